"""Sources with declared schemas. Blank means missing, never 0."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Schemas of the tables of the contest family.
CANDIDATE = "na string, candidate_name string, party string, votes bigint, rank int"
CONSTITUENCY = (
    "na string, constituency_name string, province string, winner_name string, winner_party string, winner_votes bigint, runnerup_name string, "
    "runnerup_party string, runnerup_votes bigint, registered_voters bigint, votes_polled bigint, turnout_pct double"
)
OVERRIDES = (
    "merges array<struct<ids:array<string>,why:string>>, splits array<struct<person_id:string,match:struct<year:string,district:string,"
    "district_contains:string,name_contains:string>,merge_into:string,why:string>>"
)
FEATURES = "type string, features array<struct<type:string,properties:map<string,string>,geometry:struct<type:string,coordinates:string>>>"


def csv(spark: SparkSession, path, schema: str, strict: bool = True) -> DataFrame:
    """Typed CSV with a header; a malformed row fails, or becomes nulls if not ``strict``."""
    return spark.read.csv(path, schema=schema, header=True, nullValue="", mode="FAILFAST" if strict else "PERMISSIVE", multiLine=False)


def csv_rows(spark: SparkSession, path) -> DataFrame:
    """CSV with every column a string, blanks null, plus ``pos``: source order within all files."""
    d = spark.read.csv(path, header=True, nullValue="", inferSchema=False)
    return d.withColumn("pos", F.monotonically_increasing_id())


def aliased(df: DataFrame, names: dict[str, list[str]]) -> DataFrame:
    """Columns under one name each: the first alias that the source has, null if it has none."""
    have = set(df.columns)
    return df.select(*[next((F.col(a) for a in [n, *alias] if a in have), F.lit(None).cast("string")).alias(n) for n, alias in names.items()])


def json_documents(spark: SparkSession, path, schema: str) -> DataFrame:
    return spark.read.json(path, schema=schema, multiLine=True)


def json_by_key(spark: SparkSession, path, value: str, keys: tuple[str, ...] = ("year", "na")) -> DataFrame:
    """A document nested by one or more keys, as rows (keys, value)."""
    kind = value
    for _ in keys:
        kind = f"map<string,{kind}>"
    d = spark.read.text(path, wholetext=True).select(F.from_json("value", kind).alias("_m"))
    for k in keys:
        rest = [c for c in d.columns if c != "_m"]
        d = d.select(*rest, F.explode("_m").alias(k, "_m"))
    return d.withColumnRenamed("_m", "value")


def geojson(spark: SparkSession, path) -> DataFrame:
    """A row a feature: properties map, geometry type, coordinates as rings of polygons."""
    coords = "array<array<array<double>>>"
    d = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", FEATURES)["features"]).alias("f"))
    g = d.select(F.col("f.properties").alias("properties"), F.col("f.geometry.type").alias("kind"), F.col("f.geometry.coordinates").alias("_c"))
    many = F.when(F.col("kind") == "Polygon", F.array(F.from_json("_c", coords))).otherwise(F.from_json("_c", f"array<{coords}>"))
    return g.select("properties", "kind", many.alias("polygons"))


def embedded_json(text: Column, marker: str, schema: str) -> Column:
    """The JSON literal assigned to ``marker`` on its line of a larger text."""
    return F.from_json(F.regexp_extract(text, rf"(?m){marker}\s*=\s*(\{{.*\}}|\[.*\])\s*;?\s*$", 1), schema)


def pages(spark: SparkSession, path, number: str = r"(\d+)\.\w+$") -> DataFrame:
    """``(path, number, text)`` of cached pages, one file each, with the number that the pattern finds in the path; bytes that
    are no UTF-8 count as Windows-1252, or as Latin-1 if they hold one that Windows-1252 lacks."""
    d = spark.read.format("binaryFile").load(path).select("path", "content")
    latin = F.decode("content", "ISO-8859-1")
    known = {c: bytes([c]).decode("cp1252", "ignore") for c in range(0x80, 0xA0)}
    windows = F.translate(latin, "".join(chr(c) for c, x in known.items() if x), "".join(known.values()))
    other = F.when(latin.rlike(f"[{''.join(chr(c) for c, x in known.items() if not x)}]"), latin).otherwise(windows)
    text = F.when(F.is_valid_utf8(F.col("content").cast("string")), F.col("content").cast("string")).otherwise(other)
    return d.select("path", F.nullif(F.regexp_extract("path", number, 1), F.lit("")).cast("int").alias("number"), text.alias("text"))


def missing_pages(pages_: DataFrame, high: int) -> DataFrame:
    return pages_.sparkSession.range(1, high + 1).select(F.col("id").cast("int").alias("number")).join(pages_.select("number"), "number", "left_anti")


def last_file_wins(df: DataFrame, keys: list[str], file: str = "path") -> DataFrame:
    """Of rows read from several files, the one of the last file by name for each key."""
    w = Window.partitionBy(*keys).orderBy(F.desc(file))
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def literal(spark: SparkSession, text: str, names: list[str], row: str = "|", cell: str = ";") -> DataFrame:
    """A small table written in the code; ``pos`` is its order."""
    rows = [(i, *[c.strip() or None for c in r.split(cell)]) for i, r in enumerate(x for x in text.split(row) if x.strip())]
    return spark.createDataFrame(rows, f"pos int, {', '.join(n + ' string' for n in names)}")


def memo(cache: DataFrame, asked: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(answers, still to be made): a key in the cache is a hit even if its value is null."""
    return asked.join(cache, key), asked.join(cache.select(key), key, "left_anti")


def calendar(spark: SparkSession, years: list[int]) -> DataFrame:
    """``(year, period_no)``: periods count the polls, not the years between."""
    return spark.createDataFrame([(y, i + 1) for i, y in enumerate(sorted(years))], "year int, period_no int")


def poll_date(c: Column, pivot: int = 30) -> Column:
    """A date written ``M/d/yy`` (years up to ``pivot`` are of this century) or ISO; null for anything else."""
    century = F.when(F.regexp_extract(c, r"(\d{2})$", 1) <= str(pivot), "20").otherwise("19")
    full = F.concat(F.regexp_extract(c, r"^(\d{1,2}/\d{1,2}/)\d{2}$", 1), century, F.regexp_extract(c, r"(\d{2})$", 1))
    return F.coalesce(F.try_to_timestamp(full, F.lit("M/d/yyyy")), F.try_to_timestamp(c, F.lit("yyyy-MM-dd"))).cast("date")
