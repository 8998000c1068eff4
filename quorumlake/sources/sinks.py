"""Sinks: CSV, JSON lines, nested documents, GeoJSON, upserts, templates and guarded patches of text files."""

from __future__ import annotations

import re
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str) -> None:
    df.write.csv(path, header=True)


def write_json(df: DataFrame, path: str, indented: bool = False) -> None:
    """A compact JSON object a line, or an indented array of objects a file, a file a partition, for documents that people read."""
    if not indented:
        df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.text(path)
        return
    rows = df.select(F.struct(*df.columns).alias("r"), F.spark_partition_id().alias("p")).groupBy("p").agg(F.collect_list("r").alias("rs"))
    rows.select(F.to_json("rs", {"pretty": "true"}).alias("value")).write.text(path)


def nested(df: DataFrame, outer: str, inner: str, fields: list[str]) -> DataFrame:
    """``(outer, document)``: a row an outer key, its rows as a map by the inner key, ready for one file each."""
    entry = F.struct(F.col(inner), F.struct(*fields))
    return df.groupBy(outer).agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("document"))


def rounded(points: Column, digits: int = 4) -> Column:
    """Rings of struct(x, y) as arrays of pairs, to some decimals."""
    return F.transform(points, lambda ring: F.transform(ring, lambda p: F.array(F.round(p["x"], digits), F.round(p["y"], digits))))


def feature(properties: list[str], rings: Column) -> Column:
    """GeoJSON text of a polygon feature, its rings closed, to four decimals; null for an empty geometry."""
    closed = F.transform(rings, lambda r: F.concat(r, F.slice(r, 1, 1)))
    geometry = F.struct(F.lit("Polygon").alias("type"), rounded(closed).alias("coordinates"))
    whole = F.struct(F.lit("Feature").alias("type"), F.struct(*properties).alias("properties"), geometry.alias("geometry"))
    return F.when(F.size(rings) > 0, F.to_json(whole))


def write_geojson(df: DataFrame, path: str, properties: list[str], rings: str) -> int:
    """A FeatureCollection of the rows as one text file a partition, each whole; rows without a geometry are left out. Returns
    how many were."""
    d = df.select(feature(properties, F.col(rings)).alias("f"), F.spark_partition_id().alias("p"))
    head, tail = F.lit('{"type":"FeatureCollection","features":['), F.lit("]}")
    d.where("f is not null").groupBy("p").agg(F.concat(head, F.array_join(F.array_sort(F.collect_list("f")), ","), tail).alias("value")).select("value").write.text(path)
    return df.where(F.coalesce(F.size(rings), F.lit(0)) <= 0).count()


def fill_template(text: str, values: dict[str, str]) -> str:
    """``text`` with every ``/*__NAME__*/`` replaced by its value; a name that the text lacks or leaves over is an error."""
    for name, value in values.items():
        mark = f"/*__{name}__*/"
        if mark not in text:
            raise ValueError(f"{mark} is not in the template")
        text = text.replace(mark, value)
    rest = re.search(r"/\*__\w+__\*/", text)
    if rest:
        raise ValueError(f"{rest[0]} has no value")
    return text


def patch_once(text: str, old: str, new: str) -> str:
    """``text`` with ``old``, which must occur exactly once, replaced."""
    n = text.count(old)
    if n != 1:
        raise ValueError(f"the text to replace occurs {n} times")
    return text.replace(old, new)


def patch_file(spark: SparkSession, path: str, change: Callable[[str], str]) -> str:
    """Puts a text file through ``change``, with a copy beside it first; returns the copy's path. If ``change`` fails nothing is touched."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    new = change(spark.read.text(path, wholetext=True).first()[0])
    copy = jvm.org.apache.hadoop.fs.Path(f"{path}.bak_{int(time.time() * 1000)}")
    jvm.org.apache.hadoop.fs.FileUtil.copy(fs, p, fs, copy, False, spark._jsc.hadoopConfiguration())
    out = fs.create(p, True)
    out.write(bytearray(new.encode()))
    out.close()
    return copy.toString()


def replace_value(text: str, key: str, value: str) -> str:
    """``text`` with the braced or bracketed value that follows ``key`` replaced; braces inside strings do not count."""
    found = re.search(rf"[\"']?{re.escape(key)}[\"']?\s*[:=]\s*", text)
    if not found or text[found.end() : found.end() + 1] not in ("{", "["):
        raise ValueError(f"no braced value of {key}")
    depth, quote, i = 0, "", found.end()
    while i < len(text):
        c = text[i]
        if quote:
            i += c == "\\"
            quote = "" if c == quote else quote
        elif c in "\"'`":
            quote = c
        elif c in "{[":
            depth += 1
        elif c in "}]":
            depth -= 1
            if not depth:
                return text[: found.end()] + value + text[i + 1 :]
        i += 1
    raise ValueError(f"the value of {key} does not end")


def upsert(layer: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Values of ``new`` replace those of its keys' rows; keys that the layer lacks are not added."""
    cols = [c for c in new.columns if c != key]
    n = new.select(key, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_{c}") for c in cols])
    out = layer.join(n, key, "left")
    return out.select(*[F.when(F.col("_hit"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in cols else F.col(c) for c in layer.columns])
