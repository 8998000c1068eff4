"""Exact dedup: groups by a 128-bit content hash, the bytes of their texts compared.

A slim table (id, hash, length) is made in one pass and grouped by hash; texts are not shuffled for that. Only the texts of
hashes that occur more than once meet for the comparison: grouped by (hash, text), which compares bytes, and collapses
copies in each task first, so that a group with a third of all rows is a row a task after it. Where a hash has more
than one text, its rows are grouped once more by the text itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quorumlake.plans.joins import join_dim
from quorumlake.plans.staging import Scope, Stage

#: Repeated hashes (16 bytes each) that are sent to the tasks which choose the texts to compare; beyond, all texts meet.
MOST_SENT = 500_000


def normalised(text: str = "text") -> Column:
    """The text without ASCII white space; null is empty."""
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+", "")


def content_hash(norm: Column) -> Column:
    """128 bits: the first half of the text's SHA-256, which the result carries anyway."""
    return F.unhex(F.substring(F.sha2(norm, 256), 1, 32))


def _decided(rows: DataFrame, keys: list[str], groups: DataFrame | None = None) -> DataFrame:
    """Rows (id, row, n_chars, sha, keys) with their group's size and the row that stays."""
    if groups is None:
        groups = _groups(rows, keys)
    out = join_dim(rows, groups, keys, "left")
    alone = F.col("_size").isNull()
    return out.select(
        "id", "row", F.when(alone, F.col("id")).otherwise(F.col("_best.id")).alias("keep_id"), F.coalesce("_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("_best.row") == F.col("row"))).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"),
    )


def _groups(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Groups of two rows and more. The most code points come first, then the smallest id (null last), then the row."""
    best = F.min(F.struct((-F.col("n_chars")).alias("n"), F.col("id").isNull().alias("none"), "id", "row"))
    return rows.groupBy(*keys).agg(F.count("*").alias("_size"), best.alias("_best")).where("_size > 1")


def marks(docs: DataFrame, id_col: str = "doc_id", text: str = "text", hashed=content_hash, most_sent: int = MOST_SENT, row: str | None = None) -> DataFrame:
    """``(id, keep_id, group_size, kept, text_sha256)`` for every row; texts are equal if they are without ASCII white space.

    Of equal texts the row with the most code points stays, of those the one with the smallest id (a null id is the largest), of
    rows that repeat an id one. ``hashed`` makes the hash of a normalised text: whatever it is, only equal bytes make a group.
    Defined cases: null counts as empty, and empty and blank texts are equal; an empty table gives none; other columns are ignored.
    ``row`` names a unique column, which is returned as well; without it rows are numbered.
    """
    norm = normalised(text)
    number = F.col(row) if row else F.monotonically_increasing_id()
    with Scope(docs.sparkSession) as made:
        stage = Stage(docs.sparkSession, "exact")
        full = docs.select(F.col(id_col).alias("id"), number.alias("row"), F.coalesce(F.length(text), F.lit(0)).cast("long").alias("n_chars"), norm.alias("norm"))
        full = full.withColumns({"h": hashed(F.col("norm")), "sha": F.unhex(F.sha2("norm", 256))})
        slim = stage.put(full.drop("norm"), "slim")
        groups = stage.put(_groups(slim, ["h"]), "groups")
        made.keep(slim, groups)
        texts = docs.select(norm.alias("norm")).select(hashed(F.col("norm")).alias("h"), "norm")
        repeated = groups.select("h")
        if repeated.limit(most_sent + 1).count() <= most_sent:
            texts = texts.join(F.broadcast(repeated), "h", "left_semi")
        met = stage.put(texts.groupBy("h", "norm").agg(F.count("*").alias("n")).groupBy("h").agg(F.count("*").alias("texts")).where("texts > 1").select("h"), "met")
        if met.isEmpty():
            out = _decided(slim, ["h"], groups)
        else:
            made.keep(met)
            mixed = stage.put(join_dim(full, met, "h", "left_semi"), "mixed")
            made.keep(mixed)
            rest = _decided(join_dim(slim, met, "h", "left_anti"), ["h"], groups)
            out = rest.unionByName(_decided(mixed, ["h", "norm"]))
    named = {"id": id_col} | ({"row": row} if row else {})
    return out.select(*[F.col(c).alias(named.get(c, c)) for c in out.columns if c != "row" or row])


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """``docs`` without the rows that ``marks`` drops; all columns, whatever their names. The rows are staged once, numbered,
    and lose those whose number is among the dropped."""
    row = "_row"
    while row in docs.columns:
        row = f"_{row}"
    rows = Stage(docs.sparkSession, "exact").put(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    gone = marks(rows, id_col, text, row=row, **how).where("not kept").select(row)
    return join_dim(rows, gone, row, "left_anti").drop(row)
