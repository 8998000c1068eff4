"""Similarity joins of strings by parts: pairs of similar strings without the pairs of their group.

Two strings that are ``d`` insertions and deletions apart keep at least one of ``d`` + 1 parts of the shorter one
whole, moved by no more than those allow. So the shorter string is indexed by its parts, the longer one is
asked for every place that such a part can have, and an equi join on (group, length, part, letters) brings together
what may be similar. The bound is on distances, so no pair is missed; equal strings are one row until the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quorumlake.functions import similarity as S


def _apart(length: Column, least: int, edits: int, edits_from: int) -> Column:
    """Most insertions and deletions between a string of ``length`` and any similar one that is no shorter."""
    by_ratio = F.floor(length * (2 * (100 - least)) / F.lit(least)).cast("int")
    return F.greatest(by_ratio, F.when(length >= edits_from - edits, 2 * edits).otherwise(0)) if edits else by_ratio


def _start(part: Column, length: Column, parts: Column) -> Column:
    return F.floor(part * length / parts).cast("int")


def similar_strings(df: DataFrame, group: str, text: str, least: int, edits: int = 0, edits_from: int = 0) -> DataFrame:
    """``(group, x, y)``, x <= y: distinct strings of a group that have an ``indel_ratio`` of ``least`` or more, or are, from
    ``edits_from`` letters on, at most ``edits`` edits apart. Each string is its own partner.

    Null groups and null texts have no partners; empty strings are alike; ``least`` is a whole number from 51 to 100. A part that very many
    strings of a group have in one place is a hot key of the join, which adaptive execution splits.
    """
    t = df.select(F.col(group).alias("g"), F.col(text).alias("s")).where("g is not null and s is not null").distinct()
    t = t.withColumn("n", F.length("s"))
    own = lambda n: _apart(n, least, edits, edits_from)
    n, size, d, part, at = F.col("n"), F.col("len"), F.col("d"), F.col("part"), F.col("at")

    def parts(rows: DataFrame) -> DataFrame:
        """A row a part of a string of length ``len``, with where it starts and how long it is."""
        rows = rows.withColumn("d", own(size)).withColumn("part", F.explode(F.sequence(F.lit(0), d)))
        return rows.withColumns({"at": _start(part, size, d + 1), "wide": _start(part + 1, size, d + 1) - _start(part, size, d + 1)})

    short = parts(t.withColumn("len", n)).select("g", "len", "part", F.expr("substring(s, at + 1, wide)").alias("key"), F.col("s").alias("a"))
    lowest = F.greatest(F.lit(0), F.floor(n * least / F.lit(200 - least)).cast("int") - 2 * edits)
    lengths = F.filter(F.sequence(lowest, n), lambda m: n - m <= own(m))
    long = parts(t.withColumn("len", F.explode(lengths)))
    left, right = F.floor((d - (n - size)) / 2).cast("int"), F.floor((d + (n - size)) / 2).cast("int")
    places = F.filter(F.sequence(at - left, at + right), lambda p: (p >= 0) & (p + F.col("wide") <= n))
    long = long.withColumn("place", F.explode(places)).select("g", "len", "part", F.expr("substring(s, place + 1, wide)").alias("key"), F.col("s").alias("b")).distinct()
    met = short.join(long, ["g", "len", "part", "key"]).select("g", F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y")).distinct()
    alike = (F.col("x") == F.col("y")) | (S.indel_ratio(F.col("x"), F.col("y"), least) >= least)
    if edits:
        alike = alike | ((F.greatest(F.length("x"), F.length("y")) >= edits_from) & S.within_edits(F.col("x"), F.col("y"), edits))
    return met.where(alike).select(F.col("g").alias(group), "x", "y")


def similar_rows(df: DataFrame, id_col: str, group: str, text: str, least: int, **how) -> DataFrame:
    """``(a, b)``, a < b: ids of rows of a group whose strings are similar."""
    found = similar_strings(df, group, text, least, **how).select(F.col(group).alias("_g"), "x", "y")
    rows = df.select(F.col(group).alias("_g"), F.col(text).alias("_s"), F.col(id_col).alias("_i"))
    one = found.join(rows.select("_g", F.col("_s").alias("x"), F.col("_i").alias("i")), ["_g", "x"])
    both = one.join(rows.select("_g", F.col("_s").alias("y"), F.col("_i").alias("j")), ["_g", "y"])
    pair = both.where((F.col("x") != F.col("y")) | (F.col("i") < F.col("j"))).where("i <> j")
    return pair.select(F.least("i", "j").alias("a"), F.greatest("i", "j").alias("b")).distinct()
