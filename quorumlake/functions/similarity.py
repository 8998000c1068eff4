"""Edit similarities and set overlaps: built-in functions but for the edit similarity, which runs on Arrow batches."""

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from quorumlake.plans.joins import join_dim
from quorumlake.plans.staging import Scope, Stage


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence: a row of the table is the bits of one integer."""
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    full = row = (1 << len(a)) - 1
    for c in b:
        hit = row & at.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


@F.pandas_udf(DoubleType())
def _ratio(a: pd.Series, b: pd.Series, least: pd.Series) -> pd.Series:
    """In Arrow batches; 0 without a comparison where the lengths cannot reach ``least``."""
    out = []
    for x, y, low in zip(a, b, least):
        if x is None or y is None:
            out.append(None)
        elif x == y:
            out.append(100.0)
        else:
            n = len(x) + len(y)
            out.append(200.0 * lcs(x, y) / n if 200.0 * min(len(x), len(y)) >= low * n else 0.0)
    return pd.Series(out, dtype="float64")


def indel_ratio(a: Column, b: Column, least: float = 0.0) -> Column:
    """100 (1 - insertions and deletions / total length) = 200 LCS / (|a| + |b|); two empty strings are alike. With
    ``least`` pairs that cannot reach it count as 0."""
    return _ratio(a, b, F.lit(float(least)))


def token_sort_ratio(a: Column, b: Column, least: float = 0.0) -> Column:
    """``indel_ratio`` of the sorted tokens."""
    ordered = lambda s: F.array_join(F.array_sort(F.filter(F.split(s, " "), lambda t: t != "")), " ")
    return indel_ratio(ordered(a), ordered(b), least)


def can_reach(a: Column, b: Column, least: float) -> Column:
    """Whether two strings' lengths allow an ``indel_ratio`` of ``least``: a cheap test to put before it."""
    return F.lit(200.0) * F.least(F.length(a), F.length(b)) >= F.lit(least) * (F.length(a) + F.length(b))


def within_edits(a: Column, b: Column, most: int = 1) -> Column:
    """Levenshtein distance of at most ``most``."""
    return F.levenshtein(a, b, most).between(0, most)


def jaccard(a: Column, b: Column) -> Column:
    """|a ∩ b| / |a ∪ b| of two arrays as sets; null if both are empty."""
    return F.size(F.array_intersect(a, b)) / F.nullif(F.size(F.array_union(a, b)), F.lit(0))


def contained(a: Column, b: Column) -> Column:
    """One of two sets contains the other."""
    return (F.size(F.array_except(a, b)) == 0) | (F.size(F.array_except(b, a)) == 0)


def differ_by(a: Column, b: Column, fillers: list[str], least: int = 3) -> Column:
    """Sets of at least ``least`` tokens, one inside the other, that differ by fillers alone."""
    odd = F.array_union(F.array_except(a, b), F.array_except(b, a))
    filler = F.array(*map(F.lit, fillers)) if fillers else F.array().cast("array<string>")
    return (F.least(F.size(F.array_distinct(a)), F.size(F.array_distinct(b))) >= least) & contained(a, b) & (F.size(F.array_except(odd, filler)) == 0)


#: Keys of an item beyond which only ``_rare_first`` brings them together; pairs that a task of ``overlaps`` counts.
HEAVY, TASK_PAIRS = 4096, 1 << 21


def _rare_first(d: DataFrame, least: int) -> DataFrame:
    """``(a, b)``, a < b: keys of ``d`` (k, i) that share ``least`` items, and some that share fewer.

    Items are put in one order, the rare ones first. Two sets with so many in common have one among all but the last ``least`` - 1 of each of their items, so
    only these bring keys together, and what very many keys have brings none, unless it is all that a small set has."""
    w = Window.partitionBy("k")
    rare = join_dim(d, d.groupBy("i").agg(F.count("*").alias("_df")), "i", "inner")
    rare = rare.withColumns({"_at": F.row_number().over(w.orderBy("_df", "i")), "_n": F.count("*").over(w)})
    first = rare.where(F.col("_at") <= F.col("_n") - (least - 1)).select("k", "i")
    return first.withColumnRenamed("k", "a").join(first.withColumnRenamed("k", "b"), "i").where("a < b").select("a", "b").distinct()


def _counted(d: DataFrame, held: list[str]) -> DataFrame:
    """``(a, b, l)``, a < b: how many items of ``d`` (k, i, held) two keys share, with ``held`` of both. An item gives each of its keys an array of those after
    it; the arrays of a key lie in one task, which counts its partners, so no pair is shuffled."""
    lists = d.groupBy("i").agg(F.sort_array(F.collect_list(F.struct("k", *held) if held else F.col("k"))).alias("_ks")).where(F.size("_ks") > 1)
    pairs = lists.agg(F.sum(F.size("_ks").cast("double") * (F.size("_ks") - 1) / 2)).first()[0] or 0
    tasks = max(int(d.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(pairs // TASK_PAIRS) + 1)
    rows = lists.select("_ks", F.posexplode("_ks").alias("_p", "_a")).where(F.col("_p") + 1 < F.size("_ks"))
    rows = rows.select("_a", F.slice("_ks", F.col("_p") + 2, F.size("_ks")).alias("_bs"))
    if not held:
        return rows.withColumnRenamed("_a", "a").repartition(tasks, "a").select("a", F.explode("_bs").alias("b")).groupBy("a", "b").agg(F.count("*").alias("l"))
    sides = [F.col(f"_{s}.{c}").alias(f"{c}_{s}") for c in held for s in "ab"]
    rows = rows.select(F.col("_a.k").alias("a"), "_a", "_bs").repartition(tasks, "a").select("a", "_a", F.explode("_bs").alias("_b"))
    return rows.select("a", F.col("_b.k").alias("b"), *sides).groupBy("a", "b", *[f"{c}_{s}" for c in held for s in "ab"]).agg(F.count("*").alias("l"))


def overlaps(df: DataFrame, key: str, item: str, least: int = 1) -> DataFrame:
    """``(a, b, shared, iou)``, a < b, of all keys whose sets have ``least`` items and more in common.

    Pairs are counted item by item (``_counted``). With ``least`` over 1 items of over ``HEAVY`` keys are left out there: they are added for the pairs that
    could reach ``least`` with them, and bring together by themselves only what ``_rare_first`` does.
    With ``least`` 1 every common item brings keys together, as many pairs as there are overlaps."""
    d = df.select(F.col(key).alias("k"), F.col(item).alias("i")).where("i is not null").distinct()
    if least > 1:
        with Scope(df.sparkSession) as made:
            stage = Stage(df.sparkSession, "overlaps")
            d = stage.put(d.where("k is not null"), "sets")
            heavy = stage.put(d.groupBy("i").agg(F.count("*").alias("_df")).where(F.col("_df") > HEAVY).select("i"), "heavy")
            if heavy.isEmpty():
                met = stage.put(_counted(d, []).where(F.col("l") >= least).select("a", "b", F.col("l").alias("shared")), "met")
            else:
                hot = stage.put(join_dim(d, heavy, "i", "left_semi").select("k", "i"), "hot")
                own = stage.put(hot.groupBy("k").agg(F.collect_set("i").alias("s"), F.count("*").alias("h")), "own")
                light = join_dim(join_dim(d, heavy, "i", "left_anti"), own.select("k", "h"), "k").withColumn("h", F.coalesce("h", F.lit(0).cast("long")))
                count = stage.put(_counted(light, ["h"]).where(F.col("l") + F.least("h_a", "h_b") >= least).select("a", "b", "l"), "count")
                met = count.unionByName(_rare_first(hot, least).withColumn("l", F.lit(0).cast("long"))).groupBy("a", "b").agg(F.max("l").alias("l"))
                for side in "ab":
                    met = join_dim(met, own.select(F.col("k").alias(side), F.col("s").alias(f"s_{side}")), side)
                more = F.when(F.col("s_a").isNotNull() & F.col("s_b").isNotNull(), F.size(F.array_intersect("s_a", "s_b"))).otherwise(0)
                met = stage.put(met.select("a", "b", (F.col("l") + more).alias("shared")).where(F.col("shared") >= least), "met")
            made.keep(d, met)
    else:
        met = d.select(F.col("k").alias("a"), "i").join(d.select(F.col("k").alias("b"), "i"), "i").where("a < b").groupBy("a", "b").agg(F.count("*").alias("shared"))
    n = d.groupBy("k").agg(F.count("*").alias("n"))
    for side in "ab":
        met = join_dim(met, n.select(F.col("k").alias(side), F.col("n").alias(f"n_{side}")), side, "inner")
    return met.select("a", "b", "shared", (F.col("shared") / (F.col("n_a") + F.col("n_b") - F.col("shared"))).alias("iou"))
