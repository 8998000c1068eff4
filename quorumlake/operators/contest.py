"""Contest tables: ranks, winners, margins, tallies, swings.

A contest is a group of candidacy rows; ``pos`` is the source order that breaks ties. Windows run within
a contest; where a contest could be large, only its first rows matter and Spark limits each
partition's groups before the shuffle (WindowGroupLimit).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quorumlake.operators.ordering import global_prefix
from quorumlake.plans.joins import join_dim


def keep_first(df: DataFrame, keys: list[str], pos: list) -> DataFrame:
    """First row of each key in source order."""
    w = Window.partitionBy(*keys).orderBy(*pos)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def ranked(df: DataFrame, contest: list[str], votes: str, pos: list, name: str = "rank") -> DataFrame:
    """1..n by votes descending; missing votes last; ties in source order."""
    w = Window.partitionBy(*contest).orderBy(F.col(votes).desc_nulls_last(), *pos)
    return df.withColumn(name, F.row_number().over(w))


def top_k(df: DataFrame, contest: list[str], votes: str, pos: list, k: int | None = 6) -> DataFrame:
    """The first ``k`` of each contest; all for None."""
    r = ranked(df, contest, votes, pos)
    return r if k is None else r.where(F.col("rank") <= k)


def share(votes: Column, total: Column, digits: int = 1) -> Column:
    """100 votes / total, rounded; null where either is missing or the total is 0."""
    return F.round(F.try_divide(F.lit(100.0) * votes, F.nullif(total, F.lit(0))), digits)


def results(df: DataFrame, contest: list[str], candidate: str, party: str, votes: str, pos: list, zero_is_null: bool = False) -> DataFrame:
    """A row a contest: winner, runner-up, candidates, total, the winner's share and the margin in percent.

    An uncounted sole candidate wins with null votes, share and margin. A runner-up with 0 votes gives
    a margin, unless ``zero_is_null``.
    """
    r = ranked(df, contest, votes, pos)
    pick = lambda c, k: F.max(F.when(F.col("rank") == k, F.col(c)))
    out = r.groupBy(*contest).agg(
        pick(candidate, 1).alias("winner"), pick(party, 1).alias("winner_party"), pick(votes, 1).alias("winner_votes"),
        pick(candidate, 2).alias("runner_up"), pick(party, 2).alias("runner_up_party"), pick(votes, 2).alias("runner_up_votes"),
        F.count("*").alias("n_candidates"), F.sum(votes).alias("total_votes"),
    )
    second = F.nullif("runner_up_votes", F.lit(0)) if zero_is_null else F.col("runner_up_votes")
    return out.withColumns(
        {"winner_share": share(F.col("winner_votes"), F.col("total_votes")), "margin": share(F.col("winner_votes") - second, F.col("total_votes"))}
    )


def candidates_array(df: DataFrame, contest: list[str], votes: str, pos: list, fields: dict[str, str], k: int | None = 6) -> DataFrame:
    """A row a contest with ``cands``: array of structs of the first ``k`` candidates in rank order."""
    t = top_k(df, contest, votes, pos, k)
    item = F.struct("rank", *[F.col(c).alias(a) for a, c in fields.items()])
    return t.groupBy(*contest).agg(F.transform(F.array_sort(F.collect_list(item)), lambda x: x.dropFields("rank")).alias("cands"))


def mode_first(df: DataFrame, group: list[str], value: str, pos: str) -> DataFrame:
    """Most frequent value of each group; of equals the one seen first."""
    c = df.groupBy(*group, value).agg(F.count("*").alias("n"), F.min(pos).alias("_first"))
    w = Window.partitionBy(*group).orderBy(F.desc("n"), "_first")
    return c.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn", "_first")


def mode_tiebreak(df: DataFrame, group: list[str], value: str, measure: str) -> DataFrame:
    """Most frequent value; of equals the one with the larger sum of ``measure``, then the smaller value; ``tied``
    tells whether several had the highest count."""
    c = df.groupBy(*group, value).agg(F.count("*").alias("n"), F.sum(measure).alias("_m"))
    w = Window.partitionBy(*group).orderBy(F.desc("n"), F.desc_nulls_last("_m"), value)
    most = F.max("n").over(Window.partitionBy(*group))
    c = c.withColumns({"_rn": F.row_number().over(w), "_most": most})
    c = c.withColumn("tied", F.sum(F.when(F.col("n") == F.col("_most"), 1).otherwise(0)).over(Window.partitionBy(*group)) > 1)
    return c.where("_rn = 1").drop("_rn", "_most", "_m")


def weighted_mean(value: Column, weight: Column) -> Column:
    """Over rows that have both and a weight other than 0."""
    both = value.isNotNull() & (weight != 0)
    v, w = value.cast("decimal(18,4)"), weight.cast("decimal(18,4)")
    return F.try_divide(F.sum(F.when(both, v * w)).cast("double"), F.sum(F.when(both, w)).cast("double"))


def electorate(df: DataFrame, unit: list[str], registered: Column, winner_votes: Column, winner_share: Column, per_seat: int = 100_000) -> DataFrame:
    """Weight of each unit: registered voters; only if no seat has them, winners' votes over their share;
    only if none has that either, ``per_seat`` a seat."""
    implied = F.try_divide(winner_votes * 100.0, winner_share)
    return df.groupBy(*unit).agg(
        F.coalesce(F.sum(registered).cast("double"), F.sum(F.round(implied)), F.lit(float(per_seat)) * F.count("*")).alias("electorate")
    )


def swings(shares: DataFrame, period: str, category: str, value: str, lineage: DataFrame | None = None) -> DataFrame:
    """Change of each category's value from the period before; ``period`` counts 1, 2, 3...

    ``lineage`` (new, old) maps a category of the base to its successor, so it is compared with what it
    grew out of. A category that is missing on one side counts 0 there.
    """
    base = shares.select((F.col(period) + 1).alias(period), F.col(category).alias("_old"), F.col(value).alias("_base"))
    if lineage is not None:
        base = join_dim(base, lineage.select(F.col("old").alias("_old"), F.col("new").alias("_new")), "_old").withColumn("_old", F.coalesce("_new", "_old")).drop("_new")
    base = base.groupBy(period, "_old").agg(F.sum("_base").alias("_base"))
    span = shares.agg(F.min(period).alias("_lo"), F.max(period).alias("_hi"))
    now = shares.select(period, F.col(category).alias("_old"), F.col(value).alias("_now"))
    both = now.join(base, [period, "_old"], "full_outer").crossJoin(F.broadcast(span)).where((F.col(period) > F.col("_lo")) & (F.col(period) <= F.col("_hi")))
    return both.select(period, F.col("_old").alias(category), (F.coalesce("_now", F.lit(0)) - F.coalesce("_base", F.lit(0))).alias("swing"))


def running_layout(df: DataFrame, order: list, size: str, group: list[str] | None = None) -> DataFrame:
    """Adds ``start`` and ``end``: where each row lies when sizes are laid end to end, in each group or in all."""
    if not group:
        return global_prefix(df, order, size, "end").withColumn("start", F.col("end") - F.col(size))
    w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("end", F.sum(size).over(w)).withColumn("start", F.col("end") - F.col(size))


def ordinal_pairs(left: DataFrame, right: DataFrame, group: list[str], left_order: list, right_order: list) -> DataFrame:
    """Pairs the i-th row of ``left`` with the i-th of ``right`` in each group; the longer side's rest is left out."""
    n = lambda d, o: d.withColumn("ordinal", F.row_number().over(Window.partitionBy(*group).orderBy(*o)))
    return n(left, left_order).join(n(right, right_order), [*group, "ordinal"])


def priority(sources: list[DataFrame], keys: list[str], order: list | None = None) -> DataFrame:
    """One row a key from the first source that has it; ``tier`` tells which."""
    every = None
    for i, s in enumerate(sources):
        s = s.withColumn("tier", F.lit(i))
        every = s if every is None else every.unionByName(s, allowMissingColumns=True)
    return keep_first(every, keys, ["tier", *(order or [])])


def asc(c: str) -> Column:
    """Ascending with missing values last, descending with them first: what a negated comparison gives."""
    return F.col(c).asc_nulls_last()


def desc(c: str) -> Column:
    return F.col(c).desc_nulls_first()


def largest_per_group(df: DataFrame, group: str, size: str, counts: DataFrame, n: str, pos: list) -> DataFrame:
    """The largest rows of each group, as many as ``counts`` (group, n) says."""
    w = Window.partitionBy(group).orderBy(F.desc(size), *pos)
    return join_dim(df.withColumn("_rn", F.row_number().over(w)), counts.select(group, n), group, "inner").where(F.col("_rn") <= F.col(n)).drop("_rn", n)


def arc(start: Column, end: Column, total: Column, radius: float = 100.0, hole: float = 60.0) -> Column:
    """SVG path of a half-annulus sector from ``start`` to ``end`` of ``total``, left to right."""
    point = lambda share, r: F.format_string("%.2f %.2f", F.lit(radius) - F.lit(r) * F.cos(F.pi() * share), F.lit(radius) - F.lit(r) * F.sin(F.pi() * share))
    a, b = F.try_divide(start, total), F.try_divide(end, total)
    flag = lambda r, sweep: F.lit(f" A {r:g} {r:g} 0 0 {sweep} ")
    return F.concat(F.lit("M "), point(a, radius), flag(radius, 1), point(b, radius), F.lit(" L "), point(b, hole), flag(hole, 0), point(a, hole), F.lit(" Z"))


def bar_width(value: Column, most: Column, least: float = 2.0) -> Column:
    """Width in percent of a bar: at least ``least``."""
    return F.greatest(F.lit(least), F.try_divide(F.lit(100.0) * value, most))
