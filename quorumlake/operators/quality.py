"""Checks: gaps, coverage, agreement, row arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quorumlake.plans.joins import BROADCAST_ROWS
from quorumlake.plans.staging import Stage


def gaps(df: DataFrame, number: str, low: int, high: int) -> DataFrame:
    """Numbers of low..high that do not occur."""
    return df.sparkSession.range(low, high + 1).toDF(number).join(df.select(F.col(number).cast("long").alias(number)), number, "left_anti")


def unclaimed(vocabulary: DataFrame, claimed: DataFrame, key: str) -> DataFrame:
    return vocabulary.select(key).distinct().join(claimed.select(key), key, "left_anti")


def agreement(a: DataFrame, b: DataFrame, keys: list[str], value_a: str, value_b: str) -> DataFrame:
    """Of the keys in both: how many were checked, agree (missing values never do), and the rate in percent."""
    j = a.join(b, keys)
    same = F.coalesce(F.col(value_a) == F.col(value_b), F.lit(False))
    return j.agg(F.count("*").alias("checked"), F.count_if(same).alias("agree"), F.round(100.0 * F.count_if(same) / F.count("*"), 1).alias("rate"))


def disagreements(a: DataFrame, b: DataFrame, keys: list[str], value_a: str, value_b: str) -> DataFrame:
    return a.join(b, keys).where(~F.coalesce(F.col(value_a) == F.col(value_b), F.lit(False))).select(*keys, value_a, value_b)


def flags(checks: dict[str, Column]) -> Column:
    """Names of the checks that fail; a check with a missing operand does not."""
    return F.filter(F.array(*[F.when(~F.coalesce(ok, F.lit(True)), F.lit(name)) for name, ok in checks.items()]), lambda x: x.isNotNull())


def ballot_flags() -> Column:
    """Arithmetic of an official result form."""
    c = F.col
    return flags({
        "polled": c("valid_votes") + c("rejected_votes") == c("polled_total"),
        "registered": c("reg_male") + c("reg_female") == c("reg_total"),
        "winner": c("winner_votes") <= c("valid_votes"),
    })


def exactly(df: DataFrame, n: int, what: str = "rows") -> DataFrame:
    """``df``, which fails when read unless it has ``n`` rows. The count is a job of its own, now."""
    found = df.count()
    if found != n:
        raise ValueError(f"{what}: {found} instead of {n}")
    return df


def quantiles(df: DataFrame, value: str, at: list[float], group: list[str] = ()) -> DataFrame:
    """Exact quantiles with linear interpolation, and the root mean square; missing values are left out.

    Equal values are counted before they move. Distinct values are range-partitioned, and the counts of each group in each
    partition tell where a quantile's two neighbours lie: only those cells are sorted, so no task holds a group."""
    group = list(group)
    keys = [f"_g{i}" for i in range(len(group))]
    stage = Stage(df.sparkSession, "quantiles")
    d = df.select(*[F.col(g).alias(k) for g, k in zip(group, keys)], F.col(value).cast("double").alias("_v")).where("_v is not null")
    counted = d.groupBy(*keys, "_v").agg(F.count("*").alias("_n")).repartitionByRange(*[F.col(k).asc_nulls_first() for k in keys], "_v")
    counted = stage.put(counted.withColumn("_pid", F.spark_partition_id()), "values")
    cells = counted.groupBy(*keys, "_pid").agg(F.sum("_n").alias("_n"), F.sum(F.col("_n") * F.col("_v") * F.col("_v")).alias("_sq"))
    whole = Window.partitionBy(*keys)
    before = F.coalesce(F.sum("_n").over(whole.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cells = cells.select("*", before.alias("_before"), F.sum("_n").over(whole).alias("_all"), F.sum("_sq").over(whole).alias("_squares"))
    asked = []
    for i, q in enumerate(at):
        pos = F.lit(float(q)) * (F.col("_all") - 1)
        part = pos - F.floor(pos)
        for k, weight in ((F.floor(pos), 1 - part), (F.floor(pos) + 1, part)):
            asked.append(F.struct(F.lit(i).alias("i"), (k - F.col("_before")).alias("k"), weight.alias("weight")))
    here = lambda x: (x["weight"] > 0) & (x["k"] >= 0) & (x["k"] < F.col("_n"))
    cells = cells.select(*[F.col(k).alias(f"c{k}") for k in keys], F.col("_pid").alias("_cell"), F.sqrt(F.col("_squares") / F.col("_all")).alias("rms"), F.filter(F.array(*asked), here).alias("_asked"))
    cells = stage.put(cells.where(F.size("_asked") > 0), "cells")
    same = F.col("_pid") == F.col("_cell")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"c{k}"))
    few = cells.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    rows = counted.join(F.broadcast(cells) if few else cells, same)
    upto = F.sum("_n").over(Window.partitionBy(*keys, "_pid").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("_upto", upto).withColumn("_x", F.explode("_asked")).where("_x.k < _upto and _x.k >= _upto - _n")
    named = [F.sum(F.when(F.col("_x.i") == i, F.col("_x.weight") * F.col("_v"))).alias(f"q{round(100 * q)}") for i, q in enumerate(at)]
    return rows.groupBy(*keys).agg(*named, F.first("rms").alias("rms")).withColumnsRenamed(dict(zip(keys, group)))


def metrics(a: float, parts: Column, whole: Column, overlap: Column) -> Column:
    """struct(factor, residue): the parts' sum over the whole (1 for a partition) and overlap over the whole, which should not
    exceed ``a``; ``ok`` tells."""
    factor, residue = F.try_divide(parts, whole), F.try_divide(overlap, whole)
    return F.struct(factor.alias("factor"), residue.alias("residue"), (residue <= a).alias("ok"))


def area_shares(df: DataFrame, canvas: str, area: str, km2: float) -> DataFrame:
    """``df`` with ``share`` of its canvas and ``km2``: the area times a constant."""
    w = Window.partitionBy(canvas)
    return df.withColumns({"share": F.try_divide(F.col(area), F.sum(area).over(w)), "km2": F.col(area) * F.lit(km2)})


def coverage(cells: DataFrame, unit: str = "label") -> DataFrame:
    """Of a labelled grid: cells, unlabelled ones, and cells labelled more than once."""
    per = cells.groupBy("ix", "iy").agg(F.count(unit).alias("n"))
    return per.agg(F.count("*").alias("cells"), F.count_if(F.col("n") == 0).alias("unlabelled"), F.count_if(F.col("n") > 1).alias("overlapping"))


def attempted(value: Column, fallback: Column, why: str) -> Column:
    """struct(value, issue): ``fallback`` and the reason where ``value`` (a try_ expression) is null."""
    return F.struct(F.coalesce(value, fallback).alias("value"), F.when(value.isNull(), why).alias("issue"))
