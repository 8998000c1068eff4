"""Careers: a person's rows over time, as windows by person."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quorumlake.operators.contest import keep_first
from quorumlake.plans.joins import join_dim


def best_rows(df: DataFrame, person: str, year: str, won: Column, rank: str, pos: list) -> DataFrame:
    """One row a person and year: a win first, then the best rank (unreadable counts 99), then source order."""
    key = F.coalesce(F.expr(f"try_cast({rank} as int)"), F.lit(99))
    d = df.withColumns({"_lost": F.when(won, 0).otherwise(1), "_rank": key})
    return keep_first(d, [person, year], ["_lost", "_rank", *pos]).drop("_lost", "_rank")


def steps(df: DataFrame, person: str, order: list, columns: list[str]) -> DataFrame:
    """Each row beside the person's next one: ``next_`` columns; the last row is left out."""
    w = Window.partitionBy(person).orderBy(*order)
    d = df.withColumns({f"next_{c}": F.lead(c).over(w) for c in columns}).withColumn("_last", F.lead(F.lit(1)).over(w))
    return d.where("_last is not null").drop("_last")


def with_period(df: DataFrame, calendar: DataFrame, year: str, period: str = "period_no") -> DataFrame:
    """Numbers the years by a calendar (year, period_no): neighbours differ by one, whatever the years."""
    return join_dim(df, calendar, year, "inner")


def transitions(steps_: DataFrame, keys: list[str]) -> DataFrame:
    return steps_.groupBy(*keys).agg(F.count("*").alias("n"))


def retention(steps_: DataFrame, party: str, next_party: str, group: list[str], floor: int = 30, ignore: str = "IND") -> DataFrame:
    """Share that stayed, by group, of steps between real parties; groups under ``floor`` steps are left out."""
    real = steps_.where((F.col(party) != ignore) & (F.col(next_party) != ignore))
    out = real.groupBy(*group).agg(F.count_if(F.col(party) == F.col(next_party)).alias("stayed"), F.count("*").alias("total"))
    return out.where(F.col("total") >= floor).withColumn("rate", F.round(F.col("stayed") / F.col("total"), 3))


def turnover(rows: DataFrame, person: str, period: str, won: str) -> DataFrame:
    """By period: winners, how many ran again in the next one and won again, the rate, and how many winners
    had never run before. ``rows`` has one row a person and period."""
    w = Window.partitionBy(person).orderBy(period)
    d = rows.withColumns(
        {"_np": F.lead(period).over(w), "_nw": F.lead(won).over(w), "_first": F.min(period).over(Window.partitionBy(person))}
    ).where(F.col(won))
    again = F.coalesce(F.col("_np") == F.col(period) + 1, F.lit(False))
    out = d.groupBy(period).agg(
        F.count("*").alias("winners"), F.count_if(again).alias("ran_again"), F.count_if(again & F.col("_nw")).alias("won_again"),
        F.count_if(F.col("_first") == F.col(period)).alias("newcomers"),
    )
    return out.withColumn("rate", F.round(F.col("won_again") / F.greatest(F.col("ran_again"), F.lit(1)), 3))


def careers(df: DataFrame, person: str, year: str, fields: list[str]) -> DataFrame:
    """A row a person: ``career``, the array of its rows in order."""
    return df.groupBy(person).agg(F.array_sort(F.collect_list(F.struct(year, *fields))).alias("career"))


def switches(steps_: DataFrame, person: str, party: str, next_party: str) -> DataFrame:
    """Changes of party by person."""
    return steps_.where(F.col(party) != F.col(next_party)).groupBy(person).agg(F.count("*").alias("switches"))


def seat_moves(wins: DataFrame, person: str, district: str, least: int = 2) -> DataFrame:
    """Persons who won at least ``least`` times from at least ``least`` districts."""
    d = wins.where(F.coalesce(F.col(district), F.lit("")) != "")
    out = d.groupBy(person).agg(F.count("*").alias("wins"), F.array_sort(F.collect_set(district)).alias("districts"))
    return out.where((F.col("wins") >= least) & (F.size("districts") >= least))


def persistence(wins: DataFrame, group: list[str], person: str) -> DataFrame:
    """By group: seat wins, distinct winners, and the shares of wins held by those with two or three and more."""
    per = wins.groupBy(*group, person).agg(F.count("*").alias("_w"))
    held = lambda k: F.round(F.sum(F.when(F.col("_w") >= k, F.col("_w")).otherwise(0)) / F.sum("_w"), 3)
    return per.groupBy(*group).agg(F.sum("_w").alias("wins"), F.count("*").alias("winners"), held(2).alias("held_by_2"), held(3).alias("held_by_3"))


def spans(df: DataFrame, person: str, year: str, pos: list[str], field: str) -> DataFrame:
    """``(person, n, first, last, first_value, kinds)``: rows, first and last year, the first row's ``field`` and its sorted distinct
    values, all from partial aggregates: no history is collected."""
    return df.groupBy(person).agg(
        F.count("*").alias("n"), F.min(year).alias("first"), F.max(year).alias("last"),
        F.min_by(field, F.struct(year, *pos)).alias("first_value"), F.array_sort(F.collect_set(field)).alias("kinds"),
    )


def multi_seat(df: DataFrame, keys: list[str], least: int = 2) -> DataFrame:
    """``(keys, n)`` of persons with several rows in one period."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") >= least)
