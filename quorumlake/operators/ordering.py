"""Global order without a single task: range buckets, ranks inside them, offsets of the buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quorumlake.plans.staging import Stage


def global_rank(df: DataFrame, order: list, name: str = "rank", partitions: int | None = None) -> DataFrame:
    """Adds 1..n by ``order`` (give it a total order). Rows are range-partitioned and staged, so that
    the bucket of a row is fixed; then ranks within buckets plus the counts of the buckets before."""
    spark = df.sparkSession
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    staged = Stage(spark, "rank").put(ranged.withColumn("_pid", F.spark_partition_id()), "ranged")
    sizes = staged.groupBy("_pid").agg(F.count("*").alias("_n"))  # a row a partition: one task can hold it
    offsets = sizes.select("_pid", (F.sum("_n").over(Window.orderBy("_pid")) - F.col("_n")).alias("_before"))
    within = F.row_number().over(Window.partitionBy("_pid").orderBy(*order))
    return staged.withColumn("_in", within).join(offsets, "_pid").withColumn(name, (F.col("_in") + F.col("_before")).cast("long")).drop("_pid", "_in", "_before")


def global_prefix(df: DataFrame, order: list, value: str, name: str = "upto") -> DataFrame:
    """Adds the sum of ``value`` over all rows up to each by ``order``, as ``global_rank`` counts them; missing values add nothing."""
    staged = Stage(df.sparkSession, "prefix").put(df.repartitionByRange(*order).withColumn("_pid", F.spark_partition_id()), "ranged")
    sums = staged.groupBy("_pid").agg(F.coalesce(F.sum(value), F.lit(0)).alias("_s"))
    before = sums.select("_pid", (F.sum("_s").over(Window.orderBy("_pid")) - F.col("_s")).alias("_before"))
    w = Window.partitionBy("_pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return staged.withColumn("_in", F.coalesce(F.sum(value).over(w), F.lit(0))).join(before, "_pid").withColumn(name, F.col("_in") + F.col("_before")).drop("_pid", "_in", "_before")


def place_in(c: Column, order: list[str], unknown: int = 99) -> Column:
    """Position of a value in a list that sets the order of ties; ``unknown`` if it is not there."""
    at = F.array_position(F.array(*map(F.lit, order)), c)
    return F.when(at > 0, at - 1).otherwise(unknown).cast("int")
