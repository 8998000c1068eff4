"""Joins whose broadcast side is measured first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows, and bytes of their values, of a dimension that may be sent to every executor.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 64 << 20


def _bytes(df: DataFrame):
    """Bytes of a row's values: eight a number, strings as they are, nested values as JSON."""
    total = F.lit(0).cast("long")
    for f in df.schema:
        kind = f.dataType.typeName()
        if kind in ("string", "binary"):
            total = total + F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0))
        elif kind in ("array", "map", "struct"):
            total = total + F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{f.name}`").alias("c")))), F.lit(0))
        else:
            total = total + 8
    return total


def small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` stays within both bounds; counting stops one row past the first."""
    n, size = df.limit(max_rows + 1).agg(F.count("*"), F.coalesce(F.sum(_bytes(df)), F.lit(0))).first()
    return n <= max_rows and size <= max_bytes


def spread(df: DataFrame, *by: str) -> DataFrame:
    """``df`` dealt over all cores, by ``by`` or all its columns: a small file is few tasks, which matters where each of its rows becomes many. There are
    as many tasks at least as the session's shuffles have."""
    spark = df.sparkSession
    n = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(n, *(by or df.columns))


def join_dim(fact: DataFrame, dim: DataFrame, on, how: str = "left", max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join ``dim`` by broadcast if it is ``small``, else by a shuffle that adaptive execution can split where a key is hot."""
    return fact.join(F.broadcast(dim) if small(dim, max_rows) else dim, on, how)
