"""Vector columns: which rows take part, and what both vector operators need in tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quantised(df: DataFrame, vector: str, keep: list[Column], scale: float, shift: int = 0) -> DataFrame:
    """``keep`` and ``x``, long entries floor(scale * entry) + shift, of the rows that take part.

    Rows do not if their vector is null, empty, has a null or non-finite entry or another length than most vectors (of equally common
    lengths the longest counts), or if the squares of their entries add up to 2^62 or more, which no long score could hold.
    """
    v = F.transform(vector, lambda c: c.cast("double") * scale)
    odd = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    size = F.aggregate(v, F.lit(0.0), lambda s, c: s + c * c)
    rows = df.select(*keep, v.alias("_v"), size.alias("_s"), odd.alias("_odd")).where("_v is not null and size(_v) > 0 and not _odd and _s < 4.6e18")
    common = rows.groupBy(F.size("_v").alias("n")).agg(F.count("*").alias("k")).orderBy(F.desc("k"), F.desc("n")).first()
    rows = rows.where(F.size("_v") == (common.n if common else 0))
    return rows.drop("_s", "_odd").withColumn("x", F.transform("_v", lambda c: F.floor(c).cast("long") + F.lit(shift).cast("long"))).drop("_v")


def matrix(column: pa.Array, kind: type = np.int64) -> np.ndarray:
    """Rows of a list column whose lists have one length."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(len(column), -1)


def lists(rows: np.ndarray) -> pa.Array:
    """The reverse of ``matrix``."""
    n, d = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, n * d + 1, d, dtype=np.int32)), pa.array(np.ascontiguousarray(rows).reshape(-1)))
