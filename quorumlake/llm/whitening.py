"""Embedding whitening by TSQR.

Entries are whole numbers, so the sums S are exact; rows are centred as (n x - S) / n, the dividend exact. Each partition keeps one
triangular factor: what it has so far is stacked with the next rows and factored again. The factors are merged eight at a
time up a tree; the right singular vectors of the last one are the components and its singular values give their
variances. No covariance is formed, so small variances keep their precision. One d x d matrix reaches the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quorumlake.llm.vectors import matrix, quantised
from quorumlake.plans.staging import Scope, Stage

#: Factors that a node of the tree merges, and rows factored at once.
FAN, ROWS = 8, 4096
#: Variances below this part of the largest are rounding errors of a constant direction, which cannot be whitened.
NOTHING = 1e-24


def tree(parts: DataFrame, merge: Callable[[list[np.ndarray]], np.ndarray]) -> np.ndarray | None:
    """``parts`` (part long, m array<double>) merged ``FAN`` at a time until one is left, in the order of their numbers; None if there is none."""
    def node(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        ms = [np.asarray(m, float) for m in group.sort_values("part")["m"]]
        return pd.DataFrame({"part": [int(key[0])], "m": [merge(ms)]})

    left = parts.count()
    numbers = Window.orderBy("part")  # a row a partition: one task can hold them
    parts = parts.withColumn("part", F.row_number().over(numbers).cast("long") - 1)
    while left > 1:
        parts = parts.groupBy(F.floor(F.col("part") / FAN).alias("_up")).applyInPandas(node, "part long, m array<double>")
        left = -(-left // FAN)
    rows = parts.collect()  # one row
    return np.asarray(rows[0].m, float) if rows else None


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, exact: as 64-bit integers where they fit, else as Python's."""
    top = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums))
    kind = np.int64 if top < 1 << 62 else object
    return x.astype(kind) * n - np.array(sums, kind)


def _per_partition(rows: DataFrame, start: Callable[[], np.ndarray], step: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """(part, m): what ``step`` makes of all rows of a partition, some ``ROWS`` at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, held, part = start(), [], None
        for b in batches:
            if not b.num_rows:
                continue
            part = b.column("part")[0].as_py()
            held.append(matrix(b.column("x")))
            if sum(map(len, held)) >= ROWS:
                state, held = step(state, np.vstack(held)), []
        if held:
            state = step(state, np.vstack(held))
        if part is not None:
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([state.reshape(-1)], pa.list_(pa.float64()))], ["part", "m"])

    return rows.select(F.spark_partition_id().cast("long").alias("part"), "x").mapInArrow(run, "part long, m array<double>")


def _exact_sums(rows: DataFrame, d: int) -> tuple[int, list[int]]:
    """Rows, and each dimension's sum: exact within a batch, added up as decimals."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = matrix(b.column("x"))
                s = x.sum(0) if int(np.abs(x).max()) * len(x) < 1 << 62 else x.astype(object).sum(0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([len(x)] * d, pa.int64()), pa.array(range(d), pa.int32()), pa.array([str(int(v)) for v in s])], ["n", "dim", "s"]
                )

    sums = rows.select("x").mapInArrow(run, "n long, dim int, s string").groupBy("dim")
    got = sums.agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).orderBy("dim").collect()  # a row a dimension
    return got[0].n, [int(r.s) for r in got]


def fit(rows: DataFrame, stage: Stage) -> dict | None:
    """Components of staged ``rows`` (x array<long>): n, sums, vectors (a column each), variances, their total. None without rows."""
    first = rows.select(F.size("x").alias("d")).first()
    if first is None:
        return None
    d = first.d
    n, sums = _exact_sums(rows, d)

    def triangle(r: np.ndarray, x: np.ndarray) -> np.ndarray:
        return np.linalg.qr(np.vstack([r, _centred(x, n, sums).astype(float) / n]), "r")

    def merged(rs: list[np.ndarray]) -> np.ndarray:
        return np.linalg.qr(np.vstack([r.reshape(-1, d) for r in rs]), "r").reshape(-1)

    factors = stage.put(_per_partition(rows, lambda: np.zeros((d, d)), triangle), "factors")
    r = tree(factors, merged).reshape(-1, d)
    _, s, vt = np.linalg.svd(r)
    s = np.r_[s, np.zeros(d - len(s))]
    return {"n": n, "sums": sums, "vectors": vt.T, "variances": s * s / n, "total": float((s * s).sum() / n)}


def identity_error(rows: DataFrame, stage: Stage, model: dict, k: int) -> float:
    """Largest entry of the whitened rows' covariance minus the identity: means and centred products of partitions, merged pairwise."""
    def whole(state: np.ndarray, x: np.ndarray) -> np.ndarray:
        w = project(x, model, k)
        mean = w.mean(0)
        return pooled([state, np.r_[len(w), mean, ((w - mean).T @ (w - mean)).reshape(-1)]])

    def pooled(parts: list[np.ndarray]) -> np.ndarray:
        out = parts[0]
        for p in parts[1:]:
            a, b = out[0], p[0]
            gap = p[1 : k + 1] - out[1 : k + 1]
            n = a + b
            out = np.r_[n, out[1 : k + 1] + gap * (b / max(n, 1)), out[k + 1 :] + p[k + 1 :] + (np.outer(gap, gap) * (a * b / max(n, 1))).reshape(-1)]
        return out

    parts = stage.put(_per_partition(rows, lambda: np.zeros(1 + k + k * k), whole), "moments")
    total = tree(parts, pooled)
    return float(np.abs(total[k + 1 :].reshape(k, k) / total[0] - np.eye(k)).max()) if k else 0.0


def project(x: np.ndarray, model: dict, k: int) -> np.ndarray:
    """Whitened rows, ``k`` columns."""
    y = _centred(x, model["n"], model["sums"]).astype(float) / model["n"]
    return y @ model["vectors"][:, :k] / np.sqrt(model["variances"][:k])


def whiten(df: DataFrame, components: int = 32, id_col: str = "vec_id", vector: str = "embedding", scale: float = 64, shift: int = 1_000_000) -> DataFrame:
    """``(id, component, n, deviation, whitened, explained, identity_error)``: a row for each vector and component.

    Entries are quantised to floor(scale * entry) + shift; ``deviation`` is exact, a decimal. Components are numbered by falling variance; constant
    directions (variance at most ``NOTHING`` of the largest) are no components, so there may be fewer than ``components``.
    Defined cases: vectors that ``quantised`` leaves out take no part; equal rows, and rows that repeat an id or have none, are rows of their own; a
    table of equal vectors, of one vector or of none gives an empty result; other columns are ignored.
    """
    spark = df.sparkSession
    kind = df.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    with Scope(spark) as made:
        stage = Stage(spark, "whitening")
        rows = stage.put(quantised(df, vector, [F.col(id_col).alias("id")], scale, shift), "rows")
        model = fit(rows, stage)
        e = model["variances"] if model else np.zeros(0)
        k = min(components, int((e > NOTHING * max(1.0, e.max(initial=0)) + 0).sum())) if model else 0
        if not k:
            return spark.createDataFrame([], schema)
        made.keep(rows)
        error = identity_error(rows, stage, model, k)
    held = spark.sparkContext.broadcast(model)  # d x d numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        explained = m["variances"][:k] / m["total"]
        for b in batches:
            if not b.num_rows:
                continue
            x = matrix(b.column("x"))
            c, far = _centred(x, m["n"], m["sums"]), project(x, m, k)
            if c.dtype != object and int(np.abs(c).max()) ** 2 * c.shape[1] >= 1 << 62:
                c = c.astype(object)
            dev = pa.array([str(int(v)) for v in (c * c).sum(1)]).cast(pa.decimal128(38, 0))
            each = pa.array(np.repeat(np.arange(len(x)), k))
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("id").take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(len(x) * k, m["n"])), dev.take(each),
                    pa.array(far.reshape(-1)), pa.array(np.tile(explained, len(x))), pa.array(np.full(len(x) * k, error)),
                ],
                [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(run, schema)
