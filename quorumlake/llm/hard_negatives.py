"""Hard negatives by a pivot table.

With M the largest norm, a row x becomes (x, sqrt(M² - |x|²)) and an anchor q becomes (q, 0): then |q' - x'|² = |q|² + M² - 2 qx, so
the nearest rows have the highest scores. The pivot table stores each row's distances to a few pivots; with an anchor's own
distances the triangle inequality brackets |q' - x'|, hence the score, from both sides, for a whole block of rows
(by the least and largest of its stored distances) and then for each row. Only rows whose bracket can still enter an
anchor's list are scored, exactly, in integers.

Scale: the table is laid out by nearest pivot and distance, so blocks are narrow. The anchors are a stated query set that grows with the
table: they go to all rows in chunks of a bounded size, one job a chunk for positives and one for negatives; no row is shuffled for
it, and no group by label is ever formed. A task returns at most k rows an anchor and list; a window merges them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quorumlake.llm.vectors import lists, matrix, quantised
from quorumlake.plans.staging import Scope, Stage

#: Rows from which pivots are chosen and first bounds are taken; neither changes a result.
SAMPLE = 2000
PIVOTS = 16
#: Anchors that are sent to the tasks at once, and anchors compared at once within a task.
CHUNK, AT_ONCE = 8192, 256
EXACT = 1 << 52


class Space:
    """Rows and anchors as points whose distances tell scores; ``m2`` is the largest squared norm."""

    def __init__(self, m2: int, pivots: np.ndarray):
        self.m2, self.slack = float(m2), 2.0 + 1e-9 * m2
        self.kind = np.float64 if m2 < EXACT else np.int64  # sums of products below 2^52 are exact in doubles, whatever their order
        self.pivots = np.hstack([pivots.astype(np.float64), self.height(pivots)[:, None]])

    def height(self, x: np.ndarray) -> np.ndarray:
        x = x.astype(np.float64)
        return np.sqrt(np.maximum(self.m2 - (x * x).sum(1), 0))

    def far(self, x: np.ndarray, height: np.ndarray) -> np.ndarray:
        """Distances of points to all pivots."""
        p = np.hstack([x.astype(np.float64), height[:, None]])
        return np.sqrt(np.maximum(((p[:, None, :] - self.pivots[None]) ** 2).sum(2), 0))

    def bracket(self, q2: np.ndarray, near: np.ndarray, far: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest score at distances between ``near`` and ``far``, rounding errors included."""
        top = q2 + self.m2
        return (top - far * far) / 2 - self.slack, (top - near * near) / 2 + self.slack


def _numbers(ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids as numbers and whether they are missing."""
    return ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False)


class Best:
    """The k best rows of each list: by score, then id (missing ids last), then row."""

    COLUMNS = ("list", "score", "none", "id", "row")

    def __init__(self, n: int, k: int, least: np.ndarray):
        self.k, self.rows, self.least = k, {c: np.zeros(0, np.bool_ if c == "none" else np.int64) for c in self.COLUMNS}, least.astype(np.float64)

    def add(self, **found: np.ndarray) -> None:
        if not len(found["list"]):
            return
        r = {c: np.concatenate([self.rows[c], found[c]]) for c in self.COLUMNS}
        order = np.lexsort((r["row"], r["id"], r["none"], -r["score"], r["list"]))
        at = r["list"][order]
        begins = np.r_[True, at[1:] != at[:-1]]
        rank = np.arange(len(at)) - np.maximum.accumulate(np.where(begins, np.arange(len(at)), 0))
        full = rank == self.k - 1
        order_kept = order[rank < self.k]
        self.least[at[full]] = np.maximum(self.least[at[full]], r["score"][order][full])
        self.rows = {c: v[order_kept] for c, v in r.items()}


def _search(space: Space, q: dict, k: int, same: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of the pivot table that are among a task's k best of a list.

    ``q`` holds anchors (x, q2, far, label, row) and their lists: list j of anchor i is i * w + j, its scores lie from low[i, j] to high[i, j].
    """
    n, w = q["low"].shape
    best = Best(n * w, k, q["low"].reshape(-1))
    high = q["high"].astype(np.float64)
    for b in batches:
        x, far = matrix(b.column("x"), space.kind), matrix(b.column("far"), np.float64)
        label, row = b.column("label").to_numpy(zero_copy_only=False), b.column("row").to_numpy()
        ids, none = _numbers(b.column("id"))
        least_far, most_far = far.min(0), far.max(0)
        for at in range(0, n, AT_ONCE):
            part = slice(at, min(n, at + AT_ONCE))
            need = best.least.reshape(n, w)[part]
            qf, q2 = q["far"][part], q["q2"][part]
            # the whole block first
            low, up = space.bracket(q2, np.maximum(np.maximum(qf - most_far, least_far - qf), 0).max(1), (qf + most_far).min(1))
            open_ = np.flatnonzero(((up[:, None] >= need) & (low[:, None] <= high[part]) & (need <= high[part])).any(1))
            if not len(open_):
                continue
            near, most = np.zeros((len(open_), len(x))), np.full((len(open_), len(x)), np.inf)
            for p in range(far.shape[1]):
                a, c = qf[open_, p][:, None], far[:, p][None]
                np.maximum(near, np.abs(a - c), out=near)
                np.minimum(most, a + c, out=most)
            low, up = space.bracket(q2[open_][:, None], near, most)
            left = np.zeros(near.shape, bool)
            for j in range(w):
                left |= (up >= need[open_, j][:, None]) & (low <= high[part][open_, j][:, None])
            left &= (q["label"][part][open_][:, None] == label[None]) == same
            left &= q["row"][part][open_][:, None] != row[None]
            i, r = np.nonzero(left)
            if not len(i):
                continue
            if len(i) * 8 > left.size:
                score = (q["x"][part][open_] @ x.T)[i, r]
            else:
                score = np.einsum("ij,ij->i", q["x"][part][open_][i], x[r])
            anchor = at + open_[i]
            for j in range(w):
                lists_ = anchor * w + j
                ok = (score >= best.least[lists_]) & (score <= high[anchor, j])
                best.add(list=lists_[ok], score=score[ok].astype(np.int64), none=none[r[ok]], id=ids[r[ok]], row=row[r[ok]])
    f = best.rows
    if len(f["list"]):
        yield pa.RecordBatch.from_arrays(
            [pa.array(q["row"][f["list"] // w]), pa.array((f["list"] % w).astype(np.int32)), pa.array(f["score"]), pa.array(f["id"], mask=f["none"]), pa.array(f["row"])],
            ["anchor", "slot", "score", "id", "row"],
        )


def _maximin(x: np.ndarray, heights: np.ndarray, k: int) -> np.ndarray:
    """Numbers of k points, each the farthest from those before."""
    p = np.hstack([x.astype(np.float64), heights[:, None]])
    at = [0]
    d = ((p - p[0]) ** 2).sum(1)
    while len(at) < k and d.max() > 0:
        at.append(int(d.argmax()))
        d = np.minimum(d, ((p - p[at[-1]]) ** 2).sum(1))
    return np.array(at)


def pivot_table(rows: DataFrame, space: Space) -> DataFrame:
    """Rows with ``far``, their distances to the pivots, laid out by nearest pivot, distance to it and row (so equal vectors spread)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = matrix(b.column("x"))
            far = space.far(x, space.height(x))
            own = [pa.array(far.argmin(1).astype(np.int32)), pa.array(far.min(1)), lists(far)]
            yield pa.RecordBatch.from_arrays([*b.columns, *own], [*b.schema.names, "pivot", "own", "far"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    table = rows.mapInArrow(run, f"{kinds}, pivot int, own double, far array<double>")
    return table.repartitionByRange("pivot", "own", "row").sortWithinPartitions("pivot", "own", "row").drop("pivot", "own")


def _first_bounds(q: dict, sample: dict, k: int, kind: type) -> np.ndarray:
    """The k-th best score of an anchor's label in the sample: its true k-th best is no lower."""
    out = np.full(len(q["row"]), -np.inf)
    for at in range(0, len(out), AT_ONCE):
        part = slice(at, at + AT_ONCE)
        score = (q["x"][part].astype(kind) @ sample["x"].astype(kind).T).astype(np.float64)
        ok = (q["label"][part][:, None] == sample["label"][None]) & (q["row"][part][:, None] != sample["row"][None])
        score = np.where(ok, score, -np.inf)
        if score.shape[1] >= k:
            out[part] = np.partition(score, -k, 1)[:, -k]
    return out


def mine(
    df: DataFrame, anchors: Column, id_col: str = "vec_id", vector: str = "embedding", label: str = "label", positives: int = 5, negatives: int = 10,
    low: int = 30, high: int = 90, scale: float = 256, pivots: int = PIVOTS, sample: int = SAMPLE, chunk: int = CHUNK,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score, anchor_row, positive_rank)``.

    Rows of ``df`` where ``anchors`` holds are anchors. A score is the inner product of vectors quantised to floor(scale * entry); higher come
    first, ties by smaller id (null last), then by row. An anchor's positives are its first ``positives`` other rows of the same label; for each of them
    come the first ``negatives`` rows of another label with low * positive score <= 100 * score <= high * positive score.
    Ids are whole numbers, labels of any type that can be compared. Defined cases: rows with a null label or anchor condition or a vector
    that ``quantised`` leaves out take no part (a null condition: as no anchor); rows that repeat an id are rows of their own, each of them an anchor or a
    partner; fewer partners give fewer rows, none gives none; an empty table gives an empty result; other columns are ignored.
    """
    spark = df.sparkSession
    with Scope(spark) as made:
        stage = Stage(spark, "negatives")
        keep = [F.col(id_col).cast("long").alias("id"), F.col(label).alias("label"), F.coalesce(anchors, F.lit(False)).alias("anchor")]
        rows = quantised(df.where(F.col(label).isNotNull()), vector, keep, scale).withColumn("row", F.monotonically_increasing_id())
        rows = stage.put(rows, "rows")
        norm2 = F.aggregate("x", F.lit(0).cast("long"), lambda s, c: s + c * c)
        m2 = rows.agg(F.max(norm2)).first()[0]
        some = rows.select("x", "label", "row").orderBy(F.xxhash64("row"), "row").limit(sample).toArrow().combine_chunks()
        out = None
        if m2 is not None:
            some = {"x": matrix(some.column("x").combine_chunks()), "label": some.column("label").to_numpy(), "row": some.column("row").to_numpy()}
            bare = Space(m2, some["x"][:1])
            space = Space(m2, some["x"][_maximin(some["x"], bare.height(some["x"]), pivots)])
            table = stage.put(pivot_table(rows.select("id", "label", "row", "x"), space), "pivots")
            asked = rows.where("anchor").select("id", "label", "row", "x")
            parts = -(-asked.count() // chunk)
            for i in range(parts):
                mine_ = asked.where(F.pmod(F.xxhash64("row"), F.lit(parts)) == i) if parts > 1 else asked
                found = _one_chunk(stage, space, table, mine_, some, positives, negatives, low, high)
                if found is not None:
                    made.keep(found)
                    out = found if out is None else out.unionByName(found)
        if out is None:
            out = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long, anchor_row long, positive_rank int")
        return out


def _one_chunk(stage: Stage, space: Space, table: DataFrame, asked: DataFrame, some: dict, positives: int, negatives: int, low: int, high: int) -> DataFrame | None:
    """The result for a bounded number of anchors: their positives, then the negatives between their bounds."""
    got = asked.toArrow().combine_chunks()  # ``CHUNK`` vectors, about
    if not got.num_rows:
        return None
    x = matrix(got.column("x").combine_chunks())
    q = {"x": x.astype(space.kind), "q2": (x.astype(np.float64) ** 2).sum(1), "far": space.far(x, np.zeros(len(x))), "label": got.column("label").to_numpy(), "row": got.column("row").to_numpy()}
    q["low"] = _first_bounds(q, some, positives, space.kind)[:, None]
    q["high"] = np.full((len(x), 1), np.inf)
    best = stage.put(_merged(_sent(table, space, q, positives, True), positives), "positives")
    at = {r: i for i, r in enumerate(q["row"].tolist())}
    lows, highs = np.full((len(x), positives), np.inf), np.full((len(x), positives), -np.inf)
    for r in best.select("anchor", "rank", "score").toArrow().to_pylist():  # ``positives`` an anchor of the chunk
        lows[at[r["anchor"]], r["rank"] - 1], highs[at[r["anchor"]], r["rank"] - 1] = -(-low * r["score"] // 100), high * r["score"] // 100
    q |= {"low": lows, "high": highs}
    worst = _merged(_sent(table, space, q, negatives, False), negatives)
    p = best.select("anchor", F.col("rank").alias("positive_rank"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    n = worst.select("anchor", (F.col("slot") + 1).alias("positive_rank"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = asked.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    out = n.join(p, ["anchor", "positive_rank"]).join(named, "anchor").withColumnRenamed("anchor", "anchor_row")
    return stage.put(out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score", "anchor_row", "positive_rank"), "found")


def _sent(table: DataFrame, space: Space, q: dict, k: int, same: bool) -> DataFrame:
    held = table.sparkSession.sparkContext.broadcast((space, q))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _search(*held.value, k, same, batches)

    return table.mapInArrow(run, "anchor long, slot int, score long, id long, row long")


def _merged(found: DataFrame, k: int) -> DataFrame:
    """The k best of what the tasks found for each list."""
    w = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
