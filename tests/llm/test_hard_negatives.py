import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quorumlake.llm import hard_negatives
from quorumlake.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, score string, x int"


def usable(v):
    return bool(v) and all(c is not None and math.isfinite(c) for c in v)


def brute(rows, positives=5, negatives=10):
    x = {n: [math.floor(256 * float(np.float32(c))) for c in v] for n, (_, v, label) in enumerate(rows) if label is not None and usable(v)}
    out = []
    for n in x:
        i, _, label = rows[n]
        if i is None or i % 100:
            continue
        score = {m: sum(a * b for a, b in zip(x[n], x[m])) for m in x if m != n}
        order = sorted(score, key=lambda m: (-score[m], rows[m][0] is None, rows[m][0] or 0, m))
        for p in [m for m in order if rows[m][2] == label][:positives]:
            fit = [m for m in order if rows[m][2] != label and 30 * score[p] <= 100 * score[m] <= 90 * score[p]]
            out += [(i, rows[p][0], r, rows[m][0], score[p], score[m]) for r, m in enumerate(fit[:negatives], 1)]
    return sorted(out, key=repr)


def some(n, seed, spread=0.25):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, 8))
    rows = []
    for i in range(n):
        c = int(rng.integers(6))
        rows.append((i * 10, (centres[c] + spread * rng.normal(size=8)).astype(np.float32).tolist(), int(rng.integers(4))))
    return rows


ODD = [
    (100, None, 1), (200, [1.0] * 8, None), (300, [float("nan")] + [0.0] * 7, 1), (400, [None] + [0.0] * 7, 1), (500, [], 1), (600, [float("inf")] + [0.0] * 7, 1),
    (None, [0.5] * 8, 1), (None, [0.5] * 8, 2), (700, [0.5] * 8, 1), (700, [0.5] * 8, 1), (701, [0.5] * 8, 2), (702, [0.5] * 8, 2), (800, [0.0] * 8, 3), (801, [0.0] * 8, 3), (802, [0.0] * 8, 0),
]


@pytest.mark.parametrize("how", [{}, {"chunk": 7, "pivots": 3, "sample": 5}, {"pivots": 1, "sample": 1}])
def test_equal_to_all_scores(spark, monkeypatch, how):
    """Odd rows, ties, repeated ids, several chunks; with few pivots as with many."""
    monkeypatch.setattr(hard_negatives, "AT_ONCE", 5)
    rows = some(300, 1) + ODD
    df = spark.createDataFrame([(*r, "s", 1) for r in rows], SCHEMA).repartition(3)
    got = hard_negatives.mine(df, F.col("vec_id") % 100 == 0, **how).drop("anchor_row", "positive_rank")
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def test_few_and_none(spark):
    df = spark.createDataFrame([(*r, "s", 1) for r in ODD[:6]], SCHEMA)
    assert hard_negatives.mine(df, F.col("vec_id") % 100 == 0).count() == 0
    assert hard_negatives.mine(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_brackets_hold_and_leave_most_rows_out():
    """Every score lies in its bracket; on clustered rows few brackets reach into an anchor's list."""
    x = np.array([[math.floor(256 * c) for c in v] for _, v, _ in some(2000, 2, 0.03)])
    m2 = int((x * x).sum(1).max())
    bare = hard_negatives.Space(m2, x[:1])
    space = hard_negatives.Space(m2, x[hard_negatives._maximin(x, bare.height(x), 8)])
    far, q = space.far(x, space.height(x)), x[:50]
    qf, q2, score = space.far(q, np.zeros(50)), (q * q).sum(1).astype(float), q @ x.T
    gap = np.abs(qf[:, None] - far[None]).max(2)
    low, up = space.bracket(q2[:, None], gap, (qf[:, None] + far[None]).min(2))
    assert (low <= score).all() and (score <= up).all()
    tenth = np.sort(score, 1)[:, -10]
    assert (up >= tenth[:, None]).mean() < 0.5


def test_large_entries_are_exact(spark):
    """Norms beyond 2^52 are multiplied as integers."""
    rng = np.random.default_rng(3)
    rows = [(i * 50, [float(v) for v in rng.integers(-(10**5), 10**5, 8)], int(i % 2)) for i in range(60)]
    df = spark.createDataFrame([(*r, "s", 1) for r in rows], SCHEMA)
    got = hard_negatives.mine(df, F.col("vec_id") % 100 == 0).drop("anchor_row", "positive_rank")
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def test_query_on_its_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.vec_id, list(r.embedding), (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert sorted(map(tuple, QUERIES["op12_hard_negatives"](spark, sf).collect()), key=repr) == brute(rows)
