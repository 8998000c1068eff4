import math
from fractions import Fraction

import numpy as np
import pytest

from quorumlake.llm import whitening
from quorumlake.llm.queries import QUERIES


def check(out, vectors, most):
    """``out``: rows of the operator; ``vectors``: (id, entries as whole numbers) of the rows that take part."""
    x = np.array([v for _, v in vectors], float)
    n, y = len(x), x - np.array([float(Fraction(sum(int(v[j]) for _, v in vectors), len(x))) for j in range(x.shape[1])])
    e, v = np.linalg.eigh(y.T @ y / n)
    e, v = e[::-1], v[:, ::-1]
    k = min(most, int((e > 1e-9).sum()))
    sums = [sum(int(r[j]) for _, r in vectors) for j in range(x.shape[1])]
    by = {}
    for r in out:
        by.setdefault(r[0], {})[r[1]] = r
    assert sorted(by, key=repr) == sorted((i for i, _ in vectors), key=repr) and all(sorted(c) == list(range(1, k + 1)) for c in by.values())
    w = np.array([[by[i][c + 1][4] for c in range(k)] for i, _ in vectors])
    for (i, vec), mine in zip(vectors, y):
        r = by[i][1]
        assert r[2] == n and int(r[3]) == sum((n * int(a) - s) ** 2 for a, s in zip(vec, sums))
        want = mine @ v[:, :k] / np.sqrt(e[:k])
        assert np.allclose(np.abs(w[[j for j, (b, _) in enumerate(vectors) if b == i][0]]), np.abs(want), atol=1e-6)
    assert all(math.isclose(r[5], e[r[1] - 1] / e.sum(), rel_tol=1e-6) for r in out)
    errors = {r[6] for r in out}
    assert len(errors) == 1 and errors.pop() < 1e-9
    assert np.abs(w.T @ w / n - np.eye(k)).max() < 1e-8


def whole(v, scale=64, shift=1_000_000):
    return [math.floor(scale * float(np.float32(c))) + shift for c in v]


@pytest.mark.parametrize("parts", [1, 20])
def test_rows(spark, monkeypatch, parts):
    """Odd rows take no part; small variances keep their precision; partitions and levels of the tree do not matter."""
    monkeypatch.setattr(whitening, "ROWS", 7)
    rng = np.random.default_rng(5)
    turn = np.linalg.qr(rng.normal(size=(6, 6)))[0]
    good = [(i, ((rng.normal(size=6) * [900, 300, 90, 30, 9, 3]) @ turn).astype(np.float32).tolist()) for i in range(90)]
    odd = [(900, None), (901, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (902, [math.nan] * 6), (903, [math.inf] * 6), (904, []), (905, [1.0])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in good + odd], "vec_id long, embedding array<float>, x string, n int").repartition(parts)
    check(whitening.whiten(df, 4).collect(), [(i, whole(v)) for i, v in good], 4)


def test_constant_directions_are_no_components(spark):
    rows = [(i, [float(i % 3), float(i % 5), 7.0, float(i % 3)]) for i in range(40)]
    out = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    check(out, [(i, whole(v)) for i, v in rows], 2)


def test_no_components(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (1, [1.0, 2.0])], "vec_id long, embedding array<double>")
    assert whitening.whiten(df).count() == whitening.whiten(df.limit(1)).count() == whitening.whiten(df.limit(0)).count() == 0


def test_sums_beyond_64_bits(spark):
    rows = [(i, [float((i * 7919) % 100 * 10**6), float(i)]) for i in range(64)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = whitening.whiten(df, scale=8.0, shift=10**8).collect()
    x = [[math.floor(8 * c) + 10**8 for c in v] for _, v in rows]
    sums = [sum(c) for c in zip(*x)]
    want = {i: sum((64 * a - s) ** 2 for a, s in zip(v, sums)) for (i, _), v in zip(rows, x)}
    assert {r.vec_id: int(r.deviation) for r in out} == want and max(want.values()) > 1 << 63


def test_query_on_its_table(spark):
    sf = "/root/testdata/sf0.001"
    out = QUERIES["op13_embedding_whitening"](spark, sf)
    assert dict(out.dtypes)["deviation"] == "bigint"
    check(out.collect(), [(r.vec_id, whole(r.embedding)) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()], 32)
