import hashlib
import random

import pytest
import xxhash

from quorumlake.llm import fingerprints as P


def brute_simhash(text):
    votes = [0] * 64
    for t in (text or "").lower().split():
        w, h = min(len(t), 12) ** 2, xxhash.xxh64_intdigest(t.encode(), 42)
        for b in range(64):
            votes[b] += w if h >> b & 1 else -w
    return sum(1 << b for b in range(64) if votes[b] > 0)


def brute(rows):
    rows = sorted((i, t or "") for i, t in rows if i is not None)
    out = []
    for k, (i, t) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)][1]
        h = len(t) // 2
        edited = t[: len(t) - h] + nxt[:h]
        f, g, n = brute_simhash(t), brute_simhash(edited), brute_simhash(nxt)
        like = lambda a, b: 1 - bin(a ^ b).count("1") / 64
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), f, g, like(f, g), like(f, n)))
    return out


def texts(n, seed=1):
    r = random.Random(seed)
    words = ["the", "Ünder", "grey", "x", "lorem", "ipsum", "dolor", "中文", "a1", "b\tc"]
    return [None if r.random() < 0.05 else "" if r.random() < 0.05 else " ".join(r.choices(words, k=r.randint(1, 60))) + r.choice(["", "\n", "  "]) for _ in range(n)]


@pytest.mark.parametrize("ids", [[0], list(range(1100)), [i * i * i for i in range(1100)], [7, 7, 3, -5]])
def test_against_brute_force(spark, ids):
    t = texts(len(ids))
    rows = list(zip(ids, t))
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame([(i, x, "clash") for i, x in rows], "doc_id long, text string, fingerprint string")
    got = P.edited_fingerprints(df).collect()
    u = lambda x: x & (2**64 - 1)
    mine = sorted((r.doc_id, r.n_chars, r.edited_sha256, u(r.fingerprint), u(r.edited_fingerprint), r.near_edited, r.near_next) for r in got)
    assert mine == sorted(brute(rows))


def test_null_ids_and_empty(spark):
    df = spark.createDataFrame([(None, "ab cd"), (1, "x")], "doc_id long, text string")
    got = {r.doc_id: r for r in P.edited_fingerprints(df).collect()}
    assert got[None].edited_sha256 == hashlib.sha256(b"ab ").hexdigest() and got[None].n_chars == 5
    assert P.edited_fingerprints(df.limit(0)).count() == 0


def test_within_radius(spark):
    r = random.Random(4)
    base = [r.getrandbits(64) for _ in range(30)]
    fps = base + [b ^ sum(1 << k for k in r.sample(range(64), r.randint(0, 5))) for b in base for _ in range(10)]
    signed = [f - 2**64 if f >> 63 else f for f in fps]
    t = spark.createDataFrame([(f,) for f in signed] + [(None,)], "fingerprint long")
    q = spark.createDataFrame([(f,) for f in signed[:15]], "fingerprint long")
    got = sorted((x.query, x.found, x.distance) for x in P.within_radius(q, t, 3).collect())
    d = lambda a, b: bin((a ^ b) & (2**64 - 1)).count("1")
    assert got == sorted((a, b, d(a, b)) for a in set(signed[:15]) for b in set(signed) if d(a, b) <= 3)
    masks = P.block_masks(3, 5)
    assert len(set(masks)) == 10 and all(25 <= bin(m).count("1") <= 26 for m in masks)


def test_native_plan(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    plan = P.edited_fingerprints(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_pieces_and_long_texts(spark, monkeypatch):
    """A text of many pieces has the fingerprint of the whole."""
    long = " ".join(f"word{i % 997}" for i in range(200_000))
    monkeypatch.setattr(P, "PIECE", 3)
    rows = [(1, long), (2, "a b c d e f g h i j k l"), (3, None), (4, "")]
    got = {r.k: r.fingerprint & (2**64 - 1) for r in P.simhash(spark.createDataFrame(rows, "k long, text string"), ["k"]).collect()}
    assert got == {k: brute_simhash(t) for k, t in rows}
