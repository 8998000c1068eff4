import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest

from quorumlake.llm import importance as I
from quorumlake.llm import textbytes

GOOD, BAD = [f"good{i}" for i in range(80)], [f"bad{i}" for i in range(80)]


def tables(spark, n=600):
    r = random.Random(1)
    rows = [(i, " ".join(r.choices(GOOD if i % 3 else BAD, k=30) + r.choices(["the", "of"], k=10)), "x") for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(0, n // 2)], "doc_id long, quality int")
    return docs, labels


def test_held_out_separation_and_count(spark):
    docs, labels = tables(spark)
    got = I.resample(docs, labels).collect()
    assert sum(r.keep for r in got) == round(600 * (labels.where("quality = 1").count() / 300))
    held = [r for r in got if r.doc_id >= 300]
    assert np.mean([r.keep == bool(r.doc_id % 3) for r in held]) > 0.97
    ranks = sorted(got, key=lambda r: r.rank)
    assert [r.rank for r in ranks] == list(range(1, 601)) and all(a.key >= b.key for a, b in zip(ranks, ranks[1:]))


def test_ngrams_against_brute_force():
    texts = ["A b a", "", "one", "x\ty\nz x", None and "", "é b"]
    data = "".join(texts[:4]) + texts[5]
    parts = [t.encode() for t in [*texts[:4], texts[5]]]
    offsets = np.cumsum([0, *map(len, parts)])
    codes, at = textbytes.word_ngrams(np.frombuffer(b"".join(parts), np.uint8), offsets, 16)
    by = [codes[(at >= a) & (at < b)].tolist() for a, b in zip(offsets, offsets[1:])]
    assert [len(x) for x in by] == [5, 0, 1, 7, 3] and data
    assert by[0].count(max(set(by[0]), key=by[0].count)) == 2  # A and a are one word
    alone = [textbytes.word_ngrams(np.frombuffer(p, np.uint8), np.array([0, len(p)]), 16)[0].tolist() for p in parts]
    assert [sorted(x) for x in alone] == [sorted(x) for x in by]


def test_gumbel_is_stable_and_standard():
    g = I.gumbel(np.arange(20000), "s")
    assert (g == I.gumbel(np.arange(20000), "s")).all()
    assert abs(g.mean() - 0.5772) < 0.03 and abs(g.std() - np.pi / np.sqrt(6)) < 0.03


@pytest.mark.parametrize("n", [0, 3])
def test_edges(spark, n):
    rows = [(1, None, "x"), (2, "", "x"), (None, "a b", "x")][:n]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    got = I.resample(docs, labels).collect()
    assert len(got) == n and all(r.keep and r.log_weight == 0 for r in got)


def codes_of(text):
    """Hashed words and pairs by the formula, a word at a time."""
    full, base = 2**64 - 1, 0x9E3779B97F4A7C15
    words = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()).split()
    h = []
    for w in words:
        x = sum((b + 1) * pow(base, i, 2**64) for i, b in enumerate(w)) & full
        h.append(x ^ x >> 29)
    h += [(a * 0xD6E8FEB86659FD93 + b) & full for a, b in zip(h, h[1:])]
    return [(x * 0xFF51AFD7ED558CCD & full) >> 48 for x in h]


def brute(docs, good, share, smooth=1.0):
    """(id, weight, key) by rank, from counts of dictionaries."""
    raw, target, n = Counter(), Counter(), 1 << 16
    for i, t in docs:
        raw.update(codes_of(t))
        if i in good:
            target.update(codes_of(t))
    all_raw, all_target = sum(raw.values()) + smooth * n, sum(target.values()) + smooth * n
    out = []
    for i, t in docs:
        w = 0.0
        for c in codes_of(t):
            p = (raw[c] + smooth) / all_raw
            w += float(np.float32(math.log((target[c] + smooth * p * n) / all_target / p)))
        u = int.from_bytes(hashlib.blake2b(f"resample-1:{-1 if i is None else i}".encode(), digest_size=8).digest(), "little")
        out.append((i, w, w - math.log(-math.log((u + 0.5) / 2.0**64))))
    out.sort(key=lambda x: (-x[2], x[0] is None, x[0] or 0))
    return out, round(share * len(docs))


def test_whole_resampling_against_brute_force(spark):
    """Keys, ranks and the cut over texts with nulls, repeats and a very long one, beside clashing columns."""
    r = random.Random(9)
    docs = [(i, " ".join(r.choices(GOOD + BAD if i % 2 else GOOD, k=r.randint(0, 30)))) for i in range(150)]
    docs += [(None, "good1 bad1"), (200, None), (201, ""), (7, "good2 good3"), (202, " ".join(r.choices(BAD, k=20_000)))]
    labels = [(i, int(i % 2 == 0)) for i in range(0, 150, 3)] + [(None, 1), (4, None)]
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, _id string, _hit int")
    want, k = brute(docs, {i for i, q in labels if q == 1 and i is not None}, sum(q == 1 for _, q in labels) / sum(q is not None for _, q in labels))
    got = sorted(I.resample(df, spark.createDataFrame(labels, "doc_id long, quality int")).collect(), key=lambda x: x.rank)
    assert [(x.doc_id, x.keep) for x in got] == [(i, at < k) for at, (i, _, _) in enumerate(want)]
    assert np.allclose([x.log_weight for x in got], [w for _, w, _ in want], rtol=1e-5, atol=1e-4)
    assert np.allclose([x.key for x in got], [x for _, _, x in want], rtol=1e-5, atol=1e-4)
