import random

import numpy as np
import pytest
import xxhash

from quorumlake.llm import near_dedup as N


def brute_print(text):
    w = [x for x in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ") if x]
    if not w:
        return 0
    s = [" ".join(w)] if len(w) < 3 else [" ".join(w[i : i + 3]) for i in range(len(w) - 2)]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows):
    prints = [brute_print(t) for _, t in rows]
    comp = {i: i for i, _ in rows}
    changed = True
    while changed:
        changed = False
        for (a, _), f in zip(rows, prints):
            for (b, _), g in zip(rows, prints):
                if bin(f ^ g).count("1") <= 2 and comp[a] != comp[b]:
                    comp[a] = comp[b] = min(comp[a], comp[b])
                    changed = True
    return sorted((i, f, comp[i]) for (i, _), f in zip(rows, prints))


def test_fingerprint():
    r = random.Random(1)
    for _ in range(200):
        t = " ".join(r.choices(["A", "bC", "é", "ÀX", "d", "long-word"], k=r.randint(0, 30))) + r.choice(["", "\n", " "])
        assert N.fingerprint(t.encode()) == brute_print(t)
    assert N.fingerprint(None) == N.fingerprint(b" \n\t") == 0


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5])
def test_bit_sliced_comparison(radius):
    r = random.Random(radius)
    f = [r.getrandbits(64) for _ in range(70)]
    f += [x ^ sum(1 << k for k in r.sample(range(64), r.randint(0, 6))) for x in f for _ in range(2)]
    a = np.array(f, np.uint64)
    i, j = N.within(a, a[:50], radius)
    assert set(zip(i.tolist(), j.tolist())) == {(x, y) for x in range(50) for y in range(len(f)) if bin(f[x] ^ f[y]).count("1") <= radius}


def near_copies(n, seed):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    base = r.choices(words, k=400)
    rows = []
    for i in range(n):
        t = list(base) if i % 3 else r.choices(words, k=r.randint(0, 50))
        for _ in range(i % 4):
            if t:
                t[r.randrange(len(t))] = "edit"
        rows.append((i * 3 % n, " ".join(t) if t else None))
    return rows


@pytest.mark.parametrize("cap", [4096, 3])
def test_components_against_brute_force(spark, cap):
    rows = [(i, t) for i, t in near_copies(120, 5)] if cap == 3 else near_copies(121, 6)
    rows = [(k, t) for k, (_, t) in enumerate(rows)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame([(i, t, "clash", "x") for i, t in rows], "doc_id long, text string, fp string, component_id string")
    got = N.components(df, cap=cap)
    mine = sorted((r.doc_id, r.fp & (2**64 - 1), r.component_id) for r in got.collect())
    assert mine == brute_components(rows)
    kept = N.keep_one(df, cap=cap)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, _, c in mine})


def test_chain_links_and_hot_bucket(spark):
    """Fingerprints that step two bits at a time, all inside hot buckets, are one component."""
    fps = [0]
    for k in range(0, 30, 2):
        fps.append(fps[-1] ^ (3 << k))
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    from quorumlake.operators.graph import connected_components

    for cap in (2, 4096):
        found = connected_components(N.links(df, cap=cap))
        assert found.select("component").distinct().count() == 1 and found.count() == len(fps)


def test_edge_cases(spark):
    rows = [(4, None, 1), (2, "", 1), (9, " ", 1), (None, "a b c", 1), (5, "solo", 1), (5, "solo", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _dropped int")
    got = sorted(((r.doc_id, r.component_id) for r in N.components(df).collect()), key=str)
    assert got == sorted([(4, 2), (2, 2), (9, 2), (None, None), (5, 5), (5, 5)], key=str)
    assert sorted((r.doc_id for r in N.keep_one(df).collect()), key=str) == [2, 5, 5, None]
    assert N.components(df.limit(0)).count() == 0


def brute_similar(rows):
    sets = {}
    for i, t in rows:
        w = (t or "").lower().split()
        sets[i] = frozenset(" ".join(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    comp = {i: i for i in sets}
    same = lambda a, b: a == b or len(a & b) >= 0.8 * len(a | b)
    pairs = [(a, b) for a in sets for b in sets if a < b and same(sets[a], sets[b])]
    for _ in range(len(sets)):
        for a, b in pairs:
            comp[a] = comp[b] = min(comp[a], comp[b])
    return comp


def test_stage_keeps_one_of_five_word_jaccard_groups(spark):
    """The pipeline's stage and small tiles and buckets, against all pairs."""
    import corpus_pipeline

    r = random.Random(8)
    words = [f"w{i}" for i in range(400)]
    rows = [(200, None), (201, " "), (202, "solo"), (203, "Solo")]
    for b in range(12):
        base = r.choices(words, k=r.choice([12, 60, 300]))
        for c in range(8 if b else 30):
            t = list(base)
            for _ in range(r.randint(0, max(1, len(t) // 40))):
                t[r.randrange(len(t))] = r.choice(words)
            rows.append((len(rows), " ".join(t)))
    comp = brute_similar(rows)
    assert len(set(comp.values())) < len(rows) - 40
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(x.doc_id for x in corpus_pipeline.dedup(spark, df, "").collect()) == sorted(set(comp.values()))
    for leaders in (0, 1, 3):
        got = {x.doc_id: x.component_id for x in N.similar_components(df, cap=3, tile=4, leaders=leaders).collect()}
        assert got == comp
