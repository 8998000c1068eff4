import hashlib
import re

import pytest
from pyspark.sql import functions as F

from quorumlake.llm import mixing

SCHEMA = "doc_id long, text string, source string, doc string"


def brute(rows, weights=(5, 2, 1), share=1.5, cap=2.0):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sources = sorted({r[2] for r in rows}, key=lambda s: (s is None, s or ""))
    sizes = {s: sum(size(r[1]) for r in rows if r[2] == s) for s in sources}
    w = {s: weights[i % len(weights)] for i, s in enumerate(sources)}
    full, level = set(), 0.0
    while True:
        rest = [s for s in sources if s not in full]
        if not rest:
            break
        level = (share * sum(sizes.values()) - cap * sum(sizes[s] for s in full)) / sum(w[s] for s in rest)
        new = {s for s in sources if w[s] * level > cap * sizes[s]}
        if new == full:
            break
        full = new
    out = []
    for s in sources:
        target = min(w[s] * level, cap * sizes[s])
        at, budget = 0, int(target)
        epochs = budget // sizes[s] if sizes[s] else 0
        rest = budget - epochs * sizes[s]
        mine = sorted((r for r in rows if r[2] == s), key=lambda r: (hashlib.md5(f"mix-1:{r[0]}".encode()).hexdigest(), r[0], size(r[1])))
        for r in mine:
            n = size(r[1])
            out.append((r[0], n, sizes[s], target, epochs * n + min(max(rest - at, 0), n)))
            at += n
    return sorted(out)


def rows_of(n):
    out = []
    for i in range(n):
        source = None if i % 11 == 0 else "big" if i % 3 == 0 else f"s{i % 5}"
        text = None if i % 17 == 0 else "" if i % 19 == 0 else " ".join(["w\tx"] * (i % 23)) + " " * (i % 3)
        out.append((i, text, source, "clash"))
    return out


@pytest.mark.parametrize("n", [0, 1, 400])
def test_against_brute_force(spark, n):
    rows = rows_of(n)
    got = mixing.mix(spark.createDataFrame(rows, SCHEMA))
    assert got.columns == ["doc_id", "source", "size", "source_size", "target", "taken"]
    mine = sorted((r.doc_id, r.size, r.source_size, r.target, r.taken) for r in got.collect())
    want = brute(rows)
    assert [m[:3] + m[4:] for m in mine] == [w[:3] + w[4:] for w in want]
    assert [m[3] for m in mine] == pytest.approx([w[3] for w in want])


def test_one_id_of_a_third_of_the_rows(spark):
    """Slices beyond what one window holds are split and give what a single sorted list gives."""
    rows = [(7 if i % 3 == 0 else i, text, source, doc) for i, text, source, doc in rows_of(400)]
    want = [(i, n, total, taken) for i, n, total, _, taken in brute(rows)]
    for held in (1, 3, 100_000):
        got = mixing.mix(spark.createDataFrame(rows, SCHEMA).repartition(5), held=held).collect()
        assert sorted((r.doc_id, r.size, r.source_size, r.taken) for r in got) == want


def test_budgets_are_met_and_repeats_are_bounded(spark):
    m = mixing.mix(spark.createDataFrame(rows_of(400), SCHEMA)).cache()
    per = m.groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("g")).collect()
    assert all(r.t == int(r.g) for r in per)
    assert m.where("taken > 2 * size").count() == 0


def test_only_empty_texts(spark):
    m = mixing.mix(spark.createDataFrame([(1, None, "a", ""), (2, "", None, "")], SCHEMA))
    assert [(r.size, r.taken) for r in m.collect()] == [(0, 0), (0, 0)]


def test_apply_repeats_and_cuts(spark):
    docs = spark.createDataFrame([(1, " a b  c ", "s", 7), (2, "d", "s", 1), (3, "e", "s", 1)], "doc_id long, text string, source string, n_chars long")
    mixed = spark.createDataFrame([(1, 3, 5), (2, 1, 2), (3, 1, 0)], "doc_id long, size long, taken long")
    got = sorted((r.doc_id, r.text, r.n_chars) for r in mixing.apply_mix(docs, mixed).collect())
    assert got == [(1, " a b", 4), (1, " a b  c ", 8), (2, "d", 1), (2, "d", 1)]


def test_rows_without_or_with_repeated_ids(spark):
    """Every row is taken as often as the mix says, also where ids are null or repeat."""
    import corpus_pipeline

    rows = [(None if i % 5 == 0 else i // 4, " ".join(f"r{i}w{k}" for k in range(i % 6 + 1)), f"s{i % 2}", "x") for i in range(60)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = {}
    for r in corpus_pipeline.mix(spark, docs, "").collect():
        i = int(r.text.split("w")[0][1:])
        assert (r.doc_id, r.source) == (rows[i][0], rows[i][2])
        got.setdefault(i, []).append(len(r.text.split()))
    per = mixing.mix(docs).groupBy("source").agg(F.sum("taken").alias("t")).collect()
    for p in per:
        assert sum(sum(n) for i, n in got.items() if rows[i][2] == p.source) == p.t
    assert all(sum(n) <= 2 * (i % 6 + 1) for i, n in got.items())
    assert any(rows[i][0] is None for i in got)


def test_clashing_columns(spark):
    rows = [(i, "a b c", "s", i, "k", i, 7, 8, 9) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, _size long, _taken string, _mix_row int, _words int, _pos int, _copy int")
    got = mixing.mixed_rows(docs)
    assert got.columns == docs.columns
    out = got.collect()
    assert sum(len(r.text.split()) for r in out) == 90 and all((r._size, r._taken, r._mix_row, r._words) == (r.doc_id, "k", r.doc_id, 7) for r in out)
    assert mixing.mixed_rows(docs.limit(0)).count() == 0
