import pytest
import tiktoken

import __spark_entry__ as entry
import corpus_pipeline as C
from quorumlake.llm import bpe, mixing, near_dedup, pii
from quorumlake.llm.queries import PUBLISHED_KEY, TOKENS

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Each stage's rows over the smallest tables, written and read again."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for i, (_, f) in enumerate(C.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(i))
        f(spark, docs, SF).write.parquet(path)
        new = spark.read.parquet(path)
        out.append((docs.collect(), new.collect(), docs.columns, new.columns))
        docs = new
    return out


def test_columns(stages):
    assert all(sorted(new) == sorted(old) for _, _, old, new in stages[:-1])


def test_language_keeps_clean_documents(stages):
    old, new, _, _ = stages[0]
    assert len(new) >= 0.97 * len(old) and {r.doc_id for r in old if r.text.strip()} - {r.doc_id for r in new} == set()


def test_dedup(stages):
    """Groups by all pairs of a Jaccard similarity of 0.8 of five-word shingles, as near-duplicate stages are to take."""
    old, new, _, _ = stages[1]
    sets = {}
    for r in old:
        w = r.text.encode().lower().split()
        sets[r.doc_id] = {b" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    comp = {i: i for i in sets}
    pairs = [(a, b) for a in sets for b in sets if a < b and (sets[a] == sets[b] or len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]))]
    for _ in range(5):
        for a, b in pairs:
            comp[a] = comp[b] = min(comp[a], comp[b])
    assert sorted(r.doc_id for r in new) == sorted(set(comp.values())) and len(new) < len(old)


def test_surrogates(stages):
    old, new, _, _ = stages[2]
    text = {r.doc_id: r.text for r in new}
    assert len(text) == len(old)
    for r in old:
        assert text[r.doc_id] == pii.replace(r.text, PUBLISHED_KEY.encode())[0]
        for a, b, _, _ in pii.detect(r.text):
            assert r.text[a:b] not in text[r.doc_id]


def test_mix(spark, stages):
    old, new, _, _ = stages[3]
    taken = {r.doc_id: (r.size, r.taken) for r in mixing.mix(spark.createDataFrame(old)).collect()}
    got = {}
    for r in new:
        got[r.doc_id] = got.get(r.doc_id, 0) + len(r.text.split())
    assert got == {i: t for i, (_, t) in taken.items() if t}


def test_tokens(stages):
    import public_tokenizers as P

    old, new, _, _ = stages[4]
    ranks = bpe.load(P.path(TOKENS), P.PATTERN).ranks
    ref = tiktoken.Encoding("ref", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert len(new) == len(old)
    assert sorted(r.n_tokens for r in new) == sorted(len(ref.encode_ordinary(r.text)) for r in old)


def test_registered(spark):
    q = entry.queries()
    assert all(any(n.startswith(f"op{i}_") for n in q) for i in range(1, 11)) and "pipeline" in q


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _size long, _dropped int, pii_spans string"


def test_odd_rows_pass_all_stages(spark):
    """Nulls in any column, empty and very long texts, repeated rows and ids, columns of the stages' own names."""
    prose = "the house of the people with the water and that time which they have from this "
    rows = [(i, prose * (i % 3 + 1) + f"w{i} mail a{i}@b.example.com", "en", f"s{i % 3}", 9, 1, 2, "x") for i in range(40)]
    rows += [(None, prose + " no id", "en", "s0", None, None, None, None), (None, None, None, None, None, None, None, None), (50, "", "en", "s1", 0, 1, 2, "x")]
    rows += [rows[3], rows[3], (3, prose + "of another text", "en", None, 1, 1, 1, "y"), (60, (prose + "long ") * 20_000, None, "s2", 1, 1, 1, "z")]
    docs = spark.createDataFrame(rows, SCHEMA)
    for k, (name, f) in enumerate(C.STAGES):
        new = f(spark, docs, "")
        assert f(spark, docs.limit(0), "").count() == 0, name
        if k < len(C.STAGES) - 1:
            assert new.columns == docs.columns, name
        docs = spark.createDataFrame(new.collect(), new.schema)
    out = docs.collect()
    assert {r.doc_id for r in out} >= {0, 1, 2, 60} and all(r.n_tokens > 0 for r in out)
