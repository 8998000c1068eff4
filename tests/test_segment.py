import random

import pytest

from quorumlake.operators.segment import greedy_segments


def brute(words, known):
    at, out = 0, []
    while at < len(words):
        n = next((n for n in (4, 3, 2, 1) if at + n <= len(words) and " ".join(words[at : at + n]) in known), 0)
        out += [(at, n, " ".join(words[at : at + n]))] if n else []
        at += max(n, 1)
    return out


@pytest.mark.parametrize("letters", ["ab", "abcdef"])
def test_against_reading_from_the_left(spark, letters):
    """Long chains of overlaps, unknown words, phrases that begin alike, repeated vocabulary, empty and missing texts."""
    r = random.Random(len(letters))
    known = {" ".join(r.choice(letters) for _ in range(r.randint(2, 4))) for _ in range(9)} | {letters[0]}
    texts = {i: [r.choice(letters) for _ in range(n)] for i, n in enumerate([0, 1, 2, 5, 40, 300, 3000])}
    df = spark.createDataFrame([*texts.items(), (99, None)], "id int, words array<string>")
    vocabulary = spark.createDataFrame([(p,) for p in [*known, *known, None]], "phrase string")
    got = {}
    for x in greedy_segments(df, vocabulary, "id").collect():
        got.setdefault(x.id, []).append((x.pos, x.n, x.phrase))
    assert {i: sorted(g) for i, g in got.items()} == {i: b for i, w in texts.items() if (b := brute(w, known))}


def test_only_runs_that_may_be_phrases_are_made(spark, monkeypatch):
    """Words that begin no phrase give no run, whatever follows them; words with spaces and runs at a text's end are found."""
    from quorumlake.operators import segment

    met, join = [], segment.join_dim

    def noted(fact, dim, on, *how):
        met.append((on, fact.count()))
        return join(fact, dim, on, *how)

    monkeypatch.setattr(segment, "join_dim", noted)
    df = spark.createDataFrame([(1, ["x"] * 500 + ["a", "b", "x", "a b"]), (2, ["b", "a"]), (3, [])], "id int, words array<string>")
    got = segment.greedy_segments(df, spark.createDataFrame([("a b",), ("a b x a b",), ("a",), (None,)], "phrase string"), "id").collect()
    assert sorted((r.id, r.pos, r.n, r.phrase) for r in got) == [(1, 500, 4, "a b x a b"), (2, 1, 1, "a")]
    assert met == [("head", 506), ("phrase", 6)]
