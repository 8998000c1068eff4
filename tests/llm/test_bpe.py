import hashlib
import struct

import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from quorumlake.llm import bpe

PATH = P.path("byte_bpe_multi_50k.tiktoken")
OWN = bpe.load(PATH, P.PATTERN)
REF = tiktoken.Encoding("ref", pat_str=P.PATTERN, mergeable_ranks=OWN.ranks, special_tokens={})


def ids(b):
    return list(struct.unpack(f"<{len(b) // 4}I", b))


def same(text):
    got = OWN.encode(text)
    assert ids(got) == REF.encode_ordinary(text)
    assert OWN.decode(got) == text.encode()


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    same(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab cé中'st\n\t 1.!", max_size=200))
def test_dense_text(text):
    same(text)


@pytest.mark.parametrize("text", ["", " ", "\n\n x", "a" * 3000, "ab" * 2000, " " * 2001 + "x", "é" * 999, "中" * 700, "<|endoftext|>", "\x85\xa0  y", "\x1c\x1d", "x" * 47 + "y" * 60])
def test_long_and_odd(text):
    same(text)


def test_join_of_any_two_parts():
    for word in (b"internationalisation", b"thererethatthe", "Übermäßigkeit".encode()):
        for cut in range(1, len(word)):
            assert OWN.join(OWN.merges(word[:cut]), OWN.merges(word[cut:])) == OWN.merges(word)


def test_small_memo():
    small = bpe.Bpe(OWN.ranks, P.PATTERN)
    small.memo.most = small.short.most = small.stable.most = 3
    text = "the quick brown fox jumps over the quick brown dogs. " * 3
    assert ids(small.encode(text)) == REF.encode_ordinary(text)


def test_table(spark):
    rows = [(1, "one two", "x"), (2, None, "x"), (3, "", "x"), (1, "one two", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = bpe.decode(bpe.encode(df, PATH, P.PATTERN), PATH, P.PATTERN).collect()
    assert sorted((r.doc_id, r.n_tokens, bytes(r.decoded)) for r in got) == sorted((i, len(REF.encode_ordinary(t or "")), (t or "").encode()) for i, t, _ in rows)
    assert {hashlib.sha256(r.ids).hexdigest() for r in got if r.doc_id == 2} == {hashlib.sha256(b"").hexdigest()}
    assert bpe.encode(df.limit(0), PATH, P.PATTERN).count() == 0
