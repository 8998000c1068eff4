"""Byte-level BPE encoding and decoding by monoid tree reduction.

A piece is encoded in halves, recursively. Two encoded neighbours join by encoding the bytes of a
window around the border anew. The window grows until the tokens outside are proven stable: a
sequence of tokens is the encoding of its bytes if and only if each two neighbours are the encoding
of their own bytes, and the halves are encodings already, so only the two pairs at the window's edges
have to be tested. Decoding concatenates the tokens' bytes up the same kind of tree.

Scale: rows are independent, no shuffle. A worker holds the vocabulary, a bounded memo of short pieces
and one Arrow batch; long pieces take O(n log n) by a heap where a window gets long.
"""

from __future__ import annotations

import base64
import heapq
import re
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

#: Code points with the White_Space property.
WHITE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
#: Cuts a text where every match of the usual byte-level BPE pattern ends too: a run of white space but
#: for its last character, the next word with one space before it, or a single white space.
CHUNKS = f"[{WHITE}]+(?![^{WHITE}])| ?[^{WHITE}]+|[{WHITE}]"
LEAF = 6
LONG = 96
MEMO = 300_000
MEMO_PARTS = 120_000
MEMO_CHARS = 48


class Memo(dict):
    """A function's values by argument, in two generations of bounded size: when the young one is
    full it becomes the old one, and what is asked again moves back."""

    def __init__(self, make: Callable, most: int = MEMO):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, key):
        got = self.old.get(key)
        if got is None:
            got = self.make(key)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = got
        return got


def tree(low: int, high: int, leaf: Callable, join: Callable, most: int):
    """Reduces [low, high) in halves: ``leaf`` for up to ``most`` items, ``join`` of two neighbours.

    The left part is the largest power of two, so runs of one byte are cut where merges align.
    """
    if high - low <= most:
        return leaf(low, high)
    half = 1 << (high - low - 1).bit_length() - 1
    return join(tree(low, low + half, leaf, join, most), tree(low + half, high, leaf, join, most))


class Bpe:
    """Encodes by ``ranks`` (token bytes -> id; the lowest id merges first)."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.token = {i: b for b, i in ranks.items()}
        self.pieces = regex.compile(pattern).findall
        self.chunks = re.compile(CHUNKS).findall
        self.stable = Memo(self._stable, MEMO_PARTS)
        self.short = Memo(self.merges, MEMO_PARTS)
        self.memo = Memo(self.chunk)

    def forget(self) -> None:
        """Drops the memo of chunks and all old generations: a worker outlives its task, and its memory counts then."""
        self.memo.clear()
        for m in (self.memo, self.short, self.stable):
            m.old = {}

    # -- merges

    def merges(self, data: bytes) -> list[int]:
        """Token ids of ``data`` by lowest-rank merges, leftmost first."""
        if len(data) > LONG:
            return self._merges_long(data)
        rank, parts = self.ranks.get, [data[i : i + 1] for i in range(len(data))]
        none = 1 << 62
        pair = [rank(a + b, none) for a, b in zip(parts, parts[1:])]
        while pair and (low := min(pair)) < none:
            i = pair.index(low)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pair[i]
            if i:
                pair[i - 1] = rank(parts[i - 1] + parts[i], none)
            if i < len(pair):
                pair[i] = rank(parts[i] + parts[i + 1], none)
        return [self.ranks[p] for p in parts]

    def _merges_long(self, data: bytes) -> list[int]:
        """The same with a heap of pairs over a linked list."""
        n, rank = len(data), self.ranks.get
        end, back = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int]] = []

        def offer(i: int) -> None:
            j = end[i]
            if j < n and (r := rank(data[i : end[j]])) is not None:
                heapq.heappush(heap, (r, i, end[j]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = end[i] if end[i] > 0 else n
            if end[i] < 0 or j >= n or end[j] != stop:
                continue  # a part of the pair has merged meanwhile
            end[i], end[j] = stop, -1
            if stop < n:
                back[stop] = i
            offer(i)
            if back[i] >= 0:
                offer(back[i])
        out, i = [], 0
        while i < n:
            out.append(self.ranks[data[i : end[i]]])
            i = end[i]
        return out

    # -- the monoid

    def _stable(self, pair: tuple[int, int]) -> bool:
        return self.merges(self.token[pair[0]] + self.token[pair[1]]) == [*pair]

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the bytes of two neighbouring encodings."""
        stable = self.stable
        if stable[left[-1], right[0]]:
            return left + right
        k, n, m = 1, len(left), len(right)
        while True:
            a, b = max(0, n - k), min(m, k)
            data = b"".join(map(self.token.__getitem__, left[a:] + right[:b]))
            window = self.short[data] if len(data) <= 16 else self.merges(data)
            if (a == 0 or stable[left[a - 1], window[0]]) and (b == m or stable[window[-1], right[b]]):
                return left[:a] + window + right[b:]
            k *= 2

    def piece(self, data: bytes) -> list[int]:
        """Ids of one match of the pattern: a whole token as it is, else the tree."""
        if (whole := self.ranks.get(data)) is not None:
            return [whole]
        return tree(0, len(data), lambda a, b: self.short[data[a:b]], self.join, LEAF)

    # -- texts

    def chunk(self, text: str) -> bytes:
        ids = [i for m in self.pieces(text) for i in self.piece(m.encode())]
        return array("I", ids).tobytes()

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        c, of = self.chunks(text), self.memo.__getitem__
        if max(map(len, c), default=0) > MEMO_CHARS:  # long chunks would fill the memo
            of = lambda x: self.memo[x] if len(x) <= MEMO_CHARS else self.chunk(x)
        return tree(0, len(c), lambda a, b: b"".join(map(of, c[a:b])), bytes.__add__, 1 << 14)

    def decode(self, ids: bytes) -> bytes:
        of = self.token.__getitem__
        v = memoryview(ids).cast("I")
        return tree(0, len(v), lambda a, b: b"".join(map(of, v[a:b].tolist())), bytes.__add__, 1 << 14)


@lru_cache(2)
def load(path: str, pattern: str) -> Bpe:
    """From a file of base64 tokens and ranks; a worker loads it once and keeps the merges of short parts."""
    with open(path, "rb") as f:
        return Bpe({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}, pattern)


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", keep: list[str] | None = None, back: bool = False) -> DataFrame:
    """``keep`` columns (default: doc_id), ``n_tokens bigint`` and ``ids binary`` of every whole text; with
    ``back`` also ``decoded binary``, decoded from the ids by the same worker.

    ``path`` must exist on every executor (a vocabulary that is installed with the library). Defined
    cases: null text counts as empty, an empty text has no ids; rows are encoded one by one, so
    repeated rows, ids and extra columns make no difference.
    """
    keep = ["doc_id"] if keep is None else keep
    made = ["n_tokens", "ids", *["decoded"] * back]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path, pattern)
        for b in batches:
            for at in range(0, b.num_rows, 128):
                part = b.slice(at, 128)
                ids = [bpe.encode(t.as_py() or "") for t in part.column(part.num_columns - 1)]
                cols = [*part.columns[:-1], pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]
                if back:
                    cols.append(pa.array([bpe.decode(x) for x in ids], pa.binary()))
                yield pa.RecordBatch.from_arrays(cols, [*keep, *made])
        bpe.forget()

    schema = StructType([*docs.select(*keep).schema, *[StructField(n, LongType() if n == "n_tokens" else BinaryType()) for n in made]])
    return docs.select(*keep, F.col(text).alias("_text")).mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``encoded`` with ``decoded binary``: the bytes of ``ids``; null ids count as none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path, pattern)
        for b in batches:
            ids = b.column(b.schema.get_field_index("ids"))
            text = pa.array([bpe.decode(x.as_py() or b"") for x in ids], pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns, text], [*b.schema.names, "decoded"])

    return encoded.mapInArrow(run, StructType([*encoded.schema, StructField("decoded", BinaryType())]))
