"""UTF-8 buffers of Arrow string columns, in slices of bounded size, and n-gram codes over them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that one slice holds, if no single text is longer.
SLICE = 4 << 20

_FOLD = np.full(256, 32, np.uint8)  # ASCII that is no letter becomes a space, A-Z lower case
_FOLD[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD[128:] = np.arange(128, 256)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def slices(column: pa.Array, most: int = SLICE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first row, bytes, offsets)``: the texts of rows first.. lie at offsets[i]:offsets[i + 1]; null is empty."""
    col = column.fill_null("").cast(pa.large_binary())
    if not len(col):
        return
    _, at, data = col.buffers()
    at = np.frombuffer(at, np.int64)[col.offset : col.offset + len(col) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(col):
        end = max(row + 1, int(np.searchsorted(at, at[row] + most, "right")) - 1)
        yield row, data[at[row] : at[end]], at[row : end + 1] - at[row]
        row = end


def sum_by_text(values: np.ndarray, positions: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ``values`` over the texts in which their byte ``positions`` lie."""
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    cut = np.searchsorted(positions, offsets)
    return total[cut[1:]] - total[cut[:-1]]


def trigrams(data: np.ndarray, offsets: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """``(codes, positions)`` of hashed byte trigrams of letters and single spaces, none across texts."""
    b = _FOLD[data]
    if len(b) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    keep = b[1:-1] != 32
    ends = offsets[1:-1]
    for back in (1, 2):
        k = ends - back
        k = k[(k >= 0) & (k < len(keep))]
        keep[k] = False
    at = np.nonzero(keep)[0]
    x = b[at].astype(np.uint32) << 16 | b[at + 1].astype(np.uint32) << 8 | b[at + 2]
    return ((x * np.uint32(2654435761)) >> np.uint32(32 - bits)).astype(np.int64), at


_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def word_ngrams(data: np.ndarray, offsets: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """``(codes, positions)`` of hashed words and pairs of neighbouring words of one text, A-Z lower-cased.

    A word's hash is a polynomial of its bytes modulo 2^64, from two prefix sums: no loop over words.
    """
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    word = ~_SPACE[data]
    start = np.nonzero(word & (edge[:-1] | np.concatenate([[True], ~word[:-1]])))[0]
    end = np.nonzero(word & (edge[1:] | np.concatenate([~word[1:], [True]])))[0] + 1
    prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum((_LOWER[data].astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(data)), dtype=np.uint64)])
    h = (prefix[end] - prefix[start]) * _powers(_INVERSE, len(data) + 1)[start]
    h ^= h >> np.uint64(29)
    text = np.searchsorted(offsets, start, "right")
    pair = text[1:] == text[:-1]
    two = (h[:-1] * np.uint64(0xD6E8FEB86659FD93) + h[1:])[pair]
    codes = np.concatenate([h, two]) * np.uint64(0xFF51AFD7ED558CCD) >> np.uint64(64 - bits)
    at = np.concatenate([start, start[:-1][pair]])
    order = np.argsort(at, kind="stable")
    return codes[order].astype(np.int64), at[order]
