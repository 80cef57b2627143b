"""Whole-batch text primitives over the UTF-8 buffer of an Arrow column: no loop per row or word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 19
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX_A = np.uint64(0xBF58476D1CE4E5B9)
_MIX_B = np.uint64(0x94D049BB133111EB)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every bit (the splitmix finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * _MIX_A
    x = (x ^ (x >> np.uint64(27))) * _MIX_B
    return x ^ (x >> np.uint64(31))


_LETTER = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string or binary array; a null row is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    binary = pa.types.is_binary(texts.type) or pa.types.is_large_binary(texts.type)
    texts = texts.cast(pa.large_binary() if binary else pa.large_string())
    if texts.null_count:
        texts = texts.fill_null(b"" if binary else "")
    _, offsets, data = texts.buffers()
    off = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8)
    data = np.frombuffer(data or b"", np.uint8)[off[0] : off[-1]]
    return data, off - off[0]


def pieces(off: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `limit` bytes each; a longer row stands alone."""
    row, rows = 0, len(off) - 1
    while row < rows:
        stop = int(np.searchsorted(off, off[row] + limit, "right")) - 1
        stop = min(max(stop, row + 1), rows)
        yield row, stop
        row = stop


def word_spans(
    data: np.ndarray, off: np.ndarray, is_word: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first): byte spans of the maximal runs of word bytes inside each row, and the
    number of words before each row (one entry more than there are rows)."""
    inside = is_word[data]
    rows = off[:-1][off[:-1] < len(data)]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    begins[rows] = inside[rows]
    starts = np.flatnonzero(begins)
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    last = off[1:][(off[1:] > 0) & (off[1:] > off[:-1])] - 1
    ends[last] = inside[last]
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, off)


_POWERS = np.ones(1, np.uint64)
_BACK = np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POWERS, _BACK
    if len(_POWERS) < n:
        size = 1 << (n - 1).bit_length()
        steps = np.full(size, _BASE, np.uint64)
        back = np.full(size, _INVERSE, np.uint64)
        steps[0] = back[0] = 1
        _POWERS, _BACK = np.cumprod(steps), np.cumprod(back)
    return _POWERS, _BACK


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, from one running sum over the buffer."""
    powers, back = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_LETTER[data] * powers[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * back[starts])


def run_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of every run of k neighbouring entries; row bounds are the caller's matter."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j in range(k):
        total = (total ^ hashes[j : j + n]) * _BASE + np.uint64(j + 1)
    return mix(total)


def row_of(first: np.ndarray) -> np.ndarray:
    """The row of each word."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def ragged(lengths: np.ndarray) -> np.ndarray:
    """0, 1, .. inside each of the given lengths, one after another."""
    lengths = lengths.astype(np.int64)
    before = np.cumsum(lengths) - lengths
    return np.arange(int(lengths.sum()), dtype=np.int64) - np.repeat(before, lengths)
