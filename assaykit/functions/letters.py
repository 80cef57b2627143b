"""How often each of some letters stands in a text, counted in one pass over its bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

PIECE = 1 << 20


def _counts(text: np.ndarray, singles: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Occurrences in UTF-8 bytes: of one-byte letters, then of two-byte ones, a piece at a time."""
    ones, twos = np.zeros(256, np.int64), np.zeros(len(pairs), np.int64)
    for low in range(0, len(text), PIECE):
        part = text[low : low + PIECE]
        ones += np.bincount(part, minlength=256)
        if len(pairs):
            # a pair may reach into the next piece
            part = text[low : low + PIECE + 1]
            lead = np.flatnonzero(part[:-1] >= 0xC2)
            if len(lead):
                found = part[lead].astype(np.int64) << 8 | part[lead + 1]
                at = np.minimum(np.searchsorted(pairs, found), len(pairs) - 1)
                twos += np.bincount(at[pairs[at] == found], minlength=len(pairs))
    return np.concatenate([ones[singles], twos])


def shares(text: Column, letters: str) -> Column:
    """Array of the share of each letter among the characters of the lower-cased text, 0 where it is
    empty. `letters` have one or two bytes in UTF-8, and each stands once."""
    coded = [c.encode() for c in letters]
    if max(map(len, coded), default=0) > 2 or len(set(coded)) != len(coded):
        raise ValueError("letters have one or two bytes and do not repeat")
    singles = np.array([c[0] for c in coded if len(c) == 1], np.int64)
    named = sorted(c for c in coded if len(c) == 2)
    pairs = np.array([c[0] << 8 | c[1] for c in named], np.int64)
    order = [c for c in coded if len(c) == 1] + named
    places = np.array([order.index(c) for c in coded], np.int64)

    @F.arrow_udf("array<double>")
    def count(low: pa.Array, size: pa.Array) -> pa.Array:
        low = low.cast(pa.large_string())
        off = np.frombuffer(low.buffers()[1], np.int64)[low.offset : low.offset + len(low) + 1] if len(low) else np.zeros(1, np.int64)
        data = np.frombuffer(low.buffers()[2] or b"", np.uint8)
        out = np.zeros((len(low), len(coded)))
        for i in range(len(low)):
            out[i] = _counts(data[off[i] : off[i + 1]], singles, pairs)[places]
        out /= size.to_numpy(zero_copy_only=False)[:, None]
        ends = pa.array(np.arange(len(low) + 1, dtype=np.int32) * len(coded))
        return pa.ListArray.from_arrays(ends, pa.array(out.ravel()))

    found = count(F.lower(text), F.greatest(F.length(text), F.lit(1)))
    return found
