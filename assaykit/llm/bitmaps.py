"""A bitmap over hashes whose size is bounded: whatever it lets pass is joined exactly later."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS, MOST_BITS = 26, 29
#: Bits that a hash sets, all in one word; they are read from its lowest 6 * PROBES bits.
PROBES = 4


def bits_for(n: int) -> int:
    """The BITS for n hashes: a word for two of them, from 8 MB up to 64."""
    return min(MOST_BITS, max(BITS, (32 * n).bit_length()))


def build(hashes: DataFrame, column: str, bits: int = BITS) -> np.ndarray:
    """2^bits bits in words of 64: the upper bits of a 64-bit hash choose the word, PROBES lower ones the
    bits that it sets there; tasks and Spark unite the words, and at most 2^(bits - 6) of them reach the
    driver. More hashes only let more pass."""
    marks = [f"shiftleft(1L, cast(shiftright(`{column}`, {6 * i}) & 63 as int))" for i in range(PROBES)]
    words = (
        hashes.filter(F.col(column).isNotNull())
        .groupBy(F.expr(f"shiftrightunsigned(`{column}`, {64 - bits + 6})").alias("word"))
        .agg(F.bit_or(F.expr(" | ".join(marks))).alias("bits"))
        .toArrow()
    )
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return out


def passes(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    h = hashes.view(np.uint64)
    word = bitmap[(h >> np.uint64(65 - len(bitmap).bit_length())).astype(np.int64)]
    found = np.ones(len(h), np.uint64)
    for i in range(PROBES):
        found &= word >> (h >> np.uint64(6 * i) & np.uint64(63))
    return found.astype(bool)
