"""Benchmark contamination by winnowing: fingerprints of word windows, joined and then extended."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assaykit.llm import bitmaps
from assaykit.llm.rowlists import without
from assaykit.llm.textbytes import LOWER, buffers, mix, pieces, row_of, run_hashes, span_hashes, word_spans
from assaykit.session import cut

WINDOW = 10
GRAM = 5

#: Digits, a-z after lower-casing, and every byte of a character beyond ASCII.
IS_WORD = np.zeros(256, bool)
IS_WORD[48:58] = IS_WORD[97:123] = IS_WORD[128:] = True

_FOUND = pa.struct(
    [("print", pa.int64()), ("key", pa.binary()), ("start", pa.int32()), ("length", pa.int32())]
)
_FOUND_SQL = "array<struct<print:bigint,key:binary,start:int,length:int>>"


def window_prints(hashes: np.ndarray, row: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, fingerprint) of every window of `length` words inside one row: the smallest hash of
    its k-grams, k = min(gram, length). Two equal windows have the same fingerprint, so any shared
    span of `length` words shares one."""
    k = min(gram, length)
    grams = run_hashes(hashes, k) ^ mix(np.array([length], np.uint64))
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    least = grams[:n].copy()
    for j in range(1, length - k + 1):
        np.minimum(least, grams[j : j + n], out=least)
    starts = np.flatnonzero(row[:n] == row[length - 1 :])
    return starts, least[starts]


def _windows(
    text: pa.Array, lengths: list[int] | None, window: int, gram: int, passes: np.ndarray | None
) -> Iterator[tuple[int, np.ndarray, list[list[dict]]]]:
    """For row ranges of a text column: first row, word counts, and the windows that pass the filter.
    Without `lengths` a row has windows of its own length where it is shorter than `window`."""
    data, off = buffers(text)
    for low, high in pieces(off):
        part = LOWER[data[off[low] : off[high]]]
        starts, ends, first = word_spans(part, off[low : high + 1] - off[low], IS_WORD)
        hashes, row, counts = span_hashes(part, starts, ends), row_of(first), np.diff(first)
        found: list[list[dict]] = [[] for _ in range(high - low)]
        raw = part.tobytes()
        own = np.minimum(counts, window)
        for length in lengths if lengths is not None else np.unique(own[own > 0]).tolist():
            at, prints = window_prints(hashes, row, length, gram)
            if lengths is None:
                keep = own[row[at]] == length
            else:
                keep = bitmaps.passes(passes, prints)
            for s, p in zip(at[keep].tolist(), prints[keep].view(np.int64).tolist()):
                words = b" ".join([raw[a:b] for a, b in zip(starts[s : s + length], ends[s : s + length])])
                key = hashlib.blake2b(words, digest_size=16).digest()
                found[row[s]].append(
                    {"print": p, "key": key, "start": int(s - first[row[s]]), "length": length}
                )
        yield low, counts, found


def _item_windows(items: DataFrame, id_col: str, text_col: str, window: int, gram: int) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, counts, found in _windows(batch.column(1), None, window, gram, None):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[low : low + len(counts)], pa.array(found, pa.list_(_FOUND))],
                    names=["item", "found"],
                )

    kind = items.schema[id_col].dataType.simpleString()
    return (
        items.select(id_col, text_col)
        .mapInArrow(scan, f"item {kind}, found {_FOUND_SQL}")
        .select("item", F.explode("found").alias("w"))
        .select("item", "w.print", "w.key", "w.length")
        .distinct()
    )


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
) -> DataFrame:
    """One row per row of `docs`: id, text_hash, n_words, n_hit, n_items, items_sha256, contaminated.

    Words are lower-cased runs of ASCII digits, letters and characters beyond ASCII. A window is
    `window` neighbouring words of an item; an item with fewer words is one window. Every document
    word inside an occurrence of a window is hit.

    Winnowing: the fingerprint of a window is the smallest hash of its `gram`-word runs, so equal
    windows agree in it. Documents emit only windows whose fingerprint passes a bitmap of the
    benchmark's fingerprints (fixed size, so it may travel with every task; a large benchmark only
    lets more windows pass). Those are joined with the benchmark's on the fingerprint and extended to
    the whole window by a 128-bit digest of its words. Hits then unite per document.

    A null or empty text has no words and no hits. Items without words match nothing; an item with a
    null id marks words but is not listed. Repeated rows give repeated results. Texts, of any length,
    are read whole and never leave the scan; only their windows that pass do.
    """
    spark = docs.sparkSession
    listed = cut(_item_windows(items, item_col, item_text_col, window, gram))
    lengths = sorted(r[0] for r in listed.select("length").distinct().collect())
    passes = spark.sparkContext.broadcast(bitmaps.build(listed, "print"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for low, counts, found in _windows(batch.column(2), lengths, window, gram, passes.value):
                n = len(counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(row, row + n)),
                        batch.column(0)[low : low + n],
                        batch.column(1)[low : low + n],
                        pa.array(counts.astype(np.int64)),
                        pa.array(found, pa.list_(_FOUND)),
                    ],
                    names=["row", id_col, "text_hash", "n_words", "found"],
                )
                row += n

    kind = docs.schema[id_col].dataType.simpleString()
    scanned = cut(
        docs.select(F.col(id_col), F.xxhash64(text_col).alias("text_hash"), F.col(text_col)).mapInArrow(
            scan, f"row long, `{id_col}` {kind}, text_hash long, n_words long, found {_FOUND_SQL}"
        )
    )
    hits = cut(
        scanned.select("row", F.explode("found").alias("w"))
        .select("row", "w.*")
        .join(listed.select("print", "key").distinct(), ["print", "key"])
        .select("row", "start", "length", "key")
    )
    reach = Window.partitionBy("row").orderBy("start", "length").rowsBetween(Window.unboundedPreceding, -1)
    stop = F.col("start") + F.col("length")
    covered = (
        hits.select("row", "start", "length")
        .withColumn("before", F.coalesce(F.max(stop).over(reach), F.lit(0)))
        .groupBy("row")
        .agg(F.sum(F.greatest(stop - F.greatest("start", "before"), F.lit(0))).alias("n_hit"))
    )
    named = (
        hits.select("row", "key")
        .distinct()
        .join(listed.filter(F.col("item").isNotNull()).select("key", "item").distinct(), "key")
        .groupBy("row")
        .agg(F.collect_set(F.col("item").cast("string")).alias("items"))
        .select(
            "row",
            F.size("items").cast("long").alias("n_items"),
            F.sha2(F.array_join(F.sort_array("items"), ","), 256).alias("items_sha256"),
        )
    )
    return (
        scanned.drop("found")
        .join(covered, "row", "left")
        .join(named, "row", "left")
        .select(
            id_col,
            "text_hash",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
            F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
            (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        )
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs`, with all their columns, in which no window of an item occurs."""
    bad = (
        contamination(docs, items, id_col, text_col)
        .filter("contaminated")
        .select(F.col(id_col).alias("_id"), F.col("text_hash").alias("_hash"))
        .distinct()
    )
    return without(docs, cut(bad), id_col, text_col)
