"""Substring deduplication: content-defined chunks by a gear rolling hash, deduplicated by digest."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assaykit.llm import bitmaps
from assaykit.llm.columns import unused
from assaykit.llm.textbytes import LOWER, buffers, mix, pieces, ragged, span_hashes
from assaykit.operators.skew import BROADCAST_KEYS, attach
from assaykit.session import cut

LEAST_CHUNK, MOST_CHUNK = 16, 64
LEAST_BYTES = 80
# How far before its first whole chunk a stretch is followed back; cuts there may be out of step.
BACK = 80
# Claims in one of 2^HOT_BITS buckets that a task finds in more than one of HOT_SHARE rows are counted apart.
HOT_BITS = 22
HOT_SHARE = 100
HOT_LEAST = 8
# A place and a length in one number: the length is in its lower half.
LENGTH = (1 << 32) - 1

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, *range(9, 14)]] = True
IS_WORD = np.zeros(256, bool)
IS_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_GEAR = (mix(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(48)).astype(np.uint16)


def normalised(part: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes with A-Z lower-cased and each run of ASCII white space inside a row as one space, the
    length of each row, and the place of each byte in `part`."""
    space = IS_SPACE[part]
    again = space.copy()
    again[1:] &= space[:-1]
    again[off[:-1][off[:-1] < len(part)]] = False
    kept = np.flatnonzero(~again)
    return np.where(space, np.uint8(32), LOWER[part])[kept], np.diff(np.searchsorted(kept, off)), kept


def _gear_hashes(part: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The 16-bit gear hash at each byte. It shifts by one bit a byte, so it depends on the last 16 bytes
    of the row alone. It is summed by doubling."""
    place, gear = ragged(sizes), _GEAR[part]
    for step in (1, 2, 4, 8):
        before = np.zeros_like(gear)
        before[step:] = gear[:-step] << np.uint16(step)
        gear = gear + np.where(place >= step, before, np.uint16(0))
    return gear


def chunk_ends(part: np.ndarray, sizes: np.ndarray, least: int = LEAST_CHUNK) -> np.ndarray:
    """Where chunks end: at a row's end, and after a byte whose gear hash is the least among those up to
    `least` bytes before and after it, the first of equal ones, so that chunks between are longer than
    `least` bytes and twice that on average; longer stretches are cut every MOST_CHUNK bytes from the
    cut before them. No character is cut. All but the last rule look at some bytes around the place only, so
    the ends fall into step again after an insertion."""
    n, wide, none = len(part), 2 * least + 1, np.iinfo(np.int64).max
    inside = np.append(part & 0xC0 == 0x80, False)
    at = np.arange(n) + least * (np.repeat(np.arange(len(sizes)), sizes) + 1)
    key = np.full(n + least * (len(sizes) + 1), none)
    key[at] = np.where(inside[1:], none, _gear_hashes(part, sizes).astype(np.int64) << 40 | at)
    best, span = key.copy(), 1
    while 2 * span <= wide:
        best[:-span] = np.minimum(best[:-span], best[span:])
        span *= 2
    least_here = np.minimum(best[at - least], best[at + least + 1 - span])
    natural = np.flatnonzero((least_here == key[at]) & (least_here < none) & (ragged(sizes) + 1 >= least)) + 1
    mark = np.zeros(n + 1, bool)
    mark[natural] = True
    mark[np.cumsum(sizes)] = True
    mark[0] = True
    ends = np.flatnonzero(mark)
    extra = (np.diff(ends) - 1) // MOST_CHUNK
    forced = np.repeat(ends[:-1], extra) + MOST_CHUNK * (ragged(extra) + 1)
    for _ in range(3):
        forced -= inside[forced]
    return np.sort(np.concatenate([ends[1:], forced]))


def _within(marks: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which, place): the marked places in low[i] .. high[i], both included, for each i."""
    places = np.flatnonzero(marks)
    first = np.searchsorted(places, low)
    count = np.searchsorted(places, high, "right") - first
    return np.repeat(np.arange(len(low)), count), places[np.repeat(first, count) + ragged(count)]


def _claims(part: np.ndarray, bounds: np.ndarray, starts: np.ndarray, ends: np.ndarray, known: np.ndarray):
    """(low, high) of the stretches to look up: two neighbouring known chunks, and a known chunk with
    the words that follow it in the next chunk, or that precede it by up to BACK bytes, if the
    neighbour is not known."""
    row = np.searchsorted(bounds, starts, "right")
    same = row[1:] == row[:-1]
    pair = np.flatnonzero(known[:-1] & known[1:] & same)
    after = np.flatnonzero(known[:-1] & ~known[1:] & same)
    before = np.flatnonzero(~known[:-1] & known[1:] & same) + 1
    word, wide = np.append(IS_WORD[part], False), np.append(part >= 0xE0, False)
    apart = np.zeros(len(part) + 1, bool)
    apart[bounds] = True
    last = np.concatenate([[False], word[:-1]])
    stop, begin = last & (~word | apart) | wide | apart, word & (~last | apart) | wide | apart
    i, to = _within(stop, ends[after] + 1, ends[after + 1])
    back = np.maximum(starts[before] - BACK, bounds[row[before] - 1])
    j, since = _within(begin, back, starts[before] - 1)
    low = np.concatenate([starts[pair], starts[after][i], since])
    high = np.concatenate([ends[pair + 1], to, ends[before][j]])
    return low, high


def _united(
    row: np.ndarray, first: np.ndarray, points: np.ndarray, place: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The stretches with those of the same row and `first` united that overlap by LEAST_CHUNK bytes."""
    order = np.lexsort((place, first, row))
    row, first, points, place = row[order], first[order], points[order], place[order]
    other = np.ones(len(row), bool)
    other[1:] = (row[1:] != row[:-1]) | (first[1:] != first[:-1])
    low, start = place >> 32, points >> 32
    high, stop = low + (place & LENGTH), start + (points & LENGTH)
    reach = np.maximum.accumulate(np.cumsum(other) << 32 | high) & LENGTH
    begins = other.copy()
    begins[1:] |= low[1:] > reach[:-1] - LEAST_CHUNK
    at = np.flatnonzero(begins)
    low, start = low[at], start[at]
    high, stop = (np.maximum.reduceat(x, at) if len(at) else x for x in (high, stop))
    return row[at], first[at], start << 32 | stop - start, low << 32 | high - low


def _bucket(digests: np.ndarray) -> np.ndarray:
    return (digests >> np.uint64(64 - HOT_BITS)).astype(np.int64)


def repeated_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_BYTES
) -> DataFrame:
    """(id, start, length, n_bytes, first): the stretches of at least `least` bytes that occur in another
    row too, in code points of the text as it is; `n_bytes` counts them with A-Z lower-cased and single
    spaces, as rows are compared. `first` says that this row holds the stretch first, so that it stays;
    the others can go (`drop_repeats`).

    Texts are cut into chunks by content. Digests held by two rows are noted in a bitmap of bounded size.
    A second scan emits, where the bitmap passes, the digest of each two neighbouring chunks, and at the
    end of such a run the chunk with each whole word that follows or precedes it in the next chunk.
    They meet by digest in one exchange; frequent ones are bundled by digest in each batch instead and counted
    with partial sums. If few digests of them are shared, those are broadcast and their claims united where
    they lie, else each bundle is joined once with its count. Those that another
    row holds are united where they overlap by a chunk. So a stretch needs one whole chunk to be found, and
    each two chunks of it stand together in another row; its ends are those of whole words. Where the
    bitmap fills up, more is emitted, and an end may lie a chunk short. A stretch without two cuts inside is missed; the tests
    state the share by length.

    Null and short texts have no stretches, repeated rows repeat each other, stretches repeated inside one
    row alone are left. Texts of any length are read whole and never shuffled; other columns are not read.
    """
    if least <= MOST_CHUNK:
        raise ValueError(f"a shared stretch is longer than a chunk of {MOST_CHUNK} bytes")
    kind = docs.schema[id_col].dataType.simpleString()

    def chunks(batches: Iterator[pa.RecordBatch], column: int):
        """(row number, batch, rows, raw bytes and offsets, bytes, places, bounds, chunks) by row ranges."""
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            data, off = buffers(batch.column(column))
            for low, high in pieces(off):
                raw, raw_off = data[off[low] : off[high]], off[low : high + 1] - off[low]
                part, sizes, kept = normalised(raw, raw_off)
                ends = chunk_ends(part, sizes)
                starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)[: len(ends)]
                bounds = np.concatenate([[0], np.cumsum(sizes)])
                yield row, batch, low, high, (raw, raw_off), part, kept, bounds, starts, ends
                row += high - low

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, _, _, _, _, part, _, bounds, starts, ends in chunks(batches, 0):
            some = ends - starts >= LEAST_CHUNK
            digests = span_hashes(part, starts[some], ends[some]).view(np.int64)
            rows = row + np.searchsorted(bounds, starts[some], "right") - 1
            yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(digests)], names=["row", "digest"])

    twice = cut(
        docs.select(text_col)
        .mapInArrow(name, "row long, digest long")
        .groupBy("digest")
        .agg(F.min("row").alias("lo"), F.max("row").alias("hi"))
        .filter("lo <> hi")
        .select("digest")
    )
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(bitmaps.build(twice, "digest", bitmaps.bits_for(twice.count())))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, rows = np.zeros(1 << HOT_BITS, np.int32), 0
        for row, batch, low, high, (raw, raw_off), part, kept, bounds, starts, ends in chunks(batches, 1):
            known = bitmaps.passes(held.value, span_hashes(part, starts, ends)) & (ends - starts >= LEAST_CHUNK)
            a, b = _claims(part, bounds, starts, ends, known)
            where = np.searchsorted(bounds, a, "right") - 1
            order = np.argsort(where, kind="stable")
            a, b, where = a[order], b[order], where[order]
            points = np.concatenate([[0], np.cumsum(raw & 0xC0 != 0x80)])
            base = points[raw_off[where]]
            start, stop = points[kept[a]] - base, points[kept[b - 1] + 1] - base
            digests = span_hashes(part, a, b)
            np.add.at(counts, _bucket(digests), 1)
            rows += high - low
            count = np.bincount(where, minlength=high - low)
            cuts = pa.array(np.concatenate([[0], np.cumsum(count)]).astype(np.int32))
            flats = (start << 32 | stop - start, (a - bounds[where]) << 32 | b - a, digests.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(row, row + high - low)),
                    batch.column(0)[low:high],
                    *(pa.ListArray.from_arrays(cuts, pa.array(flat)) for flat in flats),
                    pa.nulls(high - low, pa.list_(pa.int64())),
                ],
                names=["row", "id", *fields, "hot"],
            ).filter(pa.array(count > 0))
        hot = np.flatnonzero(counts >= max(HOT_LEAST, rows // HOT_SHARE))
        if len(hot):
            none = [pa.nulls(1, pa.int64()), pa.nulls(1, batch.column(0).type), *[pa.nulls(1, pa.list_(pa.int64()))] * 3]
            yield pa.RecordBatch.from_arrays([*none, pa.array([hot])], names=["row", "id", *fields, "hot"])

    # code points: start and length; bytes: low and length; each two numbers in one
    fields = ["points", "place", "digest"]
    scanned = cut(
        docs.select(id_col, text_col).mapInArrow(
            scan, f"row long, id {kind}, " + ", ".join(f"{f} array<long>" for f in [*fields, "hot"])
        )
    )
    buckets = scanned.filter("row IS NULL").select(F.explode("hot").alias("bucket")).distinct().toArrow()
    hot = np.zeros(1 << HOT_BITS, bool)
    hot[buckets.column("bucket").to_numpy()] = True
    frequent = spark.sparkContext.broadcast(np.packbits(hot))

    def claims(batches: Iterator[pa.RecordBatch], which: bool) -> Iterator[list[np.ndarray]]:
        """Row, points, place and digest of a batch's claims in frequent buckets, or of the others."""
        marked = np.unpackbits(frequent.value).astype(bool)
        for batch in batches:
            rows = np.repeat(batch.column(0).to_numpy(), batch.column(1).value_lengths().to_numpy())
            columns = [rows, *(batch.column(i).flatten().to_numpy() for i in (1, 2, 3))]
            keep = marked[_bucket(columns[3].view(np.uint64))] == which
            yield [column[keep] for column in columns]

    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in claims(batches, False):
            yield pa.RecordBatch.from_arrays([pa.array(column) for column in found], names=["row", *fields])

    def bundled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row for each frequent digest of a batch, with all its claims there."""
        for found in claims(batches, True):
            order = np.argsort(found[3], kind="stable")
            digests, begins = np.unique(found[3][order], return_index=True)
            cuts = pa.array(np.append(begins, len(order)).astype(np.int32))
            lists = (pa.ListArray.from_arrays(cuts, pa.array(column[order])) for column in found[:3])
            yield pa.RecordBatch.from_arrays([*lists, pa.array(digests)], names=["row", *fields])

    first = (F.col("lo") == F.col("row")).alias("first")
    same = Window.partitionBy("digest")
    told = scanned.filter("row IS NOT NULL").select("row", *fields)
    hits = (
        told.mapInArrow(single, "row long, points long, place long, digest long")
        .withColumn("lo", F.min("row").over(same))
        .withColumn("hi", F.max("row").over(same))
        .filter("lo <> hi")
        .select("row", "points", "place", first)
    )
    if hot.any():
        each = told.mapInArrow(bundled, "row array<long>, points array<long>, place array<long>, digest long")
        shared = cut(
            each.groupBy("digest")
            .agg(
                F.min(F.array_min("row")).alias("lo"),
                F.max(F.array_max("row")).alias("hi"),
                F.sum(F.size("row")).alias("n"),
            )
            .filter("lo <> hi")
            .select("digest", "lo", "n")
        )
        if shared.count() <= BROADCAST_KEYS:
            facts = shared.select("digest", "lo").orderBy("digest").toArrow()
            facts = spark.sparkContext.broadcast([facts.column(name).to_numpy() for name in ("digest", "lo")])

            def united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                """The frequent claims that another row holds, united in their rows as all are below."""
                digests, lows = facts.value
                for row, points, place, digest in claims(batches, True):
                    at = np.searchsorted(digests, digest)
                    held = np.append(digests, 0)[at] == digest
                    held &= at < len(digests)
                    lo = lows[at[held]]
                    row, begins, points, place = _united(row[held], row[held] == lo, points[held], place[held])
                    flats = [pa.array(column) for column in (row, points, place, begins)]
                    yield pa.RecordBatch.from_arrays(flats, names=["row", "points", "place", "first"])

            often = told.mapInArrow(united, "row long, points long, place long, first boolean")
        else:
            often = attach(each, shared, "digest", F.col("row")[0], size="n")
            often = often.select("lo", F.inline(F.arrays_zip("row", "points", "place")))
            often = often.select("row", "points", "place", first)
        hits = hits.union(often)
    low, start = F.shiftright("place", 32), F.shiftright("points", 32)
    high, stop = (x + F.col(c).bitwiseAND(F.lit(LENGTH)) for x, c in ((low, "place"), (start, "points")))
    order = Window.partitionBy("row", "first").orderBy("place")
    reach = F.max(high).over(order.rowsBetween(Window.unboundedPreceding, -1))
    runs = (
        hits.withColumn("apart", F.coalesce(low > reach - LEAST_CHUNK, F.lit(False)).cast("int"))
        .withColumn("run", F.sum("apart").over(order))
        .groupBy("row", "first", "run")
        .agg(
            F.min(start).alias("start"),
            (F.max(stop) - F.min(start)).alias("length"),
            (F.max(high) - F.min(low)).alias("n_bytes"),
        )
        .filter(F.col("n_bytes") >= least)
    )
    return runs.join(scanned.select("row", "id"), "row").select(
        F.col("id").alias(id_col), "start", "length", "n_bytes", "first"
    )


def drop_repeats(docs: DataFrame, text_col: str = "text", least: int = LEAST_BYTES) -> DataFrame:
    """The rows of `docs` with the later copies of repeated stretches cut out of the text: each stays with
    the row that holds it first. A null text stays null; a row that repeats others whole is empty.
    Rows are numbered in a table in the shared folder; it is joined with the stretches to go by row."""
    row, gone = unused(docs, "row"), unused(docs, "gone")
    numbered = cut(docs.withColumn(row, F.monotonically_increasing_id()))
    later = (
        repeated_spans(numbered, row, text_col, least)
        .filter(~F.col("first"))
        .groupBy(row)
        .agg(F.sort_array(F.collect_list(F.struct("start", "length"))).alias(gone))
    )
    text, spans = F.col(text_col), F.col(gone)

    def between(i):
        last, following = F.get(spans, i - 1), F.get(spans, i)
        low = F.coalesce(last["start"] + last["length"], F.lit(0))
        high = F.coalesce(following["start"], F.length(text).cast("long"))
        return F.substr(text, (low + 1).cast("int"), (high - low).cast("int"))

    left = F.array_join(F.transform(F.sequence(F.lit(0), F.size(spans)), between), "")
    cleaned = F.when(spans.isNull(), text).otherwise(left)
    return numbered.join(later, row, "left").withColumn(text_col, cleaned).select(*docs.columns)
