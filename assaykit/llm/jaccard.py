"""N-gram Jaccard join: prefix buckets, size-banded tiles of bitmap signatures, exact intersection."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assaykit.llm import bitmaps
from assaykit.llm.rowlists import even_share, without
from assaykit.llm.textbytes import LOWER, buffers, mix, pieces, ragged, row_of, run_hashes, span_hashes, word_spans
from assaykit.operators.components import connected_components
from assaykit.operators.skew import attach
from assaykit.session import cut

WORDS = 5
HOT_BITS = 22
HOT_SHARE = 1000
HOT_LEAST = 8
SALT_BITS = 12
SALTS = 16
ROWS_PER_SALT = 1_000_000
SLICE = 2048
SIGNED = 64
LISTED = 500_000
SEEN = 1_000_000
FOLD = np.uint64(0x9E3779B97F4A7C15)

IS_WORD = np.ones(256, bool)
IS_WORD[[32, *range(9, 14)]] = False


def shingle_sets(part: np.ndarray, off: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, sizes): the distinct hashed shingles of each row in ascending order, row after row.
    A row of fewer words has one shingle of all of them; a row without words has none."""
    part = LOWER[part]
    starts, ends, first = word_spans(part, off, IS_WORD)
    hashes, row, n = span_hashes(part, starts, ends), row_of(first), np.diff(first)
    tokens = [run_hashes(hashes, words)]
    rows = [row[: len(tokens[0])]]
    whole = rows[0] == row[words - 1 :][: len(rows[0])]
    tokens[0], rows[0] = tokens[0][whole], rows[0][whole]
    for k in range(1, words):
        short = np.flatnonzero(n == k)
        if len(short):
            runs = run_hashes(hashes, k)[first[:-1][short]]
            tokens.append(mix(runs ^ np.uint64(k)))
            rows.append(short)
    token, row = np.concatenate(tokens), np.concatenate(rows)
    order = np.argsort(token)
    token, row = token[order], row[order]
    order = np.argsort(row.astype(np.uint16) if len(n) < 1 << 16 else row, kind="stable")
    token, row = token[order], row[order]
    new = np.ones(len(token), bool)
    new[1:] = (token[1:] != token[:-1]) | (row[1:] != row[:-1])
    return token[new], np.bincount(row[new], minlength=len(n))


def set_hashes(tokens: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each set, whatever the order; 0 for an empty one."""
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(tokens ^ FOLD))])
    ends = np.cumsum(sizes)
    return mix(sums[ends] - sums[ends - sizes])


def _needed(size: np.ndarray, num: int, den: int) -> np.ndarray:
    """The least number of tokens a set of this size shares with a similar one."""
    return -(-size * num // den)


def _scan(batches: Iterator[pa.RecordBatch], column: int):
    """(batch, first row, tokens, sizes, set hashes) by row ranges of a text column."""
    for batch in batches:
        data, off = buffers(batch.column(column))
        for low, high in pieces(off):
            tokens, sizes = shingle_sets(data[off[low] : off[high]], off[low : high + 1] - off[low])
            yield batch, low, tokens, sizes, set_hashes(tokens, sizes)


class _Seen:
    """Whether a set came before in this task; forgets all when full, which only costs work."""

    def __init__(self):
        self.sets: set[int] = set()

    def new(self, hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        if len(self.sets) > SEEN:
            self.sets.clear()
        fresh = np.zeros(len(hashes), bool)
        for i, (h, n) in enumerate(zip(hashes.tolist(), sizes.tolist())):
            if n and h not in self.sets:
                self.sets.add(h)
                fresh[i] = True
        return fresh


def _facts(docs: DataFrame) -> DataFrame:
    """Per row: id, text hash, set size, set hash (`a`), and the set's signature where a task meets it
    first; and, with a null set size, counts of the token buckets that are frequent within a task."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen, rows = np.zeros(1 << HOT_BITS, np.int32), _Seen(), 0
        for batch, low, tokens, sizes, a in _scan(batches, 2):
            n = len(sizes)
            fresh = seen.new(a, sizes)
            rows += int(fresh.sum())
            own = tokens[np.repeat(fresh, sizes)]
            np.add.at(counts, (own >> np.uint64(64 - HOT_BITS)).astype(np.int64), 1)
            ends = np.cumsum(sizes)
            sigs = [
                signature(tokens[e - m : e]) if f else None
                for e, m, f in zip(ends.tolist(), sizes.tolist(), fresh.tolist())
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0)[low : low + n],
                    batch.column(1)[low : low + n],
                    pa.array(sizes.astype(np.int64)),
                    pa.array(a.view(np.int64)),
                    pa.array(sigs, pa.binary()),
                    pa.nulls(n, pa.int64()),
                    pa.nulls(n, pa.int64()),
                ],
                names=names,
            )
        hot = np.flatnonzero(counts >= max(HOT_LEAST, rows // HOT_SHARE))
        if len(hot):
            none = pa.nulls(len(hot), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(hot), kind), none, none, none, pa.nulls(len(hot), pa.binary()), pa.array(hot), pa.array(counts[hot].astype(np.int64))],
                names=names,
            )

    names = ["id", "text_hash", "size", "a", "sig", "bucket", "n"]
    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(docs.schema["id"].dataType)
    sql = f"id {docs.schema['id'].dataType.simpleString()}, text_hash long, size long, a long, sig binary, bucket long, n long"
    return docs.select("id", "text_hash", "text").mapInArrow(scan, sql)


def _hot_buckets(facts: DataFrame, n_sets: int) -> np.ndarray:
    """A bitmap over 2^HOT_BITS token buckets of those in about one set of 2 * HOT_SHARE or more."""
    least = max(HOT_LEAST, n_sets // (2 * HOT_SHARE))
    rows = (
        facts.filter("size IS NULL").groupBy("bucket").agg(F.sum("n").alias("n")).filter(F.col("n") >= least).select("bucket").toArrow()
    )
    out = np.zeros(1 << HOT_BITS, bool)
    out[rows.column("bucket").to_numpy()] = True
    return np.packbits(out)


def _postings(docs: DataFrame, hot: np.ndarray, num: int, den: int, salts: int) -> DataFrame:
    """(key, a): the first tokens of each set in one order for all sets, frequent buckets last,
    enough of them that similar sets share one. The low bits of a key are 0 for a rare token and hold
    a salt for a frequent one."""
    packed = docs.sparkSession.sparkContext.broadcast(hot)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, seen = np.unpackbits(packed.value).astype(bool), _Seen()
        for _, _, tokens, sizes, a in _scan(batches, 0):
            fresh = seen.new(a, sizes)
            tokens, a, sizes = tokens[np.repeat(fresh, sizes)], a[fresh], sizes[fresh]
            if not len(sizes):
                continue
            row = np.repeat(np.arange(len(sizes)), sizes)
            late = frequent[(tokens >> np.uint64(64 - HOT_BITS)).astype(np.int64)]
            take = sizes - _needed(sizes, num, den) + 1
            early = np.concatenate([[0], np.cumsum(~late)])
            first = np.cumsum(sizes) - sizes
            rare = early[first + sizes] - early[first]
            place = np.arange(len(tokens)) - first[row]
            rank = np.where(late, rare[row] + place - (early[:-1] - early[first][row]), early[:-1] - early[first][row])
            keep = rank < take[row]
            low = np.uint64((1 << SALT_BITS) - 1)
            key = tokens[keep] & ~low
            salt = (a[row[keep]] % np.uint64(salts)) << np.uint64(1) | np.uint64(1)
            key |= np.where(late[keep], salt, np.uint64(0))
            per = np.bincount(row[keep], minlength=len(sizes))
            bounds = np.concatenate([[0], np.cumsum(per)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(a.view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(bounds), pa.array(key.view(np.int64))),
                ],
                names=["a", "keys"],
            )

    found = docs.select("text").mapInArrow(scan, "a long, keys array<long>")
    return found.select(F.explode("keys").alias("key"), "a")


def signature(tokens: np.ndarray) -> bytes:
    """A bitmap with a bit for each token; its length is the power of two above twice the size."""
    bits = 1 << max(6, min(17, (2 * len(tokens) - 1).bit_length()))
    out = np.zeros(bits, np.uint8)
    out[(tokens & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(out, bitorder="little").tobytes()


def _token_sets(docs: DataFrame, nodes: DataFrame, per_set: DataFrame) -> DataFrame:
    """(a, tokens) of the given sets; repeated rows may repeat one. The scan passes over rows whose hash
    of id and text is not in a bitmap of one row a set, so only few texts are cut into shingles again and none is shuffled."""
    wanted = nodes.join(per_set, "a").select(F.xxhash64("one.id", "one.text_hash").alias("h"))
    bitmap = docs.sparkSession.sparkContext.broadcast(bitmaps.build(wanted, "h"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _Seen()

        def chosen() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                good = bitmaps.passes(bitmap.value, batch.column(0).to_numpy())
                yield batch.filter(pa.array(good))

        for _, _, tokens, sizes, a in _scan(chosen(), 1):
            fresh, ends = seen.new(a, sizes), np.cumsum(sizes)
            at = np.flatnonzero(fresh)
            data = [tokens[ends[i] - sizes[i] : ends[i]].tobytes() for i in at]
            yield pa.RecordBatch.from_arrays(
                [pa.array(a[at].view(np.int64)), pa.array(data, pa.binary())], names=["a", "tokens"]
            )

    found = docs.select(F.xxhash64("id", "text_hash").alias("h"), "text").mapInArrow(scan, "a long, tokens binary")
    return found.join(nodes, "a", "left_semi")


def _passing(rows: DataFrame, wanted: DataFrame, column: str) -> DataFrame:
    """The rows whose first column, a hash, passes a bitmap of fixed size over those in `column` of
    `wanted`, so that few others take part in the joins that follow."""
    bitmap = rows.sparkSession.sparkContext.broadcast(bitmaps.build(wanted, column))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(bitmaps.passes(bitmap.value, batch.column(0).to_numpy())))

    return rows.mapInArrow(scan, rows.schema)


def _folded(sigs: list[bytes], bits: int) -> np.ndarray:
    """Signatures as rows of 64-bit words, longer ones folded to `bits`."""
    out = np.zeros((len(sigs), bits // 64), np.uint64)
    for i, sig in enumerate(sigs):
        out[i] = np.bitwise_or.reduce(np.frombuffer(sig, np.uint64).reshape(-1, bits // 64), axis=0)
    return out


def overlap_bound(left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray) -> np.ndarray:
    """The most tokens that two sets can share: a bit of one that the other lacks stands for a token
    that the other lacks."""
    lone = np.bitwise_count(left & ~right).sum(-1, dtype=np.int64)
    return np.minimum(n_left - lone, n_right - np.bitwise_count(right & ~left).sum(-1, dtype=np.int64))


def _similar(shared: np.ndarray, n_left: np.ndarray, n_right: np.ndarray, num: int, den: int) -> np.ndarray:
    return den * shared >= num * (n_left + n_right - shared)


def _verify(
    pairs: DataFrame, sets: DataFrame, docs: DataFrame, per_set: DataFrame, num: int, den: int
) -> DataFrame:
    """The pairs (a, b) that reach the threshold: sizes, then signatures, then the whole sets."""

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sa, sb = batch.column(4).to_pylist(), batch.column(5).to_pylist()
            na, nb = (batch.column(i).to_numpy().astype(np.int64) for i in (2, 3))
            bits = np.minimum([8 * len(s) for s in sa], [8 * len(s) for s in sb])
            keep = np.zeros(len(sa), bool)
            for b in np.unique(bits):
                at = np.flatnonzero(bits == b)
                left, right = (_folded([s[i] for i in at], int(b)) for s in (sa, sb))
                keep[at] = _similar(overlap_bound(left, right, na[at], nb[at]), na[at], nb[at], num, den)
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(keep)) for i in (0, 1)], names=["a", "b"])

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for left, right in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (left, right))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(bool(_similar(both, len(x), len(y), num, den)))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(mask) for i in (0, 1)], names=["a", "b"])

    def ends(frame: DataFrame, known: DataFrame, *columns: str) -> DataFrame:
        for side in ("a", "b"):
            facts = known.select(F.col("a").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in columns])
            frame = frame.join(facts, side)
        order = [f"{c}_{side}" for c in columns for side in ("a", "b")]
        return frame.select("a", "b", *order)

    pairs = cut(pairs)
    known = cut(_passing(sets, pairs.select("a").union(pairs.select("b")), "a"))
    near = cut(ends(pairs, known, "size", "sig").mapInArrow(bound, "a long, b long"))
    nodes = cut(near.select("a").union(near.select("b")).distinct())
    tokens = cut(_token_sets(docs, nodes, per_set)).dropDuplicates(["a"])
    return cut(ends(near, tokens, "tokens").mapInArrow(exact, "a long, b long").distinct())


def _live(postings: DataFrame, sizes: DataFrame, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """(a, b) of the pairs that meet in buckets of their own and can be similar, and (bucket, a, size,
    reach, pivot) of the wider buckets that can hold a similar pair.

    A posted token that no other set posted counts against its set, which bounds the size of a partner
    (`reach`). The partner may still hold the token beyond its own first ones, so of two sets the bound
    holds only for the one whose first tokens end first in the common order; which one that is is not
    carried, so a pair passes when either reaches the other's size. A similar partner has at least the
    size `needed`: a bucket in which no member reaches that is done, and so is a member that neither
    reaches it nor is reached by the bucket's farthest. The member with the largest reach for its size
    is the pivot. So texts that share a passage and little else mostly meet nowhere.

    Most buckets hold two sets. They are counted by pair, so one row stands for all of a pair; a token
    that a set shares with others alone does not count for the pair, nor more than those of the best
    partner for a wider bucket.
    """
    same_key = Window.partitionBy("key")
    other = (F.col("a") != F.col("first")) & (F.col("a") != F.col("last"))
    shared = cut(
        postings.withColumn("first", F.min("a").over(same_key))
        .withColumn("last", F.max("a").over(same_key))
        .filter((F.col("first") != F.col("last")) | (F.col("key") % 2 != 0))
        .withColumn("wide", F.coalesce(F.max(other).over(same_key), F.lit(False)) | (F.col("key") % 2 != 0))
        .select("key", "a", F.when(~F.col("wide"), F.col("last")).alias("b"))
        .filter("b IS NULL OR a <> b")
        .distinct()
    )
    wide = shared.filter("b IS NULL").select("key", "a")
    twos = cut(shared.filter("b IS NOT NULL").groupBy("a", "b").agg(F.count("*").alias("n")))
    size, most = F.col("size").cast("long"), F.col("most")
    needed = F.expr(f"(cast(size as long) * {num} + {den - 1}) div {den}")
    each = cut(
        wide.groupBy("a")
        .agg(F.count("*").alias("wide"), F.lit(0).cast("long").alias("n"))
        .union(twos.select("a", F.lit(0), "n"))
        .union(twos.select("b", F.lit(0), "n"))
        .groupBy("a")
        .agg(F.sum("wide").alias("wide"), F.max("n").alias("n"))
        .join(sizes, "a")
        .withColumn("most", needed - 1 + F.col("wide"))
        .select("a", "size", "most", F.expr(f"((most + n) * {num + den}) div {num}") - size)
        .toDF("a", "size", "most", "reach")
    )
    pairs = twos
    for side in ("a", "b"):
        pairs = pairs.join(each.select(F.col("a").alias(side), size.alias(f"size_{side}"), most.alias(f"most_{side}")), side)
    reaches = [
        F.expr(f"((most_{x} + n) * {num + den}) div {num} - size_{x}") >= F.col(f"size_{y}") for x, y in ("ab", "ba")
    ]
    small, large = F.least("size_a", "size_b"), F.greatest("size_a", "size_b")
    pairs = cut(pairs.filter((small * den >= large * num) & (reaches[0] | reaches[1])).select("a", "b"))
    rows = wide.join(each.drop("most"), "a").select(
        F.shiftright("key", SALT_BITS).alias("bucket"), "a", "size", "reach"
    )
    # the member with the largest share of common tokens is the likeliest origin of its neighbours
    first = F.struct((-F.expr("reach * 1000 div size")).alias("rank"), "a", "size", "reach")
    reaches = F.col("reach") >= needed
    pivots = (
        rows.groupBy("bucket")
        .agg(
            F.min(F.when(reaches, first)).alias("pivot"),
            F.max("reach").alias("farthest"),
            F.count("*").alias("n"),
        )
        .filter("pivot IS NOT NULL AND n > 1")
        .select("bucket", "pivot", "farthest")
    )
    live = cut(rows.join(pivots, "bucket").filter(reaches | (F.col("size") <= F.col("farthest"))).drop("farthest"))
    return pairs, live


def _star_pairs(live: DataFrame, num: int, den: int) -> DataFrame:
    """Each member of a bucket with the bucket's pivot, within the size bounds."""
    p = F.col("pivot")
    small, large = F.least("size", p["size"]), F.greatest("size", p["size"])
    return (
        live.filter(
            (F.col("a") != p["a"])
            & (small * den >= large * num)
            & ((F.col("size") <= p["reach"]) | (p["size"] <= F.col("reach")))
        )
        .select(F.least("a", p["a"]).alias("a"), F.greatest("a", p["a"]).alias("b"))
        .distinct()
    )


def _bands(num: int, den: int) -> list[int]:
    """Lower ends of the size bands: a set and a similar larger one are in one band or neighbours."""
    out = [1]
    while out[-1] < 1 << 31:
        out.append(out[-1] * den // num + 1)
    return out


def _listed(df: DataFrame) -> DataFrame:
    """A small table, written and counted: broadcast up to LISTED narrow rows, joined as any other
    beyond."""
    df = cut(df)
    return F.broadcast(df) if df.count() <= LISTED else df


def _tile_pairs(
    live: DataFrame, labels: DataFrame, sets: DataFrame, num: int, den: int
) -> DataFrame:
    """Pairs of different components that share as many buckets as similar sets of their sizes do.

    A bucket whose members are all in one component is done, and of open buckets with the same
    members one is compared, for all of them. A bucket of up to SLICE members is one tile. A larger one
    is cut into tiles: a size band and the next above, in which
    slices of the largest component each meet slices of the other members, and those meet each other,
    so a tile has two slices at most and members of the largest component are never paired among
    themselves. A pair meets once in each bucket that it shares; its buckets are counted, and must make up
    for the tokens that the first ones leave out. Signatures travel with the members of buckets above
    SIGNED and bound a pair at once.
    """
    named = (
        live.select("bucket", "a", "size", "reach")
        .join(_listed(labels.select(F.col("node").alias("a"), "component")), "a", "left")
        .withColumn("component", F.coalesce("component", "a"))
    )
    # one narrow exchange finds the buckets to compare; components are counted in those alone
    chosen = (
        named.groupBy("bucket")
        .agg(
            F.count("*").alias("n"),
            F.bit_xor(F.xxhash64("a")).alias("h"),
            F.min("component").alias("low"),
            F.max("component").alias("high"),
        )
        .filter("low < high")
        .groupBy("n", "h")
        .agg(F.min("bucket").alias("bucket"), F.count("*").alias("weight"))
        .select("bucket", "n", "weight")
    )
    compared = cut(named.join(_listed(chosen), "bucket"))
    mains = (
        compared.filter(F.col("n") > SLICE).groupBy("bucket", "n", "component")
        .agg(F.count("*").alias("m"))
        .groupBy("bucket", "n")
        .agg(F.max(F.struct("m", "component")).alias("most"))
        .select(
            "bucket",
            F.col("most.component").alias("main"),
            F.ceil(F.col("most.m") / SLICE).cast("int").alias("main_slices"),
            F.ceil((F.col("n") - F.col("most.m")) / SLICE).cast("int").alias("rest_slices"),
        )
    )
    members = cut(compared.filter(F.col("n") > SLICE).drop("n").join(_listed(mains), "bucket"))
    is_main = F.col("component") == F.col("main")
    own = F.pmod(F.xxhash64("a"), F.when(is_main, F.col("main_slices")).otherwise(F.col("rest_slices"))).cast("int")

    def place(kind: int, i, j):
        return F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"))

    rest = F.sequence(F.lit(0), F.col("rest_slices") - 1)
    against_main = F.transform(F.sequence(F.lit(0), F.col("main_slices") - 1), lambda i: place(0, i, F.col("own")))
    among_rest = F.transform(rest, lambda j: place(1, F.least(j, F.col("own")), F.greatest(j, F.col("own"))))
    places = F.when(is_main, F.transform(rest, lambda j: place(0, F.col("own"), j))).otherwise(
        F.concat(against_main, among_rest)
    )
    ends = F.array(*[F.lit(e) for e in _bands(num, den)])
    band = F.size(F.filter(ends, lambda e: e <= F.col("size").cast("long")))
    bases = F.array(F.col("band"), F.col("band") - 1)
    keys = ["bucket", "base", "kind", "i", "j"]
    columns = [*keys, "band", "own", "c", "main", "a", "size", "reach", "weight", "sig"]
    known = cut(_passing(sets, compared.filter(F.col("n") > SIGNED), "a")).select("a", "sig")
    tiles = (
        members.withColumn("own", own)
        .withColumn("band", band)
        .select("*", F.explode(places).alias("p"))
        .select("*", "p.*", F.explode(bases).alias("base"))
        .withColumn("c", F.col("component"))
        .withColumn("main", is_main)
        .join(known, "a")
        .select(*columns)
    )
    zero = F.lit(0)
    whole = compared.filter(F.col("n") <= SLICE).select(
        "bucket", zero.alias("base"), F.lit(2).alias("kind"), zero.alias("i"), zero.alias("j"), zero.alias("band"),
        zero.alias("own"), F.col("component").alias("c"), F.lit(False).alias("main"), "a", "size", "reach", "weight", "n",
    )
    none = F.lit(None).cast("binary").alias("sig")
    small = whole.filter(F.col("n") <= SIGNED).select(*columns[:-1], none)
    medium = whole.filter(F.col("n") > SIGNED).join(known, "a").select(*columns)

    def compare(table: dict[str, np.ndarray], sigs: list[bytes]) -> list[np.ndarray]:
        kind, i, j, base = (int(table[c][0]) for c in ("kind", "i", "j", "base"))
        if kind == 0:
            left, right = np.flatnonzero(table["main"]), np.flatnonzero(~table["main"])
        elif kind == 1:
            left, right = np.flatnonzero(table["own"] == i), np.flatnonzero(table["own"] == j)
        else:
            left = right = np.arange(len(sigs))
        if not len(left) or not len(right):
            return [np.zeros(0, np.int64)] * 4
        signed = sigs[0] is not None
        rows = _folded(sigs, min(8 * len(s) for s in sigs)) if signed else None
        c, a, size, band, reach = (table[n].astype(np.int64) for n in ("c", "a", "size", "band", "reach"))
        out = []
        step = max(1, (1 << 20) // len(right))
        for low in range(0, len(left), step):
            x = left[low : low + step]
            ok = (c[x][:, None] != c[right][None]) & (
                (band[x][:, None] == base) | (band[right][None] == base)
            )
            if kind and i == j:
                ok &= a[x][:, None] < a[right][None]
            one, two = size[x][:, None], size[right][None]
            ok &= (np.minimum(one, two) * den >= np.maximum(one, two) * num) & ((two <= reach[x][:, None]) | (one <= reach[right][None]))
            p, q = np.nonzero(ok)
            chunk = max(1, (1 << 22) // rows.shape[1]) if signed else 1 << 20
            for at in range(0, len(p), chunk):
                l, r = x[p[at : at + chunk]], right[q[at : at + chunk]]
                if signed:
                    most = overlap_bound(rows[l], rows[r], size[l], size[r])
                    good = _similar(most, size[l], size[r], num, den)
                    l, r = l[good], r[good]
                out.append((l, r))
        l, r = (np.concatenate([o[k] for o in out] or [np.zeros(0, np.int64)]).astype(np.int64) for k in (0, 1))
        both = -(-num * (size[l] + size[r]) // (num + den))
        least = both - _needed(np.maximum(size[l], size[r]), num, den) + 1
        return [np.minimum(a[l], a[r]), np.maximum(a[l], a[r]), least, np.full(len(l), int(table["weight"][0]))]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Tiles come one after another, sorted; the last of a batch may go on in the next."""
        held: list[pa.RecordBatch] = []

        def done(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(rows).combine_chunks()
            columns = {n: table.column(n).to_numpy() for n in table.column_names if n != "sig"}
            sigs = table.column("sig").to_pylist()
            marks = np.flatnonzero(np.any([columns[k][1:] != columns[k][:-1] for k in keys], axis=0)) + 1
            found = []
            for low, high in zip([0, *marks.tolist()], [*marks.tolist(), len(table)]):
                if high - low > 1:
                    found.append(compare({n: v[low:high] for n, v in columns.items()}, sigs[low:high]))
            none = [np.zeros(0, np.int64)]
            out = [np.concatenate([f[k] for f in found] or none) for k in range(4)]
            return pa.RecordBatch.from_arrays([pa.array(v) for v in out], names=names)

        def tile(batch: pa.RecordBatch, at: int) -> tuple:
            return tuple(batch.column(k)[at].as_py() for k in keys)

        for batch in batches:
            if not len(batch):
                continue
            last = tile(batch, len(batch) - 1)
            start = len(batch) - 1
            while start > 0 and tile(batch, start - 1) == last:
                start -= 1
            if held and start == 0 and tile(held[-1], 0) == last:
                held.append(batch)
                continue
            ready = [*held, batch.slice(0, start)]
            yield done([r for r in ready if len(r)]) if any(len(r) for r in ready) else empty
            held = [batch.slice(start)]
        if held:
            yield done(held)

    names = ["a", "b", "least", "weight"]
    empty = pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 4, names=names)
    spread = small.union(medium).union(tiles).repartition(*keys).sortWithinPartitions(*keys)
    return (
        spread.mapInArrow(scan, ", ".join(f"{n} long" for n in names))
        .groupBy("a", "b")
        .agg(F.sum("weight").alias("weight"), F.max("least").alias("least"))
        .filter("weight >= least")
        .select("a", "b")
    )


def jaccard_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    num: int = 75,
    den: int = 100,
) -> DataFrame:
    """(id, text_hash, n_shingles, component, component_id) per row: documents linked, directly or
    through others, when den * |A and B| >= num * |A or B| over their sets of five-word shingles.

    Words are runs of anything but ASCII white space, A-Z lower-cased; a text with fewer words has its
    whole sequence as one shingle. Null and empty texts have an empty set and are their own component.
    A component's id is its smallest document id; documents without id are linked too and take it.
    `component` is a key of the component that is null for empty sets only.
    Repeated rows give repeated results. Texts are read whole.

    1. Equal sets collapse. Token buckets in more than about one set of 1,000 are noted in a bitmap of
       fixed size. 2. In one order for all sets, frequent buckets last, each set posts its first tokens;
       similar sets share one. Only shared buckets stay, those of two sets as one counted pair. 3. Every
       member of the wider ones is checked against its bucket's first set, which settles families of
       copies in linear work, and so is every pair. 4. Wider buckets that still hold several
       components are compared in size-banded tiles: bit counts of signatures bound the overlap from
       above. 5. What passes is intersected exactly. Nothing is capped or sampled. Shingles and sets are
       known by 64-bit hashes.
    """
    own = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text")
    )
    facts = cut(_facts(own))
    rows = facts.filter("size IS NOT NULL").select("id", "text_hash", "size", "a")
    full = rows.filter("size > 0")
    per_set = cut(
        full.groupBy("a").agg(
            F.min("id").alias("least"),
            F.min(F.struct("id", "text_hash")).alias("one"),
            F.min("size").cast("int").alias("size"),
        )
    )
    n_sets = per_set.count()
    salts = min((1 << SALT_BITS - 1) - 1, max(SALTS, n_sets // ROWS_PER_SALT))
    postings = _postings(own, _hot_buckets(facts, n_sets), num, den, salts)
    twos, live = _live(postings, per_set.select("a", "size"), num, den)
    signed = facts.filter("sig IS NOT NULL").select("a", F.col("size").cast("int").alias("size"), "sig")
    met = cut(twos.select("a").union(twos.select("b")).union(live.select("a")).distinct())
    sets = cut(_passing(signed, met, "a").dropDuplicates(["a"]))
    compared = cut(_star_pairs(live, num, den).union(twos).distinct())
    stars = _verify(compared, sets, own, per_set, num, den)
    labels = connected_components(stars)
    others = _tile_pairs(live, labels, sets, num, den).join(compared, ["a", "b"], "left_anti")
    across = _verify(others, sets, own, per_set, num, den)
    merged = connected_components(
        labels.select(F.col("node").alias("a"), F.col("component").alias("b")).union(across)
    )
    grouped = per_set.join(merged, per_set["a"] == merged["node"], "left").select(
        "a", "least", F.coalesce("component", "a").alias("component")
    )
    grouped = cut(grouped)
    ids = cut(grouped.groupBy("component").agg(F.min("least").alias("component_id"), F.count("*").alias("n")))
    named = attach(
        grouped, ids, "component", F.col("a"), size="n", rows_per_task=even_share(docs, n_sets), total=n_sets
    ).select("a", "component", "component_id")
    return rows.withColumn("a", F.when(F.col("size") > 0, F.col("a"))).join(named, "a", "left").select(
        F.col("id").alias(id_col),
        "text_hash",
        F.col("size").alias("n_shingles"),
        "component",
        F.coalesce("component_id", "id").alias("component_id"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs`, with all their columns, that stay when one of each component does: the one
    with the smallest id (a null id last), of repeated rows one. Rows with an empty set all stay."""
    found = cut(jaccard_components(docs, id_col, text_col).filter("component IS NOT NULL"))
    first = cut(
        found.groupBy("component").agg(
            F.min(F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), "text_hash")).alias("f"),
            F.count("*").alias("n"),
        )
    )
    here = found.select("component", F.col(id_col).alias("_id"), F.col("text_hash").alias("_hash"))
    counted = cut(here.groupBy("component", "_id", "_hash").agg(F.count("*").alias("rows")))
    total = counted.count()
    stays = F.col("_id").eqNullSafe(F.col("f.id")) & (F.col("_hash") == F.col("f.text_hash"))
    each = cut(
        attach(counted, first, "component", F.xxhash64("_id", "_hash"), size="n", rows_per_task=even_share(docs, total), total=total)
        .withColumn("stays", stays)
        .select("_id", "_hash", "rows", "stays")
    )
    repeated = each.filter("stays AND rows > 1")
    if repeated.isEmpty():
        return without(docs, cut(each.filter("NOT stays").select("_id", "_hash")), id_col, text_col)
    again = repeated.select("_id", "_hash")
    again = F.broadcast(again) if again.count() <= LISTED else again
    same = docs[id_col].eqNullSafe(again["_id"]) & (F.xxhash64(docs[text_col]) == again["_hash"])
    once = docs.join(again, same, "left_semi").dropDuplicates([id_col, text_col])
    gone = cut(each.filter("NOT stays OR rows > 1").select("_id", "_hash"))
    return without(docs, gone, id_col, text_col).unionByName(once)
