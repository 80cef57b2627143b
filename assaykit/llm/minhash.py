"""Near duplicates by banded MinHash, sequential Bayesian verification of signatures and exact sets."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaykit.llm import bitmaps
from assaykit.llm.jaccard import set_hashes, shingle_sets
from assaykit.llm.textbytes import buffers, mix, pieces
from assaykit.operators.components import connected_components
from assaykit.operators.skew import ROWS_PER_TASK, attach
from assaykit.session import cut

WORDS = 2
NUM, DEN = 80, 100
BANDS = 32
BAND_ROWS = 5
HASHES = BANDS * BAND_ROWS
#: Hashes compared at a time; a signature keeps one byte of each.
BATCH = 32
BYTE = 256
#: A pair is dropped where the posterior chance that it reaches the threshold is below this.
MISS = 1e-6
#: Sets of a slice in a tile, and their tokens.
SLICE = 1024
SLICE_TOKENS = 2_000_000
#: Pairs of a tile that are intersected one by one, and columns of a matrix block where there are more.
FEW_PAIRS = 2_000
COLUMNS = 8192
#: The least number of rows for which a key is split over tasks.
LEAST_HOT = 1_000
SEEN = 1_000_000
_ODD = mix(np.arange(1, HASHES + 1, dtype=np.uint64)) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def posterior(matches: int, compared: int, num: int = NUM, den: int = DEN) -> float:
    """The chance that a pair's similarity is num / den or more when `matches` of `compared` hashes
    agree in their kept byte, from a uniform prior.

    Bytes agree with probability c = s + (1 - s) / BYTE at similarity s, so c is uniform on
    [1 / BYTE, 1] before and follows a beta distribution cut to that range afterwards; its tails are
    sums of binomial terms.
    """

    def above(x: float) -> float:
        n = compared + 1
        return math.fsum(math.comb(n, j) * x**j * (1 - x) ** (n - j) for j in range(matches + 1))

    at = num / den
    return above(at + (1 - at) / BYTE) / above(1 / BYTE)


def least_matches(num: int = NUM, den: int = DEN, miss: float = MISS) -> list[tuple[int, int]]:
    """(compared, fewest matches that keep a pair) after each batch."""
    return [
        (n, next((m for m in range(n + 1) if posterior(m, n, num, den) >= miss), n + 1))
        for n in range(BATCH, HASHES + 1, BATCH)
    ]


def survives(left: np.ndarray, right: np.ndarray, bars: list[tuple[int, int]]) -> np.ndarray:
    """Which pairs of signature rows outlast all batches; each batch compares what the one before left."""
    alive, matches, low = np.arange(len(left)), np.zeros(len(left), np.int64), 0
    for n, bar in bars:
        matches = matches + (left[alive, low:n] == right[alive, low:n]).sum(1)
        good = matches >= bar
        alive, matches, low = alive[good], matches[good], n
    out = np.zeros(len(left), bool)
    out[alive] = True
    return out


def signatures(tokens: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The HASHES smallest values of each set (none of them empty) under as many multiplications of its
    mixed 64-bit tokens, their upper halves."""
    first = np.cumsum(sizes) - sizes
    out = np.empty((len(sizes), HASHES), np.uint32)
    for i in range(HASHES):
        out[:, i] = np.minimum.reduceat(((tokens * _ODD[i]) >> np.uint64(32)).astype(np.uint32), first)
    return out


def band_keys(sigs: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of each set."""
    rows = sigs.reshape(len(sigs), BANDS, BAND_ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), rows.shape[:2]).copy()
    for j in range(BAND_ROWS):
        key = mix((key ^ rows[:, :, j]) * _STEP + np.uint64(j))
    return key


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


def _binary(rows: np.ndarray) -> pa.Array:
    """Rows of one length as binary values."""
    ends = np.arange(len(rows) + 1, dtype=np.int32) * (rows.shape[1] * rows.itemsize)
    data = np.ascontiguousarray(rows)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(data)])


def _facts(docs: DataFrame) -> DataFrame:
    """Per row: id, text hash, set size and set hash (`a`); where a task meets a set first, also its
    signature bytes and band keys."""
    kind = docs.schema["id"].dataType

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _Seen()
        for batch in batches:
            data, off = buffers(batch.column(2))
            for low, high in pieces(off):
                tokens, sizes = shingle_sets(data[off[low] : off[high]], off[low : high + 1] - off[low], WORDS)
                a = set_hashes(tokens, sizes)
                fresh = seen.new(a, sizes)
                sigs = signatures(tokens[np.repeat(fresh, sizes)], sizes[fresh])
                keys = band_keys(sigs).view(np.int64).ravel()
                at = np.cumsum(fresh) - 1
                none = pa.array(~fresh)
                bounds = np.concatenate([[0], np.cumsum(fresh) * BANDS]).astype(np.int32)
                take = pa.array(np.maximum(at, 0)) if len(sigs) else None
                bytes_ = _binary(sigs.astype(np.uint8)).take(take) if len(sigs) else pa.nulls(len(a), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[low:high],
                        batch.column(1)[low:high],
                        pa.array(sizes.astype(np.int64)),
                        pa.array(a.view(np.int64)),
                        pc.if_else(none, pa.scalar(None, pa.binary()), bytes_),
                        pa.ListArray.from_arrays(pa.array(bounds), pa.array(keys)),
                    ],
                    names=["id", "text_hash", "size", "a", "sig", "keys"],
                )

    schema = f"id {kind.simpleString()}, text_hash long, size long, a long, sig binary, keys array<long>"
    return docs.select("id", "text_hash", "text").mapInArrow(scan, schema)


def _even(df: DataFrame, rows: int) -> int:
    """A key is hot when it has more rows than an even share of a task; at most as many keys are hot as
    there are tasks."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(ROWS_PER_TASK, max(LEAST_HOT, rows // tasks))


def _similar_sizes(one: str, two: str, num: int, den: int):
    return F.least(one, two) * den >= F.greatest(one, two) * num


def _prune(pairs: DataFrame, sets: DataFrame, num: int, den: int, miss: float) -> DataFrame:
    """The pairs (a, b) whose signatures leave them the threshold. Signatures come to the pairs in two
    joins; a set with many pairs is split."""
    bars = least_matches(num, den, miss)
    total = pairs.count()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (buffers(batch.column(i))[0].reshape(-1, HASHES) for i in (2, 3))
            good = pa.array(survives(left, right, bars))
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(good) for i in (0, 1)], names=["a", "b"])

    for side in ("a", "b"):
        facts = sets.select(F.col("a").alias(side), F.col("sig").alias(f"sig_{side}"))
        other = "b" if side == "a" else "a"
        pairs = attach(pairs, facts, side, F.col(other), rows_per_task=_even(sets, total), total=total)
    return cut(pairs.select("a", "b", "sig_a", "sig_b").mapInArrow(compare, "a long, b long"))


def _token_sets(docs: DataFrame, nodes: DataFrame, per_set: DataFrame) -> DataFrame:
    """(a, tokens) of the given sets, each from the row that stands for it. The scan passes over rows
    that are not in a bitmap of the wanted ones, and no text is shuffled; a row that stands twice in
    the table may give its set twice."""
    row = F.xxhash64("id", "text_hash")
    wanted = nodes.join(per_set, "a").select(F.xxhash64("one.id", "one.text_hash").alias("h"))
    bitmap = docs.sparkSession.sparkContext.broadcast(bitmaps.build(wanted, "h"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _Seen()
        for batch in batches:
            batch = batch.filter(pa.array(bitmaps.passes(bitmap.value, batch.column(0).to_numpy())))
            data, off = buffers(batch.column(1))
            for low, high in pieces(off):
                tokens, sizes = shingle_sets(data[off[low] : off[high]], off[low : high + 1] - off[low], WORDS)
                a, ends = set_hashes(tokens, sizes), np.cumsum(sizes)
                at = np.flatnonzero(seen.new(a, sizes))
                found = [tokens[ends[i] - sizes[i] : ends[i]].tobytes() for i in at]
                yield pa.RecordBatch.from_arrays([pa.array(a[at].view(np.int64)), pa.array(found, pa.binary())], names=["a", "tokens"])

    return cut(docs.select(row.alias("h"), "text").mapInArrow(scan, "a long, tokens binary"))


def _exact(pairs: DataFrame, docs: DataFrame, per_set: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) that reach the threshold on their full sets."""
    pairs = cut(pairs)
    total = pairs.count()
    if not total:
        return pairs
    nodes = pairs.select("a").union(pairs.select("b")).distinct()
    tokens = _token_sets(docs, nodes, per_set)

    def intersect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for left, right in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (left, right))
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(den * both >= num * (len(x) + len(y) - both))
            keep = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(keep) for i in (0, 1)], names=["a", "b"])

    for side, other in (("a", "b"), ("b", "a")):
        ends = pairs.select(side).distinct()
        facts = tokens.select(F.col("a").alias(side), F.col("tokens").alias(f"tokens_{side}")).join(ends, side, "left_semi")
        counts = pairs.groupBy(side).agg(F.count("*").alias("_n"))
        facts = facts.join(counts, side)
        pairs = attach(pairs, facts, side, F.col(other), size="_n", rows_per_task=_even(docs, total), total=total).drop("_n")
    return cut(pairs.select("a", "b", "tokens_a", "tokens_b").mapInArrow(intersect, "a long, b long").distinct())


def _named(edges: DataFrame) -> DataFrame:
    """(node, component), written."""
    edges = cut(edges)
    return cut(connected_components(edges, rows_per_task=_even(edges, edges.count())))


def _confirm_stars(near: DataFrame, docs: DataFrame, per_set: DataFrame, num: int, den: int) -> DataFrame:
    """(node, component) of the pairs that hold on full sets.

    First each set is held against one partner, the one most sets have in common; then only the pairs
    that lie across the components found so far, for the others add nothing. So a set with many copies
    is fetched about once for itself, and no link between different components is left out.
    """
    degree = near.groupBy("b").agg(F.count("*").alias("n"))
    total = near.count()
    first = (
        attach(near, degree, "b", F.col("a"), size="n", rows_per_task=_even(docs, total), total=total)
        .groupBy("a")
        .agg(F.max_by("b", F.struct("n", "b")).alias("b"))
    )
    labels = _named(_exact(first, docs, per_set, num, den))
    across = near.select("a", "b")
    for side, other in (("a", "b"), ("b", "a")):
        facts = labels.select(F.col("node").alias(side), F.col("component").alias(f"c_{side}"))
        across = attach(across, facts, side, F.col(other), how="left", rows_per_task=_even(docs, total), total=total)
    across = across.filter(F.coalesce("c_a", "a") != F.coalesce("c_b", "b")).select("a", "b")
    return _merge(labels, _exact(across, docs, per_set, num, den))


def _merge(labels: DataFrame, links: DataFrame) -> DataFrame:
    return _named(labels.select(F.col("node").alias("a"), F.col("component").alias("b")).union(links))


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Intersection sizes of every left with every right set, by products of 0/1 matrices over the
    tokens that both sides hold, COLUMNS of them at a time."""
    sides = []
    for sets in (left, right):
        tokens = np.concatenate(sets)
        sides.append((tokens, np.repeat(np.arange(len(sets)), [len(x) for x in sets])))
    both = np.intersect1d(np.unique(sides[0][0]), np.unique(sides[1][0]), assume_unique=True)
    placed = []
    for tokens, row in sides:
        code = np.searchsorted(both, tokens)
        held = code < len(both)
        held[held] = both[code[held]] == tokens[held]
        order = np.argsort(code[held], kind="stable")
        placed.append((code[held][order], row[held][order]))
    out = np.zeros((len(left), len(right)), np.float64)
    for low in range(0, len(both), COLUMNS):
        blocks = []
        for (code, row), n in zip(placed, out.shape):
            part = slice(*np.searchsorted(code, [low, low + COLUMNS]))
            block = np.zeros((n, COLUMNS), np.float32)
            block[row[part], code[part] - low] = 1
            blocks.append(block)
        out += blocks[0] @ blocks[1].T
    return out.astype(np.int64)


def star_edges(mask: np.ndarray, left: np.ndarray, right: np.ndarray, a: np.ndarray) -> np.ndarray:
    """The sets that the links of a mask join, each with the first set it is joined to, so a tile
    returns fewer rows than it has sets."""
    label, n = np.arange(len(a)), len(a)
    while True:
        before = label.copy()
        label[left] = np.minimum(label[left], np.where(mask, label[right][None], n).min(1, initial=n))
        label[right] = np.minimum(label[right], np.where(mask, label[left][:, None], n).min(0, initial=n))
        label = label[label]
        if (label == before).all():
            break
    joined = np.flatnonzero(label != np.arange(n))
    return np.stack([a[joined], a[label[joined]]])


def _in_tiles(members: DataFrame, payload: DataFrame, column: str, similar, num: int, den: int, least: int) -> DataFrame:
    """(a, b): sets of different components that a key's tiles join, as stars.

    `members` is (key, a, size, component), written; keys with fewer than `least` members or with one
    component are done, and of keys with the same members one is taken. The largest component of a key
    is cut into slices, and the other members too; a tile holds a slice of the former and one of the
    latter, or two slices of the latter, so it has some 2 * SLICE sets and 2 * SLICE_TOKENS tokens at
    most (or one larger set), and members of the largest component never meet each other.
    `similar(payloads, left, right, able)` marks the pairs of a tile that hold among the able ones;
    pairs never leave the tile.
    """
    total = members.count()
    each = members.groupBy("key", "component").agg(
        F.count("*").alias("n"), F.sum(F.col("size").cast("long")).alias("w"), F.bit_xor(F.xxhash64("a")).alias("h")
    )

    def slices(n, w):
        return F.greatest(F.ceil(n / SLICE), F.ceil(w / SLICE_TOKENS)).cast("int")

    most = F.col("b.most")
    open_keys = cut(
        each.groupBy("key")
        .agg(
            F.sum("n").alias("n"),
            F.sum("w").alias("w"),
            F.bit_xor("h").alias("h"),
            F.max(F.struct("n", "w", "component")).alias("most"),
            F.count("*").alias("parts"),
        )
        .filter((F.col("parts") > 1) & (F.col("n") >= least))
        .groupBy("n", "w", "h")
        .agg(F.min(F.struct("key", "most")).alias("b"))
        .select(
            "b.key",
            "n",
            most["component"].alias("main"),
            slices(most["n"], most["w"]).alias("main_slices"),
            slices(F.col("n") - most["n"], F.col("w") - most["w"]).alias("rest_slices"),
        )
    )
    found = attach(members, open_keys, "key", F.col("a"), size="n", rows_per_task=_even(members, total), total=total)
    is_main = F.col("component") == F.col("main")
    own = F.pmod(F.xxhash64("a", "key"), F.when(is_main, F.col("main_slices")).otherwise(F.col("rest_slices"))).cast("int")

    def place(kind: int, i, j):
        return F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"))

    rest = F.sequence(F.lit(0), F.col("rest_slices") - 1)
    places = F.when(is_main, F.transform(rest, lambda j: place(0, F.col("own"), j))).otherwise(
        F.concat(
            F.transform(F.sequence(F.lit(0), F.col("main_slices") - 1), lambda i: place(0, i, F.col("own"))),
            F.transform(rest, lambda j: place(1, F.least(j, F.col("own")), F.greatest(j, F.col("own")))),
        )
    )
    keys = ["key", "kind", "i", "j"]
    placed = cut(
        found.withColumn("own", own)
        .withColumn("in_main", is_main)
        .select("key", "own", "component", "in_main", "a", "size", F.explode(places).alias("p"))
    )
    n_placed = placed.count()
    tiles = attach(
        placed.select("key", "p.*", "own", "component", "in_main", "a", "size"),
        payload.select("a", column),
        "a",
        F.col("key"),
        rows_per_task=_even(members, n_placed),
        total=n_placed,
    ).select(*keys, "own", "component", "in_main", "a", "size", column)

    def tile(table: pa.Table) -> pa.Table:
        if len(table) < 2:
            return empty
        table = table.combine_chunks()
        get = {n: table.column(n).to_numpy() for n in ("own", "component", "in_main", "a", "size")}
        kind, i, j = (int(table.column(n)[0].as_py()) for n in keys[1:])
        if kind == 0:
            left, right = np.flatnonzero(get["in_main"]), np.flatnonzero(~get["in_main"])
        else:
            left, right = np.flatnonzero(get["own"] == i), np.flatnonzero(get["own"] == j)
        one, two = get["size"][left][:, None].astype(np.int64), get["size"][right][None].astype(np.int64)
        able = get["component"][left][:, None] != get["component"][right][None]
        able &= np.minimum(one, two) * den >= np.maximum(one, two) * num
        if not able.any():
            return empty
        mask = similar(table.column(column), left, right, able)
        a, b = star_edges(mask, left, right, get["a"])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    empty = pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
    return cut(tiles.groupBy(*keys).applyInArrow(tile, "a long, b long").distinct())


def _across_bands(
    shared: DataFrame, labels: DataFrame, sets: DataFrame, docs: DataFrame, per_set: DataFrame, num: int, den: int, miss: float
) -> DataFrame:
    """Links between sets of different components that share a band of more than two sets.

    Signatures are compared in tiles of a band; what outlasts the batches joins sets into families, not
    yet links. The members of a family that are in different components are then compared on their full
    sets, in tiles of the family. So a family whose sets nearly reach the threshold, but do not, costs
    work in its tiles and not a row for each pair.
    """
    bars = least_matches(num, den, miss)

    def by_signature(column: pa.ChunkedArray, left: np.ndarray, right: np.ndarray, able: np.ndarray) -> np.ndarray:
        sigs = buffers(column)[0].reshape(-1, HASHES)
        mask, step = np.zeros_like(able), max(1, (1 << 16) // len(right))
        for low in range(0, len(left), step):
            p, q = np.nonzero(able[low : low + step])
            mask[low + p, q] = survives(sigs[left[low + p]], sigs[right[q]], bars)
        return mask

    def by_tokens(column: pa.ChunkedArray, left: np.ndarray, right: np.ndarray, able: np.ndarray) -> np.ndarray:
        data, off = buffers(column)
        tokens = [np.frombuffer(data[off[i] : off[i + 1]].tobytes(), np.uint64) for i in range(len(off) - 1)]
        sizes = np.array([len(t) for t in tokens], np.int64)
        both = np.zeros(able.shape, np.int64)
        p, q = np.nonzero(able)
        if len(p) < FEW_PAIRS:
            both[p, q] = [len(np.intersect1d(tokens[left[x]], tokens[right[y]], assume_unique=True)) for x, y in zip(p, q)]
        else:
            both = overlaps([tokens[x] for x in left], [tokens[y] for y in right])
        return able & (den * both >= num * (sizes[left][:, None] + sizes[right][None] - both))

    total = shared.count()
    facts = labels.select(F.col("node").alias("a"), "component")

    def labelled(rows: DataFrame) -> DataFrame:
        out = attach(rows, facts, "a", F.col("key"), how="left", rows_per_task=_even(docs, total), total=total)
        return cut(out.withColumn("component", F.coalesce("component", "a")).select("key", "a", "size", "component"))

    near = _in_tiles(labelled(shared), sets, "sig", by_signature, num, den, least=3)
    touched = near.select("a").union(near.select("b")).distinct()
    own = touched.join(facts, "a").select("a", F.col("component").alias("b"))
    families = _named(near.union(own)).select(F.col("node").alias("a"), F.col("component").alias("key"))
    sized = shared.select("a", "size").distinct()
    members = labelled(cut(touched.join(families, "a").join(sized, "a").select("key", "a", "size")))
    tokens = _token_sets(docs, touched, per_set).dropDuplicates(["a"])
    return _in_tiles(members, tokens, "tokens", by_tokens, num, den, least=2)


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    num: int = NUM,
    den: int = DEN,
    miss: float = MISS,
) -> DataFrame:
    """(id, n_shingles, component_id, kept) per row: documents linked, directly or through others, when
    den * |A and B| >= num * |A or B| over their sets of two-word shingles.

    Words are runs of anything but ASCII white space, A-Z lower-cased; a text of one word has it as its
    shingle. Null and empty texts have an empty set and are their own component. A component's id is
    its smallest document id, null where none of its documents has one; documents without id are linked
    too. `kept` holds where id and component id are the same, null for null. Repeated rows give
    repeated results. Texts are read whole; other columns are not read.

    1. Equal sets collapse to one. Each set has HASHES MinHash values, cut into BANDS bands of BAND_ROWS.
    2. In each band, sets are held against the band's first one, within the size bounds. 3. Pairs are
    compared by BATCH hashes at a time and dropped as soon as the posterior chance of the threshold is
    below `miss`. 4. The rest is confirmed on full sets. 5. In bands that still hold several components
    the members of different ones are compared in tiles by the same batches, and confirmed.

    A pair at the threshold of 0.8 shares no band with a chance of 3 in a million, less above it, and is
    dropped by a batch with about `miss` for each of five; links are otherwise complete and all
    confirmed. Nothing is capped. A band is one task's matter only up to an even share of a task's rows.
    The worst case, many sets that share bands without being similar, is quadratic inside a band's
    tiles. Sets and shingles are known by 64-bit hashes.
    """
    own = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    facts = cut(_facts(own))
    rows = facts.select("id", "size", "a")
    per_set = cut(
        facts.filter("size > 0")
        .groupBy("a")
        .agg(F.min("id").alias("least"), F.min(F.struct("id", "text_hash")).alias("one"), F.count("*").alias("rows"))
    )
    postings = facts.filter("sig IS NOT NULL").select(F.explode("keys").alias("key"), "a", F.col("size").cast("int").alias("size"))
    # a band's first set, and nothing of bands with one set
    bands = (
        postings.groupBy("key")
        .agg(F.min(F.struct("a", "size")).alias("first"), F.max("a").alias("last"), F.count("*").alias("n"))
        .filter("first.a <> last")
    )
    posted = facts.filter("sig IS NOT NULL").count() * BANDS
    shared = cut(
        attach(postings, cut(bands), "key", F.col("a"), size="n", rows_per_task=_even(docs, posted), total=posted)
        .select("key", "a", "size", "first")
        .distinct()
    )
    stars = cut(
        shared.filter((F.col("a") != F.col("first.a")) & _similar_sizes("size", "first.size", num, den))
        .select("a", F.col("first.a").alias("b"))
        .distinct()
    )
    live = docs.sparkSession.sparkContext.broadcast(bitmaps.build(shared.select(F.xxhash64("a").alias("h")).distinct(), "h"))

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = pa.array(bitmaps.passes(live.value, batch.column(0).to_numpy()))
            yield pa.RecordBatch.from_arrays([c.filter(good) for c in batch.columns[1:]], names=["a", "sig"])

    signed = facts.filter("sig IS NOT NULL").select(F.xxhash64("a").alias("h"), "a", "sig")
    sets = cut(signed.mapInArrow(chosen, "a long, sig binary").dropDuplicates(["a"]))
    labels = _confirm_stars(_prune(stars, sets, num, den, miss), own, per_set, num, den)
    labels = _merge(labels, _across_bands(shared.select("key", "a", "size"), labels, sets, own, per_set, num, den, miss))

    n_sets = per_set.count()
    grouped = cut(
        per_set.join(labels, per_set["a"] == labels["node"], "left").select(
            "a", "least", "rows", F.coalesce("component", "a").alias("component")
        )
    )
    firsts = cut(grouped.groupBy("component").agg(F.min("least").alias("component_id"), F.count("*").alias("n")))
    named = attach(grouped, firsts, "component", F.col("a"), size="n", rows_per_task=_even(docs, n_sets), total=n_sets)
    total = rows.count()
    keyed = rows.withColumn("a", F.when(F.col("size") > 0, F.col("a")))
    return (
        attach(
            keyed,
            named.select("a", "component", "component_id", "rows"),
            "a",
            F.xxhash64("id"),
            how="left",
            size="rows",
            rows_per_task=_even(docs, total),
            total=total,
        )
        .withColumn("component_id", F.when(F.col("component").isNull(), F.col("id")).otherwise(F.col("component_id")))
        .select(
            F.col("id").alias(id_col),
            F.col("size").alias("n_shingles"),
            "component_id",
            F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
        )
    )
