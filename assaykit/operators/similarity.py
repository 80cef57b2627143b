"""Near duplicates: groups connected by word-shingle Jaccard similarity."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaykit.operators.components import connected_components
from assaykit.operators.skew import ROWS_PER_TASK, attach
from assaykit.session import cut

EPS = 1e-9
MINHASHES = 32
COUNT_BITS = 22
BATCH = 500_000
LISTED = 1_000_000


def with_shingles(df: DataFrame, text: Column, words: int = 3) -> DataFrame:
    """Adds `tokens`: the distinct hashed runs of `words` words over the whole text; a shorter text has
    one run of all its words. Texts without words are left out.

    The word list is a column of its own, so that it is split once per row and not once per run.
    """
    parts = F.col("_parts")

    def run(i: Column) -> Column:
        return F.xxhash64(*[F.get(parts, i + k) for k in range(words)])

    starts = F.sequence(F.lit(0), F.greatest(F.size(parts) - words, F.lit(0)))
    return (
        df.withColumn("_parts", F.filter(F.split(text, r"[ \t\n\r]+"), lambda w: w != ""))
        .filter(F.size(parts) > 0)
        .withColumn("tokens", F.array_distinct(F.transform(starts, run)))
        .drop("_parts")
    )


def listed(keys: DataFrame) -> DataFrame:
    """Narrow rows to join to wide ones: sent to every task up to LISTED of them, and beyond that the
    side a hash table is built from, so that the wide rows are never sorted."""
    keys = cut(keys)
    return F.broadcast(keys) if keys.count() <= LISTED else keys.hint("shuffle_hash")


def distinct_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(content, node, text): every text once, with its smallest node. Which rows hold a copy is settled
    on digests and ids; texts stay in the scan, but for those that one node holds more than once."""
    texts = docs.select(
        F.col(id_col).alias("node"), F.md5(text_col).alias("content"), F.col(text_col).alias("text")
    ).filter("node IS NOT NULL AND content IS NOT NULL")
    held = texts.groupBy("content", "node").agg(F.count("*").alias("n")).groupBy("content")
    first = held.agg(F.min(F.struct("node", "n")).alias("first"), F.sum("n").alias("rows"))
    repeated = listed(
        first.filter("rows > 1").select(
            F.col("content").alias("_content"), F.col("first.node").alias("_node"), (F.col("first.n") > 1).alias("_twice")
        )
    )
    marked = texts.join(repeated, F.col("content") == F.col("_content"), "left").filter(
        F.col("_content").isNull() | (F.col("node") == F.col("_node"))
    )
    columns = ["content", "node", "text"]
    if not repeated.filter("_twice").limit(1).count():
        return marked.select(*columns)
    twice = F.coalesce("_twice", F.lit(False))
    return marked.filter(~twice).select(*columns).unionByName(
        marked.filter(twice).select(*columns).dropDuplicates(["content"])
    )


def distinct_sets(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One token set per distinct text: (content, node, tokens, size). Copies of a text collapse before
    it is cut into shingles, so a text held by a third of all rows is cut once."""
    return (
        with_shingles(distinct_texts(docs, id_col, text_col), F.col("text"))
        .select("content", "node", "tokens")
        .withColumn("size", F.size("tokens"))
    )


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of a batch of sets, one after another, and the number of each set's."""
    sizes = np.diff(column.offsets.to_numpy(zero_copy_only=False)).astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False), sizes


def _bucket(tokens: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each token by its upper bits; `buckets` is a power of two."""
    return (tokens.view(np.uint64) >> np.uint64(65 - buckets.bit_length())).astype(np.int64)


def token_classes(sets: DataFrame) -> np.ndarray:
    """How frequent tokens are, as classes of 2^COUNT_BITS buckets of them: 0 up to twice the mean of a
    bucket, and one more for each doubling. Tasks count their own tokens and Spark adds the counts; only
    buckets above twice the mean, so at most half of a fixed number, reach the driver."""

    buckets, limit = 1 << COUNT_BITS, BATCH

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            np.add.at(counts, _bucket(_flat(batch.column(0))[0], buckets), 1)
        at = np.flatnonzero(counts)
        for low in range(0, len(at), limit):
            part = at[low : low + limit]
            yield pa.RecordBatch.from_pydict({"bucket": part, "n": counts[part]})

    total = sets.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    often = max(1.0, 2 * total / buckets)
    found = sets.select("tokens").mapInArrow(scan, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    frequent = found.filter(F.col("n") > often).toArrow()
    out = np.zeros(buckets, np.uint8)
    out[frequent.column("bucket").to_numpy()] = 1 + np.log2(frequent.column("n").to_numpy() / often).astype(np.uint8)
    return out


def prefix_postings(sets: DataFrame, threshold: float, rows_per_task: int) -> DataFrame:
    """(token, node, size): the first tokens of each set, enough of them that two similar sets must share
    one.

    Any order common to all sets serves; this one has frequent tokens last, by the classes of their
    buckets, and needs no row of a token but those posted. Tokens posted by a single set can match
    nothing and are left out.
    """
    shared = sets.sparkSession.sparkContext.broadcast(token_classes(sets))
    at, limit = sets.schema["node"].dataType.simpleString(), BATCH

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = shared.value
        for batch in batches:
            tokens, sizes = _flat(batch.column(1))
            ends = np.cumsum(sizes)
            low = 0
            while low < len(sizes):
                begin = int(ends[low] - sizes[low])
                high = max(low + 1, int(np.searchsorted(ends, begin + limit, "right")))
                part, own = tokens[begin : ends[high - 1]], sizes[low:high]
                row = np.repeat(np.arange(high - low), own)
                order = np.lexsort((part, classes[_bucket(part, len(classes))], row))
                pos = np.arange(len(part)) - np.repeat(np.cumsum(own) - own, own)
                take = pos < (own - np.ceil(threshold * own - EPS).astype(np.int64) + 1)[row]
                row = row[take]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(part[order][take]),
                        batch.column(0).take(pa.array(row + low)),
                        pa.array(own[row].astype(np.int32)),
                    ],
                    names=["token", "node", "size"],
                )
                low = high

    posted = cut(sets.select("node", "tokens").mapInArrow(scan, f"token long, node {at}, size int"))
    held = cut(posted.groupBy("token").agg(F.count("*").alias("_held")).filter("_held > 1"))
    # a token is in a set once, so no token has more rows than there are sets
    return attach(
        posted, held, "token", F.col("node"), size="_held", rows_per_task=rows_per_task, total=sets.count()
    ).drop("_held")


def verify(pairs: DataFrame, sets: DataFrame, threshold: float, rows_per_task: int) -> DataFrame:
    """The pairs (a, b) whose token sets reach the threshold. Pairs are written once; the number of
    pairs of each end comes from them, so that hot sets are split at either end."""
    pairs = cut(pairs)
    total = pairs.count()
    both = pairs
    for end, other in (("b", "a"), ("a", "b")):
        counts = listed(pairs.groupBy(end).agg(F.count("*").alias("_size")))
        facts = sets.select(F.col("node").alias(end), F.col("tokens").alias(f"_t{end}")).join(counts, end)
        both = attach(
            both, facts, end, F.col(other), size="_size", rows_per_task=rows_per_task, total=total
        ).drop("_size")
    common = F.size(F.array_intersect("_ta", "_tb"))
    union = F.size("_ta") + F.size("_tb") - common
    return both.filter(common >= F.lit(threshold) * union - EPS).select("a", "b")


def enough(a: Column, b: Column, common: Column, threshold: float) -> Column:
    """Whether sets of sizes `a` and `b` with `common` posted tokens can be similar. Of the two, that whose
    posted tokens end first in the common order shares no other of them, as the other set would have
    posted it; so all they share is those and what it did not post."""
    need = F.ceil(F.lit(threshold / (1 + threshold)) * (a + b) - EPS)
    return F.ceil(F.lit(threshold) * F.greatest(a, b) - EPS) - 1 + common >= need


def _star_pairs(
    postings: DataFrame, bucket: str, threshold: float, rows_per_task: int, total: int, counted: bool
) -> DataFrame:
    """One candidate per posting: each member of a bucket against the bucket's smallest set. With
    `counted`, a pair that shares too few buckets for their whole number to be enough is left to the pass
    across components; its buckets with other smallest sets are not counted here, hence the factor."""
    pivots = postings.groupBy(bucket).agg(
        F.min(F.struct("size", "node")).alias("_pivot"), F.count("*").alias("_members")
    )
    joined = attach(
        postings.select(bucket, "node", "size"),
        pivots.filter("_members > 1"),
        bucket,
        F.col("node"),
        size="_members",
        rows_per_task=rows_per_task,
        total=total,
    )
    met = (
        joined.filter(F.col("_pivot.node") != F.col("node"))
        .filter(F.col("_pivot.size") >= F.lit(threshold) * F.col("size") - EPS)
        .groupBy(F.col("_pivot.node").alias("a"), F.col("node").alias("b"))
        .agg(F.min("_pivot.size").alias("_sa"), F.min("size").alias("_sb"), F.count("*").alias("_common"))
    )
    if counted:
        met = met.filter(enough(F.col("_sa"), F.col("_sb"), 2 * F.col("_common"), threshold))
    return met.select("a", "b")


def _cross_pairs(
    postings: DataFrame, labels: DataFrame, threshold: float, rows_per_task: int, total: int, counted: bool
) -> DataFrame:
    """Candidates between different components that share a bucket, or with `counted` enough of them.

    Buckets that the star pass merged into one component are done and drop out. What is left is
    joined under the length bound of prefix filtering; a large bucket is cut into slices
    on both sides, and each pair of slices meets in a task of its own, so that no task forms more than
    some hundred times `rows_per_task` pairs.
    """
    named = postings.join(labels, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    open_buckets = (
        named.groupBy("token")
        .agg(
            F.count("*").alias("_members"),
            F.min("component").alias("_first"),
            F.max("component").alias("_last"),
        )
        .filter("_first <> _last")
        .select("token", "_members")
    )
    left_over = attach(
        named,
        open_buckets,
        "token",
        F.col("node"),
        size="_members",
        rows_per_task=rows_per_task,
        total=total,
    )
    slice_rows = max(1, int(10 * rows_per_task**0.5))
    sliced = left_over.withColumn("_n", F.ceil(F.col("_members") / slice_rows).cast("int"))
    own = F.pmod(F.xxhash64("node"), F.col("_n")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("_n") - 1))
    fields = F.struct("size", "node", "component")
    small = sliced.select("token", own.alias("_i"), every.alias("_j"), fields.alias("s"))
    large = sliced.select("token", own.alias("_j"), every.alias("_i"), fields.alias("l"))
    ordered = F.struct("s.size", "s.node") < F.struct("l.size", "l.node")
    met = (
        small.join(large, ["token", "_i", "_j"])
        .filter(F.col("s.component") != F.col("l.component"))
        .filter(ordered)
        .filter(F.col("s.size") >= F.lit(threshold) * F.col("l.size") - EPS)
        .groupBy(F.col("s.node").alias("a"), F.col("l.node").alias("b"))
        .agg(F.min("s.size").alias("_sa"), F.min("l.size").alias("_sb"), F.count("*").alias("_common"))
    )
    if counted:
        # sets of different components share open buckets alone, so all they share are counted
        met = met.filter(enough(F.col("_sa"), F.col("_sb"), F.col("_common"), threshold))
    return met.select("a", "b")


def near_duplicate_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = 0.8,
    rows_per_task: int = ROWS_PER_TASK,
    sets: DataFrame | None = None,
) -> DataFrame:
    """(content, node, component): texts linked, directly or through others, by Jaccard similarity
    of at least `threshold` over word 3-shingles. Exact.

    Equal texts collapse first. A star pass then compares every posting with the smallest member of
    its bucket only, which settles families of copies in linear work; pairs are formed only across
    what is still apart. `sets` are the written distinct_sets of the documents, where they are there.
    """
    sets = cut(distinct_sets(docs, id_col, text_col)) if sets is None else sets
    postings = cut(prefix_postings(sets, threshold, rows_per_task))
    return _linked(postings, sets, threshold, rows_per_task, counted=True)


def lsh_layout(threshold: float, recall: float, hashes: int = MINHASHES) -> tuple[int, int]:
    """(bands, rows): the most rows in a band, and so the fewest needless candidates, for which a pair
    at the threshold shares one of the bands with a chance of at least `recall`."""
    for rows in range(hashes, 0, -1):
        bands = hashes // rows
        if 1 - (1 - threshold**rows) ** bands >= recall:
            return bands, rows
    return hashes, 1


def one_permutation(sets: DataFrame, hashes: int = MINHASHES) -> DataFrame:
    """(node, size, signature): MinHash values from one pass over each token, which is a hash already.

    The lower part of a token names a bin, its upper part competes for the bin's minimum. An empty bin
    takes the value of the next one that is not (rotation), so that signatures of small sets are full.
    """
    tokens = sets.select("node", "size", F.explode("tokens").alias("t"))
    bin_ = F.pmod("t", F.lit(hashes))
    value = F.xxhash64("t")
    mins = [F.min(F.when(F.col("bin") == i, F.col("value"))).alias(f"h{i}") for i in range(hashes)]
    sparse = tokens.select("node", "size", bin_.alias("bin"), value.alias("value")).groupBy("node", "size").agg(*mins)
    ring = sparse.select("node", "size", F.array(*[F.col(f"h{i}") for i in range(hashes)] * 2).alias("ring"))

    def filled(i):
        ahead = F.slice("ring", i + 1, F.lit(hashes))
        return F.get(F.filter(ahead, lambda h: h.isNotNull()), F.lit(0))

    return ring.select("node", "size", F.transform(F.sequence(F.lit(0), F.lit(hashes - 1)), filled).alias("signature"))


def near_duplicate_lsh_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = 0.8,
    rows_per_task: int = ROWS_PER_TASK,
    recall: float = 0.95,
    sets: DataFrame | None = None,
) -> DataFrame:
    """As near_duplicate_components, but candidates come from bands of one-permutation MinHash
    signatures: every pair that shares a band is linked, directly or through others, where it is
    similar, and every link is verified on the whole sets. A similar pair without a common band may be
    missed; bands are chosen so that one at the threshold is found with a chance of `recall`."""
    sets = cut(distinct_sets(docs, id_col, text_col)) if sets is None else sets
    bands, rows = lsh_layout(threshold, recall)
    keys = F.array(
        *[F.xxhash64(F.lit(i), *[F.get("signature", F.lit(i * rows + k)) for k in range(rows)]) for i in range(bands)]
    )
    buckets = cut(one_permutation(sets).select(F.explode(keys).alias("token"), "node", "size"))
    return _linked(buckets, sets, threshold, rows_per_task, counted=False)


def _linked(
    postings: DataFrame, sets: DataFrame, threshold: float, rows_per_task: int, counted: bool
) -> DataFrame:
    """Components over the buckets of `postings`: the star pass, then what is still apart."""
    total = sets.count()
    near_pivot = _star_pairs(postings, "token", threshold, rows_per_task, total, counted)
    stars = verify(near_pivot, sets, threshold, rows_per_task)
    labels = connected_components(stars, rows_per_task)
    across = _cross_pairs(postings, labels, threshold, rows_per_task, total, counted)
    crossing = verify(across, sets, threshold, rows_per_task)
    merged = connected_components(
        labels.select(F.col("node").alias("a"), F.col("component").alias("b")).union(crossing),
        rows_per_task,
    )
    return sets.select("content", "node").join(merged, "node")
