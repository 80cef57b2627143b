"""Groups of 64-bit hashes within a Hamming radius, exact, from bands and tiles of bounded size."""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaykit.operators.components import connected_components
from assaykit.operators.skew import ROWS_PER_TASK, attach
from assaykit.session import cut

BITS = 64
SLICE = 1024
#: Hashes that a bucket should hold on average, and the most bits by which a band may differ.
BUCKET = 64
MAX_REACH = 2


def layout(radius: int, n: int) -> tuple[list[tuple[int, int]], int]:
    """(bands as (lowest bit, width), reach): two hashes within `radius` differ by at most `reach` bits
    in some band, for `radius` spread over radius // (reach + 1) + 1 bands cannot exceed it in each.

    The smallest reach is taken for which a band's values are so many that n spread hashes fill its
    buckets with BUCKET or fewer on average; a larger reach means fewer, wider bands and more variants.
    """
    for reach in range(MAX_REACH + 1):
        count = radius // (reach + 1) + 1
        if n <= BUCKET << (BITS // count) or count == 1:
            break
    ends = [BITS * i // count for i in range(count + 1)]
    return [(low, high - low) for low, high in zip(ends, ends[1:])], reach


def _variants(width: int, reach: int) -> list[int]:
    """Masks of up to `reach` bits."""
    return [sum(1 << b for b in bits) for k in range(min(reach, width) + 1) for bits in combinations(range(width), k)]


def _postings(nodes: DataFrame, bands: list[tuple[int, int]], reach: int) -> DataFrame:
    """(band, value, side, h, rows): each hash on the left under its own value of each band, on the
    right under every value within reach. So a pair within reach meets in one bucket of the band."""
    out = []

    def tagged(points, band: int):
        return F.transform(points, lambda p: F.struct(F.lit(band).alias("band"), p["value"].alias("value"), p["side"].alias("side")))

    for i, (low, width) in enumerate(bands):
        mask = (1 << width) - 1
        own = F.shiftrightunsigned("h", low) if width < BITS else F.col("h")
        value = own.bitwiseAND(F.lit(mask if mask < 1 << 63 else -1))
        near = F.array(*[F.lit(m if m < 1 << 63 else m - (1 << 64)).cast("long") for m in _variants(width, reach)])
        left = F.array(F.struct(value.alias("value"), F.lit(0).alias("side")))
        right = F.transform(near, lambda m: F.struct(value.bitwiseXOR(m).alias("value"), F.lit(1).alias("side")))
        out.append(tagged(F.concat(left, right), i))
    return nodes.select(F.explode(F.concat(*out)).alias("p"), "h", "rows").select("p.*", "h", "rows")


def _joined(mask: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, the first hash it is joined to) for the hashes that the links of a mask join."""
    nodes, at = np.unique(np.concatenate([left, right]), return_inverse=True)
    l, r = at[: len(left)], at[len(left) :]
    label, n = np.arange(len(nodes)), len(nodes)
    while True:
        before = label.copy()
        np.minimum.at(label, l, np.where(mask, label[r][None], n).min(1, initial=n))
        np.minimum.at(label, r, np.where(mask, label[l][:, None], n).min(0, initial=n))
        label = label[label]
        if (label == before).all():
            break
    moved = np.flatnonzero(label != np.arange(n))
    return nodes[moved], nodes[label[moved]]


def hamming_links(nodes: DataFrame, radius: int, n: int) -> DataFrame:
    """(a, b, n): stars (a, b) that join hashes within the radius, and rows (a, null, n) that add up to
    the number of rows whose hash is another one within the radius.

    `nodes` is (h, rows), one row a hash, n of them. Buckets are cut into slices on both sides, so a
    tile compares SLICE with SLICE hashes however many share a value; a pair is counted in the first
    band that brings it together and never leaves its tile.
    """
    bands, reach = layout(radius, n)
    postings = cut(_postings(nodes, bands, reach))
    total = postings.count()
    sizes = (
        postings.groupBy("band", "value")
        .agg(F.count_if(F.col("side") == 0).alias("l"), F.count_if(F.col("side") == 1).alias("r"), F.min("h").alias("first"), F.max("h").alias("last"))
        .filter("l > 0 AND r > 0 AND first <> last")
        .select(
            F.struct("band", "value").alias("key"),
            (F.col("l") + F.col("r")).alias("size"),
            F.ceil(F.col("l") / SLICE).cast("int").alias("ls"),
            F.ceil(F.col("r") / SLICE).cast("int").alias("rs"),
        )
    )
    tasks = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    even = min(ROWS_PER_TASK, max(SLICE, total // tasks))
    found = attach(
        postings.select(F.struct("band", "value").alias("key"), "side", "h", "rows"),
        cut(sizes),
        "key",
        F.col("h"),
        size="size",
        rows_per_task=even,
        total=total,
    )
    is_left = F.col("side") == 0
    own = F.pmod(F.xxhash64("h", "key"), F.when(is_left, F.col("ls")).otherwise(F.col("rs"))).cast("int")
    other = F.sequence(F.lit(0), F.when(is_left, F.col("rs")).otherwise(F.col("ls")) - 1)
    placed = (
        found.withColumn("own", own)
        .select("key.*", "side", "h", "rows", "own", F.explode(other).alias("o"))
        .withColumn("i", F.when(is_left, F.col("own")).otherwise(F.col("o")))
        .withColumn("j", F.when(is_left, F.col("o")).otherwise(F.col("own")))
        .select("band", "value", "i", "j", "side", "h", "rows")
    )
    masks = [np.uint64(((1 << width) - 1) << low) for low, width in bands]

    def tile(table: pa.Table) -> pa.Table:
        band = table.column("band")[0].as_py()
        side, h, rows = (table.column(c).to_numpy() for c in ("side", "h", "rows"))
        left, right, weight = h[side == 0], h[side == 1], rows[side == 1]
        out = {c: np.zeros(0, np.int64) for c in ("a", "b", "n")}
        if len(left) and len(right):
            apart = left.view(np.uint64)[:, None] ^ right.view(np.uint64)[None]
            mask = (np.bitwise_count(apart) <= radius) & (apart != 0)
            first = mask.copy()
            for earlier in masks[:band]:
                first &= np.bitwise_count(apart & earlier) > reach
            links = first @ weight.astype(np.int64)
            some = np.flatnonzero(links)
            a, b = _joined(mask, left, right)
            out["a"] = np.concatenate([a, left[some]])
            out["b"] = np.concatenate([b, np.zeros(len(some), np.int64)])
            out["n"] = np.concatenate([np.zeros(len(a), np.int64), links[some]])
        return pa.table({"a": pa.array(out["a"]), "b": pa.array(out["b"], mask=out["n"] > 0), "n": pa.array(out["n"])})

    return cut(placed.groupBy("band", "value", "i", "j").applyInArrow(tile, "a long, b long, n long"))


def hamming_groups(
    hashes: DataFrame, radius: int, id_col: str = "path", hash_col: str = "phash"
) -> DataFrame:
    """(id, hash, first_member, first_hash, n_links) per row: rows linked, directly or through others,
    when their 64-bit hashes differ in at most `radius` bits.

    `first_member` is the smallest id of the row's group, `first_hash` the smallest hash among the
    group's rows of that id, `n_links` the number of other rows within the radius. A null hash (an image
    that could not be decoded) is linked with nothing and is its own group; a null id is linked and
    never a first member where the group has another. Repeated rows count as rows of their own. Other
    columns are not read. Equal hashes collapse first, so a group of copies with a third of all rows is
    one hash; its rows meet the result in a salted join. Exact: nothing is capped.
    """
    if not 0 <= radius < BITS:
        raise ValueError("the radius must be between 0 and 63")
    rows = hashes.select(F.col(id_col).alias("id"), F.col(hash_col).cast("long").alias("h"))
    nodes = cut(
        rows.filter("h IS NOT NULL")
        .groupBy("h")
        .agg(F.count("*").alias("rows"), F.min("id").alias("least"))
    )
    found = hamming_links(nodes.select("h", "rows"), radius, nodes.count()) if radius else None
    if found is None:
        named = nodes.select("h", "rows", "least", F.col("h").alias("component"), F.lit(0).cast("long").alias("near"))
    else:
        labels = connected_components(found.filter("b IS NOT NULL").select("a", "b"))
        near = found.groupBy("a").agg(F.sum("n").alias("near"))
        named = (
            nodes.join(labels, nodes["h"] == labels["node"], "left")
            .join(near, nodes["h"] == near["a"], "left")
            .select("h", "rows", "least", F.coalesce("component", "h").alias("component"), F.coalesce("near", F.lit(0)).alias("near"))
        )
    named = cut(named)
    firsts = named.groupBy("component").agg(
        F.min(F.struct(F.col("least").isNull().alias("none"), F.col("least").alias("id"), "h")).alias("f"),
        F.count("*").alias("size"),
    )
    n = named.count()
    facts = attach(named, firsts, "component", F.col("h"), size="size", total=n).select(
        "h", "rows", F.col("f.id").alias("first_member"), F.col("f.h").alias("first_hash"), "near"
    )
    joined = attach(rows, facts, "h", F.xxhash64("id"), how="left", size="rows")
    return joined.select(
        F.col("id").alias(id_col),
        F.col("h").alias(hash_col),
        F.when(F.col("h").isNull(), F.col("id")).otherwise(F.col("first_member")).alias("first_member"),
        "first_hash",
        F.coalesce(F.col("near") + F.col("rows") - 1, F.lit(0)).cast("long").alias("n_links"),
    )


def expected_bucket(n: int, radius: int) -> float:
    """Hashes in a bucket on average, were n hashes spread evenly."""
    bands, reach = layout(radius, n)
    width = min(w for _, w in bands)
    return n * math.fsum(math.comb(width, k) for k in range(reach + 1)) / 2**width
