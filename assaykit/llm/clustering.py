"""Lloyd rounds in exact integers, with Orchard's search for the nearest centroid."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaykit.llm.vectors import usable
from assaykit.session import cut

DIMS = 64
SCALE = 1024
CLUSTERS = 8
ROUNDS = 10
SEED = "3"
#: Components are held within this, so that a squared distance over up to 127 of them fits in 64 bits.
LARGEST = 1 << 27
ROWS = 8192


def integers(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component, x as double, held within LARGEST."""
    top = F.lit(float(LARGEST))
    return F.transform(
        vector,
        lambda x: F.floor(F.greatest(F.least(x.cast("double") * F.lit(float(scale)), top), -top)).cast("int"),
    )


def neighbour_lists(centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each centroid, the others by ascending squared distance (ties: smaller number), and those
    distances."""
    k = len(centroids)
    far = np.zeros((k, k), np.int64)
    for i in range(k):
        gap = centroids - centroids[i]
        far[i] = np.einsum("ij,ij->i", gap, gap)
    order = np.argsort(far, axis=1, kind="stable")
    others = order[order != np.arange(k)[:, None]].reshape(k, k - 1)
    return others, np.take_along_axis(far, others, 1)


def nearest(
    vectors: np.ndarray, centroids: np.ndarray, others: np.ndarray, gaps: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """(centroid, squared distance) of each vector, ties to the smaller number, and the number of
    distances computed.

    Orchard's search, all vectors a step at a time: a vector walks the neighbour list of its current
    centroid; a neighbour met for the first time is measured and marked visited; when it is closer, the
    walk goes on at the start of its list. The walk stops at a neighbour strictly beyond twice the
    vector's current distance (in squares: beyond four times), for by the triangle inequality neither
    it nor any later one can be as close.
    """
    n, k = len(vectors), len(centroids)
    at = np.zeros(n, np.int64)
    gap = vectors - centroids[0]
    best = np.einsum("ij,ij->i", gap, gap)
    visited = np.zeros((n, k), bool)
    visited[:, 0] = True
    place = np.zeros(n, np.int64)
    walking, measured = np.arange(n), n
    while len(walking) and k > 1:
        here, step = at[walking], place[walking]
        # gap > 4 * best without overflow
        inside = -(-gaps[here, step] // 4) <= best[walking]
        walking, met = walking[inside], others[here, step][inside]
        new = ~visited[walking, met]
        who, what = walking[new], met[new]
        visited[who, what] = True
        gap = vectors[who] - centroids[what]
        found = np.einsum("ij,ij->i", gap, gap)
        measured += len(who)
        closer = (found < best[who]) | ((found == best[who]) & (what < at[who]))
        place[walking] += 1
        jump = who[closer]
        at[jump], best[jump], place[jump] = what[closer], found[closer], 0
        walking = walking[place[walking] < k - 1]
    return at, best, measured


def _rows(batch: pa.RecordBatch, column: int, dims: int) -> np.ndarray:
    values = batch.column(column).flatten().to_numpy(zero_copy_only=False)
    return values.reshape(-1, dims).astype(np.int64)


def _sums(kept: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, np.ndarray]]:
    """Count and componentwise sum of the vectors of every centroid that has some. A task adds up its
    own; Spark adds the tasks' cells, of which clusters * (dims + 1) reach the driver."""
    dims = centroids.shape[1]
    shared = kept.sparkSession.sparkContext.broadcast((centroids, *neighbour_lists(centroids)))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        total = np.zeros((len(model[0]), dims + 1), np.int64)
        for batch in batches:
            for low in range(0, len(batch), ROWS):
                x = _rows(batch.slice(low, ROWS), 0, dims)
                at = nearest(x, *model)[0]
                for c in np.unique(at):
                    own = x[at == c]
                    total[c, :dims] += own.sum(0)
                    total[c, dims] += len(own)
        some = np.flatnonzero(total[:, dims])
        cells = (some[:, None] * (dims + 1) + np.arange(dims + 1)).ravel()
        yield pa.RecordBatch.from_pydict({"cell": cells, "v": total[some].ravel()})

    cells = kept.select("x").mapInArrow(scan, "cell long, v long")
    found = cells.groupBy("cell").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect()
    shared.unpersist()
    out = {row["cell"]: int(row["v"]) for row in found}
    return {
        c: (out[c * (dims + 1) + dims], np.array([out[c * (dims + 1) + j] for j in range(dims)], object))
        for c in range(len(centroids))
        if c * (dims + 1) in out
    }


def centroid_digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    dims: int = DIMS,
    scale: int = SCALE,
    seed: str = SEED,
) -> tuple[DataFrame, np.ndarray]:
    """((id, cluster, distance, cluster_inertia, inertia) per vector, final centroids by number).

    Kept are vectors of exactly `dims` components, none null, NaN or infinite, as floor(scale * x);
    others have no row. Integers beyond LARGEST are held at it. Repeated rows and ids are vectors of
    their own. A null id is kept; it comes last among the starts. Of equal hashes, the vector that
    sorts first comes first. With fewer kept vectors than `clusters` there are that many centroids,
    with none there are no rows. Columns but the two named are not read.

    The starts are the vectors with the smallest SHA-256 of `seed:id`. Each round is one scan: a task
    finds the nearest centroids of its vectors by Orchard's search and returns sums per centroid, so
    no vector is shuffled, whatever share of the vectors are equal. `clusters` * `dims` numbers pass
    through the driver in a round: the model itself.
    """
    spark = df.sparkSession
    vector = F.col(vector_col)
    kept = cut(
        df.filter((F.size(vector) == dims) & usable(vector)).select(
            F.col(id_col).alias("id"), integers(vector, scale).alias("x")
        )
    )
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    starts = kept.orderBy(F.asc_nulls_last(hashed), "x").limit(clusters).collect()
    kind = kept.schema["id"].dataType.simpleString()
    if not starts:
        none = "cluster int, distance long, cluster_inertia long, inertia long"
        return spark.createDataFrame([], f"`{id_col}` {kind}, {none}"), np.zeros((0, dims), np.int64)
    centroids = np.array([row["x"] for row in starts], np.int64)
    for _ in range(rounds):
        moved = centroids.copy()
        for c, (n, total) in _sums(kept, centroids).items():
            moved[c] = (total // n).astype(np.int64)
        if (moved == centroids).all():
            break  # settled: further rounds change nothing
        centroids = moved
    shared = spark.sparkContext.broadcast((centroids, *neighbour_lists(centroids)))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), ROWS):
                part = batch.slice(low, ROWS)
                at, far, _ = nearest(_rows(part, 1, dims), *shared.value)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(at.astype(np.int32)), pa.array(far)], names=["id", "cluster", "distance"]
                )

    found = cut(kept.select("id", "x").mapInArrow(assign, f"id {kind}, cluster int, distance long"))
    # one row a cluster; sums beyond 64 bits are held at the largest
    most = F.lit((1 << 63) - 1).cast("decimal(38,0)")
    each = {
        row["cluster"]: int(row["s"])
        for row in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    }
    sums = spark.createDataFrame(
        [(c, str(s), str(sum(each.values()))) for c, s in each.items()], "cluster int, own string, every string"
    ).select("cluster", *[F.least(F.col(c).cast("decimal(38,0)"), most).cast("long").alias(n) for c, n in (("own", "cluster_inertia"), ("every", "inertia"))])
    return found.join(F.broadcast(sums), "cluster").select(
        F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia"
    ), centroids


def with_digests(found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """The rows of `cluster` with the digest of their centroid's components."""
    digests = F.array(*[F.lit(centroid_digest(c)) for c in centroids], F.lit(None).cast("string"))
    return found.withColumn("centroid_sha256", F.get(digests, F.col("cluster")))
