"""Exact inner-product search over norm-sorted blocks with bounds from rotated partial sums."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assaykit.llm.textbytes import ragged
from assaykit.session import cut

SCALE = 256
BLOCK = 1024
SHARE = 32
STEP = 256
HEAD_DIMS = 16
SLACK = 1e-9
#: A score that is not there yet; the scores themselves lie above it.
NONE = np.iinfo(np.int64).min
MOST = np.iinfo(np.int64).max
BLOCK_SCHEMA = "top double, ids binary, rows binary, dims int, keys binary"


def usable(vector: Column) -> Column:
    """Neither null nor holding a null, NaN or infinite component."""
    odd = F.exists(
        vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")).cast("double"))
    )
    return vector.isNotNull() & ~odd


def _matrix(column: pa.Array, dims: int, scale: int) -> np.ndarray:
    """floor(scale * x) as exact doubles, rows padded with zeros to `dims`."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(column.offsets.to_numpy(zero_copy_only=False))
    out = np.zeros((len(column), dims))
    rows = np.repeat(np.arange(len(column)), lengths)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out[rows, ragged(lengths)] = np.floor(values * scale)
    return out


def _blocks(df: DataFrame, dims: int, scale: int, size: int) -> DataFrame:
    """Rows (id, vector, key) in descending norm as blocks of `size`, each with its largest norm."""

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ids, keys = [], [], []

        def flush() -> Iterator[pa.RecordBatch]:
            rows, names, numbers = np.concatenate(held), np.concatenate(ids), np.concatenate(keys)
            order = np.argsort(-(rows * rows).sum(1), kind="stable")
            rows, names, numbers = rows[order], names[order], numbers[order]
            for low in range(0, len(rows), size):
                part = np.ascontiguousarray(rows[low : low + size])
                top = float(np.sqrt((part * part).sum(1).max()))
                yield pa.RecordBatch.from_pydict(
                    {
                        "top": [top],
                        "ids": pa.array([names[low : low + size].tobytes()], pa.binary()),
                        "rows": pa.array([part.tobytes()], pa.binary()),
                        "dims": pa.array([dims], pa.int32()),
                        "keys": pa.array([numbers[low : low + size].tobytes()], pa.binary()),
                    }
                )

        for batch in batches:
            held.append(_matrix(batch.column(1), dims, scale))
            ids.append(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64))
            keys.append(batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64))
            if sum(map(len, held)) >= size:
                yield from flush()
                held, ids, keys = [], [], []
        if held:
            yield from flush()

    def squared(x: Column) -> Column:
        whole = F.floor(x.cast("double") * scale).cast("double")
        return whole * whole

    norm = F.aggregate("vector", F.lit(0.0), lambda a, x: a + squared(x))
    ordered = df.withColumn("norm", norm)
    ordered = ordered.repartitionByRange(F.desc("norm"), F.asc("id"), F.asc("key")).sortWithinPartitions(
        F.desc("norm"), F.asc("id"), F.asc("key")
    )
    return ordered.select("id", "vector", "key").mapInArrow(block, BLOCK_SCHEMA)


def rotation(df: DataFrame, dims: int, scale: int) -> np.ndarray:
    """Right singular vectors of all rows, from their Gram matrix: tasks add up their own, Spark adds
    the cells, and dims * dims sums reach the driver."""

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for batch in batches:
            x = _matrix(batch.column(0), dims, scale)
            total += x.T @ x
        yield pa.RecordBatch.from_pydict(
            {"cell": np.arange(dims * dims, dtype=np.int64), "v": total.ravel()}
        )

    cells = df.select("vector").mapInArrow(gram, "cell long, v double").groupBy("cell").agg(F.sum("v"))
    total = np.zeros(dims * dims)
    for cell, value in cells.collect():
        total[cell] = value
    total = total.reshape(dims, dims)
    if not np.isfinite(total).all():
        return np.eye(dims)
    values, vectors = np.linalg.eigh((total + total.T) / 2)
    return np.ascontiguousarray(vectors[:, np.argsort(-values)])


def _load(ids: bytes, rows: bytes, keys: bytes, dims: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.frombuffer(ids, np.int64), np.frombuffer(rows, np.float64).reshape(-1, dims), np.frombuffer(keys, np.int64)


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers held as doubles, exact as integers. What a long cannot hold is
    drawn to its ends, which no smaller score reaches."""
    largest = np.sqrt((q * q).sum(1).max(initial=0)) * np.sqrt((c * c).sum(1).max(initial=0))
    if largest < 2.0**52:
        return (q @ c.T).astype(np.int64)
    if largest < 2.0**62 and max(np.abs(q).max(), np.abs(c).max()) < 2.0**62:
        return q.astype(np.int64) @ c.astype(np.int64).T
    whole = np.vectorize(int, otypes=[object])
    return np.clip(whole(q) @ whole(c).T, NONE + 1, MOST).astype(np.int64)


def _bar(best: np.ndarray) -> np.ndarray:
    """The last of each row's best scores, as a bound."""
    return np.where(best[:, -1] > NONE, best[:, -1].astype(np.float64), -np.inf)


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores of each row, ties to the smaller id."""
    order = np.argsort(ids, axis=1, kind="stable")
    ids, scores = np.take_along_axis(ids, order, 1), np.take_along_axis(scores, order, 1)
    # the complement turns the order round and, unlike the negative, stays within a long
    order = np.argsort(~scores, axis=1, kind="stable")[:, :k]
    return np.take_along_axis(ids, order, 1), np.take_along_axis(scores, order, 1)


def search_tile(
    q_keys: np.ndarray,
    q: np.ndarray,
    floor: np.ndarray,
    c_ids: np.ndarray,
    c: np.ndarray,
    basis: np.ndarray,
    k: int,
    head: int = HEAD_DIMS,
    step: int = STEP,
    c_keys: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray, int]:
    """The best k candidates of each query in one block sorted by descending norm, and the number of
    products computed in full. `floor` is a score that k candidates of the query are known to reach.
    Keys name rows, so that a query's own row is left out; without `c_keys` they are the ids.

    A query leaves once its norm times the next candidate's norm stays below its k-th score; of the
    rest, the first `head` rotated components plus the product of the residual norms bound each
    score from above, and only what the bound leaves is multiplied in full.
    """
    c_keys = c_ids if c_keys is None else c_keys
    qn, cn = np.sqrt((q * q).sum(1)), np.sqrt((c * c).sum(1))
    qr, cr = q @ basis, c @ basis
    q_rest, c_rest = np.sqrt((qr[:, head:] ** 2).sum(1)), np.sqrt((cr[:, head:] ** 2).sum(1))
    ids = np.full((len(q), k), np.iinfo(np.int64).max)
    best = np.full((len(q), k), NONE)
    full = 0
    for low in range(0, len(c), step):
        part = slice(low, min(low + step, len(c)))
        bar = np.maximum(floor, _bar(best))
        slack = SLACK * (qn * cn[low] + 1)
        alive = np.flatnonzero(qn * cn[low] + slack >= bar)
        if not len(alive):
            break
        bound = qr[alive, :head] @ cr[part, :head].T + np.outer(q_rest[alive], c_rest[part])
        hit = bound >= (bar - slack)[alive, None]
        hit &= c_keys[None, part] != q_keys[alive, None]
        rows, cols = np.flatnonzero(hit.any(1)), np.flatnonzero(hit.any(0))
        if not len(rows):
            continue
        who, hit = alive[rows], hit[np.ix_(rows, cols)]
        scores = np.where(hit, products(q[who], c[part][cols]), NONE)
        full += int(hit.sum())
        both_ids = np.concatenate([ids[who], np.broadcast_to(c_ids[part][cols], hit.shape)], 1)
        ids[who], best[who] = _best(both_ids, np.concatenate([best[who], scores], 1), k)
    return ids, best, full


def top_inner_products(
    df: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 5,
    scale: int = SCALE,
    block: int = BLOCK,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that `is_query` selects, the k highest inner
    products of floor(scale * x) with the other rows, ties to the smaller id. Exact: doubles bound the
    scores, integers rank them. A result that a long cannot hold is an error.

    Vectors are sorted by descending norm into blocks. The block with the largest norms (its size is
    a parameter) gives every query a first k-th score; then each block of queries
    meets the candidate blocks whose largest norm can still matter, in shares of about SHARE blocks, so
    no task holds more than that. Each share returns at most k rows a query.

    Null ids and vectors that are null or hold null or non-finite components take no part; shorter
    vectors count as padded with zeros. Rows with one id are rows of their own, as queries and as
    candidates: a query leaves out its own row alone. Other columns are not read.
    """
    spark = df.sparkSession
    rows = cut(
        df.filter(F.col(id_col).isNotNull() & usable(F.col(vector_col)))
        .select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"), is_query.alias("q"))
        .withColumn("key", F.monotonically_increasing_id())
    )
    dims = rows.agg(F.max(F.size("vector"))).first()[0] or 1
    basis = rotation(rows, dims, scale)
    candidates = cut(_blocks(rows, dims, scale, block).withColumn("c", F.monotonically_increasing_id()))
    asked = _blocks(rows.filter("q"), dims, scale, block)
    first = candidates.orderBy(F.desc("top"), "c").limit(1).collect()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not first:
        return empty
    seed_ids, seed, seed_keys = _load(first[0]["ids"], first[0]["rows"], first[0]["keys"], dims)

    def floors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bars, needs = [], []
            for ids, vectors, keys in zip(*(batch.column(i).to_pylist() for i in (1, 2, 4))):
                _, q, q_keys = _load(ids, vectors, keys, dims)
                none = np.full(len(q), -np.inf)
                bar = _bar(search_tile(q_keys, q, none, seed_ids, seed, basis, k, c_keys=seed_keys)[1])
                norm = np.sqrt((q * q).sum(1))
                bars.append(bar.tobytes())
                with np.errstate(divide="ignore", invalid="ignore"):
                    need = np.where(norm > 0, bar / norm, np.where(bar > 0, np.inf, -np.inf))
                needs.append(float(need.min()))
            columns = [*batch.columns, pa.array(bars, pa.binary()), pa.array(needs, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "bars", "need"])

    queries = cut(
        asked.mapInArrow(floors, BLOCK_SCHEMA + ", bars binary, need double").withColumn(
            "g", F.monotonically_increasing_id()
        )
    )
    needs = [F.struct(F.lit(g).alias("g"), F.lit(need).alias("need")) for g, need in queries.select("g", "need").collect()]
    if not needs:
        return empty
    shares = -(-candidates.count() // SHARE)
    able = F.filter(F.array(*needs), lambda m: m["need"] <= F.col("top") * (1 + SLACK) + SLACK)
    left = candidates.withColumn("g", F.explode(F.transform(able, lambda m: m["g"]))).withColumn(
        "s", F.pmod(F.xxhash64("c"), F.lit(shares))
    )
    right = queries.withColumn("s", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shares - 1).cast("long"))))

    def tile(blocks: pa.Table, asked: pa.Table) -> pa.Table:
        found = {"key": [], "query_id": [], "vec_id": [], "score": []}
        for query in asked.to_pylist():
            q_ids, q, q_keys = _load(query["ids"], query["rows"], query["keys"], dims)
            bar = np.frombuffer(query["bars"], np.float64)
            ids = np.full((len(q), k), np.iinfo(np.int64).max)
            best = np.full((len(q), k), NONE)
            order = np.argsort(-blocks.column("top").to_numpy(), kind="stable")
            for i in order.tolist():
                row = {n: blocks.column(n)[i].as_py() for n in ("ids", "rows", "keys")}
                c_ids, c, c_keys = _load(row["ids"], row["rows"], row["keys"], dims)
                bar = np.maximum(bar, _bar(best))
                more = search_tile(q_keys, q, bar, c_ids, c, basis, k, c_keys=c_keys)
                ids, best = _best(
                    np.concatenate([ids, more[0]], 1), np.concatenate([best, more[1]], 1), k
                )
            some = best > NONE
            if (np.abs(best[some]) == MOST).any():
                raise OverflowError("a score among the best does not fit a long")
            found["key"].append(np.repeat(q_keys, some.sum(1)))
            found["query_id"].append(np.repeat(q_ids, some.sum(1)))
            found["vec_id"].append(ids[some])
            found["score"].append(best[some])
        none = [np.zeros(0, np.int64)]
        return pa.table({n: np.concatenate(v or none) for n, v in found.items()})

    found = left.groupBy("g", "s").cogroup(right.groupBy("g", "s")).applyInArrow(
        tile, "key long, query_id long, vec_id long, score long"
    )
    order = Window.partitionBy("key").orderBy(F.desc("score"), F.asc("vec_id"))
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
