"""Token ids as raw payload shards with a minimal perfect hash index over document keys."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assaykit.llm.textbytes import buffers, mix, pieces
from assaykit.llm.tokens import END_ID, encoder, word_bpe

SHARD_TOKENS = 1 << 20
BUCKET_KEYS = 4096
SLOT_KEYS = 4
TRIALS = 64
RUN_ROWS = 1 << 16

SHARD_SCHEMA = (
    "part int, shard int, docs_before long, tokens_before long, n_docs long, n_tokens long, "
    "width int, keys array<{key}>, offsets array<long>, lengths array<long>, payload binary"
)
INDEX_SCHEMA = (
    "bucket long, n int, pilots binary, prints binary, part binary, shard binary, "
    "at binary, length binary, slot binary, copies binary"
)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_PRINT = np.uint64(0xD6E8FEB86659FD93)


def write_shards(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    end_id: int = END_ID,
    shard_tokens: int = SHARD_TOKENS,
) -> None:
    """Tokenise whole texts in ascending id order and write them under `path`/shards.

    Rows are spread by range of (id, text hash, place of the row), so a repeated id can span tasks,
    and sorted inside each range. A shard row holds the ids of whole documents one after another,
    little-endian and unsigned, 16 bits wide where the vocabulary allows and 32 otherwise, with the
    keys and lengths of its documents. Spark's committer writes the files, so a lost executor leaves
    none behind. A shard ends with the document that reaches `shard_tokens`. Null ids come first,
    null texts are empty and have the end id alone.
    """
    file = tokenizer or word_bpe()
    key = docs.schema[id_col].dataType.simpleString()

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(file)
        wide = np.dtype("<u2" if words.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        part, shard, docs_before, tokens_before = TaskContext.get().partitionId(), 0, 0, 0
        keys, flats, counts, held = [], [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal shard, docs_before, tokens_before
            ids, lengths = np.concatenate(flats), np.concatenate(counts)
            names = pa.concat_arrays(keys)
            whole = pa.array([0, len(names)], pa.int32())
            batch = pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([part], pa.int32()),
                    "shard": pa.array([shard], pa.int32()),
                    "docs_before": [docs_before],
                    "tokens_before": [tokens_before],
                    "n_docs": [len(names)],
                    "n_tokens": [len(ids)],
                    "width": pa.array([wide.itemsize], pa.int32()),
                    "keys": pa.ListArray.from_arrays(whole, names),
                    "offsets": pa.ListArray.from_arrays(whole, pa.array(np.cumsum(lengths) - lengths)),
                    "lengths": pa.ListArray.from_arrays(whole, pa.array(lengths, pa.int64())),
                    "payload": pa.array([ids.astype(wide).tobytes()], pa.binary()),
                }
            )
            shard, docs_before, tokens_before = shard + 1, docs_before + len(names), tokens_before + len(ids)
            return batch

        for batch in batches:
            _, off = buffers(batch.column(1))
            for low, high in pieces(off):
                ids, each = words.encode(batch.column(1)[low:high], end_id)
                keys.append(batch.column(0)[low:high])
                flats.append(ids)
                counts.append(each)
                held += len(ids)
                if held >= shard_tokens:
                    yield flush()
                    keys, flats, counts, held = [], [], [], 0
        if held:
            yield flush()

    order = [F.asc_nulls_first("id"), F.asc("tie"), F.asc("row")]
    (
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .withColumn("tie", F.xxhash64("text"))
        .withColumn("row", F.monotonically_increasing_id())
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("id", "text")
        .mapInArrow(shards, SHARD_SCHEMA.format(key=key))
        .write.option("compression", "zstd")
        .parquet(f"{path}/shards")
    )


def _placed(shards: DataFrame) -> DataFrame:
    """Shards with `first_slot` and `first_token`, the documents and tokens of all shards before:
    sums over the writing tasks added to the counts inside each. There is one sum for each partition
    of the write, a number that the session sets, so they are broadcast and the payload stays put."""
    before = Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        shards.groupBy(F.col("part").alias("p"))
        .agg(F.sum("n_docs").alias("d"), F.sum("n_tokens").alias("t"))
        .select(
            "p",
            F.coalesce(F.sum("d").over(before), F.lit(0)).alias("d"),
            F.coalesce(F.sum("t").over(before), F.lit(0)).alias("t"),
        )
    )
    return (
        shards.join(F.broadcast(parts), shards["part"] == parts["p"])
        .withColumn("first_slot", F.col("docs_before") + F.col("d"))
        .withColumn("first_token", F.col("tokens_before") + F.col("t"))
        .drop("p", "d", "t")
    )


def _hashed(keys: np.ndarray, seed: int) -> np.ndarray:
    return mix(keys.astype(np.int64).view(np.uint64) + np.uint64(seed + 1) * _STEP)


def _slots(hashes: np.ndarray, pilots: np.ndarray, n: int) -> np.ndarray:
    """The slot of each key under its group's pilot; a negative pilot names the slot itself."""
    pilot = pilots[(hashes >> np.uint64(32)) % np.uint64(len(pilots))]
    tried = mix(hashes ^ (pilot.astype(np.int64).view(np.uint64) * _PRINT)) % np.uint64(n)
    return np.where(pilot < 0, -pilot - 1, tried.astype(np.int64))


def prints(hashes: np.ndarray) -> np.ndarray:
    """The 32-bit fingerprint stored for a key."""
    return (mix(hashes ^ _PRINT) >> np.uint64(32)).astype(np.uint32)


def build_hash(keys: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Pilots of a minimal perfect hash over distinct 64-bit keys, and the slot of each key.

    Keys fall into groups of about SLOT_KEYS; from the largest group on, the first pilot is taken that
    sends all its keys to free slots, TRIALS pilots at a time. A group of one key has a free slot
    written into its pilot, which spares the long search at the end.
    """
    n = len(keys)
    hashes = _hashed(keys, seed)
    groups = max(1, -(-n // SLOT_KEYS))
    group = ((hashes >> np.uint64(32)) % np.uint64(groups)).astype(np.int64)
    order = np.argsort(group, kind="stable")
    sizes = np.bincount(group, minlength=groups)
    first = np.cumsum(sizes) - sizes
    pilots, free = np.zeros(groups, np.int64), np.ones(n, bool)
    slots = np.zeros(n, np.int64)
    for g in np.argsort(-sizes, kind="stable"):
        size = int(sizes[g])
        if size <= 1:
            break
        own = order[first[g] : first[g] + size]
        base = 0
        while True:
            tries = np.arange(base, base + TRIALS, dtype=np.uint64)
            at = (mix(hashes[own][None, :] ^ (tries * _PRINT)[:, None]) % np.uint64(n)).astype(np.int64)
            at.sort(axis=1)
            good = free[at].all(1) & (np.diff(at, axis=1) > 0).all(1)
            if good.any():
                pilots[g] = base + int(np.argmax(good))
                pilot = np.array([pilots[g]], np.uint64)
                slots[own] = (mix(hashes[own] ^ (pilot * _PRINT)) % np.uint64(n)).astype(np.int64)
                free[slots[own]] = False
                break
            base += TRIALS
    single = np.flatnonzero(sizes == 1)
    spots = np.flatnonzero(free)
    pilots[single] = -spots - 1
    slots[order[first[single]]] = spots
    return pilots, slots


def _bucket(key: Column, buckets: int) -> Column:
    return F.when(key.isNull(), -1).otherwise(F.pmod(F.xxhash64(key), F.lit(buckets))).cast("long")


def build_index(spark: SparkSession, path: str) -> None:
    """Index the shards under `path`: `path`/index has one minimal perfect hash for every bucket of
    some BUCKET_KEYS distinct keys (integers; the null key has a bucket of its own), with the
    fingerprint, the shard, token offset and length of the first document of each key, its place in
    the whole order and the number of documents under it, which lie side by side."""
    shards = spark.read.parquet(f"{path}/shards").drop("payload")
    entries = (
        _placed(shards)
        .select(
            "part",
            "shard",
            "first_slot",
            F.posexplode(F.arrays_zip("keys", "offsets", "lengths")).alias("pos", "e"),
        )
        .groupBy(F.col("e.keys").cast("long").alias("key"))
        .agg(
            F.min(
                F.struct(
                    (F.col("first_slot") + F.col("pos")).alias("slot"),
                    "part",
                    "shard",
                    F.col("e.offsets").alias("at"),
                    F.col("e.lengths").alias("n"),
                )
            ).alias("f"),
            F.count("*").alias("copies"),
        )
    )
    n_docs = shards.agg(F.coalesce(F.sum("n_docs"), F.lit(0))).first()[0]
    buckets = max(1, -(-n_docs // BUCKET_KEYS))

    def build(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        keys = table.column("key").fill_null(0).to_numpy()
        pilots, slots = build_hash(keys, bucket)
        order = np.argsort(slots)
        columns = {"bucket": [bucket], "n": pa.array([len(keys)], pa.int32())}
        binary = {"pilots": pilots.astype("<i4"), "prints": prints(_hashed(keys, bucket))[order]}
        for name in ("part", "shard", "at", "length", "slot", "copies"):
            binary[name] = table.column(name).to_numpy()[order].astype("<i8")
        columns |= {k: pa.array([v.tobytes()], pa.binary()) for k, v in binary.items()}
        return pa.table(columns).select([c.split()[0] for c in INDEX_SCHEMA.split(", ")])

    (
        entries.select(
            _bucket(F.col("key"), buckets).alias("bucket"),
            "key",
            F.col("f.part").cast("long").alias("part"),
            F.col("f.shard").cast("long").alias("shard"),
            "f.at",
            F.col("f.n").alias("length"),
            "f.slot",
            "copies",
        )
        .groupBy("bucket")
        .applyInArrow(build, INDEX_SCHEMA)
        .write.parquet(f"{path}/index")
    )


def lookup(spark: SparkSession, path: str, keys: DataFrame, key_col: str = "doc_id") -> DataFrame:
    """(key, part, shard, at, length, slot, copies) of the keys that the index holds: hash, pilot,
    slot, fingerprint. An absent key gives no row (a wrong one with probability 2^-32)."""
    index = spark.read.parquet(f"{path}/index")
    most = index.agg(F.max("bucket")).first()[0]
    kind = keys.schema[key_col].dataType.simpleString()
    total = spark.read.parquet(f"{path}/shards").agg(F.coalesce(F.sum("n_docs"), F.lit(0))).first()[0]
    buckets = max(1, -(-total // BUCKET_KEYS))
    out = f"`{key_col}` {kind}, part int, shard int, at long, length long, slot long, copies long"
    if most is None:
        return spark.createDataFrame([], out)
    asked = keys.select(F.col(key_col).alias("key")).distinct().withColumn("bucket", _bucket(F.col("key"), buckets))

    def find(table: pa.Table, rows: pa.Table) -> pa.Table:
        schema = pa.schema(
            [(key_col, table.schema.field("key").type), ("part", pa.int32()), ("shard", pa.int32())]
            + [(c, pa.int64()) for c in ("at", "length", "slot", "copies")]
        )
        if not len(rows) or not len(table):
            return schema.empty_table()
        row = rows.to_pylist()[0]
        hashes = _hashed(table.column("key").fill_null(0).to_numpy(), row["bucket"])
        slots = _slots(hashes, np.frombuffer(row["pilots"], "<i4").astype(np.int64), row["n"])
        known = np.flatnonzero(np.frombuffer(row["prints"], np.uint32)[slots] == prints(hashes))
        found = [table.column("key").combine_chunks().take(pa.array(known))]
        for name, field in zip(("part", "shard", "at", "length", "slot", "copies"), list(schema)[1:]):
            found.append(pa.array(np.frombuffer(row[name], "<i8")[slots[known]], field.type))
        return pa.Table.from_arrays(found, schema=schema)

    return asked.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInArrow(find, out)


def fetch(spark: SparkSession, path: str, keys: DataFrame, key_col: str = "doc_id") -> DataFrame:
    """(key, ids) of the first document under each key, sliced out of its shard's payload."""
    shards = spark.read.parquet(f"{path}/shards").select("part", "shard", "width", "payload")
    data = F.substr("payload", (F.col("at") * F.col("width") + 1).cast("int"), (F.col("length") * F.col("width")).cast("int"))
    return (
        lookup(spark, path, keys, key_col)
        .join(shards, ["part", "shard"])
        .select(key_col, "width", data.alias("ids"))
    )


def read_payload(spark: SparkSession, path: str) -> DataFrame:
    """(slot, start, n_tokens, ids_crc32) of every document in the shards, in order of the slots."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for slot, token, width, lengths, payload in zip(
                *(batch.column(i) for i in range(5))
            ):
                each = lengths.values.to_numpy()
                ids = np.frombuffer(payload.as_buffer(), f"<u{width.as_py()}").astype("<u4")
                data, ends = memoryview(ids).cast("B"), np.cumsum(each)
                crc = [zlib.crc32(data[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), each.tolist())]
                yield pa.RecordBatch.from_pydict(
                    {
                        "slot": slot.as_py() + np.arange(len(each)),
                        "start": token.as_py() + ends - each,
                        "n_tokens": each,
                        "ids_crc32": np.array(crc, np.int64),
                    }
                )

    shards = _placed(spark.read.parquet(f"{path}/shards"))
    return shards.select("first_slot", "first_token", "width", "lengths", "payload").mapInArrow(
        scan, "slot long, start long, n_tokens long, ids_crc32 long"
    )


def read_documents(spark: SparkSession, path: str, keys: DataFrame, key_col: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, ids_crc32), one row per stored document of the given keys: the index
    names the slots of each key, the payload gives what lies there."""
    found = lookup(spark, path, keys, key_col)
    # a key may have any number of documents: slots unfold by runs, then one by one
    runs = found.select(
        key_col,
        (F.col("slot") + F.col("copies")).alias("stop"),
        F.explode(F.sequence("slot", F.col("slot") + F.col("copies") - 1, F.lit(RUN_ROWS))).alias("low"),
    )
    slots = runs.select(
        key_col, F.explode(F.sequence("low", F.least(F.col("low") + RUN_ROWS, "stop") - 1)).alias("slot")
    )
    return slots.join(read_payload(spark, path), "slot").drop("slot")
