"""A linear classifier trained by distributed mini-batches, epoch by epoch, with its whole history."""

from __future__ import annotations

import math
import random
import time
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assaykit.functions.numeric import half_even
from assaykit.operators.evaluation import metrics_from_counts
from assaykit.session import cut, scratch_path

HISTORY = "epoch int, train_loss double, train_acc double, val_loss double, learning_rate double, epoch_time_sec double"


@dataclass
class Fitted:
    """Weights of the best epoch, (features + 1) x classes, and where each better one was written."""

    weights: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    best_epoch: int
    history: DataFrame
    checkpoints: dict[int, str] = field(default_factory=dict)


def learning_rate(epoch: int, epochs: int, first: float) -> float:
    """Half a cosine from `first` down to a hundredth of it."""
    return first * (0.01 + 0.99 * (1 + math.cos(math.pi * (epoch - 1) / max(1, epochs))) / 2)


def _rows(column: pa.Array, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Features as a matrix with a last column of ones, centred and scaled; what is missing or not
    finite counts as the mean."""
    values = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)
    x = (values - mean) / scale
    return np.hstack([np.where(np.isfinite(x), x, 0.0), np.ones((len(x), 1))])


def _probs(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    z = x @ weights
    z = np.exp(z - z.max(1, keepdims=True))
    return z / z.sum(1, keepdims=True)


def _sums(df: DataFrame, weights: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Gradient sums, then rows, loss and hits over all rows: each task adds up its own, Spark adds the
    tasks' cells, and as many numbers as the model has reach the driver."""
    shared = df.sparkSession.sparkContext.broadcast((weights, mean, scale))
    cells = weights.size + 3

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, centre, spread = shared.value
        total = np.zeros(cells)
        for batch in batches:
            if not len(batch):
                continue
            x, y = _rows(batch.column(1), centre, spread), batch.column(0).to_numpy()
            p = _probs(x, w)
            total[-3] += len(y)
            total[-2] -= np.log(np.maximum(p[np.arange(len(y)), y], 1e-300)).sum()
            total[-1] += (p.argmax(1) == y).sum()
            p[np.arange(len(y)), y] -= 1
            total[:-3] += (x.T @ p).ravel()
        yield pa.RecordBatch.from_pydict({"cell": np.arange(cells), "v": total})

    found = df.select("label", "features").mapInArrow(scan, "cell long, v double")
    out = np.zeros(cells)
    for cell, value in found.groupBy("cell").agg(F.sum("v")).collect():
        out[cell] = value
    shared.unpersist()
    return out


def score(df: DataFrame, fitted: Fitted, name: str = "linear") -> DataFrame:
    """(model, item, label, pred, probs) of every row; ties go to the smaller class."""
    shared = df.sparkSession.sparkContext.broadcast((fitted.weights, fitted.mean, fitted.scale))
    kind = df.schema["item"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, mean, scale = shared.value
        for batch in batches:
            if not len(batch):
                continue
            p = _probs(_rows(batch.column(2), mean, scale), w)
            ends = pa.array(np.arange(len(p) + 1, dtype=np.int32) * p.shape[1])
            probs = pa.ListArray.from_arrays(ends, pa.array(p.ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(p.argmax(1).astype(np.int32)), probs],
                names=["item", "label", "pred", "probs"],
            )

    rows = df.select("item", F.col("label").cast("int").alias("label"), "features")
    found = rows.mapInArrow(scan, f"item {kind}, label int, pred int, probs array<double>")
    return found.select(F.lit(name).alias("model"), "*")


def fit_epochs(
    train: DataFrame,
    val: DataFrame,
    classes: int,
    epochs: int = 10,
    slots: int = 4,
    rate: float = 1.0,
    momentum: float = 0.9,
    decay: float = 1e-4,
    seed: int = 42,
) -> Fitted:
    """Softmax regression over (item, label, features), labels 0 to classes - 1, by mini-batch gradient
    descent.

    The training rows are written once in `slots` parts by a hash of their item; a step reads one part,
    its tasks return gradient sums, and the driver moves the weights by the mean gradient with momentum
    under a cosine schedule. The order of the parts changes from epoch to epoch with the seed. So a step
    is one synchronous mini-batch over the whole cluster, and its result does not depend on how rows
    are spread, but for the order of sums. After each epoch all of `val` is counted, and the weights of
    a better accuracy are written to the shared folder. Rows with a null label are left out; an empty
    training set is an error. `slots` sets how many rows a step sees: the rows divided by it.

    The history has a row per epoch: train_loss, train_acc (as met during the epoch), val_loss, val_acc,
    val_f1_weighted, learning_rate, epoch_time_sec.
    """
    spark = train.sparkSession
    known = F.col("label").isNotNull()
    slot = F.pmod(F.xxhash64("item", F.lit(seed)), F.lit(slots)).cast("int")
    path = scratch_path(spark, "training")
    parts = train.filter(known).select(F.col("label").cast("int").alias("label"), "features", slot.alias("slot"))
    parts.write.partitionBy("slot").parquet(path)
    rows = spark.read.schema(parts.schema).parquet(path)
    val = cut(val.filter(known).select(F.col("label").cast("int").alias("label"), "features", F.lit(0).cast("long").alias("item")))
    each = rows.select(F.posexplode("features").alias("i", "x")).groupBy("i").agg(F.avg("x").alias("m"), F.stddev_pop("x").alias("s"))
    facts = {r["i"]: (r["m"], r["s"]) for r in each.collect()}
    if not facts:
        raise ValueError("no rows to train on")
    mean = np.array([facts[i][0] or 0.0 for i in range(len(facts))])
    scale = np.array([facts[i][1] or 1.0 for i in range(len(facts))])
    weights = np.zeros((len(mean) + 1, classes))
    speed, best, fitted, history, counts = np.zeros_like(weights), -1.0, None, [], []
    checkpoints: dict[int, str] = {}
    for epoch in range(1, epochs + 1):
        began = time.perf_counter()
        step, seen = learning_rate(epoch, epochs, rate), np.zeros(3)
        order = list(range(slots))
        random.Random(seed + epoch).shuffle(order)
        for part in order:
            sums = _sums(rows.filter(F.col("slot") == part), weights, mean, scale)
            if not sums[-3]:
                continue
            seen += sums[-3:]
            gradient = sums[:-3].reshape(weights.shape) / sums[-3] + decay * weights
            speed = momentum * speed - step * gradient
            weights = weights + speed
        found = Fitted(weights, mean, scale, epoch, None)
        scored = score(val, found, str(epoch))
        lost = -F.log(F.greatest(F.get("probs", F.col("label")), F.lit(1e-300)))
        met = [r for r in scored.groupBy("model", "label", "pred").agg(F.count("*").alias("n"), F.sum(lost).alias("lost")).collect()]
        n = sum(r["n"] for r in met)
        hits = sum(r["n"] for r in met if r["label"] == r["pred"]) / n if n else 0.0
        counts += [(epoch, r["label"], r["pred"], r["n"]) for r in met]
        took = time.perf_counter() - began
        history.append(
            (epoch, float(seen[1] / seen[0]), float(seen[2] / seen[0]), sum(r["lost"] for r in met) / n if n else None, step, took)
        )
        if hits > best:
            best, fitted = hits, found
            checkpoints[epoch] = save(spark, weights, epoch)
    fitted.history = _history(spark, history, counts)
    fitted.checkpoints = checkpoints
    return fitted


def _history(spark: SparkSession, rows: list[tuple], counts: list[tuple]) -> DataFrame:
    confusion = spark.createDataFrame(counts, "model int, label int, pred int, n long")
    quality = metrics_from_counts(confusion).select(
        F.col("model").alias("epoch"), F.col("accuracy").alias("val_acc"), F.col("f1_weighted").alias("val_f1_weighted")
    )
    plain = spark.createDataFrame(rows, HISTORY)

    def rounded(name: str, digits: int) -> Column:
        return half_even(F.col(name), digits).alias(name)

    return plain.join(quality, "epoch", "left").select(
        "epoch",
        rounded("train_loss", 5),
        rounded("train_acc", 4),
        rounded("val_loss", 5),
        "val_acc",
        "val_f1_weighted",
        "learning_rate",
        "epoch_time_sec",
    )


def save(spark: SparkSession, weights: np.ndarray, epoch: int) -> str:
    """The weights as a table (row, weights), one row a feature and the last the constant."""
    path = scratch_path(spark, f"weights-{epoch}")
    rows = [(i, [float(x) for x in row]) for i, row in enumerate(weights)]
    spark.createDataFrame(rows, "row int, weights array<double>").coalesce(1).write.parquet(path)
    return path


def load(spark: SparkSession, path: str) -> np.ndarray:
    return np.array([r["weights"] for r in spark.read.parquet(path).orderBy("row").collect()])


def as_run_log(history: DataFrame, run_id: str, started_ms: int = 0) -> DataFrame:
    """The history as metric lines (run_id, key, step, ts, value), as a run store holds them; the time
    of a line is that of the end of its epoch."""
    keys = [c for c in history.columns if c != "epoch"]
    upto = F.sum("epoch_time_sec").over(Window.orderBy("epoch"))  # one row an epoch
    timed = history.withColumn("ts", (F.lit(started_ms) + upto * 1000).cast("long"))
    lines = F.array(*[F.struct(F.lit(k).alias("key"), F.col(k).cast("double").alias("value")) for k in keys])
    return timed.select(F.lit(run_id).alias("run_id"), F.explode(lines).alias("l"), F.col("epoch").alias("step"), "ts").select(
        "run_id", "l.key", "step", "ts", "l.value"
    )
