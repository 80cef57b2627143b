"""Mini-batch training against a plain loop, its history and its checkpoints."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from assaykit.operators import evaluation, training


def frame(spark, x, y, start=0):
    rows = [(start + i, int(label), [float(v) for v in row]) for i, (row, label) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "item long, label int, features array<double>")


def clouds(seed, n, classes=3, dims=4):
    rng = np.random.default_rng(seed)
    centres = np.random.default_rng(0).normal(0, 2, (classes, dims))
    y = np.minimum(rng.integers(0, classes + 2, n), classes - 1)  # the last class is the majority
    return centres[y] + rng.normal(0, 0.7, (n, dims)), y


def test_one_part_is_plain_gradient_descent(spark):
    x, y = clouds(1, 90)
    df = frame(spark, x, y)
    fitted = training.fit_epochs(df, df, 3, epochs=4, slots=1, decay=0.01)
    z = np.hstack([(x - x.mean(0)) / x.std(0), np.ones((len(x), 1))])
    w, speed, best, hits = np.zeros((5, 3)), np.zeros((5, 3)), None, -1
    for epoch in range(1, 5):
        p = np.exp(z @ w) / np.exp(z @ w).sum(1, keepdims=True)
        p[np.arange(len(y)), y] -= 1
        speed = 0.9 * speed - training.learning_rate(epoch, 4, 1.0) * (z.T @ p / len(y) + 0.01 * w)
        w = w + speed
        now = ((z @ w).argmax(1) == y).mean()
        if now > hits:
            best, hits, at = w, now, epoch
    assert fitted.best_epoch == at and np.allclose(fitted.weights, best, atol=1e-9)


def test_training_learns_and_records(spark):
    train, test = frame(spark, *clouds(2, 400)), frame(spark, *clouds(3, 150), start=1000)
    fitted = training.fit_epochs(train, test, 3, epochs=5, slots=3)
    rows = [r.asDict() for r in fitted.history.orderBy("epoch").collect()]
    assert [r["epoch"] for r in rows] == [1, 2, 3, 4, 5]
    assert rows[-1]["train_loss"] < rows[0]["train_loss"] and rows[-1]["learning_rate"] < rows[0]["learning_rate"]
    assert all(r["epoch_time_sec"] > 0 for r in rows)
    labels = [r["label"] for r in test.collect()]
    majority = max(labels.count(c) for c in set(labels)) / len(labels)
    best = rows[fitted.best_epoch - 1]
    assert best["val_acc"] == max(r["val_acc"] for r in rows) > majority + 0.2
    quality = evaluation.quality_metrics(training.score(test, fitted)).first()
    assert quality["accuracy"] == best["val_acc"] and quality["f1_weighted"] == best["val_f1_weighted"]
    assert sorted(fitted.checkpoints)[-1] == fitted.best_epoch
    assert np.array_equal(training.load(spark, fitted.checkpoints[fitted.best_epoch]), fitted.weights)
    again = training.fit_epochs(train.repartition(7), test, 3, epochs=5, slots=3)
    assert np.allclose(again.weights, fitted.weights)
    log = training.as_run_log(fitted.history, "r1", 1000)
    assert log.count() == 5 * 7 and log.filter("key = 'val_f1_weighted'").count() == 5
    times = [r["ts"] for r in log.filter("key = 'val_acc'").orderBy("step").collect()]
    assert times == sorted(times) and times[0] >= 1000


def test_odd_rows_and_empty_tables(spark):
    x, y = clouds(4, 60)
    df = frame(spark, x, y)
    odd = spark.createDataFrame(
        [(900, None, [1.0] * 4), (901, 1, [float("nan"), None, 1.0, float("inf")])],
        "item long, label int, features array<double>",
    )
    clean = df.withColumn("slot", F.lit("s")).withColumn("pred", F.lit(9))
    fitted = training.fit_epochs(clean, odd.filter("item = 901"), 3, epochs=1, slots=5)
    assert fitted.history.first()["val_acc"] in (0.0, 1.0)
    assert training.score(odd, fitted).filter("pred IS NULL").count() == 0
    assert training.score(odd.limit(0), fitted).collect() == []
    none = training.fit_epochs(df, df.limit(0), 3, epochs=1)
    assert none.history.first()["val_acc"] is None and none.best_epoch == 1
    with pytest.raises(ValueError):
        training.fit_epochs(df.limit(0), df, 3, epochs=1)
