import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from assaykit.operators import skew
from assaykit.operators.quantiles import exact_percentiles
from assaykit.operators.skew import attach, blocked_row_number, hot_keys


def hot_rows(spark, n=600, seed=1):
    rng = random.Random(seed)
    keys = ["hot"] * 10 + [None] * 4 + [f"k{i}" for i in range(15)]
    return spark.createDataFrame([(i, rng.choice(keys)) for i in range(n)], "id long, key string")


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("size", [None, "n"])
def test_attach_equals_plain_join(spark, how, size):
    rows = hot_rows(spark)
    facts = rows.filter("key is not null and key <> 'k3'").groupBy("key").agg(F.count("*").alias("n"))
    mine = attach(rows, facts, "key", F.col("id"), how=how, size=size, rows_per_task=20)
    plain = rows.join(facts, "key", how)
    assert sorted(mine.select("id", "key", "n").collect(), key=repr) == sorted(
        plain.select("id", "key", "n").collect(), key=repr
    )


def test_attach_spreads_the_hot_key(spark):
    rows = spark.range(1000).select("id", F.lit("hot").alias("key"))
    facts = rows.groupBy("key").agg(F.count("*").alias("n"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = attach(rows, facts, "key", F.col("id"), size="n", rows_per_task=50)
        parts = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(parts) > 1
    assert sum(p["count"] for p in parts) == 1000


@pytest.mark.parametrize("keys", [[], ["key"]])
def test_blocked_row_number_equals_window(spark, keys):
    rows = hot_rows(spark)
    mine = blocked_row_number(rows, keys, F.floor(F.col("id") / 37), [F.col("id")], "rn")
    window = Window.partitionBy(*(keys or [F.lit(1)])).orderBy("id")
    plain = rows.withColumn("rn", F.row_number().over(window))
    assert sorted(map(tuple, mine.select("id", "rn").collect())) == sorted(
        map(tuple, plain.select("id", "rn").collect())
    )


@pytest.mark.parametrize("accuracy", [100, 10_000])
def test_percentiles_are_exact(spark, accuracy):
    rng = np.random.default_rng(3)
    data = {"a": rng.normal(size=3000).round(2), "b": rng.exponential(size=700), "c": np.array([5.0])}
    rows = spark.createDataFrame(
        [(k, float(x)) for k, xs in data.items() for x in xs], "k string, v double"
    )
    probs = [0.0, 0.25, 0.5, 0.95, 0.99, 1.0]
    names = [f"p{i}" for i in range(len(probs))]
    got = exact_percentiles(rows, "k", "v", probs, names, accuracy=accuracy).collect()
    assert len(got) == 3
    for row in got:
        want = np.quantile(data[row["k"]], probs)
        assert np.allclose([row[n] for n in names], want, rtol=0, atol=1e-12)


def test_every_hot_key_is_split(spark):
    """More hot keys than a short list could name: each is spread, the result is the plain join."""
    rows = spark.range(1200 * 6).select("id", (F.col("id") % 1200).alias("key"))
    facts = rows.groupBy("key").agg(F.count("*").alias("n"))
    hot = hot_keys(facts, "key", "n", 2)
    assert hot.count() == 1200 and hot.agg(F.min("_copies"), F.max("_copies")).first() == (3, 3)
    joined = attach(rows, facts, "key", F.col("id"), size="n", rows_per_task=2)
    assert joined.count() == rows.count() and joined.select("id").distinct().count() == rows.count()


def test_hot_keys_need_no_broadcast(spark, monkeypatch):
    monkeypatch.setattr(skew, "BROADCAST_KEYS", 0)
    rows = hot_rows(spark)
    facts = rows.filter("key is not null").groupBy("key").agg(F.count("*").alias("n"))
    mine = attach(rows, facts, "key", F.col("id"), how="left", size="n", rows_per_task=20)
    assert sorted(mine.select("id", "n").collect(), key=repr) == sorted(
        rows.join(facts, "key", "left").select("id", "n").collect(), key=repr
    )
