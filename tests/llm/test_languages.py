"""Language mixtures: held-out accuracy, mixtures, and EM against a plain loop."""

import math
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from assaykit.llm import languages

SF = "/root/testdata/sf0.01"


@pytest.mark.skipif(not Path(SF).is_dir(), reason="no test tables")
def test_held_out_accuracy_and_mixture(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names, logp = languages.train(docs, "text", "lang", ~languages.held_out(F.col("doc_id")))
    right = docs.filter(languages.held_out(F.col("doc_id"))).withColumn(
        "found", languages.language_of(F.col("text"), names, logp, spark)
    )
    row = right.agg(F.count("*").alias("n"), F.count_if(F.col("found.lang") == F.col("lang")).alias("good")).first()
    assert row.n > 100 and row.good >= 0.98 * row.n
    halves = [docs.filter(F.col("lang") == l).orderBy("doc_id").first().text[:1500] for l in ("de", "fr")]
    mixed = spark.createDataFrame([(" ".join(halves),)], "text string")
    found = mixed.select(languages.language_of(F.col("text"), names, logp, spark).alias("f")).first().f
    assert {m.lang for m in found.mixture} == {"de", "fr"} and 0.3 < found.score < 0.7


def test_em_against_a_plain_loop():
    rng = np.random.default_rng(3)
    scores = np.log(rng.dirichlet(np.ones(3), 40))
    top = scores.max(1)
    got, like = languages._mixtures(
        np.exp(scores - top[:, None]), top, np.zeros(40, int), np.array([0]), np.ones((1, 3)), 30
    )
    shares = [1 / 3] * 3
    for _ in range(30):
        new = [0.0] * 3
        for row in np.exp(scores):
            whole = sum(s * p for s, p in zip(shares, row))
            new = [a + s * p / whole for a, s, p in zip(new, shares, row)]
        shares = [a / 40 for a in new]
    assert np.allclose(got[0], shares)
    assert math.isclose(like[0], sum(math.log(sum(s * p for s, p in zip(shares, r))) for r in np.exp(scores)))


def test_edge_rows(spark):
    rows = [
        (1, "aaa bbb aaa bbb abab", "x"), (2, "ccc ddd cdcd ccc ddd", "y"), (3, None, "x"), (4, "", None), (5, "12 34 €", "y"),
        (6, "é", None), (None, "aaa bbb", None), (7, "aaa bbb " * 60_000, None), (7, "ccc ddd", None), (7, "ccc ddd", None),
    ]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, score int")
    names, logp = languages.train(df, "text", "lang", F.col("lang").isNotNull())
    found = df.withColumn("f", languages.language_of(F.col("text"), names, logp, spark)).collect()
    assert [r.f.lang for r in found if r.text in (None, "", "12 34 €")] == ["und"] * 3
    assert all(r.f.lang == ("x" if "aaa" in r.text else "y") for r in found if r.text and ("aaa" in r.text or "ccc" in r.text))
    assert all(0 <= r.f.score <= 1 for r in found)
    kept = languages.keep_known(df.withColumn("language", F.lit(1)))
    assert kept.columns == [*df.columns, "language"]
    none = df.limit(0)
    assert languages.keep_known(none).collect() == []
    untrained = df.withColumn("lang", F.lit(None).cast("string")).withColumn("f", languages.identify(df.withColumn("lang", F.lit(None).cast("string"))))
    assert {r.f.lang for r in untrained.collect()} == {"und"}
