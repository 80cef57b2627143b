"""Every stage keeps what it should, with all columns, whatever the rows."""

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from assaykit.llm import bitmaps, contamination, jaccard, rowlists
from assaykit.session import cut

COPY = "seven words that stand in this copied text one two three four"
ROWS = [
    (1, COPY, "x", "s", 10, "a"), (2, COPY.upper(), "x", "s", 10, "b"), (2, COPY.upper(), "x", "s", 10, "b"),
    (3, "another text entirely with token=abcdefghijklmnop inside", "x", "s", 10, "c"), (4, None, None, None, None, None),
    (5, "", "x", "s", 0, "d"), (None, COPY, "x", "s", 10, "e"), (None, "text without any id at all here", "x", "s", 1, "f"),
    (6, "12 34 56", "x", "s", 8, "g"), (7, "we saw the benchmark passage of ten words or more that nobody should ever see", "x", "s", 1, "h"),
    (8, "twice the same row", "x", "s", 1, "i"), (8, "twice the same row", "x", "s", 1, "i"),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, component string"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(ROWS, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    items = [(1, "benchmark passage of ten words or more that nobody should ever"), (2, None)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_stages_keep_columns_and_take_effect(spark, tables):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, tables)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        docs = out
    left = sorted(((r.doc_id, r.text) for r in docs.collect()), key=repr)
    assert left == sorted(
        [(1, COPY), (3, "another text entirely with [secret] inside"), (None, "text without any id at all here"), (8, "twice the same row")],
        key=repr,
    )


def test_near_duplicates_keep_one(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    kept = sorted((r.component or "" for r in jaccard.keep_one(docs).collect()))
    assert kept == sorted(["a", "c", "", "d", "f", "g", "h", "i"])


def test_run_and_empty(spark, tables):
    pieces = corpus_pipeline.run(spark, tables).collect()
    assert {p.doc_id for p in pieces} == {1, 3, 8, None}
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, tables).collect() == []


@pytest.mark.parametrize("limit,full", [(500_000, False), (3, False), (100, True), (3, True)])
def test_listed_rows_go_by_every_way(spark, monkeypatch, limit, full):
    """Broadcast; a bitmap; one so full that all pass, those by chance picked by broadcast or joined:
    the same rows."""
    monkeypatch.setattr(rowlists, "LISTED", limit)
    if full:
        monkeypatch.setattr(bitmaps, "build", lambda *_: np.full(1 << (bitmaps.BITS - 6), ~np.uint64(0)))
    rows = [(i if i % 9 else None, f"text {i % 40}", i % 3 == 0) for i in range(200)] + [(500, None, True), (501, None, False)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, passes boolean")
    gone = docs.filter("doc_id % 4 <> 0 OR (doc_id IS NULL AND text LIKE '%8')")
    listed = cut(gone.select(F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_hash")).distinct())
    got = rowlists.without(docs, listed, "doc_id", "text")
    assert got.columns == docs.columns
    want = [r for r in rows if not (r[0] % 4 if r[0] is not None else r[1].endswith("8"))]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    left = len({(r[0], r[1]) for r in want})
    assert listed.count() > 100 > left > 3


def test_no_text_in_an_exchange(spark):
    """Neither stage that drops rows shuffles whole rows to do so."""
    docs = spark.createDataFrame([(i, f"word{i} b c d e f g {'x y z' if i % 2 else ''}") for i in range(50)], "doc_id long, text string")
    items = spark.createDataFrame([("i", "word3 b c d e f g x y z")], "item_id string, text string")
    for kept in (contamination.drop_contaminated(docs, items), jaccard.keep_one(docs)):
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan
