"""Catalog queries against their SQL. All keys with ASSAYKIT_ALL=1, a cross-section otherwise."""

import os
from pathlib import Path

import duckdb
import pytest
from compare import table

import __spark_entry__ as entry

SF = os.environ.get("ASSAYKIT_SF", "/root/testdata/sf0.001")
SOME = [
    "class_summary", "null_summary", "split_class_pivot", "integrity_flags", "parse_artifact_name",
    "per_class_counter", "odd_size_odd_aspect", "manifest_hash", "upsert_version",
    "join_version_default", "exact_duplicate_groups", "validation_by_split_class", "duplicate_report",
    "last_writer_wins", "load_manifest", "per_class_report", "latency_profile", "model_comparison",
    "runs_wide", "dashboard_summary", "models_compare", "recommendation", "scan_run_store",
    "perceptual_hash", "pixel_stats",
]

pytestmark = pytest.mark.skipif(not Path(SF).is_dir(), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


KEYS = sorted(entry.oracle_sql()) if os.environ.get("ASSAYKIT_ALL") else SOME


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_sql(spark, db, key):
    frame = entry.queries()[key](spark, SF)
    result = db.execute(entry.oracle_sql()[key])
    want = table([d[0] for d in result.description], result.fetchall())
    assert table(frame.columns, [tuple(r) for r in frame.collect()]) == want
