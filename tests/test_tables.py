"""Publishing without a gap, stored tables that evolve, checks counted during a write."""

import uuid

import pytest
from pyspark.sql import types as T

from assaykit.operators import integrity
from assaykit.sources import tables

SHAPE = T.StructType([T.StructField("id", T.LongType()), T.StructField("note", T.StringType()), T.StructField("x", T.DoubleType())])


def test_publish_swaps_whole_states(spark):
    view = f"pub_{uuid.uuid4().hex[:8]}"
    frame = lambda n: spark.range(n).selectExpr("id", "'a' AS note")
    tables.publish(frame(3), view, SHAPE)
    reader = spark.table(view)
    tables.publish(frame(5), view, SHAPE)
    assert reader.count() == 3 and spark.table(view).count() == 5
    assert spark.table(view).columns == ["id", "note", "x"]
    broken = frame(4).selectExpr("id", "raise_error('no') AS note")
    with pytest.raises(Exception, match="no"):
        tables.publish(broken, view, SHAPE)
    assert spark.table(view).count() == 5
    tables.publish(frame(0), view, SHAPE)
    tables.publish(frame(7), view, SHAPE)
    assert spark.table(view).count() == 7 and len(tables.versions_of(spark, view)) == 2
    other = f"{view}__v9x"
    tables.publish(frame(1), other, SHAPE)
    assert spark.table(view).count() == 7


def test_stored_table_gets_columns(spark):
    name = f"old_{uuid.uuid4().hex[:8]}"
    spark.range(4).write.saveAsTable(name)
    assert tables.evolve_table(spark, name, SHAPE) == ["note", "x"]
    assert tables.evolve_table(spark, name, SHAPE) == []
    spark.createDataFrame([(9, "n", 0.5)], SHAPE).write.insertInto(name)
    rows = {r["id"]: (r["note"], r["x"]) for r in spark.table(name).collect()}
    assert rows == {0: (None, None), 1: (None, None), 2: (None, None), 3: (None, None), 9: ("n", 0.5)}


def test_checks_cost_no_scan(spark, tmp_path):
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    rows = spark.range(1000).selectExpr("id", "CASE WHEN id % 10 = 0 THEN NULL ELSE id * 1.0D END AS x")
    seen = rows.mapInArrow(count, "id long, x double")
    found = integrity.write_checked(seen, f"{tmp_path}/t", ["x"], {"x": (0, 499), "id": (0, 2000)})
    assert found == {"n_rows": 1000, "n_nulls": 100, "out_of_bounds_x": 100 + 450, "out_of_bounds_id": 0}
    assert read.value == 1000
    assert spark.read.parquet(f"{tmp_path}/t").count() == 1000
    empty = integrity.write_checked(rows.limit(0), f"{tmp_path}/e", ["x"], {"x": (0, 1)})
    assert empty == {"n_rows": 0, "n_nulls": 0, "out_of_bounds_x": 0}
