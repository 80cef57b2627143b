"""The queries against their SQL."""

from pathlib import Path

import duckdb
import pytest
from compare import table

from assaykit.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not Path(SF).is_dir(), reason="no test tables")
@pytest.mark.parametrize("key", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, key):
    con = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    frame = queries.QUERIES[key](spark, SF)
    result = con.execute(queries.ORACLE_SQL[key])
    assert table(frame.columns, [tuple(r) for r in frame.collect()]) == table([d[0] for d in result.description], result.fetchall())
