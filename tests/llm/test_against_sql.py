"""Every query with check SQL against DuckDB on the small tables."""

import glob
import os

import duckdb
import pandas as pd
import pytest

from landfall.llm import queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(queries.CHECKS))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    want = con.sql(queries.CHECKS[name]).df()
    got = queries.QUERIES[name](spark, SF).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    order = sorted(want.columns)
    frames = [f.sort_values(order).reset_index(drop=True)[order] for f in (got, want)]
    pd.testing.assert_frame_equal(*frames, check_dtype=False)
