"""The operators' queries against their SQL on DuckDB, on the smallest tables."""

import os
from collections import Counter
from pathlib import Path

import duckdb
import pytest

from landfall.bindings.registry import SCHEMAS
from landfall.llm.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="no test tables")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    with duckdb.connect() as connection:
        for table in SCHEMAS:
            connection.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
        result = connection.execute(ORACLES[name])
        found = [d[0] for d in result.description]
        df = QUERIES[name](spark, SF_DIR)
        assert sorted(found) == sorted(df.columns)
        assert Counter(map(tuple, df.select(*found).collect())) == Counter(result.fetchall())
