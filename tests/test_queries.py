"""Every registered query against its SQL on DuckDB, on the smallest tables."""

import os
import subprocess
import sys
from collections import Counter
from pathlib import Path

import duckdb
import pytest
from conftest import plan_text

import __spark_entry__ as contract
from landfall.bindings import ORACLES as LIBRARY_SQL
from landfall.bindings import QUERIES as LIBRARY
from landfall.bindings.registry import SCHEMAS, table

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = LIBRARY, LIBRARY_SQL

pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in SCHEMAS:
        connection.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert set(LIBRARY) == set(LIBRARY_SQL)


def test_stated_schemas_are_those_of_the_files(spark):
    for name in SCHEMAS:
        found = spark.read.parquet(f"{SF_DIR}/{name}.parquet")
        assert table(spark, SF_DIR, name).schema.simpleString() == found.schema.simpleString()


def test_entry_points_without_the_optional_parts():
    """The optional subpackage and its pipeline may be left out of an installation."""
    code = """
import sys
sys.modules["landfall.llm"] = sys.modules["corpus_pipeline"] = None
import __spark_entry__ as entry
from landfall.bindings import ORACLES, QUERIES
assert entry.queries().keys() == QUERIES.keys() and entry.oracle_sql() == ORACLES
"""
    root = Path(__file__).resolve().parent.parent
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr[-2000:]


def test_entry(spark):
    assert contract.entry(spark).columns[0] == "i94port"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = plan_text(df)
    assert not [word for word in ("Cartesian", "NestedLoop", "EvalPython", "MapInPandas") if word in plan]
    columns = sorted(df.columns)
    result = duck.execute(SQL[name])
    found = [d[0] for d in result.description]
    assert sorted(found) == columns
    order = [found.index(c) for c in columns]
    expected = Counter(tuple(row[i] for i in order) for row in result.fetchall())
    assert Counter(tuple(row[c] for c in columns) for row in df.collect()) == expected
