"""Every query against its DuckDB SQL, and the shape of the plans."""

import os
import re

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_DIR

from treeloom.plans.oracles import ORACLES
from treeloom.plans.queries import QUERIES


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SF_DIR):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF_DIR}/{name}'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).columns == ["scope", "key", "files", "loc", "size"]


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_as_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    result = duck.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    order = [columns.index(c) for c in df.columns]
    expected = sorted((tuple(row[i] for i in order) for row in result.fetchall()), key=repr)
    assert sorted((tuple(r) for r in df.collect()), key=repr) == expected


@pytest.mark.parametrize("name", list(QUERIES))
def test_plan(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "Scan ExistingRDD"):
        assert node not in plan


def test_scans_read_only_what_is_used(spark):
    plan = QUERIES["module_path"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert all("l_extendedprice" not in s for s in re.findall(r"ReadSchema: [^\n]*", plan))
    plan = QUERIES["nul_filter"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


@pytest.mark.parametrize("name,exchanges", [
    # Extraction from a file needs no exchange; definitions need one (six build the code base).
    ("html_attributes", 0), ("css_properties", 0), ("entity_rows", 0), ("json_data", 0), ("content_hash", 1),
    ("lint_stats", 1),
])
def test_number_of_exchanges(spark, name, exchanges):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"(?<!Broadcast)Exchange ", plan)) == exchanges


def test_definitions_exchange_once(spark):
    from treeloom.operators import definitions
    files = spark.read.schema("file_path string, content string").parquet(f"{SF_DIR}/documents.parquet")
    plan = definitions.call_edges(definitions.definitions(files))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(file_path") == 1 and plan.count("Exchange ") == 1
