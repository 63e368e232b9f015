"""Every registered query against its SQL, and what its plan must not contain."""

import duckdb
import pytest

import __spark_entry__ as entry_point
import check

SF = "/root/testdata/sf0.001"
ADDED = entry_point.extra()[0]
QUERIES = {name: run for name, run in entry_point.queries().items() if name not in ADDED}
ORACLES = {name: sql for name, sql in entry_point.oracle_sql().items() if name not in ADDED}
# these run jobs of their own while the query is built
WRITES = {"table_create", "landing_write", "registry_save"}


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in check.TABLES.split():
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, db, name):
    got = QUERIES[name](spark, SF)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert check.compare(got.toPandas(), db.execute(ORACLES[name]).df()) is None


def test_scans_read_only_what_is_used(spark):
    plan = QUERIES["text_chunks"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan
    assert "Exchange" not in plan


@pytest.mark.parametrize("name", ["chunk_counts", "record_json", "json_chunks"])
def test_python_runs_once_per_row(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    # constant formats let Spark leave a splitter out altogether
    assert plan.count("split_each_long") <= 1 and plan.count("split_nested") <= 1


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns[:2] == ["namespace", "_id"] and df.count() > 0
