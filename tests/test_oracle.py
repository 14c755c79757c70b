"""Every registered query against its SQL in DuckDB, over whole tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from helpers import UNWANTED, planned
from martloom.catalog import oracle, queries
from martloom.catalog.inputs import GIVEN

FOLDER = "/root/testdata/sf0.001"
QUERIES = {name: queries.callable_for(function) for name, function in queries.QUERIES.items()}
ORACLE = oracle.ORACLE


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in GIVEN:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def ordered(rows):
    return sorted(rows, key=lambda r: [(v is None, str(v)) for v in r])


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries())
    assert ORACLE.items() <= contract.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    cursor = duck.execute(ORACLE[name])
    names = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(names)
    expected = ordered(cursor.fetchall())
    actual = ordered(tuple(r) for r in df.select([f"`{n}`" for n in names]).collect())
    assert expected, "the query should have rows to compare"
    assert actual == expected


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_cross_join_and_no_python(spark, name):
    plan = planned(QUERIES[name](spark, FOLDER))
    assert [node for node in UNWANTED if node in plan] == []


def test_flagship_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0
    assert df.columns[-5:] == ["is_active", "created_ts", "updated_ts", "created_by_job_exec_id", "updated_by_job_exec_id"]
