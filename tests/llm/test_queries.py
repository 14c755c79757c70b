"""Every corpus query over its whole table, against SQL in DuckDB where there is some."""

import duckdb
import pytest
from edge_cases import FOLDER

import __spark_entry__ as contract
import corpus_pipeline
from martloom.llm.queries import ORACLE, QUERIES

NATIVE = ("op1_", "op3_", "op10_", "op11_")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in ("documents", "benchmark", "labels", "embeddings"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def test_all_are_registered():
    registered = contract.queries()
    assert set(QUERIES) | {"pipeline"} <= set(registered)
    assert [sum(name.startswith(f"op{n}_") for name in registered) for n in range(1, 14)] == [1] * 13
    assert set(ORACLE) <= set(contract.oracle_sql())
    assert len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows_as_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    cursor = duck.execute(ORACLE[name])
    names = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(names)
    expected = sorted(map(str, cursor.fetchall()))
    assert expected
    assert sorted(str(tuple(r)) for r in df.select(names).collect()) == expected


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n.startswith(NATIVE)))
def test_native_plans_have_no_python(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert [node for node in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin") if node in plan] == []
