from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import count_nodes, executed_plan, planned
from martloom.operators import pick
from martloom.operators.incremental import changed_since, in_window
from martloom.operators.lookup import expand_with_parameters, group_parents, lookup, lookup_with_fallback
from martloom.operators.schema import enforce_schema, lower_names, project, renamed, schema_of_codes
from martloom.operators.unpivot import unpivot_lines


@pytest.fixture
def facts(spark):
    return spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, k string")


@pytest.fixture
def names(spark):
    return spark.createDataFrame([("a", "one"), ("a", "two"), ("c", "three"), (None, "none")], "k string, name string")


def test_lookup_keeps_unmatched_rows_and_multiplies_matches(facts, names, rows):
    found = lookup(facts, names, {"k": "k"}, {"name": "found"})
    assert found.columns == ["id", "k", "found"]
    assert rows(found) == [(1, "a", "one"), (1, "a", "two"), (2, "b", None), (3, None, None)]


def test_lookup_inner_and_self(facts, names, rows):
    assert rows(expand_with_parameters(facts, names, {"k": "k"}, {"name": "n"})) == [(1, "a", "one"), (1, "a", "two")]
    assert rows(lookup(facts, facts, {"id": "id"}, {"k": "again"})) == [(1, "a", "a"), (2, "b", "b"), (3, None, None)]


def test_fallback(spark, rows):
    df = spark.createDataFrame([("g1", "C1"), ("g2", "C1"), ("g3", "C1")], "g string, c string")
    ids = spark.createDataFrame([("g1C1", "own"), ("g1ZZ", "global1"), ("g2ZZ", "global2")], "key string, id string")
    found = lookup_with_fallback(
        df, ids, "key", "id", F.concat("g", "c"), F.concat("g", F.lit("ZZ")), "found"
    )
    assert rows(found) == [("g1", "C1", "own"), ("g2", "C1", "global2"), ("g3", "C1", None)]


def test_group_parents_by_role(spark, rows):
    groups = spark.createDataFrame([(1, "STGH"), (2, "BRND"), (3, "MKTP")], "prod_grp_id int, grp_prps_cd string")
    links = spark.createDataFrame(
        [(1, 2, "C1"), (1, 2, "C2"), (1, 3, "C1"), (2, 3, "C1")],
        "prod_grp_id_child int, prod_grp_id_prnt int, cntry_cd string",
    )
    assert rows(group_parents(links, groups, "STGH", ["BRND"], False)) == [(1, 2, "BRND")]
    assert rows(group_parents(links, groups, "STGH", ["BRND"], True)) == [(1, 2, "BRND", "C1"), (1, 2, "BRND", "C2")]


def test_hot_lookup_key_is_split(spark, settings, rows):
    """A key with a third of all rows, a side too large to broadcast: the hot partition is split."""
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    )
    n = 60_000
    facts = spark.range(n, numPartitions=16).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), F.sha1(F.col("id").cast("string")).alias("pad")
    )
    right = spark.range(n).select(F.col("id").alias("k"), (F.col("id") * 2).alias("twice"))
    found = lookup(facts, right, {"k": "k"}, {"twice": "twice"})
    plan = executed_plan(found)
    assert "skew=true" in plan
    assert found.count() == n
    assert found.filter("twice <> k * 2 or twice is null").count() == 0


PICK_SCHEMA = "k string, a int, d date, v string"
PICK_ROWS = [
    ("x", 2, date(2020, 1, 1), "p"),
    ("x", 1, date(2021, 1, 1), "q"),
    ("x", 1, None, "r"),
    ("y", None, date(2019, 1, 1), None),
    ("y", 5, None, "s"),
    (None, 1, None, "t"),
    (None, 1, None, "t"),
]


def test_first_per_key_is_one_coherent_row(spark, rows):
    df = spark.createDataFrame(PICK_ROWS, PICK_SCHEMA)
    expected = [(None, 1, None, "t"), ("x", 1, None, "r"), ("y", None, date(2019, 1, 1), None)]
    assert rows(pick.first_per_key(df, ["k"], ["a"])) == expected
    assert rows(pick.first_per_key(df.repartition(5), ["k"], ["a"])) == expected


def test_max_with_first(spark, rows):
    df = spark.createDataFrame(PICK_ROWS, PICK_SCHEMA)
    expected = [(None, 1, None, "t"), ("x", 1, date(2021, 1, 1), "q"), ("y", None, date(2019, 1, 1), None)]
    assert rows(pick.max_with_first(df, ["k"], "d", ["a"])) == expected


def test_latest_keeps_ties_and_drops_all_null_keys(spark, rows):
    df = spark.createDataFrame(
        [("x", 1, "a"), ("x", 2, "b"), ("x", 2, "c"), ("y", None, "d"), (None, 3, "e"), (None, 1, "f")],
        "k string, d int, v string",
    )
    assert rows(pick.latest_by(df, ["k"], "d")) == [(None, 3, "e"), ("x", 2, "b"), ("x", 2, "c")]


def test_picks_match_brute_force(spark):
    data = [(i % 7 if i % 3 else 0, (i * 37) % 11, None if i % 5 == 0 else (i * 13) % 17, i) for i in range(600)]
    df = spark.createDataFrame(data, "k int, a int, d int, i int").repartition(9)
    first, latest = {}, {}
    for k, a, dd, i in data:
        # nulls come first, so the smallest tuple per key is the pick
        candidate = (a, (dd is not None, dd or 0), i)
        first[k] = min(first.get(k, candidate), candidate)
        if dd is not None:
            latest[k] = max(latest.get(k, dd), dd)
    picked = {r["k"]: r["i"] for r in pick.first_per_key(df, ["k"], ["a", "d"]).collect()}
    assert picked == {k: v[2] for k, v in first.items()}
    kept = {r["i"] for r in pick.latest_by(df, ["k"], "d").collect()}
    assert kept == {i for k, _, dd, i in data if dd is not None and dd == latest[k]}


def test_picks_reduce_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = planned(pick.first_per_key(df, ["k"], ["id"]))
    assert "partial_min" in plan and count_nodes(plan, "Window") == 0
    plan = planned(pick.latest_by(df, ["k"], "id"))
    assert "partial_max" in plan and count_nodes(plan, "Window") == 0


def test_latest_of_a_hot_key_with_all_rows_tied(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    df = spark.range(90_000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), F.lit(1).alias("d"))
    assert pick.latest_by(df, ["k"], "d").count() == 90_000


def test_bridge_open_end_wins(spark, rows):
    links = spark.createDataFrame(
        [
            (1, 10, date(2023, 1, 1), date(2022, 1, 1), date(2020, 1, 1)),
            (1, 10, date(2023, 1, 1), None, date(2019, 1, 1)),
            (1, 10, date(2024, 1, 1), date(2022, 5, 1), None),
            (1, 99, None, None, None),
        ],
        "prod_child_id int, prod_grp_prnt_id int, end_dt date, cease_pblsh_dt date, lst_pblsh_dt date",
    )
    groups = spark.createDataFrame([(10, "BRND"), (10, "BRND")], "prod_grp_id int, grp_prps_cd string")
    assert rows(pick.bridge_maxima(links, groups)) == [
        (1, 10, "BRND", date(2023, 1, 1), date(9999, 12, 31), date(2020, 1, 1)),
        (1, 10, "BRND", date(2024, 1, 1), date(2022, 5, 1), None),
    ]


def test_changed_since_any_date(spark):
    df = spark.createDataFrame([(date(2020, 1, 2), None), (None, date(2020, 1, 1)), (None, None)], "a date, b date")
    kept = df.filter(changed_since([F.col("a"), F.col("b")], "2020-01-01"))
    assert [r["a"] for r in kept.collect()] == [date(2020, 1, 2)]


def test_window_is_half_open_and_windows_tile(spark):
    stamps = [f"2020-01-0{i}T00:00:00.000Z" for i in range(1, 8)]
    df = spark.createDataFrame([(s,) for s in stamps], "t string")

    def inside(after, until, mode):
        return {r["t"] for r in df.filter(in_window(F.col("t"), after, until, mode)).collect()}

    for mode in ("instant", "text"):
        a, b, c = stamps[0], stamps[3], stamps[6]
        assert inside(a, b, mode) == set(stamps[1:4])
        assert inside(a, b, mode) | inside(b, c, mode) == inside(a, c, mode)
        assert not inside(a, b, mode) & inside(b, c, mode)


def test_window_modes_differ_on_offsets(spark):
    df = spark.createDataFrame([("2020-01-01T01:30:00.000+02:00",)], "t string")
    bounds = ("2020-01-01T00:00:00.000Z", "2020-01-02T00:00:00.000Z")
    assert df.filter(in_window(F.col("t"), *bounds)).count() == 0
    assert df.filter(in_window(F.col("t"), *bounds, mode="text")).count() == 1
    with pytest.raises(ValueError):
        in_window(F.col("t"), *bounds, mode="other")


def test_unpivot_is_one_pass(spark, rows):
    df = spark.createDataFrame([(1, 2, 3), (4, None, 6)], "id int, a int, b int")
    lines = unpivot_lines(
        df, [F.col("id")], [{"name": F.lit("a"), "v": F.col("a")}, {"name": F.lit("b"), "v": F.col("b")}]
    )
    assert rows(lines) == [(1, "a", 2), (1, "b", 3), (4, "a", None), (4, "b", 6)]
    plan = planned(lines)
    assert count_nodes(plan, "Generate") == 1 and count_nodes(plan, "Union") == 0


def test_enforce_schema(spark):
    df = spark.createDataFrame([("7", "2020-01-01", "x", "1.5")], "N string, day string, bad string, amount string")
    schema = T.StructType(
        [
            T.StructField("day", T.DateType()),
            T.StructField("n", T.ShortType()),
            T.StructField("bad", T.IntegerType()),
            T.StructField("amount", T.DecimalType(16, 2)),
            T.StructField("absent", T.TimestampType()),
        ]
    )
    typed = enforce_schema(df, schema)
    assert typed.schema.simpleString() == schema.simpleString()
    first = typed.head()
    assert (first["day"], first["n"], first["bad"], str(first["amount"]), first["absent"]) == (date(2020, 1, 1), 7, None, "1.50", None)
    assert enforce_schema(df.limit(0), schema).schema.simpleString() == schema.simpleString()


def test_schema_of_codes():
    schema = schema_of_codes({"a": 1700, "b": 20, "c": 1184, "d": 424242})
    assert schema.simpleString() == "struct<a:decimal(14,6),b:bigint,c:timestamp,d:string>"


def test_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "A int, b int, C int")
    assert lower_names(df).columns == ["a", "b", "c"]
    assert renamed(df, {"a": "x", "missing": "y"}).columns == ["x", "b", "C"]
    assert project(df, {"C": "z", "A": "x"}).columns == ["z", "x"]


def test_run_timestamp_is_exact(spark):
    from martloom.context import RunContext

    run = RunContext(datetime(2024, 1, 2, 3, 4, 5, 678), 9)
    row = spark.range(1).select(run.timestamp.alias("t"), run.as_of_date.alias("d"), run.executor.alias("e")).head()
    assert (row["d"], row["e"]) == (date(2024, 1, 2), 9)
    assert spark.range(1).select(run.timestamp.cast("string").alias("t")).head()["t"] == "2024-01-02 03:04:05.000678"
