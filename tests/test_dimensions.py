import pytest

import sedimenta as sd
from sedimenta.operators.dimensions import left_lookup


@pytest.fixture
def tables(spark):
    dimension = spark.createDataFrame(
        [
            ("T", "d1", "Donor", "g1"), ("T", "d1", "Donor", "g2"), ("T", "d1", "Donor", "gone"),
            ("U", "d2", "Donor", "g3"), ("T", "d3", "Empty", None), ("T", "d4", "Other", "g1"),
        ],
        "dimensionType STRING, id STRING, name STRING, items_id STRING",
    )
    groups = spark.createDataFrame(
        [
            ("g1", "G one", "o1"), ("g1", "G one", "o2"), ("g2", "G two", "o2"),
            ("g3", "G three", "nowhere"), ("g9", "unused", "o1"),
        ],
        "id STRING, name STRING, categoryOptions_id STRING",
    )
    options = spark.createDataFrame(
        [("o1", "opt", "c1"), ("o2", "opt", "c2"), ("o2", "opt", "c3")],
        "id STRING, name STRING, categoryOptionCombos_id STRING",
    )
    return dimension, groups, options


STRATEGIES = ("auto", "join", "split")


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_one_hop(tables, rows, strategy):
    dimension, groups, _ = tables
    got = sd.dimension_members(
        dimension, groups, "Donor", "categoryOptions_id", strategy=strategy
    )
    assert got.columns == ["name", "categoryOptions_id"]
    assert rows(got) == sorted(
        [
            ("G one", "o1"), ("G one", "o2"), ("G two", "o2"), ("G three", "nowhere"),
            (None, None),
        ],
        key=repr,
    )


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_two_hops_keep_repeated_rows(tables, rows, strategy):
    got = sd.dimension_members_2hop(
        *tables, "Donor", "categoryOptionCombos_id", strategy=strategy
    )
    assert rows(got) == sorted(
        [
            ("G one", "c1"), ("G one", "c2"), ("G one", "c3"), ("G two", "c2"), ("G two", "c3"),
            ("G three", None), (None, None),
        ],
        key=repr,
    )


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_list_without_items_and_unknown_list(tables, rows, strategy):
    dimension, groups, _ = tables
    args = ("categoryOptions_id", False)
    empty = sd.dimension_members(dimension, groups, "Empty", *args, strategy=strategy)
    assert rows(empty) == [(None, None)]
    none = sd.dimension_members(dimension, groups, "No such", *args, strategy=strategy)
    assert rows(none) == []


def test_distinct_alias_and_type(tables, rows):
    dimension, groups, _ = tables
    got = sd.dimension_members(
        dimension.union(dimension), groups, "Donor", "categoryOptions_id",
        distinct=True, member_alias="m", dimension_type="T",
    )
    assert got.columns == ["name", "m"]
    assert len(rows(got)) == 4


@pytest.mark.parametrize("limit", ["-1", "10485760"])
def test_split_lookup_equals_left_join_on_a_hot_key(spark, rows, limit):
    """A third of all rows on one key, NULL keys and keys without partner on the left."""
    left = spark.createDataFrame(
        [(i % 7 if i % 3 else 0, f"l{i}") for i in range(60)] + [(None, "n"), (99, "m")],
        "k INT, a STRING",
    )
    right = spark.createDataFrame(
        [(0 if i % 3 == 0 else i % 5, f"r{i}") for i in range(60)] + [(None, "x")],
        "id INT, b STRING",
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        split = rows(left_lookup(left, right, "k", "id", "split"))
        plain = rows(left_lookup(left, right, "k", "id", "join"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert split == plain


def test_auto_takes_the_split_join_beyond_the_broadcast_limit(spark, tables, rows):
    dimension, groups, _ = tables
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        df = sd.dimension_members(dimension, groups, "Donor", "categoryOptions_id")
        assert "LeftAnti" in df._jdf.queryExecution().optimizedPlan().toString()
        assert len(rows(df)) == 5
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_filter_and_columns_reach_the_scan(spark, tables, tmp_path):
    for name, df in zip(("d", "g"), tables, strict=False):
        df.write.parquet(str(tmp_path / name))
    dimension, groups = (spark.read.parquet(str(tmp_path / n)) for n in ("d", "g"))
    df = sd.dimension_members(dimension, groups, "Donor", "categoryOptions_id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(name,Donor)" in plan
    assert "ReadSchema: struct<name:string,items_id:string>" in plan
    assert "BroadcastHashJoin" in plan


def test_unknown_strategy(tables):
    with pytest.raises(ValueError, match="strategy"):
        sd.dimension_members(tables[0], tables[1], "Donor", "categoryOptions_id", strategy="x")
