"""Joins with heavy keys: the same rows as a plain join, and no task with most of them."""

import statistics

import pytest
from pyspark.sql import functions as F

from sedimenta.operators.heavy import heavy_join, heavy_keys


@pytest.fixture(scope="module")
def sides(spark):
    left = spark.range(20_000).select(
        F.when(F.col("id") % 10 < 8, F.lit("hot")).when(F.col("id") % 10 == 8, F.lit(None)).otherwise(F.concat(F.lit("k"), F.col("id") % 701)).alias("k"),
        F.col("id").alias("n"),
        (F.col("id") % 3).alias("copies"),
    )
    right = spark.createDataFrame([("hot", i) for i in range(3)] + [(f"k{i}", i) for i in range(500)] + [("lone", 1), (None, 9)], "key string, v long")
    return left, right


def test_heavy_keys(sides):
    left, right = sides
    assert heavy_keys(left, "k") == ["hot"]
    assert heavy_keys(right, "key", share=0.05) == []
    assert heavy_keys(left.limit(0), "k") == []
    with pytest.raises(ValueError, match="share"):
        heavy_keys(left, "k", share=0.0001)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_same_rows_as_a_plain_join(sides, how):
    left, right = sides
    plain = left.join(right, left["k"] == right["key"], how)
    salted = heavy_join(left, right, "k", "key", how, copies=8)
    assert salted.columns == plain.columns

    def counted(df):
        return {tuple(r) for r in df.groupBy(*df.columns).count().collect()}

    assert counted(salted) == counted(plain)


def test_a_key_that_is_heavy_on_both_sides(spark):
    left = spark.range(3000).select(F.when(F.col("id") < 1500, "x").otherwise(F.col("id").cast("string")).alias("k"), "id")
    right = spark.range(200).select(F.when(F.col("id") < 150, "x").otherwise("y").alias("k2"), F.col("id").alias("r"))
    out = heavy_join(left, right, "k", "k2", copies=5)
    assert out.count() == out.distinct().count() == 1500 * 150
    other = heavy_join(right, left, "k2", "k", copies=5)
    assert other.count() == 1500 * 150


def test_no_task_gets_most_of_the_rows(spark, sides):
    """80 % of the rows have one key; by parts no task has twice what the median one has."""
    left, right = sides
    held = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for k, v in zip(held, ("false", "-1"), strict=True):
            spark.conf.set(k, v)

        def sizes(df):
            got = df.groupBy(F.spark_partition_id().alias("p")).count().collect()
            return sorted(r["count"] for r in got)

        plain = sizes(left.join(right, left["k"] == right["key"]))
        salted = sizes(heavy_join(left, right, "k", "key", copies=640))
        assert plain[-1] >= 0.8 * sum(plain)
        assert len(salted) == 8 and salted[-1] <= 2 * statistics.median(salted)
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)


def test_wrong_use(sides):
    with pytest.raises(ValueError, match="how"):
        heavy_join(*sides, "k", "key", "full")
