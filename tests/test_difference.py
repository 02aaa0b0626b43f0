"""Snapshot differences against dictionaries."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sedimenta.operators.difference import row_difference, snapshot_difference, with_deletions

DDL = "k string, n long, v string, x double"


def snapshot(rng):
    return {(rng.choice([None, "a", "b", "hot"]), rng.choice([None, *range(8)])): (rng.choice([None, "", "v", "w"]), rng.choice([None, 0.0, -0.0, 1.5])) for _ in range(rng.randrange(40))}


def frame(spark, data):
    return spark.createDataFrame([(*k, *v) for k, v in data.items()], DDL)


def norm(x):
    return tuple(0.0 if v == 0 and isinstance(v, float) else v for v in x)


@pytest.mark.parametrize("seed", range(4))
def test_random_snapshots(spark, seed):
    rng = random.Random(seed)
    old, new = snapshot(rng), snapshot(rng)
    out = snapshot_difference(frame(spark, old), frame(spark, new).select("x", "v", "n", "k"), ["k", "n"], with_same=True)
    assert out.columns == ["x", "v", "n", "k", "change"]
    got = sorted(((r["change"], r["k"], r["n"], *norm((r["v"], r["x"]))) for r in out.collect()), key=repr)
    want = []
    for key in {*old, *new}:
        a, b = old.get(key), new.get(key)
        if a is None or b is None:
            want.append(("added" if a is None else "removed", *key, *norm(b or a)))
        else:
            want.append(("same" if norm(a) == norm(b) else "changed", *key, *norm(b)))
    assert got == sorted(want, key=repr)
    fewer = snapshot_difference(frame(spark, old), frame(spark, new), ["k", "n"])
    assert fewer.count() == sum(w[0] != "same" for w in want)


def test_nested_values(spark):
    ddl = "k int, s struct<a:int,b:string>, l array<string>, m map<string,int>, b binary"
    old = spark.createDataFrame([(1, (1, None), ["a", None], {"x": 1, "y": 2}, b"1"), (2, (1, None), [], {}, None), (3, None, None, None, b""), (4, (None, None), ["a,b"], None, None)], ddl)
    new = spark.createDataFrame([(1, (1, None), ["a", None], {"y": 2, "x": 1}, b"1"), (2, (1, ""), [], {}, None), (3, (None, None), None, None, b""), (4, (None, None), ["a", "b"], None, None)], ddl)
    out = snapshot_difference(old, new, ["k"], with_same=True)
    assert {r["k"]: r["change"] for r in out.collect()} == {1: "same", 2: "changed", 3: "changed", 4: "changed"}


def test_microseconds_and_nested_doubles(spark):
    ddl = "k int, t timestamp, u timestamp_ntz, l array<double>"
    at = datetime(2024, 1, 1, 1, 2, 3, 400000)
    old = [(1, at, at, [0.0]), (2, at, at, [0.0]), (3, at, at, [1.0]), (4, at, at, [float("nan")])]
    new = [(1, at, at, [-0.0]), (2, at.replace(microsecond=400001), at, [0.0]), (3, at, at.replace(microsecond=400001), [1.0]), (4, at, at, [float("nan")])]
    out = snapshot_difference(spark.createDataFrame(old, ddl), spark.createDataFrame(new, ddl), ["k"], with_same=True)
    assert {r["k"]: r["change"] for r in out.collect()} == {1: "same", 2: "changed", 3: "changed", 4: "same"}


def test_only_keys(spark):
    a = spark.createDataFrame([(1,), (2,)], "k int")
    b = spark.createDataFrame([(2,), (3,)], "k int")
    assert sorted(tuple(r) for r in snapshot_difference(a, b, ["k"]).collect()) == [(1, "removed"), (3, "added")]


def test_refusals(spark):
    a = spark.createDataFrame([(None, 1), (None, 1)], "k int, v int")
    with pytest.raises(ValueError, match="duplicate key in the old snapshot: k=None"):
        snapshot_difference(a, a.limit(1), ["k"])
    with pytest.raises(ValueError, match="new snapshot"):
        snapshot_difference(a.limit(1), a, ["k"])
    with pytest.raises(ValueError, match="same columns"):
        snapshot_difference(a, a.drop("v"), ["k"])
    with pytest.raises(ValueError, match="taken"):
        snapshot_difference(a.withColumn("change", F.lit(1)), a.withColumn("change", F.lit(1)), ["k"])


def test_rows_without_keys(spark):
    a = spark.createDataFrame([(1, "x")] * 300 + [(2, None)] * 2 + [(3, "z")], "k int, v string")
    b = spark.createDataFrame([(1, "x")] * 299 + [(2, None)] * 2 + [(4, "z")], "k int, v string")
    assert sorted(tuple(r) for r in row_difference(a, b.select("v", "k")).select("k", "v", "n_old", "n_new").collect()) == [(1, "x", 300, 299), (3, "z", 1, 0), (4, "z", 0, 1)]


def test_rows_that_go_and_come_back(spark):
    days = [datetime(2024, 1, d) for d in (1, 2, 3, 4)]
    snapshots = [{1: "a", 2: "b", None: "n"}, {1: "A"}, {2: "back", 3: "c"}, {3: "c", None: "N"}]
    held, want = None, {}
    for day, now in zip(days, snapshots, strict=True):
        df = spark.createDataFrame(list(now.items()), "k int, v string")
        held = with_deletions(held, df, ["k"], F.lit(day))
        for k in {*want, *now}:
            if k in now:
                want[k] = (now[k], None)
            elif want[k][1] is None:
                want[k] = (want[k][0], day)
        rows = held.collect()
        assert {r["k"]: (r["v"], r["deleted_at"]) for r in rows} == want and len(rows) == len(want)
        held = spark.createDataFrame([tuple(r) for r in rows], held.schema)
