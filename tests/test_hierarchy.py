"""Closures against walking up node by node."""

import random

import pytest

from sedimenta.operators.hierarchy import below, hierarchy, roll_up

DDL = "id string, parent_id string"


def walked(parents):
    """id to its ancestors, nearest first, itself included; None for an endless way."""
    out = {}
    for i in parents:
        way, at = [i], parents[i]
        while at is not None and at != way[-1] and at in parents and len(way) <= len(parents):
            way.append(at)
            at = parents[at]
        out[i] = None if len(way) > len(parents) else way
    return out


def check(spark, parents):
    df = spark.createDataFrame(list(parents.items()), DDL)
    found = hierarchy(df)
    want = walked(parents)
    pairs = {(r["id"], r["ancestor"], r["distance"]) for r in found.closure.collect()}
    assert found.closure.count() == len(pairs)
    assert pairs == {(i, a, d) for i, way in want.items() for d, a in enumerate(way or [i])}
    faults = {(r["id"], r["fault"]) for r in found.faults.collect()}
    orphans = {(i, "orphan") for i, p in parents.items() if p is not None and p not in parents}
    assert faults == orphans | {(i, "cycle") for i, way in want.items() if way is None}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_forests(spark, seed):
    rng = random.Random(seed)
    n = 60
    order = [str(i) for i in range(n)]
    rng.shuffle(order)
    parents = {i: (rng.choice([None, "lost", *order[:k]]) if k else None) for k, i in enumerate(order)}
    if seed == 3:  # two cycles, one of a single step beyond itself, and what hangs on them
        parents[order[0]], parents[order[5]] = order[5], order[0]
    check(spark, parents)


def test_a_long_chain(spark):
    check(spark, {str(i): str(i - 1) if i else None for i in range(70)})


def test_a_star_and_a_cycle_of_three(spark):
    parents = {"root": None, **{f"n{i}": "root" for i in range(40)}, "a": "b", "b": "c", "c": "a", "under": "a", "self": "self"}
    check(spark, parents)


def test_empty_and_repeated(spark):
    none = hierarchy(spark.createDataFrame([], DDL))
    assert none.closure.collect() == [] and none.faults.collect() == []
    df = spark.createDataFrame([("a", None), ("b", "a"), ("b", "a"), ("b", "0"), ("0", None), (None, "a"), (None, None)], DDL)
    found = hierarchy(df)
    assert sorted((r["id"], r["ancestor"]) for r in found.closure.collect()) == [("0", "0"), ("a", "a"), ("b", "0"), ("b", "b")]
    assert [tuple(r) for r in found.faults.collect()] == [("b", "repeated", "3")]


def test_paths_and_levels(spark):
    rows = [("a", None, "/a", 1), ("b", "a", "/a/b", 2), ("c", "b", "/a/c", 3), ("d", "c", None, 9), ("e", "a", "/a/e", None), ("x", "y", "/y/x", 2), ("y", "x", "/x/y", 1)]
    found = hierarchy(spark.createDataFrame(rows, "id string, parent_id string, path string, level long"), path_col="path", level_col="level")
    assert sorted(tuple(r) for r in found.faults.collect()) == [("c", "path", "/a/b/c"), ("d", "level", "4"), ("x", "cycle", None), ("y", "cycle", None)]


def test_totals_of_all_below(spark):
    tree = spark.createDataFrame([("a", None), ("b", "a"), ("c", "b"), ("d", None)], DDL)
    facts = spark.createDataFrame([("c", 1), ("c", 2), ("b", 10), ("d", 100), ("nowhere", 1000), (None, 5)], "unit string, v long")
    closure = hierarchy(tree).closure
    got = {r["ancestor"]: (r["n_facts"], r["v"]) for r in roll_up(facts, closure, "unit", ["v"]).collect()}
    assert got == {"a": (3, 13), "b": (3, 13), "c": (2, 3), "d": (1, 100), None: (2, 1005)}
    assert sorted(tuple(r) for r in below(closure, "a").collect()) == [("a", 0), ("b", 1), ("c", 2)]
