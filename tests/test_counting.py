"""Dimensions refreshed by counting against dimensions built anew."""

import random

import pytest

import sedimenta as sd
from sedimenta.operators.counting import COUNT, apply_difference, changed_keys, counted, refresh_members

ITEMS = "dimensionType string, id string, name string, items_id string"
GROUPS = "id string, name string, member string"


def build(items, groups):
    return sd.dimension_members(items, groups, "L", "member")


@pytest.mark.parametrize("seed", range(4))
def test_random_changes_equal_a_rebuild(spark, seed):
    rng = random.Random(seed)

    def some_items():
        return [("t", "d", rng.choice(["L", "L", "other"]), rng.choice([None, *"abcde"])) for _ in range(rng.randrange(12))]

    def some_groups():
        return [(rng.choice([None, *"abcdef"]), rng.choice(["G", "H", None]), rng.choice([None, "m1", "m2", "m3"])) for _ in range(rng.randrange(30))]

    def changed(data, fresh):
        kept = [r for r in data if rng.random() < 0.7]
        return kept + fresh()[: rng.randrange(4)]

    items, groups = some_items(), some_groups()

    def frames():
        return spark.createDataFrame(items, ITEMS), spark.createDataFrame(groups, GROUPS)

    old_items, old_groups = frames()
    view = counted(build(old_items, old_groups))
    for _ in range(3):
        items, groups = changed(items, some_items), changed(groups, some_groups)
        new_items, new_groups = frames()
        view = refresh_members(view, build, (old_items, new_items), (old_groups, new_groups))
        rows = view.collect()
        view = spark.createDataFrame([tuple(r) for r in rows], view.schema)
        want = counted(build(new_items, new_groups)).collect()
        assert sorted((tuple(r) for r in rows), key=repr) == sorted((tuple(r) for r in want), key=repr)
        old_items, old_groups = new_items, new_groups


def test_a_row_with_two_reasons_stays_until_both_are_gone(spark):
    view = counted(spark.createDataFrame([("a",), ("a",), ("b",)], "name string"))
    one = spark.createDataFrame([("a",)], "name string")
    none = one.limit(0)
    after = apply_difference(view, one, none)
    assert {r["name"]: r[COUNT] for r in after.collect()} == {"a": 1, "b": 1}
    assert {r["name"] for r in apply_difference(after, one, none).collect()} == {"b"}
    with pytest.raises(Exception, match="taken away but not there: c"):
        apply_difference(view, spark.createDataFrame([("c",)], "name string"), none).collect()


def test_changed_keys(spark):
    old = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), (None, 3), ("c", 4)], "k string, v int")
    new = spark.createDataFrame([("a", 1), ("b", 2), (None, 4), ("c", 5), ("d", 1)], "k string, v int")
    assert sorted(r["k"] for r in changed_keys(old, new, "k").collect()) == ["a", "c", "d"]


def test_only_the_changes_are_joined(spark):
    """Of the groups only those of changed keys reach the join."""
    items = spark.createDataFrame([("t", "d", "L", str(i)) for i in range(50)], ITEMS)
    groups = spark.createDataFrame([(str(i), "G", f"m{i}") for i in range(50)], GROUPS)
    more = groups.union(spark.createDataFrame([("7", "G", "new")], GROUPS))
    seen = []

    def watched(a, b):
        seen.append((a.count(), b.count()))
        return build(a, b)

    view = refresh_members(counted(build(items, groups)), watched, (items, items), (groups, more))
    assert seen == [(1, 1), (1, 2)]
    assert view.count() == 51
