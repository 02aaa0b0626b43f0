"""Bitmaps of list members against Python sets."""

import random

import pytest

from sedimenta.operators.membership import (
    count_members,
    list_bitmaps,
    member_numbers,
    members_matching,
    members_of,
    overlaps,
    union_of_lists,
)


@pytest.fixture(scope="module")
def lists(spark):
    rng = random.Random(3)
    everyone = [f"m{i}" for i in range(70_000)]
    sets = {"all": set(everyone), "few": {everyone[0], "m69999"}, "odd": set(everyone[1::2]), "third": set(everyone[::3]), "none": set()}
    sets["some"] = set(rng.sample(everyone, 5000))
    rows = [(name, m) for name, held in sets.items() for m in held]
    rows += rows[:100] + [("few", None), (None, "m1")]
    df = spark.createDataFrame(rows, "list string, member string")
    numbers = member_numbers(df, "member", together=20_000)
    return sets, df, numbers, list_bitmaps(df, numbers, "list", "member")


def test_numbers_have_no_gaps(lists):
    sets, _, numbers, _ = lists
    got = numbers.collect()
    assert sorted(r["number"] for r in got) == list(range(len(sets["all"])))
    assert {r["member"] for r in got} == sets["all"]


def test_bitmaps_are_small(lists):
    _, _, _, bitmaps = lists
    assert bitmaps.groupBy("list").count().filter("list = 'all'").first()["count"] == 3


@pytest.mark.parametrize(
    "question",
    [
        {"all_of": ["odd", "third"]},
        {"all_of": ["odd", "third", "some"]},
        {"all_of": ["odd", "none"]},
        {"any_of": ["few", "some"]},
        {"all_of": ["odd"], "any_of": ["third", "some"]},
        {"all_of": ["all"], "none_of": ["odd", "third"]},
        {"any_of": ["some", "few"], "none_of": ["third"]},
        {"all_of": ["third"], "any_of": ["some"], "none_of": ["odd", "few"]},
        {"all_of": ["nobody"]},
        {"any_of": ["nobody", "few"], "none_of": ["nobody"]},
        {"all_of": ["few", "few"]},
    ],
)
def test_questions(lists, question):
    sets, _, numbers, bitmaps = lists
    want = None
    for name in question.get("all_of", []):
        held = sets.get(name, set())
        want = held if want is None else want & held
    if "any_of" in question:
        some = set().union(*(sets.get(n, set()) for n in question["any_of"]))
        want = some if want is None else want & some
    for name in question.get("none_of", []):
        want = want - sets.get(name, set())
    found = members_matching(bitmaps, **question)
    assert count_members(found).first()["n_members"] == len(want)
    assert sorted(r["member"] for r in members_of(found, numbers).collect()) == sorted(want)


def test_union_and_overlaps(lists):
    sets, _, numbers, bitmaps = lists
    assert count_members(union_of_lists(bitmaps, ["few", "third"])).first()["n_members"] == len(sets["few"] | sets["third"])
    assert count_members(union_of_lists(bitmaps)).first()["n_members"] == len(sets["all"])
    named = bitmaps.filter("list IS NOT NULL")
    got = {(r["list"], r["other"]): (r["n_both"], r["n_either"]) for r in overlaps(named).collect()}
    names = sorted(n for n in sets if sets[n])
    assert got == {(a, b): (len(sets[a] & sets[b]), len(sets[a] | sets[b])) for a in names for b in names if a < b}


def test_empty_and_refused(spark):
    none = spark.createDataFrame([], "list string, member string")
    numbers = member_numbers(none, "member")
    bitmaps = list_bitmaps(none, numbers, "list", "member")
    assert bitmaps.collect() == []
    assert count_members(members_matching(bitmaps, ["a"], none_of=["b"])).first()["n_members"] == 0
    with pytest.raises(ValueError, match="have to be in"):
        members_matching(bitmaps, none_of=["a"])
