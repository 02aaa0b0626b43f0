"""Star reports against counting by hand."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import sedimenta as sd
from sedimenta.operators.star import Link, group_sets, star_report
from sedimenta.plans.curated import star


@pytest.fixture
def parts(spark):
    rng = random.Random(2)
    facts = [(rng.choice([None, "u1", "u2", "u3", "hot", "hot", "hot"]), rng.choice([None, "c1", "c2", "zz"]), rng.choice(["a", "b"]), rng.randint(-50, 50), Decimal(rng.randint(-999, 999)) / 100) for _ in range(400)]
    units = [("North", "u1"), ("North", "u1"), ("South", "u1"), ("South", "u2"), ("North", "hot"), ("East", "hot"), ("South", "hot"), (None, "u3"), (None, None), ("Empty", None)]
    combos = [("F", "c1"), ("M", "c2"), ("F", "c2"), ("never", "c9")]
    fact = spark.createDataFrame(facts, "unit string, combo string, period string, n long, amount decimal(10,2)")
    links = {
        "Area": Link(spark.createDataFrame(units, "name string, member string"), "unit", "member"),
        "Gender": Link(spark.createDataFrame(combos, "name string, id string"), "combo", "id"),
    }
    sets = [{m: sorted({n for n, x in bridge if x == m and n}) for m in {x for _, x in bridge if x}} for bridge in (units, combos)]
    return facts, fact, links, sets


def brute(facts, sets, sharing):
    out = {}

    def add(key, n, values):
        old = out.setdefault(key, [0, 0, Decimal(0)])
        for i, v in enumerate((n, *values)):
            old[i] += v

    groups = {}
    for unit, combo, period, n, amount in facts:
        key = (period, tuple(sets[0].get(unit, [])), tuple(sets[1].get(combo, [])))
        old = groups.setdefault(key, [0, 0, Decimal(0)])
        for i, v in enumerate((1, n, amount)):
            old[i] += v
    for (period, a, b), (count, n, amount) in groups.items():
        if sharing == "sets":
            add((period, a, b), count, (n, amount))
            continue
        pairs = [(x, y) for x in a or [None] for y in b or [None]]
        for at, (x, y) in enumerate(pairs):
            if sharing == "each":
                add((period, x, y), count, (n, amount))
            else:
                k = len(pairs)
                share = [v // k + (at < v % k) for v in (count, n, int(amount * 100))]
                add((period, x, y), share[0], (share[1], Decimal(share[2]) / 100))
    return {k: tuple(v) for k, v in out.items()}


@pytest.mark.parametrize("sharing", ["sets", "each", "split"])
def test_two_dimensions(parts, sharing):
    facts, fact, links, sets = parts
    out = star_report(fact, links, ["n", "amount"], ["period"], sharing)
    assert out.columns == ["period", "Area", "Gender", "n_facts", "n", "amount"]
    rows = out.collect()
    shape = (lambda x: tuple(x)) if sharing == "sets" else (lambda x: x)
    got = {(r["period"], shape(r["Area"]), shape(r["Gender"])): (r["n_facts"], r["n"], r["amount"]) for r in rows}
    assert len(got) == len(rows)
    assert got == brute(facts, sets, sharing)
    if sharing != "each":
        assert sum(v[0] for v in got.values()) == len(facts)
        assert sum(v[1] for v in got.values()) == sum(f[3] for f in facts)
        assert sum(v[2] for v in got.values()) == sum(f[4] for f in facts)


def test_no_dimension_and_empty_facts(parts):
    _, fact, links, _ = parts
    assert star_report(fact, {}, [], []).collect()[0]["n_facts"] == 400
    assert star_report(fact.limit(0), links, ["n"], ["period"], "split").collect() == []


def test_refusals(parts):
    _, fact, links, _ = parts
    with pytest.raises(ValueError, match="sharing"):
        star_report(fact, links, sharing="twice")
    with pytest.raises(ValueError, match="split"):
        star_report(fact.withColumn("x", F.lit(1.5)), links, ["x"], sharing="split")
    with pytest.raises(ValueError, match="share a name"):
        star_report(fact.withColumn("area", F.lit(1)), links, ["area"])


def test_one_fact_is_one_row_on_either_side_of_the_join(parts):
    """The bridge is unique by member when the facts meet it."""
    _, _, links, _ = parts
    sets = group_sets(links["Area"].bridge, "member")
    assert {r["member"]: r["groups"] for r in sets.collect()} == {"u1": ["North", "South"], "u2": ["South"], "hot": ["East", "North", "South"]}


def test_over_the_curated_layer(spark, tmp_path):
    root = str(tmp_path)
    facts = [("d1", "c1", "a1", "2024", "u1", "3"), ("d1", "c2", "a1", "2024", "u1", "4.5"), ("d2", "c1", "a2", "2024", "u2", "yes"), ("d1", "c1", None, "2025", "u9", "1")]
    sd.write_curated(spark.createDataFrame(facts, "dataElement_id string, categoryOptionCombo_id string, attributeOptionCombo_id string, period string, orgUnit string, value string"), f"{root}/dataElement-values")
    sd.write_curated(spark.createDataFrame([("Rural", "u1"), ("All", "u1"), ("All", "u2")], "name string, organisationUnits_id string"), f"{root}/Area")
    sd.write_curated(spark.createDataFrame([("F", "c1"), ("M", "c2")], "name string, categoryOptionCombos_id string"), f"{root}/Gender")
    sd.write_curated(spark.createDataFrame([("P", "a1")], "name string, attributeOptionCombo_id string"), f"{root}/Project")
    out = star(spark, root, ["Area", "Gender"])
    got = {(r["period"], r["Area"], r["Gender"]): (r["n_facts"], None if r["value"] is None else float(r["value"])) for r in out.collect()}
    assert got == {
        ("2024", "Rural", "F"): (1, 3.0), ("2024", "All", "F"): (2, 3.0), ("2024", "Rural", "M"): (1, 4.5), ("2024", "All", "M"): (1, 4.5), ("2025", None, "F"): (1, 1.0),
    }
    by_project = star(spark, root, ["Project"], by=[], sharing="split").collect()
    assert {r["Project"]: r["n_facts"] for r in by_project} == {"P": 2, None: 2}
    with pytest.raises(ValueError, match="no dimension"):
        star(spark, root, ["Org Unit"])
