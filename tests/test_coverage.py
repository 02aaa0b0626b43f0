"""Covered intervals and gaps against sets of whole numbers."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import sedimenta as sd
from sedimenta.operators.coverage import gaps, islands

DDL = "unit string, start long, end long"


def brute(fetches):
    out = {}
    for unit, a, b in fetches:
        if a is not None and b is not None and a < b:
            out.setdefault(unit, []).append((a, b))
    found = []
    for unit, spans in out.items():
        spans.sort()
        now, n = list(spans[0]), 0
        for a, b in spans:
            if a > now[1]:
                found.append((unit, *now, n))
                now, n = [a, b], 0
            now[1] = max(now[1], b)
            n += 1
        found.append((unit, *now, n))
    return sorted(found, key=repr)


def missing(fetches, wanted):
    found = []
    for unit, a, b in wanted:
        if a is None or b is None:
            continue
        held = {x for u, s, e in fetches if u == unit and s is not None and e is not None for x in range(s, e)}
        run = None
        for x in range(a, b + 1):
            if x < b and x not in held:
                run = x if run is None else run
            elif run is not None:
                found.append((unit, run, x))
                run = None
    return sorted(found, key=repr)


@pytest.mark.parametrize("span", [None, 1, 7, 1000])
def test_random_fetches(spark, rows, span):
    rng = random.Random(span or 0)
    units = [None, "a", "hot", "hot", "hot"]
    fetches = [(rng.choice(units), *((a := rng.randrange(100)), a + rng.randint(-2, 9))) for _ in range(200)]
    fetches += [("a", None, 5), ("a", 5, None), ("once", 10, 20), ("once", 20, 25)]
    df = spark.createDataFrame(fetches, DDL)
    by = F.floor(F.col("start") / span) if span else None
    found = islands(df, ["unit"], span=by)
    assert found.columns == ["unit", "start", "end", "n_fetches"]
    assert rows(found) == brute(fetches)
    wanted = [("a", 0, 120), ("hot", 30, 40), (None, -5, 300), ("once", 12, 18), ("new", 0, 10), ("none", None, 3), ("back", 9, 3)]
    asked = spark.createDataFrame(wanted, DDL)
    assert rows(gaps(asked, found, ["unit"])) == missing(fetches, wanted)


def test_empty(spark):
    none = spark.createDataFrame([], DDL)
    assert islands(none, ["unit"]).collect() == []
    asked = spark.createDataFrame([("a", 1, 2)], DDL)
    assert [tuple(r) for r in gaps(asked, islands(none, ["unit"]), ["unit"]).collect()] == [("a", 1, 2)]
    assert gaps(none, islands(asked, ["unit"]), ["unit"]).collect() == []


def test_a_failed_unit_is_asked_again_from_its_own_gap(spark):
    day = datetime(2024, 1, 1)
    log = [(u, day + timedelta(d), day + timedelta(d + 1), ok) for u in ("u1", "u2") for d, ok in enumerate([True, u == "u1", True])]
    fetched = spark.createDataFrame(log, "unit string, start timestamp, end timestamp, ok boolean").filter("ok")
    wanted = spark.createDataFrame([(u, day, day + timedelta(4)) for u in ("u1", "u2", "u3")], "unit string, start timestamp, end timestamp")
    open_gaps = gaps(wanted, islands(fetched, ["unit"], span=F.to_date("start")), ["unit"])
    texts = open_gaps.select("unit", *[sd.iso_text(c).alias(c) for c in ("start", "end")])
    plan = sd.request_plan(texts, {"unit": "orgUnit", "start": "lastUpdatedStartDate", "end": "lastUpdatedEndDate"})
    got = sorted(r["parameters"].replace("%3A", ":") for r in plan.collect())
    assert got == [
        "orgUnit=u1&lastUpdatedStartDate=2024-01-04T00:00:00&lastUpdatedEndDate=2024-01-05T00:00:00",
        "orgUnit=u2&lastUpdatedStartDate=2024-01-02T00:00:00&lastUpdatedEndDate=2024-01-03T00:00:00",
        "orgUnit=u2&lastUpdatedStartDate=2024-01-04T00:00:00&lastUpdatedEndDate=2024-01-05T00:00:00",
        "orgUnit=u3&lastUpdatedStartDate=2024-01-01T00:00:00&lastUpdatedEndDate=2024-01-05T00:00:00",
    ]
