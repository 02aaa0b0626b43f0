"""Landed documents against declared schemas."""

import json

import pytest
from pyspark.sql.types import _parse_datatype_string

from sedimenta.sources.drift import drift, landed_schema, landing_drift

DECLARED = "struct<items:array<struct<id:string,n:bigint,x:double,when:struct<a:string>,tags:array<string>,gone:string>>,total:bigint>"


@pytest.fixture
def landed(tmp_path):
    def write(*documents):
        path = tmp_path / "landed"
        path.mkdir(exist_ok=True)
        (path / "a.json").write_text("\n".join(d if isinstance(d, str) else json.dumps(d) for d in documents))
        return str(path)

    return write


def test_differences(spark, landed):
    path = landed(
        {"items": [{"id": "1", "n": 1, "x": 2, "when": {"a": "t", "b": 1}, "tags": ["x"]}], "total": 1},
        {"items": [{"id": 7, "n": "many", "x": 2.5, "extra": [{"k": 1}], "tags": "none", "we`ird,name": 1}], "page": {"size": 50}},
        {"items": []},
        {"items": None},
        "{broken",
        "",
    )
    got = {(r["path"], r["kind"]): (r["declared"], r["landed"]) for r in landing_drift(spark, path, _parse_datatype_string(DECLARED)).collect()}
    assert set(got) == {
        ("items[].id", "other type"), ("items[].n", "other type"), ("items[].when.b", "undeclared"), ("items[].tags", "other type"),
        ("items[].gone", "absent"), ("items[].extra", "undeclared"), ("items[].we`ird,name", "undeclared"), ("page", "undeclared"), ("", "unreadable"),
    }
    assert got[("items[].extra", "undeclared")][1].startswith("array<struct<k:")
    assert got[("", "unreadable")] == (None, "1")


def test_no_drift(spark, landed):
    path = landed({"items": [{"id": "1", "n": 3, "x": 1, "when": None, "tags": [], "gone": "g"}], "total": 10**12})
    assert landing_drift(spark, path, _parse_datatype_string(DECLARED)).collect() == []


def test_counts_and_an_empty_folder(spark, landed):
    found, n, bad = landed_schema(spark, landed({"a": 1}, {"a": None}, "x{"))
    assert (n, bad) == (3, 1) and found.simpleString().startswith("struct<a:")
    found, n, bad = landed_schema(spark, landed(""))
    assert (n, bad) == (0, 0) and drift(_parse_datatype_string("struct<a:int>"), found) == []
