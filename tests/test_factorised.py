"""One table per array: rows add up instead of multiplying, and rejoin to what flatten gives."""

import pytest

import sedimenta as sd
from sedimenta.operators.factorised import factorise

DDL = (
    "id long, meta struct<lang:string, tags:array<string>>, "
    "contacts array<struct<id:string, phones:array<struct<no:string>>>>, lines array<string>"
)
ROWS = [
    (1, ("en", ["x", "y"]), [("a", [("1",), ("2",)]), ("b", []), ("c", None)], ["l1", "l2", "l2"]),
    (2, (None, []), [], ["only"]),
    (3, None, None, None),
    (4, ("de", None), [("d", [(None,)]), None], []),
    (1, ("en", ["x", "y"]), [("a", [("1",), ("2",)]), ("b", []), ("c", None)], ["l1", "l2", "l2"]),
]


@pytest.fixture
def nested(spark):
    return spark.createDataFrame(ROWS, DDL)


def test_tables(nested, rows):
    parts = factorise(nested)
    assert parts.parents == {"meta_tags": "", "contacts": "", "contacts_phones": "contacts", "lines": ""}
    sizes = {name: df.count() for name, df in parts.tables.items()}
    assert sizes == {"": 5, "meta_tags": 4, "contacts": 8, "contacts_phones": 5, "lines": 7}
    lines = parts.tables["lines"]
    assert lines.columns == ["_row", "_parent", "_at", "lines"]
    root = parts.tables[""]
    met = lines.join(root.filter("id = 2"), lines["_parent"] == root["_row"])
    assert rows(met, "_at", "lines") == [(0, "only")]
    for df in parts.tables.values():
        assert df.select("_row").distinct().count() == df.count()


def test_the_product_is_what_flatten_gives(nested, rows):
    flat = sd.flatten(nested)
    product = factorise(nested).product()
    assert sorted(product.columns) == sorted(flat.columns)
    assert rows(product.select(*flat.columns)) == rows(flat)


def test_only_the_arrays_that_are_asked_for(nested, rows):
    parts = factorise(nested)
    some = parts.product(["contacts_phones"])
    assert some.columns == ["id", "meta_lang", "contacts_id", "contacts_phones_no"]
    flat = sd.flatten(nested, columns=some.columns)
    assert rows(some) == rows(flat.select(*some.columns))
    inner = parts.product(["lines"], outer=False)
    assert inner.count() == 7 and inner.columns == ["id", "meta_lang", "lines"]
    with pytest.raises(KeyError, match="no such array"):
        parts.product(["nothing"])


def test_empty_and_plain(spark, rows):
    none = factorise(spark.createDataFrame([], DDL))
    assert none.product().collect() == []
    plain = spark.createDataFrame([(1, "a")], "n int, s string")
    assert rows(factorise(plain).product()) == [(1, "a")]


def test_two_fields_with_one_flat_name(spark):
    df = spark.createDataFrame([((1,), 2)], "a struct<b:int>, a_b int")
    with pytest.raises(ValueError, match="a_b"):
        factorise(df)


def test_arrays_of_arrays(spark, rows):
    df = spark.createDataFrame([(1, [[1, 2], [], [3]])], "id int, m array<array<int>>")
    with pytest.raises(ValueError, match="array of arrays"):
        factorise(df)
