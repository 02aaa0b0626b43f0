"""Least common schemas: bounds, refusals, and tables whose batches bring new columns."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql.types import StructType, _parse_datatype_string

import sedimenta as sd
from sedimenta.operators.lattice import NoCommonType, common_schema, common_type, to_schema, union_of

_SIMPLE = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal(9,2)", "decimal(20,0)", "string", "date", "timestamp_ntz", "void")


def kind(text):
    return _parse_datatype_string(text)


@pytest.mark.parametrize(
    "a,b,both",
    [
        ("int", "bigint", "bigint"),
        ("tinyint", "decimal(4,2)", "decimal(5,2)"),
        ("decimal(10,2)", "decimal(8,4)", "decimal(12,4)"),
        ("bigint", "decimal(5,1)", "decimal(20,1)"),
        ("float", "smallint", "float"),
        ("float", "int", "double"),
        ("void", "array<int>", "array<int>"),
        ("date", "timestamp_ntz", "timestamp_ntz"),
        ("array<int>", "array<bigint>", "array<bigint>"),
        ("map<string,int>", "map<string,double>", "map<string,double>"),
        ("struct<a:int,b:string>", "struct<b:string,c:date>", "struct<a:int,b:string,c:date>"),
        ("array<struct<a:int>>", "array<struct<a:bigint,z:int>>", "array<struct<a:bigint,z:int>>"),
    ],
)
def test_narrowest_type(a, b, both):
    assert common_type(kind(a), kind(b)).simpleString() == both
    assert isinstance(common_type(kind(b), kind(a)), type(kind(both)))


@pytest.mark.parametrize("a,b", [("int", "string"), ("bigint", "double"), ("struct<a:int>", "int"), ("decimal(38,0)", "decimal(10,5)"), ("boolean", "int"), ("date", "timestamp")])
def test_refused(a, b):
    with pytest.raises(NoCommonType):
        common_type(kind(a), kind(b))


@settings(max_examples=300, deadline=None)
@given(st.sampled_from(_SIMPLE), st.sampled_from(_SIMPLE), st.sampled_from(_SIMPLE))
def test_lattice_laws(a, b, c):
    a, b, c = kind(a), kind(b), kind(c)

    def join(x, y):
        try:
            return common_type(x, y)
        except NoCommonType:
            return None

    assert join(a, a) == a
    assert join(a, b) == join(b, a)
    ab, bc = join(a, b), join(b, c)
    if ab is not None:
        assert join(ab, a) == ab and join(ab, b) == ab  # an upper bound of both
    left = join(ab, c) if ab is not None else None
    right = join(a, bc) if bc is not None else None
    if left is not None and right is not None:
        assert left == right


def test_names_that_differ_in_case_are_one_field():
    a, b = kind("struct<Id:int,x:int>"), kind("struct<ID:bigint,y:int>")
    assert common_schema(a, b).simpleString() == "struct<Id:bigint,x:int,y:int>"
    with pytest.raises(ValueError, match="case only"):
        common_schema(StructType().add("a", kind("int")).add("A", kind("int")), b)


def test_values_survive(spark, rows):
    a = spark.createDataFrame([(1, (2, "x"), [(1,)]), (None, None, None)], "n int, s struct<p:int,q:string>, l array<struct<k:int>>")
    b = spark.createDataFrame([(2**40, ("y", 1.5), [(2**40, "new")], True)], "N bigint, s struct<q:string,r:double>, l array<struct<k:bigint,z:string>>, extra boolean")
    both = union_of(a, b)
    assert both.schema.simpleString() == "struct<n:bigint,s:struct<p:int,q:string,r:double>,l:array<struct<k:bigint,z:string>>,extra:boolean>"
    assert rows(both) == sorted(
        [(1, (2, "x", None), [(1, None)], None), (None, None, None, None), (2**40, (None, "y", 1.5), [(2**40, "new")], True)], key=repr
    )


def test_a_batch_with_a_new_column(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    sd.load_incremental(spark.createDataFrame([(i, "a") for i in range(20)], "id int, v string"), path, ["id"], buckets=2)
    new = spark.createDataFrame([(1, 2.5)], "id int, extra double")
    with pytest.raises(ValueError, match="columns differ"):
        sd.load_incremental(new, path, ["id"])
    before = {p.name for p in (tmp_path / "t").iterdir()}
    sd.load_incremental(new, path, ["id"], merge_schema=True)
    added = {p.name for p in (tmp_path / "t").iterdir()} - before
    assert len(added) == 1  # the run alone: nothing was rewritten for a column that is new
    got = rows(sd.read_table(spark, path).filter("id < 3"))
    assert got == [(0, "a", None), (1, None, 2.5), (2, "a", None)]
    # an older program's batch still fits
    sd.load_incremental(spark.createDataFrame([(2, "b")], "id int, v string"), path, ["id"], merge_schema=True)
    assert rows(sd.read_table(spark, path).filter("id = 2")) == [(2, "b", None)]


def test_a_batch_with_wider_keys(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    sd.load_incremental(spark.createDataFrame([(1, "a"), (2, "a")], "id int, v string"), path, ["id"], buckets=8)
    sd.load_incremental(spark.createDataFrame([(2, "b"), (2**40, "b")], "id bigint, v string"), path, ["id"], merge_schema=True)
    assert rows(sd.read_table(spark, path)) == sorted([(1, "a"), (2, "b"), (2**40, "b")], key=repr)
    with pytest.raises(NoCommonType, match="id"):
        sd.load_incremental(spark.createDataFrame([("x", "c")], "id string, v string"), path, ["id"], merge_schema=True)
    assert sd.read_table(spark, path).count() == 3


def test_random_batches_equal_a_union(spark, tmp_path, rows):
    """Columns come, go and grow; the table is what a dictionary of all rows would be."""
    rng = random.Random(7)
    path = str(tmp_path / "t")
    pool = {"a": ["int", "bigint"], "b": ["smallint", "decimal(9,2)"], "c": ["string"], "d": ["float", "double"]}
    want, schema = {}, None
    for poll in range(6):
        names = rng.sample(sorted(pool), rng.randint(1, 4))
        ddl = ", ".join(["id int", *(f"{n} {rng.choice(pool[n])}" for n in names)])
        ids = rng.sample(range(12), rng.randint(1, 8))
        df = spark.createDataFrame([(i,) for i in ids], "id int").selectExpr(
            "id", *[f"CAST('{poll}' AS {part.split(' ', 1)[1]}) AS {part.split(' ', 1)[0]}" for part in ddl.split(", ")[1:]]
        )
        sd.load_incremental(df, path, ["id"], merge_schema=True, buckets=3)
        schema = common_schema(schema, df.schema) if schema else df.schema
        want |= {i: {"id": i, **dict.fromkeys(names, poll)} for i in ids}
    got = sd.read_table(spark, path)
    assert got.schema.simpleString() == schema.simpleString()
    found = {r["id"]: {k: (v if k == "id" else float(v)) for k, v in r.asDict().items() if v is not None} for r in got.collect()}
    assert found == want


def test_to_schema_keeps_null_structs(spark):
    df = spark.createDataFrame([(None,), ((1,),)], "s struct<a:int>")
    out = to_schema(df, kind("struct<s:struct<a:bigint,b:int>>"))
    assert [r["s"] for r in out.collect()] == [None, (1, None)]
