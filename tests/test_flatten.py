import pytest
from pyspark.sql import functions as F

import sedimenta as sd

NESTED = (
    "root ARRAY<STRUCT<id: STRING, owner: STRUCT<id: STRING, name: STRING>, "
    "tags: ARRAY<STRUCT<code: STRING, value: STRING>>, "
    "notes: ARRAY<STRING>, extra: MAP<STRING, STRING>>>"
)


@pytest.fixture
def nested(spark):
    data = [
        (
            [
                ("a", ("o1", "n1"), [("c1", "v1"), ("c2", "v2")], ["x", "y"], {"k": "1"}),
                ("b", None, [], None, None),
            ],
        ),
        (None,),
    ]
    return spark.createDataFrame(data, NESTED)


def test_levels_and_names(nested):
    flat = sd.flatten(nested)
    assert flat.columns == [
        "root_id", "root_notes", "root_extra", "root_owner_id", "root_owner_name",
        "root_tags_code", "root_tags_value",
    ]


def test_siblings_multiply_and_empty_arrays_keep_the_record(nested, rows):
    flat = sd.flatten(nested)
    got = rows(flat, "root_id", "root_owner_id", "root_notes", "root_tags_code")
    assert got == sorted(
        [
            ("a", "o1", "x", "c1"), ("a", "o1", "x", "c2"),
            ("a", "o1", "y", "c1"), ("a", "o1", "y", "c2"),
            ("b", None, None, None), (None, None, None, None),
        ],
        key=repr,
    )


def test_map_is_passed_through(nested):
    assert sd.flatten(nested).schema["root_extra"].dataType.typeName() == "map"


def test_pruned_equals_full_under_distinct(nested, rows):
    for wanted in (["root_id"], ["root_id", "root_tags_value"], ["root_owner_name", "root_notes"]):
        full = sd.flatten(nested).select(*wanted).distinct()
        assert rows(sd.flatten(nested, columns=wanted).distinct()) == rows(full)


def test_pruned_has_no_needless_generator(nested):
    plan = sd.flatten(nested, columns=["root_id"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate") == 1


def test_keep_leaves_the_array(nested):
    flat = sd.flatten(nested, keep={"root_notes"})
    assert flat.schema["root_notes"].dataType.typeName() == "array"


def test_array_of_arrays(spark, rows):
    df = spark.createDataFrame([([[1, 2], [3]],), ([],)], "m ARRAY<ARRAY<INT>>")
    assert rows(sd.flatten(df)) == [(1,), (2,), (3,), (None,)]


def test_name_clash_is_refused(spark):
    df = spark.createDataFrame([("x", ("y",))], "a_b STRING, a STRUCT<b: STRING>")
    with pytest.raises(ValueError, match="a_b"):
        sd.flatten(df)


def test_dotted_names(spark, rows):
    df = spark.createDataFrame([(("v",),)], "`p.q` STRUCT<`r.s`: STRING>")
    assert sd.flatten(df).columns == ["p.q_r.s"]
    assert rows(sd.flatten(df)) == [("v",)]


def test_unknown_column_is_an_error(nested):
    with pytest.raises(Exception, match="root_nothing"):
        sd.flatten(nested, columns=["root_nothing"]).schema  # noqa: B018


def test_inferred_schema_works_too(spark, landing, rows):
    root = landing("x.json", {"items": [{"id": 1, "sub": [{"k": "a"}, {"k": "b"}]}]})
    flat = sd.flatten(sd.read_landing(spark, f"{root}/x.json"))
    assert rows(flat) == [(1, "a"), (1, "b")]


def test_array_text_keeps_null(spark, rows):
    df = spark.createDataFrame([(["1", "2"],), (None,), ([],)], "c ARRAY<STRING>")
    assert rows(df.select(sd.array_text("c"))) == sorted([("1,2",), (None,), ("",)], key=repr)


def test_scalars(spark, rows):
    df = spark.createDataFrame(
        [("2024-01-02T03:04:05.678+0100",), ("bad",), (None,)], "t STRING"
    )
    stamps = df.select(sd.iso_timestamp("t").cast("string"), sd.iso_date("t").cast("string"))
    assert rows(stamps) == sorted(
        [("2024-01-02 03:04:05", "2024-01-02"), (None, None), (None, None)], key=repr
    )
    assert rows(df.select(sd.iso_text(sd.iso_timestamp("t")))) == sorted(
        [("2024-01-02T03:04:05",), (None,), (None,)], key=repr
    )


def test_contact_address(spark, rows):
    df = spark.createDataFrame(
        [("u@x", "e@x"), ("u", "e@x"), ("u", "e"), (None, None), (None, "e@x")],
        "username STRING, email STRING",
    )
    got = [r[0] for r in df.select(sd.contact_address("username", "email")).collect()]
    assert got == ["u@x;", "e@x;", "", "", "e@x;"]


def test_null_when_keeps_the_value_of_an_unknown_condition(spark, rows):
    df = spark.createDataFrame([(4, "p"), (2, "q"), (None, "r")], "level INT, c STRING")
    got = rows(df.select("level", sd.null_when("c", F.col("level") != 4)))
    assert got == sorted([(4, "p"), (2, None), (None, "r")], key=repr)


def test_split_point(spark, rows):
    df = spark.createDataFrame([("1.5,2.5",), (None,)], "c STRING")
    parts = sd.split_point("c")
    assert rows(df.select(parts["long"], parts["lat"])) == sorted(
        [("1.5", "2.5"), (None, None)], key=repr
    )


def test_rename_ignores_unknown_names(spark):
    df = spark.createDataFrame([(1, 2)], "a INT, b INT")
    assert sd.rename(df, {"a": "x", "zzz": "y"}).columns == ["x", "b"]


def test_sorted_projection(spark):
    df = spark.createDataFrame([("b", 1), (None, 2), ("a", 3), ("b", 0)], "name STRING, id INT")
    got = [r["name"] for r in sd.sorted_projection(df, ["name", "id"], "name").collect()]
    assert got == [None, "a", "b", "b"]


def test_sorted_projection_behind_a_shuffle_is_staged(spark):
    df = spark.range(50).selectExpr("id % 3 AS name", "1 AS x").repartition(4)
    out = sd.sorted_projection(df, ["name", "x"], "name")
    assert "repartition" not in out._jdf.queryExecution().logical().toString().lower()
    got = [r["name"] for r in out.collect()]
    assert got == sorted(got) and len(got) == 50
