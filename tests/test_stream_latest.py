"""The latest row of every key from polls that overlap, come late and repeat themselves."""

import random
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import sedimenta as sd
from sedimenta.operators.upsert import latest_per_key
from sedimenta.sources.tables import snapshot_of, versions
from sedimenta.streaming.upserts import stream_latest

DDL = "id LONG, part STRING, at LONG, v STRING"


def frame(spark, data):
    return spark.createDataFrame(data, DDL)


def some_rows(rng, n):
    return [
        (rng.choice([None, *range(12)]), rng.choice([None, "", "a", "b"]), rng.choice([None, *range(6)]), rng.choice([None, "x", "y", "z"]))
        for _ in range(n)
    ]


def poll(spark, tmp_path, data, **options):
    """One more file, and the stream run over what is new; returns its last progress."""
    landing = str(tmp_path / "landing")
    frame(spark, data).coalesce(1).write.mode("append").parquet(landing)
    query = stream_latest(
        spark.readStream.schema(DDL).parquet(landing), str(tmp_path / "t"), ["id", "part"],
        str(tmp_path / "checkpoint"), version="at", **options,
    )
    query.awaitTermination()
    return query.recentProgress


def dropped(progress):
    return sum(p.stateOperators[0].customMetrics.get("numDroppedDuplicateRows", 0) for p in progress if p.stateOperators)


@pytest.mark.parametrize("null_safe", [True, False])
def test_polls_equal_one_batch(spark, tmp_path, rows, null_safe):
    """Late, repeated and tied rows, NULLs in every column, over four polls."""
    rng = random.Random(3)
    first = some_rows(rng, 60)
    polls = [first, first[:20] + some_rows(rng, 30), some_rows(rng, 5), first]
    repeats = 0
    for data in polls:
        progress = poll(spark, tmp_path, data, null_safe=null_safe, buckets=3)
        repeats += dropped(progress)
        assert all(p.stateOperators[0].numRowsDroppedByWatermark == 0 for p in progress if p.stateOperators)
    everything = [r for data in polls for r in data]
    assert repeats == len(everything) - len(set(everything))
    want = latest_per_key(frame(spark, list(set(everything))), ["id", "part"], "at", null_safe=null_safe)
    assert rows(sd.read_table(spark, str(tmp_path / "t"))) == rows(want)


def test_a_poll_without_news_writes_nothing(spark, tmp_path, rows):
    data = [(i, "a", 1, "x") for i in range(50)]
    poll(spark, tmp_path, data)
    path = str(tmp_path / "t")
    before, known = rows(sd.read_table(spark, path)), versions(spark, path)
    poll(spark, tmp_path, data[:30])
    assert versions(spark, path) == known and rows(sd.read_table(spark, path)) == before


def test_the_state_is_bounded_and_what_it_forgot_changes_nothing(spark, tmp_path, rows):
    old = [(i, "a", 1, "x") for i in range(50)]
    poll(spark, tmp_path, old, remember="1 second")
    poll(spark, tmp_path, [(i, "a", 2, "y") for i in range(50)], remember="1 second")
    for i in range(2):
        time.sleep(2.5)
        progress = poll(spark, tmp_path, [(1000 + i, "a", 0, "z")], remember="1 second")
    assert progress[-1].stateOperators[0].numRowsTotal <= 2
    # the first versions once more, forgotten by now: they reach the table and lose there
    assert dropped(poll(spark, tmp_path, old, remember="1 second")) == 0
    got = {r["id"]: r["v"] for r in sd.read_table(spark, str(tmp_path / "t")).collect()}
    assert got == {**{i: "y" for i in range(50)}, 1000: "z", 1001: "z"}


def test_own_columns_are_refused(spark, tmp_path):
    stream = spark.readStream.schema("id LONG, _Digest STRING").parquet(str(tmp_path))
    with pytest.raises(ValueError, match="_digest"):
        stream_latest(stream, str(tmp_path / "t"), ["id"], str(tmp_path / "c"), version="id")


@pytest.mark.parametrize("layout", [{}, {"partition_by": ["part"]}, {"buckets": 2, "bucket_by": ["id"]}])
def test_a_table_kept_latest_by_is_the_same_in_any_order(spark, tmp_path, rows, layout):
    rng = random.Random(5)
    batches = [some_rows(rng, n) for n in (1, 40, 3, 10, 60, 2)]
    want = rows(latest_per_key(frame(spark, [r for b in batches for r in b]), ["id", "part"], "at"))
    for turn in range(2):
        path = str(tmp_path / f"t{turn}")
        rng.shuffle(batches)
        for i, batch in enumerate(batches):
            sd.load_incremental(frame(spark, batch), path, ["id", "part"], latest_by="at", null_safe=True, **layout)
            if i == 3:
                sd.compact_table(spark, path)
        assert rows(sd.read_table(spark, path)) == want


def test_a_batch_is_written_without_reading_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    big = spark.range(50_000).select("id", F.lit("p").alias("part"), F.lit(5).cast("long").alias("at"), F.lit("x").alias("v"))
    sd.load_incremental(big, path, ["id"], latest_by="at", buckets=16)
    late = big.filter("id % 500 = 0").withColumns({"at": F.lit(4).cast("long"), "v": F.lit("late")})
    sd.load_incremental(late, path, ["id"], latest_by="at")
    written = [spark.read.parquet(str(p)).count() for p in Path(path).glob("snapshot=2-*")]
    assert written == [100]
    table = sd.read_table(spark, path)
    assert table.count() == 50_000 and table.filter("v = 'late'").isEmpty()


def test_a_table_changes_its_rule_by_being_put_together(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    for at, v in ((3, "a"), (1, "b")):
        sd.load_incremental(frame(spark, [(i, "p", at, v) for i in range(8 if v == "a" else 2)]), path, ["id", "part"])
    sd.load_incremental(frame(spark, [(0, "p", 0, "late"), (1, "p", 2, "new")]), path, ["id", "part"], latest_by="at")
    got = {r["id"]: r["v"] for r in sd.read_table(spark, path).collect()}
    assert (got[0], got[1], got[2]) == ("b", "new", "a") and len(got) == 8
    assert snapshot_of(spark, path).latest_by == "at"
    sd.load_incremental(frame(spark, [(1, "p", 0, "last")]), path, ["id", "part"])
    assert {r["id"]: r["v"] for r in sd.read_table(spark, path).collect()}[1] == "last"
    with pytest.raises(ValueError, match="latest_by"):
        sd.load_incremental(frame(spark, []), path, ["id"], latest_by="at", newer_only="at")
