import pytest
from pyspark.sql import functions as F

import sedimenta as sd
from sedimenta.sources import storage
from sedimenta.sources.tables import snapshot_of, versions

DDL = "id LONG, period STRING, v STRING, at INT"
FIRST = [(1, "202401", "a", 1), (2, "202402", "b", 1), (3, None, "c", 1), (4, "", "d", 1)]
SECOND = [(1, "202401", "A", 2), (5, "202403", "e", 2), (3, None, "C", 0)]
MERGED = sorted([SECOND[0], FIRST[1], SECOND[2], FIRST[3], SECOND[1]], key=repr)


def frame(spark, data):
    return spark.createDataFrame(data, DDL)


@pytest.mark.parametrize(
    "layout",
    [
        {},
        {"partition_by": ["period"]},
        {"buckets": 4, "bucket_by": ["id"]},
    ],
    ids=["whole", "by_period", "by_bucket"],
)
def test_load_twice_then_again(spark, tmp_path, rows, layout):
    path = str(tmp_path / "t")
    keys = ["id", "period"]
    assert sd.load_incremental(frame(spark, FIRST), path, keys, null_safe=True, **layout) == 1
    assert rows(sd.read_table(spark, path)) == sorted(FIRST, key=repr)
    for version in (2, 3):
        done = sd.load_incremental(frame(spark, SECOND), path, keys, null_safe=True, **layout)
        assert done == version
        assert rows(sd.read_table(spark, path)) == MERGED
    assert rows(sd.read_table(spark, path, version=1)) == sorted(FIRST, key=repr)
    assert sd.read_table(spark, path).columns == ["id", "period", "v", "at"]


def test_only_touched_slices_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "t")
    sd.load_incremental(frame(spark, FIRST), path, ["id", "period"], partition_by=["period"])
    before = snapshot_of(spark, path).slices
    sd.load_incremental(frame(spark, SECOND[:1]), path, ["id", "period"])
    after = snapshot_of(spark, path).slices
    assert {n for n in after if after[n] != before.get(n)} == {"slice=p-202401"}


def test_reading_only_some_slices(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    sd.load_incremental(frame(spark, FIRST), path, ["id", "period"], partition_by=["period"])
    df = sd.read_table(spark, path, only={"period": ["202402", None]})
    assert rows(df, "id") == [(2,), (3,)]
    assert len(df.inputFiles()) <= 2
    assert rows(sd.read_table(spark, path, only={"v": ["d"]}), "id") == [(4,)]
    assert rows(sd.read_table(spark, path, only={"period": ["nope"]})) == []


def test_latest_and_newer_only(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    sd.load_incremental(
        frame(spark, [*FIRST, (1, "202401", "newer", 9)]), path, ["id", "period"],
        on_duplicate="latest", order_by="at", null_safe=True,
    )
    assert (1, "202401", "newer", 9) in rows(sd.read_table(spark, path))
    sd.load_incremental(
        frame(spark, SECOND), path, ["id", "period"], null_safe=True, newer_only="at"
    )
    got = rows(sd.read_table(spark, path))
    assert (1, "202401", "newer", 9) in got and (3, None, "c", 1) in got and len(got) == 5


def test_duplicates_fail_and_leave_the_table_alone(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    twice = frame(spark, [*SECOND, (5, "202403", "other", 3)])
    with pytest.raises(ValueError, match="duplicate key in batch: id=5"):
        sd.load_incremental(twice, path, ["id", "period"])
    assert not sd.table_exists(spark, path)
    sd.load_incremental(frame(spark, FIRST), path, ["id", "period"])
    with pytest.raises(ValueError, match="duplicate key"):
        sd.load_incremental(twice, path, ["id", "period"])
    assert versions(spark, path) == [1]
    assert rows(sd.read_table(spark, path)) == sorted(FIRST, key=repr)


def test_empty_batch_makes_no_version(spark, tmp_path):
    path = str(tmp_path / "t")
    assert sd.load_incremental(frame(spark, []), path, ["id"]) is None
    assert not sd.table_exists(spark, path)


def test_a_failing_job_leaves_the_table_alone(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    sd.overwrite_snapshot(frame(spark, FIRST), path)
    broken = frame(spark, SECOND).withColumn("v", F.raise_error(F.lit("boom")).cast("string"))
    with pytest.raises(Exception, match="boom"):
        sd.overwrite_snapshot(broken, path)
    assert rows(sd.read_table(spark, path)) == sorted(FIRST, key=repr)


def test_a_second_writer_loses_at_the_commit(spark, tmp_path):
    path = str(tmp_path / "t")
    sd.overwrite_snapshot(frame(spark, FIRST), path)
    commit = f"{path}/_commits/0000000001.json"
    with pytest.raises(FileExistsError):
        storage.publish_text(spark, commit, "{}")
    assert snapshot_of(spark, path).version == 1


def test_overwrite_may_read_itself_and_change_the_schema(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    sd.overwrite_snapshot(frame(spark, FIRST), path)
    sd.overwrite_snapshot(
        sd.read_table(spark, path).select("id", F.lit(1).alias("n")).filter("id < 3"), path
    )
    assert rows(sd.read_table(spark, path)) == [(1, 1), (2, 1)]
    sd.overwrite_snapshot(sd.read_table(spark, path).limit(0), path)
    assert sd.read_table(spark, path).columns == ["id", "n"]
    assert rows(sd.read_table(spark, path)) == []


def test_compact_and_expire(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    keys = ["id", "period"]
    sd.load_incremental(frame(spark, FIRST), path, keys, partition_by=["period"], null_safe=True)
    sd.load_incremental(frame(spark, SECOND), path, keys, null_safe=True)
    assert sd.expire_snapshots(spark, path, keep=1) == [1]
    assert rows(sd.read_table(spark, path)) == MERGED
    sd.compact_table(spark, path)
    sd.expire_snapshots(spark, path, keep=1)
    assert rows(sd.read_table(spark, path)) == MERGED
    assert len([n for n in storage.child_names(spark, path) if n.startswith("snapshot=")]) == 1


def test_wrong_use(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(ValueError, match="key columns"):
        sd.load_incremental(frame(spark, FIRST), path, ["id"], partition_by=["period"])
    with pytest.raises(ValueError, match="on_duplicate"):
        sd.load_incremental(frame(spark, FIRST), path, ["id"], on_duplicate="x")
    sd.overwrite_snapshot(frame(spark, FIRST), path)
    with pytest.raises(ValueError, match="columns differ"):
        sd.load_incremental(frame(spark, FIRST).drop("v"), path, ["id"])
    with pytest.raises(ValueError, match="taken"):
        sd.overwrite_snapshot(frame(spark, FIRST).withColumn("slice", F.lit(1)), path)


def test_plain_parquet_and_view(spark, tmp_path, rows):
    path = str(tmp_path / "p")
    sd.write_curated(frame(spark, FIRST), path)
    sd.write_curated(frame(spark, FIRST[:2]), path)
    assert sd.table_exists(spark, path) and not sd.table_exists(spark, f"{path}/none")
    sd.table_view(spark, path, "plain")
    assert spark.sql("SELECT max(id) FROM plain").first()[0] == 2
    assert rows(spark.sql(f"SELECT id FROM parquet.`{path}`")) == [(1,), (2,)]


def test_size_texts():
    assert storage.byte_count("10485760b") == 10485760
    assert storage.byte_count("10MB") == storage.byte_count("10m") == 10 << 20
    assert storage.byte_count("-1") == -1
    with pytest.raises(ValueError):
        storage.byte_count("many")
