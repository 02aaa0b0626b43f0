"""Runs on top of slices: a poll costs its batch, readers see the last row of each key."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import sedimenta as sd
from sedimenta.sources import tables
from sedimenta.sources.tables import snapshot_of, versions

DDL = "id LONG, part STRING, v LONG"


def frame(spark, data):
    return spark.createDataFrame(data, DDL)


def rows_written(spark, path, version):
    """Rows of the files that a version brought, from the folders that its name begins."""
    folders = [str(p) for p in Path(path).glob(f"snapshot={version}-*")]
    return sum(spark.read.parquet(f).count() for f in folders)


def test_a_poll_costs_its_batch_not_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    big = spark.range(200_000).select("id", F.lit("p").alias("part"), F.lit(0).cast("long").alias("v"))
    sd.load_incremental(big, path, ["id"], buckets=64)
    written = []
    for poll in range(1, 13):
        batch = big.filter(F.col("id") % 401 == poll).withColumn("v", F.lit(poll).cast("long"))
        sd.load_incremental(batch, path, ["id"])
        written.append(rows_written(spark, path, poll + 1))
    # 500 rows a poll, of 200,000; runs are rewritten together with runs
    assert max(written) <= 12 * 500 and sum(written) <= 12 * 500 * 5, written
    layers = [len(x) for x in snapshot_of(spark, path).slices.values()]
    assert len(layers) == 64 and max(layers) <= 5
    got = sd.read_table(spark, path).groupBy("v").count().collect()
    assert {r["v"]: r["count"] for r in got if r["v"]} == {
        n: big.filter(F.col("id") % 401 == n).count() for n in range(1, 13)
    }
    assert sd.read_table(spark, path).count() == 200_000


@pytest.mark.parametrize("null_safe", [True, False])
@pytest.mark.parametrize("layout", [{}, {"partition_by": ["part"]}, {"partition_by": ["part"], "buckets": 2, "bucket_by": ["id"]}])
def test_many_polls_are_as_one_dictionary(spark, tmp_path, rows, null_safe, layout):
    """Random batches of different sizes, with a NULL in either key, compacted half-way."""
    rng = random.Random(4)
    path = str(tmp_path / "t")
    want, loose = {}, []
    for poll in range(9):
        batch = {}
        for _ in range(rng.choice([1, 3, 10, 60])):
            key = (rng.choice([None, *range(30)]), rng.choice([None, "", "a", "b"]))
            batch[key] = (*key, poll)
        sd.load_incremental(frame(spark, list(batch.values())), path, ["id", "part"], null_safe=null_safe, **layout)
        whole = {k: r for k, r in batch.items() if null_safe or None not in k}
        want |= whole
        loose += [r for k, r in batch.items() if k not in whole]
        if poll == 5:
            sd.compact_table(spark, path)
            sd.expire_snapshots(spark, path, keep=1)
    assert rows(sd.read_table(spark, path)) == sorted([*want.values(), *loose], key=repr)
    for part in ("", "a", None):
        got = rows(sd.read_table(spark, path, only={"part": [part]}))
        assert got == sorted((r for r in [*want.values(), *loose] if r[1] == part), key=repr)


def test_old_versions_stay_readable_and_expire(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    for poll in range(6):
        sd.load_incremental(frame(spark, [(i, "p", poll) for i in range(poll, 20)]), path, ["id"], buckets=2)
    for version in range(1, 7):
        got = {r["id"]: r["v"] for r in sd.read_table(spark, path, version=version).collect()}
        assert got == {i: min(i, version - 1) for i in range(20)}
    assert sd.expire_snapshots(spark, path, keep=2) == [1, 2, 3, 4]
    assert {r["id"]: r["v"] for r in sd.read_table(spark, path).collect()} == {i: min(i, 5) for i in range(20)}


def test_newer_only_looks_through_the_runs(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    sd.load_incremental(frame(spark, [(i, "p", 5) for i in range(100)]), path, ["id"])
    sd.load_incremental(frame(spark, [(1, "p", 9), (2, "p", 1)]), path, ["id"])
    sd.load_incremental(frame(spark, [(1, "q", 7), (2, "q", 7), (3, "q", 4)]), path, ["id"], newer_only="v")
    got = {r["id"]: (r["part"], r["v"]) for r in sd.read_table(spark, path).filter("id < 5").collect()}
    assert got == {0: ("p", 5), 1: ("p", 9), 2: ("q", 7), 3: ("p", 5), 4: ("p", 5)}


def test_other_keys_compact_first(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    sd.load_incremental(frame(spark, [(i, "p", 0) for i in range(50)]), path, ["id"])
    sd.load_incremental(frame(spark, [(1, "p", 1)]), path, ["id"])
    sd.load_incremental(frame(spark, [(1, "q", 2), (2, "p", 2)]), path, ["id", "part"])
    got = rows(sd.read_table(spark, path).filter("v > 0"))
    assert got == [(1, "p", 1), (1, "q", 2), (2, "p", 2)]
    assert sd.read_table(spark, path).count() == 51


def test_a_load_that_dies_leaves_no_files(spark, tmp_path, rows, monkeypatch):
    path = str(tmp_path / "t")
    sd.load_incremental(frame(spark, [(1, "p", 0)]), path, ["id"])
    before = sorted(p.name for p in Path(path).iterdir())
    monkeypatch.setattr(tables, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        sd.load_incremental(frame(spark, [(1, "p", 1)]), path, ["id"])
    assert sorted(p.name for p in Path(path).iterdir()) == before
    monkeypatch.undo()
    sd.load_incremental(frame(spark, [(1, "p", 2)]), path, ["id"])
    assert rows(sd.read_table(spark, path)) == [(1, "p", 2)]


def test_a_take_over_that_dies_leaves_plain_parquet(spark, tmp_path, rows, monkeypatch):
    """Also one that left its files behind, as a killed driver would."""
    path = str(tmp_path / "t")
    frame(spark, [(1, "p", 0), (2, "p", 0)]).write.parquet(path)
    monkeypatch.setattr(tables, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        sd.load_incremental(frame(spark, [(1, "p", 1)]), path, ["id"], buckets=4)
    assert any(p.name.startswith("snapshot=") for p in Path(path).iterdir())
    assert rows(sd.read_table(spark, path)) == [(1, "p", 0), (2, "p", 0)]
    assert sd.read_table(spark, path).columns == ["id", "part", "v"]
    monkeypatch.undo()
    sd.load_incremental(frame(spark, [(1, "p", 1)]), path, ["id"], buckets=4)
    assert rows(sd.read_table(spark, path)) == [(1, "p", 1), (2, "p", 0)]
    assert versions(spark, path) == [1, 2]


@pytest.mark.parametrize(
    "kind,stored,asked",
    [
        ("decimal(10,2)", ["1", "1.5"], [1]),
        ("double", ["1", "-0.0", "0.0"], [1, 0]),
        ("string", ["01", "1", "x"], [1]),
        ("string", ["01", "1", "x"], ["1"]),
        ("int", ["1", "2"], [1, 2**40]),
        ("boolean", ["true", "false"], [True]),
        ("date", ["2024-01-01", "2024-01-02"], ["2024-01-01"]),
        ("bigint", ["1", "2"], [1, None]),
    ],
)
def test_only_is_the_filter_it_says(spark, tmp_path, kind, stored, asked):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*stored, None])], "id long, k string")
    df = df.filter("k <> 'x' OR k IS NULL") if asked == [1] else df
    df = df.select("id", F.col("k").cast(kind).alias("k"))
    sd.load_incremental(df, path, ["id", "k"], partition_by=["k"], null_safe=True)
    got = sorted(r["id"] for r in sd.read_table(spark, path, only={"k": asked}).collect())
    present = [v for v in asked if v is not None]
    test = F.col("k").isin(*present) | (F.col("k").isNull() if None in asked else F.lit(False))
    assert got == sorted(r["id"] for r in df.filter(test).collect()) != []
