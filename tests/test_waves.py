"""Loads in waves: the same rows, and no more scratch space than one wave needs."""

import gzip
import random
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import sedimenta as sd
from sedimenta.plans.showcase import land_documents
from sedimenta.sources import tables
from sedimenta.sources.tables import snapshot_of

DDL = "id LONG, part STRING, at LONG, v LONG"


def frame(spark, data):
    return spark.createDataFrame(data, DDL)


def shuffle_files(spark):
    """Files of shuffles on this machine's scratch disk."""
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for d in manager.localDirsString() for f in Path(d).rglob("shuffle_*.data")}


@pytest.mark.parametrize(
    "rule, null_safe, layout",
    [
        ("latest", True, {"partition_by": ["part"], "buckets": 2, "bucket_by": ["id"]}),
        ("newer_only", False, {"partition_by": ["part"]}),
        ("latest_by", True, {}),
    ],
)
def test_waves_give_the_same_rows(spark, tmp_path, rows, monkeypatch, rule, null_safe, layout):
    """Random batches with repeated and NULL keys, whole and in waves of at most fifty rows."""
    options = {
        "latest": {"order_by": "at", "on_duplicate": "latest"},
        "newer_only": {"order_by": "at", "on_duplicate": "latest", "newer_only": "at"},
        "latest_by": {"latest_by": "at"},
    }[rule]
    rng = random.Random(7)
    batches = [
        [
            (rng.choice([None, *range(60)]), rng.choice([None, "", "a", "b"]), rng.randrange(5), rng.randrange(3))
            for _ in range(n)
        ]
        for n in (150, 100)
    ]
    got = []
    for name, most, staged in (("whole", 1 << 25, 1 << 60), ("waves", 50, 0)):
        monkeypatch.setattr(tables, "WAVE_ROWS", most)
        monkeypatch.setattr(tables, "STAGED_BYTES", staged)
        path = str(tmp_path / name)
        for batch in batches:
            df = frame(spark, batch)
            sd.load_incremental(df, path, ["id", "part"], null_safe=null_safe, **options, **layout)
        got.append(rows(sd.read_table(spark, path)))
    assert got[0] == got[1] and len(got[0]) > 60


def test_a_wave_holds_so_many_rows(spark, tmp_path, monkeypatch):
    """Small slices go together, a large one is cut by its keys, and every row is counted."""
    monkeypatch.setattr(tables, "WAVE_ROWS", 100)
    waves = list(tables._waves({"a": 60, "b": 40, "c": 1, "d": 250}, ["id"]))
    assert [names for names, _ in waves] == [["a", "b"], ["c"], ["d"], ["d"], ["d"]]
    assert [part is None for _, part in waves] == [True, True, False, False, False]
    shares = [spark.range(3000).filter(part).count() for _, part in waves[2:]]
    assert sum(shares) == 3000 and min(shares) > 800

    monkeypatch.setattr(tables, "STAGED_BYTES", 0)
    path, largest = str(tmp_path / "t"), []
    latest = tables.latest_per_key
    monkeypatch.setattr(
        tables, "latest_per_key", lambda df, *a, **o: largest.append(df.count()) or latest(df, *a, **o)
    )
    df = spark.range(400).select("id", F.lit(1).cast("long").alias("at"))
    sd.load_incremental(df, path, ["id"], order_by="at", on_duplicate="latest", buckets=8)
    assert largest[0] == 400 and max(largest[1:]) <= 100 and sum(largest[1:]) == 400
    assert sum(x.rows for layers in snapshot_of(spark, path).slices.values() for x in layers) == 400


def test_a_batch_of_other_types_goes_in_waves(spark, tmp_path, rows, monkeypatch):
    path = str(tmp_path / "t")
    options = {"order_by": "at", "on_duplicate": "latest", "buckets": 4, "bucket_by": ["id"]}
    sd.load_incremental(frame(spark, [(i, "p", 1, 0) for i in range(50)]), path, ["id"], **options)
    monkeypatch.setattr(tables, "WAVE_ROWS", 30)
    monkeypatch.setattr(tables, "STAGED_BYTES", 0)
    narrow = frame(spark, [(i, "p", at, at) for i in range(25, 75) for at in (2, 3)]).withColumn("id", F.col("id").cast("int"))
    sd.load_incremental(narrow, path, ["id"], **options)
    want = [(i, "p", 1, 0) for i in range(25)] + [(i, "p", 3, 3) for i in range(25, 75)]
    assert rows(sd.read_table(spark, path)) == sorted(want, key=repr)


def test_a_load_frees_what_it_shuffled(spark, tmp_path):
    before = shuffle_files(spark)
    df = frame(spark, [(i % 900, "p", i, 0) for i in range(1000)])
    for _ in range(2):
        sd.load_incremental(df, str(tmp_path / "t"), ["id"], order_by="at", on_duplicate="latest", buckets=8)
    # the small queries that count rows may leave theirs
    until, left = time.time() + 20, 5_000
    while left >= 5_000 and time.time() < until:
        time.sleep(0.2)
        left = sum(f.stat().st_size for f in shuffle_files(spark) - before if f.exists())
    assert left < 5_000, left
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"


def test_landed_documents_are_packed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("sedimenta.plans.showcase.LANDED_DOCUMENTS", 40)
    record = F.array(F.struct(F.col("id").cast("string").alias("id"), F.lit("x" * 20).alias("dataDimensionType")))
    land_documents(str(tmp_path), spark.range(100).coalesce(1).select(record.alias("categories")), "c")
    files = [f for f in (tmp_path / "c").iterdir() if f.name.startswith("part-")]
    assert all(f.name.endswith(".json.gz") for f in files)
    assert sorted(len(gzip.open(f).readlines()) for f in files) == [20, 40, 40]
    landed = sd.read_landing(spark, str(tmp_path / "c"), "categories ARRAY<STRUCT<id: STRING>>")
    assert {r[0][0][0] for r in landed.collect()} == {str(i) for i in range(100)}
