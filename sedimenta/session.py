"""Session settings and the shared scratch area."""

from __future__ import annotations

import contextlib
import contextvars
import re
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

from sedimenta.sources import storage

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
}


def build_session(
    app: str = "sedimenta", master: str | None = None, **extra: str
) -> SparkSession:
    """A session with the engine's settings. ``extra`` keys use ``__`` for dots.

    The number of shuffle partitions is left to the cluster: AQE coalesces
    small ones, so a deployment sets ``spark.sql.shuffle.partitions`` high.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def use_engine_settings(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session someone else built."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_path(spark: SparkSession, label: str, near: str | None = None) -> str:
    """A fresh path in the shared scratch folder.

    The folder is the one the cluster names in ``spark.checkpoint.dir``. Where
    that is unset, ``near`` (a table's own folder, shared by nature) is used;
    a temporary folder only ever serves a local master.
    """
    context = spark.sparkContext
    root = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not root and near:
        root = f"{near.rstrip('/')}/_scratch"
    if not root and context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="sedimenta-"))
        root = context.getCheckpointDir()
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


_STAGED: contextvars.ContextVar[list | None] = contextvars.ContextVar("staged", default=None)


@contextlib.contextmanager
def freed_scratch() -> Iterator[None]:
    """What is staged inside is removed at the end, also after a failure.

    For jobs that write their result: a DataFrame that reads a staged table must
    not leave the block.
    """
    staged: list = []
    outer = _STAGED.set(staged)
    try:
        yield
    finally:
        _STAGED.reset(outer)
        for spark, path in staged:
            storage.remove_tree(spark, path)


@contextlib.contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of every query that runs inside are removed when it ends.

    Otherwise they stay until the driver happens to collect the plan that made them. For
    queries that write their result: a DataFrame that runs again shuffles again.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def stage(df: DataFrame, label: str, near: str | None = None) -> DataFrame:
    """Write ``df`` to the scratch folder and read it back.

    This cuts the lineage in a way that survives lost executors, and it gives
    Catalyst the true size of the result, so that a later join is broadcast
    only if the data really is small. Inside :func:`freed_scratch` the table is
    removed at the block's end; elsewhere it stays for the DataFrames that read it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label, near)
    staged = _STAGED.get()
    if staged is not None:
        staged.append((spark, path))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def planned_bytes(df: DataFrame) -> int:
    """Catalyst's own size estimate of ``df`` (no job is run)."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes()))


def fits_broadcast(df: DataFrame) -> bool:
    """Would Catalyst broadcast ``df`` by its size estimate?"""
    limit = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    return planned_bytes(df) <= storage.byte_count(limit)


def has_shuffle(df: DataFrame) -> bool:
    """Does the plan of ``df`` move rows between tasks, so that their order may vary?"""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return bool(re.search(r"(?<!Broadcast)(?<!Reused)Exchange ", plan))
