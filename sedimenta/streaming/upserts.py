"""The incremental loads as a stream over the landing folder."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from sedimenta.operators.difference import row_digest
from sedimenta.plans.enrichment import JOBS, enrich, load
from sedimenta.sources import storage
from sedimenta.sources.landing import read_landing
from sedimenta.sources.tables import load_incremental, read_table, table_exists

#: Columns that ``stream_latest`` adds while rows pass through its state.
ARRIVED, DIGEST = "_arrived", "_digest"


def stream_upsert(
    stream: DataFrame,
    target: str,
    keys: Sequence[str],
    checkpoint: str,
    *,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    available_now: bool = True,
    **options,
) -> StreamingQuery:
    """Upsert every micro-batch of ``stream`` into the table at ``target``.

    The state is the table itself. A batch that is replayed after a failure
    finds its own rows there and replaces them by themselves, so the outcome is
    the same; ``null_safe`` keys are needed for that where a key can be NULL.
    """
    options.setdefault("null_safe", True)

    def merge(batch: DataFrame, _: int) -> None:
        rows = transform(batch) if transform else batch
        load_incremental(rows, target, keys, **options)

    return _start(stream, merge, checkpoint, available_now)


def stream_latest(
    stream: DataFrame,
    target: str,
    keys: Sequence[str],
    checkpoint: str,
    *,
    version: str,
    remember: str = "1 day",
    available_now: bool = True,
    **options,
) -> StreamingQuery:
    """Keep the latest row of every key, by ``version``, from polls that overlap.

    Polls ask for everything that changed since some time ago, so most of what they bring
    was there before. A row whose equal (in all columns) arrived less than ``remember``
    ago is dropped by a digest of 128 bits in the stream's state, before it costs anything
    further; a poll that brings nothing new writes nothing. The state holds the digests of
    one to two such spans and no more. What it no longer knows goes on to the table, which
    is kept ``latest_by`` the version: the outcome is that of one batch with all rows,
    whatever the order, delay and repetition of their arrival.

    The watermark follows the time of arrival. Were it to follow ``version``, Spark would
    drop rows that come later than ``remember``; so none is dropped but repeats. Rows with
    a NULL version yield to others; NULL keys match each other (``null_safe=False``: they
    match nothing). Equal rows meet in one task of a poll.
    """
    taken = {c.lower() for c in stream.columns} & {ARRIVED, DIGEST}
    if taken:
        raise ValueError(f"columns of the stream's own: {', '.join(sorted(taken))}")
    options.setdefault("null_safe", True)
    marked = stream.withColumns(
        {ARRIVED: F.current_timestamp(), DIGEST: row_digest(stream, stream.columns)}
    )
    once = marked.withWatermark(ARRIVED, remember).dropDuplicatesWithinWatermark([DIGEST])

    def merge(batch: DataFrame, _: int) -> None:
        if options["null_safe"]:
            load_incremental(batch, target, keys, latest_by=version, **options)
            return
        # rows with and without a whole key go their own ways: the state is gone through once
        held = batch.persist()
        try:
            load_incremental(held, target, keys, latest_by=version, **options)
        finally:
            held.unpersist()

    return _start(once.drop(ARRIVED, DIGEST), merge, checkpoint, available_now)


def stream_enrichment(
    spark: SparkSession,
    name: str,
    landing: str,
    target: str,
    checkpoint: str,
    *,
    schema: StructType | None = None,
    max_files: int | None = None,
    available_now: bool = True,
    **options,
) -> StreamingQuery:
    """Follow a landing folder with one of the merging enrichment jobs.

    The stream takes every file name once, so each poll must land under names of its
    own (``poll=`` of ``plan_extract``). A file that was replaced since it was taken
    makes the start fail: which files were taken, and as of when, is kept beside the
    checkpoint.
    """
    job = JOBS[name]
    if not job.keys:
        raise ValueError(f"{name} replaces its table and cannot follow a stream")
    ledger = f"{checkpoint.rstrip('/')}-files"
    _fail_on_replaced(spark, landing, ledger)
    documents = read_landing(
        spark,
        landing,
        schema or job.schema(),
        streaming=True,
        max_files=max_files,
        with_file=True,
    )

    def merge(batch: DataFrame, _: int) -> None:
        if not available_now:
            _fail_on_replaced(spark, landing, ledger)
        rows = enrich(job, batch, on_duplicate=options.get("on_duplicate"))
        load(job, rows, target, **options)
        load_incremental(batch.select(*_FILE).distinct(), ledger, _FILE[:1], on_duplicate="allow")

    return _start(documents, merge, checkpoint, available_now)


_FILE = ("file_path", "file_modification_time")


def _fail_on_replaced(spark: SparkSession, landing: str, ledger: str) -> None:
    """Compare the folder's listing with the ledger, a keyed table with a row for each file.

    A file that replaced another is newer than the oldest one taken; the rest of the
    listing does not reach the join.
    """
    if not table_exists(spark, ledger) or not storage.exists(spark, landing):
        return
    taken = read_table(spark, ledger).withColumnRenamed("file_modification_time", "taken")
    # only the listing is read, not the files
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(landing)
    now = files.select(*[f"_metadata.{c}" for c in _FILE])
    oldest = taken.agg(F.min("taken"))
    recent = now.filter(F.col("file_modification_time") > oldest.scalar())
    changed = recent.join(taken, "file_path").filter("file_modification_time > taken")
    example = changed.select("file_path").head(1)
    if example:
        raise ValueError(f"replaced under its own name since the stream took it: {example[0][0]}")


def _start(stream, merge, checkpoint, available_now) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
