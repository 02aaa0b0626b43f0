"""Tables addressed by path: versioned Parquet snapshots, upserts, curated output.

A table folder holds ``snapshot=<id>/slice=<label>/*.parquet`` and, per version,
a small JSON file in ``_commits`` that says in which snapshots each slice's
current rows lie. A version exists once its commit file does, so readers never
see half a write, and a job that dies leaves the table as it was. There is one
writer per table at a time; a second one loses at the commit and must run again.

A slice is a set of keys: rows with the same values in ``partition_by`` (which
must be key columns), in the same of ``buckets`` hash buckets, or both. A batch is
written once, as a run on top of the slices it touches, and readers take each key
from the last run that holds it, or, where the table is kept ``latest_by`` a column, its
greatest row by that column from whichever run. Runs are put together as soon as what comes after
them is half their size, so what a small batch costs depends on the batch and on the
logarithm of the table. An upsert fails before the commit if it should have written a
slice that it has not read.

What has to be shuffled goes in waves of whole keys, most often of whole slices, and a wave's
shuffle files are freed before the next one. So the scratch space a load needs is that of one wave.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, replace
from datetime import date, datetime
from decimal import Decimal
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    IntegralType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from sedimenta.operators.lattice import common_schema, to_schema, widened
from sedimenta.operators.upsert import (
    any_null,
    duplicate_keys,
    latest_per_key,
    upsert,
    with_keys,
)
from sedimenta.session import (
    freed_scratch,
    freed_shuffles,
    has_shuffle,
    planned_bytes,
    stage,
)
from sedimenta.sources import storage

SLICE, SNAPSHOT = "slice", "snapshot"
WHOLE = "all"
#: A layer that is not so many times as large as all later ones is put together with them.
LAYER_STEP = 2
#: So many rows are shuffled at a time, if there are more.
WAVE_ROWS = 1 << 25
#: A batch that is planned as larger is staged, so that its latest rows are found in waves. A size
#: that Catalyst does not know is planned as ``UNKNOWN_BYTES`` or more.
STAGED_BYTES, UNKNOWN_BYTES = 256 << 20, 1 << 60


class Layer(NamedTuple):
    """The rows of a slice in one snapshot; how many there are is -1 if nobody counted."""

    at: str
    rows: int = -1


@dataclass(frozen=True)
class Snapshot:
    """A version. The layers of a slice are ordered from its oldest rows to its last run."""

    version: int
    schema: StructType
    partition_by: tuple[str, ...]
    bucket_by: tuple[str, ...]
    buckets: int
    slices: Mapping[str, tuple[Layer, ...]]
    keys: tuple[str, ...] = ()
    null_safe: bool = False
    latest_by: str | None = None

    def to_json(self) -> str:
        return json.dumps(
            {
                "version": self.version,
                "schema": self.schema.jsonValue(),
                "partition_by": self.partition_by,
                "bucket_by": self.bucket_by,
                "buckets": self.buckets,
                "slices": dict(self.slices),
                "keys": self.keys,
                "null_safe": self.null_safe,
                "latest_by": self.latest_by,
            }
        )

    @classmethod
    def from_json(cls, text: str) -> Snapshot:
        raw = json.loads(text)
        return cls(
            raw["version"],
            StructType.fromJson(raw["schema"]),
            tuple(raw["partition_by"]),
            tuple(raw["bucket_by"]),
            raw["buckets"],
            {
                name: (Layer(held),) if isinstance(held, str) else tuple(Layer(*x) for x in held)
                for name, held in raw["slices"].items()
            },
            tuple(raw.get("keys", ())),
            raw.get("null_safe", False),
            raw.get("latest_by"),
        )

    @property
    def sliced(self) -> bool:
        return bool(self.partition_by) or self.buckets > 1

    def slice_label(self) -> Column:
        """Which slice a row belongs to. Two keys sharing a label is harmless."""
        parts = []
        if self.partition_by:
            values = [F.coalesce(self._plain(c), F.lit("")) for c in self.partition_by]
            parts.append(F.concat(F.lit("p-"), F.concat_ws("/", *values)))
        if self.buckets > 1:
            bucket = F.pmod(F.xxhash64(*self.bucket_by), F.lit(self.buckets))
            parts.append(F.concat(F.lit("b-"), bucket.cast("string")))
        return F.concat_ws("/", *parts) if parts else F.lit(WHOLE)

    def _plain(self, column: str) -> Column:
        """The value as text; a timestamp's does not depend on the session's time zone."""
        if isinstance(self.schema[column].dataType, TimestampType):
            return F.unix_micros(column).cast("string")
        return F.col(column).cast("string")

    def partition_label(self, label: str) -> str:
        """The part of a slice's label that ``partition_by`` made."""
        return label.rpartition("/b-")[0] if self.buckets > 1 else label


# -- reading ---------------------------------------------------------------


def versions(spark: SparkSession, path: str) -> list[int]:
    names = storage.child_names(spark, f"{path}/_commits")
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[0] != ".")


def snapshot_of(spark: SparkSession, path: str, version: int | None = None) -> Snapshot | None:
    known = versions(spark, path)
    if not known:
        return None
    if version is None:
        version = known[-1]
    return Snapshot.from_json(storage.read_text(spark, _commit_file(path, version)))


def table_exists(spark: SparkSession, path: str) -> bool:
    """Is there a table at ``path``: a snapshot table, a Delta table, or plain Parquet?"""
    return bool(versions(spark, path)) or _other_format(spark, path)


def _other_format(spark: SparkSession, path: str) -> bool:
    """Data that is not a snapshot table. Folders of an unfinished first version are none."""
    names = storage.child_names(spark, path)
    return "_delta_log" in names or any(
        not n.startswith(("_", ".", "snapshot=")) for n in names
    )


def read_table(
    spark: SparkSession,
    path: str,
    version: int | None = None,
    only: Mapping[str, Sequence] | None = None,
) -> DataFrame:
    """The table at ``path``: a snapshot table, a Delta table, or plain Parquet.

    ``only`` limits a table sliced by ``partition_by`` to the given values before
    a single file is listed. It is a filter as well as a pruning.
    """
    snapshot = snapshot_of(spark, path, version)
    if snapshot is None:
        if storage.exists(spark, f"{path}/_delta_log"):
            reader = spark.read.format("delta")
            if version is not None:
                reader = reader.option("versionAsOf", version)
            df = reader.load(path)
        else:
            df = _plain_parquet(spark, path)
        return df.filter(_only_condition(only)) if only else df
    chosen = _named_slices(spark, snapshot, only or {})
    df = _rows(spark, path, snapshot, chosen).select(*snapshot.schema.names)
    return df.filter(_only_condition(only)) if only else df


def _plain_parquet(spark: SparkSession, path: str) -> DataFrame:
    """The root's own files; what a first version that was never committed left stays out."""
    names = storage.child_names(spark, path)
    if not any(n.startswith(f"{SNAPSHOT}=") for n in names):
        return spark.read.parquet(path)
    own = [f"{path}/{n}" for n in names if not n.startswith(("_", ".", f"{SNAPSHOT}="))]
    return spark.read.option("basePath", path).parquet(*own)


#: Values of these Python types are compared with columns of these types as they are.
_COMPARED_AS_TYPED: tuple[tuple[tuple[type, ...], tuple[type[DataType], ...]], ...] = (
    ((str,), (StringType,)),
    ((bool,), (BooleanType,)),
    ((int,), (IntegralType, DecimalType)),
    ((Decimal,), (DecimalType,)),
    ((datetime,), (TimestampType, TimestampNTZType)),
    ((date,), (DateType,)),
)


def _named_slices(
    spark: SparkSession, snapshot: Snapshot, only: Mapping[str, Sequence]
) -> Mapping[str, tuple[Layer, ...]]:
    """The slices that rows with the given values can lie in.

    The values become the column's type and get their labels as rows do. Where a value is
    compared with the column by another type (a number with text, anything with a
    fraction, whose zeros have two names) no slice is left out.
    """
    if len(snapshot.partition_by) != 1 or snapshot.partition_by[0] not in only:
        return snapshot.slices
    (column,) = snapshot.partition_by
    kind, values = snapshot.schema[column].dataType, list(only[column])
    for value in values:
        fits = [k for types, k in _COMPARED_AS_TYPED if type(value) in types]
        if value is not None and not (fits and isinstance(kind, fits[0])):
            return snapshot.slices
    given = [F.lit(v).try_cast(kind) for v in values if v is not None]
    rows = spark.range(1).select(F.explode(F.array(*given, F.lit(None).cast(kind))).alias(column))
    alone = replace(snapshot, buckets=1)
    labels = {
        label for value, label in rows.select(column, alone.slice_label()).collect() if value is not None
    }
    if None in values:
        labels |= {"p-"}
    return {
        name: layers
        for name, layers in snapshot.slices.items()
        if snapshot.partition_label(unquote(name.partition("=")[2])) in labels
    }


def table_view(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Make the table at ``path`` known to SQL under ``name``."""
    df = read_table(spark, path)
    df.createOrReplaceTempView(name)
    return df


def _only_condition(only: Mapping[str, Sequence]) -> Column:
    condition = F.lit(True)
    for column, values in only.items():
        present = [v for v in values if v is not None]
        test = F.col(column).isin(*present) if present else F.lit(False)
        if len(present) < len(values):
            test |= F.col(column).isNull()
        condition &= test
    return condition


def _scan(
    spark: SparkSession,
    path: str,
    snapshot: Snapshot,
    slices: Mapping[str, Sequence[Layer]],
    part: Column | None = None,
) -> DataFrame:
    """All rows of the given layers, with the snapshot that each one lies in."""
    schema = StructType([*snapshot.schema.fields]).add(SLICE, StringType()).add(SNAPSHOT, StringType())
    folders = [f"{path}/{SNAPSHOT}={x.at}/{name}" for name, layers in slices.items() for x in layers]
    if not folders:
        return spark.createDataFrame([], schema)
    df = spark.read.schema(schema).option("basePath", path).parquet(*folders)
    return df if part is None else df.filter(part)


def _rows(
    spark: SparkSession,
    path: str,
    snapshot: Snapshot,
    slices: Mapping[str, Sequence[Layer]],
    part: Column | None = None,
) -> DataFrame:
    """The rows of the given slices: of a key, those of the last layer that holds it, or
    the latest by the table's column for that. ``part`` picks keys."""
    names = snapshot.schema.names
    single = {name: layers for name, layers in slices.items() if len(layers) == 1}
    layered = {name: layers for name, layers in slices.items() if len(layers) > 1}
    alone = _scan(spark, path, snapshot, single, part).select(*names)
    if not layered:
        return alone
    oldest = _scan(spark, path, snapshot, {name: x[:1] for name, x in layered.items()}, part)
    runs = _scan(spark, path, snapshot, {name: x[1:] for name, x in layered.items()}, part)
    if snapshot.latest_by:
        # rows of the oldest layer take part in the choice only if a run holds their key
        met = with_keys(oldest, runs, snapshot.keys, snapshot.null_safe)
        rivals = runs.select(*names).unionByName(met.select(*names))
        runs = latest_per_key(
            rivals, snapshot.keys, snapshot.latest_by, null_safe=snapshot.null_safe
        )
    elif any(len(x) > 2 for x in layered.values()):
        runs = _last_run_per_key(runs, snapshot)
    merged = upsert(
        oldest.select(*names),
        runs.select(*names),
        snapshot.keys,
        null_safe=snapshot.null_safe,
        on_duplicate="allow",
    )
    return alone.unionByName(merged) if single else merged


def _last_run_per_key(runs: DataFrame, snapshot: Snapshot) -> DataFrame:
    """Rows of each key's last run; a NULL in a key matches nothing, unless it is said to."""
    keys = list(snapshot.keys)
    turn = F.substring_index(SNAPSHOT, "-", 1).cast("long")
    window = Window.partitionBy(F.xxhash64(*keys), *keys)

    def last(df: DataFrame) -> DataFrame:
        ranked = df.withColumn("_turn", turn).withColumn("_last", F.max("_turn").over(window))
        return ranked.filter("_turn = _last").select(*snapshot.schema.names)

    if snapshot.null_safe:
        return last(runs)
    loose = runs.filter(any_null(keys)).select(*snapshot.schema.names)
    return last(runs.filter(~any_null(keys))).unionByName(loose)


# -- writing ---------------------------------------------------------------


def write_curated(df: DataFrame, path: str) -> None:
    """Replace the Parquet folder at ``path``."""
    df.write.mode("overwrite").parquet(path)


def overwrite_snapshot(
    df: DataFrame,
    path: str,
    *,
    partition_by: Sequence[str] = (),
    buckets: int = 1,
    bucket_by: Sequence[str] = (),
) -> int:
    """Publish ``df`` as the table's new content and schema; returns the version.

    ``df`` may read the table it replaces.
    """
    spark = df.sparkSession
    known = versions(spark, path)
    snapshot = _layout(df, known[-1] + 1 if known else 1, partition_by, buckets, bucket_by)
    return _commit(spark, path, _write(spark, [df], path, snapshot))


def load_incremental(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    *,
    order_by: str | None = None,
    on_duplicate: str = "error",
    null_safe: bool = False,
    newer_only: str | None = None,
    latest_by: str | None = None,
    partition_by: Sequence[str] = (),
    buckets: int = 1,
    bucket_by: Sequence[str] = (),
    merge_schema: bool = False,
) -> int | None:
    """First run: write the table. Later runs: upsert ``df`` into it.

    Returns the new version, or None if the batch was empty. The batch is written
    once, sliced as the table is, and becomes a run on top of the slices it touches.
    Only where a slice's last layers are hardly larger than what the batch brings are
    these rewritten together with it. With ``newer_only`` the rows that are replaced
    have to be read, so all touched slices are.

    With ``latest_by`` a key's row is the greatest by that column of all that ever came
    (ties by the other columns, as ``latest_per_key`` has them), so the order in which
    batches arrive does not matter, and a late or repeated row changes nothing. Nothing
    is read to write a batch: readers choose among the runs. The first load with it
    takes the table as it is.

    A batch whose types differ from the table's is cast first; a value that does
    not survive the cast fails the load. With ``merge_schema`` columns (and fields of
    structs) that one side lacks are NULL there, and types become the narrowest that
    holds both; the table is rewritten only if one of its types has to change. A table
    of another format at ``path`` is taken over: its rows become the first version.
    """
    if on_duplicate not in ("error", "latest", "allow"):
        raise ValueError(f"unknown on_duplicate {on_duplicate!r}")
    spark = df.sparkSession
    keys, given = list(keys), df
    if not set(partition_by) <= set(keys) or not set(bucket_by) <= set(keys):
        raise ValueError("slices must be made from key columns")
    if latest_by:
        if newer_only or order_by or on_duplicate == "latest":
            raise ValueError("latest_by decides between rows of one key by itself")
        on_duplicate = "allow"
        df = latest_per_key(df, keys, latest_by, null_safe=null_safe)
    elif on_duplicate == "latest":
        if order_by is None:
            raise ValueError("on_duplicate='latest' needs order_by")
        df = latest_per_key(df, keys, order_by, null_safe=null_safe)
    current = snapshot_of(spark, path)
    if current is None and _other_format(spark, path):
        overwrite_snapshot(
            read_table(spark, path),
            path,
            partition_by=partition_by,
            buckets=buckets,
            bucket_by=bucket_by or keys,
        )
        current = snapshot_of(spark, path)
    if current is None:
        layout = _layout(df, 1, partition_by, buckets, bucket_by or keys)
    else:
        if merge_schema:
            current = _with_schema(spark, path, current, common_schema(current.schema, df.schema))
            df = to_schema(df, current.schema)
        if sorted(current.schema.names) != sorted(df.columns):
            raise ValueError(f"batch columns differ from those of {path}")
        if not set(current.partition_by) | set(current.bucket_by) <= set(keys):
            raise ValueError(f"the slices of {path} are not made from the key columns")
        rule = (list(current.keys), current.null_safe, current.latest_by)
        if rule != (keys, null_safe, latest_by) and any(
            len(layers) > 1 for layers in current.slices.values()
        ):
            compact_table(spark, path)
            current = snapshot_of(spark, path)
        df = _as_typed(df, current.schema)
        layout = replace(current, slices={}, version=current.version + 1)
    layout = replace(layout, keys=tuple(keys), null_safe=null_safe, latest_by=latest_by)
    made: list[str] = []
    try:
        parts: Iterable[DataFrame] = [df.select(*layout.schema.names)]
        latest = latest_by or (order_by if on_duplicate == "latest" else None)
        if latest and STAGED_BYTES <= planned_bytes(given) < UNKNOWN_BYTES:
            waves = _latest_in_waves(given, path, layout, latest)
            parts = (_as_stored(x, layout, current, merge_schema) for x in waves)
        with freed_scratch():
            staged = _write(spark, parts, path, layout, made, counted=True)
        batch = _rows(spark, path, staged, staged.slices)
        if on_duplicate == "error":
            _fail_on_duplicates(batch, keys, null_safe)
        if not staged.slices:
            _remove_snapshots(spark, path, made)
            return None
        if current is None:
            return _commit(spark, path, staged)
        held = {name: current.slices.get(name, ()) for name in staged.slices}
        first = {
            name: 0 if newer_only else _first_to_merge(layers, staged.slices[name][0].rows)
            for name, layers in held.items()
        }
        joined = {name: held[name][first[name] :] for name in held if held[name][first[name] :]}
        slices = {**current.slices, **{name: held[name] + staged.slices[name] for name in held}}
        if joined:
            both = {name: layers + staged.slices[name] for name, layers in joined.items()}

            def merged() -> Iterator[DataFrame]:
                counts = _row_counts(spark, path, layout, both)
                for names, part in _waves(counts, keys):
                    if not newer_only:
                        yield _rows(spark, path, layout, {name: both[name] for name in names}, part)
                        continue
                    held_by = replace(current, keys=layout.keys)
                    before = _rows(spark, path, held_by, {name: joined[name] for name in names}, part)
                    met = _rows(spark, path, staged, {name: staged.slices[name] for name in names}, part)
                    yield upsert(
                        before, met, keys, null_safe=null_safe, on_duplicate="allow", newer_only=newer_only
                    )

            written = _write(spark, merged(), path, layout, made, gathered=True, counted=True)
            strays = set(written.slices) - set(joined)
            if strays:
                raise RuntimeError(f"the upsert would replace slices it has not read: {strays}")
            slices |= {name: held[name][: first[name]] + written.slices[name] for name in joined}
        version = _commit(spark, path, replace(layout, slices=slices))
    except BaseException:
        _remove_snapshots(spark, path, made)
        raise
    if set(joined) == set(staged.slices):  # nothing reads the batch as it was written
        _remove_snapshots(spark, path, made[:1])
    return version


def _first_to_merge(layers: Sequence[Layer], rows: int) -> int:
    """From which layer on a slice is rewritten with ``rows`` new ones: those that are less
    than ``LAYER_STEP`` times what comes after them. So a slice has no more layers than
    its rows are powers of that step, and a row is rewritten about as often."""
    first = len(layers)
    while first and layers[first - 1].rows <= LAYER_STEP * rows:
        first -= 1
        rows += max(layers[first].rows, 0)
    return first


def _latest_in_waves(
    df: DataFrame, path: str, layout: Snapshot, order_by: str
) -> Iterator[DataFrame]:
    """``latest_per_key`` of a large batch. The batch is staged as it comes, without a shuffle,
    and each wave picks its slices from there; a slice's label is a function of the key."""
    with freed_shuffles(df.sparkSession):
        batch = stage(df, "batch", near=path)
    label = replace(layout, schema=df.schema).slice_label()
    rows = dict(batch.groupBy(label.alias(SLICE)).count().collect())
    for names, part in _waves(rows, layout.keys):
        some = batch if len(names) == len(rows) else batch.filter(label.isin(*names))
        some = some if part is None else some.filter(part)
        yield latest_per_key(some, layout.keys, order_by, null_safe=layout.null_safe)


def _waves(
    rows: Mapping[str, int], keys: Sequence[str]
) -> Iterator[tuple[list[str], Column | None]]:
    """Slices put together up to ``WAVE_ROWS``; one with more rows is alone and comes in parts,
    by a hash that is neither that of the buckets nor that of a shuffle."""
    groups: list[list[str]] = []
    held = 0
    for name, count in sorted(rows.items()):
        if not groups or held + count > WAVE_ROWS:
            groups.append([])
            held = 0
        groups[-1].append(name)
        held += count
    for names in groups:
        parts = max(1, -(-sum(rows[name] for name in names) // WAVE_ROWS))
        turn = F.pmod(F.xxhash64(F.lit(SLICE), *keys), F.lit(parts))
        for i in range(parts):
            yield names, (turn == i if parts > 1 else None)


def _row_counts(
    spark: SparkSession, path: str, layout: Snapshot, slices: Mapping[str, Sequence[Layer]]
) -> dict[str, int]:
    """How many rows the layers of each slice have; those that nobody counted are counted."""
    unknown = {n: [x for x in layers if x.rows < 0] for n, layers in slices.items()}
    unknown = {n: layers for n, layers in unknown.items() if layers}
    found: dict[str, int] = {}
    if unknown:
        found = dict(_scan(spark, path, layout, unknown).groupBy(SLICE).count().collect())
    return {
        n: sum(max(x.rows, 0) for x in layers) + found.get(unquote(n.partition("=")[2]), 0)
        for n, layers in slices.items()
    }


def _as_stored(
    df: DataFrame, layout: Snapshot, current: Snapshot | None, merge_schema: bool
) -> DataFrame:
    """Rows of a batch with the table's columns and types."""
    if current is not None:
        df = _as_typed(to_schema(df, current.schema) if merge_schema else df, current.schema)
    return df.select(*layout.schema.names)


def _with_schema(
    spark: SparkSession, path: str, current: Snapshot, schema: StructType
) -> Snapshot:
    """The table's newest version under a schema that also holds a batch's rows."""
    if widened(current.schema, schema):
        rows = to_schema(_rows(spark, path, current, current.slices), schema)
        layout = replace(current, schema=schema, slices={}, version=current.version + 1)
        _commit(spark, path, _write(spark, [rows], path, layout))
        return snapshot_of(spark, path)
    return replace(current, schema=schema)


def _as_typed(df: DataFrame, schema: StructType) -> DataFrame:
    """``df`` with the table's types. The job fails on a value that a cast would change."""
    columns = []
    for field in schema.fields:
        given, column = df.schema[field.name].dataType, F.col(field.name)
        if given.simpleString() == field.dataType.simpleString():
            columns.append(column)
            continue
        cast = column.try_cast(field.dataType)
        changed = column.isNotNull() & ~cast.try_cast(given).eqNullSafe(column)
        message = F.concat(
            F.lit(f"column {field.name} of the batch does not fit {field.dataType.simpleString()}: "),
            column.cast("string"),
        )
        lost = F.raise_error(message).cast(field.dataType)
        columns.append(F.when(changed, lost).otherwise(cast).alias(field.name))
    return df.select(*columns)


def compact_table(spark: SparkSession, path: str) -> int:
    """Rewrite the table in its own layout, joining up the runs and small files of past batches."""
    current = snapshot_of(spark, path)
    df = _rows(spark, path, current, current.slices)
    layout = replace(current, slices={}, version=current.version + 1)
    return _commit(spark, path, _write(spark, [df], path, layout, counted=True))


def expire_snapshots(spark: SparkSession, path: str, keep: int = 2) -> list[int]:
    """Forget all but the newest ``keep`` versions and free their files."""
    known = versions(spark, path)
    old, kept = known[:-keep], known[-keep:]
    used = {
        (x.at, name)
        for v in kept
        for name, layers in snapshot_of(spark, path, v).slices.items()
        for x in layers
    }
    for version in old:
        storage.remove_tree(spark, _commit_file(path, version))
    for folder in storage.child_names(spark, path):
        at = folder.partition(f"{SNAPSHOT}=")[2]
        if not at or int(at.partition("-")[0]) > known[-1]:
            continue  # not a snapshot, or one that is being written
        names = storage.child_names(spark, f"{path}/{folder}")
        if not any((at, name) in used for name in names):
            storage.remove_tree(spark, f"{path}/{folder}")
            continue
        for name in names:
            if "=" in name and (at, name) not in used:
                storage.remove_tree(spark, f"{path}/{folder}/{name}")
    return old


def _fail_on_duplicates(batch: DataFrame, keys: list[str], null_safe: bool) -> None:
    example = duplicate_keys(batch, keys, null_safe=null_safe).head(1)
    if example:
        shown = ", ".join(f"{k}={example[0][k]!r}" for k in keys)
        raise ValueError(f"duplicate key in batch: {shown}")


def _layout(df, version, partition_by, buckets, bucket_by) -> Snapshot:
    if buckets > 1 and not bucket_by:
        raise ValueError("buckets need bucket_by")
    for name in (SLICE, SNAPSHOT):
        if name in df.columns:
            raise ValueError(f"the column name {name!r} is taken by the table layout")
    return Snapshot(
        version, df.schema, tuple(partition_by), tuple(bucket_by), int(buckets), {}
    )


def _write(
    spark: SparkSession,
    parts: Iterable[DataFrame],
    path: str,
    snapshot: Snapshot,
    made: list[str] | None = None,
    gathered: bool = False,
    counted: bool = False,
) -> Snapshot:
    """Write a version's files, one part after the other; ``made`` learns the snapshot's name
    before it is written.

    The rebalance brings a slice's rows together; AQE then splits a large slice
    over many tasks. It is left out where the rows come ``gathered``, straight
    from a scan of files that each belong to one slice. What a part shuffled is
    freed once it is written. Rows are counted from the footers of the files.
    """
    at = f"{snapshot.version}-{uuid.uuid4().hex[:12]}"
    if made is not None:
        made.append(at)
    folder = f"{path}/{SNAPSHOT}={at}"
    for df in parts:
        labelled = df.withColumn(SLICE, snapshot.slice_label())
        if snapshot.sliced and not (gathered and not has_shuffle(df)):
            labelled = labelled.hint("rebalance", SLICE)
        with freed_shuffles(spark):
            labelled.write.mode("append").partitionBy(SLICE).parquet(folder)
    names = [n for n in storage.child_names(spark, folder) if "=" in n]
    rows: dict[str, int] = {}
    if counted and names:
        files = spark.read.schema(StructType().add(SLICE, StringType())).parquet(folder)
        rows = dict(files.groupBy(SLICE).count().collect())
    layers = {n: Layer(at, rows.get(unquote(n.partition("=")[2]), -1)) for n in names}
    return replace(snapshot, slices={name: (layer,) for name, layer in layers.items()})


def _remove_snapshots(spark: SparkSession, path: str, made: Sequence[str]) -> None:
    for at in made:
        storage.remove_tree(spark, f"{path}/{SNAPSHOT}={at}")


def _commit(spark: SparkSession, path: str, snapshot: Snapshot) -> int:
    storage.publish_text(spark, _commit_file(path, snapshot.version), snapshot.to_json())
    return snapshot.version


def _commit_file(path: str, version: int) -> str:
    return f"{path}/_commits/{version:010d}.json"
