"""What changed between two snapshots of a table, and tables that remember what is gone.

The two are compared by key and by a digest of the other columns, so that of a row only
key and digest are shuffled; the values of the rows that changed are fetched afterwards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from sedimenta.operators.upsert import duplicate_keys
from sedimenta.session import stage

ADDED, CHANGED, REMOVED, SAME = "added", "changed", "removed", "same"
CHANGE = "change"


def row_digest(df: DataFrame, columns: Sequence[str]) -> Column:
    """128 bits of the columns' values, as text; equal rows, and in effect only they, share it.

    NULL differs from every value, maps are compared without regard to the order of
    their entries, and 0.0 equals -0.0 as it does in a comparison.
    """
    values = [_plain(F.col(f"`{c}`"), df.schema[c].dataType) for c in columns]
    whole = F.to_json(F.struct(*[v.alias(f"c{i}") for i, v in enumerate(values)]), _EXACT)
    return F.left(F.sha2(whole, 256), F.lit(32))


# All that a value holds: NULL fields, and times to the microsecond.
_EXACT = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def _plain(value: Column, kind: DataType) -> Column:
    name = kind.typeName()
    if name in ("double", "float"):
        return F.when(value == 0, F.lit(0).cast(kind)).otherwise(value)
    if name == "map":
        return F.array_sort(F.map_entries(value))
    if isinstance(kind, ArrayType):
        return F.transform(value, lambda x: _plain(x, kind.elementType))
    if isinstance(kind, StructType):
        fields = [_plain(value.getField(f.name), f.dataType).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    return value


def snapshot_difference(
    old: DataFrame, new: DataFrame, keys: Sequence[str], *, with_same: bool = False
) -> DataFrame:
    """The rows that differ: all columns of ``new``, and ``change``.

    A row is ``added`` or ``changed`` (with its new values) or ``removed`` (with its
    last ones); ``with_same`` also lists the others. NULL parts of a key match each other.
    Both sides must have unique keys: a key that occurs twice fails the job, as there
    would be no saying which row became which (:func:`row_difference` needs no keys).
    Columns are matched by name and must be the same on both sides.

    Only keys and digests meet, shuffled by the key's hash. As a key is unique there is no
    hot one; a NULL key is one row at most on either side.
    """
    keys = list(keys)
    if sorted(old.columns) != sorted(new.columns):
        raise ValueError("both snapshots must have the same columns")
    if CHANGE in new.columns:
        raise ValueError(f"the column name {CHANGE!r} is taken")
    columns = new.columns
    rest = [c for c in columns if c not in keys]
    for name, side in (("old", old), ("new", new)):
        twice = duplicate_keys(side, keys).head(1)
        if twice:
            shown = ", ".join(f"{k}={twice[0][k]!r}" for k in keys)
            raise ValueError(f"duplicate key in the {name} snapshot: {shown}")

    def digested(df: DataFrame, side: str) -> DataFrame:
        key = F.struct(*[F.col(f"`{k}`") for k in keys])
        digest = row_digest(df, rest) if rest else F.lit("")
        return df.select(key.alias(f"key_{side}"), digest.alias(f"digest_{side}"))

    a, b = digested(old, "old"), digested(new, "new")
    met = a.join(b, F.col("key_old").eqNullSafe(F.col("key_new")), "full")
    kind = (
        F.when(F.col("digest_old").isNull(), ADDED)
        .when(F.col("digest_new").isNull(), REMOVED)
        .when(F.col("digest_old") != F.col("digest_new"), CHANGED)
        .otherwise(SAME)
    )
    kinds = met.select(F.coalesce("key_new", "key_old").alias("_key"), kind.alias(CHANGE))
    if not with_same:
        kinds = kinds.filter(F.col(CHANGE) != SAME)
    kinds = stage(kinds, "changes")

    def fetched(df: DataFrame, wanted: Column) -> DataFrame:
        part = kinds.filter(wanted)
        same = F.struct(*[F.col(f"`{k}`") for k in keys]).eqNullSafe(F.col("_key"))
        return df.select(*columns).join(part, same).select(*columns, CHANGE)

    gone = F.col(CHANGE) == REMOVED
    return fetched(new, ~gone).unionByName(fetched(old, gone))


def row_difference(old: DataFrame, new: DataFrame) -> DataFrame:
    """For tables without keys: distinct rows that occur more or less often than before.

    All columns, ``n_old`` and ``n_new``. Copies are counted before they are shuffled, so
    a row that makes up a third of the table is one row of each map task.
    """
    columns = new.columns
    if sorted(old.columns) != sorted(columns):
        raise ValueError("both snapshots must have the same columns")
    if {"n_old", "n_new"} & set(columns):
        raise ValueError("the column names n_old and n_new are taken")
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    sides = old.select(*columns, one.alias("n_old"), none.alias("n_new")).unionByName(
        new.select(*columns, none.alias("n_old"), one.alias("n_new"))
    )
    counted = sides.groupBy(*columns).agg(F.sum("n_old").alias("n_old"), F.sum("n_new").alias("n_new"))
    return counted.filter("n_old <> n_new")


def with_deletions(
    held: DataFrame | None, snapshot: DataFrame, keys: Sequence[str], at: Column, mark: str = "deleted_at"
) -> DataFrame:
    """A table that keeps what its source no longer has.

    ``held`` is the table after the last snapshot (None before the first), with the column
    ``mark``: when a row was first missing, NULL while it is there. A row that is missing
    now keeps its last values and gets ``at``; one that was missing and is back has its
    new values and no mark.
    """
    present = snapshot.select(*snapshot.columns, F.lit(None).cast("timestamp").alias(mark))
    if held is None:
        return present
    wanted = F.struct(*[F.col(f"`{k}`") for k in keys])
    there = snapshot.select(wanted.alias("_there"))
    missing = held.join(there, wanted.eqNullSafe(F.col("_there")), "left_anti")
    stamped = F.coalesce(F.col(mark), at.cast("timestamp"))
    return present.unionByName(missing.withColumn(mark, stamped))
