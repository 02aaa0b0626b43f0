"""Merging a batch of changed rows into a keyed table, as DataFrame operations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.session import fits_broadcast

DUPLICATE_POLICIES = ("error", "latest", "allow")


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    *,
    null_safe: bool = False,
    on_duplicate: str = "error",
    order_by: str | None = None,
    newer_only: str | None = None,
) -> DataFrame:
    """All source rows, and the target rows whose key the source does not hold.

    * A NULL in a key matches nothing, unless ``null_safe``.
    * ``on_duplicate`` says what to do with a key that occurs twice in the
      source: fail, keep the ``"latest"`` by ``order_by``, or ``"allow"``
      (the caller vouches for the keys).
    * ``newer_only`` names a column; a target row that is newer by it stays.

    Nothing is ever deleted. The target is shuffled only if the source's keys
    are too many to broadcast.
    """
    keys = list(keys)
    if sorted(target.columns) != sorted(source.columns):
        raise ValueError("source and target must have the same columns")
    raw = source
    source = resolve_duplicates(source, keys, on_duplicate, order_by, null_safe)
    asked = source
    if newer_only:
        asked = asked.select(*dict.fromkeys([*keys, newer_only]))
        source = _not_stale(target, source, asked, keys, newer_only, null_safe)
    elif on_duplicate != "allow":
        asked = raw.select(*keys).distinct()
    kept = without_keys(target, asked, keys, null_safe, newer_only)
    return source.select(*target.columns).unionByName(kept)


def resolve_duplicates(
    source: DataFrame,
    keys: Sequence[str],
    policy: str,
    order_by: str | None = None,
    null_safe: bool = False,
) -> DataFrame:
    if policy not in DUPLICATE_POLICIES:
        raise ValueError(f"on_duplicate must be one of {', '.join(DUPLICATE_POLICIES)}")
    if policy == "latest":
        if order_by is None:
            raise ValueError("on_duplicate='latest' needs order_by")
        return latest_per_key(source, keys, order_by, null_safe=null_safe)
    if policy == "error":
        return require_unique(source, keys, null_safe=null_safe)
    return source


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: str | Sequence[Column],
    *,
    null_safe: bool = True,
) -> DataFrame:
    """One row per key: the greatest by ``order_by``; ties go by the other columns.

    Spark puts a group limit of one row before the shuffle, so of a hot key each
    map task sends a single row. The key's hash leads the sort, as most of the
    comparisons are then settled by one number. Without ``null_safe`` rows with
    a NULL in the key are nobody's duplicate and all stay.
    """
    if not null_safe:
        keyed, keyless = _by_null_key(df, keys)
        return latest_per_key(keyed, keys, order_by).unionByName(keyless)
    if isinstance(order_by, str):
        tie = [
            F.col(f.name).asc_nulls_last()
            for f in df.schema.fields
            if f.name not in (*keys, order_by) and f.dataType.typeName() != "map"
        ]
        order = [F.col(order_by).desc_nulls_last(), *tie]
    else:
        order = list(order_by)
    window = Window.partitionBy(F.xxhash64(*keys), *keys).orderBy(*order)
    ranked = df.withColumn("_rank", F.row_number().over(window))
    return ranked.filter("_rank = 1").select(*df.columns)


def require_unique(
    df: DataFrame, keys: Sequence[str], *, null_safe: bool = True
) -> DataFrame:
    """``df`` as it is, but the job fails if a key occurs twice.

    The test is part of the plan: a subquery that reads and counts the key columns
    only, before they are shuffled. The rows themselves are neither sorted nor moved.
    """
    keys = list(keys)
    shown = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
    found = duplicate_keys(df, keys, null_safe=null_safe).agg(F.max(shown).alias("example"))
    message = F.concat(F.lit(f"duplicate key ({', '.join(keys)}) in batch: "), F.col("example"))
    unique = found.select(
        F.when(F.col("example").isNotNull(), F.raise_error(message).cast("boolean")).otherwise(
            F.lit(True)
        )
    )
    return df.filter(unique.scalar())


def _by_null_key(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows whose key is whole, and rows with a NULL in it."""
    return df.filter(~any_null(keys)), df.filter(any_null(keys))


def duplicate_keys(df: DataFrame, keys: Sequence[str], *, null_safe: bool = True) -> DataFrame:
    """The keys that occur more than once; reads only the key columns."""
    rows = df.select(*keys)
    if not null_safe:
        rows = rows.na.drop()
    return rows.groupBy(*keys).count().filter("count > 1")


def without_keys(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    null_safe: bool = False,
    unless_newer: str | None = None,
) -> DataFrame:
    """Target rows whose key does not occur in the source.

    With ``unless_newer`` those also that are newer by this column than the
    source's row. Where NULL matches nothing and the join has to shuffle, target
    rows with a NULL key go past it: they cannot match, and they may be a large
    part of the table, which all would have gone to one task.
    """
    columns = target.columns
    right = source.select(*[F.col(k).alias(f"_s_{k}") for k in keys])
    condition = same_key(keys, null_safe)
    if unless_newer:
        right = source.select(
            *[F.col(k).alias(f"_s_{k}") for k in keys], F.col(unless_newer).alias("_s_mark")
        )
        condition &= ~F.coalesce(F.col(unless_newer) > F.col("_s_mark"), F.lit(False))
    if null_safe or fits_broadcast(right):
        return target.join(right, condition, "left_anti").select(*columns)
    keyed, keyless = _by_null_key(target, keys)
    right = right.na.drop(subset=[f"_s_{k}" for k in keys])
    kept = keyed.join(right, condition, "left_anti").select(*columns)
    return kept.unionByName(keyless)


def with_keys(
    target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: bool = False
) -> DataFrame:
    """Target rows whose key occurs in the source."""
    right = source.select(*[F.col(k).alias(f"_s_{k}") for k in keys])
    return target.join(right, same_key(keys, null_safe), "left_semi").select(*target.columns)


def _not_stale(target, source, asked, keys, column, null_safe):
    """Source rows without a newer row of the same key in the target."""
    marks = asked.select(
        *[F.col(k).alias(f"_s_{k}") for k in keys], F.col(column).alias("_s_mark")
    )
    newer = F.col(column) > F.col("_s_mark")
    held = target.select(*dict.fromkeys([*keys, column]))
    stale = held.join(marks, same_key(keys, null_safe) & newer, "left_semi").select(*keys)
    return without_keys(source, stale.distinct(), keys, null_safe)


def same_key(keys: Sequence[str], null_safe: bool) -> Column:
    """``k = _s_k`` for every key."""
    pairs = [(F.col(k), F.col(f"_s_{k}")) for k in keys]
    tests = [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs]
    return reduce(lambda x, y: x & y, tests)


def any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda x, y: x | y, [F.col(k).isNull() for k in keys])


def merge_into(
    source: DataFrame, table: str, keys: Sequence[str], *, null_safe: bool = False
) -> None:
    """The same upsert on a catalog table whose format supports row-level merge."""
    pairs = [(F.col(f"{table}.{k}"), F.col(f"_source.{k}")) for k in keys]
    tests = [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs]
    (
        source.alias("_source")
        .mergeInto(table, reduce(lambda x, y: x & y, tests))
        .whenMatched()
        .updateAll()
        .whenNotMatched()
        .insertAll()
        .merge()
    )
