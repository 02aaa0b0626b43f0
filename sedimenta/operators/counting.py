"""Dimensions kept current by counting, without building them anew.

A dimension is a join of a code list with the groups of its items, so a row of it may be
there for several reasons. Kept with the number of its reasons it can be refreshed: what
changed in an input names the keys that are concerned, the join is made for these keys
only, with the old inputs and with the new ones, and the difference of the counts is added.
A row is in the dimension while its count is above zero, also where the dimension is
distinct.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COUNT = "n_reasons"


def counted(rows: DataFrame) -> DataFrame:
    """Distinct rows and how often each is there, in ``n_reasons``."""
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias(COUNT))


def apply_difference(view: DataFrame, minus: DataFrame, plus: DataFrame) -> DataFrame:
    """``view`` (counted) less the rows of ``minus`` and with those of ``plus``.

    A count below zero means that the view did not hold what was to be taken away, and
    fails the job. NULL equals NULL here, as in a grouping.
    """
    columns = [c for c in view.columns if c != COUNT]
    more = plus.select(*columns, F.lit(1).cast("long").alias(COUNT))
    less = minus.select(*columns, F.lit(-1).cast("long").alias(COUNT))
    delta = more.unionByName(less).groupBy(*columns).agg(F.sum(COUNT).alias(COUNT)).filter(f"{COUNT} <> 0")
    summed = view.unionByName(delta).groupBy(*columns).agg(F.sum(COUNT).alias(COUNT))
    shown = F.concat_ws(", ", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in columns])
    wrong = F.raise_error(F.concat(F.lit("taken away but not there: "), shown)).cast("boolean")
    kept = summed.filter(F.when(F.col(COUNT) < 0, wrong).otherwise(F.col(COUNT) > 0))
    return kept.select(*view.columns)


def changed_keys(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """``key`` of the rows that one side has more often than the other; NULL is left out.

    Rows are counted before they are shuffled.
    """
    one = F.lit(1).cast("long")
    both = old.select(*old.columns, one.alias("_n")).unionByName(new.select(*old.columns, (-one).alias("_n")))
    differing = both.groupBy(*old.columns).agg(F.sum("_n").alias("_n")).filter("_n <> 0")
    return differing.select(key).na.drop().distinct()


def refresh_members(
    view: DataFrame,
    build: Callable[[DataFrame, DataFrame], DataFrame],
    items: tuple[DataFrame, DataFrame],
    groups: tuple[DataFrame, DataFrame],
    item_key: str = "items_id",
    group_key: str = "id",
) -> DataFrame:
    """``view``, the counted rows of ``build(items, groups)``, after both may have changed.

    ``items`` and ``groups`` are (old, new). ``build`` must treat every value of the key by
    itself, as ``dimension_members`` does, dangling items included. Old and new inputs are
    reduced to the keys concerned by a semi-join, so that what is joined and shuffled is
    the changes' neighbourhood; rows whose item is NULL are concerned if they changed.
    """
    return _refreshed(view, build, [items, groups], [item_key, group_key])


def _refreshed(view: DataFrame, build, inputs: Sequence[tuple[DataFrame, DataFrame]], keys: Sequence[str]) -> DataFrame:
    concerned = None
    for (old, new), key in zip(inputs, keys, strict=True):
        found = changed_keys(old, new, key).select(F.col(key).cast("string").alias("_key"))
        concerned = found if concerned is None else concerned.unionByName(found)
    concerned = concerned.distinct()

    def part(df: DataFrame, key: str, first: bool) -> DataFrame:
        near = df.join(concerned, F.col(key).cast("string") == F.col("_key"), "left_semi")
        # an item without a key meets no group, but is a row of the dimension
        return near.unionByName(df.filter(F.col(key).isNull())) if first else near

    before = build(*[part(old, k, i == 0) for i, ((old, _), k) in enumerate(zip(inputs, keys, strict=True))])
    after = build(*[part(new, k, i == 0) for i, ((_, new), k) in enumerate(zip(inputs, keys, strict=True))])
    return apply_difference(view, before, after)
