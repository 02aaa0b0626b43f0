"""Translations (property, locale, value) to one column per property and locale."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.functions.scalars import translation_key


def pivot_translations(
    df: DataFrame,
    keys: Sequence[str],
    prop: str | Column,
    locale: str | Column,
    value: str | Column,
    locales: Sequence[str] | None = None,
    agg=F.min,
) -> DataFrame:
    """Long rows to one row per ``keys`` with a column per ``property_locale``.

    ``locales`` lists the columns to make; without it they are looked up in the
    data, which costs a job over the two key columns. Rows without translation
    keep their record and get no column of their own. Where several rows fall
    into one cell, ``agg`` decides; the smallest value makes results repeatable.
    """
    keyed = df.withColumn("_key", translation_key(prop, locale))
    names = list(locales) if locales is not None else _distinct_keys(keyed.select("_key"))
    cells = F.col(value) if isinstance(value, str) else value
    if not names:
        return df.select(*keys).distinct()
    wide = keyed.groupBy(*_led_by_hash(keys)).agg(
        *[agg(F.when(F.col("_key") == name, cells)).alias(f"_cell{i}") for i, name in enumerate(names)]
    )
    return _named(wide, keys, names)


def spread_translations(
    df: DataFrame,
    keys: Sequence[str],
    array: str,
    locales: Sequence[str] | None = None,
) -> DataFrame:
    """The same result from records that still hold their translations array.

    The array is walked once per record, into a map of the smallest value per
    name, so what is shuffled is one row per record and not one per translation;
    the aggregation only merges records that agree in all ``keys``.
    """
    keyed = df.select(
        *keys,
        F.array_sort(
            F.transform(
                array,
                lambda t: F.struct(
                    translation_key(t["property"], t["locale"]).alias("key"),
                    t["value"].alias("value"),
                ),
            )
        ).alias("_cells"),
    )
    if locales is None:
        names = _distinct_keys(keyed.select(F.explode("_cells.key").alias("_key")))
    else:
        names = list(locales)
    if not names:
        return keyed.select(*keys).distinct()
    with_value = keyed.withColumn("_cells", F.filter("_cells", lambda c: c["value"].isNotNull()))
    # sorted by name, then value: the first of each name is its smallest value
    firsts = F.filter(
        "_cells",
        lambda c, i: (i == 0) | (F.get("_cells", i - 1)["key"] != c["key"]),
    )
    mapped = with_value.select(*keys, F.map_from_entries(firsts).alias("_cells"))
    cells = [F.try_element_at("_cells", F.lit(n)).alias(f"_cell{i}") for i, n in enumerate(names)]
    wide = mapped.select(*keys, *cells).groupBy(*_led_by_hash(keys))
    return _named(wide.agg(*[F.min(f"_cell{i}").alias(f"_cell{i}") for i in range(len(names))]), keys, names)


def _led_by_hash(keys: Sequence[str]) -> list[Column]:
    """Grouping keys behind their hash: sorts then settle on one number nearly always."""
    return [F.xxhash64(*keys).alias("_hash"), *[F.col(k) for k in keys]]


def _named(wide: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """The cells under their names.

    A name that differs from an earlier column in case only, or not at all, gets the
    first of ``_1``, ``_2`` and so on that makes it another.
    """
    taken, final = {k.lower() for k in keys}, []
    for name in names:
        shown, n = name, 0
        while shown.lower() in taken:
            n += 1
            shown = f"{name}_{n}"
        taken.add(shown.lower())
        final.append(shown)
    return wide.select(*keys, *[F.col(f"_cell{i}").alias(x) for i, x in enumerate(final)])


def translation_names(df: DataFrame, prop: str | Column, locale: str | Column) -> list[str]:
    """The ``property_locale`` names that occur, sorted."""
    return _distinct_keys(df.select(translation_key(prop, locale).alias("_key")))


def _distinct_keys(keys: DataFrame) -> list[str]:
    """The column names to make. As many as Spark lets a pivot have, or an error."""
    limit = int(keys.sparkSession.conf.get("spark.sql.pivotMaxValues", "10000"))
    found = keys.filter("_key <> ''").distinct().limit(limit + 1).collect()
    if len(found) > limit:
        raise ValueError(f"more than {limit} translation columns; pass locales=")
    return sorted(row[0] for row in found)
