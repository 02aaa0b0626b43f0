"""Projection, renaming, null dropping, sorted output."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.session import has_shuffle, stage


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename many columns in a single plan node; unknown names are ignored."""
    return df.withColumnsRenamed(dict(mapping))


def project(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Keep the columns named by the mapping, under their new names, in its order."""
    return df.select(*[F.col(f"`{old}`").alias(new) for old, new in mapping.items()])


def drop_null(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Drop rows with NULL in any of ``subset``."""
    return df.na.drop(subset=list(subset))


def sorted_projection(df: DataFrame, columns: Sequence[str], by: str) -> DataFrame:
    """Project, then sort globally by one column, NULLs first.

    The other columns and a row number follow as further sort keys. They change
    nothing in the order of ``by``, but let the range partitioning cut through a
    value, or a row, that fills a third of the table. A row number is repeatable
    only if the order of the input is; behind a shuffle it is not, and there the
    numbered rows are first written to the scratch folder, so that a lost task
    that is run again deals out the same rows.
    """
    rest = [c for c in columns if c != by]
    numbered = df.select(*columns).withColumn("_spread", F.monotonically_increasing_id())
    if has_shuffle(df):
        numbered = stage(numbered, "sort")
    return numbered.orderBy(
        F.col(by).asc(), *[F.col(c).asc() for c in rest], F.col("_spread").asc()
    ).drop("_spread")
