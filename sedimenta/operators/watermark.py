"""High-water marks and the rows changed since."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.functions.scalars import iso_text


def max_of(df: DataFrame, column: str | Column, alias: str = "max_value") -> DataFrame:
    """The largest value of a column, as a one-row DataFrame."""
    return df.agg(F.max(column).alias(alias))


def high_watermark(df: DataFrame, column: str, by: str | None = None) -> str | DataFrame | None:
    """The newest ``column`` as ISO text, or None when there is none yet.

    With ``by`` the marks are kept apart per key and returned as a DataFrame
    ``(by, watermark)``, so that a key seen for the first time has no mark and
    is fetched in full.
    """
    if by is not None:
        return df.groupBy(by).agg(iso_text(F.max(column)).alias("watermark"))
    row = df.agg(iso_text(F.max(column)).alias("watermark")).first()
    return row["watermark"]


def changed_since(
    df: DataFrame, column: str, watermark: str | None, lookback: int = 0
) -> DataFrame:
    """Rows at or after the watermark; all rows if there is none.

    The test is inclusive, as a mark of whole seconds may hide later rows of the
    same second. ``lookback`` moves it back by some seconds for late arrivals.
    """
    if watermark is None:
        return df
    mark = F.lit(watermark).cast(df.schema[column].dataType)
    if lookback:
        mark = mark - F.expr(f"INTERVAL {int(lookback)} SECONDS")
    return df.filter(F.col(column) >= mark)


def active_only(df: DataFrame, flag: str = "deleted") -> DataFrame:
    """Leave out soft-deleted rows; a missing flag counts as not deleted."""
    return df.filter(~F.coalesce(F.col(flag), F.lit(False)))
