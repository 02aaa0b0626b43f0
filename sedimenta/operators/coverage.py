"""What has been fetched of each key, and what is still to be asked for.

A fetch covers an interval, from its start (included) to its end (not included). The union
of a key's intervals is a list of islands; what a request should have covered and no
island does are the gaps, and these are the next requests. A unit whose fetch failed is so
asked again from its own gap on, and the others are not asked for what they have.

Islands of islands are the islands of all: fetches are first joined up inside spans of
their starts, wherever they lie, and only what is left of them meets by key. So a key with
a third of all fetches is as many groups as it has spans, and one with many overlapping
fetches sends a few rows on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "start", "end"


def islands(
    fetches: DataFrame, keys: Sequence[str], start: str = START, end: str = END, span: Column | None = None
) -> DataFrame:
    """The keys, ``start`` and ``end`` of what is covered without a break, and ``n_fetches``.

    Intervals that touch are one. An interval without a start or an end, or that ends
    before or where it starts, covers nothing. NULL keys are one key. ``span`` is an
    expression over ``start`` that says which intervals are joined up first (a day of a
    timestamp, a thousand of a number); without it the key alone decides.
    """
    keys = list(keys)
    real = fetches.filter(F.col(end) > F.col(start)).select(
        *keys, F.col(start).alias(START), F.col(end).alias(END), F.lit(1).cast("long").alias("n_fetches")
    )
    if span is not None:
        real = _joined_up(real.withColumn("_span", span), [*keys, "_span"]).drop("_span")
    return _joined_up(real, keys)


def _joined_up(rows: DataFrame, keys: list[str]) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(START, END)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    so_far = rows.withColumn("_reach", F.max(END).over(before))
    new = (F.col("_reach").isNull() | (F.col(START) > F.col("_reach"))).cast("long")
    until = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = so_far.withColumn("_new", new).withColumn("_island", F.sum("_new").over(until))
    return (
        numbered.groupBy(*keys, "_island")
        .agg(F.min(START).alias(START), F.max(END).alias(END), F.sum("n_fetches").alias("n_fetches"))
        .drop("_island")
    )


def gaps(wanted: DataFrame, covered: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys, ``start`` and ``end`` of what ``wanted`` asks for and ``covered`` lacks.

    ``wanted`` has one row per key with ``start`` and ``end``, ``covered`` is what
    :func:`islands` gives. A key that was never fetched has its whole interval as gap; one
    without a start or an end asks for nothing. NULL keys match each other.
    """
    keys = list(keys)
    asked = wanted.filter(F.col(END) > F.col(START)).select(
        *keys, F.col(START).alias("_from"), F.col(END).alias("_to")
    )
    right = covered.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], START, END)
    same = F.lit(True)
    for i, k in enumerate(keys):
        same &= F.col(k).eqNullSafe(F.col(f"_k{i}"))
    touching = same & (F.col(START) < F.col("_to")) & (F.col(END) > F.col("_from"))
    met = asked.join(right, touching, "left").select(*keys, "_from", "_to", START, END)
    order = Window.partitionBy(*keys, "_from", "_to").orderBy(START)
    # before each island there may be a gap, and one after the last
    earlier = F.coalesce(F.lag(END).over(order), F.col("_from"))
    last = F.lead(START).over(order).isNull()
    cut = met.withColumns({"_earlier": earlier, "_last": last})
    none = F.col(START).isNull()
    before = F.struct(F.col("_earlier").alias(START), F.when(none, F.col("_to")).otherwise(F.col(START)).alias(END))
    after = F.struct(F.col(END).alias(START), F.col("_to").alias(END))
    both = F.when(F.col("_last") & ~none, F.array(before, after)).otherwise(F.array(before))
    return (
        cut.select(*keys, F.explode(both).alias("_gap"))
        .select(*keys, f"_gap.{START}", f"_gap.{END}")
        .filter(F.col(END) > F.col(START))
    )
