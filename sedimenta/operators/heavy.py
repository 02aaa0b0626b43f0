"""Joins in which a few keys hold most of the rows.

A sketch of the most frequent keys (``approx_top_k``, a fixed number of counters in each
map task) says which keys are heavy; only these are salted. A row of a heavy key goes to
one of ``copies`` parts of the key, and the other side's rows of that key go to all of
them, so a key with most of a table is spread over that many tasks, while all other keys
are joined as they are. Which keys the sketch names changes only where rows go, never
what the join gives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key with more than this share of its table is heavy.
SHARE = 0.01
#: Counters of the sketch, and keys that it may name; 1 / SHARE keys can be that frequent.
COUNTERS, NAMED = 10_000, 100


def heavy_keys(df: DataFrame, key: str, share: float = SHARE) -> list:
    """The keys that about ``share`` of the rows or more have, the most frequent one first.

    One pass; ``NAMED`` keys at the most reach the driver. NULL is no key. The sketch's
    estimate is never below the true count, so no heavy key is missed.
    """
    if not 1 / NAMED <= share <= 1:
        raise ValueError(f"share must be from {1 / NAMED} to 1")
    known = df.filter(F.col(key).isNotNull()).select(F.col(key).alias("key"))
    row = known.agg(
        F.expr(f"approx_top_k(key, {NAMED}, {COUNTERS})").alias("top"), F.count(F.lit(1)).alias("n")
    ).first()
    return [x["item"] for x in row["top"] or [] if x["count"] >= share * row["n"]]


def heavy_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    how: str = "inner",
    copies: int = 64,
    share: float = SHARE,
) -> DataFrame:
    """``left`` joined with ``right`` by equal keys (inner, left or left_semi, left_anti).

    Heavy keys of ``left`` are dealt to ``copies`` parts by a hash of the row, and the rows
    of ``right`` with such a key are repeated for each; in an inner join also the other
    way round, for a key that is heavy on the right only. A key that is heavy on both
    sides is dealt on both: each pair of rows meets in one of copies x copies parts. Rows
    with a NULL key match nothing; in a left join they are spread as well.

    At most ``NAMED`` keys are salted, so what is repeated is bounded by the rows that
    ``right`` has of these keys, times ``copies``.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"how must be inner, left, left_semi or left_anti, not {how!r}")
    hot_left = heavy_keys(left, left_key, share)
    hot_right = heavy_keys(right, right_key, share) if how == "inner" else []
    if not hot_left and not hot_right:
        return left.join(right, left[left_key] == right[right_key], how)
    a = _dealt(left, left_key, hot_left, hot_right, copies, "_a", "_b", spread_nulls=True)
    b = _dealt(right, right_key, hot_right, hot_left, copies, "_b", "_a", spread_nulls=False)
    b = b.withColumnsRenamed({"_a": "_a2", "_b": "_b2"})
    same = (a[left_key] == b[right_key]) & (F.col("_a") == F.col("_a2")) & (F.col("_b") == F.col("_b2"))
    out = a.join(b, same, how)
    return out.drop("_a", "_b", "_a2", "_b2")


def _dealt(
    df: DataFrame, key: str, own: list, others: list, copies: int, mine: str, theirs: str, spread_nulls: bool
) -> DataFrame:
    """A part for each row of the own heavy keys, and every part of the other side's ones."""
    hashed = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns if _hashable(df, c)]), F.lit(copies)).cast("int")
    part: Column = F.when(F.col(key).isin(*own), hashed).otherwise(0) if own else F.lit(0)
    if spread_nulls:
        part = F.when(F.col(key).isNull(), hashed).otherwise(part)
    all_parts = F.sequence(F.lit(0), F.lit(copies - 1))
    one = F.array(F.lit(0))
    repeated = F.when(F.col(key).isin(*others), all_parts).otherwise(one) if others else one
    return df.withColumn(mine, part).withColumn(theirs, F.explode(repeated))


def _hashable(df: DataFrame, column: str) -> bool:
    return "map" not in df.schema[column].dataType.simpleString()
