"""Who is in which list, as bitmaps: set questions over many lists in one pass.

Members get numbers from 0 without gaps, and a list becomes bitmaps of 32,768 members each,
so a list of a million members is 31 rows of 4 KB, and the lists of a whole code book are
a table small enough to be asked again and again. Unions are the bitwise OR, intersections
the bitwise AND of the rows of a range; ranges are independent of each other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.session import stage

#: Members that are numbered in one task, about.
NUMBERED_TOGETHER = 1 << 20
#: Members of one bitmap; Spark's bitmap functions fix it.
RANGE = 4096 * 8


def member_numbers(
    members: DataFrame, column: str, together: int = NUMBERED_TOGETHER
) -> DataFrame:
    """``member`` and ``number``: the distinct members, numbered from 0 without gaps.

    The members are dealt into as many hash groups as their count asks for, numbered
    inside each in order, and moved up by the sizes of the groups before. NULL is no
    member. The result is a written table: numbers stay what they are.
    """
    known = members.select(F.col(column).alias("member")).na.drop().distinct()
    known = stage(known, "members")
    groups = max(1, -(-known.count() // together))
    dealt = known.withColumn("_group", F.pmod(F.xxhash64("member"), F.lit(groups)))
    sizes = dealt.groupBy("_group").agg(F.count(F.lit(1)).alias("_size"))
    # one row for each group: the running total is over a small table
    before = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_group", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_group").orderBy("member")
    numbered = dealt.withColumn("_at", F.row_number().over(inside) - 1).join(starts, "_group")
    return stage(
        numbered.select("member", (F.col("_start") + F.col("_at")).cast("long").alias("number")),
        "numbers",
    )


def list_bitmaps(rows: DataFrame, numbers: DataFrame, list_col: str, member_col: str) -> DataFrame:
    """``list``, ``range`` and ``bits`` of the members of each list that have a number.

    A member that a list names twice sets its bit twice. A hot list is as many rows as
    its members take up ranges; each map task sends one bitmap of each.
    """
    numbered = rows.select(
        F.col(list_col).alias("list"), F.col(member_col).alias("member")
    ).join(numbers, "member")
    at = F.col("number") + 1  # Spark's ranges are of the numbers 1 to 32768, and so on
    return numbered.groupBy("list", (F.bitmap_bucket_number(at) - 1).alias("range")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")
    )


def union_of_lists(bitmaps: DataFrame, lists: Sequence[str] | None = None) -> DataFrame:
    """``range`` and ``bits`` of the members that are in any of the lists (all, if not named)."""
    chosen = bitmaps if lists is None else bitmaps.filter(F.col("list").isin(*lists))
    return chosen.groupBy("range").agg(F.bitmap_or_agg("bits").alias("bits"))


def members_matching(
    bitmaps: DataFrame,
    all_of: Sequence[str] = (),
    any_of: Sequence[str] = (),
    none_of: Sequence[str] = (),
) -> DataFrame:
    """``range`` and ``bits`` of the members in all of some lists, in any of others, in none of
    the rest. At least one of ``all_of`` and ``any_of`` must name a list; a name that is no
    list is one without members.

    One pass: per range, the AND of the first, the OR of the second and of the third meet
    in a row. What is in the third goes by counting: ``x OR y`` less ``y`` is ``x`` without
    ``y``, for which the two sides are kept apart as ``bits`` and ``without``.
    """
    if not all_of and not any_of:
        raise ValueError("name the lists that members have to be in")
    everyone = sorted({*all_of, *any_of, *none_of})
    rows = bitmaps.filter(F.col("list").isin(*everyone))

    def of(names: Sequence[str]) -> Column:
        return F.when(F.col("list").isin(*names), F.col("bits")) if names else F.lit(None).cast("binary")

    met = rows.groupBy("range").agg(
        F.bitmap_and_agg(of(all_of)).alias("_every"),
        F.count_distinct(F.when(F.col("list").isin(*all_of), F.col("list")) if all_of else F.lit(None)).alias("_n"),
        F.bitmap_or_agg(of(any_of)).alias("_some"),
        F.bitmap_or_agg(of(none_of)).alias("without"),
    )
    if all_of:
        met = met.filter(F.col("_n") == len(set(all_of)))
    sides = [F.col(c) for c, names in (("_every", all_of), ("_some", any_of)) if names]
    # two bitmaps of a range are put together by the same aggregate, over two rows
    inner = met.select("range", "without", F.explode(F.array(*sides)).alias("bits"))
    return inner.groupBy("range").agg(
        F.bitmap_and_agg("bits").alias("bits"), F.first("without").alias("without")
    )


def count_members(matching: DataFrame) -> DataFrame:
    """``n_members`` of what the functions above give; one row."""
    if "without" not in matching.columns:
        return matching.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("n_members"))
    both = matching.select("range", "without", F.explode(F.array("bits", "without")).alias("side"))
    counted = both.groupBy("range").agg(
        F.bitmap_count(F.bitmap_or_agg("side")).alias("_all"),
        F.bitmap_count(F.first("without")).alias("_out"),
    )
    return counted.agg(F.coalesce(F.sum(F.col("_all") - F.col("_out")), F.lit(0)).alias("n_members"))


def overlaps(bitmaps: DataFrame) -> DataFrame:
    """``list``, ``other`` (smaller name first), ``n_both`` and ``n_either`` of every two lists
    that share a range.

    Pairs are of lists, whose number a code book bounds, inside a range; not of members.
    """
    a = bitmaps.select("range", "list", F.col("bits").alias("_a"))
    b = bitmaps.select("range", F.col("list").alias("other"), F.col("bits").alias("_b"))
    pairs = a.join(b, "range").filter(F.col("list") < F.col("other"))
    sides = pairs.select("range", "list", "other", F.explode(F.array("_a", "_b")).alias("bits"))
    per_range = sides.groupBy("list", "other", "range").agg(
        F.bitmap_count(F.bitmap_and_agg("bits")).alias("_both")
    )
    sums = per_range.groupBy("list", "other").agg(F.sum("_both").alias("n_both"))
    sizes = bitmaps.groupBy("list").agg(F.sum(F.bitmap_count("bits")).alias("_size"))
    other = sizes.select(F.col("list").alias("other"), F.col("_size").alias("_other_size"))
    return sums.join(sizes, "list").join(other, "other").select(
        "list", "other", "n_both", (F.col("_size") + F.col("_other_size") - F.col("n_both")).alias("n_either")
    )


def members_of(matching: DataFrame, numbers: DataFrame) -> DataFrame:
    """The members themselves: ``member`` of every bit that is set (and not in ``without``)."""
    taken = matching if "without" in matching.columns else matching.withColumn("without", F.lit(None).cast("binary"))
    placed = numbers.select(
        "member",
        F.expr(f"number div {RANGE}").alias("range"),
        F.pmod(F.col("number"), F.lit(RANGE)).alias("_at"),
    )
    met = placed.join(taken, "range")
    return met.filter(_is_set("bits") & ~F.coalesce(_is_set("without"), F.lit(False))).select("member")


def _is_set(bits: str) -> Column:
    byte = F.conv(F.hex(F.substr(F.col(bits), (F.col("_at") / 8 + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (F.col("_at") % 8).cast("int")) == 1
