"""Code lists joined to the members of their groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.session import fits_broadcast, stage


def dimension_members(
    dimension: DataFrame,
    groups: DataFrame,
    name: str,
    member: str,
    distinct: bool = False,
    member_alias: str | None = None,
    dimension_type: str | None = None,
    strategy: str = "auto",
) -> DataFrame:
    """``(name, member)`` of every group that is an item of the code list ``name``.

    ``dimension`` has ``(dimensionType, id, name, items_id)``, ``groups`` has
    ``(id, name, <member>)``. The name given out is the group's. An item without
    group, or a code list without items, gives the row ``(NULL, NULL)``. Rows
    repeat as the data do unless ``distinct``.
    """
    found = members_of_lists(
        dimension, groups, [name], member, dimension_type=dimension_type, strategy=strategy
    )
    out = found.select("name", F.col(member).alias(member_alias or member))
    return out.distinct() if distinct else out


def dimension_members_2hop(
    dimension: DataFrame,
    groups: DataFrame,
    options: DataFrame,
    name: str,
    member: str,
    link: str = "categoryOptions_id",
    distinct: bool = False,
    member_alias: str | None = None,
    dimension_type: str | None = None,
    strategy: str = "auto",
) -> DataFrame:
    """The same over two hops: code list item to group, group's ``link`` to option.

    The name given out is the group's, the member the option's.
    """
    found = members_of_lists(
        dimension, groups, [name], member, options, link, dimension_type, strategy
    )
    out = found.select("name", F.col(member).alias(member_alias or member))
    return out.distinct() if distinct else out


def members_of_lists(
    dimension: DataFrame,
    groups: DataFrame,
    names: Sequence[str],
    member: str,
    options: DataFrame | None = None,
    link: str = "categoryOptions_id",
    dimension_type: str | None = None,
    strategy: str = "auto",
) -> DataFrame:
    """``(list_name, name, member)`` for several code lists in one pass over the groups."""
    condition: Column = F.col("name").isin(*names) if len(names) > 1 else F.col("name") == names[0]
    if dimension_type is not None:
        condition &= F.col("dimensionType") == dimension_type
    items = dimension.filter(condition).select(F.col("name").alias("list_name"), "items_id")
    first = member if options is None else link
    found = left_lookup(items, groups.select("id", "name", first), "items_id", "id", strategy)
    found = found.select("list_name", "name", first)
    if options is None:
        return found
    ends = options.select(F.col("id").alias("_option"), member)
    found = left_lookup(found, ends, link, "_option", strategy)
    return found.select("list_name", "name", member)


def left_lookup(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, strategy: str = "auto"
) -> DataFrame:
    """Left outer equi-join that also holds when ``right`` is huge and skewed.

    * ``"join"``: a plain left join. Right when Catalyst can broadcast ``right``.
    * ``"split"``: AQE cannot split a hot key on the right of an outer join, nor
      can a small left side be broadcast there. So the rows with a partner come
      from an inner join (either side may be broadcast, either side may be
      split), and those without from an anti-join against the keys that were
      hit, which are few. ``left`` is written to the scratch folder first, so
      Catalyst knows its true size, and a code list of ordinary size spares
      ``right`` any shuffle.
    * ``"auto"``: ``"join"`` if Catalyst's estimate of ``right`` is below the
      broadcast threshold, else ``"split"``.
    """
    if strategy not in ("auto", "join", "split"):
        raise ValueError(f"unknown strategy {strategy!r}")
    if strategy == "auto":
        strategy = "join" if fits_broadcast(right) else "split"
    if strategy == "join":
        return left.join(right, left[left_key] == right[right_key], "left")
    left = stage(left, "lookup")
    same = left[left_key] == right[right_key]
    matched = left.join(right, same, "inner")
    hit = (
        right.select(F.col(right_key).alias("_hit"))
        .join(left.select(F.col(left_key).alias("_asked")), F.expr("_hit = _asked"), "left_semi")
        .distinct()
    )
    missing = left.join(hit, left[left_key] == hit["_hit"], "left_anti")
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields]
    return matched.unionByName(missing.select("*", *nulls))
