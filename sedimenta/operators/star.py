"""Facts joined to the dimensions they have many-to-many links with.

A member (a unit, an option combination, a data element) may be in several groups of one
code list, so a join of fact rows with the bridge repeats them. Here the bridge is first
turned into one row per member, with the sorted set of its groups, and the facts into one
row per combination of their keys, with sums. The two meet by a key that is unique on the
bridge's side, so a fact is counted once whatever its groups are; a set is taken apart
only after the facts have been added up.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, IntegralType

SHARINGS = ("sets", "each", "split")
COUNT = "n_facts"


@dataclass(frozen=True)
class Link:
    """A dimension as a bridge of (group ``name``, ``member``), and the fact's ``key`` to it."""

    bridge: DataFrame
    key: str
    member: str
    name: str = "name"


def group_sets(bridge: DataFrame, member: str, name: str = "name") -> DataFrame:
    """One row per member: ``member`` and ``groups``, the sorted distinct names.

    Rows that repeat, and those without member or name (a group that has no members,
    an item without group), add nothing. A member's set is as large as its code list at
    most, so no row grows with the data.
    """
    known = bridge.filter(F.col(member).isNotNull() & F.col(name).isNotNull())
    return known.groupBy(F.col(member).alias("member")).agg(
        F.array_sort(F.collect_set(F.col(name).cast("string"))).alias("groups")
    )


def star_report(
    fact: DataFrame,
    links: Mapping[str, Link],
    sums: Sequence[str] = (),
    by: Sequence[str] = (),
    sharing: str = "each",
) -> DataFrame:
    """Facts counted (``n_facts``) and ``sums`` of their columns by groups of dimensions.

    ``links`` names the output columns; ``by`` are columns of the fact itself. A fact
    whose key is NULL, or is in no group, has the group NULL: no fact is left out.

    * ``sharing="sets"``: by the array of all groups of a member. Every fact counts once,
      so the rows add up to the facts.
    * ``"each"``: a fact counts in full in each of its groups, and in each pair of groups
      of two dimensions. Groups may overlap: rows add up to more than the facts.
    * ``"split"``: a row's count and sums are dealt out evenly among the groups of its
      set, as whole units of the last place with the remainder to the first groups by
      name. Rows add up to the facts exactly. Sums must be whole or decimal numbers.

    A combination of keys becomes one row before anything is joined, so a hot key is one
    row of each map task. The join is by a unique key on the bridge's side; beyond the
    broadcast limit AQE splits the fact side of a hot one. NULL keys do not go through
    the join at all.
    """
    if sharing not in SHARINGS:
        raise ValueError(f"sharing must be one of {', '.join(SHARINGS)}")
    taken = [*by, *links, *sums, COUNT]
    if len({c.lower() for c in taken}) < len(taken):
        raise ValueError(f"output columns share a name: {', '.join(taken)}")
    if sharing == "split":
        wrong = [c for c in sums if _unit(fact.schema[c].dataType) is None]
        if wrong:
            raise ValueError(f"only whole and decimal numbers can be split: {', '.join(wrong)}")
    keys = dict.fromkeys(link.key for link in links.values())
    numbered = {key: f"_key{i}" for i, key in enumerate(keys)}
    rows = fact.groupBy(
        *[F.col(c) for c in by], *[F.col(key).alias(name) for key, name in numbered.items()]
    ).agg(F.count(F.lit(1)).alias(COUNT), *[F.sum(c).alias(c) for c in sums])
    for i, link in enumerate(links.values()):
        sets = group_sets(link.bridge, link.member, link.name).withColumnRenamed("groups", f"_set{i}")
        rows = _with_sets(rows, sets, numbered[link.key])
    shape = [F.coalesce(F.col(f"_set{i}"), F.array(F.lit(None).cast("string"))) for i in range(len(links))]
    rows = rows.select(*by, *[s.alias(f"_set{i}") for i, s in enumerate(shape)], COUNT, *sums)
    sets = [f"_set{i}" for i in range(len(links))]
    whole = rows.groupBy(*by, *sets).agg(*[F.sum(c).alias(c) for c in (COUNT, *sums)])
    if sharing == "sets":
        named = [F.filter(s, lambda x: x.isNotNull()).alias(n) for s, n in zip(sets, links, strict=True)]
        return whole.select(*by, *named, COUNT, *sums)
    return _taken_apart(whole, list(links), [*by], [COUNT, *sums], sharing == "split")


def _with_sets(rows: DataFrame, sets: DataFrame, key: str) -> DataFrame:
    """A left join that keeps rows with a NULL key out of the shuffle's hot spot."""
    spread = F.when(F.col(key).isNull(), F.xxhash64(*rows.columns)).otherwise(F.lit(0).cast("long"))
    left = rows.withColumn("_spread", spread)
    right = sets.select(F.col("member").alias("_member"), sets.columns[1], F.lit(0).cast("long").alias("_none"))
    same = (F.col(key) == F.col("_member")) & (F.col("_spread") == F.col("_none"))
    return left.join(right, same, "left").drop("_member", "_none", "_spread")


def _taken_apart(
    whole: DataFrame, names: list[str], by: list[str], measures: list[str], split: bool
) -> DataFrame:
    """One row per group of every set, with all or an even part of the measures."""
    sizes: Column = F.lit(1).cast("long")
    place: Column = F.lit(0).cast("long")
    for i, name in enumerate(names):
        size = F.size(f"_set{i}").cast("long")
        whole = whole.select("*", F.posexplode(f"_set{i}").alias(f"_at{i}", name))
        place = place * size + F.col(f"_at{i}")
        sizes = sizes * size
    if split:
        parts = {m: _part(F.col(m), whole.schema[m].dataType, sizes, place) for m in measures}
        whole = whole.select(*by, *names, *[c.alias(m) for m, c in parts.items()])
    out = whole.groupBy(*by, *names).agg(*[F.sum(m).alias(m) for m in measures])
    return out.select(*by, *names, *measures)


def _unit(kind: DataType) -> int | None:
    """Digits after the point of the smallest part; None if there is no such part."""
    if isinstance(kind, DecimalType):
        return kind.scale
    return 0 if isinstance(kind, IntegralType) else None


def _part(value: Column, kind: DataType, sizes: Column, place: Column) -> Column:
    """``value / sizes`` in whole units; the first places take one unit of the remainder.

    Units are counted in 64 bits; a total beyond that fails the job.
    """
    scale = _unit(kind)
    units = (value * F.lit(10**scale)).cast("long") if scale else value.cast("long")
    rest = F.pmod(units, sizes)
    share = F.call_function("div", units - rest, sizes) + F.when(place < rest, 1).otherwise(0)
    if not scale:
        return share.cast(kind)
    return (share.cast("decimal(19,0)") * F.lit(Decimal(1).scaleb(-scale))).cast(kind)
