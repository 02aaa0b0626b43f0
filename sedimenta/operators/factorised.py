"""Nested records as one table per array, so that sibling arrays do not multiply.

``flatten`` gives one row for every combination of a record's arrays. Here a record is a
row of the root table and every element of an array a row of that array's own table, with
the row it belongs to and its place there. Their rows are the sum of the elements, and a
product is made only of the arrays that a question names.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from sedimenta.session import stage

ROW, PARENT, AT = "_row", "_parent", "_at"
ROOT = ""
Field = tuple[str, Column, DataType]


@dataclass(frozen=True)
class Factorised:
    """Tables by the flat name of their array; the root's name is empty.

    Every table has ``_row``; those of arrays also ``_parent``, the row they belong to in
    the table ``parents`` names, and ``_at``, their place in the array, from 0.
    """

    tables: dict[str, DataFrame]
    parents: dict[str, str]
    order: tuple[str, ...]

    def product(self, arrays: Sequence[str] | None = None, outer: bool = True) -> DataFrame:
        """The rows that flattening gives, for the named arrays only (all, if not named).

        An array that another one lies in is taken along. ``outer`` keeps a row whose
        array is empty, with NULL for its columns. The tables meet by their surrogates,
        of which every parent has one, so no side repeats but by the product asked for.
        """
        wanted = set(self.parents if arrays is None else arrays)
        unknown = wanted - set(self.parents)
        if unknown:
            raise KeyError(f"no such array: {', '.join(sorted(unknown))}")
        for name in [*wanted]:
            while name != ROOT:
                wanted.add(name)
                name = self.parents[name]
        out = self.tables[ROOT].withColumnRenamed(ROW, f"{ROW}:{ROOT}")
        for name in self.parents:
            if name not in wanted:
                continue
            child = self.tables[name].withColumnsRenamed({ROW: f"{ROW}:{name}", PARENT: f"{PARENT}:{name}"}).drop(AT)
            same = F.col(f"`{ROW}:{self.parents[name]}`") == F.col(f"`{PARENT}:{name}`")
            out = out.join(child, same, "left" if outer else "inner").drop(f"{PARENT}:{name}")
        columns = [c for c in out.columns if not c.startswith(f"{ROW}:")]
        return out.select(*[f"`{c}`" for c in sorted(columns, key=self._place)])

    def _place(self, column: str) -> int:
        return self.order.index(column)


def factorise(df: DataFrame, sep: str = "_") -> Factorised:
    """A table for the records and one for every array in them, at any depth.

    An array whose elements are arrays is refused. Fields of structs become columns by their path, as in ``flatten``. An element that is
    NULL is a row with NULL columns. The records get their surrogates in a written table,
    so these are the same in all tables, however often a task is run again.
    """
    numbered = stage(df.withColumn(ROW, F.monotonically_increasing_id().cast("string")), "records")
    tables: dict[str, DataFrame] = {}
    parents: dict[str, str] = {}
    order: list[str] = []

    def split(rows: DataFrame, name: str, columns: list[Field], keep: list[str]) -> None:
        flat, arrays = _expanded(columns, sep)
        names = [n for n, *_ in flat]
        tables[name] = rows.select(*keep, *[c.alias(n) for n, c, _ in flat])
        order.extend(names)
        twice = {n for n in names if order.count(n) > 1} | {a for a, *_ in arrays if a in order or a in parents}
        if twice:
            raise ValueError(f"two fields have the flat name {', '.join(sorted(twice))}")
        for array, values, kind in arrays:
            parents[array] = name
            inner = rows.select(F.col(ROW).alias(PARENT), F.posexplode(values).alias(AT, array))
            inner = inner.withColumn(ROW, F.concat_ws("/", PARENT, F.col(AT).cast("string")))
            if isinstance(kind.elementType, ArrayType):
                raise ValueError(f"{array} is an array of arrays, which have no name of their own")
            element = [(array, F.col(f"`{array}`"), kind.elementType)]
            split(inner, array, element, [ROW, PARENT, AT])

    split(numbered, ROOT, [(f.name, F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields], [ROW])
    return Factorised(tables, parents, tuple(order))


def _expanded(columns: list[Field], sep: str) -> tuple[list[Field], list[Field]]:
    """Columns that are no struct and no array, and the arrays, by their flat names."""
    flat, arrays = [], []
    for name, value, kind in columns:
        if isinstance(kind, StructType):
            inner = [(f"{name}{sep}{f.name}", value.getField(f.name), f.dataType) for f in kind.fields]
            some, more = _expanded(inner, sep)
            flat += some
            arrays += more
        else:
            (arrays if isinstance(kind, ArrayType) else flat).append((name, value, kind))
    return flat, arrays
