"""Turn nested records into flat rows, directed by the schema."""

from __future__ import annotations

from collections import Counter
from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType


def flatten(
    df: DataFrame,
    sep: str = "_",
    columns: Sequence[str] | None = None,
    keep: Collection[str] = (),
) -> DataFrame:
    """Expand every struct into columns and every array into rows.

    * A struct ``p`` with field ``k`` gives column ``p_k``; columns that come
      from a deeper level stand behind those of the level above.
    * An array gives one row per element; an empty or NULL array keeps its
      record, with NULL. Sibling arrays therefore multiply.
    * A map is left as it is, and so is an array whose flat name is in ``keep``.

    With ``columns`` only these are returned, and parts of the schema that lead
    to none of them are never expanded. As an outer explode leaves at least one
    row per record, this changes how often a row repeats but not which rows
    there are: use it where ``distinct`` or a key resolution follows.
    """
    wanted = None if columns is None else list(columns)
    level = [(f.name, f.dataType) for f in df.schema.fields]
    _refuse_clashes(df, [name for name, _ in level])
    while True:
        level = [(n, t) for n, t in level if _leads_to(n, wanted, sep)]
        df = df.select(*[_named(n) for n, _ in level])
        for position, (name, dtype) in enumerate(level):
            while isinstance(dtype, ArrayType) and name not in keep:
                df = df.withColumn(name, F.explode_outer(_named(name)))
                dtype = dtype.elementType
            level[position] = (name, dtype)
        if not any(isinstance(t, StructType) for _, t in level):
            break
        df, level = _open_structs(df, level, sep, wanted)
    return df if wanted is None else df.select(*[_named(c) for c in wanted])


def _open_structs(df, level, sep, wanted):
    """Replace all structs of one level by their fields, in one projection."""
    plain = [(n, t) for n, t in level if not isinstance(t, StructType)]
    inner = [
        (f"{n}{sep}{f.name}", f.dataType, _named(n).getField(f.name))
        for n, t in level
        if isinstance(t, StructType)
        for f in t.fields
    ]
    _refuse_clashes(df, [n for n, _ in plain] + [n for n, _, _ in inner])
    inner = [field for field in inner if _leads_to(field[0], wanted, sep)]
    opened = df.select(*[_named(n) for n, _ in plain], *[c.alias(n) for n, _, c in inner])
    return opened, plain + [(n, t) for n, t, _ in inner]


def _named(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _leads_to(name: str, wanted: list[str] | None, sep: str) -> bool:
    return wanted is None or any(w == name or w.startswith(name + sep) for w in wanted)


def _refuse_clashes(df: DataFrame, names: list[str]) -> None:
    if df.sparkSession.conf.get("spark.sql.caseSensitive", "false") != "true":
        names = [n.lower() for n in names]
    twice = sorted(n for n, count in Counter(names).items() if count > 1)
    if twice:
        raise ValueError(f"flattening would give several columns the name {', '.join(twice)}")
