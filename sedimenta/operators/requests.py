"""What to fetch next, as tables: id lists and request rows. Nothing is fetched."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def id_list(df: DataFrame, array: str, field: str = "id", alias: str = "id") -> DataFrame:
    """The distinct ids in an array of records, over all rows; a record without id has none.

    ``array`` may lead through another array (``units.programs``).
    """
    elements = df.select(F.explode(array).alias("_element"))
    while elements.schema["_element"].dataType.typeName() == "array":
        elements = elements.select(F.explode("_element").alias("_element"))
    ids = elements.select(F.col("_element").getField(field).alias(alias))
    return ids.filter(F.col(alias).isNotNull()).distinct()


def request_plan(
    keys: DataFrame,
    params: Mapping[str, str],
    *,
    fixed: str = "",
    watermark: str | DataFrame | None = None,
    watermark_param: str = "lastUpdated",
    suffix: str = ".json",
    poll: str | None = None,
    nulls: str = "fail",
) -> DataFrame:
    """One row per request: its key columns, ``file_name`` and ``parameters``.

    ``keys`` holds one row per request and ``params`` says which parameter each
    key column fills. ``watermark`` is one text for all, or a DataFrame of
    marks per key as :func:`sedimenta.high_watermark` gives with ``by``; a
    request without mark carries no date parameter and so asks for everything.
    ``poll`` names this round of requests and becomes part of each file name: a
    stream takes every file once, so a file must not be replaced under its name.

    A NULL key asks for nothing, so it fails the job, unless ``nulls="skip"`` leaves such
    rows out. Different keys never share a file: inside a key ``%``, ``_`` and ``/`` are
    written as ``%25``, ``%5F`` and ``%2F``, since ``_`` stands between the parts. In
    ``parameters`` a key is encoded as a part of an address is.
    """
    if nulls not in ("fail", "skip"):
        raise ValueError(f"nulls must be 'fail' or 'skip', not {nulls!r}")
    columns: Sequence[str] = list(params)
    plan = keys.select(*columns)
    if nulls == "skip":
        plan = plan.na.drop(subset=columns)
    else:
        refused = F.raise_error(F.lit(f"a request needs every key of {', '.join(columns)}"))
        known = reduce(and_, [F.col(c).isNotNull() for c in columns], F.lit(True))
        plan = plan.filter(F.when(known, F.lit(True)).otherwise(refused.cast("boolean")))
    if isinstance(watermark, DataFrame):
        by = [c for c in watermark.columns if c != "watermark"]
        plan = plan.join(watermark, by, "left")
    else:
        plan = plan.withColumn("watermark", F.lit(watermark).cast("string"))
    pieces = [
        F.concat(F.lit(f"{params[c]}="), F.url_encode(F.col(c).cast("string"))) for c in columns
    ]
    if fixed:
        pieces.append(F.lit(fixed))
    pieces.append(F.concat(F.lit(f"{watermark_param}="), F.col("watermark")))
    parts = [_file_part(F.col(c).cast("string")) for c in columns]
    if poll:
        parts.append(_file_part(F.lit(poll)))
    return plan.select(
        *columns,
        F.concat(F.concat_ws("_", *parts), F.lit(suffix)).alias("file_name"),
        F.concat_ws("&", *pieces).alias("parameters"),
    )


def _file_part(text: Column) -> Column:
    for mark, code in (("%", "%25"), ("_", "%5F"), ("/", "%2F")):
        text = F.replace(text, F.lit(mark), F.lit(code))
    return text
