"""What landed documents hold against what is declared, from one scan.

Documents are read as text, each becomes a VARIANT, and ``schema_of_variant_agg`` gives
the least schema of all of them: nothing is inferred twice and nothing declared hides what
is there. The comparison of the two schemas is made on the driver, as both are as small as
the documents' structure.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, NullType, StructType, VariantType, _parse_datatype_string

UNDECLARED, ABSENT, OTHER_TYPE = "undeclared", "absent", "other type"
#: Types that a declared text takes as they are written, so no drift.
_TEXT = "string"


def landed_schema(spark: SparkSession, path: str | Sequence[str]) -> tuple[DataType, int, int]:
    """The least schema of the JSON documents below a path (one a line), how many documents
    there are, and how many are no JSON.

    A field that holds things of no common type is VARIANT; one that is always null VOID.
    """
    lines = spark.read.option("recursiveFileLookup", "true").text(path).filter(F.trim("value") != "")
    documents = lines.select(F.try_parse_json("value").alias("document"))
    row = documents.agg(
        F.schema_of_variant_agg("document").alias("found"),
        F.count(F.lit(1)).alias("n"),
        F.count("document").alias("n_read"),
    ).first()
    return _plain_type(row["found"]), row["n"], row["n"] - row["n_read"]


def _plain_type(text: str) -> DataType:
    """The type that the aggregate writes; what it calls an OBJECT is a struct."""
    outside = re.split(r"(`(?:[^`]|``)*`)", text)  # names in backticks stay as they are
    parts = [p if p.startswith("`") else re.sub(r"\bOBJECT<", "STRUCT<", p) for p in outside]
    return _parse_datatype_string("".join(parts))


def drift(declared: DataType, landed: DataType, at: str = "") -> list[tuple[str, str, str | None, str | None]]:
    """(path, kind, declared type, landed type) of every field in which the two differ.

    Fields of an undeclared struct are one entry; elements of arrays have ``[]`` in their path.
    """
    if isinstance(landed, NullType):
        return []
    if isinstance(declared, StructType) and isinstance(landed, StructType):
        out = []
        held = {f.name: f.dataType for f in landed.fields}
        known = {f.name for f in declared.fields}
        for field in declared.fields:
            path = f"{at}.{field.name}".lstrip(".")
            if field.name in held:
                out += drift(field.dataType, held[field.name], path)
            else:
                out.append((path, ABSENT, field.dataType.simpleString(), None))
        out += [
            (f"{at}.{n}".lstrip("."), UNDECLARED, None, t.simpleString()) for n, t in held.items() if n not in known
        ]
        return out
    if isinstance(declared, ArrayType) and isinstance(landed, ArrayType):
        return drift(declared.elementType, landed.elementType, f"{at}[]")
    if _fits(declared, landed):
        return []
    return [(at, OTHER_TYPE, declared.simpleString(), landed.simpleString())]


def _fits(declared: DataType, landed: DataType) -> bool:
    """Does the parser take such a value for the declared type?"""
    want, got = declared.typeName(), landed.typeName()
    if isinstance(landed, VariantType):
        return False
    numbers = ("byte", "short", "integer", "long", "decimal", "double", "float")
    if want == _TEXT:
        return not isinstance(landed, (StructType, ArrayType))
    if want in ("double", "float", "decimal"):
        return got in numbers
    if want in numbers:
        return got in numbers[:4] or (got == "decimal" and landed.scale == 0)
    return want == got


def landing_drift(spark: SparkSession, path: str | Sequence[str], declared: StructType) -> DataFrame:
    """``path``, ``kind``, ``declared``, ``landed`` of every difference; documents that are no
    JSON are counted under the kind ``unreadable``, their number being ``landed``."""
    found, _, unreadable = landed_schema(spark, path)
    rows = drift(declared, found)
    if unreadable:
        rows.append(("", "unreadable", None, str(unreadable)))
    return spark.createDataFrame(rows, "path string, kind string, declared string, landed string")
