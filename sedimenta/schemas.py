"""Declared shapes of the landed documents.

Fixed values: the roots, field names and types below are those of the source
system's JSON. Each document is one object whose root field is the array of records.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql.types import ArrayType, DataType, StructField, StructType

_TRANSLATIONS = "translations ARRAY<STRUCT<locale: STRING, property: STRING, value: STRING>>"

RECORD_DDL = {
    "categories": "id STRING, dataDimensionType STRING",
    "categoryOptions": (
        "id STRING, name STRING, categoryOptionCombos ARRAY<STRUCT<id: STRING>>"
    ),
    "categoryOptionGroups": (
        "id STRING, name STRING, categoryOptions ARRAY<STRUCT<id: STRING>>"
    ),
    "dataElementGroups": "id STRING, name STRING, dataElements ARRAY<STRUCT<id: STRING>>",
    "organisationUnitGroups": (
        "id STRING, name STRING, organisationUnits ARRAY<STRUCT<id: STRING>>"
    ),
    "dimensions": (
        "dimensionType STRING, id STRING, name STRING, items ARRAY<STRUCT<id: STRING>>"
    ),
    "dataElements": (
        "id STRING, lastUpdated STRING, href STRING, created STRING, name STRING, "
        "shortName STRING, code STRING, displayFormName STRING, displayName STRING, "
        "displayShortName STRING, externalAccess BOOLEAN, dimensionItem STRING, "
        f"{_TRANSLATIONS}, aggregationType STRING, publicAccess STRING, "
        "description STRING, valueType STRING, domainType STRING, formName STRING, "
        "displayDescription STRING, zeroIsSignificant BOOLEAN, url STRING, "
        "favorite BOOLEAN, optionSetValue BOOLEAN, dimensionItemType STRING"
    ),
    "organisationUnits": (
        "id STRING, lastUpdated STRING, href STRING, level BIGINT, created STRING, "
        "name STRING, shortName STRING, code STRING, leaf BOOLEAN, path STRING, "
        "displayFormName STRING, displayName STRING, displayShortName STRING, "
        "favorite BOOLEAN, externalAccess BOOLEAN, openingDate STRING, "
        f"dimensionItem STRING, parent STRUCT<id: STRING>, {_TRANSLATIONS}, "
        "geometry STRUCT<coordinates: ARRAY<STRING>>, programs ARRAY<STRUCT<id: STRING>>"
    ),
    "users": (
        "displayName STRING, email STRING, firstName STRING, id STRING, "
        "languages STRING, name STRING, surname STRING, "
        "userCredentials STRUCT<lastLogin: STRING, disabled: BOOLEAN, username: STRING>"
    ),
    "dataSets": "id STRING",
    "dataValues": (
        "dataElement STRING, period STRING, orgUnit STRING, categoryOptionCombo STRING, "
        "attributeOptionCombo STRING, value STRING, storedBy STRING, created STRING, "
        "lastUpdated STRING, comment STRING, followup BOOLEAN"
    ),
    "events": (
        "program STRING, event STRING, programStage STRING, orgUnit STRING, "
        "trackedEntityInstance STRING, enrollment STRING, enrollmentStatus STRING, "
        "status STRING, orgUnitName STRING, eventDate STRING, lastUpdated STRING, "
        "created STRING, deleted BOOLEAN, dataValues ARRAY<STRUCT<dataElement: STRING, "
        "value: STRING, lastUpdated: STRING>>"
    ),
    "trackedEntityInstances": (
        "created STRING, lastUpdated STRING, orgUnit STRING, inactive BOOLEAN, "
        "deleted BOOLEAN, trackedEntityInstance STRING, "
        "programOwners ARRAY<STRUCT<program: STRING>>, "
        "attributes ARRAY<STRUCT<code: STRING, value: STRING>>"
    ),
}


def document_schema(root: str, columns: Sequence[str] | None = None, sep: str = "_") -> StructType:
    """A document's schema; with ``columns`` (flat names) only what leads to them.

    The JSON parser skips what is not declared, so this is the column pruning
    that Spark has for Parquet but not for JSON.
    """
    record = StructType.fromDDL(RECORD_DDL[root])
    if columns is not None:
        record = _pruned(record, root, list(columns), sep)
    return StructType([StructField(root, ArrayType(record))])


def _pruned(dtype: DataType, name: str, columns: list[str], sep: str) -> DataType:
    if isinstance(dtype, ArrayType):
        return ArrayType(_pruned(dtype.elementType, name, columns, sep))
    if not isinstance(dtype, StructType):
        return dtype
    fields = []
    for field in dtype.fields:
        flat = f"{name}{sep}{field.name}"
        if any(c == flat or c.startswith(flat + sep) for c in columns):
            fields.append(StructField(field.name, _pruned(field.dataType, flat, columns, sep)))
    return StructType(fields)
