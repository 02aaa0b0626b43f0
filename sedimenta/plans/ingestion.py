"""The twelve extracts as data, and the request rows of the incremental three.

Nothing is fetched here. An extract says which fields of which collection land
in which file; what lands is read by the jobs in :mod:`sedimenta.plans.enrichment`.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from sedimenta.operators.requests import id_list, request_plan
from sedimenta.operators.watermark import high_watermark
from sedimenta.schemas import document_schema
from sedimenta.sources.landing import read_landing, schema_drift
from sedimenta.sources.tables import read_table, table_exists


@dataclass(frozen=True)
class Extract:
    """One collection of the source system and where it lands.

    ``params`` maps key columns to request parameters; it is empty for an
    extract that is one document.
    """

    collection: str
    folder: str
    file_name: str | None = None
    fields: str = "*"
    params: Mapping[str, str] = field(default_factory=dict)
    fixed: str = ""
    watermark_param: str | None = None

    @property
    def root(self) -> str:
        return self.collection


_EVERYTHING = "skipPaging=true&includeDeleted=true&fields=*&totalPages=true"

# Collections, fields, parameters, folders and file names.
EXTRACTS = {
    extract.folder: extract
    for extract in (
        Extract("categories", "categories", "categories.json", "id,dataDimensionType"),
        Extract(
            "categoryOptions", "categoryOptions", "categoryOptions.json",
            "id,categoryOptionCombos,name",
        ),
        Extract(
            "categoryOptionGroups", "categoryOptionGroups", "categoryOptionGroups.json",
            "id,name,categoryOptions",
        ),
        Extract(
            "dataElementGroups", "dataElementGroups", "dataElementGroups.json",
            "id,name,dataElements",
        ),
        Extract("dataElements", "dataelement", "dataelement.json"),
        Extract("dimensions", "dimension", "dimension.json", "id,name,dimensionType,items"),
        Extract(
            "organisationUnitGroups", "organisationUnitGroups", "organisationUnitGroups.json",
            "id,name,organisationUnits",
        ),
        Extract("organisationUnits", "orgunit", "orgunit.json"),
        Extract("users", "users", "users.json"),
        Extract(
            "dataValues",
            "dataElement-values",
            params={"organisationUnitGroup": "orgUnitGroup", "dataSet": "dataSet"},
            fixed=_EVERYTHING,
            watermark_param="lastUpdated",
        ),
        Extract(
            "events",
            "events",
            params={"organisationUnit": "orgUnit"},
            fixed=_EVERYTHING,
            watermark_param="lastUpdatedStartDate",
        ),
        Extract(
            "trackedEntityInstances",
            "trackedentityinstances",
            params={"program": "program"},
            fixed="ouMode=ALL&includeDeleted=true&fields=*&skipPaging=true",
            watermark_param="lastUpdatedStartDate",
        ),
    )
}


# Fixed value: where the list of data sets lands.
DATA_SETS = "dataSets/dataSets.json"


def extract_keys(
    spark: SparkSession, folder: str, landing_root: str, pairs: DataFrame | None = None
) -> DataFrame:
    """The ids to ask for, from what has landed: units for events, programs for instances.

    Data values are asked for by unit group and data set. ``pairs`` says which data sets
    are assigned to which groups (``organisationUnitGroup``, ``dataSet``); asked for are
    those whose group and data set have both landed. The product of the two lists would
    grow with the square of the ids and is not made.
    """
    if folder == "dataElement-values":
        if pairs is None:
            raise ValueError(f"{folder} needs the assigned pairs of groups and data sets")
        groups = EXTRACTS["organisationUnitGroups"]
        lists = {
            "organisationUnitGroup": (f"{groups.folder}/{groups.file_name}", groups.root),
            "dataSet": (DATA_SETS, "dataSets"),
        }
        asked = pairs.select(*lists).distinct()
        for column, (path, root) in lists.items():
            schema = document_schema(root, [f"{root}_id"])
            known = id_list(read_landing(spark, f"{landing_root}/{path}", schema), root, alias=column)
            asked = asked.join(known, column, "left_semi")
        return asked.select(*lists)
    units = f"{landing_root}/{EXTRACTS['orgunit'].folder}/{EXTRACTS['orgunit'].file_name}"
    if folder == "events":
        schema = document_schema("organisationUnits", ["organisationUnits_id"])
        array, name = "organisationUnits", "organisationUnit"
    elif folder == "trackedentityinstances":
        schema = document_schema("organisationUnits", ["organisationUnits_programs_id"])
        array, name = "organisationUnits.programs", "program"
    else:
        raise ValueError(f"{folder} is one document and has no keys")
    return id_list(read_landing(spark, units, schema), array, alias=name)


def plan_extract(
    spark: SparkSession,
    folder: str,
    enriched_root: str,
    keys: DataFrame,
    watermark: str | DataFrame | None = None,
    poll: str | None = None,
) -> DataFrame:
    """Request rows for an incremental extract, from the mark of its table on.

    ``poll`` tells this round's files from those of other rounds, as the stream needs.

    ``keys`` has a column for each of the extract's parameters. Before the
    first load there is no mark and everything is asked for.
    """
    extract = EXTRACTS[folder]
    table = f"{enriched_root}/{folder}"
    if watermark is None and table_exists(spark, table):
        watermark = high_watermark(read_table(spark, table), "lastUpdated")
    return request_plan(
        keys,
        extract.params,
        fixed=extract.fixed,
        watermark=watermark,
        watermark_param=extract.watermark_param,
        poll=poll,
    )


def check_landing(spark: SparkSession, folder: str, landing_root: str) -> dict[str, list[str]]:
    """Which fields landed that are not declared, and which declared ones did not."""
    extract = EXTRACTS[folder]
    path = f"{landing_root}/{extract.folder}/{extract.file_name or ''}"
    return schema_drift(spark, path, document_schema(extract.root))
