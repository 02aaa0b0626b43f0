"""Flat tables to the curated layer: 23 dimensions and 4 plain outputs."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.functions.scalars import split_point
from sedimenta.operators.columns import sorted_projection
from sedimenta.operators.dimensions import (
    dimension_members,
    dimension_members_2hop,
    members_of_lists,
)
from sedimenta.operators.star import Link, star_report
from sedimenta.session import freed_scratch, scratch_path
from sedimenta.sources import storage
from sedimenta.sources.tables import read_table, write_curated

MEMBER = {
    "organisationUnitGroups": "organisationUnits_id",
    "categoryOptions": "categoryOptionCombos_id",
    "dataElementGroups": "dataElements_id",
}


@dataclass(frozen=True)
class Dimension:
    """A curated dimension: the code list's name, where its members lie, its folder."""

    name: str
    bridge: str
    sink: str
    through: str | None = None
    member_alias: str | None = None
    distinct: bool = False

    @property
    def inputs(self) -> tuple[str, ...]:
        hops = (self.through, self.bridge) if self.through else (self.bridge,)
        return ("dimension", *hops)

    def build(self, tables: Mapping[str, DataFrame], strategy: str = "auto") -> DataFrame:
        options = {
            "name": self.name,
            "member": MEMBER[self.bridge],
            "distinct": self.distinct,
            "member_alias": self.member_alias,
            "strategy": strategy,
        }
        if self.through:
            return dimension_members_2hop(
                tables["dimension"], tables[self.through], tables[self.bridge], **options
            )
        return dimension_members(tables["dimension"], tables[self.bridge], **options)


@dataclass(frozen=True)
class Output:
    """A curated table made from a single flat table."""

    name: str
    table: str
    sink: str
    make: Callable[[DataFrame], DataFrame]

    @property
    def inputs(self) -> tuple[str, ...]:
        return (self.table,)

    def build(self, tables: Mapping[str, DataFrame], strategy: str = "auto") -> DataFrame:
        return self.make(tables[self.table])


VALUE_COLUMNS = (
    "dataElement_id", "categoryOptionCombo_id", "attributeOptionCombo_id", "period",
    "orgUnit", "value",
)


def curate_values(df: DataFrame, project: bool = False) -> DataFrame:
    """The fact table as it is, or only its key columns and value."""
    return df.select(*VALUE_COLUMNS) if project else df


def curate_data_elements(df: DataFrame) -> DataFrame:
    return sorted_projection(df, ["name", "code", "id", "shortName"], by="name")


def curate_org_units(df: DataFrame) -> DataFrame:
    return df.withColumns(split_point("coordinates")).select(
        "code", "name", "id", "shortName", "path", "level", "parent_id", "lat", "long"
    )


_UNITS, _COMBOS, _ELEMENTS = "organisationUnitGroups", "categoryOptions", "dataElementGroups"
_BY_ATTRIBUTE = "attributeOptionCombo_id"

# Code list names, bridges and output folders of the curated layer.
DIMENSIONS = (
    Dimension("Area", _UNITS, "Area"),
    Dimension("Facility Ownership", _UNITS, "Facility_Ownership"),
    Dimension("Facility Type", _UNITS, "Facility_Type"),
    Dimension("Location Rural/Urban", _UNITS, "Location_Rural_Urban"),
    Dimension("Commodities", _COMBOS, "Commodities"),
    Dimension("EPI/nutrition age", _COMBOS, "EPI_nutrition_age"),
    Dimension("Gender", _COMBOS, "Gender"),
    Dimension("HIV age", _COMBOS, "HIV_age"),
    Dimension(
        "Implementing Partner", _COMBOS, "Implementing_Partner", member_alias=_BY_ATTRIBUTE
    ),
    Dimension("Location Fixed/Outreach", _COMBOS, "Location_Fixed_Outreach"),
    Dimension("Morbidity Age", _COMBOS, "Morbidity_Age"),
    Dimension("Pregnant/Non-pregnant", _COMBOS, "Pregnant_Non-pregnant"),
    Dimension("Project", _COMBOS, "Project", member_alias=_BY_ATTRIBUTE),
    Dimension("Referrals Age", _COMBOS, "Referrals_Age"),
    Dimension("Rural and Urban", _COMBOS, "Rural_and_Urban"),
    Dimension("Target vs Result", _COMBOS, "TargetvsResult"),
    Dimension("Diagnosis", _ELEMENTS, "Diagnosis", distinct=True),
    Dimension(
        "Main data element groups", _ELEMENTS, "Main_data_element_groups", distinct=True
    ),
    Dimension("Morbidity/Mortality", _ELEMENTS, "Morbidity_Mortality", distinct=True),
    Dimension("PMTCT", _ELEMENTS, "PMTCT", distinct=True),
    Dimension("Tracker-based data", _ELEMENTS, "Tracker-based_data", distinct=True),
    Dimension("Donor", _COMBOS, "Donor", through="categoryOptionGroups"),
    Dimension("Funding Agency", _COMBOS, "Funding_Agency", through="categoryOptionGroups"),
)
OUTPUTS = (
    Output("DataElement Data Values", "dataElement-values", "dataElement-values", curate_values),
    Output("DataElements", "dataelement", "dataelement", curate_data_elements),
    Output("Org Unit", "orgunit", "OrganisationUnits", curate_org_units),
    Output("users", "users", "users", lambda df: df),
)
JOBS = {job.name: job for job in (*DIMENSIONS, *OUTPUTS)}

# Fact column to the dimensions' column, and the sinks that carry it.
FACT_LINKS = {
    "orgUnit": {
        "organisationUnits_id": [d.sink for d in DIMENSIONS if d.bridge == _UNITS],
        "id": ["OrganisationUnits"],
    },
    "categoryOptionCombo_id": {
        "categoryOptionCombos_id": [
            d.sink for d in DIMENSIONS if d.bridge == _COMBOS and not d.member_alias
        ],
    },
    "attributeOptionCombo_id": {
        _BY_ATTRIBUTE: [d.sink for d in DIMENSIONS if d.member_alias],
    },
    "dataElement_id": {
        "dataElements_id": [d.sink for d in DIMENSIONS if d.bridge == _ELEMENTS],
        "id": ["dataelement"],
    },
}
_FACT = "DataElement Data Values"
#: Places after the point of the values that a report adds up.
VALUE_PLACES = 6


def curate(name: str, tables: Mapping[str, DataFrame], strategy: str = "auto") -> DataFrame:
    """The curated table ``name`` from the flat tables it needs."""
    return JOBS[name].build(tables, strategy)


def star(
    spark: SparkSession,
    curated_root: str,
    names: Sequence[str],
    by: Sequence[str] = ("period",),
    sharing: str = "each",
) -> DataFrame:
    """Data values by the groups of several curated dimensions, as ``star_report`` counts them.

    ``names`` are those of dimensions. ``n_facts`` counts values, ``value`` adds up those
    that are numbers, as decimals with ``VALUE_PLACES`` places. What :func:`run_dimensions`
    and the values' own job have written is read.
    """
    wanted = [JOBS[name] for name in names]
    folders = {
        sink: (key, member)
        for key, members in FACT_LINKS.items()
        for member, sinks in members.items()
        for sink in sinks
    }
    unknown = [d.name for d in wanted if not isinstance(d, Dimension)]
    if unknown:
        raise ValueError(f"no dimension with groups: {', '.join(unknown)}")
    links = {
        d.sink: Link(spark.read.parquet(f"{curated_root}/{d.sink}"), *folders[d.sink]) for d in wanted
    }
    fact = spark.read.parquet(f"{curated_root}/{JOBS[_FACT].sink}")
    number = F.col("value").try_cast(f"decimal(28,{VALUE_PLACES})")
    return star_report(fact.withColumn("value", number), links, ["value"], by, sharing)


def run_curated(
    spark: SparkSession, name: str, enriched_root: str, curated_root: str, strategy: str = "auto"
) -> str:
    """Read a job's inputs, build it, write it; returns the folder written."""
    job = JOBS[name]
    tables = {t: read_table(spark, f"{enriched_root}/{t}") for t in job.inputs}
    path = f"{curated_root}/{job.sink}"
    with freed_scratch():
        write_curated(job.build(tables, strategy), path)
    return path


def run_dimensions(
    spark: SparkSession,
    enriched_root: str,
    curated_root: str,
    names: Sequence[str] | None = None,
    strategy: str = "auto",
) -> list[str]:
    """Write many dimensions, reading each bridge once and not once per dimension.

    All lists that share a bridge are looked up together; the result is staged by
    list, and each dimension is written from its own part of it.
    """
    unknown = set(names or ()) - {d.name for d in DIMENSIONS}
    if unknown:
        raise KeyError(f"no such dimension: {', '.join(sorted(unknown))}")
    wanted = [d for d in DIMENSIONS if names is None or d.name in names]
    with freed_scratch():
        return _write_dimensions(spark, enriched_root, curated_root, wanted, strategy)


def _write_dimensions(spark, enriched_root, curated_root, wanted, strategy) -> list[str]:
    written = []
    for bridge, through in dict.fromkeys((d.bridge, d.through) for d in wanted):
        together = [d for d in wanted if (d.bridge, d.through) == (bridge, through)]
        member = MEMBER[bridge]
        groups = read_table(spark, f"{enriched_root}/{through or bridge}")
        options = read_table(spark, f"{enriched_root}/{bridge}") if through else None
        found = members_of_lists(
            read_table(spark, f"{enriched_root}/dimension"),
            groups,
            [d.name for d in together],
            member,
            options,
            strategy=strategy,
        )
        folder = scratch_path(spark, "dimensions", near=curated_root)
        try:
            found.hint("rebalance", "list_name").write.partitionBy("list_name").parquet(folder)
            schema = found.schema
            for dimension in together:
                part = spark.read.schema(schema).parquet(folder)
                part = part.filter(F.col("list_name") == dimension.name).select(
                    "name", F.col(member).alias(dimension.member_alias or member)
                )
                path = f"{curated_root}/{dimension.sink}"
                write_curated(part.distinct() if dimension.distinct else part, path)
                written.append(path)
        finally:
            storage.remove_tree(spark, folder)
    return written
