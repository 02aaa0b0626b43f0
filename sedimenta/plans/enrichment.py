"""Landed documents to flat tables. Each table is a job description, not a script."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.functions.scalars import (
    array_text,
    contact_address,
    iso_date,
    iso_timestamp,
    null_when,
)
from sedimenta.operators.columns import drop_null, project
from sedimenta.operators.flatten import flatten
from sedimenta.operators.pivot import spread_translations, translation_names
from sedimenta.schemas import document_schema
from sedimenta.sources.landing import has_records, read_landing, records
from sedimenta.sources.tables import load_incremental, overwrite_snapshot

SEP = "_"
#: Hash buckets of a new table, and of each partition of one that is partitioned too.
TABLE_BUCKETS, PARTITION_BUCKETS = 64, 4
# Fixed value: coordinates are kept for units of this level only.
POINT_LEVEL = 4


@dataclass(frozen=True)
class EnrichmentJob:
    """How the documents under one root become a table.

    ``fields`` names the flat columns wanted (without the root), ``renamed``
    those that get another name than their own. A job with ``keys`` is merged
    into its table, one without replaces it.
    """

    name: str
    root: str
    source: str
    fields: tuple[str, ...]
    renamed: Mapping[str, str] = field(default_factory=dict)
    dates: tuple[str, ...] = ()
    timestamps: tuple[str, ...] = ()
    translations: str | None = None
    texts: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    finish: Callable[[DataFrame], DataFrame] | None = None
    keys: tuple[str, ...] = ()
    order_by: str | None = None
    on_duplicate: str = "error"
    partition_by: tuple[str, ...] = ()
    bucket_by: tuple[str, ...] = ()

    @property
    def columns(self) -> dict[str, str]:
        """Flat name to table column, in table order."""
        return {f"{self.root}{SEP}{f}": self.renamed.get(f, f) for f in self.fields}

    def schema(self):
        paths = list(self.columns)
        if self.translations:
            cells = ("locale", "property", "value")
            paths += [f"{self.root}{SEP}{self.translations}{SEP}{c}" for c in cells]
        return document_schema(self.root, paths, SEP)


def _keep_points(df: DataFrame) -> DataFrame:
    return df.withColumn("coordinates", null_when("coordinates", F.col("level") != POINT_LEVEL))


def _add_contact(df: DataFrame) -> DataFrame:
    return df.withColumn("Distribution", contact_address("username", "email"))


def _membership(name: str, member: str, *, source: str | None = None) -> EnrichmentJob:
    return EnrichmentJob(name, name, source or f"{name}/{name}.json", ("id", "name", member))


# Folders, field lists, column names and keys of the twelve tables.
JOBS = {
    job.name: job
    for job in (
        EnrichmentJob(
            "categories", "categories", "categories/categories.json", ("id", "dataDimensionType")
        ),
        _membership("categoryOptions", "categoryOptionCombos_id"),
        _membership("categoryOptionGroups", "categoryOptions_id"),
        _membership("dataElementGroups", "dataElements_id"),
        _membership("organisationUnitGroups", "organisationUnits_id"),
        EnrichmentJob(
            "dimension",
            "dimensions",
            "dimension/dimension.json",
            ("dimensionType", "id", "name", "items_id"),
        ),
        EnrichmentJob(
            "users",
            "users",
            "users/users.json",
            (
                "displayName", "email", "firstName", "id", "languages", "name", "surname",
                "userCredentials_lastLogin", "userCredentials_disabled",
                "userCredentials_username",
            ),
            renamed={
                "userCredentials_lastLogin": "lastLogin",
                "userCredentials_disabled": "disabled",
                "userCredentials_username": "username",
            },
            dates=("lastLogin",),
            finish=_add_contact,
        ),
        EnrichmentJob(
            "dataelement",
            "dataElements",
            "dataelement/dataelement.json",
            (
                "id", "lastUpdated", "href", "created", "name", "shortName", "code",
                "displayFormName", "displayName", "displayShortName", "externalAccess",
                "dimensionItem", "aggregationType", "publicAccess", "description",
                "valueType", "domainType", "formName", "displayDescription",
                "zeroIsSignificant", "url", "favorite", "optionSetValue",
                "dimensionItemType",
            ),
            translations="translations",
        ),
        EnrichmentJob(
            "orgunit",
            "organisationUnits",
            "orgunit/orgunit.json",
            (
                "id", "lastUpdated", "href", "level", "created", "name", "shortName", "code",
                "leaf", "path", "displayFormName", "displayName", "displayShortName",
                "favorite", "externalAccess", "openingDate", "dimensionItem", "parent_id",
                "geometry_coordinates",
            ),
            renamed={"geometry_coordinates": "coordinates"},
            translations="translations",
            texts=("coordinates",),
            finish=_keep_points,
        ),
        EnrichmentJob(
            "dataElement-values",
            "dataValues",
            "dataElement-values",
            (
                "dataElement", "period", "orgUnit", "categoryOptionCombo",
                "attributeOptionCombo", "value", "storedBy", "created", "lastUpdated",
                "comment", "followup",
            ),
            renamed={
                "dataElement": "dataElement_id",
                "categoryOptionCombo": "categoryOptionCombo_id",
                "attributeOptionCombo": "attributeOptionCombo_id",
            },
            timestamps=("created", "lastUpdated"),
            keys=(
                "dataElement_id", "categoryOptionCombo_id", "attributeOptionCombo_id",
                "period", "orgUnit",
            ),
            order_by="lastUpdated",
            on_duplicate="latest",
            partition_by=("period",),
            bucket_by=("orgUnit",),
        ),
        EnrichmentJob(
            "events",
            "events",
            "events",
            (
                "program", "event", "programStage", "orgUnit", "trackedEntityInstance",
                "enrollment", "enrollmentStatus", "status", "orgUnitName", "eventDate",
                "lastUpdated", "created", "deleted", "dataValues_dataElement",
                "dataValues_value",
            ),
            renamed={"dataValues_dataElement": "dataElement"},
            dates=("eventDate",),
            timestamps=("lastUpdated", "created"),
            keys=("event", "dataElement"),
            order_by="lastUpdated",
            on_duplicate="latest",
            bucket_by=("event",),
        ),
        EnrichmentJob(
            "trackedentityinstances",
            "trackedEntityInstances",
            "trackedentityinstances",
            (
                "programOwners_program", "created", "lastUpdated", "orgUnit", "inactive",
                "deleted", "attributes_code", "attributes_value", "trackedEntityInstance",
            ),
            renamed={"programOwners_program": "program"},
            timestamps=("created", "lastUpdated"),
            required=("attributes_code",),
            keys=("trackedEntityInstance", "attributes_code", "program"),
            order_by="lastUpdated",
            on_duplicate="latest",
            bucket_by=("trackedEntityInstance",),
        ),
    )
}


def enrich(
    job: EnrichmentJob | str,
    documents: DataFrame,
    *,
    locales: list[str] | None = None,
    spread: int | str | None = None,
    on_duplicate: str | None = None,
) -> DataFrame:
    """The table rows held in ``documents``, before any merge with older ones.

    Rows are made distinct as landed, before texts become dates. Where the load
    keeps one row per key anyhow (``"latest"``), that shuffle is left out.
    """
    job = JOBS[job] if isinstance(job, str) else job
    root = records(documents, job.root, spread)
    if job.translations:
        rows = _spread_job(job, root, locales)
    else:
        flat = flatten(root, SEP, columns=list(job.columns))
        rows = project(flat, job.columns)
        if (on_duplicate or job.on_duplicate) != "latest":
            rows = rows.distinct()
    casts = {c: iso_date(c) for c in job.dates}
    casts |= {c: iso_timestamp(c) for c in job.timestamps}
    if casts:
        rows = rows.withColumns(casts)
    if job.required:
        rows = drop_null(rows, job.required)
    return rows if job.translations or job.finish is None else job.finish(rows)


def _spread_job(job: EnrichmentJob, root: DataFrame, locales: list[str] | None) -> DataFrame:
    """Records whose translations become columns; their array is never exploded."""
    array = f"{job.root}{SEP}{job.translations}"
    by_name = {name: flat for flat, name in job.columns.items()}
    flat = flatten(
        root, SEP, columns=[*job.columns, array], keep={array, *(by_name[t] for t in job.texts)}
    )
    rows = project(flat, {**job.columns, array: "_translations"})
    if job.texts:
        rows = rows.withColumns({t: array_text(t) for t in job.texts})
    if job.finish:
        rows = job.finish(rows)
    return spread_translations(rows, list(job.columns.values()), "_translations", locales)


def load(
    job: EnrichmentJob | str,
    rows: DataFrame,
    path: str,
    *,
    buckets: int | None = None,
    on_duplicate: str | None = None,
    newer_only: bool = False,
) -> int | None:
    """Publish a job's rows: merge them if the job has keys, else replace the table.

    NULL key parts match each other here, so that an event without data values
    is one row however often it is loaded. ``buckets`` is how many hash buckets a
    new table has, in each partition if it has any; it stays so for good, so name
    it for a large one. A table that exists keeps its layout.
    """
    job = JOBS[job] if isinstance(job, str) else job
    if not job.keys:
        return overwrite_snapshot(rows, path)
    default = PARTITION_BUCKETS if job.partition_by else TABLE_BUCKETS
    layout = {
        "partition_by": job.partition_by,
        "buckets": buckets or default,
        "bucket_by": job.bucket_by,
    }
    return load_incremental(
        rows,
        path,
        job.keys,
        order_by=job.order_by,
        on_duplicate=on_duplicate or job.on_duplicate,
        null_safe=True,
        newer_only=job.order_by if newer_only else None,
        **layout,
    )


def find_locales(
    spark: SparkSession,
    job: EnrichmentJob,
    path: str,
    multiline: bool = False,
    unreadable: str = "fail",
) -> list[str]:
    """The translation columns the landed documents call for.

    The documents are read with a schema of the two key fields only, so that
    this extra pass does not parse the records in full.
    """
    array = f"{job.root}{SEP}{job.translations}"
    cells = [f"{array}{SEP}property", f"{array}{SEP}locale"]
    documents = read_landing(
        spark,
        path,
        document_schema(job.root, cells, SEP),
        multiline=multiline,
        unreadable=unreadable,
    )
    return translation_names(flatten(records(documents, job.root), SEP, columns=cells), *cells)


def run_enrichment(
    spark: SparkSession,
    name: str,
    landing_root: str,
    enriched_root: str,
    *,
    source: str | None = None,
    locales: list[str] | None = None,
    spread: int | str | None = None,
    multiline: bool = False,
    unreadable: str = "fail",
    **options,
) -> int | None:
    """Run one job from the landing zone to its table; None if nothing has landed.

    A job that replaces its table does not replace it by nothing: without a single
    record it fails. Its document is one row, so its records are spread by their size
    unless ``spread`` says how. ``unreadable`` is that of ``read_landing``.
    """
    job = JOBS[name]
    path = f"{landing_root}/{source or job.source}"
    documents = read_landing(
        spark, path, job.schema(), multiline=multiline, unreadable=unreadable
    )
    if not has_records(documents, job.root):
        if job.keys:
            return None
        raise ValueError(f"no record below {path}: table {name} stays as it is")
    if spread is None and not job.keys:
        spread = "auto"
    if job.translations and locales is None:
        locales = find_locales(spark, job, path, multiline, unreadable)
    rows = enrich(
        job, documents, locales=locales, spread=spread, on_duplicate=options.get("on_duplicate")
    )
    return load(job, rows, f"{enriched_root}/{name}", **options)
