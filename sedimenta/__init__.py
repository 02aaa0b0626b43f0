"""Layered health-programme analytics on PySpark.

Landed JSON documents become flat, typed tables; keyed facts are kept current
by incremental upserts (batch or file stream); code lists are joined to their
group members to give the curated dimensions.
"""

from sedimenta.functions.scalars import (
    array_text,
    contact_address,
    iso_date,
    iso_text,
    iso_timestamp,
    null_when,
    split_point,
    translation_key,
)
from sedimenta.operators.columns import drop_null, project, rename, sorted_projection
from sedimenta.operators.dimensions import dimension_members, dimension_members_2hop
from sedimenta.operators.flatten import flatten
from sedimenta.operators.pivot import pivot_translations, spread_translations
from sedimenta.operators.requests import id_list, request_plan
from sedimenta.operators.upsert import latest_per_key, merge_into, require_unique, upsert
from sedimenta.operators.watermark import active_only, changed_since, high_watermark, max_of
from sedimenta.session import build_session, freed_scratch, scratch_path, stage
from sedimenta.sources.landing import (
    has_records,
    land,
    read_landing,
    records,
    schema_drift,
    unreadable_documents,
)
from sedimenta.sources.tables import (
    compact_table,
    expire_snapshots,
    load_incremental,
    overwrite_snapshot,
    read_table,
    table_exists,
    table_view,
    write_curated,
)

__all__ = [
    "active_only",
    "array_text",
    "build_session",
    "changed_since",
    "compact_table",
    "contact_address",
    "dimension_members",
    "dimension_members_2hop",
    "drop_null",
    "expire_snapshots",
    "flatten",
    "freed_scratch",
    "has_records",
    "high_watermark",
    "id_list",
    "iso_date",
    "iso_text",
    "iso_timestamp",
    "land",
    "latest_per_key",
    "load_incremental",
    "max_of",
    "merge_into",
    "null_when",
    "overwrite_snapshot",
    "pivot_translations",
    "project",
    "read_landing",
    "read_table",
    "records",
    "rename",
    "request_plan",
    "require_unique",
    "schema_drift",
    "scratch_path",
    "sorted_projection",
    "split_point",
    "spread_translations",
    "stage",
    "table_exists",
    "table_view",
    "translation_key",
    "unreadable_documents",
    "upsert",
    "write_curated",
]
