"""The same results in SQL, written independently for DuckDB."""

from __future__ import annotations

from sedimenta.plans.curated import DIMENSIONS

_MOMENT = "date_trunc('second', {})"

_CONTACTS = "list_filter(string_split(text, ' '), lambda w: contains(w, '@'))"
_NONE_AS_NULL = "CASE WHEN len({0}) = 0 THEN [NULL] ELSE {0} END"
_CONTACT_ROWS = _NONE_AS_NULL.format(_CONTACTS)

_LABELLED = """
    SELECT CASE WHEN l.doc_id IS NOT NULL THEN 'toxic ' || l.toxic END AS name, l.quality
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    WHERE d.lang = 'en'
"""

_ORDERS = "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate FROM orders"
_OLD = "o_orderdate < TIMESTAMP '1998-01-01'"
_NEW = "o_orderdate >= TIMESTAMP '1996-01-01'"
_ONE_HOP = """
    SELECT {columns}
    FROM part p LEFT JOIN lineitem l ON p.p_partkey = l.l_partkey
    WHERE p.p_brand = 'Brand#7'
"""
_NULL_KEY = f"""
    WITH o AS (
        SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'P') AS o_orderstatus, o_orderdate
        FROM orders
    ), old AS (SELECT * FROM o WHERE {_OLD}),
    new AS (
        SELECT o_orderkey, -o_custkey AS o_custkey, o_orderstatus, o_orderdate FROM o WHERE {_NEW}
    )
    SELECT * FROM new UNION ALL
    SELECT * FROM old WHERE NOT EXISTS (
        SELECT 1 FROM new WHERE new.o_orderkey = old.o_orderkey
        AND new.o_orderstatus {{same}} old.o_orderstatus)
"""
_FIXED_ALL = "skipPaging=true&includeDeleted=true&fields=*&totalPages=true"

ORACLE: dict[str, str] = {
    "q01_json_parse": """
        SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""",
    "q02_flatten_nested": f"""
        SELECT DISTINCT doc_doc_id, doc_meta_lang, doc_meta_source, doc_contacts_id,
               unnest(lines) AS doc_lines
        FROM (
            SELECT doc_id AS doc_doc_id, lang AS doc_meta_lang, source AS doc_meta_source,
                   unnest({_CONTACT_ROWS}) AS doc_contacts_id,
                   string_split(text, chr(10)) AS lines
            FROM documents)""",
    "q03_flatten_pruned": f"""
        SELECT DISTINCT doc_id AS doc_doc_id, lang AS doc_meta_lang,
               unnest({_CONTACT_ROWS}) AS doc_contacts_id
        FROM documents""",
    "q04_array_text": """
        SELECT vec_id, array_to_string(list_transform(embedding,
               lambda x: CAST(round(CAST(x AS DOUBLE) * 1000) AS BIGINT)::VARCHAR), ',')
               AS vector_text
        FROM embeddings""",
    "q05_rename_project": """
        SELECT c_custkey AS id, c_name AS name, c_name || '/' || c_mktsegment AS label
        FROM customer""",
    "q12_iso_timestamp": f"SELECT event_id, {_MOMENT.format('ts')} AS ts FROM events",
    "q13_iso_date": "SELECT event_id, CAST(ts AS DATE) AS day FROM events",
    "q14_null_when": """
        SELECT event_id, CASE WHEN event_type = 'purchase' THEN value END AS value FROM events""",
    "q15_split_point": """
        SELECT c_custkey, split_part(p, ',', 1) AS long, split_part(p, ',', -1) AS lat
        FROM (SELECT c_custkey, c_nationkey || ',' || c_mktsegment || ',' || c_custkey AS p
              FROM customer)""",
    "q16_contact_address": """
        SELECT doc_id, CASE WHEN contains(source, '@') THEN source || ';'
                            WHEN contains(text, '@') THEN text || ';' ELSE '' END AS contact
        FROM documents""",
    "q18_sorted_projection": "SELECT p_name, p_brand, p_partkey FROM part ORDER BY p_name",
    "q27_size_guard": f"""
        SELECT lang, count(*) AS n_docs, CAST(sum(len(c)) AS BIGINT) AS n_contacts
        FROM (SELECT lang, {_CONTACTS} AS c FROM documents) WHERE len(c) >= 1 GROUP BY lang""",
    "q06_dimension_1hop": _ONE_HOP.format(columns="l.l_returnflag AS name, l.l_suppkey"),
    "q06_dimension_split_join": _ONE_HOP.format(columns="l.l_returnflag AS name, l.l_suppkey"),
    "q07_dimension_2hop": """
        SELECT l.l_returnflag AS name, o.o_custkey
        FROM part p LEFT JOIN lineitem l ON p.p_partkey = l.l_partkey
        LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
        WHERE p.p_brand = 'Brand#7'""",
    "q08_dimension_distinct": _ONE_HOP.format(
        columns="DISTINCT l.l_returnflag AS name, l.l_linestatus AS status"
    )
    + " AND p.p_type = 'ECONOMY'",
    "q09_dimension_dangling": _LABELLED,
    "q09_dimension_dangling_split_join": _LABELLED,
    "q17_drop_null": f"SELECT * FROM ({_LABELLED}) WHERE quality IS NOT NULL",
    "q32_left_lookup_split": """
        SELECT o.o_custkey, l.l_partkey
        FROM orders o LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey""",
    "q38_members_of_lists": """
        SELECT p.p_brand AS list_name, l.l_returnflag AS name, l.l_suppkey
        FROM part p LEFT JOIN lineitem l ON p.p_partkey = l.l_partkey""",
    "q10_pivot": "SELECT user_id, "
    + ", ".join(
        f"max(value) FILTER (WHERE event_type = '{t}') AS {t}"
        for t in ("click", "error", "purchase", "signup", "view")
    )
    + " FROM events GROUP BY user_id",
    "q11_pivot_translations": "SELECT source, "
    + ", ".join(
        f"min(n_chars) FILTER (WHERE lang = '{x}') AS CHARS_{x}" for x in ("de", "en", "es", "fr")
    )
    + " FROM documents GROUP BY source",
    "q11_spread_translations": "SELECT doc_id, "
    + ", ".join(
        f"CASE WHEN lang = '{x}' THEN source END AS SOURCE_{x}" for x in ("de", "en", "es", "fr")
    )
    + " FROM documents",
    "q19_watermark": """
        SELECT strftime(max(ts), '%Y-%m-%dT%H:%M:%S') AS watermark FROM events""",
    "q19_watermark_by_key": """
        SELECT user_id, strftime(max(ts), '%Y-%m-%dT%H:%M:%S') AS watermark
        FROM events GROUP BY user_id""",
    "q20_changed_since": """
        SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-15 12:00:00'""",
    "q30_global_max": "SELECT max(ts) AS max_ts FROM events",
    "q21_upsert": f"""
        WITH old AS ({_ORDERS} WHERE {_OLD}),
        new AS (SELECT * REPLACE ('X' AS o_orderstatus) FROM ({_ORDERS} WHERE {_NEW}))
        SELECT coalesce(new.o_orderkey, old.o_orderkey) AS o_orderkey,
               CASE WHEN new.o_orderkey IS NULL THEN old.o_custkey ELSE new.o_custkey END
                   AS o_custkey,
               CASE WHEN new.o_orderkey IS NULL THEN old.o_orderstatus
                    ELSE new.o_orderstatus END AS o_orderstatus,
               CASE WHEN new.o_orderkey IS NULL THEN old.o_orderdate
                    ELSE new.o_orderdate END AS o_orderdate
        FROM old FULL JOIN new ON old.o_orderkey = new.o_orderkey""",
    "q22_upsert_composite": """
        WITH i AS (
            SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity
            FROM lineitem
        ), old AS (SELECT * FROM i WHERE l_shipdate < TIMESTAMP '1998-01-01'),
        new AS (
            SELECT * REPLACE (l_quantity + 1 AS l_quantity) FROM i
            WHERE l_shipdate >= TIMESTAMP '1996-01-01'
            QUALIFY row_number() OVER (
                PARTITION BY l_orderkey, l_linenumber, l_partkey, l_suppkey
                ORDER BY l_shipdate DESC, l_quantity) = 1
        )
        SELECT * FROM new UNION ALL
        SELECT * FROM old ANTI JOIN new USING (l_orderkey, l_linenumber, l_partkey, l_suppkey)""",
    "q23_latest_per_key": """
        SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                ORDER BY l_shipdate DESC, l_partkey, l_suppkey) = 1""",
    "q24_upsert_null_safe": _NULL_KEY.format(same="IS NOT DISTINCT FROM"),
    "q24_upsert_null_never_matches": _NULL_KEY.format(same="="),
    "q29_soft_delete": f"""
        WITH old AS (SELECT *, false AS deleted FROM ({_ORDERS} WHERE {_OLD})),
        new AS (SELECT * REPLACE ('X' AS o_orderstatus), o_custkey < 100 AS deleted
                FROM ({_ORDERS} WHERE {_NEW}))
        SELECT * FROM new UNION ALL
        SELECT * FROM old WHERE o_orderkey NOT IN (SELECT o_orderkey FROM new)""",
    "q29_active_only": """
        SELECT o_orderkey FROM orders
        WHERE NOT coalesce(nullif(o_orderstatus, 'P') = 'F', false)""",
    "q33_upsert_newer_only": """
        SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_custkey ELSE -o_custkey END
                   AS o_custkey, o_orderstatus,
               CASE WHEN o_orderstatus = 'F' THEN o_orderdate
                    ELSE o_orderdate + INTERVAL 1 DAY END AS o_orderdate
        FROM orders""",
    "q25_request_plan": f"""
        SELECT s_nationkey AS "organisationUnitGroup", s_suppkey AS "dataSet",
               s_nationkey || '_' || s_suppkey || '.json' AS file_name,
               'orgUnitGroup=' || s_nationkey || '&dataSet=' || s_suppkey || '&{_FIXED_ALL}'
               || '&lastUpdated=' || (SELECT strftime(max(ts), '%Y-%m-%dT%H:%M:%S') FROM events)
               AS parameters
        FROM supplier""",
    "q25_request_plan_by_key": f"""
        SELECT CAST(c_custkey AS VARCHAR) AS "organisationUnit",
               c_custkey || '.json' AS file_name,
               'orgUnit=' || c_custkey || '&{_FIXED_ALL}' || coalesce(
                   '&lastUpdatedStartDate=' || strftime(newest, '%Y-%m-%dT%H:%M:%S'), '')
               AS parameters
        FROM customer LEFT JOIN (
            SELECT o_custkey, max(o_orderdate) AS newest FROM orders GROUP BY o_custkey)
            ON c_custkey = o_custkey""",
    "q26_id_list": "SELECT DISTINCT unnest(string_split(text, ' ')) AS id FROM documents",
    "q28_stream_upsert": """
        SELECT * REPLACE (CASE WHEN event_id % 5 = 0 THEN -1 ELSE value END AS value)
        FROM events""",
    "q34_overwrite_snapshot": f"""
        SELECT *, CAST(year(o_orderdate) AS INTEGER) AS o_year FROM ({_ORDERS})""",
    "q35_load_incremental": f"""
        SELECT * FROM ({_ORDERS} WHERE o_orderdate < TIMESTAMP '1996-01-01') UNION ALL
        SELECT * REPLACE ('X' AS o_orderstatus) FROM ({_ORDERS} WHERE {_NEW})""",
    "q36_land_and_read": f"""
        SELECT CAST(event_id AS VARCHAR) AS event, 'v' AS "dataElement",
               json_extract_string(props, '$.k') AS "dataValues_value",
               {_MOMENT.format('ts')} AS "lastUpdated"
        FROM events""",
    "q37_write_curated": f"SELECT name, count(*) AS n FROM ({_LABELLED}) GROUP BY name",
    # -- enrichment jobs
    "e_categories": """
        SELECT DISTINCT c_mktsegment AS id, CAST(c_nationkey AS VARCHAR) AS "dataDimensionType"
        FROM customer""",
    "e_categoryOptions": f"""
        SELECT DISTINCT CAST(doc_id AS VARCHAR) AS id, lang AS name,
               unnest({_CONTACT_ROWS}) AS "categoryOptionCombos_id"
        FROM documents""",
    "e_categoryOptionGroups": """
        SELECT DISTINCT CAST(page_id AS VARCHAR) AS id, url AS name,
               unnest(string_split(url, '/')) AS "categoryOptions_id"
        FROM pages""",
    "e_dataElementGroups": """
        SELECT DISTINCT conv_id || '-' || turn AS id, role AS name,
               unnest(string_split(text, chr(10))) AS "dataElements_id"
        FROM conversations""",
    "e_organisationUnitGroups": """
        SELECT DISTINCT CAST(vec_id AS VARCHAR) AS id, CAST(label AS VARCHAR) AS name,
               unnest(list_transform(embedding,
                   lambda x: CAST(round(CAST(x AS DOUBLE) * 1000) AS BIGINT)::VARCHAR))
               AS "organisationUnits_id"
        FROM embeddings""",
    "e_dimension": """
        SELECT DISTINCT p_type AS "dimensionType", p_brand AS id, p_name AS name,
               unnest(string_split(p_name, ' ')) AS items_id
        FROM part""",
    "e_events": f"""
        SELECT event_type AS program, CAST(event_id AS VARCHAR) AS event,
               CAST(NULL AS VARCHAR) AS "programStage", CAST(user_id AS VARCHAR) AS "orgUnit",
               CAST(NULL AS VARCHAR) AS "trackedEntityInstance",
               CAST(NULL AS VARCHAR) AS enrollment, CAST(NULL AS VARCHAR) AS "enrollmentStatus",
               CAST(NULL AS VARCHAR) AS status, CAST(NULL AS VARCHAR) AS "orgUnitName",
               CAST(ts AS DATE) AS "eventDate", {_MOMENT.format('ts')} AS "lastUpdated",
               CAST(NULL AS TIMESTAMP) AS created, value > 50 AS deleted,
               CASE WHEN event_type <> 'view' THEN 'k' END AS "dataElement",
               CASE WHEN event_type <> 'view' THEN json_extract_string(props, '$.k') END
                   AS "dataValues_value"
        FROM events""",
    "e_trackedentityinstances": """
        SELECT program, CAST(NULL AS TIMESTAMP) AS created,
               TIMESTAMP '2024-02-03 04:05:06' AS "lastUpdated",
               CAST(c_nationkey AS VARCHAR) AS "orgUnit", c_acctbal < 0 AS inactive,
               CAST(NULL AS BOOLEAN) AS deleted, code AS attributes_code,
               CASE code WHEN 'NAME' THEN c_name ELSE CAST(c_nationkey AS VARCHAR) END
                   AS attributes_value,
               CAST(c_custkey AS VARCHAR) AS "trackedEntityInstance"
        FROM (SELECT *, unnest(['NAME', 'NATION']) AS code FROM (
                SELECT *, unnest(CASE WHEN c_nationkey > 4 THEN [c_mktsegment, 'ALL']
                                      ELSE [NULL] END) AS program
                FROM customer))""",
}

_USERS = """
    SELECT lang AS "displayName", text AS email, CAST(NULL AS VARCHAR) AS "firstName",
           CAST(doc_id AS VARCHAR) AS id, CAST(NULL AS VARCHAR) AS languages,
           CAST(NULL AS VARCHAR) AS name, CAST(NULL AS VARCHAR) AS surname,
           CASE WHEN lang <> 'fr' THEN DATE '2024-01-01' + CAST(n_chars % 365 AS INTEGER) END
               AS "lastLogin",
           n_chars > 2000 AS disabled, source AS username,
           CASE WHEN contains(source, '@') THEN source || ';'
                WHEN contains(text, '@') THEN text || ';' ELSE '' END AS "Distribution"
    FROM documents"""
ORACLE["e_users"] = ORACLE["c_users"] = _USERS

_TEXT_NULLS = (
    "lastUpdated", "href", "created", "displayFormName", "displayName", "displayShortName",
    "dimensionItem",
)
_nulls = ", ".join(f'CAST(NULL AS VARCHAR) AS "{c}"' for c in _TEXT_NULLS)
_element_nulls = ", ".join(
    f'CAST(NULL AS VARCHAR) AS "{c}"'
    for c in (
        "aggregationType", "publicAccess", "description", "valueType", "domainType", "formName",
        "displayDescription", "url", "dimensionItemType",
    )
)
_element_flags = ", ".join(
    f'CAST(NULL AS BOOLEAN) AS "{c}"'
    for c in ("externalAccess", "zeroIsSignificant", "optionSetValue")
)
ORACLE["e_dataelement"] = f"""
    SELECT CAST(p_partkey AS VARCHAR) AS id, {_nulls}, {_element_nulls}, {_element_flags},
           p_name AS name, p_type AS "shortName", p_brand AS code, p_size > 25 AS favorite,
           CASE WHEN p_type <> 'PROMO' THEN p_brand END AS "NAME_en",
           CASE WHEN p_type <> 'PROMO' THEN p_name END AS "NAME_fr",
           CASE WHEN p_type <> 'PROMO' THEN p_type END AS "SHORT_NAME_fr"
    FROM part"""
ORACLE["c_dataelement"] = """
    SELECT p_name AS name, p_brand AS code, CAST(p_partkey AS VARCHAR) AS id,
           p_type AS "shortName"
    FROM part ORDER BY p_name"""

_UNIT = """
    SELECT *, CASE c_mktsegment WHEN 'BUILDING' THEN 4 WHEN 'MACHINERY' THEN NULL ELSE 2 END
               AS lvl,
           '/' || c_nationkey || '/' || c_custkey AS unit_path
    FROM customer"""
_UNIT_POINT = "c_acctbal > 0 AND c_mktsegment IN ('BUILDING', 'MACHINERY')"
ORACLE["e_orgunit"] = f"""
    SELECT CAST(c_custkey AS VARCHAR) AS id, {_nulls}, CAST(lvl AS BIGINT) AS level,
           c_name AS name, c_mktsegment AS "shortName", CAST(NULL AS VARCHAR) AS code,
           CAST(NULL AS BOOLEAN) AS leaf, unit_path AS path, CAST(NULL AS BOOLEAN) AS favorite,
           CAST(NULL AS BOOLEAN) AS "externalAccess", CAST(NULL AS VARCHAR) AS "openingDate",
           CAST(c_nationkey AS VARCHAR) AS parent_id,
           CASE WHEN {_UNIT_POINT} THEN c_nationkey || ',' || c_custkey END AS coordinates,
           c_name AS "NAME_fr"
    FROM ({_UNIT})"""
ORACLE["c_organisationunits"] = f"""
    SELECT CAST(NULL AS VARCHAR) AS code, c_name AS name, CAST(c_custkey AS VARCHAR) AS id,
           c_mktsegment AS "shortName", unit_path AS path, CAST(lvl AS BIGINT) AS level,
           CAST(c_nationkey AS VARCHAR) AS parent_id,
           CASE WHEN {_UNIT_POINT} THEN CAST(c_nationkey AS VARCHAR) END AS long,
           CASE WHEN {_UNIT_POINT} THEN CAST(c_custkey AS VARCHAR) END AS lat
    FROM ({_UNIT})"""

_VALUES = f"""
    SELECT CAST(l_partkey AS VARCHAR) AS "dataElement_id",
           strftime(l_shipdate, '%Y') AS period, CAST(l_suppkey AS VARCHAR) AS "orgUnit",
           l_returnflag AS "categoryOptionCombo_id",
           CAST(l_linenumber AS VARCHAR) AS "attributeOptionCombo_id",
           CAST(CAST(trunc(l_quantity) AS BIGINT) AS VARCHAR) AS value,
           l_linestatus AS "storedBy",
           {_MOMENT.format('l_shipdate')} AS created,
           {_MOMENT.format('l_shipdate')} AS "lastUpdated",
           CAST(NULL AS VARCHAR) AS comment, l_quantity > 25 AS followup
    FROM lineitem"""
ORACLE["c_dataelement_values"] = _VALUES
ORACLE["q31_curated_values_projected"] = f"""
    SELECT "dataElement_id", "categoryOptionCombo_id", "attributeOptionCombo_id", period,
           "orgUnit", value FROM ({_VALUES})"""
ORACLE["e_dataElement_values"] = f"""
    SELECT * FROM ({_VALUES}) QUALIFY row_number() OVER (
        PARTITION BY "dataElement_id", period, "orgUnit", "categoryOptionCombo_id",
                     "attributeOptionCombo_id"
        ORDER BY "lastUpdated" DESC, value, "storedBy", created, followup) = 1"""


def _curated_sql(number: int, member: str, distinct: bool) -> str:
    """Code list ``number`` is made of the parts of the brand with that number."""
    return f"""
        SELECT {'DISTINCT' if distinct else ''} l.l_returnflag || '-' || l.l_linestatus AS name,
               CAST(l.l_suppkey AS VARCHAR) AS "{member}"
        FROM part p LEFT JOIN lineitem l ON p.p_partkey = l.l_partkey
        WHERE p.p_brand = 'Brand#{number}'"""


def _curated_2hop_sql(number: int) -> str:
    return f"""
        SELECT l.l_returnflag || '-' || l.l_linestatus AS name,
               CAST(o.o_custkey AS VARCHAR) AS "categoryOptionCombos_id"
        FROM part p LEFT JOIN lineitem l ON p.p_partkey = l.l_partkey
        LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
        WHERE p.p_brand = 'Brand#{number}'"""


# The member column each curated dimension must give out, by list number.
_MEMBERS = {
    **dict.fromkeys(range(1, 5), "organisationUnits_id"),
    **dict.fromkeys(range(5, 17), "categoryOptionCombos_id"),
    **dict.fromkeys(range(17, 22), "dataElements_id"),
    9: "attributeOptionCombo_id",
    13: "attributeOptionCombo_id",
}
for _number, _dimension in enumerate(DIMENSIONS, start=1):
    _key = "c_" + _dimension.sink.replace("-", "_").lower()
    if _number in (22, 23):
        ORACLE[_key] = _curated_2hop_sql(_number)
    else:
        ORACLE[_key] = _curated_sql(_number, _MEMBERS[_number], 17 <= _number <= 21)

ORACLE["j_landed_org_units"] = ORACLE["e_orgunit"]
ORACLE["j_landed_dimensions"] = """
    WITH groups AS (
        SELECT DISTINCT l_partkey, l_returnflag || '-' || l_linestatus AS name, l_orderkey
        FROM lineitem
    )
    SELECT CASE p.p_brand WHEN 'Brand#22' THEN 'Donor' ELSE 'Funding Agency' END AS dimension,
           g.name, CAST(o.o_custkey AS VARCHAR) AS "categoryOptionCombos_id"
    FROM part p LEFT JOIN groups g ON p.p_partkey = g.l_partkey
    LEFT JOIN orders o ON g.l_orderkey = o.o_orderkey
    WHERE p.p_brand IN ('Brand#22', 'Brand#23')"""
_SINCE = """'&lastUpdatedStartDate=' ||
    (SELECT strftime(max(ts), '%Y-%m-%dT%H:%M:%S') FROM events)"""
ORACLE["i_events"] = f"""
    SELECT CAST(c_custkey AS VARCHAR) AS "organisationUnit", c_custkey || '.json' AS file_name,
           'orgUnit=' || c_custkey || '&{_FIXED_ALL}' || {_SINCE} AS parameters
    FROM customer"""
ORACLE["i_trackedentityinstances"] = f"""
    SELECT DISTINCT c_mktsegment AS program, c_mktsegment || '.json' AS file_name,
           'program=' || c_mktsegment
           || '&ouMode=ALL&includeDeleted=true&fields=*&skipPaging=true' || {_SINCE}
           AS parameters
    FROM customer"""

# Whole chains over landed documents.
for _name in (
    "categories", "categoryOptions", "categoryOptionGroups", "dataElementGroups",
    "organisationUnitGroups", "dimension", "users", "dataelement", "orgunit",
):
    ORACLE[f"j_landed_{_name}"] = ORACLE[f"e_{_name}"]


def _second_poll(sql: str, number: str, changed: str) -> str:
    """The rows after a second poll that changes every seventh record."""
    hit = f'CAST("{number}" AS BIGINT) % 7 = 0'
    return f"""
        SELECT * REPLACE (
            CASE WHEN {hit} THEN 'changed' ELSE "{changed}" END AS "{changed}",
            CASE WHEN {hit} THEN TIMESTAMP '2030-01-01 00:00:00' ELSE "lastUpdated" END
                AS "lastUpdated")
        FROM ({sql})"""


ORACLE["j_landed_events"] = _second_poll(ORACLE["e_events"], "event", "orgUnit")
ORACLE["q28_stream_enrichment"] = ORACLE["j_landed_events"]
ORACLE["j_landed_trackedentityinstances"] = _second_poll(
    ORACLE["e_trackedentityinstances"], "trackedEntityInstance", "orgUnit"
)
ORACLE["j_landed_dataElement_values"] = ORACLE["e_dataElement_values"].replace(
    _VALUES, _second_poll(_VALUES, "dataElement_id", "value")
)
ORACLE["j_landed_with_bad_document"] = f"""
    SELECT *, (SELECT count(*) FROM nation) AS set_aside FROM ({ORACLE['e_categories']})"""
ORACLE["j_landing_drift"] = """
    SELECT kind, 'categories.' || field AS field
    FROM (VALUES ('unknown', 'code'), ('missing', 'dataDimensionType')) t(kind, field)"""
ORACLE["q35_load_incremental_typed"] = ORACLE["q35_load_over_parquet"] = ORACLE["q21_upsert"]
ORACLE["i_datavalues"] = f"""
    SELECT CAST(vec_id AS VARCHAR) AS "organisationUnitGroup", CAST(label AS VARCHAR) AS "dataSet",
           vec_id || '_' || label || '.json' AS file_name,
           'orgUnitGroup=' || vec_id || '&dataSet=' || label || '&{_FIXED_ALL}'
           || '&lastUpdated=' || (SELECT strftime(max(ts), '%Y-%m-%dT%H:%M:%S') FROM events)
           AS parameters
    FROM embeddings JOIN nation ON label = n_nationkey WHERE n_regionkey <> 0"""
