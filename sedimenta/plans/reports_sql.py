"""The same results in SQL, written independently for DuckDB."""

from __future__ import annotations

_MARKS = "SELECT doc_id, unnest(['quality ' || quality, 'toxic ' || toxic]) AS name FROM labels"
_STAR = f"""
    WITH parts AS (
        SELECT DISTINCT page_id, unnest(string_split(split_part(url, '/', 3), '.')) AS name FROM pages
    ), marks AS (SELECT DISTINCT * FROM ({_MARKS})),
    part_sets AS (SELECT page_id, list(name ORDER BY name) AS names FROM parts GROUP BY page_id),
    mark_sets AS (SELECT doc_id, list(name ORDER BY name) AS names FROM marks GROUP BY doc_id)
"""
_SETS = f"""
    {_STAR}, whole AS (
        SELECT d.lang, p.names AS part, m.names AS mark, count(*) AS n_facts, sum(d.n_chars) AS n_chars
        FROM documents d LEFT JOIN part_sets p ON d.doc_id = p.page_id
        LEFT JOIN mark_sets m ON d.doc_id = m.doc_id
        GROUP BY ALL)
"""
_LISTS = f"""
    WITH lists AS (
        SELECT DISTINCT list, doc_id FROM (
            SELECT lang AS list, doc_id FROM documents UNION ALL
            SELECT source, doc_id FROM documents UNION ALL
            SELECT name, doc_id FROM ({_MARKS})))
"""
_TREE = """
    WITH RECURSIVE whole AS (
        SELECT page_id, strlen(html) AS n_bytes,
               rtrim(split_part(split_part(split_part(url, '://', 2), '?', 1), '#', 1), '/') AS address
        FROM pages
    ), cut AS (
        SELECT *, string_split(split_part(address, '/', 1), '.') AS host,
               string_split(address, '/')[2:] AS rest FROM whole
    ), ways AS (
        SELECT page_id, n_bytes, address, list_concat(
            list_transform(range(1, len(host) + 1), lambda k: array_to_string(host[len(host) - k + 1:], '.')),
            list_transform(range(1, len(rest) + 1), lambda k:
                split_part(address, '/', 1) || '/' || array_to_string(rest[1:k], '/'))) AS steps
        FROM cut
    ), tree AS (
        SELECT DISTINCT steps[k] AS id, CASE WHEN k > 1 THEN steps[k - 1] END AS parent_id
        FROM (SELECT steps, unnest(range(1, len(steps) + 1)) AS k FROM ways)
    ), closure AS (
        SELECT id, id AS ancestor, 0 AS distance, parent_id FROM tree
        UNION ALL
        SELECT c.id, t.id, c.distance + 1, t.parent_id FROM closure c JOIN tree t ON c.parent_id = t.id
    )
"""
_UNITS = """
    WITH RECURSIVE units AS (
        SELECT doc_id::VARCHAR AS id, CASE WHEN lang <> 'fr' THEN n_chars::VARCHAR END AS parent
        FROM documents
    ), up AS (SELECT u.id, p.id AS parent FROM units u JOIN units p ON u.parent = p.id AND u.id <> p.id),
    reach AS (
        SELECT id, parent AS top FROM up UNION SELECT r.id, u.parent FROM reach r JOIN up u ON r.top = u.id
    ), on_cycle AS (SELECT id FROM reach WHERE id = top),
    lost AS (SELECT id FROM reach WHERE top IN (SELECT id FROM on_cycle) UNION SELECT id FROM on_cycle),
    walked AS (
        SELECT id, id AS top, 1 AS level FROM units WHERE id NOT IN (SELECT id FROM lost)
        UNION ALL SELECT w.id, u.parent, w.level + 1 FROM walked w JOIN up u ON w.top = u.id
    )
"""
_OLD = """SELECT doc_id, text, lang, source, CASE WHEN source = 'src0' THEN -1 ELSE n_chars END AS n_chars
          FROM documents WHERE lang <> 'fr'"""
_NEW = "SELECT doc_id, text, lang, source, n_chars FROM documents WHERE lang <> 'es'"

_ISLANDS = """
    WITH f AS (SELECT source AS unit, doc_id AS s, doc_id + n_chars % 40 AS e FROM documents),
    marked AS (
        SELECT *, CASE WHEN s <= max(e) OVER (PARTITION BY unit ORDER BY s, e
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh
        FROM f WHERE e > s
    ), numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY unit ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS g FROM marked),
    islands AS (SELECT unit, min(s) AS s, max(e) AS e, count(*) AS n FROM numbered GROUP BY unit, g)
"""

ORACLE: dict[str, str] = {
    "q39_star_each": f"""
        {_STAR}
        SELECT d.lang, p.name AS part, m.name AS mark, count(*) AS n_facts,
               CAST(sum(d.n_chars) AS BIGINT) AS n_chars
        FROM documents d LEFT JOIN parts p ON d.doc_id = p.page_id
        LEFT JOIN marks m ON d.doc_id = m.doc_id
        GROUP BY ALL""",
    "q39_star_split": f"""
        {_SETS}, counted AS (
            SELECT *, coalesce(len(part), 1) AS a, coalesce(len(mark), 1) AS b FROM whole
        ), cells AS (
            SELECT *, unnest(range(0, a * b)) AS place FROM counted
        )
        SELECT lang, part[place // b + 1] AS part, mark[place % b + 1] AS mark,
               CAST(sum(n_facts // (a * b) + CASE WHEN place < n_facts % (a * b) THEN 1 ELSE 0 END)
                    AS BIGINT) AS n_facts,
               CAST(sum(n_chars // (a * b) + CASE WHEN place < n_chars % (a * b) THEN 1 ELSE 0 END)
                    AS BIGINT) AS n_chars
        FROM cells GROUP BY ALL""",
    "q39_star_sets": f"""
        {_SETS}
        SELECT lang, coalesce(array_to_string(part, '+'), '') AS part,
               coalesce(array_to_string(mark, '+'), '') AS mark, n_facts,
               CAST(n_chars AS BIGINT) AS n_chars
        FROM whole""",
    "q40_list_overlaps": f"""
        {_LISTS}, sizes AS (SELECT list, count(*) AS n FROM lists GROUP BY list),
        pairs AS (
            SELECT a.list, b.list AS other, count(*) AS n_both
            FROM lists a JOIN lists b ON a.doc_id = b.doc_id AND a.list < b.list GROUP BY ALL)
        SELECT a.list, b.list AS other, coalesce(n_both, 0) AS n_both,
               a.n + b.n - coalesce(n_both, 0) AS n_either
        FROM sizes a JOIN sizes b ON a.list < b.list
        LEFT JOIN pairs p ON p.list = a.list AND p.other = b.list""",
    "q40_list_questions": f"""
        {_LISTS}, members AS (SELECT doc_id, list(list) AS l FROM lists GROUP BY doc_id)
        SELECT 'good English' AS question, doc_id FROM members
        WHERE list_has_all(l, ['en', 'quality 1']) AND NOT list_contains(l, 'toxic 1')
        UNION ALL
        SELECT 'src0 or src1, not German', doc_id FROM members
        WHERE list_has_any(l, ['src0', 'src1']) AND NOT list_contains(l, 'de')
        UNION ALL
        SELECT 'toxic French or Spanish', doc_id FROM members
        WHERE list_contains(l, 'toxic 1') AND list_has_any(l, ['fr', 'es'])""",
    "q41_hierarchy_closure": f"{_TREE} SELECT id, ancestor, distance FROM closure",
    "q41_hierarchy_roll_up": f"""
        {_TREE}
        SELECT ancestor, count(*) AS n_facts, CAST(sum(n_bytes) AS BIGINT) AS n_bytes
        FROM ways JOIN closure ON steps[-1] = id GROUP BY ancestor""",
    "q41_hierarchy_faults": f"""
        {_UNITS}
        SELECT id, 'orphan' AS fault, parent AS detail FROM units
        WHERE parent IS NOT NULL AND parent <> id AND parent NOT IN (SELECT id FROM units)
        UNION ALL SELECT u.id, 'cycle', NULL FROM units u WHERE id IN (SELECT id FROM lost)
        UNION ALL SELECT id, 'level', max(level)::VARCHAR FROM walked GROUP BY id HAVING max(level) <> 2""",
    "q42_snapshot_difference": f"""
        WITH old AS ({_OLD}), new AS ({_NEW})
        SELECT coalesce(n.doc_id, o.doc_id) AS doc_id,
               CASE WHEN n.doc_id IS NULL THEN o.text ELSE n.text END AS text,
               CASE WHEN n.doc_id IS NULL THEN o.lang ELSE n.lang END AS lang,
               CASE WHEN n.doc_id IS NULL THEN o.source ELSE n.source END AS source,
               CASE WHEN n.doc_id IS NULL THEN o.n_chars ELSE n.n_chars END AS n_chars,
               CASE WHEN o.doc_id IS NULL THEN 'added' WHEN n.doc_id IS NULL THEN 'removed'
                    ELSE 'changed' END AS change
        FROM old o FULL JOIN new n ON o.doc_id = n.doc_id
        WHERE o.doc_id IS NULL OR n.doc_id IS NULL OR o.text IS DISTINCT FROM n.text
              OR o.lang IS DISTINCT FROM n.lang OR o.source IS DISTINCT FROM n.source
              OR o.n_chars IS DISTINCT FROM n.n_chars""",
    "q42_row_difference": f"""
        SELECT lang, source, text, CAST(sum(n_old) AS BIGINT) AS n_old, CAST(sum(n_new) AS BIGINT) AS n_new
        FROM (SELECT lang, source, text, 1 AS n_old, 0 AS n_new FROM ({_OLD}) UNION ALL
              SELECT lang, source, text, 0, 1 FROM ({_NEW}))
        GROUP BY ALL HAVING sum(n_old) <> sum(n_new)""",
    "q42_with_deletions": f"""
        SELECT doc_id, lang, n_chars, NULL::TIMESTAMP AS deleted_at FROM ({_OLD})
        UNION ALL
        SELECT doc_id, lang, n_chars, TIMESTAMP '2024-01-03' FROM ({_NEW}) n
        WHERE doc_id NOT IN (SELECT doc_id FROM ({_OLD}))""",
    "q43_load_new_columns": """
        SELECT doc_id, CASE WHEN toxic = 1 THEN NULL ELSE quality END AS quality,
               CASE WHEN toxic = 1 THEN toxic END AS toxic, CASE WHEN toxic = 1 THEN 'seen' END AS note
        FROM labels""",
    "q44_coverage_islands": f"""
        {_ISLANDS} SELECT unit, s AS start, e AS "end", n AS n_fetches FROM islands""",
    "q44_coverage_gaps": f"""
        {_ISLANDS}, wanted AS (SELECT unit, min(s) AS a, max(s) + 100 AS b FROM f GROUP BY unit),
        edges AS (
            SELECT unit, e AS s, lead(s) OVER (PARTITION BY unit ORDER BY s) AS e FROM islands
            UNION ALL SELECT unit, a, (SELECT min(s) FROM islands i WHERE i.unit = w.unit) FROM wanted w)
        SELECT unit, s AS start, coalesce(least(e, b), b) AS "end"
        FROM edges JOIN wanted USING (unit) WHERE s < coalesce(least(e, b), b)""",
    "q45_factorised_lines": """
        SELECT doc_id AS doc_doc_id, lang AS doc_meta_lang, source AS doc_meta_source,
               unnest(string_split(text, chr(10))) AS doc_lines
        FROM documents""",
    "q45_factorised_counts": """
        SELECT doc_id AS doc_doc_id, len(string_split(text, chr(10))) AS doc_lines,
               len(list_filter(string_split(text, ' '), lambda w: contains(w, '@'))) AS doc_contacts
        FROM documents""",
    "q46_landing_drift_types": """
        SELECT 'categoryOptions[].' || field AS path, kind, declared, landed FROM (VALUES
            ('id', 'other type', 'string', 'struct<id:string>'),
            ('name', 'absent', 'string', NULL),
            ('code', 'undeclared', NULL, 'bigint')) AS v (field, kind, declared, landed)""",
    "q47_refresh_members": """
        SELECT CASE WHEN l.doc_id IS NOT NULL THEN 'quality ' || quality END AS name,
               l.doc_id * 10 + l.toxic AS member, count(*) AS n_reasons
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
        WHERE d.lang = 'en' AND d.source <> 'src0' GROUP BY ALL""",
    "q48_heavy_join": """
        SELECT d.doc_id, d.source, o.lang AS other
        FROM documents d JOIN (SELECT DISTINCT source, lang FROM documents) o ON d.source = o.source""",
    "q49_stream_latest": """
        SELECT source, n_chars, doc_id, lang, doc_id % 3 AS version FROM documents
        QUALIFY row_number() OVER (
            PARTITION BY source, n_chars ORDER BY version DESC, doc_id, lang) = 1""",
}
