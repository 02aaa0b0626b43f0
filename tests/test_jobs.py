"""The enrichment and curated jobs on documents with all the odd rows."""

import pytest

import sedimenta as sd
from sedimenta.plans import curated, enrichment, ingestion
from sedimenta.plans.enrichment import run_enrichment
from sedimenta.schemas import RECORD_DDL, document_schema
from sedimenta.streaming.upserts import stream_enrichment


@pytest.fixture
def out(tmp_path):
    return str(tmp_path / "enriched")


def test_every_job_has_a_schema_for_its_columns():
    assert len(enrichment.JOBS) == 12 and len(curated.JOBS) == 27
    assert len(ingestion.EXTRACTS) == 12 and len(RECORD_DDL) == 13  # and the list of data sets
    for job in enrichment.JOBS.values():
        assert len(job.schema()[job.root].dataType.elementType.names) > 1


def test_categories(spark, landing, out, rows):
    root = landing(
        "categories/categories.json",
        {"categories": [{"id": "a", "dataDimensionType": "X", "new": 1}, {"id": "a",
         "dataDimensionType": "X"}, {"id": "b"}], "pager": {"page": 1}},
    )
    run_enrichment(spark, "categories", root, out)
    assert rows(sd.read_table(spark, f"{out}/categories")) == [("a", "X"), ("b", None)]


@pytest.mark.parametrize(
    ("name", "array", "member"),
    [
        ("categoryOptions", "categoryOptionCombos", "categoryOptionCombos_id"),
        ("categoryOptionGroups", "categoryOptions", "categoryOptions_id"),
        ("dataElementGroups", "dataElements", "dataElements_id"),
        ("organisationUnitGroups", "organisationUnits", "organisationUnits_id"),
    ],
)
def test_memberships(spark, landing, rows, name, array, member):
    root = landing(
        f"{name}/{name}.json",
        {name: [
            {"id": "a", "name": "A", array: [{"id": "m1"}, {"id": "m2"}, {"id": "m1"}]},
            {"id": "b", "name": "B", array: []},
            {"id": "c", "name": "C"},
        ]},
    )
    job = enrichment.JOBS[name]
    df = enrichment.enrich(name, sd.read_landing(spark, f"{root}/{job.source}", job.schema()))
    assert df.columns == ["id", "name", member]
    assert rows(df) == sorted(
        [("a", "A", "m1"), ("a", "A", "m2"), ("b", "B", None), ("c", "C", None)], key=repr
    )


def test_users(spark, landing, out, rows):
    def user(i, username, email, login):
        return {
            "id": i, "email": email,
            "userCredentials": {"username": username, "lastLogin": login, "disabled": False},
        }

    root = landing(
        "users/users.json",
        {"users": [
            user("1", "u@x", "e@x", "2023-01-09T11:12:13.000"), user("2", "u", "e@x", "soon"),
            user("3", "u", "e", None), {"id": "4"},
        ]},
    )
    run_enrichment(spark, "users", root, out)
    df = sd.read_table(spark, f"{out}/users")
    assert df.columns == [
        "displayName", "email", "firstName", "id", "languages", "name", "surname", "lastLogin",
        "disabled", "username", "Distribution",
    ]
    got = rows(df.selectExpr("id", "string(lastLogin)", "disabled", "Distribution"))
    assert got == [
        ("1", "2023-01-09", False, "u@x;"), ("2", None, False, "e@x;"), ("3", None, False, ""),
        ("4", None, None, ""),
    ]
    curated.run_curated(spark, "users", out, f"{out}/curated")
    assert rows(spark.read.parquet(f"{out}/curated/users"), "id") == rows(df, "id")


TRANSLATED = [
    {"property": "NAME", "locale": "fr", "value": "nom"},
    {"property": "NAME", "locale": "en", "value": "name"},
    {"property": "SHORT_NAME", "locale": "fr", "value": "n."},
]


@pytest.fixture
def element_root(landing):
    return landing(
        "dataelement/dataelement.json",
        {"dataElements": [
            {"id": "1", "name": "b", "code": "c", "shortName": "s", "translations": TRANSLATED,
             "favorite": True},
            {"id": "2", "name": "a", "translations": []}, {"id": "3"},
            {"id": "2", "name": "a", "translations": TRANSLATED[:1]},
        ]},
    )


def test_data_elements(spark, element_root, out, rows):
    run_enrichment(spark, "dataelement", element_root, out)
    df = sd.read_table(spark, f"{out}/dataelement")
    assert len(df.columns) == 27 and "" not in df.columns
    assert df.columns[-3:] == ["NAME_en", "NAME_fr", "SHORT_NAME_fr"]
    assert rows(df, "id", "NAME_en", "NAME_fr", "SHORT_NAME_fr") == [
        ("1", "name", "nom", "n."), ("2", None, "nom", None), ("3", None, None, None),
    ]
    curated.run_curated(spark, "DataElements", out, f"{out}/curated")
    sink = spark.read.parquet(f"{out}/curated/dataelement")
    assert sink.columns == ["name", "code", "id", "shortName"]
    assert rows(sink, "name", "id") == sorted([(None, "3"), ("a", "2"), ("b", "1")], key=repr)


def test_data_elements_with_known_locales(spark, element_root, out, rows):
    run_enrichment(spark, "dataelement", element_root, out, locales=["NAME_fr", "NAME_de"])
    df = sd.read_table(spark, f"{out}/dataelement")
    assert rows(df, "id", "NAME_fr", "NAME_de") == [
        ("1", "nom", None), ("2", "nom", None), ("3", None, None),
    ]


def test_both_pivots_agree(spark, element_root, rows):
    job = enrichment.JOBS["dataelement"]
    docs = sd.read_landing(spark, f"{element_root}/{job.source}", job.schema())
    cells = [f"dataElements_translations_{c}" for c in ("property", "locale", "value")]
    flat = sd.flatten(docs, columns=[*job.columns, *cells]).distinct()
    long = sd.pivot_translations(flat, list(job.columns), *cells)
    assert rows(long) == rows(enrichment.enrich(job, docs))


def test_no_translations_at_all(spark, landing, rows):
    root = landing("dataelement/dataelement.json", {"dataElements": [{"id": "1"}, {"id": "1"}]})
    job = enrichment.JOBS["dataelement"]
    docs = sd.read_landing(spark, f"{root}/{job.source}", job.schema())
    assert rows(enrichment.enrich(job, docs), "id") == [("1",)]
    empty = spark.createDataFrame([], "k STRING, p STRING, l STRING, v STRING")
    assert sd.pivot_translations(empty, ["k"], "p", "l", "v").columns == ["k"]


def test_org_units(spark, landing, out, rows):
    def unit(i, level, coordinates, **more):
        geometry = {"geometry": {"type": "P", "coordinates": coordinates}} if coordinates else {}
        return {"id": i, "level": level, "name": f"n{i}", **geometry, **more}

    root = landing(
        "orgunit/orgunit.json",
        {"organisationUnits": [
            unit("1", 4, [-11.5, 8.25], parent={"id": "p"}, translations=TRANSLATED),
            unit("2", 2, [[[1, 2], [3, 4]]]), unit("3", None, [5, 6]), unit("4", 4, None),
        ]},
    )
    run_enrichment(spark, "orgunit", root, out)
    df = sd.read_table(spark, f"{out}/orgunit")
    assert rows(df, "id", "coordinates", "parent_id", "NAME_fr") == [
        ("1", "-11.5,8.25", "p", "nom"), ("2", None, None, None), ("3", "5,6", None, None),
        ("4", None, None, None),
    ]
    curated.run_curated(spark, "Org Unit", out, f"{out}/curated")
    sink = spark.read.parquet(f"{out}/curated/OrganisationUnits")
    assert sink.columns == [
        "code", "name", "id", "shortName", "path", "level", "parent_id", "lat", "long",
    ]
    assert rows(sink, "id", "long", "lat")[0] == ("1", "-11.5", "8.25")
    assert rows(sink, "id", "long", "lat")[3] == ("4", None, None)


def value(element, period, text, updated, **more):
    return {
        "dataElement": element, "period": period, "orgUnit": "u", "categoryOptionCombo": "c",
        "attributeOptionCombo": "a", "value": text, "lastUpdated": updated,
        "created": "2024-01-01T00:00:00.000+0000", **more,
    }


def test_data_values(spark, landing, out, rows):
    landing("dataElement-values/g1_d.json", {"dataValues": [
        value("e1", "202401", "1", "2024-01-01T00:00:00.000+0000"),
        value("e2", "202401", "2", "2024-01-01T00:00:00.900+0000"),
    ]})
    landing("dataElement-values/g3_d.json", {})
    root = landing("dataElement-values/g2_d.json", {"dataValues": [
        value("e1", "202401", "1b", "2024-01-05T00:00:00.000+0000"),
    ]})
    assert run_enrichment(spark, "dataElement-values", root, out) == 1
    table = f"{out}/dataElement-values"
    got = rows(sd.read_table(spark, table), "dataElement_id", "period", "value")
    assert got == [("e1", "202401", "1b"), ("e2", "202401", "2")]
    landing("dataElement-values/g2_d.json", {"dataValues": [
        value("e1", "202401", "1c", "2024-01-06T00:00:00.000+0000", followup=True),
        value("e1", "202402", "9", "2024-02-01T00:00:00.000+0000"),
    ]})
    assert run_enrichment(spark, "dataElement-values", root, out) == 2
    df = sd.read_table(spark, table)
    assert rows(df, "dataElement_id", "period", "value", "followup") == sorted(
        [("e1", "202401", "1c", True), ("e1", "202402", "9", None), ("e2", "202401", "2", None)],
        key=repr,
    )
    assert sd.high_watermark(df, "lastUpdated") == "2024-02-01T00:00:00"
    curated.run_curated(spark, "DataElement Data Values", out, f"{out}/curated")
    sink = spark.read.parquet(f"{out}/curated/dataElement-values")
    assert sink.columns == df.columns and sink.count() == 3
    assert curated.curate_values(df, project=True).columns == list(curated.VALUE_COLUMNS)


def event(i, values, updated="2024-03-01T10:11:12.345+0200", **more):
    return {
        "event": i, "eventDate": "2024-02-29T00:00:00.000", "lastUpdated": updated,
        "created": "rubbish", "deleted": False, "dataValues": values, **more,
    }


def test_events(spark, landing, out, rows):
    landing("events/empty.json", {"events": []})
    root = landing("events/u1.json", {"events": [
        event("1", [{"dataElement": "x", "value": "5"}, {"dataElement": "y", "value": "6"}]),
        event("2", []), event("3", None, deleted=True),
    ]})
    for version in (1, 2):
        assert run_enrichment(spark, "events", root, out, buckets=4) == version
        df = sd.read_table(spark, f"{out}/events")
        got = rows(df.selectExpr(
            "event", "dataElement", "dataValues_value", "deleted", "string(eventDate)",
            "string(lastUpdated)", "created",
        ))
        day, time = "2024-02-29", "2024-03-01 10:11:12"
        assert got == [
            ("1", "x", "5", False, day, time, None), ("1", "y", "6", False, day, time, None),
            ("2", None, None, False, day, time, None), ("3", None, None, True, day, time, None),
        ]
    landing("events/u2.json", {"events": [
        event("1", [{"dataElement": "x", "value": "7"}], updated="2024-03-02T00:00:00.000")]})
    with pytest.raises(ValueError, match="duplicate key"):
        run_enrichment(spark, "events", root, out, on_duplicate="error")
    assert run_enrichment(spark, "events", root, out) == 3
    df = sd.read_table(spark, f"{out}/events")
    assert ("1", "x", "7") in rows(df, "event", "dataElement", "dataValues_value")
    assert df.count() == 4


def test_nothing_landed(spark, landing, out):
    root = landing("events/u1.json", {"events": []})
    assert run_enrichment(spark, "events", root, out) is None
    assert not sd.table_exists(spark, f"{out}/events")


def test_tracked_entities(spark, landing, out, rows):
    root = landing("trackedentityinstances/p.json", {"trackedEntityInstances": [
        {"trackedEntityInstance": "t1", "programOwners": [{"program": "p"}, {"program": "q"}],
         "attributes": [{"code": "A", "value": "1"}, {"code": "B", "value": "2"},
                        {"value": "no code"}]},
        {"trackedEntityInstance": "t2", "attributes": [{"code": "A", "value": "3"}]},
        {"trackedEntityInstance": "t3"},
    ]})
    for _ in range(2):
        run_enrichment(spark, "trackedentityinstances", root, out, buckets=2)
        df = sd.read_table(spark, f"{out}/trackedentityinstances")
        assert rows(df, "trackedEntityInstance", "program", "attributes_code") == sorted(
            [("t1", "p", "A"), ("t1", "p", "B"), ("t1", "q", "A"), ("t1", "q", "B"),
             ("t2", None, "A")], key=repr,
        )


def test_dimensions_end_to_end(spark, landing, out, rows):
    landing("dimension/dimension.json", {"dimensions": [
        {"id": "d1", "name": "Donor", "dimensionType": "T", "items": [{"id": "g1"}, {"id": "gx"}]},
        {"id": "d2", "name": "PMTCT", "items": [{"id": "eg"}, {"id": "eg"}]},
        {"id": "d3", "name": "Project", "items": [{"id": "o1"}]},
        {"id": "d4", "name": "Area", "items": []},
    ]})
    landing("categoryOptionGroups/categoryOptionGroups.json", {"categoryOptionGroups": [
        {"id": "g1", "name": "G1", "categoryOptions": [{"id": "o1"}, {"id": "o2"}]}]})
    landing("categoryOptions/categoryOptions.json", {"categoryOptions": [
        {"id": "o1", "name": "O1", "categoryOptionCombos": [{"id": "c1"}, {"id": "c2"}]},
        {"id": "o2", "name": "O2", "categoryOptionCombos": [{"id": "c1"}]}]})
    landing("dataElementGroups/dataElementGroups.json", {"dataElementGroups": [
        {"id": "eg", "name": "EG", "dataElements": [{"id": "e"}]}]})
    root = landing("organisationUnitGroups/organisationUnitGroups.json", {
        "organisationUnitGroups": [{"id": "ug", "name": "UG"}]})
    for name in ("dimension", "categoryOptionGroups", "categoryOptions", "dataElementGroups",
                 "organisationUnitGroups"):
        run_enrichment(spark, name, root, out)
    expected = {
        "Donor": (["name", "categoryOptionCombos_id"],
                  [("G1", "c1"), ("G1", "c1"), ("G1", "c2"), (None, None)]),
        "PMTCT": (["name", "dataElements_id"], [("EG", "e")]),
        "Project": (["name", "attributeOptionCombo_id"], [("O1", "c1"), ("O1", "c2")]),
        "Area": (["name", "organisationUnits_id"], [(None, None)]),
        "Gender": (["name", "categoryOptionCombos_id"], []),
    }
    for name, (columns, wanted) in expected.items():
        path = curated.run_curated(spark, name, out, f"{out}/curated")
        df = spark.read.parquet(path)
        assert df.columns == columns
        assert rows(df) == sorted(wanted, key=repr)
    curated.run_dimensions(spark, out, f"{out}/together", list(expected))
    for name, (columns, wanted) in expected.items():
        df = spark.read.parquet(f"{out}/together/{curated.JOBS[name].sink}")
        assert df.columns == columns
        assert rows(df) == sorted(wanted, key=repr)


def test_fact_links_name_real_columns():
    facts = enrichment.JOBS["dataElement-values"].columns.values()
    sinks = {job.sink for job in curated.JOBS.values()}
    for column, sides in curated.FACT_LINKS.items():
        assert column in facts
        assert all(sink in sinks for names in sides.values() for sink in names)


def test_extract_plans(spark, landing, out, rows):
    root = landing("orgunit/orgunit.json", {"organisationUnits": [
        {"id": "u1", "programs": [{"id": "p1"}]},
        {"id": "u2", "programs": [{"id": "p1"}, {"id": "p2"}]}]})
    units = ingestion.extract_keys(spark, "events", root)
    programs = ingestion.extract_keys(spark, "trackedentityinstances", root)
    assert rows(units) == [("u1",), ("u2",)] and rows(programs) == [("p1",), ("p2",)]
    plan = ingestion.plan_extract(spark, "events", out, units)
    assert rows(plan, "file_name", "parameters")[0] == (
        "u1.json", "orgUnit=u1&skipPaging=true&includeDeleted=true&fields=*&totalPages=true")
    landing("events/u1.json", {"events": [event("1", [])]})
    run_enrichment(spark, "events", root, out, buckets=2)
    later = ingestion.plan_extract(spark, "events", out, units)
    assert rows(later, "parameters")[0][0].endswith("&lastUpdatedStartDate=2024-03-01T10:11:12")
    with pytest.raises(ValueError, match="assigned pairs"):
        ingestion.extract_keys(spark, "dataElement-values", root)
    with pytest.raises(ValueError, match="no keys"):
        ingestion.extract_keys(spark, "users", root)
    polled = ingestion.plan_extract(spark, "events", out, units, poll="20240301")
    assert rows(polled, "file_name") == [("u1_20240301.json",), ("u2_20240301.json",)]


def test_data_value_keys(spark, landing, rows):
    root = landing("organisationUnitGroups/organisationUnitGroups.json", {
        "organisationUnitGroups": [{"id": "g1"}, {"id": "g2"}, {"name": "no id"}]})
    landing("dataSets/dataSets.json", {"dataSets": [{"id": "s1"}, {"id": "s1"}, {"id": "s2"}]})
    pairs = spark.createDataFrame(
        [("g1", "s1"), ("g1", "s1"), ("g2", "s2"), ("g2", "s9"), ("g7", "s1"), (None, "s1")],
        "organisationUnitGroup string, dataSet string")
    keys = ingestion.extract_keys(spark, "dataElement-values", root, pairs)
    assert rows(keys) == [("g1", "s1"), ("g2", "s2")]


def test_the_watermark_never_moves_back(spark, landing, out):
    marks = []
    for day, text in (("05", "a"), ("09", "b"), ("03", "c")):
        root = landing(f"dataElement-values/{day}.json", {"dataValues": [
            value(f"e{day}", "202401", text, f"2024-01-{day}T00:00:00.000+0000")]})
        run_enrichment(spark, "dataElement-values", root, out)
        table = sd.read_table(spark, f"{out}/dataElement-values")
        marks.append(sd.high_watermark(table, "lastUpdated"))
    assert marks == sorted(marks) and table.count() == 3


def test_landing_check(spark, landing):
    root = landing("categories/categories.json", {"categories": [{"id": "a", "colour": "red"}]})
    drift = ingestion.check_landing(spark, "categories", root)
    assert drift == {
        "unknown": ["categories.colour"], "missing": ["categories.dataDimensionType"]
    }


def test_land_replaces_only_its_own_requests(spark, tmp_path, rows):
    path = str(tmp_path / "landing")

    def batch(data):
        return spark.createDataFrame(data, "unit STRING, event STRING, status STRING")

    sd.land(batch([("u1", "1", "a"), ("u1", "2", "a"), ("u2", "3", "a")]), path, ["unit"], "events")
    sd.land(batch([("u1", "1", "b")]), path, ["unit"], "events")
    docs = sd.read_landing(spark, path, document_schema("events"))
    got = sd.flatten(docs, columns=["events_event", "events_status"])
    assert rows(got) == [("1", "b"), ("3", "a")]


def test_multiline_documents_and_spread(spark, tmp_path, rows):
    path = tmp_path / "pretty.json"
    path.write_text('{\n "events": [\n {"event": "1"},\n null, {"event": "2"}\n ]\n}')
    docs = sd.read_landing(spark, str(path), document_schema("events"), multiline=True)
    assert sd.has_records(docs, "events")
    out = sd.records(docs, "events", spread=3)
    assert rows(out.select("events.event")) == [("1",), ("2",)]
    assert out.rdd.getNumPartitions() == 3


def test_stream_equals_batch(spark, landing, out, tmp_path, rows):
    def follow():
        stream_enrichment(
            spark, "events", f"{root}/events", f"{out}/stream", str(tmp_path / "chk"),
            max_files=1, buckets=2,
        ).awaitTermination()

    root = landing("events/u1.json", {"events": [
        event("1", [{"dataElement": "x", "value": "5"}]), event("2", [])]})
    landing("events/u0.json", {"events": []})
    follow()
    landing("events/u2.json", {"events": [
        event("3", None), event("1", [{"dataElement": "x", "value": "5"}])]})
    follow()
    run_enrichment(spark, "events", root, out, buckets=2)
    streamed, batch = (sd.read_table(spark, f"{out}/{t}") for t in ("stream", "events"))
    assert rows(streamed) == rows(batch)
    with pytest.raises(ValueError, match="stream"):
        stream_enrichment(spark, "users", root, out, str(tmp_path / "c2"))


def test_json_scan_reads_only_declared_fields():
    pruned = document_schema("organisationUnits", ["organisationUnits_programs_id"])
    assert pruned.simpleString() == (
        "struct<organisationUnits:array<struct<programs:array<struct<id:string>>>>>"
    )
