"""Every operator and job, run over the test tables.

The tables are star-shaped, so each operator works on a stand-in: parts are the
code list, line items the group members, orders the keyed facts, documents the
nested records. Every query takes whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

import sedimenta as sd
from sedimenta.operators.dimensions import left_lookup, members_of_lists
from sedimenta.plans import curated, enrichment, ingestion
from sedimenta.schemas import RECORD_DDL
from sedimenta.session import scratch_path, use_engine_settings
from sedimenta.streaming.upserts import stream_enrichment, stream_upsert

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(make: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return make(use_engine_settings(spark), sf_dir)

        QUERIES[name] = run
        return make

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def moment(column: str) -> Column:
    """A timestamp as the source system writes it, with fraction and offset."""
    return F.concat(F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("+0000"))


def id_structs(array: Column) -> Column:
    return F.transform(array, lambda x: F.struct(x.alias("id")))


def address_words() -> Column:
    """Words of a document that hold an '@'; for most documents there are none."""
    return F.filter(F.split("text", " "), lambda w: w.contains("@"))


def documents_of(df: DataFrame, root: str, fields: dict[str, Column]) -> DataFrame:
    """Each row as a landed document with a single record; fields not given are NULL."""
    record = StructType.fromDDL(RECORD_DDL[root])
    columns = [
        fields.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in record.fields
    ]
    return df.select(F.array(F.struct(*columns)).alias(root))


def ntz(df: DataFrame, *columns: str) -> DataFrame:
    """Timestamps without zone, which is what the comparison has."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


# -- flatten, scalars, projections -----------------------------------------


@query("q01_json_parse")
def _(spark, sf):
    events = table(spark, sf, "events")
    return events.select("event_id", F.from_json("props", "k BIGINT")["k"].alias("k"))


def nested_documents(spark, sf) -> DataFrame:
    return table(spark, sf, "documents").select(
        F.struct(
            "doc_id",
            F.struct("lang", "source").alias("meta"),
            id_structs(address_words()).alias("contacts"),
            F.split("text", "\n").alias("lines"),
        ).alias("doc")
    )


@query("q02_flatten_nested")
def _(spark, sf):
    return sd.flatten(nested_documents(spark, sf)).distinct()


@query("q03_flatten_pruned")
def _(spark, sf):
    wanted = ["doc_doc_id", "doc_contacts_id", "doc_meta_lang"]
    return sd.flatten(nested_documents(spark, sf), columns=wanted).distinct()


@query("q04_array_text")
def _(spark, sf):
    scaled = F.transform("embedding", lambda x: F.round(x.cast("double") * 1000).cast("long"))
    vectors = table(spark, sf, "embeddings").select("vec_id", scaled.alias("vector"))
    return vectors.select("vec_id", sd.array_text("vector").alias("vector_text"))


@query("q05_rename_project")
def _(spark, sf):
    renamed = sd.rename(
        table(spark, sf, "customer"), {"c_custkey": "id", "c_name": "name", "absent": "x"}
    )
    return renamed.withColumn("label", F.concat("name", F.lit("/"), "c_mktsegment")).select(
        "id", "name", "label"
    )


@query("q12_iso_timestamp")
def _(spark, sf):
    landed = table(spark, sf, "events").select("event_id", moment("ts").alias("written"))
    return ntz(landed.select("event_id", sd.iso_timestamp("written").alias("ts")), "ts")


@query("q13_iso_date")
def _(spark, sf):
    landed = table(spark, sf, "events").select("event_id", moment("ts").alias("written"))
    return landed.select("event_id", sd.iso_date("written").alias("day"))


@query("q14_null_when")
def _(spark, sf):
    events = table(spark, sf, "events")
    kept = sd.null_when("value", F.col("event_type") != "purchase")
    return events.select("event_id", kept.alias("value"))


@query("q15_split_point")
def _(spark, sf):
    point = F.concat_ws(",", text("c_nationkey"), "c_mktsegment", text("c_custkey"))
    customers = table(spark, sf, "customer").select("c_custkey", point.alias("coordinates"))
    parts = sd.split_point("coordinates")
    return customers.select(
        "c_custkey", parts["long"].alias("long"), parts["lat"].alias("lat")
    )


@query("q16_contact_address")
def _(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", sd.contact_address("source", "text").alias("contact"))


@query("q18_sorted_projection")
def _(spark, sf):
    return sd.sorted_projection(
        table(spark, sf, "part"), ["p_name", "p_brand", "p_partkey"], by="p_name"
    )


@query("q27_size_guard")
def _(spark, sf):
    docs = table(spark, sf, "documents").select("lang", address_words().alias("contacts"))
    return (
        docs.filter(F.size("contacts") >= 1)
        .groupBy("lang")
        .agg(
            F.count(F.lit(1)).alias("n_docs"),
            F.sum(F.size("contacts").cast("long")).alias("n_contacts"),
        )
    )


# -- code lists and members ------------------------------------------------


def part_lists(spark, sf) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_type").alias("dimensionType"),
        F.col("p_name").alias("id"),
        F.col("p_brand").alias("name"),
        F.col("p_partkey").alias("items_id"),
    )


def item_groups(spark, sf) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("id"),
        F.col("l_returnflag").alias("name"),
        "l_suppkey",
        "l_linestatus",
        "l_orderkey",
    )


@query("q06_dimension_1hop")
def _(spark, sf):
    return sd.dimension_members(
        part_lists(spark, sf), item_groups(spark, sf), "Brand#7", "l_suppkey"
    )


@query("q06_dimension_split_join")
def _(spark, sf):
    return sd.dimension_members(
        part_lists(spark, sf), item_groups(spark, sf), "Brand#7", "l_suppkey", strategy="split"
    )


@query("q07_dimension_2hop")
def _(spark, sf):
    options = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), "o_custkey")
    return sd.dimension_members_2hop(
        part_lists(spark, sf),
        item_groups(spark, sf),
        options,
        "Brand#7",
        "o_custkey",
        link="l_orderkey",
    )


@query("q08_dimension_distinct")
def _(spark, sf):
    return sd.dimension_members(
        part_lists(spark, sf),
        item_groups(spark, sf),
        "Brand#7",
        "l_linestatus",
        distinct=True,
        member_alias="status",
        dimension_type="ECONOMY",
    )


def labelled(spark, sf, strategy="auto") -> DataFrame:
    lists = table(spark, sf, "documents").select(
        F.col("lang").alias("name"), F.col("doc_id").alias("items_id")
    )
    groups = table(spark, sf, "labels").select(
        F.col("doc_id").alias("id"),
        F.concat(F.lit("toxic "), text("toxic")).alias("name"),
        "quality",
    )
    return sd.dimension_members(lists, groups, "en", "quality", strategy=strategy)


@query("q09_dimension_dangling")
def _(spark, sf):
    return labelled(spark, sf)


@query("q09_dimension_dangling_split_join")
def _(spark, sf):
    return labelled(spark, sf, "split")


@query("q17_drop_null")
def _(spark, sf):
    return sd.drop_null(labelled(spark, sf), ["quality"])


@query("q32_left_lookup_split")
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    return left_lookup(orders, items, "o_orderkey", "l_orderkey", "split").select(
        "o_custkey", "l_partkey"
    )


@query("q38_members_of_lists")
def _(spark, sf):
    return members_of_lists(
        part_lists(spark, sf),
        item_groups(spark, sf),
        [f"Brand#{n}" for n in range(1, 26)],
        "l_suppkey",
        strategy="split",
    )


# -- pivots ----------------------------------------------------------------


@query("q10_pivot")
def _(spark, sf):
    return sd.pivot_translations(
        table(spark, sf, "events"),
        ["user_id"],
        "event_type",
        F.lit(None).cast("string"),
        "value",
        agg=F.max,
    )


@query("q11_pivot_translations")
def _(spark, sf):
    return sd.pivot_translations(
        table(spark, sf, "documents"), ["source"], F.lit("CHARS"), "lang", "n_chars"
    )


@query("q11_spread_translations")
def _(spark, sf):
    translations = F.array(
        F.struct(F.col("lang").alias("locale"), F.lit("SOURCE").alias("property"),
                 F.col("source").alias("value")),
        F.struct(F.lit("xx").alias("locale"), F.lit("SIZE").alias("property"),
                 text("n_chars").alias("value")),
    )
    docs = table(spark, sf, "documents").select("doc_id", translations.alias("translations"))
    return sd.spread_translations(
        docs, ["doc_id"], "translations", [f"SOURCE_{x}" for x in ("de", "en", "es", "fr")]
    )


# -- watermarks, upserts, requests -----------------------------------------


@query("q19_watermark")
def _(spark, sf):
    newest = sd.max_of(table(spark, sf, "events"), "ts")
    return newest.select(sd.iso_text("max_value").alias("watermark"))


@query("q19_watermark_by_key")
def _(spark, sf):
    return sd.high_watermark(table(spark, sf, "events"), "ts", by="user_id")


@query("q20_changed_since")
def _(spark, sf):
    return sd.changed_since(table(spark, sf, "events"), "ts", "2024-01-15T12:00:00").select(
        "event_id", "ts"
    )


@query("q30_global_max")
def _(spark, sf):
    return sd.max_of(table(spark, sf, "events"), "ts", "max_ts")


ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")


def old_orders(spark, sf) -> DataFrame:
    orders = table(spark, sf, "orders").select(*ORDER_COLUMNS)
    return orders.filter("o_orderdate < TIMESTAMP_NTZ '1998-01-01'")


def new_orders(spark, sf) -> DataFrame:
    orders = table(spark, sf, "orders").select(*ORDER_COLUMNS)
    changed = sd.changed_since(orders, "o_orderdate", "1996-01-01T00:00:00")
    return changed.withColumn("o_orderstatus", F.lit("X"))


@query("q21_upsert")
def _(spark, sf):
    return sd.upsert(old_orders(spark, sf), new_orders(spark, sf), ["o_orderkey"])


@query("q22_upsert_composite")
def _(spark, sf):
    columns = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity")
    items = table(spark, sf, "lineitem").select(*columns)
    old = items.filter("l_shipdate < TIMESTAMP_NTZ '1998-01-01'")
    new = sd.changed_since(items, "l_shipdate", "1996-01-01T00:00:00").withColumn(
        "l_quantity", F.col("l_quantity") + 1
    )
    return sd.upsert(
        old, new, columns[:4], on_duplicate="latest", order_by="l_shipdate"
    )


@query("q23_latest_per_key")
def _(spark, sf):
    items = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey"
    )
    return sd.latest_per_key(items, ["l_orderkey", "l_linenumber"], "l_shipdate")


def status_key() -> Column:
    return F.nullif(F.col("o_orderstatus"), F.lit("P"))


@query("q24_upsert_null_safe")
def _(spark, sf):
    old = old_orders(spark, sf).withColumn("o_orderstatus", status_key())
    new = sd.changed_since(
        table(spark, sf, "orders").select(*ORDER_COLUMNS), "o_orderdate", "1996-01-01T00:00:00"
    )
    new = new.withColumns({"o_orderstatus": status_key(), "o_custkey": -F.col("o_custkey")})
    return sd.upsert(old, new, ["o_orderkey", "o_orderstatus"], null_safe=True)


@query("q24_upsert_null_never_matches")
def _(spark, sf):
    old = old_orders(spark, sf).withColumn("o_orderstatus", status_key())
    new = sd.changed_since(
        table(spark, sf, "orders").select(*ORDER_COLUMNS), "o_orderdate", "1996-01-01T00:00:00"
    )
    new = new.withColumns({"o_orderstatus": status_key(), "o_custkey": -F.col("o_custkey")})
    return sd.upsert(old, new, ["o_orderkey", "o_orderstatus"], null_safe=False)


@query("q29_soft_delete")
def _(spark, sf):
    old = old_orders(spark, sf).withColumn("deleted", F.lit(False))
    new = new_orders(spark, sf).withColumn("deleted", F.col("o_custkey") < 100)
    return sd.upsert(old, new, ["o_orderkey"], on_duplicate="allow")


@query("q29_active_only")
def _(spark, sf):
    flagged = table(spark, sf, "orders").select(
        "o_orderkey", (status_key() == "F").alias("deleted")
    )
    return sd.active_only(flagged).select("o_orderkey")


@query("q33_upsert_newer_only")
def _(spark, sf):
    old = table(spark, sf, "orders").select(*ORDER_COLUMNS)
    shifted = F.when(
        F.col("o_orderstatus") == "F", F.expr("o_orderdate - INTERVAL 1 DAY")
    ).otherwise(F.expr("o_orderdate + INTERVAL 1 DAY"))
    new = old.withColumns({"o_orderdate": shifted, "o_custkey": -F.col("o_custkey")})
    return sd.upsert(
        old, new, ["o_orderkey"], on_duplicate="allow", newer_only="o_orderdate"
    )


@query("q25_request_plan")
def _(spark, sf):
    keys = table(spark, sf, "supplier").select(
        F.col("s_nationkey").alias("organisationUnitGroup"), F.col("s_suppkey").alias("dataSet")
    )
    mark = sd.high_watermark(table(spark, sf, "events"), "ts")
    return ingestion.plan_extract(spark, "dataElement-values", sf, keys, mark)


@query("q25_request_plan_by_key")
def _(spark, sf):
    keys = table(spark, sf, "customer").select(text("c_custkey").alias("organisationUnit"))
    orders = table(spark, sf, "orders").select(
        text("o_custkey").alias("organisationUnit"), "o_orderdate"
    )
    marks = sd.high_watermark(orders, "o_orderdate", by="organisationUnit")
    return ingestion.plan_extract(spark, "events", sf, keys, marks)


@query("q26_id_list")
def _(spark, sf):
    docs = table(spark, sf, "documents").select(
        F.array(F.struct(id_structs(F.split("text", " ")).alias("programs"))).alias("units")
    )
    return sd.id_list(docs, "units.programs")


# -- tables, landing, streams ----------------------------------------------


@query("q28_stream_upsert")
def _(spark, sf):
    """All events, then a second run of the stream with new values for a fifth of them."""
    events = table(spark, sf, "events")
    landing, target = scratch_path(spark, "landing"), scratch_path(spark, "events")
    checkpoint = scratch_path(spark, "stream")
    changed = events.filter("event_id % 5 = 0").withColumn("value", F.lit(-1.0))
    for batch in (events, changed):
        batch.write.mode("append").parquet(landing)
        stream_upsert(
            spark.readStream.schema(events.schema).parquet(landing), target, ["event_id"],
            checkpoint, buckets=8, bucket_by=["event_id"],
        ).awaitTermination()
    return sd.read_table(spark, target)


@query("q28_stream_enrichment")
def _(spark, sf):
    """Two polls of landed JSON and an empty document, followed by the events job."""
    root, target = scratch_path(spark, "raw"), scratch_path(spark, "events")
    checkpoint = scratch_path(spark, "stream")
    for poll in (1, 2):
        land_poll(spark, sf, root, "events", poll)
        stream_enrichment(
            spark, "events", f"{root}/events", target, checkpoint, buckets=8
        ).awaitTermination()
    return ntz(sd.read_table(spark, target), *enrichment.JOBS["events"].timestamps)


@query("q34_overwrite_snapshot")
def _(spark, sf):
    path = scratch_path(spark, "orders")
    sd.overwrite_snapshot(table(spark, sf, "orders").select(*ORDER_COLUMNS), path)
    sd.overwrite_snapshot(
        sd.read_table(spark, path).withColumn("o_year", F.year("o_orderdate")), path
    )
    return sd.read_table(spark, path)


@query("q35_load_incremental")
def _(spark, sf):
    path = scratch_path(spark, "orders")
    keys = ["o_orderkey", "o_custkey"]
    layout = {"buckets": 8, "bucket_by": ["o_custkey"]}
    sd.load_incremental(old_orders(spark, sf), path, keys, **layout)
    sd.load_incremental(new_orders(spark, sf), path, keys)
    return sd.read_table(spark, path)


@query("q35_load_incremental_typed")
def _(spark, sf):
    """Batches whose keys are narrower than the table's meet the same slices."""
    path = scratch_path(spark, "orders")
    layout = {"buckets": 8, "bucket_by": ["o_orderkey"]}
    sd.load_incremental(old_orders(spark, sf), path, ["o_orderkey"], **layout)
    narrow = new_orders(spark, sf).withColumns(
        {c: F.col(c).cast("int") for c in ("o_orderkey", "o_custkey")}
    )
    sd.load_incremental(narrow, path, ["o_orderkey"])
    return sd.read_table(spark, path)


@query("q35_load_over_parquet")
def _(spark, sf):
    """A folder of plain Parquet becomes the table's first version."""
    path = scratch_path(spark, "orders")
    old_orders(spark, sf).write.parquet(path)
    sd.load_incremental(new_orders(spark, sf), path, ["o_orderkey"], buckets=8)
    return sd.read_table(spark, path)


@query("q36_land_and_read")
def _(spark, sf):
    path = scratch_path(spark, "landing")
    rows = table(spark, sf, "events").select(
        "event_type", text("event_id").alias("event"), moment("ts").alias("lastUpdated"),
        F.array(F.struct(F.lit("v").alias("dataElement"),
                         F.get_json_object("props", "$.k").alias("value"))).alias("dataValues"),
    )
    sd.land(rows, path, ["event_type"], "events")
    job = enrichment.JOBS["events"]
    landed = enrichment.enrich(job, sd.read_landing(spark, path, job.schema()))
    return ntz(
        landed.select("event", "dataElement", "dataValues_value", "lastUpdated"), "lastUpdated"
    )


@query("q37_write_curated")
def _(spark, sf):
    path = scratch_path(spark, "curated")
    sd.write_curated(labelled(spark, sf), path)
    sd.table_view(spark, path, "curated_labels")
    return spark.sql("SELECT name, count(*) AS n FROM curated_labels GROUP BY name")


# -- the enrichment jobs ---------------------------------------------------


def raw_categories(spark, sf):
    return documents_of(
        table(spark, sf, "customer"),
        "categories",
        {"id": F.col("c_mktsegment"), "dataDimensionType": F.col("c_nationkey")},
    )


def raw_category_options(spark, sf):
    return documents_of(
        table(spark, sf, "documents"),
        "categoryOptions",
        {
            "id": F.col("doc_id"),
            "name": F.col("lang"),
            "categoryOptionCombos": id_structs(address_words()),
        },
    )


def raw_category_option_groups(spark, sf):
    return documents_of(
        table(spark, sf, "pages"),
        "categoryOptionGroups",
        {
            "id": F.col("page_id"),
            "name": F.col("url"),
            "categoryOptions": id_structs(F.split("url", "/")),
        },
    )


def raw_data_element_groups(spark, sf):
    return documents_of(
        table(spark, sf, "conversations"),
        "dataElementGroups",
        {
            "id": F.concat_ws("-", text("conv_id"), text("turn")),
            "name": F.col("role"),
            "dataElements": id_structs(F.split("text", "\n")),
        },
    )


def raw_organisation_unit_groups(spark, sf):
    members = F.transform(
        "embedding", lambda x: F.round(x.cast("double") * 1000).cast("long").cast("string")
    )
    return documents_of(
        table(spark, sf, "embeddings"),
        "organisationUnitGroups",
        {
            "id": F.col("vec_id"),
            "name": F.col("label"),
            "organisationUnits": id_structs(members),
        },
    )


def raw_dimensions(spark, sf):
    return documents_of(
        table(spark, sf, "part"),
        "dimensions",
        {
            "dimensionType": F.col("p_type"),
            "id": F.col("p_brand"),
            "name": F.col("p_name"),
            "items": id_structs(F.split("p_name", " ")),
        },
    )


def raw_users(spark, sf):
    day = F.expr("date_add(DATE '2024-01-01', CAST(n_chars % 365 AS INT))")
    return documents_of(
        table(spark, sf, "documents"),
        "users",
        {
            "id": F.col("doc_id"),
            "displayName": F.col("lang"),
            "email": F.col("text"),
            "userCredentials": F.struct(
                F.when(F.col("lang") == "fr", F.lit("never"))
                .otherwise(F.concat(text(day), F.lit("T10:11:12.345+0000")))
                .alias("lastLogin"),
                (F.col("n_chars") > 2000).alias("disabled"),
                F.col("source").alias("username"),
            ),
        },
    )


def translation(prop: str, locale: str, value: Column) -> Column:
    return F.struct(
        F.lit(locale).alias("locale"), F.lit(prop).alias("property"), value.alias("value")
    )


def raw_data_elements(spark, sf):
    translations = F.when(
        F.col("p_type") == "PROMO", F.array().cast(
            "array<struct<locale:string,property:string,value:string>>")
    ).otherwise(
        F.array(
            translation("NAME", "fr", F.col("p_name")),
            translation("SHORT_NAME", "fr", F.col("p_type")),
            translation("NAME", "en", F.col("p_brand")),
        )
    )
    return documents_of(
        table(spark, sf, "part"),
        "dataElements",
        {
            "id": F.col("p_partkey"),
            "name": F.col("p_name"),
            "code": F.col("p_brand"),
            "shortName": F.col("p_type"),
            "favorite": F.col("p_size") > 25,
            "translations": translations,
        },
    )


def raw_organisation_units(spark, sf):
    segment = F.col("c_mktsegment")
    level = (
        F.when(segment == "BUILDING", 4).when(segment == "MACHINERY", F.lit(None)).otherwise(2)
    )
    point = F.struct(F.array(text("c_nationkey"), text("c_custkey")).alias("coordinates"))
    return documents_of(
        table(spark, sf, "customer"),
        "organisationUnits",
        {
            "id": F.col("c_custkey"),
            "name": F.col("c_name"),
            "shortName": segment,
            "level": level,
            "path": F.concat(F.lit("/"), text("c_nationkey"), F.lit("/"), text("c_custkey")),
            "parent": F.struct(text("c_nationkey").alias("id")),
            "geometry": F.when(F.col("c_acctbal") > 0, point),
            "translations": F.array(translation("NAME", "fr", F.col("c_name"))),
            "programs": F.array(F.struct(segment.alias("id"))),
        },
    )


def raw_data_values(spark, sf):
    return documents_of(
        table(spark, sf, "lineitem"),
        "dataValues",
        {
            "dataElement": F.col("l_partkey"),
            "period": F.date_format("l_shipdate", "yyyy"),
            "orgUnit": F.col("l_suppkey"),
            "categoryOptionCombo": F.col("l_returnflag"),
            "attributeOptionCombo": F.col("l_linenumber"),
            "value": F.col("l_quantity").cast("long"),
            "storedBy": F.col("l_linestatus"),
            "created": moment("l_shipdate"),
            "lastUpdated": moment("l_shipdate"),
            "followup": F.col("l_quantity") > 25,
        },
    )


def raw_events(spark, sf):
    values = F.array(
        F.struct(
            F.lit("k").alias("dataElement"),
            F.get_json_object("props", "$.k").alias("value"),
            moment("ts").alias("lastUpdated"),
        )
    )
    return documents_of(
        table(spark, sf, "events"),
        "events",
        {
            "program": F.col("event_type"),
            "event": F.col("event_id"),
            "orgUnit": F.col("user_id"),
            "eventDate": moment("ts"),
            "lastUpdated": moment("ts"),
            "created": F.lit("not a time"),
            "deleted": F.col("value") > 50,
            "dataValues": F.when(F.col("event_type") != "view", values),
        },
    )


def raw_tracked_entities(spark, sf):
    attributes = F.array(
        F.struct(F.lit("NAME").alias("code"), F.col("c_name").alias("value")),
        F.struct(F.lit(None).cast("string").alias("code"), F.lit("lost").alias("value")),
        F.struct(F.lit("NATION").alias("code"), text("c_nationkey").alias("value")),
    )
    owners = F.array(
        F.struct(F.col("c_mktsegment").alias("program")), F.struct(F.lit("ALL").alias("program"))
    )
    return documents_of(
        table(spark, sf, "customer"),
        "trackedEntityInstances",
        {
            "trackedEntityInstance": F.col("c_custkey"),
            "orgUnit": F.col("c_nationkey"),
            "lastUpdated": F.lit("2024-02-03T04:05:06.789+0000"),
            "inactive": F.col("c_acctbal") < 0,
            "programOwners": F.when(F.col("c_nationkey") > 4, owners),
            "attributes": attributes,
        },
    )


RAW = {
    "categories": raw_categories,
    "categoryOptions": raw_category_options,
    "categoryOptionGroups": raw_category_option_groups,
    "dataElementGroups": raw_data_element_groups,
    "organisationUnitGroups": raw_organisation_unit_groups,
    "dimension": raw_dimensions,
    "users": raw_users,
    "dataelement": raw_data_elements,
    "orgunit": raw_organisation_units,
    "dataElement-values": raw_data_values,
    "events": raw_events,
    "trackedentityinstances": raw_tracked_entities,
}


def enriched(spark, sf, name: str) -> DataFrame:
    return enrichment.enrich(name, RAW[name](spark, sf))


def loaded(spark, sf, name: str) -> DataFrame:
    """The job's table after a full load and a second one of what changed of late."""
    path = scratch_path(spark, name)
    rows = enriched(spark, sf, name)
    enrichment.load(name, rows, path, buckets=8)
    mark = sd.high_watermark(sd.read_table(spark, path), "lastUpdated")
    recent = sd.changed_since(rows, "lastUpdated", mark, lookback=86400)
    enrichment.load(name, recent, path)
    return sd.read_table(spark, path)


def _register_enrichment(name: str) -> None:
    job = enrichment.JOBS[name]

    @query("e_" + name.replace("-", "_"))
    def _(spark, sf):
        rows = (loaded if job.keys else enriched)(spark, sf, name)
        return ntz(rows, *job.timestamps)


for _name in enrichment.JOBS:
    _register_enrichment(_name)


# -- the curated jobs ------------------------------------------------------

# One code list per brand: the 23 curated ones, then two that are not curated.
LIST_NAMES = [*(d.name for d in curated.DIMENSIONS), "Other list", "Further list"]


def curated_inputs(spark, sf) -> dict[str, DataFrame]:
    number = F.expr("CAST(substring(p_brand, 7) AS INT)")
    items = table(spark, sf, "lineitem")
    names = F.concat("l_returnflag", F.lit("-"), "l_linestatus")

    def members(column: str) -> DataFrame:
        return items.select(
            text("l_partkey").alias("id"), names.alias("name"), text("l_suppkey").alias(column)
        )

    return {
        "dimension": table(spark, sf, "part").select(
            F.col("p_type").alias("dimensionType"),
            F.col("p_brand").alias("id"),
            F.element_at(F.array(*[F.lit(n) for n in LIST_NAMES]), number).alias("name"),
            text("p_partkey").alias("items_id"),
        ),
        "organisationUnitGroups": members("organisationUnits_id"),
        "dataElementGroups": members("dataElements_id"),
        "categoryOptionGroups": items.select(
            text("l_partkey").alias("id"),
            names.alias("name"),
            text("l_orderkey").alias("categoryOptions_id"),
        ),
        "categoryOptions": members("categoryOptionCombos_id"),
        "orders": table(spark, sf, "orders").select(
            text("o_orderkey").alias("id"),
            F.col("o_orderpriority").alias("name"),
            text("o_custkey").alias("categoryOptionCombos_id"),
        ),
    }


def _register_curated(name: str) -> None:
    job = curated.JOBS[name]

    @query("c_" + job.sink.replace("-", "_").lower())
    def _(spark, sf):
        if isinstance(job, curated.Output):
            rows = enriched(spark, sf, job.table)
            stamps = enrichment.JOBS[job.table].timestamps
            return ntz(curated.curate(name, {job.table: rows}), *stamps)
        tables = curated_inputs(spark, sf)
        if job.through:
            tables["categoryOptions"] = tables["orders"]
        return curated.curate(name, tables)


for _name in curated.JOBS:
    _register_curated(_name)


@query("q31_curated_values_projected")
def _(spark, sf):
    return curated.curate_values(enriched(spark, sf, "dataElement-values"), project=True)


# -- whole chains, with JSON files in between --------------------------------


#: Documents of a landed file: packed files are not split, so each is kept small.
LANDED_DOCUMENTS = 250_000


def land_documents(root: str, documents: DataFrame, source: str) -> None:
    """Packed, as JSON repeats every name in every record: it takes an eighth of the disk."""
    packed = documents.write.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
    packed.option("maxRecordsPerFile", LANDED_DOCUMENTS).json(f"{root}/{source}")


# What the second poll changes of every record whose number is divisible by seven:
# the field with the number, and the field that gets another value.
SECOND_POLL = {
    "dataElement-values": ("dataElement", "value"),
    "events": ("event", "orgUnit"),
    "trackedentityinstances": ("trackedEntityInstance", "orgUnit"),
}


def land_poll(spark, sf, root: str, name: str, poll: int) -> None:
    """Land all documents of a job, or at the second poll those changed and an empty one."""
    job = enrichment.JOBS[name]
    documents = RAW[name](spark, sf)
    if poll == 2:
        number, changed = SECOND_POLL[name]
        late = F.lit("2030-01-01T00:00:00.000+0000")
        documents = documents.filter(
            F.exists(job.root, lambda r: r[number].cast("long") % 7 == 0)
        ).select(
            F.transform(
                job.root,
                lambda r: r.withField(changed, F.lit("changed")).withField("lastUpdated", late),
            ).alias(job.root)
        )
        empty = spark.range(1).select(F.array().cast("array<string>").alias(job.root))
        land_documents(root, empty, f"{job.source}/empty")
    land_documents(root, documents, f"{job.source}/poll{poll}" if job.keys else job.source)


def _register_landed(name: str) -> None:
    job = enrichment.JOBS[name]

    @query("j_landed_" + name.replace("-", "_"))
    def _(spark, sf):
        root = scratch_path(spark, "raw")
        for poll in (1, 2) if job.keys else (1,):
            land_poll(spark, sf, root, name, poll)
            options = {"buckets": 8} if job.keys else {}
            enrichment.run_enrichment(spark, name, root, f"{root}/flat", **options)
        return ntz(sd.read_table(spark, f"{root}/flat/{name}"), *job.timestamps)


for _name in enrichment.JOBS:
    _register_landed(_name)


@query("j_landed_with_bad_document")
def _(spark, sf):
    """Documents cut short are set aside and counted; the others make the table."""
    root, job = scratch_path(spark, "raw"), enrichment.JOBS["categories"]
    land_documents(root, raw_categories(spark, sf), job.source)
    cut = table(spark, sf, "nation").select(
        F.format_string('{"categories":[{"id":"%s"', F.col("n_name"))
    )
    cut.write.mode("append").text(f"{root}/{job.source}")
    enrichment.run_enrichment(spark, job.name, root, f"{root}/flat", unreadable="skip")
    aside = sd.unreadable_documents(spark, f"{root}/{job.source}", job.schema())
    counted = aside.agg(F.count("*").alias("set_aside"))
    return sd.read_table(spark, f"{root}/flat/categories").join(counted)


@query("j_landing_drift")
def _(spark, sf):
    """Fields that landed undeclared, and declared ones that did not land."""
    root = scratch_path(spark, "raw")
    record = F.struct(F.col("c_mktsegment").alias("id"), F.col("c_nationkey").alias("code"))
    documents = table(spark, sf, "customer").select(F.array(record).alias("categories"))
    land_documents(root, documents, enrichment.JOBS["categories"].source)
    drift = ingestion.check_landing(spark, "categories", root)
    rows = [(kind, field) for kind, fields in drift.items() for field in fields]
    return spark.createDataFrame(rows, "kind string, field string")


@query("j_landed_org_units")
def _(spark, sf):
    root = scratch_path(spark, "raw")
    land_documents(root, raw_organisation_units(spark, sf), "orgunit/orgunit.json")
    enrichment.run_enrichment(spark, "orgunit", root, f"{root}/flat")
    return sd.read_table(spark, f"{root}/flat/orgunit")


@query("j_landed_dimensions")
def _(spark, sf):
    """Code lists, groups and options as landed JSON, to two curated dimensions."""
    root = scratch_path(spark, "raw")
    inputs = curated_inputs(spark, sf)

    def members(column: str) -> Column:
        return F.array(F.struct(F.col(column).alias("id")))

    records = {
        "dimension": ("dimensions", inputs["dimension"], "items", "items_id"),
        "categoryOptionGroups": (
            "categoryOptionGroups", inputs["categoryOptionGroups"], "categoryOptions",
            "categoryOptions_id",
        ),
        "categoryOptions": (
            "categoryOptions", inputs["orders"], "categoryOptionCombos",
            "categoryOptionCombos_id",
        ),
    }
    for name, (collection, df, array, column) in records.items():
        fields = {c: F.col(c) for c in df.columns if c != column} | {array: members(column)}
        documents = documents_of(df, collection, fields)
        land_documents(root, documents, enrichment.JOBS[name].source)
        enrichment.run_enrichment(spark, name, root, f"{root}/flat")
    names = ["Donor", "Funding Agency"]
    curated.run_dimensions(spark, f"{root}/flat", f"{root}/curated", names)
    donor, agency = (
        spark.read.parquet(f"{root}/curated/{curated.JOBS[n].sink}").withColumn(
            "dimension", F.lit(n)
        )
        for n in names
    )
    return donor.unionByName(agency)


def planned_requests(spark, sf, folder: str) -> DataFrame:
    root = scratch_path(spark, "raw")
    land_documents(root, raw_organisation_units(spark, sf), "orgunit/orgunit.json")
    keys = ingestion.extract_keys(spark, folder, root)
    mark = sd.high_watermark(table(spark, sf, "events"), "ts")
    return ingestion.plan_extract(spark, folder, f"{root}/flat", keys, mark)


@query("i_datavalues")
def _(spark, sf):
    """Assigned pairs of unit groups and data sets, of those that have landed."""
    root = scratch_path(spark, "raw")
    groups = ingestion.EXTRACTS["organisationUnitGroups"]
    land_documents(
        root, raw_organisation_unit_groups(spark, sf), f"{groups.folder}/{groups.file_name}"
    )
    sets = documents_of(
        table(spark, sf, "nation").filter("n_regionkey <> 0"), "dataSets", {"id": F.col("n_nationkey")}
    )
    land_documents(root, sets, ingestion.DATA_SETS)
    pairs = table(spark, sf, "embeddings").select(
        text("vec_id").alias("organisationUnitGroup"), text("label").alias("dataSet")
    )
    keys = ingestion.extract_keys(spark, "dataElement-values", root, pairs)
    mark = sd.high_watermark(table(spark, sf, "events"), "ts")
    return ingestion.plan_extract(spark, "dataElement-values", f"{root}/flat", keys, mark)


@query("i_events")
def _(spark, sf):
    return planned_requests(spark, sf, "events")


@query("i_trackedentityinstances")
def _(spark, sf):
    return planned_requests(spark, sf, "trackedentityinstances")
