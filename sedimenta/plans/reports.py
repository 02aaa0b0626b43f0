"""Queries over what the layers hold: stars, hierarchies, snapshots, code lists.

As in the showcase, every operator works on stand-ins made of the given tables: documents
are the facts, pages and labels the bridges to their groups, addresses the tree of units,
languages and sources the code lists.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

import sedimenta as sd
from sedimenta.operators.counting import counted, refresh_members
from sedimenta.operators.coverage import gaps, islands
from sedimenta.operators.difference import row_difference, snapshot_difference, with_deletions
from sedimenta.operators.factorised import factorise
from sedimenta.operators.heavy import heavy_join
from sedimenta.operators.hierarchy import hierarchy, roll_up
from sedimenta.operators.membership import (
    list_bitmaps,
    member_numbers,
    members_matching,
    members_of,
    overlaps,
)
from sedimenta.operators.star import Link, star_report
from sedimenta.plans.enrichment import JOBS
from sedimenta.plans.showcase import (
    land_documents,
    nested_documents,
    ntz,
    query,
    raw_category_options,
    table,
    text,
)
from sedimenta.session import scratch_path, stage
from sedimenta.sources.drift import landing_drift
from sedimenta.streaming.upserts import stream_latest

# -- a star over two bridges ---------------------------------------------------


def site_parts(spark, sf) -> DataFrame:
    """Every page is in one group for each part of its host's name."""
    host = F.split(F.element_at(F.split("url", "/"), 3), r"\.")
    return table(spark, sf, "pages").select(F.explode(host).alias("name"), "page_id")


def mark_groups(spark, sf) -> DataFrame:
    marks = [F.concat(F.lit(f"{c} "), text(c)) for c in ("quality", "toxic")]
    return table(spark, sf, "labels").select(F.explode(F.array(*marks)).alias("name"), "doc_id")


def document_star(spark, sf, sharing: str) -> DataFrame:
    links = {
        "part": Link(site_parts(spark, sf), "page", "page_id"),
        "mark": Link(mark_groups(spark, sf), "doc_id", "doc_id"),
    }
    facts = table(spark, sf, "documents").select(
        "lang", "doc_id", F.col("doc_id").alias("page"), "n_chars"
    )
    return star_report(facts, links, ["n_chars"], ["lang"], sharing)


@query("q39_star_each")
def _(spark, sf):
    return document_star(spark, sf, "each")


@query("q39_star_split")
def _(spark, sf):
    return document_star(spark, sf, "split")


@query("q39_star_sets")
def _(spark, sf):
    sets = document_star(spark, sf, "sets")
    return sets.withColumns({c: F.array_join(c, "+") for c in ("part", "mark")})


# -- code lists as bitmaps -----------------------------------------------------


def document_lists(spark, sf) -> DataFrame:
    """Documents by language, by source, and by their marks."""
    docs = table(spark, sf, "documents")
    named = docs.select(F.explode(F.array("lang", "source")).alias("list"), "doc_id")
    return named.unionAll(mark_groups(spark, sf).select("name", "doc_id"))


def document_bitmaps(spark, sf) -> DataFrame:
    lists = document_lists(spark, sf)
    return list_bitmaps(lists, member_numbers(lists, "doc_id"), "list", "doc_id")


@query("q40_list_overlaps")
def _(spark, sf):
    return overlaps(document_bitmaps(spark, sf))


@query("q40_list_questions")
def _(spark, sf):
    lists = document_lists(spark, sf)
    numbers = member_numbers(lists, "doc_id")
    bitmaps = stage(list_bitmaps(lists, numbers, "list", "doc_id"), "bitmaps")
    questions = {
        "good English": {"all_of": ["en", "quality 1"], "none_of": ["toxic 1"]},
        "src0 or src1, not German": {"any_of": ["src0", "src1"], "none_of": ["de"]},
        "toxic French or Spanish": {"all_of": ["toxic 1"], "any_of": ["fr", "es"]},
    }
    answers = [
        members_of(members_matching(bitmaps, **q), numbers).select(
            F.lit(name).alias("question"), F.col("member").alias("doc_id")
        )
        for name, q in questions.items()
    ]
    return answers[0].unionAll(answers[1]).unionAll(answers[2])


# -- a hierarchy ---------------------------------------------------------------


def address_steps() -> Column:
    """An address from its last host label to the whole of it: com, example.com, ..."""
    whole = F.regexp_extract("url", r"^[a-z]+://([^?#]*?)/*(?:[?#].*)?$", 1)
    host = F.split(F.substring_index(whole, "/", 1), r"\.")
    depth = F.size(host)
    hosts = F.transform(
        F.sequence(F.lit(1), depth), lambda k: F.array_join(F.slice(host, depth - k + 1, k), ".")
    )
    rest = F.slice(F.split(whole, "/"), 2, F.size(F.split(whole, "/")))
    full = F.element_at(hosts, -1)
    paths = F.transform(
        F.when(F.size(rest) > 0, F.sequence(F.lit(1), F.size(rest))).otherwise(F.array().cast("array<int>")),
        lambda k: F.concat(full, F.lit("/"), F.array_join(F.slice(rest, 1, k), "/")),
    )
    return F.concat(hosts, paths)


def address_tree(spark, sf) -> DataFrame:
    steps = table(spark, sf, "pages").select(address_steps().alias("steps"))
    edges = steps.select(F.posexplode("steps").alias("at", "id"), "steps").select(
        "id", F.when(F.col("at") > 0, F.expr("steps[at - 1]")).alias("parent_id")
    )
    return edges.distinct()


@query("q41_hierarchy_closure")
def _(spark, sf):
    return hierarchy(address_tree(spark, sf)).closure


@query("q41_hierarchy_roll_up")
def _(spark, sf):
    closure = hierarchy(address_tree(spark, sf)).closure
    pages = table(spark, sf, "pages").select(
        F.element_at(address_steps(), -1).alias("unit"), F.octet_length("html").cast("long").alias("n_bytes")
    )
    return roll_up(pages, closure, "unit", ["n_bytes"])


@query("q41_hierarchy_faults")
def _(spark, sf):
    """Documents below the one that their size points to: orphans, cycles, wrong levels."""
    units = table(spark, sf, "documents").select(
        text("doc_id").alias("id"),
        F.when(F.col("lang") != "fr", text("n_chars")).alias("parent_id"),
        F.lit(2).alias("level"),
    )
    return hierarchy(units, level_col="level").faults


# -- snapshots -------------------------------------------------------------------


def old_documents(spark, sf) -> DataFrame:
    """A snapshot from before French documents came, and before src0 was counted anew."""
    docs = table(spark, sf, "documents").filter("lang <> 'fr'")
    return docs.withColumn("n_chars", F.when(F.col("source") == "src0", -1).otherwise(F.col("n_chars")))


def new_documents(spark, sf) -> DataFrame:
    return table(spark, sf, "documents").filter("lang <> 'es'")


@query("q42_snapshot_difference")
def _(spark, sf):
    return snapshot_difference(old_documents(spark, sf), new_documents(spark, sf), ["doc_id"])


@query("q42_row_difference")
def _(spark, sf):
    columns = ("lang", "source", "text")
    return row_difference(
        old_documents(spark, sf).select(*columns), new_documents(spark, sf).select(*columns)
    )


@query("q42_with_deletions")
def _(spark, sf):
    """Three snapshots: all but French, all but Spanish, all."""
    columns = ("doc_id", "lang", "n_chars")
    held, path = None, scratch_path(spark, "documents")
    snapshots = (old_documents(spark, sf), new_documents(spark, sf), old_documents(spark, sf))
    for day, snapshot in enumerate(snapshots, 1):
        at = F.lit(f"2024-01-0{day} 00:00:00")
        rows = with_deletions(held, snapshot.select(*columns), ["doc_id"], at)
        sd.overwrite_snapshot(rows, path)
        held = sd.read_table(spark, path)
    return ntz(held, "deleted_at")


# -- batches that bring columns ----------------------------------------------------


@query("q43_load_new_columns")
def _(spark, sf):
    """Labels without a column, then some with it and with wider keys."""
    path = scratch_path(spark, "labels")
    labels = table(spark, sf, "labels")
    first = labels.select(F.col("doc_id").cast("int"), "quality")
    sd.load_incremental(first, path, ["doc_id"], buckets=8)
    marked = labels.filter("toxic = 1").select("doc_id", "toxic", F.lit("seen").alias("note"))
    sd.load_incremental(marked, path, ["doc_id"], merge_schema=True)
    return sd.read_table(spark, path)


# -- what has been fetched ----------------------------------------------------------


def fetched(spark, sf) -> DataFrame:
    """Every document as a fetch of its source: from its number on, as far as its size."""
    return table(spark, sf, "documents").select(
        F.col("source").alias("unit"),
        F.col("doc_id").alias("start"),
        (F.col("doc_id") + F.col("n_chars") % 40).alias("end"),
    )


def covered(spark, sf) -> DataFrame:
    return islands(fetched(spark, sf), ["unit"], span=F.floor(F.col("start") / 1000))


@query("q44_coverage_islands")
def _(spark, sf):
    return covered(spark, sf)


@query("q44_coverage_gaps")
def _(spark, sf):
    """What each source still lacks of all numbers from its own smallest to 100 past the largest."""
    wanted = fetched(spark, sf).groupBy("unit").agg(
        F.min("start").alias("start"), (F.max("start") + 100).alias("end")
    )
    return gaps(wanted, covered(spark, sf), ["unit"])


# -- nested records as tables ---------------------------------------------------------


@query("q45_factorised_lines")
def _(spark, sf):
    """One of two sibling arrays rejoined to its records; the other multiplies nothing."""
    return factorise(nested_documents(spark, sf)).product(["doc_lines"])


@query("q45_factorised_counts")
def _(spark, sf):
    parts = factorise(nested_documents(spark, sf)).tables
    root = parts[""].select("_row", "doc_doc_id")
    for name in ("doc_lines", "doc_contacts"):
        sizes = parts[name].groupBy(F.col("_parent").alias("_row")).agg(F.count(F.lit(1)).alias(name))
        root = root.join(sizes, "_row", "left").na.fill(0, [name])
    return root.drop("_row")


@query("q46_landing_drift_types")
def _(spark, sf):
    """Fields of other types than declared, undeclared ones and absent ones, from one scan."""
    root, job = scratch_path(spark, "raw"), JOBS["categoryOptions"]
    renamed = raw_category_options(spark, sf).select(
        F.transform(
            "categoryOptions",
            lambda r: r.withField("code", F.length(r["name"])).withField("id", F.struct(r["id"])).dropFields("name"),
        ).alias("categoryOptions")
    )
    land_documents(root, renamed, job.source)
    return landing_drift(spark, f"{root}/{job.source}", job.schema())


# -- dimensions that follow their inputs ------------------------------------------------


@query("q47_refresh_members")
def _(spark, sf):
    """English documents by their marks, after src0 left the list and toxic ones got groups."""
    lists = table(spark, sf, "documents").select(
        F.lit("t").alias("dimensionType"), F.col("lang").alias("id"), F.col("lang").alias("name"),
        F.col("doc_id").alias("items_id"), "source",
    )
    marks = table(spark, sf, "labels").select(
        F.col("doc_id").alias("id"), F.concat(F.lit("quality "), text("quality")).alias("name"),
        (F.col("doc_id") * 10 + F.col("toxic")).alias("member"), "toxic",
    )
    items = (lists.drop("source"), lists.filter("source <> 'src0'").drop("source"))
    groups = (marks.filter("toxic = 0").drop("toxic"), marks.drop("toxic"))

    def build(part, near):
        return sd.dimension_members(part, near, "en", "member")

    view = stage(counted(build(items[0], groups[0])), "members")
    return refresh_members(view, build, items, groups)


@query("q48_heavy_join")
def _(spark, sf):
    """Every document with the languages of its source, of which one has a third of all."""
    docs = table(spark, sf, "documents").select("doc_id", "source")
    languages = table(spark, sf, "documents").select(F.col("source").alias("of"), F.col("lang").alias("other")).distinct()
    return heavy_join(docs, languages, "source", "of").select("doc_id", "source", "other")


# -- polls that overlap -------------------------------------------------------------------


@query("q49_stream_latest")
def _(spark, sf):
    """Three polls that share a tenth of their rows, the newest versions in the middle one."""
    seen = table(spark, sf, "documents").select(
        "source", "n_chars", "doc_id", "lang", (F.col("doc_id") % 3).alias("version")
    )
    landing, target = scratch_path(spark, "landing"), scratch_path(spark, "documents")
    checkpoint = scratch_path(spark, "stream")
    for version in (0, 2, 1):
        poll = seen.filter((F.col("version") == version) | (F.col("doc_id") % 10 == 0))
        poll.write.mode("append").parquet(landing)
        stream_latest(
            spark.readStream.schema(seen.schema).parquet(landing), target, ["source", "n_chars"],
            checkpoint, version="version", buckets=8, bucket_by=["source", "n_chars"],
        ).awaitTermination()
    return sd.read_table(spark, target)
