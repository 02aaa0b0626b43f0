"""A corpus from raw documents to token ids, in five stages.

Each stage takes what its predecessor kept, as a written table, and returns the columns
of ``documents`` again; the last one returns the ids.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.llm import bpe, language_id, line_dedup, mixing, near_dup
from sedimenta.llm.common import Scratch, aside, fresh, quoted, ready, text_of
from sedimenta.llm.queries import RANKS

#: SQL cannot express the first, third and last stage; tests compare with brute force.
ORACLE_SQL = None


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; ``lang`` is what was found, not what was declared."""
    named, now = aside(docs, *language_id.RESULTS)
    found = language_id.identify_language(named).filter("accepted")
    return found.select(
        *[F.col("language").alias(c) if c == "lang" else quoted(now[c]).alias(c) for c in docs.columns]
    )


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated runs of lines; one that loses all its lines goes.

    ``n_chars`` follows the text.
    """
    (removed,) = fresh(docs, "n_removed")
    short = line_dedup.drop_repeated_lines(docs, removed=removed)
    gone = (quoted(removed) > 0) & (F.trim(text_of(short)) == "")
    size = F.when(quoted(removed) > 0, F.length(text_of(short)).cast("long"))
    return short.filter(~gone).select(
        *[
            F.coalesce(size, quoted(c)).alias(c) if c == "n_chars" else quoted(c)
            for c in docs.columns
        ]
    )


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return near_dup.keep_one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by the weights of their source, language and topic."""
    named, now = aside(docs, *mixing.RESULTS)
    drawn = mixing.mix_sources(named).filter("sampled")
    return drawn.select(*[quoted(now[c]).alias(c) for c in docs.columns])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, and the digest of what they decode to."""
    ready(spark)
    packed = docs.select("doc_id", "source", "lang", bpe.encode_text(F.col("text"), RANKS).alias("ids"))
    both = packed.withColumn("decoded", bpe.decode_ids(F.col("ids"), RANKS))
    return both.select(
        "doc_id",
        "source",
        "lang",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify),
    ("line_dedup", drop_lines),
    ("near_dup", drop_copies),
    ("mixing", mix),
    ("byte_bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from ``documents``; each is written to the shared folder and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        kept = scratch.keep(stage(spark, docs, sf_dir))
        scratch.free(docs)
        docs = kept
    return docs
