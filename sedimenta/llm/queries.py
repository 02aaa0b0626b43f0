"""One registered query for each operator, and the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.llm import (
    bpe,
    fill_in_middle,
    id_files,
    language_id,
    line_dedup,
    mixing,
    near_dup,
    nearest,
    ngram_lm,
    prefix_trie,
    sharding,
    sim_hash,
    top_k,
)
from sedimenta.llm.common import Scratch, aside, ready, text_of

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
OLD_SHARDS, SHARDS = 32, 40


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_repeated_lines(_table(spark, sf_dir, "documents"))


def op2_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(_table(spark, sf_dir, "documents"))


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, _ = aside(_table(spark, sf_dir, "documents"), *language_id.RESULTS)
    found = language_id.identify_language(docs)
    return found.select("doc_id", F.col("lang").alias("declared"), "language", "probability", "accepted")


def language_id_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over web pages, where markup, address suffix and host are all there."""
    host = language_id.address_host(F.col("url"))
    plain = F.regexp_replace(F.col("html"), r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    pages = _table(spark, sf_dir, "pages").select(
        "page_id",
        plain.alias("text"),
        language_id.markup_language(F.col("html")).alias("declared"),
        host.alias("host"),
        language_id.address_suffix(host).alias("suffix"),
    )
    return language_id.identify_language(pages, "text", "declared", "host", "suffix").drop("text")


def op5_reshard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, _ = aside(_table(spark, sf_dir, "documents"), *sharding.RESULTS)
    placed, plan = sharding.reshard(docs, SHARDS, sharding.old_shard_of(F.col("doc_id"), OLD_SHARDS))
    files = sharding.rewrite_shards(placed, plan, Scratch(spark, "shards").path())
    return files.select(
        "doc_id",
        "size",
        F.crc32(text_of(files).cast("binary")).alias("text_crc32"),
        F.lit(sharding.LAW).alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, _ = aside(_table(spark, sf_dir, "documents"), *mixing.RESULTS)
    return mixing.mix_sources(docs).select(
        "doc_id", "source", "lang", "topic", "tokens", "probability", "sampled"
    )


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.score_texts(_table(spark, sf_dir, "documents"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    docs = _table(spark, sf_dir, "documents")
    ids = docs.select("doc_id", bpe.encode_text(F.col("text"), RANKS).alias("ids"))
    both = ids.select("doc_id", "ids", bpe.decode_ids(F.col("ids"), RANKS).alias("decoded"))
    return both.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op10_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = Scratch(spark, "ids").path()
    id_files.write_ids(_table(spark, sf_dir, "documents"), path, TOKENIZER, plain_special=False)
    return id_files.read_ids(spark, path).select(
        "doc_id",
        "start",
        F.col("n_ids").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sim_hash.simhash_components(_table(spark, sf_dir, "documents"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = fill_in_middle.fill_in_middle(docs)
    whole = fill_in_middle.restored(F.col("output"), F.col("form"))
    return cut.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(whole, 256).alias("restored_sha256"),
    )


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "trie")
    numbered = scratch.keep(prefix_trie.numbered_turns(_table(spark, sf_dir, "conversations")))
    return prefix_trie.prefix_trie(*prefix_trie.spliced(numbered, scratch), scratch)


QUERIES = {
    f.__name__: f
    for f in (
        op1_line_dedup,
        op2_near_dup,
        op3_top_k,
        op4_language_id,
        op5_reshard,
        op6_mixing,
        op7_lm_score,
        op8_byte_bpe,
        op9_nearest,
        op10_id_files,
        op11_simhash,
        op12_fill_in_middle,
        op13_prefix_trie,
        language_id_pages,
    )
}

ORACLE = {
    "op1_line_dedup": line_dedup.SQL.format(docs="documents", min_words=25),
    "op3_top_k": top_k.SQL.format(scale=64, every=20, k=20),
    "op12_fill_in_middle": fill_in_middle.SQL.format(docs="documents"),
    "op13_prefix_trie": prefix_trie.SQL.format(conversations="conversations"),
}
