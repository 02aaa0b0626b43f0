"""Columns named like results, and very long texts, where other tests do not have them."""

import math

import pytest
from pyspark.sql import functions as F
from test_language_id import text
from test_ngram_lm import brute

import corpus_pipeline
from sedimenta.llm import queries, sharding
from sedimenta.llm.common import aside
from sedimenta.llm.language_id import identify_language
from sedimenta.llm.mixing import mix_sources
from sedimenta.llm.ngram_lm import score_texts

RESULTS = ["Language", "probability", "accepted", "topic", "TOKENS", "sampled", "size", "shard", "slot"]


@pytest.fixture
def clashing(documents):
    import random

    rng = random.Random(8)
    rows = [(i, text(rng, lang, 60), lang, f"s{i % 4}") for i in range(60) for lang in [["en", "fr", "de"][i % 3]]]
    plain = documents(*rows)
    return plain, plain.select("*", *[F.concat(F.lit(f"{c} "), "doc_id").alias(c) for c in RESULTS])


def test_stages_keep_columns_named_like_their_results(spark, clashing):
    plain, docs = clashing
    for stage in (corpus_pipeline.identify, corpus_pipeline.mix):
        got, want = stage(spark, docs, ""), stage(spark, plain, "")
        assert got.columns == docs.columns and got.count() > 0
        assert sorted(got.select(*plain.columns).collect()) == sorted(want.collect())
        assert all(r[c] == f"{c} {r['doc_id']}" for r in got.collect() for c in RESULTS)


def test_queries_read_tables_with_such_columns(spark, clashing, tmp_path):
    plain, docs = clashing
    for name, table in (("plain", plain), ("docs", docs)):
        table.write.parquet(str(tmp_path / name / "documents.parquet"))
    for query in (queries.op4_language_id, queries.op6_mixing, queries.op7_lm_score, queries.op5_reshard):
        rows = [
            sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in query(spark, str(tmp_path / n)).collect())
            for n in ("plain", "docs")
        ]
        assert rows[0] == rows[1] and len(rows[0]) == 60


def test_operators_refuse_them_whatever_the_case(clashing):
    _, docs = clashing
    for call in (identify_language, mix_sources, lambda d: sharding.reshard(d, 2, F.lit(0))):
        with pytest.raises(ValueError, match="already"):
            call(docs)


def test_aside(spark):
    df = spark.createDataFrame([(1, 2, 3)], "A int, _a int, b int")
    moved, now = aside(df, "a", "c")
    assert now == {"A": "__A", "_a": "_a", "b": "b"} and moved.columns == ["__A", "_a", "b"]
    assert aside(df, "c")[0] is df


LONG = "the quick brown fox jumps over the lazy dog " * 60_000


def test_a_very_long_text_is_scored_whole(documents):
    docs = [(1, LONG), (2, "the quick fox"), (3, "dog the quick"), (4, "x" * 500_000)]
    got = {r["doc_id"]: (r["n_words"], r["log2_score"]) for r in score_texts(documents(*docs)).collect()}
    for i, n, score in brute(docs, 3, 2, 0.4):
        assert got[i] == (n, pytest.approx(score))


def test_a_very_long_text_has_a_shard_and_a_weight(documents):
    docs = documents((1, LONG), *[(i, "w w w", "en", "s") for i in range(2, 40)])
    placed, _ = sharding.reshard(docs, 4, sharding.old_shard_of(F.col("doc_id"), 3))
    rows = placed.collect()
    assert [r["size"] for r in rows if r["doc_id"] == 1] == [len(LONG) + 16]
    counts = [sum(r["shard"] == s for r in rows) for s in range(4)]
    assert sum(counts) == 39 and max(counts) - min(counts) <= 1
    drawn = {r["doc_id"]: r for r in mix_sources(docs).collect()}
    assert drawn[1]["tokens"] == LONG.count(" ") + 1 and drawn[1]["topic"] == "long"
    assert all(0 < r["probability"] <= 1 and not math.isnan(r["probability"]) for r in drawn.values())
