"""The registered queries over the smallest tables, by what their rows have to be."""

import zlib
from collections import Counter, defaultdict

import pytest

from sedimenta.llm.language_id import identify_language
from sedimenta.llm.queries import language_id_pages, op5_reshard

SF = "/root/testdata/sf0.001"


def test_reshard(spark):
    texts = defaultdict(list)
    for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        texts[r["doc_id"]].append(r["text"])
    rows = op5_reshard(spark, SF).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(i for i, t in texts.items() for _ in t)
    for r in rows:
        raw = [(t or "").encode() for t in texts[r["doc_id"]]]
        assert r["text_crc32"] in [zlib.crc32(x) for x in raw]
        assert r["size"] in [len(x) + 16 for x in raw]
        assert r["law"] == "rows" and r["grown_shard"] is None and 0 <= r["shard"] < 40
    counts = Counter(r["shard"] for r in rows)
    assert max(counts[s] for s in range(40)) - min(counts[s] for s in range(40)) <= 1
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_pages_by_language(spark):
    """Every page is there once; what its markup declares is nearly always what is found."""
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").collect()
    rows = language_id_pages(spark, SF).collect()
    assert sorted(r["page_id"] for r in rows) == sorted(r["page_id"] for r in pages)
    told = [r for r in rows if r["declared"] and r["accepted"]]
    assert len(told) > len(rows) / 4
    assert sum(r["declared"] == r["language"] for r in told) >= 0.95 * len(told)


@pytest.mark.parametrize("words", [1, 200_000])
def test_a_very_long_text_has_its_language(documents, words):
    rows = [(i, t * 20, lang) for i, (t, lang) in enumerate([("the thing and others ", "en"), ("le chateau et que oui ", "fr")] * 10)]
    rows.append((99, "the thing and others " * words, None))
    out = {r["doc_id"]: r for r in identify_language(documents(*rows)).collect()}
    assert out[99]["language"] == "en" and out[99]["accepted"]
