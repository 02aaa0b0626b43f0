import hashlib
import random
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sedimenta.llm import bpe, pieces
from sedimenta.llm.queries import RANKS, op8_byte_bpe

PATTERN = regex.compile(public_tokenizers.PATTERN)
TEXT = st.text(st.one_of(st.sampled_from(" \t\n\r'.,0189abtshelvdm²½ªº×÷éÈßǅŉ\x1c\x85\xa0一Ⅷ"), st.characters(codec="utf-8")), max_size=60)


@lru_cache
def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


@settings(max_examples=400, deadline=None)
@given(TEXT)
def test_pieces_are_the_pattern_s(text):
    assert pieces.split(text) == PATTERN.findall(text)
    assert "".join(pieces.split(text)) == text


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXT, max_size=6))
def test_ids_are_tiktoken_s(texts):
    got = pieces.Remembered(bpe.vocabulary(RANKS).encode_pieces).texts(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [reference().encode_ordinary(x) for x in texts]


def test_long_pieces_and_full_memory(monkeypatch):
    rng = random.Random(0)
    monkeypatch.setattr(pieces, "REMEMBERED", 10)
    known = pieces.Remembered(bpe.vocabulary(RANKS).encode_pieces)
    for _ in range(4):
        texts = ["".join(rng.choices("thesandxyzé ", k=k)) for k in (3, 50, 900)] + ["a" * 700, "the" * 300, "é" * 200, " " * 300]
        got = known.texts(texts)
        assert [np.frombuffer(x, "<u4").tolist() for x in got] == [reference().encode_ordinary(x) for x in texts]
        assert all(len(k) <= pieces.LONGEST for k in known.known)


def test_rows_of_a_matrix_merge_on_their_own():
    v = bpe.vocabulary(RANKS)
    words = ["the", "aaaa", "theres", "x", "nation"]
    got = v.encode_pieces(words)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [reference().encode_ordinary(x) for x in words]


def test_query(spark, tmp_path):
    texts = ["Hello world's end", None, "", "ß " * 2000, "<|endoftext|>", "  \n\n x"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "a"), (0, texts[0])]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((tuple(r) for r in op8_byte_bpe(spark, str(tmp_path)).collect()), key=repr)
    want = []
    for i, t in rows:
        ids = reference().encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=repr)


def test_an_unknown_id_is_an_error(spark):
    df = spark.createDataFrame([(b"\xff\xff\xff\x00",)], "ids binary").select(bpe.decode_ids(F.col("ids"), RANKS))
    with pytest.raises(Exception, match="list index out of range"):
        df.collect()


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert op8_byte_bpe(spark, str(tmp_path)).collect() == []


def test_pack_of_pa_types():
    assert bpe.binary_array([b"a", b""]).type == pa.binary()
