"""Every stage of the pipeline against brute force over that stage's own input."""

import hashlib
import random

import numpy as np
import pytest
from test_bpe import reference
from test_language_id import PARTS
from test_language_id import brute as brute_language
from test_line_dedup import brute as brute_lines
from test_near_dup import brute_classes

import corpus_pipeline
from sedimenta.llm.mixing import rake, tempered

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    rng = random.Random(11)
    words = {lang: ["".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(300)] for lang, parts in PARTS.items()}
    shared = [" ".join(rng.choices(words["en"], k=40)) for _ in range(3)]
    docs = []
    for _ in range(70):
        lang = rng.choice(list(PARTS))
        lines = [" ".join(rng.choices(words[lang], k=rng.randint(5, 60))) for _ in range(rng.randint(1, 6))]
        if rng.random() < 0.2:
            lines.insert(rng.randint(0, len(lines)), rng.choice(shared))
        docs.append((lang, "\n".join(lines)))
        if rng.random() < 0.3:
            copy = docs[-1][1].split(" ")
            copy[rng.randrange(len(copy))] = "changed"
            docs.append((lang, " ".join(copy)))
        if rng.random() < 0.1:
            docs.append(docs[-1])
    docs += [("en", ""), ("en", None), ("fr", "12 34 !!"), (None, "the and ing " * 30)]
    rng.shuffle(docs)
    return [(i, t, lang, rng.choice(["hot", "hot", "a", "b"]), len(t or "")) for i, (lang, t) in enumerate(docs)]


def brute_topic(text):
    marks = sum(text.count(c) for c in "#$%&*{}<>|")
    if "icense" in text:
        return "legal"
    if marks * 20 > len(text):
        return "table"
    return "note" if len(text) < 1000 else "article" if len(text) < 5000 else "long"


def brute_mix(rows):
    keys = [(s, lang, brute_topic(t or "")) for _, t, lang, s, _ in rows]
    weight = [(t or "").count(" ") + 1 if t else 0 for _, t, *_ in rows]
    names = [[*sorted({k[a] for k, w in zip(keys, weight)}), "(rest)"] for a in range(3)]
    cells = np.zeros([len(n) for n in names])
    for k, w in zip(keys, weight):
        cells[tuple(names[a].index(k[a]) for a in range(3))] += w
    goals = []
    for a in range(3):
        sums = cells.sum(axis=tuple(b for b in range(3) if b != a))
        share = tempered(dict(zip(names[a], sums)), 0.85)
        goals.append(np.array([share.get(n, 0.0) for n in names[a]]))
    factor = np.divide(rake(cells, goals), cells, out=np.zeros_like(cells), where=cells > 0)
    p = [factor[tuple(names[a].index(k[a]) for a in range(3))] / factor.max() for k in keys]
    draw = [int(hashlib.md5(f"{r[0]}:1".encode()).hexdigest()[:8], 16) / 2**32 for r in rows]
    return {r[0] for r, q, d in zip(rows, p, draw) if d < q}


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows that went into each stage, and those that came out of the last."""
    folder = tmp_path_factory.mktemp("pipeline")
    df = spark.createDataFrame(corpus(), SCHEMA)
    df.write.parquet(str(folder / "documents.parquet"))
    out = []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out.append((name, [tuple(r) for r in df.collect()]))
        stage(spark, df, str(folder)).write.parquet(str(folder / str(i)))
        df = spark.read.parquet(str(folder / str(i)))
        if i < 4:
            assert [f.lower() for f in df.columns] == ["doc_id", "text", "lang", "source", "n_chars"]
    out.append(("", [r.asDict() for r in df.collect()]))
    whole = corpus_pipeline.run(spark, str(folder)).collect()
    assert sorted(r["doc_id"] for r in whole) == sorted(r["doc_id"] for r in out[-1][1])
    return dict(zip([n for n, _ in out[:-1]], [(a[1], b[1]) for a, b in zip(out, out[1:])]))


def test_language_stage(stages):
    rows, kept = stages["language_id"]
    want = brute_language([r[:4] for r in rows])
    assert {r[0]: r[2] for r in kept} == {i: lang for i, (lang, _, ok) in want.items() if ok}
    assert len(kept) >= len(rows) - 3


def test_line_stage(stages):
    rows, kept = stages["line_dedup"]
    want = brute_lines([r[:2] for r in rows], 25)
    got = {r[0]: r for r in kept}
    assert set(got) == {i for i, (t, n) in want.items() if not (n and not t.strip(" "))}
    for i, r in got.items():
        text, n = want[i]
        assert r[1] == text and (not n or r[4] == len(text))
    assert sum(n > 0 for _, n in want.values()) > 5


def test_near_stage(stages):
    rows, kept = stages["near_dup"]
    classes = brute_classes([r[:2] for r in rows])
    assert sorted(r[0] for r in kept) == sorted(i for i, c in classes.items() if i == c)


def test_mixing_stage(stages):
    rows, kept = stages["mixing"]
    assert {r[0] for r in kept} == brute_mix(rows)


def test_encoding_stage(stages):
    rows, coded = stages["byte_bpe"]
    texts = {r[0]: r[1] for r in rows}
    assert {r["doc_id"] for r in coded} == set(texts)
    for r in coded:
        ids = reference().encode_ordinary(texts[r["doc_id"]] or "")
        assert np.frombuffer(r["ids"], "<u4").tolist() == ids and r["n_tokens"] == len(ids)
        assert r["decoded_sha256"] == hashlib.sha256((texts[r["doc_id"]] or "").encode()).hexdigest()


def test_empty(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
