import hashlib
import random

import numpy as np
import pytest

from sedimenta.llm.mixing import mix_sources, rake


def test_raking_meets_all_marginals():
    rng = np.random.default_rng(0)
    cells = rng.random((4, 3, 2)) * 10
    goals = [np.array([0.1, 0.2, 0.3, 0.4]), np.array([0.5, 0.25, 0.25]), np.array([0.7, 0.3])]
    out = rake(cells, goals)
    for axis, goal in enumerate(goals):
        assert np.allclose(out.sum(axis=tuple(a for a in range(3) if a != axis)), goal)
    # raking keeps the odds ratios of the cells
    assert np.isclose(out[0, 0, 0] * out[1, 1, 0] / (out[0, 1, 0] * out[1, 0, 0]), cells[0, 0, 0] * cells[1, 1, 0] / (cells[0, 1, 0] * cells[1, 0, 0]))


def test_raking_with_empty_categories():
    out = rake(np.array([[1.0, 3.0], [0.0, 0.0]]), [np.array([0.5, 0.5]), np.array([0.5, 0.5])])
    assert np.allclose(out, [[0.5, 0.5], [0, 0]])
    assert rake(np.zeros((2, 2)), [np.ones(2), np.ones(2)]).sum() == 0


def docs_of(documents, n=3000, extra=False):
    rng = random.Random(2)
    rows = [
        (i, "w " * rng.randint(0, 60) + rng.choice(["", "Licensed"]), rng.choice(["en", "en", "fr"]), rng.choice(["hot"] * 5 + ["a", "b"]))
        for i in range(n)
    ]
    return documents(*rows, extra=extra)


def test_expected_tokens_have_the_target_shares(documents):
    targets = {"source": {"hot": 0.4, "a": 0.4, "b": 0.2}, "language": {"en": 0.5, "fr": 0.5}, "topic": {"legal": 0.5, "note": 0.5}}
    rows = mix_sources(docs_of(documents), targets=targets).collect()
    for column, goal in (("source", targets["source"]), ("lang", targets["language"]), ("topic", targets["topic"])):
        mass = {k: sum(r["tokens"] * r["probability"] for r in rows if r[column] == k) for k in goal}
        assert {k: v / sum(mass.values()) for k, v in mass.items()} == pytest.approx(goal)
    assert max(r["probability"] for r in rows) == pytest.approx(1)
    kept = sum(r["sampled"] for r in rows)
    assert kept == pytest.approx(sum(r["probability"] for r in rows), rel=0.1)


def test_the_draw_is_a_function_of_the_id(documents):
    rows = mix_sources(docs_of(documents, 300), seed=4).collect()
    for r in rows:
        draw = int(hashlib.md5(f"{r['doc_id']}:4".encode()).hexdigest()[:8], 16) / 2**32
        assert r["sampled"] == (draw < r["probability"])


def test_no_target_no_sample_and_edges(documents):
    docs = documents((1, "a b", "en", "x"), (2, "a b", "en", "y"), (None, None, None, None), (3, "", "fr", "x"), (4, "a", "en", "x"), (4, "a", "en", "x"), extra=True)
    out = mix_sources(docs, targets={"source": {"x": 1.0}})
    assert out.columns == [*docs.columns, "topic", "tokens", "probability", "sampled"]
    got = sorted(((r["doc_id"], r["tokens"], r["probability"]) for r in out.collect()), key=repr)
    assert [g for g in got if g[0] in (2, None)] == [(2, 2, 0.0), (None, 0, 0.0)]
    assert [g[2] for g in got if g[0] in (1, 4)] == [1.0, 1.0, 1.0]
    assert mix_sources(docs.limit(0)).collect() == []
    assert mix_sources(documents((1, ""), (2, None))).filter("sampled").count() == 0
    with pytest.raises(ValueError):
        mix_sources(out)


def test_one_rare_document_hardly_moves_the_kept_share(documents):
    def kept(*more, **options):
        rows = mix_sources(docs_of(documents).unionByName(documents(*more)), **options).collect()
        mass = sum(r["tokens"] for r in rows if r["doc_id"] < 3000)
        assert all(0 <= r["probability"] <= 1 for r in rows)
        rare = [r["probability"] for r in rows if r["doc_id"] >= 3000]
        return sum(r["tokens"] * r["probability"] for r in rows if r["doc_id"] < 3000) / mass, rare

    ordinary = (3000, "w " * 19 + "w", "en", "hot")
    usual, _ = kept(ordinary)
    for lang in ("en", "new"):
        share, rare = kept((3000, "w " * 19 + "w", lang, "rare"))
        assert share == pytest.approx(usual, abs=0.01)
        assert rare == [pytest.approx(1)]
    assert kept(ordinary, kept=0.3)[0] == pytest.approx(0.3, abs=1e-3)
    assert kept((3000, "w", "new", "rare"), kept=0.3) == (pytest.approx(0.3, abs=1e-3), [pytest.approx(1)])


def test_whole_cells_leave_the_targets_of_the_others(documents):
    # b has 1/5 of the tokens and is to be half of the 3/5 kept: all of it stays, a and c share the rest
    docs = documents(*[(i, "w w", "en", "aaabc"[i % 5]) for i in range(100)])
    rows = mix_sources(docs, targets={"source": {"a": 0.3, "b": 0.5, "c": 0.2}}, kept=0.6).collect()
    got = {r["source"]: r["probability"] for r in rows}
    assert got == pytest.approx({"a": 0.24 / 0.6, "b": 1.0, "c": 0.16 / 0.2})


def many_sources(documents):
    rng = random.Random(5)
    names = [f"s{i:03}" for i in range(100)]
    picked = [*names, *rng.choices(names, [1 / (i + 1) for i in range(100)], k=1400)]
    rows = [(i, "w " * rng.randint(1, 30) + "w", rng.choice(["en", "fr"]), s) for i, s in enumerate(picked)]
    return documents(*rows, (1500, "w w", None, None))


def test_every_source_has_its_own_target(documents):
    rows = mix_sources(many_sources(documents), kept=0.4).collect()
    has, got = {}, {}
    for r in rows:
        has[r["source"]] = has.get(r["source"], 0) + r["tokens"]
        got[r["source"]] = got.get(r["source"], 0) + r["tokens"] * r["probability"]
    assert len(has) == 101
    part = [s for s in has if got[s] < has[s] * 0.99]
    ratios = [got[s] / has[s] ** 0.85 for s in part]
    assert len(part) > 64 and max(ratios) == pytest.approx(min(ratios), rel=1e-4)


def test_cells_as_a_table_give_the_same(documents):
    docs = docs_of(documents, 300).unionByName(documents((300, "w " * 3 + "w", "en", "rare"), (301, "", "en", None)))
    few = {r["doc_id"]: r["probability"] for r in mix_sources(docs).collect()}
    many = {r["doc_id"]: r["probability"] for r in mix_sources(docs, driver_cells=0).collect()}
    assert many == pytest.approx(few, abs=1e-4) and few[300] == pytest.approx(1) and few[301] == 0
