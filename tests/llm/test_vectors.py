import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sedimenta.llm.nearest import BOUNDARY, COPIES, _lists_of, _probe, fit_index, nearest, unit
from sedimenta.llm.top_k import threshold_search, top_k

SCHEMA = "vec_id long, embedding array<float>, id string, list int, vector string"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "x", 1, "y") for i, v in rows], SCHEMA)


def brute(rows, asked, k, score):
    good = {}
    for i, v in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            good.setdefault(i, v)
    out = []
    for q in good:
        if asked(q):
            best = sorted((-score(good[q], v), i) for i, v in good.items() if i != q and score(good[q], v) is not None)[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    return sorted(out)


def inner(a, b):
    return sum(math.floor(64 * float(np.float32(x))) * math.floor(64 * float(np.float32(y))) for x, y in zip(a, b))


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def random_rows(n, d, seed=0, spread=1.0):
    rng = np.random.default_rng(seed)
    return [(i, (rng.normal(size=d) * spread).astype(np.float32).tolist()) for i in range(n)]


def test_top_k_against_brute_force(spark):
    rows = random_rows(300, 6) + [(i, [0.5] * 6) for i in range(300, 360)]
    got = rows_of(top_k(table(spark, rows), F.col("vec_id") % 20 == 0))
    assert got == brute(rows, lambda i: i % 20 == 0, 20, inner)


def test_top_k_edges(spark):
    rows = [(0, [1, 2]), (20, None), (40, [1, None]), (60, [float("nan"), 1]), (80, [float("inf"), 1]), (None, [1, 1]), (3, [2, 1]), (4, [2, 1]), (3, [2, 1]), (100, [])]
    got = rows_of(top_k(table(spark, rows), F.col("vec_id") % 20 == 0))
    assert got == [(0, 1, 3, 64 * 64 * 4), (0, 2, 4, 64 * 64 * 4), (0, 3, 100, 0), (100, 1, 0, 0), (100, 2, 3, 0), (100, 3, 4, 0)]
    assert top_k(table(spark, []), F.col("vec_id") % 20 == 0).collect() == []


def test_top_k_refuses_what_it_cannot_add_up(spark):
    rows = [(0, [1e30, 2]), (20, [1, 2])]
    with pytest.raises(Exception, match="too large to be scored exactly"):
        top_k(table(spark, rows), F.col("vec_id") % 20 == 0).collect()
    with pytest.raises(Exception, match="would not be exact"):
        top_k(table(spark, [(0, [1e8, 2]), (20, [1e8, 2])]), F.col("vec_id") % 20 == 0).collect()
    high = [(0, [1e4, -1e4]), (20, [1e4, 3]), (21, [-1e4, 1e4])]
    assert rows_of(top_k(table(spark, high), F.col("vec_id") % 20 == 0)) == brute(high, lambda i: i % 20 == 0, 20, inner)


def test_the_threshold_stops_early_and_is_exact():
    rng = np.random.default_rng(2)
    rows = np.floor(rng.normal(size=(6000, 3)) * 60) * np.where(rng.random(6000) < 0.02, 6, 1)[:, None]
    ids = np.arange(6000)
    queries = rows[:5]
    query, near, score, worked = threshold_search(rows, ids, queries, ids[:5], 4)
    for q in range(5):
        all_scores = rows @ queries[q]
        all_scores[q] = -np.inf
        order = np.lexsort((ids, -all_scores))[:4]
        assert near[query == q].tolist() == order.tolist()
        assert score[query == q].tolist() == all_scores[order].tolist()
    assert worked < 5 * 6000 / 2


def cosine(a, b):
    a, b = np.array(a, np.float32).astype(float), np.array(b, np.float32).astype(float)
    norm = math.sqrt(a @ a) * math.sqrt(b @ b)
    return float(a @ b) / norm if norm else None


def test_nearest_recall_and_scores(spark):
    rows = random_rows(3000, 16, 4)
    got = rows_of(nearest(table(spark, rows), F.col("vec_id") % 50 == 0))
    true = brute(rows, lambda i: i % 50 == 0, 5, cosine)
    assert len(got) == len(true)
    want = {(q, i): s for q, _, i, s in true}
    found = {(q, i) for q, _, i, _ in got} & set(want)
    assert len(found) >= 0.9 * len(want)
    vectors = dict(rows)
    for q, _, i, s in got:
        assert s == pytest.approx(cosine(vectors[q], vectors[i]), abs=1e-12)


def test_nearest_of_many_equal_vectors_is_tied_by_id(spark):
    rows = random_rows(400, 8, 5) + [(i, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8]) for i in range(400, 900)]
    got = rows_of(nearest(table(spark, rows), F.col("vec_id") % 50 == 0))
    by_query = {}
    for q, r, i, _ in got:
        by_query.setdefault(q, []).append(i)
    for q in range(400, 900, 50):
        assert by_query[q] == [i for i in range(400, 910) if i != q][:5]


def test_nearest_edges(spark):
    rows = [(0, [1, 0]), (50, None), (100, [0, 0]), (150, [1, None]), (200, [float("nan"), 1]), (None, [1, 1]), (7, [1, 1]), (7, [1, 1]), (8, [2, 2])]
    got = rows_of(nearest(table(spark, rows), F.col("vec_id") % 50 == 0))
    assert [(q, r, i) for q, r, i, _ in got] == [(0, 1, 7), (0, 2, 8)]
    assert nearest(table(spark, []), F.col("vec_id") % 50 == 0).collect() == []


def test_the_walk_sees_the_nearest_centroids():
    rng = np.random.default_rng(3)
    sample = unit(rng.normal(size=(4000, 12)))
    index = fit_index(sample, 100_000, 5)
    far = index.near(sample[:200], 8, 1.0)
    true = (sample[:200] @ index.centroids.T).argmax(axis=1)
    assert (far.argmin(axis=1) == true).mean() > 0.95
    size = np.bincount((sample @ index.centroids.T).argmax(axis=1), minlength=len(index.centroids))
    assert size.max() < 6 * size.mean()


def test_few_rows_are_scored_where_the_vectors_have_structure(spark):
    """Rows around 300 centres: the lists read hold less than a fifth of the table."""
    rng = np.random.default_rng(6)
    centres = unit(rng.normal(size=(300, 16)))
    data = unit(centres[rng.integers(0, 300, 9000)] + rng.normal(size=(9000, 16)) * 0.05)
    index = fit_index(data[:4000], len(data), 5)
    held = _lists_of(index.near(data, 2 * COPIES, BOUNDARY))
    sizes = held.sum(axis=0)
    asked = np.arange(0, 9000, 50)
    batch = pa.RecordBatch.from_arrays([pa.array(asked), pa.array(data[asked].tolist())], names=["id", "vector"])
    (probed,) = _probe(index, sizes, 5)(iter([batch]))
    query, list_ = probed.column(0).to_numpy(), probed.column(2).to_numpy()
    scored = sizes[list_].sum() / len(asked)
    score = data[asked] @ data.T
    score[np.arange(len(asked)), asked] = -np.inf
    hits = 0
    for i, q in enumerate(asked):
        read = held[:, list_[query == q]].any(axis=1)
        hits += read[np.argsort(-score[i])[:5]].sum()
    assert hits >= 0.9 * 5 * len(asked)
    assert scored < 9000 / 5, scored
