import random
from collections import Counter

import numpy as np
import pyarrow as pa

from sedimenta.llm.common import slices, utf8, word_hashes
from sedimenta.llm.near_dup import bag_minhash, components, keep_one_of_each, near_duplicates, similarities
from sedimenta.llm.common import Scratch


def bag(text: str | None, size: int = 5) -> Counter:
    words = "".join(c if c.isalnum() else " " for c in (text or "").lower()).split()
    if not words:
        return Counter()
    return Counter(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def jaccard(a: Counter, b: Counter) -> float:
    both = (a & b).total()
    whole = (a | b).total()
    return both / whole if whole else 0.0


def brute_classes(docs: list[tuple[int, str | None]], threshold: float = 0.8) -> dict[int, int]:
    bags = {i: bag(t) for i, t in docs}
    root = {i: i for i in bags}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in bags:
        for b in bags:
            if a < b and bags[a] and bags[b] and jaccard(bags[a], bags[b]) >= threshold:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in bags}


def corpus(seed: int = 3, n: int = 40) -> list[tuple[int, str]]:
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    docs = []
    for _ in range(n):
        base = rng.choices(words, k=rng.choice([1, 3, 7, 40, 120, 400]))
        docs.append(" ".join(base))
        for _ in range(rng.choice([0, 0, 1, 4, 9])):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 2, 5, 12])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            docs.append(" ".join(copy).upper() + "!")
    rng.shuffle(docs)
    return [(i, t) for i, t in enumerate(docs)]


def classes(df) -> dict[int, int]:
    return {r["doc_id"]: r["class_id"] for r in df.collect()}


def test_classes_are_the_components_of_all_links(documents):
    docs = corpus()
    assert classes(near_duplicates(documents(*docs))) == brute_classes(docs)


def test_many_near_copies_of_one_text(documents):
    rng = random.Random(1)
    base = [f"b{i}" for i in range(200)]
    docs = []
    for i in range(150):
        copy = list(base)
        for _ in range(3):
            copy[rng.randrange(200)] = f"x{rng.random()}"
        docs.append((i, " ".join(copy)))
    assert classes(near_duplicates(documents(*docs))) == brute_classes(docs)


def test_signatures_estimate_the_weighted_similarity():
    rng = np.random.default_rng(0)
    shared, own = rng.integers(1, 1 << 62, 60).astype(np.uint64), rng.integers(1, 1 << 62, 60).astype(np.uint64)
    a = {int(x): int(w) for x, w in zip(shared, rng.integers(1, 9, 60))}
    b = {x: int(w) for (x, _), w in zip(a.items(), rng.integers(1, 9, 60))} | {int(x): 2 for x in own[:20]}
    whole = sum(max(a.get(x, 0), b.get(x, 0)) for x in {*a, *b})
    true = sum(min(a[x], b.get(x, 0)) for x in a) / whole
    text = np.repeat([0, 1], [len(a), len(b)])
    shingle = np.array([*a, *b], np.uint64)
    weight = np.array([*a.values(), *b.values()])
    sig = bag_minhash(text, shingle, weight, 2, 8192)
    assert abs((sig[0] == sig[1]).mean() - true) < 0.03


def test_similarity_is_exact():
    docs = corpus(8, 25)
    left, right = [t for _, t in docs[:30]], [t for _, t in docs[10:40]]
    got = similarities(utf8(pa.array([x.lower() for x in left])), utf8(pa.array([x.lower() for x in right])), 30, 5)
    assert np.allclose(got, [jaccard(bag(a), bag(b)) for a, b in zip(left, right)])


def test_words_do_not_depend_on_where_they_stand():
    texts = ["alpha beta", "", "beta", "x, alpha-beta é1", "é1"]
    hashes, bounds = word_hashes(*utf8(pa.array(texts)))
    of = [hashes[bounds[i] : bounds[i + 1]].tolist() for i in range(len(texts))]
    assert of[0] == [of[3][1], of[2][0]] and of[1] == [] and of[3][3] == of[4][0] and len(set(of[3])) == 4


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 200), (200, 150)], "u long, v long")
    got = {r["node"]: r["root"] for r in components(edges, Scratch(spark, "t")).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, 150: 100, 200: 100}


def test_edges(documents):
    text = "some words that are the same in both"
    docs = documents((1, None), (2, ""), (3, "!!!"), (4, text), (5, text), (None, text), (6, "one"), (7, "ONE"), (7, "ONE"), extra=True)
    assert classes(near_duplicates(docs)) == {1: 1, 2: 2, 3: 3, 4: 4, 5: 4, 6: 6, 7: 6}
    kept = keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == [1, 2, 3, 4, 6, None]
    assert near_duplicates(docs.limit(0)).collect() == [] and keep_one_of_each(docs.limit(0)).collect() == []


def test_one_id_with_two_texts_ties_their_classes(documents):
    one, two = "a b c d e f g h", "q r s t u v w x"
    docs = documents((1, one), (2, two), (3, one), (3, two))
    assert classes(near_duplicates(docs)) == {1: 1, 2: 1, 3: 1}


def test_an_id_with_unrelated_texts_loses_none(documents):
    one, two = (" ".join(f"{x}{i}" for i in range(60)) for x in "ab")
    docs = documents((1, one), (1, two), (2, one), (3, two), (4, two + " more"), (5, "!"), (5, "?"), (5, "?"), (None, one))
    kept = sorted(((r["doc_id"], r["text"]) for r in keep_one_of_each(docs).collect()), key=repr)
    assert kept == sorted([(1, one), (1, two), (5, "!"), (5, "?"), (None, one)], key=repr)
    assert classes(near_duplicates(docs)) == {1: 1, 2: 1, 3: 1, 4: 1, 5: 5}


def test_a_repeated_row_is_no_hot_spot(documents):
    text = " ".join(f"w{i}" for i in range(80))
    docs = documents(*[(7, text)] * 400, (8, text + " end"), (9, "apart"))
    assert classes(near_duplicates(docs)) == {7: 7, 8: 7, 9: 9}
    assert sorted(r["doc_id"] for r in keep_one_of_each(docs).collect()) == [7, 9]


def test_many_short_texts_in_a_batch_without_limit(spark):
    """More texts in a slice than their number has bits for."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    docs = spark.range(40_000).selectExpr("id AS doc_id", "concat('w', id) AS text").coalesce(1)
    try:
        for limit in ("0", "100000"):
            spark.conf.set(setting, limit)
            found = near_duplicates(docs)
            assert found.filter("n_shingles <> 1 OR class_id <> doc_id").count() == 0
            assert found.count() == 40_000
        data, offsets = utf8(pa.array([f"w{i}" for i in range(40_000)]))
        assert all(b - a <= 1 << 14 for a, b in slices(offsets, most=1 << 14))
    finally:
        spark.conf.set(setting, before)


def test_very_long_texts_are_compared_whole(documents):
    rng = random.Random(6)
    words = [f"w{rng.randrange(3000)}" for _ in range(120_000)]
    other = words[:60_000] + [f"x{i}" for i in range(60_000)]
    near = [w if i % 100 else "changed" for i, w in enumerate(words)]
    docs = documents((1, " ".join(words)), (2, " ".join(other)), (3, " ".join(near)))
    assert classes(near_duplicates(docs)) == {1: 1, 2: 2, 3: 1}
