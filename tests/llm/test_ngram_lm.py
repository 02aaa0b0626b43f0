import math
import random
from collections import Counter

import numpy as np
import pytest

from sedimenta.llm import ngram_lm as lm


def words_of(text):
    return "".join(c if c.isalnum() else " " for c in (text or "").lower()).split()


def brute(docs, order, least, backoff):
    counts = Counter()
    for _, text in docs:
        w = words_of(text)
        for n in range(1, order + 1):
            counts.update(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
    whole = sum(v for k, v in counts.items() if len(k) == 1)
    out = []
    for i, text in docs:
        w, total = words_of(text), 0.0
        for p in range(len(w)):
            n, factor = min(order, p + 1), 1.0
            while n > 1 and counts[tuple(w[p - n + 1 : p + 1])] < least:
                n, factor = n - 1, factor * backoff
            gram = tuple(w[p - n + 1 : p + 1])
            below = whole if n == 1 else counts[gram[:-1]]
            total += math.log2(factor * counts[gram] / below)
        out.append((i, len(w), total / len(w) if w else None))
    return out


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_against_brute_force(documents, order):
    rng = random.Random(order)
    vocabulary = [f"w{i}" for i in range(12)] + ["é", "Straße"]
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 2, 3, 30, 90])))) for i in range(120)]
    docs += [(500, None), (501, "..."), (None, "w1 w2"), (3, "W1, w2"), (3, "W1, w2")]
    got = sorted(((r["doc_id"], r["n_words"], r["log2_score"]) for r in lm.score_texts(documents(*docs, extra=True), order=order).collect()), key=repr)
    want = sorted(brute(docs, order, 2, 0.4), key=repr)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    for g, w in zip(got, want):
        assert g[2] == (pytest.approx(w[2]) if w[2] is not None else None)


def test_packing():
    values = np.array([0, 1, 255, 256, (1 << 40) - 1], np.uint64)
    assert lm.unpack(lm.pack(values, 5), 5).tolist() == values.tolist()
    assert lm.unpack(lm.pack(values[:0], 5), 5).tolist() == []


def test_empty(documents):
    assert lm.score_texts(documents((1, "a")).limit(0)).collect() == []
    assert [r["log2_score"] for r in lm.score_texts(documents((1, None))).collect()] == [None]
