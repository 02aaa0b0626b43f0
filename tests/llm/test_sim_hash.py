"""SimHash: fingerprints word by word, links against all pairs, with planted neighbours."""

import random
import re

import pytest
import xxhash

from sedimenta.llm.common import Scratch
from sedimenta.llm.sim_hash import DISTANCE, SEGMENTS, linked, simhash_components


def fingerprint(text: str | None) -> int:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes))


def components(prints: dict) -> dict:
    """Key to the set of keys that links of four bits or fewer lead to."""
    root = {k: k for k in prints}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    keys = list(prints)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                root[find(a)] = find(b)
    groups = {}
    for k in keys:
        groups.setdefault(find(k), set()).add(k)
    return {k: groups[find(k)] for k in keys}


def brute(rows):
    prints = {n: fingerprint(t) for n, (_, t) in enumerate(rows)}
    groups = components(prints)
    out = []
    for n, (i, _) in enumerate(rows):
        ids = [rows[m][0] for m in groups[n] if rows[m][0] is not None]
        out.append((i, f"{prints[n]:016x}", min(ids) if ids else None))
    return sorted(out, key=repr)


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def test_every_pair_within_four_bits_shares_a_key_in_three_segments():
    assert sum(length for _, length in SEGMENTS) == 64
    assert 2 * len(SEGMENTS) > DISTANCE


@pytest.mark.parametrize("parted", [False, True])
def test_links_are_those_of_all_pairs(spark, parted):
    rng = random.Random(5)
    prints = []
    for _ in range(60):
        centre = rng.getrandbits(64)
        prints.append(centre)
        for _ in range(rng.choice([0, 1, 2, 30])):
            near = centre
            for bit in rng.sample(range(64), rng.choice([1, 2, 3, 4, 4, 5, 6])):
                near ^= 1 << bit
            prints.append(near)
    # a chain in which each is linked to the next one only, and all bits of one segment
    last = rng.getrandbits(64)
    for k in range(0, 24, 4):
        last ^= 0b1111 << k
        prints.append(last)
    prints += [0, 0b1111 << 30, 1 << 63, (1 << 64) - 1]
    prints = sorted(set(prints))
    df = spark.createDataFrame([(signed(p), 1) for p in prints], "fingerprint long, copies long")
    got = {}
    for r in linked(df, Scratch(spark, "test"), parted).collect():
        got.setdefault(r["root"], set()).add(r["fingerprint"])
    groups = components({p: p for p in prints})
    want = {frozenset(signed(p) for p in g) for g in groups.values()}
    assert {frozenset(g) for g in got.values()} == want
    assert len(want) < len(prints) - 100


def test_documents(spark, documents):
    rng = random.Random(8)
    words = [f"word{i}" for i in range(300)]
    rows = []
    for _ in range(25):
        base = rng.choices(words, k=rng.choice([1, 2, 3, 4, 5, 60, 300]))
        rows.append(" ".join(base))
        for _ in range(rng.choice([0, 1, 3])):
            copy = list(base)
            copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append("\t".join(copy).upper())
    rows += ["", None, " \n\t\x0b\x0c\r", "\x1c one\xa0two é É", "Ünder A\x00B", "x" * 5000]
    rows = [(i, t) for i, t in enumerate(rows)]
    rows += [(3, rows[3][1]), (3, "another text with the id of row three"), (None, rows[0][1]), (None, "no id at all here")]
    got = simhash_components(documents(*rows, extra=True))
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows)


def test_very_long_text_counts_every_shingle(spark, documents):
    rng = random.Random(1)
    text = " ".join(f"w{rng.randrange(5000)}" for _ in range(150_000))
    tail = text + " " + " ".join(["the same four words"] * 150_000)
    (a, b) = sorted(tuple(r) for r in simhash_components(documents((1, text), (2, tail))).collect())
    assert a[1] == f"{fingerprint(text):016x}" and b[1] == f"{fingerprint(tail):016x}" and a[1] != b[1]


def test_empty_table(documents):
    assert simhash_components(documents()).collect() == []


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = sorted((tuple(r) for r in simhash_components(docs).collect()), key=repr)
    assert got == brute(rows)
    assert any(c != i for i, _, c in got)
