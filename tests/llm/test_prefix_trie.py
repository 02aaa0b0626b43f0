"""The prefix trie against a trie built turn by turn."""

import hashlib
import random
import zlib

import pytest

from sedimenta.llm.common import Scratch
from sedimenta.llm.prefix_trie import numbered_turns, prefix_trie, spliced
from sedimenta.llm.queries import op13_prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    own = {}
    order = sorted(
        (r for r in rows if r[0] is not None),
        key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""),
    )
    for c, _, role, text in order:
        own.setdefault(c, []).append((role or "", text or ""))
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        paths[c] = tuple(own.get(base, [])[:h] + turns[h:])
    return nodes(paths)


def nodes(paths):
    members = {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    children, leaves, saved = {}, {}, {}
    for path in members:
        if path:
            children[path[:-1]] = children.get(path[:-1], 0) + 1
    for path, cs in members.items():
        size = len(path[-1][1].encode()) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] = leaves.get(path[:d], 0) + (path not in children)
            saved[path[:d]] = saved.get(path[:d], 0) + (len(cs) - 1) * size
    return sorted(
        (
            (
                min(cs),
                len(path),
                min(members[path[:-1]]) if path else None,
                len(cs),
                children.get(path, 0),
                leaves[path],
                saved[path],
                hashlib.sha256(",".join(str(c) for c in sorted(cs) if paths[c] == path).encode()).hexdigest(),
            )
            for path, cs in members.items()
        ),
        key=repr,
    )


def trie(spark, df):
    scratch = Scratch(spark, "test")
    turns = scratch.keep(numbered_turns(df))
    out = prefix_trie(*spliced(turns, scratch), scratch)
    assert out.columns == [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    ]
    assert {f.dataType.simpleString() for f in out.schema.fields[:-1]} == {"bigint"}
    return sorted((tuple(r) for r in out.collect()), key=repr)


def conversations(seed, n, longest):
    rng = random.Random(seed)
    said = ["", None, "hello", "é😀", "same words", "x" * 70 + "1", "x" * 70 + "2"]
    rows = []
    for c in rng.sample(range(-n, 3 * n), n):
        first = rng.choice([[], [("user", "hello")], [("user", "hello"), ("assistant", "yes")] * rng.randrange(1, 12)])
        turns = first + [(rng.choice(["user", "assistant", None, ""]), rng.choice(said)) for _ in range(rng.randrange(longest))]
        rows += [(c, t, *turn) for t, turn in enumerate(turns)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,n,longest", [(1, 60, 6), (2, 40, 30), (3, 5, 90)])
def test_random(spark, seed, n, longest):
    rows = conversations(seed, n, longest)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS conv", "1 AS at", "'y' AS block", "2 AS t1", "'z' AS length", "0 AS depth")
    assert trie(spark, df) == brute(rows)


def test_ties_nulls_and_repeated_rows(spark):
    rows = [
        (1, None, "user", "later"), (1, None, "user", "early"), (1, 0, None, None), (1, 0, "", ""),
        (1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, -3, "ab", "c"), (1, 5, "a", "bc"),
        (None, 0, "user", "nobody"), (None, None, None, None),
        (2, 0, "user", "b"), (5, 0, "user", "b"), (6, 0, "user", "a"), (9, None, None, None), (10, 9, "u", "v"),
    ]
    assert trie(spark, spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_left_without_turns(spark):
    """Conversations whose own turns all fall away and whose base is absent end at the root."""
    short = [c for c in range(1, 200) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 2][:7]
    rows = [(c, 0, "user", "only") for c in short]
    got = trie(spark, spark.createDataFrame(rows, SCHEMA))
    listed = ",".join(str(c) for c in short)
    assert got == [(short[0], 0, None, 7, 0, 1, 0, hashlib.sha256(listed.encode()).hexdigest())]


def test_copies_end_at_one_node_over_many_runs(spark):
    """Numbers far apart lie in different runs; the digest is of all, in order."""
    ids = sorted({*range(0, 30000, 95), -25000, -5, 4095, 4096, 8190, 10**15})
    rows = [(c, t, "user", f"turn {t}") for c in ids for t in range(10)]
    got = trie(spark, spark.createDataFrame(rows, SCHEMA))
    assert got == brute(rows)
    assert any(r[3] == len(ids) and r[1] == 10 for r in got)


def test_long_conversation(spark):
    rows = [(0, t, "user", str(t % 7)) for t in range(700)] + [(5, t, "user", str(t % 7)) for t in range(650)]
    assert trie(spark, spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_empty(spark):
    assert trie(spark, spark.createDataFrame([], SCHEMA)) == []


def test_given_conversations(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = op13_prefix_trie(spark, "/root/testdata/sf0.001").collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)
