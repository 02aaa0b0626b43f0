import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sedimenta.llm import sharding as sh


def blocks_of(seed, old=5, classes=4):
    rng = random.Random(seed)
    return [sh.Block(o, c, n := rng.randint(0, 30), n * (10 + 20 * c)) for o in range(old) for c in range(classes)]


def cheapest_by_hand(blocks, room):
    """Each shard keeps its dearest rows: what is left over has to move."""
    moved = 0
    for shard in {b.old for b in blocks}:
        free = room[shard] if shard < len(room) else 0
        for b in sorted((b for b in blocks if b.old == shard), key=lambda b: -b.bytes / max(b.rows, 1)):
            stay = min(free, b.rows)
            free -= stay
            moved += (b.rows - stay) * b.bytes / max(b.rows, 1)
    return moved


@pytest.mark.parametrize("seed", range(12))
@pytest.mark.parametrize("shards", [3, 5, 8])
def test_plan_moves_the_fewest_bytes(seed, shards):
    blocks = blocks_of(seed)
    room = sh.capacities(blocks, shards)
    assert max(room) - min(room) <= 1
    plan, moved = sh.plan_transfers(blocks, room)
    assert moved == pytest.approx(cheapest_by_hand(blocks, room), abs=1)
    out, slots = Counter(), defaultdict(set)
    for t in plan:
        out[t.old, t.size_class] += t.rows
        span = set(range(t.slot, t.slot + t.rows))
        assert not span & slots[t.shard]
        slots[t.shard] |= span
    assert all(out[b.old, b.size_class] == b.rows for b in blocks)
    assert [len(slots[j]) for j in range(shards)] == room
    assert all(slots[j] == set(range(room[j])) for j in range(shards))


def test_a_bad_start_is_mended_by_cycles():
    net = sh.Network.of(4)
    dear = [net.arc(0, 1, 5, 3.0, 5), net.arc(1, 3, 5, 3.0, 5)]
    cheap = [net.arc(0, 2, 4, 1.0), net.arc(2, 3, 4, 1.0)]
    assert net.cheapest() >= 1
    assert [net.flow(a) for a in dear + cheap] == [1, 1, 4, 4]


def test_rows_and_slots(documents):
    rng = random.Random(4)
    rows = [(i, "é" * rng.choice([0, 1, 5, 50, 400])) for i in range(1000)] + [(7, "same")] * 40 + [(None, None)] * 15
    docs = documents(*rows, extra=True)
    placed, plan = sh.reshard(docs, 9, sh.old_shard_of(F.col("doc_id"), 6))
    assert placed.columns == [*docs.columns, "size", "shard", "slot"]
    got = placed.collect()
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter(rows)
    assert all(r["size"] == len((r["text"] or "").encode()) + 16 for r in got)
    by_shard = defaultdict(list)
    for r in got:
        by_shard[r["shard"]].append(r["slot"])
    sizes = [len(by_shard[j]) for j in range(9)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by_shard.values())
    old = {r["doc_id"]: r["o"] for r in docs.select("doc_id", sh.old_shard_of(F.col("doc_id"), 6).alias("o")).collect()}
    moved = sum(r["shard"] != old[r["doc_id"]] for r in got)
    held = Counter(old[i] for i, _ in rows)
    assert moved == len(rows) - sum(min(held[o], sizes[o]) for o in held)


def test_files(documents, tmp_path):
    docs = documents(*[(i, f"t{i}") for i in range(100)])
    first, plan = sh.reshard(docs, 4, F.lit(0))
    old = sh.rewrite_shards(first, plan, str(tmp_path / "old"))
    assert sorted(r["doc_id"] for r in old.collect()) == list(range(100))
    again, plan = sh.reshard(old.drop("size", "slot").withColumnRenamed("shard", "was"), 4, F.col("was"))
    assert sh.affected(plan) == []
    grown, plan = sh.reshard(old.drop("size", "slot").withColumnRenamed("shard", "was"), 5, F.col("was"))
    assert sh.affected(plan) == [0, 1, 2, 3, 4]
    both = sh.rewrite_shards(grown.drop("was"), plan, str(tmp_path / "new"), str(tmp_path / "old"))
    assert sorted(r["doc_id"] for r in both.collect()) == list(range(100))


def test_empty(documents):
    placed, plan = sh.reshard(documents((1, "a")).limit(0), 3, F.lit(0))
    assert placed.collect() == [] and plan == []
