"""Resharding by minimum-cost flow.

Old shards are cut into blocks: the rows of one shard and one class of sizes. A flow
network takes the rows of each block (source) to the new shards (capacities): staying
costs nothing, moving costs the block's mean bytes per row. The cheapest flow says how
many rows of each block go where. Blocks and shards are few whatever the number of
rows; the rows themselves find their places in the flow by counting inside slices of
bounded size.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sedimenta.llm.common import Scratch, fresh, quoted, refuse_taken, text_of

#: Bytes that every row has besides its text.
ROW_BYTES = 16
#: Size classes: so many to a doubling of the size.
PER_OCTAVE = 4
#: Rows of a slice aimed at. A shard has as many slices as that takes, and ``SLICES`` at least.
SLICE_ROWS, SLICES = 20_000, 8
LAW = "rows"


# --- the flow -----------------------------------------------------------------------


@dataclass
class Network:
    """Arcs with capacity, cost and flow; the reverse of arc ``i`` is ``i ^ 1``."""

    nodes: int
    tail: list[int]
    head: list[int]
    room: list[int]
    cost: list[float]

    @classmethod
    def of(cls, nodes: int) -> Network:
        return cls(nodes, [], [], [], [])

    def arc(self, tail: int, head: int, room: int, cost: float, flow: int = 0) -> int:
        self.tail += [tail, head]
        self.head += [head, tail]
        self.room += [room - flow, flow]
        self.cost += [cost, -cost]
        return len(self.tail) - 2

    def flow(self, arc: int) -> int:
        return self.room[arc ^ 1]

    def cheapest(self) -> int:
        """Cancel negative cycles until there is none: the flow is then of minimum cost.

        Cycles are found by Bellman-Ford over all arcs with room; returns how many.
        """
        tail, head = np.array(self.tail), np.array(self.head)
        cost = np.array(self.cost)
        for cancelled in range(1 << 30):
            room = np.array(self.room)
            live = np.flatnonzero(room > 0)
            distance = np.zeros(self.nodes)
            came = np.full(self.nodes, -1)
            changed = -1
            for _ in range(self.nodes):
                offer = distance[tail[live]] + cost[live]
                order = np.lexsort((offer, head[live]))
                node = head[live][order]
                first = np.ones(len(node), bool)
                first[1:] = node[1:] != node[:-1]
                best = order[first]
                better = best[offer[best] < distance[head[live[best]]] - 1e-9]
                if not len(better):
                    changed = -1
                    break
                distance[head[live[better]]] = offer[better]
                came[head[live[better]]] = live[better]
                changed = int(head[live[better[0]]])
            if changed < 0:
                return cancelled
            node = changed
            for _ in range(self.nodes):
                node = int(tail[came[node]])
            cycle, at = [], node
            while True:
                cycle.append(int(came[at]))
                at = int(tail[came[at]])
                if at == node:
                    break
            push = min(self.room[a] for a in cycle)
            for a in cycle:
                self.room[a] -= push
                self.room[a ^ 1] += push
        raise AssertionError


@dataclass(frozen=True)
class Block:
    old: int
    size_class: int
    rows: int
    bytes: int


@dataclass(frozen=True)
class Transfer:
    """Rows ``start`` to ``start + rows`` of a block, and their first slot in ``shard``."""

    old: int
    size_class: int
    start: int
    rows: int
    shard: int
    slot: int


def capacities(blocks: Sequence[Block], shards: int) -> list[int]:
    """Rows of each new shard, at most one apart; the fullest old shards get the odd ones."""
    total = sum(b.rows for b in blocks)
    held = [0] * shards
    for b in blocks:
        if b.old < shards:
            held[b.old] += b.rows
    out = [total // shards] * shards
    for shard in sorted(range(shards), key=lambda i: (-held[i], i))[: total % shards]:
        out[shard] += 1
    return out


def plan_transfers(blocks: Sequence[Block], room: Sequence[int]) -> tuple[list[Transfer], int]:
    """The cheapest way into shards of the given rows, and the mean-size bytes it moves.

    Starts with the largest rows staying, fills up the rest, and lets the network cancel
    whatever can be done more cheaply.
    """
    if sum(b.rows for b in blocks) != sum(room):
        raise ValueError("capacities must add up to the rows")
    blocks = sorted(blocks, key=lambda b: (b.old, b.size_class))
    shards, hub = len(room), len(blocks) + len(room)
    net = Network.of(hub + 1)
    free = list(room)
    stay_flow = [0] * len(blocks)
    for i in sorted(range(len(blocks)), key=lambda i: -blocks[i].bytes / max(blocks[i].rows, 1)):
        b = blocks[i]
        if b.old < shards:
            stay_flow[i] = min(b.rows, free[b.old])
            free[b.old] -= stay_flow[i]
    stay, move = {}, {}
    for i, b in enumerate(blocks):
        if b.old < shards:
            stay[i] = net.arc(i, len(blocks) + b.old, b.rows, 0.0, stay_flow[i])
        move[i] = net.arc(i, hub, b.rows, b.bytes / max(b.rows, 1), b.rows - stay_flow[i])
    enter = [net.arc(hub, len(blocks) + j, sum(room), 0.0, free[j]) for j in range(shards)]
    net.cheapest()
    out, slot, moved = [], [0] * shards, 0.0
    start = [0] * len(blocks)

    def place(i: int, rows: int, shard: int) -> None:
        out.append(Transfer(blocks[i].old, blocks[i].size_class, start[i], rows, shard, slot[shard]))
        start[i] += rows
        slot[shard] += rows

    for i in range(len(blocks)):
        if i in stay and net.flow(stay[i]):
            place(i, net.flow(stay[i]), blocks[i].old)
    want = [net.flow(a) for a in enter]
    shard = 0
    for i, b in enumerate(blocks):
        left = net.flow(move[i])
        moved += left * b.bytes / max(b.rows, 1)
        while left:
            while not want[shard]:
                shard += 1
            rows = min(left, want[shard])
            place(i, rows, shard)
            want[shard] -= rows
            left -= rows
    return out, round(moved)


# --- rows ---------------------------------------------------------------------------


#: Columns that the result has beside those of the input.
RESULTS = ("size", "shard", "slot")


def row_bytes(text: Column) -> Column:
    """UTF-8 bytes of the text (NULL: none) plus ``ROW_BYTES``."""
    return F.octet_length(F.coalesce(text, F.lit(""))).cast("long") + ROW_BYTES


def old_shard_of(id_: Column, shards: int) -> Column:
    """Where a row lies in a layout by the hash of its id."""
    return F.pmod(F.xxhash64(id_), F.lit(shards)).cast("int")


def reshard(
    docs: DataFrame,
    shards: int,
    old_shard: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> tuple[DataFrame, list[Transfer]]:
    """``docs`` with ``size``, ``shard`` (0 to ``shards`` - 1) and ``slot``, and the plan.

    New shards hold numbers of rows at most one apart, slots are gapless from 0, and the
    bytes that change shards are the fewest: of each old shard the smallest rows move.
    Old shards are few whole numbers, as they are files of one table. Only the size of a text
    is looked at, however long it is. NULL ids and texts
    and repeated rows are rows like any others. An empty table gives empty shards.
    """
    refuse_taken(docs, *RESULTS)
    old, part, kind, places, turn, at = fresh(docs, "old", "part", "kind", "places", "turn", "at")
    size = row_bytes(quoted(text_col))
    rows = docs.withColumns({old: F.coalesce(old_shard.cast("int"), F.lit(0)), "size": size})
    rows = rows.withColumn(kind, F.floor(F.log2(F.col("size").cast("double")) * PER_OCTAVE).cast("int"))
    scratch = Scratch(docs.sparkSession, "blocks")
    n = docs.count()
    slices_each = F.lit(max(SLICES, -(-n // (16 * SLICE_ROWS))))
    identity = F.xxhash64(F.lit(1), quoted(id_col), F.col("size"))
    rows = rows.withColumn(part, F.pmod(identity, slices_each).cast("int"))
    counts = scratch.keep(
        rows.groupBy(F.col(old).alias("old"), F.col(part).alias("part"), F.col(kind).alias("kind")).agg(
            F.count("*").alias("n"), F.sum("size").alias("bytes")
        )
    )
    blocks = [
        Block(r["old"], r["kind"], r["n"], r["bytes"])
        for r in counts.groupBy("old", "kind").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes")).collect()
    ]
    plan, _ = plan_transfers(blocks, capacities(blocks, shards))
    moves = docs.sparkSession.createDataFrame(
        [(t.old, t.size_class, t.start, t.rows, t.shard, t.slot) for t in plan],
        "old int, kind int, start long, n long, shard int, slot long",
    )
    # a row per block with its transfers: as many as there are blocks and shards
    to = moves.groupBy("old", "kind").agg(F.collect_list(F.struct("start", "n", "shard", "slot")).alias("to"))
    before = Window.partitionBy("old", "kind").orderBy("part")
    offsets = (
        counts.withColumn("offset", F.sum("n").over(before) - F.col("n"))
        .join(to, ["old", "kind"])
        .groupBy("old", "part")
        .agg(F.collect_list(F.struct("kind", "offset", "to")).alias("places"))
        .toDF(old, part, places)
    )
    order = Window.partitionBy(old, part, kind).orderBy(
        "size", quoted(id_col), F.xxhash64(F.lit(2), text_of(docs, text_col))
    )
    numbered = rows.join(offsets.hint("merge"), [old, part]).withColumn(turn, F.row_number().over(order) - 1)
    block = F.element_at(F.filter(quoted(places), lambda p: p["kind"] == quoted(kind)), 1)
    row = block["offset"] + quoted(turn)
    hit = F.element_at(
        F.filter(block["to"], lambda t: (row >= t["start"]) & (row < t["start"] + t["n"])), 1
    )
    slot = (hit["slot"] + row - hit["start"]).alias("slot")
    placed = numbered.withColumn(at, F.struct(hit["shard"].alias("shard"), slot))
    return (
        placed.select(
            *[quoted(c) for c in docs.columns],
            "size",
            quoted(at)["shard"].alias("shard"),
            quoted(at)["slot"].cast("long").alias("slot"),
        ),
        plan,
    )


def affected(plan: Sequence[Transfer], blocks_of: Sequence[int] | None = None) -> list[int]:
    """New shards whose files change: those that take rows in, or whose old rows leave."""
    changed = {t.shard for t in plan if t.shard != t.old} | {t.old for t in plan if t.shard != t.old}
    whole = {t.shard for t in plan} | set(blocks_of or ())
    return sorted(s for s in whole if s in changed)


def rewrite_shards(
    placed: DataFrame, plan: Sequence[Transfer], path: str, old_path: str | None = None
) -> DataFrame:
    """Write the shards that change below ``path``, a folder each, rows by slot; read all.

    Shards that keep exactly their rows are read from ``old_path`` where they lie; without
    one every shard is written.
    """
    spark = placed.sparkSession
    changed = affected(plan) if old_path else None
    out = placed if changed is None else placed.filter(F.col("shard").isin(changed))
    out.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    kinds = placed.schema
    read = spark.read.schema(kinds).parquet(path)
    if changed is None:
        return read
    return read.unionByName(spark.read.schema(kinds).parquet(old_path).filter(~F.col("shard").isin(changed)))
