"""Trees given by a parent column: ancestors, faults, and totals of everything below.

The closure (every node with each of its ancestors) is made by pointer doubling: after k
rounds every node knows its next 2^k ancestors and points to the one after those; a round
joins each node with what its pointer knows. A tree of depth d takes log2(d) rounds, and
each row of the closure is made once. The pointers alone come first: a node whose pointer
still leads somewhere after more steps than there are nodes lies on a cycle or below one,
and is left out before its endless list of ancestors is begun.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.session import stage

#: What can be wrong with a node.
ORPHAN, CYCLE, REPEATED, PATH, LEVEL = "orphan", "cycle", "repeated", "path", "level"


@dataclass(frozen=True)
class Hierarchy:
    """``closure`` holds (``id``, ``ancestor``, ``distance``), each node being its own at
    distance 0; ``faults`` holds (``id``, ``fault``, ``detail``)."""

    closure: DataFrame
    faults: DataFrame


def hierarchy(
    nodes: DataFrame,
    id_col: str = "id",
    parent_col: str = "parent_id",
    path_col: str | None = None,
    level_col: str | None = None,
) -> Hierarchy:
    """The closure of a tree, or of many, and what is wrong with it.

    A node without parent (NULL, or its own id) is a root. One whose parent is not there
    is an ``orphan`` and the root of what lies below it. Nodes on a cycle, or below one,
    have the fault ``cycle`` and only themselves in the closure. An id with several rows
    is ``repeated``; the smallest of its parents counts. Rows with a NULL id take no
    part. With ``path_col`` (ids from the root down, each after a ``/``) and ``level_col``
    (1 at the root) both are compared with the tree; NULL is not compared.

    The rows of the closure are the sum of all depths. Each round is a written table, so
    its lineage is short and a lost executor costs a round's tasks at most. The joins are
    by the pointer: many nodes point to one (the root, at the end), which AQE splits, as
    the side they look up is unique by it.
    """
    known = nodes.filter(F.col(id_col).isNotNull())
    own, parent = F.col(id_col).cast("string"), F.col(parent_col).cast("string")
    rows = known.select(own.alias("id"), F.when(parent != own, parent).alias("parent"))
    single = rows.groupBy("id").agg(F.count(F.lit(1)).alias("n_rows"), F.min("parent").alias("parent"))
    there = single.select(F.col("id").alias("_there"))
    tree = single.join(there, F.col("parent") == F.col("_there"), "left")
    tree = stage(tree.select("id", "n_rows", "parent", F.col("_there").alias("up")), "tree")
    pointers = _pointers(tree.filter("up IS NOT NULL").select("id", "up"), tree.count())
    lost = pointers.pop()
    if lost.limit(1).count():
        pointers = [p.join(lost.select("id"), "id", "left_anti") for p in pointers]
    closure = _closure(pointers, lost)
    every = tree.select("id", F.col("id").alias("ancestor"), F.lit(0).alias("distance"))
    closure = stage(every.unionByName(closure), "closure")
    faults = [
        tree.filter("parent IS NOT NULL AND up IS NULL").select("id", F.lit(ORPHAN), "parent"),
        lost.select("id", F.lit(CYCLE), F.lit(None).cast("string")),
        tree.filter("n_rows > 1").select("id", F.lit(REPEATED), F.col("n_rows").cast("string")),
    ]
    faults += _told_otherwise(known, closure, lost, id_col, path_col, level_col)
    found = faults[0].toDF("id", "fault", "detail")
    for more in faults[1:]:
        found = found.unionByName(more.toDF("id", "fault", "detail"))
    return Hierarchy(closure, found)


def _pointers(up: DataFrame, n_nodes: int) -> list[DataFrame]:
    """``id`` to its 1st, 2nd, 4th ... ancestor, as far as there is one.

    The last table is empty, or holds the nodes whose way up has no end.
    """
    out, step = [stage(up, "pointers")], 1
    while out[-1].limit(1).count() and step < n_nodes:  # a way up has fewer steps than there are nodes
        now = out[-1]
        on = now.select(F.col("id").alias("_at"), F.col("up").alias("_up"))
        out.append(stage(now.join(on, F.col("up") == F.col("_at")).select("id", F.col("_up").alias("up")), "pointers"))
        step *= 2
    return out


def _closure(pointers: list[DataFrame], empty: DataFrame) -> DataFrame:
    """(``id``, ``ancestor``, ``distance``) of all proper ancestors."""
    first = pointers[0] if pointers else empty.limit(0)
    closure = first.select("id", F.col("up").alias("ancestor"), F.lit(1).alias("distance"))
    for k, pointer in enumerate(pointers):
        ahead = closure.select(
            F.col("id").alias("_at"), F.col("ancestor").alias("_far"), F.col("distance").alias("_more")
        )
        further = pointer.join(ahead, F.col("up") == F.col("_at")).select(
            "id", F.col("_far").alias("ancestor"), (F.col("_more") + F.lit(1 << k)).alias("distance")
        )
        closure = closure.unionByName(stage(further, "ancestors"))
    return closure


def _told_otherwise(known, closure, lost, id_col, path_col, level_col) -> list[DataFrame]:
    """Nodes whose path or level is not that of the tree."""
    if not path_col and not level_col:
        return []
    walked = closure.groupBy("id").agg(
        F.max("distance").alias("steps"),
        F.array_sort(F.collect_list(F.struct((-F.col("distance")).alias("turn"), "ancestor"))).alias("way"),
    )
    path = F.concat(F.lit("/"), F.array_join(F.transform("way", lambda x: x["ancestor"]), "/"))
    told = known.select(
        F.col(id_col).cast("string").alias("id"),
        *([F.col(path_col).alias("path")] if path_col else []),
        *([F.col(level_col).cast("long").alias("level")] if level_col else []),
    ).join(lost.select("id"), "id", "left_anti")
    both = told.join(walked.select("id", path.alias("true_path"), (F.col("steps") + 1).alias("true_level")), "id")
    out = []
    if path_col:
        out.append(both.filter("path <> true_path").select("id", F.lit(PATH), "true_path"))
    if level_col:
        wrong = both.filter("level <> true_level")
        out.append(wrong.select("id", F.lit(LEVEL), F.col("true_level").cast("string")))
    return out


def below(closure: DataFrame, ancestor: str) -> DataFrame:
    """Everything below one node, itself included: ``id`` and ``distance``."""
    return closure.filter(F.col("ancestor") == ancestor).select("id", "distance")


def roll_up(facts: DataFrame, closure: DataFrame, node_col: str, sums: list[str]) -> DataFrame:
    """``ancestor``, ``n_facts`` and sums of the facts of each node and all below it.

    Facts are added up by node before they meet the closure, so what is joined is one row
    per node, not one per fact. Facts of a node that the tree does not have are under
    ``ancestor`` NULL, which also says that the totals of the roots lack them.
    """
    own = facts.groupBy(F.col(node_col).cast("string").alias("id")).agg(
        F.count(F.lit(1)).alias("n_facts"), *[F.sum(c).alias(c) for c in sums]
    )
    spread = own.join(closure.select("id", "ancestor"), "id", "left")
    return spread.groupBy("ancestor").agg(*[F.sum(c).alias(c) for c in ("n_facts", *sums)])
