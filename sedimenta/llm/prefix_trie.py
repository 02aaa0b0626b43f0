"""The trie of conversation prefixes, by ROLLUP over positional turn columns.

A turn's id is a digest of its role and text with the text's length, so texts are read
once and not moved on. Eight turns of a conversation make one row, a block, with a column
for each position; ``ROLLUP`` over these columns aggregates the prefixes of all lengths
together, and ``grouping_id`` says which length a group has. A longer conversation goes
on in further rows, grouped by the node at which the block before them ended; that node
is known by 128 bits that depend on every turn before it (an XOR of hashes of position
and turn, which a window carries along a conversation's blocks), so blocks of all depths
are rolled up in one pass.

What a node says of its whole subtree needs no walk over the tree. Its smallest member
owns a node; a conversation owns the lower end of its path, from some depth on. A leaf
has one owner, and a node's text is counted once, by its owner, so the subtree's sums are
sums over the members, and a second ROLLUP gives them: leaves owned, bytes of all turns,
bytes of owned nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sedimenta.llm.common import Scratch, quoted, ready

#: Turns of a block: positional columns of one ROLLUP.
BLOCK = 8
#: A conversation with number c begins with turns of the one with number c - c % SIBLINGS.
SIBLINGS, MOST_SHARED = 5, 9
#: Ids that end at one node are digested in runs of this many numbers (a power of 2).
RUN_BITS = 12

_AT = [f"t{i}" for i in range(1, BLOCK + 1)]
_EMPTY = hashlib.sha256(b"").hexdigest()


# --- turns --------------------------------------------------------------------------


def turn_id(role: Column, text: Column) -> Column:
    """24 bytes: 128 bits of a digest of role and text, then the text's size in bytes."""
    both = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    size = F.lpad(F.hex(F.octet_length(text).cast("long")), 16, "0")
    return F.unhex(F.concat(F.left(F.sha2(both, 256), F.lit(32)), size))


def _bytes_of(turn: Column) -> Column:
    return F.conv(F.hex(F.substr(turn, F.lit(17), F.lit(8))), 16, 10).cast("long")


def numbered_turns(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """``conv``, ``at`` (from 1) and ``turn_id`` of every row with a conversation.

    Turns go by number, NULL first; equal ones by role, by the text's first 64
    characters, and by digest. NULL roles and texts are empty. Rows without a
    conversation are left out.
    """
    role = F.coalesce(quoted(role_col).cast("string"), F.lit(""))
    text = F.coalesce(quoted(text_col).cast("string"), F.lit(""))
    rows = conversations.filter(quoted(conv_col).isNotNull()).select(
        quoted(conv_col).cast("long").alias("conv"),
        quoted(turn_col).alias("turn"),
        F.left(role, F.lit(64)).alias("role"),
        F.left(text, F.lit(64)).alias("head"),
        turn_id(role, text).alias("turn_id"),
    )
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "head", "turn_id")
    return rows.select("conv", F.row_number().over(order).alias("at"), "turn_id")


def spliced(turns: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with turns of another one, and their lengths.

    Conversation c becomes the first h turns of conversation ``c - c % 5`` (all, if it
    has fewer; none, if there is no such conversation) and its own turns after its first
    h; h is the CRC-32 of c in decimal digits, modulo 9. Gives ``conv``, ``at``,
    ``turn_id``, and ``conv``, ``length`` of every conversation, also of those left empty.
    """
    sizes = turns.groupBy("conv").agg(F.max("at").alias("size"))
    shared = (F.crc32(F.col("conv").cast("string").cast("binary")) % MOST_SHARED).cast("int")
    own = sizes.select("conv", "size", (F.col("conv") - F.col("conv") % SIBLINGS).alias("base"), shared.alias("h"))
    first_of = sizes.select(F.col("conv").alias("base"), F.col("size").alias("base_size"))
    shift = F.least("h", F.coalesce("base_size", F.lit(0)))
    known = scratch.keep(
        own.join(first_of, "base", "left").select("conv", "base", "h", "size", shift.alias("shift"))
    )
    heads = turns.filter(F.col("at") < MOST_SHARED).withColumnRenamed("conv", "base")
    taken = known.select("conv", "base", "h").join(heads, "base").filter("at <= h").select("conv", "at", "turn_id")
    kept = (
        turns.join(known.select("conv", "h", "shift"), "conv")
        .filter("at > h")
        .select("conv", (F.col("at") - F.col("h") + F.col("shift")).alias("at"), "turn_id")
    )
    length = F.col("shift") + F.greatest(F.col("size") - F.col("h"), F.lit(0))
    return taken.unionByName(kept), known.select("conv", length.alias("length"))


# --- blocks and nodes ---------------------------------------------------------------


def _mark(at: Column, turn: Column, side: int) -> Column:
    """64 bits of a turn at its place; the key of a prefix is the XOR of its turns' marks."""
    return F.xxhash64(at.cast("long"), turn) if side == 0 else F.xxhash64(F.lit(1), turn, at.cast("long"))


def _blocks(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """One row per conversation and ``BLOCK`` turns: ``conv``, ``length``, ``total`` (bytes),
    ``block``, what lies before it (``key_a``, ``key_b``, ``before`` bytes), the turn columns,
    and ``end_a``, ``end_b``, the key after it."""
    at = F.col("at") - 1
    numbered = turns.select(
        "conv", F.expr(f"(at - 1) div {BLOCK}").alias("block"), "at", "turn_id"
    )
    place = F.pmod(at, F.lit(BLOCK)).cast("int")
    held = numbered.groupBy("conv", "block").agg(
        F.map_from_entries(F.collect_list(F.struct(place, "turn_id"))).alias("by_place"),
        F.sum(_bytes_of(F.col("turn_id"))).alias("size"),
        F.bit_xor(_mark(F.col("at"), F.col("turn_id"), 0)).alias("xor_a"),
        F.bit_xor(_mark(F.col("at"), F.col("turn_id"), 1)).alias("xor_b"),
    )
    rows = lengths.join(held, "conv", "left")
    along = Window.partitionBy("conv").orderBy("block")
    earlier, until = (along.rowsBetween(Window.unboundedPreceding, end) for end in (-1, 0))
    zero = F.lit(0).cast("long")
    return rows.select(
        "conv",
        "length",
        F.coalesce(F.sum("size").over(Window.partitionBy("conv")), zero).alias("total"),
        F.coalesce("block", zero).alias("block"),
        F.coalesce(F.bit_xor("xor_a").over(earlier), zero).alias("key_a"),
        F.coalesce(F.bit_xor("xor_b").over(earlier), zero).alias("key_b"),
        F.coalesce(F.sum("size").over(earlier), zero).alias("before"),
        *[F.try_element_at("by_place", F.lit(i)).alias(name) for i, name in enumerate(_AT)],
        F.coalesce(F.bit_xor("xor_a").over(until), zero).alias("end_a"),
        F.coalesce(F.bit_xor("xor_b").over(until), zero).alias("end_b"),
    )


def _rolled(blocks: DataFrame, **sums: str) -> DataFrame:
    """The nodes of all depths with the given aggregates over their members' rows.

    ``key_a``, ``key_b`` name a node, ``up_a``, ``up_b`` its parent; ``size`` is its last
    turn's text in bytes and ``before`` what lies above that.
    """
    listed = ", ".join(f"{expression} AS {name}" for name, expression in sums.items())
    turns = ", ".join(_AT)
    groups = blocks.sparkSession.sql(
        f"""SELECT block, key_a, key_b, before, {turns}, {listed},
                   {BLOCK} - CAST(bit_count(grouping_id()) AS INT) AS used
            FROM {{rows}} GROUP BY block, key_a, key_b, before, ROLLUP ({turns})""",
        rows=blocks,
    )
    # of a later block the group of no turn is the last node of the block before
    last = F.element_at(F.array(*_AT), F.greatest(F.col("used"), F.lit(1)))
    real = groups.withColumn("last", F.when(F.col("used") > 0, last)).filter(
        ((F.col("used") == 0) & (F.col("block") == 0)) | F.col("last").isNotNull()
    )
    depth = F.col("block") * BLOCK + F.col("used")
    out = {"up": [], "key": []}
    for side, name in enumerate(("key_a", "key_b")):
        key = F.col(name)
        for i, column in enumerate(_AT):
            position = F.col("block") * BLOCK + (i + 1)
            inner = (F.col("used") > i + 1) & F.col(column).isNotNull()
            key = key.bitwiseXOR(F.when(inner, _mark(position, F.col(column), side)).otherwise(F.lit(0)))
        own = F.when(F.col("last").isNotNull(), _mark(depth, F.col("last"), side)).otherwise(F.lit(0))
        out["up"].append(key.alias(f"up_{'ab'[side]}"))
        out["key"].append(key.bitwiseXOR(own).alias(f"key_{'ab'[side]}"))
    above = F.col("before")
    for i, column in enumerate(_AT):
        above += F.when(F.col("used") > i + 1, _bytes_of(F.col(column))).otherwise(F.lit(0))
    return real.select(
        depth.alias("depth"),
        *out["key"],
        *out["up"],
        F.coalesce(_bytes_of(F.col("last")), F.lit(0)).alias("size"),
        above.alias("before"),
        *sums,
    )


# --- conversations that end at a node -----------------------------------------------


def _digest_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the runs of each node, which come one after the other, in order."""
    key, state, done = None, None, []

    def out() -> pa.RecordBatch:
        columns = [*zip(*done, strict=True)] if done else [[]] * 4
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
            names=["depth", "key_a", "key_b", "ends_sha256"],
        )

    for batch in batches:
        nodes = zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)
        for node, run in zip(nodes, batch.column(4).to_pylist(), strict=True):
            if node == key:
                state.update(b",")
            else:
                if key is not None:
                    done.append((*key, state.hexdigest()))
                key, state = node, hashlib.sha256()
            state.update(run.encode())
        if done:
            yield out()
            done = []
    if key is not None:
        done.append((*key, state.hexdigest()))
    yield out()


def _ends(blocks: DataFrame) -> DataFrame:
    """``depth``, ``key_a``, ``key_b``, ``ends_sha256`` of the nodes at which conversations end.

    The ids of a node are first put together in runs of neighbouring numbers, wherever
    they are; the digest then reads one run after the other and holds none of them.
    """
    last = blocks.filter(F.col("block") == F.expr(f"greatest(length - 1, 0) div {BLOCK}"))
    node = ["depth", "key_a", "key_b"]
    ended = last.select(
        F.col("length").cast("long").alias("depth"),
        F.col("end_a").alias("key_a"),
        F.col("end_b").alias("key_b"),
        F.shiftright("conv", RUN_BITS).alias("run"),
        "conv",
    )
    ordered = F.array_sort(F.collect_list("conv")).cast("array<string>")
    runs = ended.groupBy(*node, "run").agg(F.array_join(ordered, ",").alias("ids"))
    return (
        runs.repartition("key_a", "key_b")
        .sortWithinPartitions(*node, "run")
        .select(*node, "run", "ids")
        .mapInArrow(_digest_runs, "depth long, key_a long, key_b long, ends_sha256 string")
    )


# --- the operator -------------------------------------------------------------------


def prefix_trie(turns: DataFrame, lengths: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """One row per distinct prefix of the conversations.

    ``turns`` has ``conv``, ``at`` (1, 2, 3 ... without gaps) and ``turn_id`` as
    :func:`turn_id` makes them, ``lengths`` has ``conv`` and ``length`` of every
    conversation, 0 for one without turns. Gives ``conv_id`` (smallest member),
    ``depth``, ``parent_conv_id`` (NULL for the root), ``n_convs``, ``n_children``,
    ``n_leaves`` (childless nodes of the subtree, itself included), ``saved_tokens`` (over
    the subtree, one less than the members times the bytes of the last text) and
    ``ends_sha256`` (of the decimal ids, in order, of the members that end there). No
    conversation, no node, not even a root.
    """
    spark = turns.sparkSession
    ready(spark)
    scratch = scratch or Scratch(spark, "trie")
    blocks = scratch.keep(_blocks(turns, lengths))
    node = ["depth", "key_a", "key_b"]
    first = scratch.keep(
        _rolled(blocks, conv_id="min(conv)", n_convs="count(*)", longest="max(length)")
    )
    # what each owner has: the bytes above its first node, and whether it ends a path
    owners = first.groupBy("conv_id").agg(
        F.min_by("before", "depth").alias("start"),
        F.max((F.col("longest") == F.col("depth")).cast("long")).alias("leaf"),
    )
    owned = blocks.join(owners.withColumnRenamed("conv_id", "conv"), "conv", "left").select(
        *[c for c in blocks.columns if c not in ("end_a", "end_b")],
        F.col("start"),
        F.coalesce("leaf", F.lit(0)).alias("leaf"),
        F.coalesce(F.col("total") - F.col("start"), F.lit(0)).alias("own"),
    )
    sums = scratch.keep(
        _rolled(
            owned,
            conv_id="min(conv)",
            start="min_by(start, conv)",
            n_convs="count(*)",
            n_leaves="sum(leaf)",
            all_bytes="sum(total)",
            own_bytes="sum(own)",
        )
    )
    children = first.filter("depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("up_a").alias("key_a"), F.col("up_b").alias("key_b")
    ).agg(F.count("*").alias("n_children"))
    parents = first.select(
        (F.col("depth") + 1).alias("depth"),
        F.col("key_a").alias("up_a"),
        F.col("key_b").alias("up_b"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    # every text below, for all members, less every text below, once for each node
    every = F.col("all_bytes") - F.col("n_convs") * F.col("before")
    once = F.col("own_bytes") - (F.col("before") - F.col("start"))
    return (
        sums.join(scratch.keep(children), node, "left")
        .join(scratch.keep(_ends(blocks)), node, "left")
        .join(parents, ["depth", "up_a", "up_b"], "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
            "n_leaves",
            (every - once).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"),
        )
    )


#: DuckDB: prefixes as lists of digests; CRC-32 bit by bit; subtrees by listing ancestors.
SQL = r"""
WITH numbered AS (
  SELECT conv_id AS c,
         row_number() OVER (PARTITION BY conv_id
                            ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos,
         sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS id,
         strlen(coalesce(text, '')) AS size
  FROM {conversations} WHERE conv_id IS NOT NULL
), own AS (
  SELECT c, list({{'id': id, 'size': size}} ORDER BY pos) AS turns, c - c % 5 AS base,
         xor(list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
           lambda r, b: list_reduce([xor(r, b), 1, 1, 1, 1, 1, 1, 1, 1],
             lambda v, k: xor(v >> 1, (v & 1) * 3988292384))), 4294967295) % 9 AS h
  FROM numbered GROUP BY c
), paths AS (
  SELECT a.c, list_concat(coalesce(b.turns, [])[1:a.h], a.turns[a.h + 1:]) AS path
  FROM own a LEFT JOIN own b ON a.base = b.c
), steps AS (
  SELECT c, d, len(path) AS length, list_transform(path[1:d], lambda t: t.id) AS prefix,
         CASE WHEN d > 0 THEN path[d].size ELSE 0 END AS size
  FROM paths, LATERAL (SELECT unnest(range(0, len(path) + 1)) AS d)
), nodes AS (
  SELECT d, prefix, min(c) AS conv_id, count(*) AS n_convs, max(size) AS size,
         coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE length = d), '') AS ends
  FROM steps GROUP BY d, prefix
), kids AS (
  SELECT d - 1 AS d, prefix[1:d - 1] AS prefix, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL
), full_nodes AS (
  SELECT n.*, coalesce(k.n, 0) AS n_children FROM nodes n LEFT JOIN kids k ON n.d = k.d AND n.prefix = k.prefix
), below AS (
  SELECT a AS d, prefix[1:a] AS prefix, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves,
         sum((n_convs - 1) * size) AS saved
  FROM full_nodes, LATERAL (SELECT unnest(range(0, full_nodes.d + 1)) AS a) GROUP BY ALL
)
SELECT n.conv_id, n.d::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs,
       n.n_children::BIGINT AS n_children, b.n_leaves::BIGINT AS n_leaves,
       b.saved::BIGINT AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM full_nodes n JOIN below b ON n.d = b.d AND n.prefix = b.prefix
LEFT JOIN nodes p ON p.d = n.d - 1 AND p.prefix = n.prefix[1:n.d - 1]
"""
