"""SimHash near-duplicates by deletion variants of fingerprint segments.

A text's fingerprint has bit j set if more than half of its shingles' hashes have. Two
texts are linked if their fingerprints differ in at most four of the 64 bits.

Index. With four bits that may differ, three segments are enough for one of them to differ
in at most one bit (were there two in each, that would be six). Every fingerprint is put
under each of its segments with one bit of it wildcarded: 64 keys, one for each bit, of
the segment and what is left of it. Two segments that differ in at most one bit have the
variant without that bit in common, so every link is found by an equality join on keys,
and what the join finds is verified by counting the bits that differ.

Nodes are fingerprints, not documents: copies cost nothing. Of each key the fingerprint
of the most documents is the leader, and all others are first verified against it; this
ties groups of near copies together by as many links as they have members. What is still
apart is then joined key by key, with the condition that both belong to different
components so far: the links that it finds are all that were missing, and no bucket is
dropped or cut off.

A key holds 20 or 21 bits, so of some 16 million fingerprints a dozen share one. Beyond
that (``PARTED``, counted) a second cut narrows the keys: the bits outside the segment
also differ in at most four, so of five parts of them one is equal and joins the key, at
five times the rows. The links are the same ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.common import Scratch, quoted, ready, slices, text_of, utf8
from sedimenta.llm.near_dup import components

SHINGLE = 4
DISTANCE = 4
#: Seed of the hash of a shingle.
SEED = 42
#: First bit and length of each segment.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Fingerprints from which on the bits outside a segment narrow its keys, and their parts.
PARTED, PARTS = 1 << 24, DISTANCE + 1
#: Shingles that are hashed at a time.
BLOCK = 1 << 16

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True
_LANES = np.uint64(0x0101010101010101)


# --- fingerprints -------------------------------------------------------------------


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case words with one blank between, where each begins and ends, words before each text."""
    n = len(data)
    inside = ~_BLANK[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    start = np.flatnonzero(inside & (np.r_[True, ~inside[:-1]] | edge[:n]))
    end = np.flatnonzero(inside & (np.r_[~inside[1:], True] | edge[1:])) + 1
    stay = inside.copy()
    gap = end[end < n]
    stay[gap] = True  # the blank after a word; at the end of a text it is not needed, but harmless
    place = np.cumsum(stay) - stay
    clean = np.where(inside, _LOWER[data], np.uint8(32))[stay]
    first = place[start] if len(start) else start
    return clean, first, first + (end - start), np.searchsorted(start, offsets)


def fingerprints(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """64-bit fingerprint of each text; 0 for a text without words."""
    clean, first, last, bounds = _words(data, offsets)
    words = np.diff(bounds)
    each = np.where(words >= size, words - size + 1, (words > 0).astype(words.dtype))
    before = np.concatenate([[0], np.cumsum(each)])
    raw, digest = clean.tobytes(), xxhash.xxh64_intdigest
    counts = np.zeros((len(words), 64), np.int64)
    for low in range(0, int(before[-1]), BLOCK):
        number = np.arange(low, min(low + BLOCK, int(before[-1])))
        text = np.searchsorted(before, number, side="right") - 1
        at = bounds[text] + number - before[text]
        tail = at + np.minimum(size, words[text]) - 1
        pairs = zip(first[at].tolist(), last[tail].tolist(), strict=True)
        hashes = np.fromiter((digest(raw[a:b], SEED) for a, b in pairs), np.uint64, len(number))
        # runs of one text and of at most 255 hashes: a byte holds how many have a bit set
        new = np.flatnonzero(np.diff(text, prepend=-1))
        since = np.arange(len(text)) - np.repeat(new, np.diff(np.append(new, len(text))))
        runs = np.flatnonzero(since % 255 == 0)
        for bit in range(8):
            sums = np.add.reduceat((hashes >> np.uint64(bit)) & _LANES, runs)
            lanes = sums.astype("<u8").view(np.uint8).reshape(-1, 8).astype(np.int64)
            np.add.at(counts, (text[runs][:, None], np.arange(8) * 8 + bit), lanes)
    bits = (2 * counts > each[:, None]).astype(np.uint8)
    return np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel()


def _sign(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            found = np.zeros(batch.num_rows, np.uint64)
            for a, b in slices(offsets):
                part = offsets[a : b + 1] - offsets[a]
                found[a:b] = fingerprints(data[offsets[a] : offsets[b]], part, size)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fingerprint"]
            )

    return run


# --- links --------------------------------------------------------------------------


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _outside(segment: tuple[int, int]) -> list[int]:
    """The bits outside a segment as ``PARTS`` masks."""
    start, length = segment
    rest = [j for j in range(64) if not start <= j < start + length]
    return [sum(1 << j for j in part.tolist()) for part in np.array_split(rest, PARTS)]


def keyed(prints: DataFrame, parted: bool) -> DataFrame:
    """Every row once for each variant of its ``fingerprint``, which ``key`` names."""
    bit = F.col("bit")
    start, inside = F.lit(0), F.lit(0)
    for first, length in SEGMENTS:
        start = F.when(bit >= first, F.lit(first)).otherwise(start)
        inside = F.when(bit >= first, F.lit((1 << length) - 1)).otherwise(inside)
    kept = F.expr("fingerprint & ~(1L << bit)")
    value = F.call_function("shiftrightunsigned", kept, start).bitwiseAND(inside)
    key = F.call_function("shiftleft", bit.cast("long"), F.lit(22)).bitwiseOR(value)
    spread = prints.withColumn("bit", F.explode(F.sequence(F.lit(0), F.lit(63))))
    if not parted:
        return spread.select(*prints.columns, key.alias("key"))
    masks = F.array(*[F.lit(_signed(m)) for segment in SEGMENTS for m in _outside(segment)])
    nth = F.lit(len(SEGMENTS) - 1)
    for i, (first, length) in reversed([*enumerate(SEGMENTS)]):
        nth = F.when(bit < first + length, F.lit(i)).otherwise(nth)
    spread = spread.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    mask = F.element_at(masks, (nth * PARTS + F.col("part") + 1).cast("int"))
    narrow = F.xxhash64(key, F.col("part"), F.col("fingerprint").bitwiseAND(mask))
    return spread.select(*prints.columns, narrow.alias("key"))


def differing(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def linked(prints: DataFrame, scratch: Scratch, parted: bool | None = None) -> DataFrame:
    """``fingerprint`` and ``root`` of every distinct fingerprint (``copies`` is its weight)."""
    if parted is None:
        parted = prints.count() > PARTED
    tie = F.pmod(F.xxhash64("fingerprint"), F.lit(1 << 24))
    weight = F.least(F.col("copies"), F.lit(1 << 38)) * F.lit(1 << 24) + tie
    all_keys = keyed(prints.select("fingerprint", weight.alias("weight")), parted)
    leaders = scratch.keep(
        all_keys.groupBy("key").agg(F.max_by("fingerprint", "weight").alias("leader"))
    )
    close = (F.col("fingerprint") != F.col("leader")) & (
        differing(F.col("fingerprint"), F.col("leader")) <= DISTANCE
    )
    plain = keyed(prints.select("fingerprint"), parted)
    led = plain.hint("merge").join(leaders, (plain["key"] == leaders["key"]) & close)
    edges = scratch.keep(led.select(F.col("fingerprint").alias("u"), F.col("leader").alias("v")).distinct())
    scratch.free(leaders)

    def rooted(edges: DataFrame) -> DataFrame:
        ends = components(edges, scratch).withColumnRenamed("node", "fingerprint")
        return prints.select("fingerprint").join(ends, "fingerprint", "left").select(
            "fingerprint", F.coalesce("root", "fingerprint").alias("root")
        )

    placed = scratch.keep(rooted(edges))
    every = keyed(placed, parted)
    a, b = (every.select("key", F.col("fingerprint").alias(x), F.col("root").alias(f"root_{x}")) for x in "uv")
    apart = (F.col("root_u") < F.col("root_v")) & (differing(F.col("u"), F.col("v")) <= DISTANCE)
    missing = a.hint("merge").join(b, (a["key"] == b["key"]) & apart).select("u", "v").distinct()
    grown = scratch.keep(edges.union(missing))
    out = scratch.keep(rooted(grown))
    scratch.free(edges, placed, grown)
    return out


def simhash_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", parted: bool | None = None
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``fingerprint`` (16 hex digits) and
    ``component_id``, the smallest id that links lead to, its own included.

    Words are what blanks and ASCII control blanks separate, after A-Z are lower case;
    four of them are a shingle, and so is a shorter text as a whole. A text without
    words (NULL, empty, blank) has fingerprint zero and is linked like any other. Long
    texts are read whole, in blocks of shingles. Rows with one id are rows of their own:
    each has its text's fingerprint and component. A row with a NULL id takes part in
    links, but never names a component; one whose component has no id at all gets NULL.
    Other columns are not read. ``parted`` forces or forbids the second cut of the keys.
    """
    ready(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "simhash")
    texts = docs.select(quoted(id_col).cast("long"), text_of(docs, text_col))
    signed = scratch.keep(texts.mapInArrow(_sign(SHINGLE), "doc_id long, fingerprint long"))
    prints = scratch.keep(
        signed.groupBy("fingerprint").agg(F.count("*").alias("copies"), F.min("doc_id").alias("least"))
    )
    roots = linked(prints, scratch, parted)
    named = prints.join(roots, "fingerprint")
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of_print = scratch.keep(named.join(smallest, "root").select("fingerprint", "component_id"))
    scratch.free(prints, roots)
    return signed.join(of_print, "fingerprint").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
