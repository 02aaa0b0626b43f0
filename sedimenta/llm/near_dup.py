"""Near-duplicates by BagMinHash signatures of word shingles.

A text is the multiset of its five-word shingles; two texts are linked if the weighted
Jaccard similarity of their multisets (sum of minima over sum of maxima) is 0.8 or more.

Signatures. Every shingle has one Poisson process for each dyadic interval of weights,
[0, 1), [1, 2), [2, 4), [4, 8) and so on, whose rate is the interval's width. The points
of a process fall on the signature's components at random; a shingle that occurs w times
takes all points of the intervals below w and, of the interval that holds w, those whose
place is below w (the halves of an interval are its children; a point belongs to one).
A component keeps the earliest point, so two signatures agree in a component with
exactly the weighted Jaccard similarity as probability. A process is left as soon as its
next point is later than all components of its text.

Candidates share a band of components and are verified on their whole texts. Texts with
one multiset are one representative from the start, so exact copies cost nothing.
In a band's bucket members are compared with a leader, not with each other: the member
whose buckets are the fullest, which is the original that the others are copies of, as
it agrees with most of them in most bands. Those that are not linked to it are then
compared with the leader among themselves.
Members of one bucket that are still in different components are compared exactly. In
buckets of up to ``SMALL`` members that is pair by pair. In larger ones candidates must
share one of their rarest shingles (a text can only be linked to another that has one of
the rarest fifth of its shingles among its own rarest fifth), at places that still allow
for enough others; a copy's own changes are its rarest shingles, so hardly any pair of
copies of one original comes up. Nothing is dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sedimenta.llm.common import (
    Scratch,
    fresh,
    mix,
    quoted,
    ready,
    shingles,
    slices,
    text_of,
    utf8,
    word_hashes,
)

#: Signature components are bands x rows; similarity 0.8 is missed once in 10 million.
BANDS, ROWS = 32, 4
SHINGLE = 5
THRESHOLD = 0.8

#: A bucket of more members is not compared pair by pair.
SMALL = 16

_STEP = np.uint64(0x9E3779B97F4A7C15)
#: Bits that number the texts of one slice, which has no more texts than they can.
TEXT_BITS = 14
#: Bytes of text that are signed together.
SIGN_BYTES = 4 << 20


# --- multisets ----------------------------------------------------------------------


def multisets(
    data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, shingle and its count, for every different shingle of every text."""
    words, bounds = word_hashes(data, offsets)
    hashes, text = shingles(words, bounds, size)
    return counted(hashes, text)


def counted(hashes: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same, from a shingle and its text for every place.

    Text and the upper ``64 - TEXT_BITS`` bits of the hash are sorted as one number.
    """
    if not len(hashes):
        return text, hashes, np.zeros(0, np.int64)
    key = (text.astype(np.uint64) << np.uint64(64 - TEXT_BITS)) | (hashes >> np.uint64(TEXT_BITS))
    key.sort()
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    at = np.flatnonzero(new)
    text = (key[at] >> np.uint64(64 - TEXT_BITS)).astype(np.int64)
    return text, mix(key[at] << np.uint64(TEXT_BITS)), np.diff(np.append(at, len(key)))


# --- signatures ---------------------------------------------------------------------


def _uniform(x: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1] from the upper 53 bits."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0**-53


def bag_minhash(
    text: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n_texts: int, width: int
) -> np.ndarray:
    """Signatures, ``n_texts`` by ``width``, of multisets with whole weights of 1 or more."""
    time = np.full(n_texts * width, np.inf)
    mark = np.zeros(n_texts * width, np.uint64)
    top = np.maximum(np.ceil(np.log2(np.maximum(weight, 1))).astype(np.int64), 0)  # last level
    each = top + 1
    element = np.repeat(np.arange(len(text)), each)
    level = np.arange(len(element)) - np.repeat(np.cumsum(each) - each, each)
    low = np.where(level == 0, 0.0, 2.0 ** (level - 1))
    rate = np.where(level == 0, 1.0, 2.0 ** (level - 1))
    limit = weight[element].astype(np.float64)
    seed = mix(shingle[element] + _STEP * (level.astype(np.uint64) + np.uint64(1)))
    owner = text[element]
    now = np.zeros(len(seed))
    count = 0
    while len(seed):
        count += 1
        draw = mix(seed + np.uint64(count * int(_STEP) % (1 << 64)))
        now = now - np.log(_uniform(draw)) / rate
        pick = mix(draw + _STEP)
        take = np.ones(len(seed), bool)
        high = rate > 1
        if high.any():
            take[high] = low[high] + rate[high] * (1 - _uniform(mix(pick[high] + _STEP))) < limit[high]
        slot = owner[take] * width + (pick[take] % np.uint64(width)).astype(np.int64)
        at, which = now[take], pick[take]
        np.minimum.at(time, slot, at)
        mine = time[slot] == at
        mark[slot[mine]] = which[mine]
        latest = time.reshape(n_texts, width).max(axis=1)
        go = now < latest[owner]
        seed, owner, now, rate, low, limit = (x[go] for x in (seed, owner, now, rate, low, limit))
    return mark.reshape(n_texts, width)


def _sign(size: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            n = batch.num_rows
            n_shingles = np.zeros(n, np.int64)
            digest = np.zeros((n, 2), np.uint64)
            keys = np.zeros((n, bands), np.uint64)
            for a, b in slices(offsets, SIGN_BYTES, 1 << TEXT_BITS):
                part = offsets[a : b + 1] - offsets[a]
                text, shingle, weight = multisets(data[offsets[a] : offsets[b]], part, size)
                if not len(text):
                    continue
                n_shingles[a:b] = np.bincount(text, weight, b - a).astype(np.int64)
                for k in (0, 1):
                    item = mix(mix(shingle + np.uint64((k + 7) * int(_STEP) % (1 << 64))) + weight.astype(np.uint64))
                    have = np.flatnonzero(np.diff(text, prepend=-1))
                    digest[a + text[have], k] = np.add.reduceat(item, have)
                have = np.unique(text)
                rank = np.searchsorted(have, text)
                mark = bag_minhash(rank, shingle, weight, len(have), bands * rows)
                key = np.zeros((len(have), bands), np.uint64)
                for r in range(rows):
                    key = mix(key + mark[:, r::rows] + _STEP)
                keys[a + have] = mix(key + np.arange(bands, dtype=np.uint64))
            places = pa.array(np.arange(n + 1, dtype=np.int32) * bands)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(n_shingles),
                    pa.array(digest[:, 0].view(np.int64)),
                    pa.array(digest[:, 1].view(np.int64)),
                    pa.ListArray.from_arrays(places, pa.array(keys.ravel().view(np.int64))),
                ],
                names=["doc", "part", "n_shingles", "digest_a", "digest_b", "bands"],
            )

    return run


_SIGNED = "doc long, part long, n_shingles long, digest_a long, digest_b long, bands array<long>"


# --- verification -------------------------------------------------------------------


def similarities(
    left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray], n: int, size: int
) -> np.ndarray:
    """Weighted Jaccard similarity of ``n`` pairs of texts; 0 where both have no word."""
    sides = [multisets(data, offsets, size) for data, offsets in (left, right)]
    sums = [np.bincount(text, weight, n) for text, _, weight in sides]
    text = np.concatenate([x[0] for x in sides])
    shingle = np.concatenate([x[1] for x in sides])
    weight = np.concatenate([x[2] for x in sides])
    order = np.lexsort((shingle, text))
    text, shingle, weight = text[order], shingle[order], weight[order]
    both = np.flatnonzero((text[1:] == text[:-1]) & (shingle[1:] == shingle[:-1]))
    shared = np.bincount(text[both], np.minimum(weight[both], weight[both + 1]), n)
    whole = sums[0] + sums[1] - shared
    return np.divide(shared, whole, out=np.zeros(n), where=whole > 0)


def _verify(size: int, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = utf8(batch.column(2)), utf8(batch.column(3))
            found = np.zeros(batch.num_rows, bool)
            for a, b in slices(left[1] + right[1], most=1 << TEXT_BITS):
                one, two = (
                    (data[at[a] : at[b]], at[a : b + 1] - at[a]) for data, at in (left, right)
                )
                found[a:b] = similarities(one, two, b - a, size) >= threshold
            yield batch.select([0, 1]).filter(pa.array(found))

    return run


_TOKEN = "doc long, token long, n int"


def _tokens(size: int):
    """Every shingle of every text; the second of two equal ones is another token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for a, b in slices(offsets, most=1 << TEXT_BITS):
                part = offsets[a : b + 1] - offsets[a]
                text, shingle, weight = multisets(data[offsets[a] : offsets[b]], part, size)
                total = np.bincount(text, weight, b - a).astype(np.int32)
                turn = np.arange(weight.sum()) - np.repeat(np.cumsum(weight) - weight, weight)
                text, shingle = np.repeat(text, weight), np.repeat(shingle, weight)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(a + text)),
                        pa.array(mix(shingle + turn.astype(np.uint64)).view(np.int64)),
                        pa.array(total[text]),
                    ],
                    names=["doc", "token", "n"],
                )

    return run


def rare_pairs(texts: DataFrame, roots: DataFrame, size: int, threshold: float) -> DataFrame:
    """``u``, ``v`` of texts with different roots that may be as similar as asked.

    Exact: prefix and position filters over all tokens, rarest first. Two texts of n and
    m tokens are as similar as t if they share t / (1 + t) * (n + m) of them, and then
    their first common token lies among the first n - t * n + 1 of each.
    """
    tokens = texts.select("doc", "text").mapInArrow(_tokens(size), _TOKEN)
    counts = tokens.groupBy("token").agg(F.count("*").alias("often"))
    order = Window.partitionBy("doc").orderBy("often", "token")
    ranked = tokens.join(counts.hint("merge"), "token").withColumn("at", F.row_number().over(order))
    early = ranked.filter("often > 1").filter(
        F.col("at") <= F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1
    )
    placed = early.join(roots, "doc").select("token", "doc", "n", "at", "root")
    # tokens of the very same texts bring up the same pairs: one of them stands for all,
    # at the first place that any of them has in each text
    mark = F.xxhash64("doc")
    holders = placed.groupBy("token").agg(
        F.bit_xor(mark).alias("set_a"),
        F.bit_xor(F.xxhash64(mark, F.lit(1))).alias("set_b"),
        F.min("root").alias("low"),
        F.max("root").alias("high"),
    )
    mixed = holders.filter("low < high").select("token", "set_a", "set_b")
    posted = (
        placed.join(mixed.hint("merge"), "token")
        .groupBy("set_a", "set_b", "doc")
        .agg(F.min("n").alias("n"), F.min("at").alias("at"), F.min("root").alias("root"))
    )
    left, right = (
        posted.select("set_a", "set_b", *[F.col(c).alias(f"{c}_{side}") for c in ("doc", "n", "at", "root")])
        for side in "uv"
    )
    rest = 1 + F.least(F.col("n_u") - F.col("at_u"), F.col("n_v") - F.col("at_v"))
    whole = F.col("n_u") + F.col("n_v")
    possible = (
        (F.col("doc_u") < F.col("doc_v"))
        & (F.col("root_u") != F.col("root_v"))
        & (F.least("n_u", "n_v") >= F.greatest("n_u", "n_v") * threshold - 1e-9)
        & (rest >= whole * (threshold / (1 + threshold)) - 1e-9)
    )
    same = (left["set_a"] == right["set_a"]) & (left["set_b"] == right["set_b"])
    pairs = left.hint("merge").join(right, same & possible)
    return pairs.select(F.col("doc_u").alias("u"), F.col("doc_v").alias("v")).distinct()


# --- components ---------------------------------------------------------------------


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``node``, ``root``: the smallest node of each connected component of ``u``, ``v``.

    Large-star and small-star rounds: every node hands its larger, then its smaller
    neighbours to its smallest one, until all edges lead to the root. Each round's edges
    are a written table; a node with many neighbours is only ever aggregated.
    """

    def tidy(df: DataFrame) -> DataFrame:
        return df.filter("u <> v").distinct()

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v") % (1 << 31))).first())

    now = scratch.keep(tidy(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))))
    before = state(now)
    while before[0]:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = tidy(both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        held = scratch.keep(large)
        low = held.groupBy("u").agg(F.min("v").alias("m"))
        small = held.join(low, "u")
        step = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        after_df = scratch.keep(tidy(step.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))))
        scratch.free(now, held)
        now, after = after_df, state(after_df)
        if after == before:
            break
        before = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


# --- the operator -------------------------------------------------------------------


def row_classes(
    texts: DataFrame,
    scratch: Scratch,
    size: int = SHINGLE,
    threshold: float = THRESHOLD,
    bands: int = BANDS,
    rows: int = ROWS,
) -> tuple[DataFrame, DataFrame]:
    """Classes of texts, whatever their ids are.

    ``texts`` has ``doc``, ``part`` (a hash of the text, to tell the texts of one id apart)
    and ``text``. Gives ``doc``, ``part``, ``root`` of every text with words, where equal
    roots are one class, and the signed rows (with ``n_shingles``), both as written tables.
    """
    signed = scratch.keep(texts.mapInArrow(_sign(size, bands, rows), _SIGNED))
    worded = signed.filter("n_shingles > 0")
    exact = ["digest_a", "digest_b"]
    # a node is a multiset of shingles; one of the texts that have it stands for it
    firsts = worded.groupBy(*exact).agg(F.min_by("part", "doc").alias("part"), F.min("doc").alias("doc"))
    reps = scratch.keep(firsts.withColumn("node", F.monotonically_increasing_id()))
    alike = scratch.keep(worded.join(reps.select(*exact, "node"), exact).select("doc", "part", "node").distinct())

    # one row per representative and band
    banded = worded.join(reps.select("doc", "part", "node"), ["doc", "part"])
    buckets = scratch.keep(
        banded.select(F.col("node").alias("doc"), F.col("n_shingles").alias("n"), F.explode("bands").alias("bucket"))
        .distinct()
    )
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1")
    joined = buckets.join(shared, "bucket")
    fullness = joined.groupBy("doc").agg(F.sum("size").alias("full"))
    tie = F.pmod(F.xxhash64("doc"), F.lit(1 << 20))
    crowded = scratch.keep(
        joined.join(fullness, "doc").select(
            "bucket", "doc", "n", "size", (F.col("full") * F.lit(1 << 20) + tie).alias("rank")
        )
    )
    scratch.free(buckets)
    # whole texts are moved once, and kept for those that share a bucket with another
    met = crowded.select(F.col("doc").alias("node")).distinct()
    wanted = reps.join(met, "node", "left_semi").select("doc", "part", "node")
    whole = texts.join(wanted.hint("merge"), ["doc", "part"]).select(F.col("node").alias("doc"), "text")
    again = signed.groupBy("doc", "part").count().filter("count > 1")
    held = scratch.keep(whole.dropDuplicates(["doc"]) if again.limit(1).count() else whole)
    scratch.free(reps)

    def linked(pairs: DataFrame) -> DataFrame:
        """The pairs of representatives that are as similar as asked."""
        a = held.select(F.col("doc").alias("u"), F.col("text").alias("text_u"))
        b = held.select(F.col("doc").alias("v"), F.col("text").alias("text_v"))
        both = pairs.select("u", "v").distinct().hint("merge").join(a, "u").hint("merge").join(b, "v")
        return scratch.keep(
            both.select("u", "v", "text_u", "text_v").mapInArrow(_verify(size, threshold), "u long, v long")
        )

    def sided(rows: DataFrame, side: str) -> DataFrame:
        names = {"doc": side, "n": f"n_{side}", "root": f"root_{side}"}
        return rows.select("bucket", *[F.col(c).alias(x) for c, x in names.items()])

    def led(rows: DataFrame) -> DataFrame:
        """Each member of another component with its bucket's leader, if sizes allow a link."""
        lead = rows.groupBy("bucket").agg(F.max_by("doc", "rank").alias("u"))
        heads = sided(rows.join(lead, "bucket").filter("doc = u").drop("u"), "u")
        return possible(sided(rows, "v").join(heads.distinct(), "bucket"))

    def possible(pairs: DataFrame) -> DataFrame:
        sizes = F.least("n_u", "n_v") >= F.greatest("n_u", "n_v") * threshold - 1e-9
        return pairs.filter((F.col("root_u") != F.col("root_v")) & sizes)

    def still_open(edges: DataFrame) -> DataFrame:
        """Rows of the buckets that hold several components, with ``first``: is it the leader's?"""
        roots = components(edges, scratch)
        placed = crowded.join(roots.withColumnRenamed("node", "doc"), "doc", "left").withColumn(
            "root", F.coalesce("root", "doc")
        )
        lead = placed.groupBy("bucket").agg(
            F.max_by("root", "rank").alias("main"), F.min("root").alias("low"), F.max("root").alias("high")
        )
        mixed = lead.filter("low < high").select("bucket", "main")
        return scratch.keep(placed.join(mixed, "bucket").withColumn("first", F.col("root") == F.col("main")))

    def more(edges: DataFrame, pairs: DataFrame) -> DataFrame:
        found = linked(pairs)
        grown = scratch.keep(edges.union(found))
        scratch.free(edges, found)
        return grown

    edges = linked(led(crowded.withColumn("root", F.col("doc"))))
    rest = still_open(edges)
    edges = more(edges, led(rest.filter(~F.col("first"))))
    scratch.free(rest)
    rest = still_open(edges)
    few = rest.filter(F.col("size") <= SMALL)
    apart = sided(few.filter(~F.col("first")), "u")
    direct = possible(sided(few, "v").join(apart, "bucket")).select(
        F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")
    )
    many = scratch.keep(rest.filter(F.col("size") > SMALL).select("doc", "root").distinct())
    rare = rare_pairs(held.join(many.hint("merge"), "doc", "left_semi"), many, size, threshold)
    edges = more(edges, direct.union(rare))
    scratch.free(rest, many, crowded, held)
    roots = components(edges, scratch)
    own = alike.join(roots, "node", "left").select("doc", "part", F.coalesce("root", "node").alias("root"))
    out = scratch.keep(own)
    scratch.free(alike, edges)
    return out, signed


def _parts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.lower(text_of(docs, text_col))
    return docs.select(
        quoted(id_col).cast("long").alias("doc"), F.xxhash64(text).alias("part"), text.alias("text")
    ).filter("doc IS NOT NULL")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings
) -> DataFrame:
    """One row per id: ``doc_id``, ``class_id`` (the smallest id that links lead to, itself if
    there is none) and ``n_shingles``.

    Texts are compared in lower case by words (letters and digits). A text of fewer words
    than ``size`` is one shingle; a text without words (NULL, empty) is in no class but
    its own. Very long texts are compared whole. Rows with a NULL id take no part. Rows
    with one id are one document: if their texts differ, it has the links of them all.
    Other columns are not read. ``settings`` are those of :func:`row_classes`.
    """
    ready(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "near")
    own, signed = row_classes(_parts(docs, id_col, text_col), scratch, **settings)
    # an id with several texts ties their classes together
    several = own.groupBy("doc").agg(F.min("root").alias("u"), F.max("root").alias("v")).filter("u < v")
    ties = own.join(several.select("doc", F.col("u").alias("to")), "doc")
    tied = components(ties.select(F.col("root").alias("u"), F.col("to").alias("v")), scratch)
    ends = own.join(
        tied.select(F.col("node").alias("root"), F.col("root").alias("end")), "root", "left"
    ).select("doc", F.coalesce("end", "root").alias("end")).distinct()
    ended = scratch.keep(ends)
    least = scratch.keep(ended.groupBy("end").agg(F.min("doc").alias("class_id")))
    classes = ended.join(least, "end").select("doc", "class_id")
    every = signed.groupBy("doc").agg(F.max("n_shingles").alias("n_shingles"))
    return every.join(classes, "doc", "left").select(
        F.col("doc").alias("doc_id"),
        F.coalesce("class_id", "doc").alias("class_id"),
        "n_shingles",
    )


def keep_one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings
) -> DataFrame:
    """``docs`` with one row of each class of texts, that of the smallest id.

    Rows are told apart by id and text, so of an id with unrelated texts each text stays
    unless it is a near copy of another row's. Rows that repeat id and text are one row,
    also where the text has no words; other texts without words and rows with a NULL id
    all stay.
    """
    ready(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "near")
    own, signed = row_classes(_parts(docs, id_col, text_col), scratch, **settings)
    scratch.free(signed)
    firsts = own.groupBy("root").agg(F.min_by("part", "doc").alias("kept_part"), F.min("doc").alias("kept"))
    first = (F.col("doc") == F.col("kept")) & (F.col("part") == F.col("kept_part"))
    doc, part, turn = fresh(docs, "doc", "part", "turn")
    firsts = scratch.keep(firsts)
    later = own.join(firsts, "root").filter(~first)
    gone = scratch.keep(later.select(F.col("doc").alias(doc), F.col("part").alias(part)).distinct())
    scratch.free(own, firsts)
    named = docs.withColumn(doc, quoted(id_col).cast("long")).withColumn(
        part, F.xxhash64(F.lower(text_of(docs, text_col)))
    )
    stay = named.join(gone.hint("merge"), [doc, part], "left_anti")
    order = Window.partitionBy(quoted(doc), quoted(part)).orderBy(F.xxhash64(text_of(docs, text_col)))
    ranked = stay.filter(quoted(doc).isNotNull()).withColumn(turn, F.row_number().over(order))
    columns = [quoted(c) for c in docs.columns]
    return ranked.filter(quoted(turn) == 1).select(*columns).unionByName(
        docs.filter(quoted(id_col).isNull()).select(*columns)
    )
