"""Stupid-backoff scores of every text under n-gram counts of the whole corpus.

N-grams are known by hashes whose leading bits name a bucket; a bucket holds its part of
the count tables. Texts are dealt into chunks. A chunk asks every bucket once for each
different n-gram it holds and gives its own count, so frequent words and phrases cost one
entry per chunk; the bucket adds the counts up and answers in the order it was asked in.
The chunk joins the answers back to its n-grams and sums the scores per document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.common import Scratch, mix, quoted, ready, text_of, utf8, word_hashes

ORDER = 3
#: What each step to a shorter context costs.
BACKOFF = 0.4
#: N-grams seen more rarely are not in the tables.
MIN_COUNT = 2
#: Bytes of text of a chunk, and different n-grams of a bucket, aimed at.
CHUNK_BYTES, BUCKET_KEYS = 8 << 20, 1 << 20
#: Bits that tell n-grams of one bucket apart.
KEY_BITS = 40

_STEP = np.uint64(0x9E3779B97F4A7C15)


def ngram_keys(words: np.ndarray, bounds: np.ndarray, order: int, bucket_bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each length from 1 to ``order``: where n-grams end in ``words``, and their keys."""
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    place = np.arange(len(words)) - bounds[text]
    out, value = [], words
    for n in range(1, order + 1):
        if n > 1:
            value = np.concatenate([np.zeros(1, np.uint64), value[:-1]])
            value = mix(value * np.uint64(2 * n + 1) + words + _STEP)
        at = np.flatnonzero(place >= n - 1)
        out.append((at, mix(value[at] + np.uint64(n)) >> np.uint64(64 - KEY_BITS - bucket_bits)))
    return out


def pack(values: np.ndarray, width: int) -> bytes:
    """Numbers as ``width`` runs of bytes, lowest first: equal high bytes compress away."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def unpack(data: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view("<u8").ravel()


_ASKED = "n int, bucket int, chunk int, keys binary, counts binary"
_ANSWERED = "n int, bucket int, chunk int, counts binary"
_SCORED = "doc long, n_words long, log2_sum double, n_unigram long"


def _texts(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    return word_hashes(*utf8(table["text"]))


def _ask(order: int, bucket_bits: int):
    def run(table: pa.Table) -> pa.Table:
        chunk = table["chunk"][0].as_py()
        rows: list[tuple] = []
        for n, (_, keys) in enumerate(ngram_keys(*_texts(table), order, bucket_bits), 1):
            keys, counts = np.unique(keys, return_counts=True)
            bucket = (keys >> np.uint64(KEY_BITS)).astype(np.int64)
            ends = np.searchsorted(bucket, np.arange((1 << bucket_bits) + 1))
            for b in np.flatnonzero(np.diff(ends)):
                part = slice(ends[b], ends[b + 1])
                rows.append((n, int(b), chunk, pack(keys[part], KEY_BITS // 8), pack(counts[part], 5)))
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        kinds = [pa.int32()] * 3 + [pa.binary()] * 2
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["n", "bucket", "chunk", "keys", "counts"])

    return run


def _answer(table: pa.Table) -> pa.Table:
    """Counts over all chunks, for each chunk in the order of its keys."""
    keys = [unpack(x, KEY_BITS // 8) for x in table["keys"].to_pylist()]
    counts = [unpack(x, 5) for x in table["counts"].to_pylist()]
    _, place = np.unique(np.concatenate(keys), return_inverse=True)
    # whole numbers below 2**53 add up exactly
    total = np.bincount(place, np.concatenate(counts).astype(np.float64)).astype(np.uint64)
    answers = np.split(total[place], np.cumsum([len(k) for k in keys])[:-1])
    return table.select(["n", "bucket", "chunk"]).append_column(
        "counts", pa.array([pack(a, 5) for a in answers], pa.binary())
    )


def backoff_scores(
    counts: list[tuple[np.ndarray, np.ndarray]], size: int, min_count: int, backoff: float
) -> tuple[np.ndarray, np.ndarray]:
    """For each word: log2 of its score, where one for the corpus size is still to be taken
    off if the second result is true. ``counts`` has, by length, where n-grams end and how
    often they occur."""
    full = []
    for at, count in counts:
        whole = np.zeros(size, np.float64)
        whole[at] = count
        full.append(whole)
    score = np.zeros(size)
    open_ = np.ones(size, bool)
    longest = np.zeros(size, np.int64)
    for at, _ in counts:
        longest[at] += 1
    for n in range(len(counts), 1, -1):
        seen = open_ & (full[n - 1] >= min_count)
        i = np.flatnonzero(seen)
        # the context is the n - 1 words that end one word earlier
        score[i] = np.log2(full[n - 1][i] / full[n - 2][i - 1]) + np.log2(backoff) * (longest[i] - n)
        open_ &= ~seen
    i = np.flatnonzero(open_)
    score[i] = np.log2(full[0][i]) + np.log2(backoff) * (longest[i] - 1)
    return score, open_


def _score(order: int, bucket_bits: int, min_count: int, backoff: float):
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        names = ["doc", "n_words", "log2_sum", "n_unigram"]
        words, bounds = _texts(table)
        answers = answers.sort_by([("n", "ascending"), ("bucket", "ascending")])
        lengths = answers["n"].to_numpy()
        blobs = answers["counts"]
        counts = []
        for n, (at, keys) in enumerate(ngram_keys(words, bounds, order, bucket_bits), 1):
            low, high = np.searchsorted(lengths, [n, n + 1])
            known = [unpack(x, 5) for x in blobs.slice(low, high - low).to_pylist()]
            total = np.concatenate(known) if known else np.zeros(0, np.uint64)
            _, place = np.unique(keys, return_inverse=True)
            counts.append((at, total[place]))
        score, rest = backoff_scores(counts, len(words), min_count, backoff)
        text = np.repeat(np.arange(table.num_rows), np.diff(bounds))
        return pa.table(
            [
                table["doc"],
                pa.array(np.diff(bounds)),
                pa.array(np.bincount(text, score, table.num_rows).astype(np.float64)),
                pa.array(np.bincount(text, rest, table.num_rows).astype(np.int64)),
            ],
            names=names,
        )

    return run


def score_texts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    order: int = ORDER,
    min_count: int = MIN_COUNT,
    backoff: float = BACKOFF,
) -> DataFrame:
    """One row per row of ``docs``: its id as ``doc_id``, ``n_words``, ``log2_score`` (mean
    over its words of the binary logarithm of the stupid-backoff score) and ``perplexity``.

    The score of a word after its context is the n-gram's count over its context's count,
    if the n-gram occurs ``min_count`` times or more; else ``backoff`` times the score with
    a context shorter by one word; in the end its count over all words. Contexts do not
    reach over the beginning of a text. Counts are of all texts, in lower case, of words of
    letters and digits. A text without words (NULL, empty) has NULL for both scores. NULL
    ids and repeated rows are scored like others; other columns are not read. A text is scored
    whole, in one task, however long it is. Two n-grams
    of one bucket share a count if 40 bits of their hashes agree: a few in a million.
    """
    spark = docs.sparkSession
    ready(spark)
    scratch = Scratch(spark, "lm")
    text = F.lower(text_of(docs, text_col))
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    chunks = max(-(-size // CHUNK_BYTES), min(2 * spark.sparkContext.defaultParallelism, -(-size // (1 << 16))), 1)
    bucket_bits = max(int(size / 6 / BUCKET_KEYS), spark.sparkContext.defaultParallelism).bit_length()
    bucket_bits = min(bucket_bits, 64 - KEY_BITS)
    dealt = docs.select(
        quoted(id_col).cast("long").alias("doc"),
        text.alias("text"),
        F.pmod(F.xxhash64(quoted(id_col), quoted(text_col)), F.lit(chunks)).cast("int").alias("chunk"),
    )
    asked = dealt.groupBy("chunk").applyInArrow(_ask(order, bucket_bits), _ASKED)
    answers = scratch.keep(asked.groupBy("n", "bucket").applyInArrow(_answer, _ANSWERED))
    scratch.settle()
    scored = scratch.keep(
        dealt.groupBy("chunk")
        .cogroup(answers.groupBy("chunk"))
        .applyInArrow(_score(order, bucket_bits, min_count, backoff), _SCORED)
    )
    scratch.free(answers)
    words = scored.agg(F.sum("n_words")).first()[0] or 0
    whole = float(np.log2(words)) if words else 0.0
    mean = F.when(F.col("n_words") > 0, (F.col("log2_sum") - F.col("n_unigram") * whole) / F.col("n_words"))
    return scored.select(
        F.col("doc").alias("doc_id"), "n_words", mean.alias("log2_score"), F.pow(F.lit(2.0), -mean).alias("perplexity")
    )
