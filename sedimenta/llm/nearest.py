"""Approximate nearest neighbours by cosine: balanced posting lists.

Centroids are fitted to a bounded sample with a penalty on size, so that lists are
balanced. Every row is indexed: its nearest centroids are found by walking a graph over
the centroids that each task holds in memory; a row on a boundary (another centroid is
hardly further off than the nearest) is written to several lists. A query walks the same
graph and reads the lists whose distance is within a ratio of the nearest one's. The
ratio is measured on the sample for a recall wanted there. Lists are read in pieces of
bounded size, and scores are worked out on the original vectors in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sedimenta.llm.common import Scratch, quoted, ready
from sedimenta.llm.vectors import matrix, one_row_per_id, same_width

#: Rows (those with the smallest id hashes) that the centroids are fitted to, at most.
SAMPLE = 8192
#: Lists at most, and rows of a list aimed at while there are fewer.
LISTS, LIST_ROWS = 1024, 256
#: Rows of a list, and queries for it, that one task handles.
PIECE = 4096
#: A row goes to at most so many lists, those within this ratio of its nearest centroid.
COPIES, BOUNDARY = 4, 1.05


@dataclass(frozen=True)
class Index:
    """Unit centroids, a graph over them, and the ratio for queries."""

    centroids: np.ndarray
    neighbours: np.ndarray
    entries: np.ndarray
    ratio: float

    def near(self, rows: np.ndarray, least: int, ratio: float) -> np.ndarray:
        """Distance of each row to the centroids the walk has seen, infinite for others.

        From the entries on, the nearest node not yet expanded is expanded, as long as it
        is within ``ratio`` of the nearest or among the ``least`` nearest seen.
        """
        n, k = len(rows), len(self.centroids)
        far = np.full((n, k), np.inf)
        far[:, self.entries] = _distance(rows @ self.centroids[self.entries].T)
        open_ = np.where(np.isfinite(far), far, np.inf)
        active = np.arange(n)
        least = min(least, k)
        while len(active):
            node = open_[active].argmin(axis=1)
            at = open_[active, node]
            seen = far[active]
            limit = np.maximum(seen.min(axis=1) * ratio, np.partition(seen, least - 1, axis=1)[:, least - 1])
            go = np.isfinite(at) & (at <= limit)
            active, node = active[go], node[go]
            if not len(active):
                break
            open_[active, node] = np.inf
            more = self.neighbours[node]
            value = _distance(np.einsum("ijk,ik->ij", self.centroids[more], rows[active]))
            new = np.isinf(far[active[:, None], more])
            a, b = np.nonzero(new)
            far[active[a], more[a, b]] = value[a, b]
            open_[active[a], more[a, b]] = value[a, b]
        return far


def _distance(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2.0 - 2.0 * cosine, 0.0))


def unit(rows: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(norm > 0, norm, 1.0)


def _balanced_centroids(rows: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """Spherical k-means in which a centroid that holds many rows looks further away."""
    centroids = rows[np.linspace(0, len(rows) - 1, k).astype(int)].copy()
    penalty = np.zeros(k)
    for _ in range(rounds):
        own = (rows @ centroids.T - penalty).argmax(axis=1)
        size = np.bincount(own, minlength=k)
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, rows)
        norm = np.linalg.norm(sums, axis=1)
        some = norm > 0
        centroids[some] = sums[some] / norm[some, None]
        penalty = 0.5 * penalty + 0.02 * (size * k / len(rows) - 1)
    return centroids


def _lists_of(far: np.ndarray) -> np.ndarray:
    """Which lists a row is written to, by its distances: the nearest and its boundary."""
    nearest = np.argsort(far, axis=1, kind="stable")[:, :COPIES]
    value = np.take_along_axis(far, nearest, axis=1)
    out = np.zeros(far.shape, bool)
    np.put_along_axis(out, nearest, value <= value[:, :1] * BOUNDARY, axis=1)
    return out


def fit_index(sample: np.ndarray, n_rows: int, k: int, recall: float = 0.97) -> Index:
    """An index for ``n_rows`` rows from unit rows of a sample."""
    lists = int(max(1, min(LISTS, n_rows // LIST_ROWS, len(sample) // 8)))
    centroids = _balanced_centroids(sample, lists)
    degree = min(lists, 16)
    alike = centroids @ centroids.T
    neighbours = np.argsort(-alike, axis=1, kind="stable")[:, :degree]
    # a ring through all nodes keeps the graph connected
    ring = np.stack([np.roll(np.arange(lists), 1), np.roll(np.arange(lists), -1)], axis=1)
    neighbours = np.concatenate([neighbours, ring], axis=1)
    entries = np.unique(np.linspace(0, lists - 1, max(1, int(lists**0.5))).astype(int))
    index = Index(centroids, neighbours, entries, np.inf)
    far = _distance(sample @ centroids.T)
    held = _lists_of(far)
    asked = np.linspace(0, len(sample) - 1, min(512, len(sample))).astype(int)
    score = sample[asked] @ sample.T
    score[np.arange(len(asked)), asked] = -np.inf
    true = np.argsort(-score, axis=1)[:, : min(k, len(sample) - 1)]
    needed = [
        np.where(held[t], far[q][None, :], np.inf).min(axis=1) / max(far[q].min(), 1e-12)
        for q, t in zip(asked, true, strict=True)
    ]
    flat = np.concatenate(needed) if needed else np.ones(1)
    ratio = float(np.quantile(flat, recall)) if len(flat) else 1.0
    return Index(centroids, neighbours, entries, max(ratio, 1.0))


def _assign(index: Index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = unit(matrix(batch.column(1), index.centroids.shape[1])[:, : index.centroids.shape[1]])
            held = _lists_of(index.near(rows, 2 * COPIES, BOUNDARY))
            row, list_ = np.nonzero(held)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row)), pa.array(list_.astype(np.int32))],
                names=["id", "vector", "list"],
            )

    return run


def _probe(index: Index, rows_of: np.ndarray, k: int):
    """Lists each query reads: within the ratio, and as many as hold k rows for certain."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = unit(matrix(batch.column(1), index.centroids.shape[1])[:, : index.centroids.shape[1]])
            far = index.near(rows, 8, index.ratio)
            order = np.argsort(far, axis=1, kind="stable")
            value = np.take_along_axis(far, order, axis=1)
            before = np.cumsum(rows_of[order], axis=1) - rows_of[order]
            take = (value <= value[:, :1] * index.ratio) | (before < COPIES * (k + 1))
            row, place = np.nonzero(take)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row)),
                    batch.column(1).take(pa.array(row)),
                    pa.array(order[row, place].astype(np.int32)),
                ],
                names=["id", "vector", "list"],
            )

    return run


def cosines(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Cosine of each pair of rows; the same numbers for the same vectors, wherever they stand."""
    dot = np.einsum("ij,ij->i", query, rows)
    return dot / (np.sqrt(np.einsum("ij,ij->i", query, query)) * np.sqrt(np.einsum("ij,ij->i", rows, rows)))


def _search(k: int):
    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        none = pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())], names=names)
        if not queries.num_rows or not rows.num_rows:
            return none
        q, x = same_width(queries["vector"], rows["vector"])
        ids, asked = rows["id"].to_numpy(), queries["id"].to_numpy()
        rough = unit(q) @ unit(x).T
        rough[asked[:, None] == ids[None, :]] = -np.inf
        kth = np.partition(rough, max(rough.shape[1] - k, 0), axis=1)[:, max(rough.shape[1] - k, 0)]
        # whatever rounding could bring among the best is scored anew
        out = []
        for first in range(0, len(q), 256):
            part = rough[first : first + 256]
            row, column = np.nonzero((part >= kth[first : first + 256, None] - 1e-9) & np.isfinite(part))
            for a in range(0, max(len(row), 1), 1 << 18):
                r, c = row[a : a + (1 << 18)], column[a : a + (1 << 18)]
                out.append((r + first, ids[c], cosines(q[first + r], x[c])))
        row, near, score = (np.concatenate(z) for z in zip(*out, strict=True))
        order = np.lexsort((near, -score, row))
        row, near, score = row[order], near[order], score[order]
        top = np.arange(len(row)) - np.searchsorted(row, row) < k
        return pa.table([pa.array(asked[row[top]]), pa.array(near[top]), pa.array(score[top])], names=names)

    return run


def nearest(
    df: DataFrame,
    query: Column,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    recall: float = 0.97,
) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id``, ``score`` (cosine): the ``k`` nearest rows
    found for every row for which ``query`` holds, among all rows with another id, nearest
    first, ties to the smaller id. With ``k`` other rows or more, every query gets ``k``.

    Vectors that are NULL, zero or hold NULL or non-finite components take no part, nor
    do NULL ids; of rows with one id the smallest vector counts. Shorter vectors are
    filled up with zeros. Other columns are not read. ``recall`` is what the ratio is
    chosen for on the sample of at most ``SAMPLE`` rows.
    """
    spark = df.sparkSession
    ready(spark)
    scratch = Scratch(spark, "nearest")
    vector = F.transform(quoted(vector_col), lambda x: x.cast("double"))
    rows = scratch.keep(
        one_row_per_id(df, id_col, vector).filter(F.exists("vector", lambda x: x != 0.0))
    )
    n = rows.count()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).toArrow()
    index = fit_index(unit(matrix(sample["vector"])), n, k, recall)
    posted = scratch.keep(rows.mapInArrow(_assign(index), "id long, vector array<double>, list int"))
    sizes = {r[0]: r[1] for r in posted.groupBy("list").count().collect()}
    rows_of = np.array([sizes.get(i, 0) for i in range(len(index.centroids))])
    asked = df.filter(query).select(quoted(id_col).cast("long").alias("id")).distinct()
    probes = scratch.keep(
        rows.join(asked, "id", "left_semi").mapInArrow(
            _probe(index, rows_of, k), "id long, vector array<double>, list int"
        )
    )
    wanted = {r[0]: r[1] for r in probes.groupBy("list").count().collect()}
    # lists and their queries in pieces; the table has a row per list, so LISTS at most
    pieces = spark.createDataFrame(
        [(i, -(-int(rows_of[i]) // PIECE) or 1, -(-wanted.get(i, 0) // PIECE) or 1) for i in range(len(rows_of))],
        "list int, row_pieces int, query_pieces int",
    )

    def dealt(count: str) -> Column:
        return F.pmod(F.xxhash64("id"), F.col(count)).cast("int")

    def all_of(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    left = probes.join(F.broadcast(pieces), "list").select(
        "id", "vector", "list", dealt("query_pieces").alias("q"), all_of("row_pieces").alias("p")
    )
    right = posted.join(F.broadcast(pieces), "list").select(
        "id", "vector", "list", all_of("query_pieces").alias("q"), dealt("row_pieces").alias("p")
    )
    key = ["list", "q", "p"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(
        _search(k), "query_id long, vec_id long, score double"
    )
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        once.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
