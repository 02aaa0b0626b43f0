"""What both vector searches share: rows that take part, and blocks of rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.common import quoted


def usable(vector: Column) -> Column:
    """Is the vector there, with finite components only?"""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def one_row_per_id(df: DataFrame, id_col: str, vector: Column) -> DataFrame:
    """``id``, ``vector`` of the rows with an id and a usable vector.

    Of several rows with one id the one with the smallest vector counts.
    """
    rows = df.select(quoted(id_col).cast("long").alias("id"), vector.alias("vector"))
    return rows.filter(F.col("id").isNotNull() & usable(F.col("vector"))).groupBy("id").agg(
        F.min("vector").alias("vector")
    )


def matrix(column: pa.ChunkedArray, width: int = 0, kind: type = np.float64) -> np.ndarray:
    """A list column as rows of a matrix; shorter rows are filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    size = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind)
    wide = max(int(size.max(initial=0)), width, 1)
    if len(size) and (size == wide).all():
        return flat.reshape(-1, wide)
    out = np.zeros((len(size), wide), kind)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def same_width(a: pa.ChunkedArray, b: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    one, two = matrix(a), matrix(b)
    wide = max(one.shape[1], two.shape[1])
    return tuple(np.pad(x, ((0, 0), (0, wide - x.shape[1]))) if x.shape[1] < wide else x for x in (one, two))


def best_of_rows(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Columns of the ``k`` best entries of each row, best first, ties to the smaller id."""
    k = min(k, score.shape[1])
    if k < score.shape[1]:
        # everything that can be among the best: above the kth value, or equal to it
        kth = np.partition(score, score.shape[1] - k, axis=1)[:, -k]
    else:
        kth = np.full(len(score), -np.inf)
    row, column = np.nonzero(score >= kth[:, None])
    order = np.lexsort((ids[column], -score[row, column], row))
    row, column = row[order], column[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    first = place < k
    return column[first].reshape(len(score), k)
