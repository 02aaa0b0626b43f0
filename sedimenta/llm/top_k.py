"""Exact top-k search by inner product: the threshold algorithm over sorted lists.

Vectors are dealt into blocks, queries into groups, and each pair of a group and a block
is one task's work of bounded size. In a block every dimension has its sorted list, read
from the top for queries with a positive weight there and from the bottom for negative
ones. All queries of the group read in step: rows are scored in the order in which any
list brings them up. At every depth the largest score that an unseen row can have is the
sum over dimensions of weight times the list's value at that depth; a query whose kth
score is larger stops.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sedimenta.llm.common import Scratch, quoted, ready
from sedimenta.llm.vectors import best_of_rows, one_row_per_id, same_width, usable

#: Rows of a block and queries of a group at most, on average.
BLOCK, GROUP = 8192, 2048
#: Rows that are scored between two looks at the threshold.
STEP = 512
#: Doubles hold all whole numbers below this.
EXACT = 2**53


def threshold_search(
    rows: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Query, row id and score of each query's ``k`` best rows with another id, and how
    many scores were worked out. Whole numbers below 2**53 give exact scores."""
    n = len(rows)
    by_value = np.sort(rows, axis=0)
    rank = np.argsort(np.argsort(rows, axis=0, kind="stable"), axis=0, kind="stable")
    depth = np.minimum(rank, n - 1 - rank).min(axis=1)
    order = np.lexsort((ids, depth))
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    active = np.arange(len(queries))
    best_score = np.full((len(queries), k), -np.inf)
    best_id = np.full((len(queries), k), np.iinfo(np.int64).max)
    worked = 0
    for first in range(0, n, STEP):
        part = order[first : first + STEP]
        score = queries[active] @ rows[part].T
        worked += score.size
        score[query_ids[active][:, None] == ids[part][None, :]] = -np.inf
        top = best_of_rows(score, ids[part], k)
        line = np.arange(len(active))[:, None]
        merged = np.concatenate([best_score[active], score[line, top]], axis=1)
        merged_id = np.concatenate([best_id[active], ids[part][top]], axis=1)
        pick = np.lexsort((merged_id, -merged), axis=1)[:, :k]
        best_score[active], best_id[active] = merged[line, pick], merged_id[line, pick]
        if first + STEP >= n:
            break
        # what is still unseen lies at least so deep in every list
        deep = depth[order[first + STEP]]
        limit = up[active] @ by_value[n - 1 - deep] + down[active] @ by_value[deep]
        active = active[~(best_score[active, -1] > limit)]
        if not len(active):
            break
    query, place = np.nonzero(best_score > -np.inf)
    return query_ids[query], best_id[query, place], best_score[query, place], worked


def _search(k: int):
    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        if not queries.num_rows or not rows.num_rows:
            return pa.table([pa.array([], pa.int64())] * 3, names=names)
        q, x = same_width(queries["vector"], rows["vector"])
        if np.abs(q).sum(axis=1).max() * np.abs(x).max(initial=0) >= EXACT:
            raise ValueError("inner products of 2**53 or more would not be exact: use a smaller scale")
        found = threshold_search(x, rows["id"].to_numpy(), q, queries["id"].to_numpy(), k)
        return pa.table([pa.array(found[0]), pa.array(found[1]), pa.array(found[2].astype(np.int64))], names=names)

    return run


def whole_components(vector: Column, scale: float) -> Column:
    """Each component x as the whole number floor(scale * x), x as double; one that doubles
    do not hold exactly fails the job."""

    def whole(x: Column) -> Column:
        value = x.cast("double") * scale
        message = F.concat(F.lit("a component is too large to be scored exactly: "), x.cast("string"))
        return F.when(F.abs(value) >= EXACT, F.raise_error(message).cast("long")).otherwise(F.floor(value).cast("long"))

    return F.transform(vector, whole)


def top_k(
    df: DataFrame,
    query: Column,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: float = 64.0,
) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id``, ``score``: the ``k`` rows with the largest
    inner product (all, if fewer) of every row for which ``query`` holds, among all rows
    with another id; ties go to the smaller id.

    Vectors that are NULL or hold NULL or non-finite components take no part, nor do NULL
    ids; of rows with one id the smallest vector counts. Shorter vectors are filled up
    with zeros, so an empty one scores 0. Scores are exact: where a component, or the
    products of a block, could reach 2**53 the job fails. Other columns are not read.
    """
    spark = df.sparkSession
    ready(spark)
    vector = F.when(usable(quoted(vector_col)), whole_components(quoted(vector_col), scale))
    scratch = Scratch(spark, "topk")
    rows = scratch.keep(one_row_per_id(df, id_col, vector))
    asked = df.filter(query).select(quoted(id_col).cast("long").alias("id")).distinct()
    queries = scratch.keep(rows.join(asked, "id", "left_semi"))
    n, n_queries = rows.count(), queries.count()
    tasks = 2 * spark.sparkContext.defaultParallelism
    blocks = max(-(-n // BLOCK), min(tasks, -(-n // 1024)), 1)
    groups = max(-(-n_queries // GROUP), 1)

    def dealt(count: int) -> Column:
        return F.pmod(F.xxhash64("id"), F.lit(count)).cast("int")

    left = queries.select(
        "id", "vector", dealt(groups).alias("q"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("b")
    )
    right = rows.select(
        "id", "vector", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("q"), dealt(blocks).alias("b")
    )
    found = left.groupBy("q", "b").cogroup(right.groupBy("q", "b")).applyInArrow(
        _search(k), "query_id long, vec_id long, score long"
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


#: The same in DuckDB's SQL; every pair is scored.
SQL = """
WITH v AS (
  SELECT vec_id, [CAST(floor(CAST(x AS DOUBLE) * {scale}) AS BIGINT) FOR x IN embedding] AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_dot_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id
  WHERE q.vec_id % {every} = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {k}
"""
