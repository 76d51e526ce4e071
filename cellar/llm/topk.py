"""Exact top-k inner products by the Fagin threshold algorithm.

Candidates and queries are dealt to blocks by id hashes; every pair of a candidate block and a
query block is one task of bounded size. In a task each dimension has its list of candidates
sorted by value. A query reads its lists from their better end in growing steps, scores every
candidate it meets in full, and stops when the bound for all unread ones (the sum of the lists'
next values, times the query) is below its kth result. The best of the blocks are merged.

Components become ``floor(scale * x)``; scores are integers. Vectors that are null or hold null
or non-finite components, and rows without an id, take no part; only vectors of equal length are
compared. Identical rows count once. Scores beyond 2**53 lose exactness in no case: such blocks
are computed with Python integers and saturate at the bounds of a long.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CANDIDATE_BLOCK = 8192
QUERY_BLOCK = 2048
FIRST_STEP = 64


def integer_vector(vector: Column, scale: int) -> Column:
    """``floor(scale * x)`` of every component; null for vectors that take no part."""
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(usable, F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long")))


class Lists:
    """Candidates of a block with a sorted list per dimension."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.order = np.argsort(vectors, axis=0, kind="stable").T.copy()
        self.sorted = np.take_along_axis(vectors, self.order.T, 0).T.copy()

    def best(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best but ``own``, ties to the smaller id."""
        n = len(self.ids)
        up, down = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
        unread = np.ones(n, bool)
        ids, scores = self.ids[:0], self.vectors[:0, :0].sum(1)
        begin, step = 0, FIRST_STEP
        while unread.any():
            end = min(begin + step, n)
            met = np.zeros(n, bool)
            met[self.order[up, n - end:n - begin]] = True
            met[self.order[down, begin:end]] = True
            if end == n:
                # every list is read to its end (or the query is zero)
                met[:] = True
            met &= unread
            unread &= ~met
            new = np.flatnonzero(met)
            got = (self.vectors @ query)[new] if 2 * len(new) > n else self.vectors[new] @ query
            at = self.ids[new]
            keep = at != own
            if len(ids) == k:
                keep &= got >= scores[-1]
            ids, scores = np.concatenate([ids, at[keep]]), np.concatenate([scores, got[keep]])
            top = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[top], scores[top]
            if end < n and len(ids) == k:
                bound = query[up] @ self.sorted[up, n - end - 1] + query[down] @ self.sorted[down, end]
                if bound < scores[-1]:
                    break
            begin, step = end, step * 2
        return ids, scores


def _arrays(rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, vectors and vector hashes of a group, identical rows once."""
    ids = rows.column("vec_id").to_numpy()
    hashes = rows.column("h").to_numpy()
    flat = rows.column("v").combine_chunks().flatten().to_numpy()
    vectors = flat.reshape(len(ids), -1)
    order = np.lexsort((hashes, ids))
    ids, hashes, vectors = ids[order], hashes[order], vectors[order]
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (hashes[1:] != hashes[:-1])
    return ids[new], vectors[new], hashes[new]


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: int = 64,
          vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows for every query row."""
    rows = (vectors.select(F.col(vec_id).cast("long").alias("vec_id"), integer_vector(F.col(vector), scale).alias("v"),
                           is_query.alias("is_query"))
            .where("vec_id IS NOT NULL AND v IS NOT NULL").withColumn("dim", F.size("v"))
            .withColumn("h", F.xxhash64("v")))
    n, asking = rows.agg(F.count(F.lit(1)), F.count_if("is_query")).first()
    by_candidate, by_query = max(1, -(-n // CANDIDATE_BLOCK)), max(1, -(-asking // QUERY_BLOCK))

    def dealt(df: DataFrame, own: str, own_blocks: int, other: str, other_blocks: int) -> DataFrame:
        return df.select("vec_id", "v", "h", "dim", F.pmod(F.xxhash64("vec_id"), F.lit(own_blocks)).alias(own),
                         F.explode(F.sequence(F.lit(0).cast("long"), F.lit(other_blocks - 1).cast("long"))).alias(other))

    candidates = dealt(rows, "c", by_candidate, "q", by_query)
    queries = dealt(rows.where("is_query"), "q", by_query, "c", by_candidate)
    names = ["query_id", "h", "vec_id", "score"]

    def run(key, left, right):
        out = {name: [np.zeros(0, np.int64)] for name in names}
        if left.num_rows and right.num_rows:
            ids, x, _ = _arrays(left)
            asked, y, hashes = _arrays(right)
            bound = float(np.abs(x.astype(float)).max(initial=0)) * float(np.abs(y.astype(float)).max(initial=0))
            exact = bound * max(1, x.shape[1]) < 2.0 ** 53
            # whole numbers below 2**53 are exact as doubles, which multiply faster
            x, y = (x.astype(float), y.astype(float)) if exact else (x.astype(object), y.astype(object))
            lists = Lists(ids, x)
            for query, h, own in zip(y, hashes.tolist(), asked.tolist(), strict=True):
                found, scores = lists.best(query, own, k)
                if not exact:
                    scores = np.array([min(max(int(s), -(1 << 63)), (1 << 63) - 1) for s in scores], np.int64)
                out["query_id"].append(np.full(len(found), own))
                out["h"].append(np.full(len(found), h))
                out["vec_id"].append(found)
                out["score"].append(scores.astype(np.int64))
        return pa.table({name: np.concatenate(out[name]).astype(np.int64) for name in names})

    best = candidates.groupBy("dim", "c", "q").cogroup(queries.groupBy("dim", "c", "q")).applyInArrow(
        run, "query_id long, h long, vec_id long, score long")
    order = Window.partitionBy("query_id", "h").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def digest(embeddings: DataFrame) -> DataFrame:
    return top_k(embeddings, F.col("vec_id") % 20 == 0)


#: The same over whole tables in DuckDB.
ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_dot_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
