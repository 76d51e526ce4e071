"""Ranked lexical search: exact inner products by a sparse ball tree.

Items are sparse query vectors (a term's occurrences), documents sparse vectors of integer term
impacts; a score is their inner product. One map counts the terms of every whole text that some
item asks for (cut off with a checkpoint); a second one gathers the documents of a task in
blocks of bounded size and builds a ball tree over each. A node has the centroid ``c`` of its
documents and radii around it, one over all terms and one for each of ``SEGMENTS`` groups of
terms, so that for every document ``x`` below it::

    q.x <= q.c + min(|q| * r, sum over segments of |q_s| * r_s)

Radii and bounds are computed in doubles and rounded up by more than the error they can have
(``_SLACK``). A query goes through the tree best-first and stops at the first bound below its
kth score so far, which it carries on from block to block of a task; leaves are scored in 64-bit
integers. Only ``k`` rows per item and task are shuffled.

Rows: a null or termless text takes no part and counts in no statistic. Every document row is a
document of its own, repeated rows and ids included; a null ``doc_id`` ranks behind others of its
score. Repeated (item_id, text) rows are one item; rows that share an item_id but not the text are
items of their own. Items without terms, and any item if there are no documents, have no result.
Other columns are not looked at. Items are taken in blocks of about ``ITEM_BYTES`` of text, the
only thing besides their terms' counts that the driver holds.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellar.llm.common import cut

#: Weights of the score (fixed values of the contract): a term's saturation and the share of length.
SATURATION, LENGTH_SHARE = 8, 75
ITEM_BYTES = 1 << 20
#: A block of documents under one tree: so many documents or so many vector entries.
BLOCK_DOCS, BLOCK_ENTRIES = 4096, 1 << 20
LEAF_DOCS = 48
SEGMENTS = 512
#: Relative allowance for rounding in sums of up to ``BLOCK_ENTRIES`` doubles (2**20 * 2**-53 < 1.2e-10).
_SLACK = 1e-9
_PART = 1 << 20
#: Spread of the first of the two merging steps.
_SALTS = 64

#: Bytes of terms are kept (A-Z as a-z), all others end a term.
_TERM = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def term_counts(text: str | None) -> Counter:
    """Occurrences of each term of a text, as UTF-8 bytes; long texts go in parts."""
    data = (text or "").encode("utf-8").translate(_TERM)
    if len(data) <= _PART:
        return Counter(data.split())
    counts, begin = Counter(), 0
    while begin < len(data):
        end = begin + _PART
        if end < len(data):
            end = data.rfind(b" ", begin, end) + 1 or data.find(b" ", end) + 1 or len(data)
        counts.update(data[begin:end].split())
        begin = end
    return counts


# ---------------------------------------------------------------- documents as vectors


def vectors(docs: DataFrame, vocabulary: dict[bytes, int], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n, terms, counts): a document's length in terms and its counts of the vocabulary."""

    def run(batches):
        for batch in batches:
            lengths, sizes, terms, counts = [], [0], [], []
            for value in batch.column(1):
                found = term_counts(value.as_py())
                lengths.append(found.total())
                if len(found) > len(vocabulary):
                    hits = [(i, found[t]) for t, i in vocabulary.items() if t in found]
                else:
                    hits = [(vocabulary[t], c) for t, c in found.items() if t in vocabulary]
                terms.extend(i for i, _ in hits)
                counts.extend(c for _, c in hits)
                sizes.append(len(terms))
            at = pa.array(sizes, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lengths, pa.int64()), pa.ListArray.from_arrays(at, pa.array(terms, pa.int32())),
                 pa.ListArray.from_arrays(at, pa.array(counts, pa.int64()))], ["doc_id", "n", "terms", "counts"])

    src = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, n long, terms array<int>, counts array<long>")


def statistics(found: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """Documents with terms, all their terms, and the documents that hold each vocabulary term."""

    def run(batches):
        df, docs, length = np.zeros(size, np.int64), 0, 0
        for batch in batches:
            n = batch.column(0).to_numpy(zero_copy_only=False)
            docs += int((n > 0).sum())
            length += int(n.sum())
            df += np.bincount(batch.column(1).flatten().to_numpy(zero_copy_only=False), minlength=size)
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[-2, -1], some]).astype(np.int32)),
                                          pa.array(np.concatenate([[docs, length], df[some]]).astype(np.int64))],
                                         ["term", "c"])

    total = dict(found.select("n", "terms").mapInArrow(run, "term int, c long")
                 .groupBy("term").agg(F.sum("c")).collect())  # at most the vocabulary and two
    df = np.zeros(size, np.int64)
    for term, c in total.items():
        if term >= 0:
            df[term] = c
    return total.get(-2) or 0, total.get(-1) or 0, df


def weights(df: np.ndarray, docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


# ---------------------------------------------------------------- the tree


class BallTree:
    """Documents of a block as a tree of balls. ``row`` numbers the documents from zero."""

    def __init__(self, sizes: np.ndarray, column: np.ndarray, impact: np.ndarray, width: int, segment: np.ndarray):
        self.width, self.segment = width, segment
        self.segments = int(segment.max()) + 1 if len(segment) else 1
        self.children: list[tuple[int, int] | None] = []
        self.leaves: list[tuple | None] = []
        centroids, radii, spans = [], [], []
        todo = [(np.arange(len(sizes)), sizes, column, impact, -1)]
        while todo:
            rows, sizes, column, impact, parent = todo.pop()
            node = len(self.children)
            self.children.append(None)
            self.leaves.append(None)
            if parent >= 0:
                self.children[parent] = (self.children[parent] or ()) + (node,)
            x = impact.astype(float)
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            owner = np.repeat(np.arange(len(rows)), sizes)
            c = np.bincount(column, x, width) / len(rows)
            square, part = self._distances(owner, column, x, c, len(rows))
            norm = np.add.reduceat(x * x, starts).max() + c @ c
            centroids.append(c)
            radii.append(math.sqrt(max(0.0, square.max()) + _SLACK * norm))
            spans.append(np.sqrt(np.maximum(part.max(0), 0) + _SLACK * norm * (part.max(0) > 0)))
            if len(rows) <= LEAF_DOCS or square.max() <= _SLACK * norm:
                self.leaves[node] = (rows, starts, column, impact)
                continue
            # along the line between two far apart documents, half to either side
            far = self._dense(int(square.argmax()), starts, sizes, column, x)
            other = np.add.reduceat(x * x - 2 * x * far[column], starts)
            line = far - self._dense(int(other.argmax()), starts, sizes, column, x)
            order = np.argsort(np.add.reduceat(x * line[column], starts), kind="stable")
            left = np.zeros(len(rows), bool)
            left[order[:len(rows) // 2]] = True
            for side in (left, ~left):
                mine = side[owner]
                todo.append((rows[side], sizes[side], column[mine], impact[mine], node))
        self.centroids, self.radii, self.spans = np.array(centroids), np.array(radii), np.array(spans)

    def _distances(self, owner, column, x, c, n) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances to the centroid, overall and by segment."""
        gain = (x - c[column]) ** 2 - c[column] ** 2
        part = np.bincount(owner * self.segments + self.segment[column], gain, n * self.segments)
        part = part.reshape(n, self.segments) + np.bincount(self.segment, c * c, self.segments)
        return part.sum(1), part

    def _dense(self, row, starts, sizes, column, x) -> np.ndarray:
        out = np.zeros(self.width)
        at = slice(starts[row], starts[row] + sizes[row])
        out[column[at]] = x[at]
        return out

    def bounds(self, columns: np.ndarray, times: np.ndarray) -> np.ndarray:
        """Upper bounds of the scores below every node, for a query of distinct columns."""
        squares = np.bincount(self.segment[columns], times.astype(float) ** 2, self.segments)
        some = np.flatnonzero(squares)
        spread = self.spans[:, some] @ np.sqrt(squares[some])
        ball = self.radii * math.sqrt(squares.sum())
        middle = self.centroids[:, columns] @ times
        return (middle + np.minimum(ball, spread)) * (1 + _SLACK) + 1

    def search(self, columns: np.ndarray, times: np.ndarray, floor: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows and exact scores leaf by leaf, best bound first, while a bound reaches ``floor``,
        the least score of interest; send a new floor to raise it."""
        bound = self.bounds(columns, times)
        query = np.zeros(self.width, np.int64)
        query[columns] = times
        heap = [(-bound[0], 0)]
        while heap and -heap[0][0] >= floor:
            _, node = heappop(heap)
            if (leaf := self.leaves[node]) is not None:
                rows, starts, column, impact = leaf
                floor = (yield rows, np.add.reduceat(impact * query[column], starts)) or floor
            else:
                for child in self.children[node]:
                    heappush(heap, (-bound[child], child))


class Searcher:
    """The k best of the documents met so far, for every query."""

    def __init__(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int):
        self.queries, self.k = queries, k
        self.best: list[list[tuple]] = [[] for _ in queries]
        self.visited = self.scored = self.nodes = 0

    def add(self, ids: list, sizes: np.ndarray, terms: np.ndarray, impact: np.ndarray, rarity: np.ndarray) -> None:
        """Search a block; all sizes are positive. ``rarity`` orders terms into segments."""
        present = np.unique(terms)
        column = np.searchsorted(present, terms)
        # heavy terms are dealt to different segments
        segment = np.empty(len(present), np.int64)
        segment[np.argsort(-rarity[present], kind="stable")] = np.arange(len(present)) % SEGMENTS
        tree = BallTree(sizes, column, impact, len(present), segment)
        self.nodes += len(tree.leaves)
        for q, (asked, times) in enumerate(self.queries):
            at = np.searchsorted(present, asked)
            here = at < len(present)
            here[here] = present[at[here]] == asked[here]
            if not here.any():
                continue
            best = self.best[q]
            floor = -best[-1][0] if len(best) == self.k else 1
            walk = tree.search(at[here], times[here], floor)
            step = next(walk, None)
            while step is not None:
                rows, scores = step
                self.visited += 1
                self.scored += len(rows)
                good = np.flatnonzero(scores >= floor)
                if len(good):
                    best += [(-s, ids[r] is None, ids[r] or 0) for s, r in
                             zip(scores[good].tolist(), rows[good].tolist(), strict=True)]
                    best.sort()
                    del best[self.k:]
                    floor = -best[-1][0] if len(best) == self.k else 1
                try:
                    step = walk.send(floor)
                except StopIteration:
                    step = None


def _ranked(found: DataFrame, queries: list[tuple], weight: np.ndarray, docs: int, length: int, k: int) -> DataFrame:
    """(item_id, h, doc_id, score): the k best of every task."""
    plain = [(item, h, terms, times) for item, h, terms, times in queries]

    def run(batches):
        search = Searcher([(t, c) for _, _, t, c in plain], k)
        ids, sizes, terms, impacts, entries = [], [], [], [], 0

        def flush():
            nonlocal ids, sizes, terms, impacts, entries
            if ids:
                search.add(ids, np.concatenate(sizes), np.concatenate(terms), np.concatenate(impacts), weight)
            ids, sizes, terms, impacts, entries = [], [], [], [], 0

        def part(batch):
            nonlocal entries
            n = batch.column(1).to_numpy(zero_copy_only=False)
            size = batch.column(2).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            term = batch.column(2).flatten().to_numpy(zero_copy_only=False)
            tf = batch.column(3).flatten().to_numpy(zero_copy_only=False)
            m = 100 - LENGTH_SHARE + (LENGTH_SHARE * n * docs) // length
            ids.extend(batch.column(0).to_pylist())
            sizes.append(size)
            terms.append(term)
            impacts.append(weight[term] * ((1_000_000_000 * tf) // (1000 * tf + SATURATION * np.repeat(m, size))))
            entries += len(term)

        for batch in batches:
            # pieces of a batch that fit into what is left of the block
            size = np.cumsum(batch.column(2).value_lengths().to_numpy(zero_copy_only=False))
            begin = 0
            while begin < batch.num_rows:
                base = int(size[begin - 1]) if begin else 0
                end = int(np.searchsorted(size, base + BLOCK_ENTRIES - entries, side="right"))
                end = max(begin + 1, min(end, begin + BLOCK_DOCS - len(ids), batch.num_rows))
                part(batch.slice(begin, end - begin))
                begin = end
                if len(ids) >= BLOCK_DOCS or entries >= BLOCK_ENTRIES or begin < batch.num_rows:
                    flush()
        flush()
        rows = [(item, h, None if empty else doc, -s) for (item, h, _, _), best in zip(plain, search.best, strict=True)
                for s, empty, doc in best]
        for i in range(0, len(rows), 1 << 16):
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[j] for r in rows[i:i + (1 << 16)]], pa.int64()) for j in range(4)],
                ["item_id", "h", "doc_id", "score"])

    return found.where("size(terms) > 0").mapInArrow(run, "item_id long, h long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = 10, item_id: str = "item_id", item_text: str = "text",
           doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of every item, scores above zero."""
    spark = docs.sparkSession
    asked = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text"))
    asked = asked.where("text IS NOT NULL").distinct().withColumn("h", F.xxhash64("text"))
    bytes_ = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-bytes_ // ITEM_BYTES))
    results = []
    for block in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("item_id", "h"), F.lit(blocks)) == block).collect()
        counts = [(r["item_id"], r["h"], term_counts(r["text"])) for r in rows]
        vocabulary = {t: i for i, t in enumerate(sorted(set().union(*(c for *_, c in counts))))}
        if not vocabulary:
            continue
        queries = []
        for item, h, c in counts:
            terms = sorted((vocabulary[t], n) for t, n in c.items())
            queries.append((item, h, np.array([t for t, _ in terms], np.int64), np.array([n for _, n in terms], np.int64)))
        found = cut(vectors(docs, vocabulary, doc_id, text))
        n, length, df = statistics(found, len(vocabulary))
        if n:
            results.append(_ranked(found, [q for q in queries if len(q[2])], weights(df, n), n, length, k))
    if not results:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    best = reduce(DataFrame.union, results)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    # two steps, so that no task meets the rows of all tasks at once
    for keys in (["item_id", "h", "salt"], ["item_id", "h"]):
        if "salt" in keys:
            best = best.withColumn("salt", F.pmod(F.xxhash64("doc_id", "score"), F.lit(_SALTS)))
        best = best.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(
            F.col("rank") <= k)
    return best.select("item_id", "rank", "doc_id", "score")


def digest(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    return search(documents, benchmark)


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: The same over whole tables in DuckDB.
ORACLE_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{_PATTERN}') AS t
  FROM documents WHERE text IS NOT NULL
), s AS (
  SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(t)) AS BIGINT) AS n_terms FROM d WHERE len(t) > 0
), tf AS (
  SELECT r, doc_id, len(t) AS n, term, CAST(count(*) AS BIGINT) AS tf
  FROM (SELECT r, doc_id, t, unnest(t) AS term FROM d) GROUP BY ALL
), w AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), s
), q AS (
  SELECT item_id, text, term, CAST(count(*) AS BIGINT) AS times
  FROM (SELECT item_id, text, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{_PATTERN}')) AS term
        FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY ALL
), p AS (
  SELECT item_id, text, r, doc_id, CAST(sum(times * w * ((1000000000 * tf)
           // (1000 * tf + 8 * (100 - 75 + (75 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN w USING (term), s GROUP BY ALL
), k AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
  FROM p WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 10
"""
