"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. Its features are measures of its bytes and words (case, symbols,
punctuation, digits, repeated words, separators, lengths), each cut into bins, of the line itself
and of the lines before and after. Forward-backward gives each line's marginal probability of
being good; weighted by line length they add up to the document's score (0 to 1).

Training: the lines of a labelled document carry its label. The fit uses a bounded sample: the
``SAMPLE_DOCS`` labelled documents with the smallest id hashes, ``SAMPLE_LINES`` lines of each at
most (both parameters); scoring reads whole texts. Labels, language, source and id never enter a
score. Conflicting labels of a document count as the smaller; without labels of both classes
every score is the share of label 1 (0.5 without any).

A null text counts as empty, which is one empty line. Repeated rows give repeated results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellar.operators.ordinal import fresh, quoted
from cellar.llm.common import LOWER, SPACE, crc32_mod, pieces, string_bytes, words
from cellar.llm.crf import marginals

SAMPLE_DOCS = 6000
SAMPLE_LINES = 256
THRESHOLD = 0.3
#: Training sequences are cut to this many lines.
CHAIN = 64
STEPS, RATE, RIDGE = 150, 0.15, 1e-3
BINS = 8
#: Upper bin edges of the measures, in the order of ``_measures``.
EDGES = np.array([
    [0.02, 0.06, 0.12, 0.25, 0.5, 0.8, 0.95],     # capitals of ASCII letters
    [0.001, 0.02, 0.05, 0.1, 0.2, 0.35, 0.6],     # symbols of bytes
    [0.001, 0.02, 0.1, 0.3, 0.6, 0.9, 1.2],       # exclamation marks a word
    [0.001, 0.02, 0.1, 0.3, 0.45, 0.6, 0.9],      # bars a word
    [0.001, 0.02, 0.05, 0.1, 0.2, 0.4, 0.7],      # digits of bytes
    [0.15, 0.3, 0.45, 0.6, 0.75, 0.9, 0.999],     # distinct of words
    [0.001, 0.01, 0.03, 0.1, 0.3, 0.6, 0.9],      # words equal to the one before
    [0.001, 0.05, 0.1, 0.15, 0.25, 0.5, 1.0],     # stops and commas a word
    [2.0, 3.0, 4.0, 5.0, 6.0, 8.0, 12.0],         # bytes a word
    [1, 3, 6, 12, 30, 80, 200],                   # words
    [0.5, 1.5, 2.5, 3.5, 5.5, 10.5, 30.5],        # equal lines just before
])
MEASURES = len(EDGES)


def _count(mask: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return total[ends] - total[starts]


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_UPPER, _LOWER_CASE = _table(bytes(range(65, 91))), _table(bytes(range(97, 123)))
_DIGIT, _STOP = _table(b"0123456789"), _table(b".,;:?")
_SYMBOL = _table(b"#$%&*+/<=>@[\\]^_`{}~")


def line_bins(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bins of every line (lines x measures), line lengths in bytes, first line of each row."""
    breaks = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate([off[:-1], breaks + 1]))
    # a break at the end of a row begins a line of that row, before the next row's first line
    of = np.searchsorted(off[1:], breaks, side="right")
    lines = np.bincount(of, minlength=len(off) - 1) + 1
    first = np.concatenate([[0], np.cumsum(lines)])
    last = np.zeros(len(starts), bool)
    last[first[1:] - 1] = True
    ends = np.empty_like(starts)
    ends[:-1] = starts[1:] - 1
    ends[last] = off[1:]
    size = ends - starts
    hashes, word = words(LOWER[data], np.append(starts, len(data)), SPACE)
    n = np.diff(word)
    some, length = np.maximum(n, 1), np.maximum(size, 1)
    row = np.repeat(np.arange(len(starts)), n)
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
    order = np.lexsort((hashes, row))
    h, r = hashes[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    place = np.arange(len(hashes)) - word[row]
    with np.errstate(over="ignore"):
        line = np.bincount(row, (hashes * (place.astype(np.uint64) * np.uint64(2) + np.uint64(1)) >> np.uint64(40))
                           .astype(np.float64), len(starts))
    same = np.zeros(len(starts), bool)
    same[1:] = (line[1:] == line[:-1]) & (n[1:] > 0) & (n[1:] == n[:-1])
    same[first[:-1]] = False
    index = np.arange(len(starts))
    run = index - np.maximum.accumulate(np.where(same, 0, index))
    upper, letters = _count(_UPPER[data], starts, ends), _count(_LOWER_CASE[data], starts, ends)
    spaces = _count(SPACE[data], starts, ends)
    measures = (
        upper / np.maximum(upper + letters, 1), _count(_SYMBOL[data], starts, ends) / length,
        _count(data == 33, starts, ends) / some, _count(data == 124, starts, ends) / some,
        _count(_DIGIT[data], starts, ends) / length, np.bincount(r, new, len(starts)) / some,
        np.bincount(row, again, len(starts)) / some, _count(_STOP[data], starts, ends) / some,
        (size - spaces) / some, n, run)
    bins = np.stack([np.searchsorted(EDGES[i], m, side="right") for i, m in enumerate(measures)], 1)
    return bins.astype(np.uint8), size, first


def _node(bins: np.ndarray, first: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Score of "good" against "bad" for every line, from its bins and its neighbours'."""
    w = weights[:3 * MEASURES * BINS].reshape(3, MEASURES, BINS)
    score = np.full(len(bins), weights[-5])
    edge = np.zeros(len(bins), bool)
    for i in range(MEASURES):
        score += w[0, i][bins[:, i]]
    edge[first[:-1]] = True
    before = np.flatnonzero(~edge)
    edge[:] = False
    edge[first[1:] - 1] = True
    after = np.flatnonzero(~edge)
    for i in range(MEASURES):
        score[before] += w[1, i][bins[before - 1, i]]
        score[after] += w[2, i][bins[after + 1, i]]
    return score


def fit(bins: np.ndarray, first: np.ndarray, good: np.ndarray) -> np.ndarray:
    """Weights by gradient ascent (Adam) on the conditional log-likelihood.

    ``good``: the label of every line. Last five weights: bias and transitions.
    """
    weights = np.zeros(3 * MEASURES * BINS + 5)
    edge_first, edge_last = np.zeros(len(bins), bool), np.zeros(len(bins), bool)
    edge_first[first[:-1]], edge_last[first[1:] - 1] = True, True
    before, after = np.flatnonzero(~edge_first), np.flatnonzero(~edge_last)
    y = good.astype(float)
    moved = (2 * good[before - 1].astype(int) + good[before]) if len(before) else np.zeros(0, int)
    seen = np.bincount(moved, minlength=4)
    m, v = np.zeros_like(weights), np.zeros_like(weights)
    for k in range(1, STEPS + 1):
        p, counts, _ = marginals(_node(bins, first, weights), first, weights[-4:], pairs=True)
        gap = y - p
        grad = np.empty_like(weights)
        parts = []
        for rows, other in ((slice(None), slice(None)), (before, before - 1), (after, after + 1)):
            for i in range(MEASURES):
                parts.append(np.bincount(bins[other, i], gap[rows], BINS))
        grad[:-5] = np.concatenate(parts)
        grad[-5] = gap.sum()
        grad[-4:] = seen - counts.reshape(-1)
        grad = grad / len(bins) - RIDGE * weights
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        weights += RATE * (m / (1 - 0.9 ** k)) / (np.sqrt(v / (1 - 0.99 ** k)) + 1e-8)
    return weights


def _sample(docs: DataFrame, labels: DataFrame, sample_docs: int, sample_lines: int) -> list:
    """(quality, bins) of the labelled documents the fit sees; bounded by the parameters."""
    chosen = (labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id")
              .agg(F.min("quality").alias("quality")).where(crc32_mod("doc_id", 5) != 0)
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs))
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "quality", "text")

    def run(batches):
        for batch in batches:
            data, off = string_bytes(batch.column(2))
            out = []
            for begin, end in pieces(data, off):
                part = off[begin:end + 1]
                bins, _, first = line_bins(data[part[0]:part[-1]], part - part[0])
                out += [bins[a:min(b, a + sample_lines)].tobytes()
                        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1).cast(pa.int64()), pa.array(out, pa.binary())],
                                             ["doc_id", "quality", "bins"])

    rows = texts.mapInArrow(run, "doc_id long, quality long, bins binary").orderBy("doc_id", "bins").limit(sample_docs)
    return [(r["quality"], r["bins"]) for r in rows.collect()]


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS,
          sample_lines: int = SAMPLE_LINES) -> np.ndarray | float:
    """Weights of the field, or a constant score where the labels don't have both classes."""
    rows = _sample(docs, labels, sample_docs, sample_lines)
    chains, marks = [], []
    for quality, raw in rows:
        bins = np.frombuffer(raw, np.uint8).reshape(-1, MEASURES)
        for k in range(0, len(bins), CHAIN):
            chains.append(bins[k:k + CHAIN])
            marks.append(quality == 1)
    share = float(np.mean([q == 1 for q, _ in rows])) if rows else 0.5
    if share in (0.0, 1.0) or not rows:
        return share
    size = np.array([len(c) for c in chains])
    return fit(np.concatenate(chains), np.concatenate([[0], np.cumsum(size)]), np.repeat(marks, size))


def score(docs: DataFrame, weights: np.ndarray | float, keep: list[str], text: str = "text",
          name: str = "score") -> DataFrame:
    """Columns ``keep`` of every row and its score. One map over whole texts, no shuffle."""
    keep = [c for c in keep if c != name]
    extra = [] if text in keep else [text]
    src = docs.select(*map(quoted, keep + extra))
    at = src.columns.index(text)
    schema = docs.select(*map(quoted, keep)).schema.add(name, "double")

    def run(batches):
        for batch in batches:
            data, off = string_bytes(batch.column(at))
            out = []
            for begin, end in pieces(data, off):
                if isinstance(weights, float):
                    out.append(np.full(end - begin, weights))
                    continue
                part = off[begin:end + 1]
                bins, size, first = line_bins(data[part[0]:part[-1]], part - part[0])
                good = marginals(_node(bins, first, weights), first, weights[-4:])
                weight = np.maximum(size, 1e-9)
                out.append(np.add.reduceat(good * weight, first[:-1]) / np.add.reduceat(weight, first[:-1]))
            scores = np.clip(np.concatenate(out), 0.0, 1.0) if out else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], pa.array(scores, pa.float64())], [*keep, name])

    return src.mapInArrow(run, schema)


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    got = score(docs, train(docs, labels), ["doc_id"])
    return got.select("doc_id", (crc32_mod("doc_id", 5) == 0).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the documents that the classifier rejects."""
    (name,) = fresh(docs, "__quality_score")
    got = score(docs, train(docs, labels), docs.columns, name=name)
    return got.where(F.col(name) >= THRESHOLD).select(*map(quoted, docs.columns))
