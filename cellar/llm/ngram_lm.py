"""Language-model scores by deleted interpolation.

The model mixes maximum-likelihood estimates (uniform over the vocabulary and one unknown word,
unigram, ..., n-gram) with weights that depend on how often the context was seen (``BUCKETS``
frequency buckets). The weights come from expectation-maximisation on held-out counts: the
corpus falls into blocks, and every block in turn is held out, its own counts deleted from those
of the corpus.

Spark's part. Documents are dealt to blocks of bounded size by a hash. A block asks for the
counts of its distinct n-grams in packed, sorted slices of the key space, with its own training
counts; a slice of the key space adds up what all blocks bring and answers each of them in the
order asked. A frequent n-gram therefore costs one entry a block, however many rows hold it,
and no task sees more than a block or a slice. Three passes: counts, held-out histogram (of fixed
size, the only thing besides totals that the driver gets), scores.

Tokens are hashed to 64 bits; n-grams beyond words keep 40 bits beside their slice (the number
of slices grows with the input, so the share of confused n-grams stays below one in 100,000).

A null text counts as empty (its end token alone). Repeated rows give repeated results; they
count as often as they occur. Without training rows every component but the uniform is zero.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellar.llm.common import LOWER, SPACE, crc32_mod, cut, mix, release, string_bytes, words

ORDER = 2
BUCKETS = 16
BLOCK_BYTES = 10 << 20
LEAST_BLOCKS = 16
SLICE_BYTES = 12 << 20
ROUNDS = 60
GRAM_BYTES = 5
#: Histogram steps a power of two; zero probabilities have a level of their own.
LEVELS_PER_OCTAVE, LEVELS = 4, 256

_END = np.uint64(0x6A09E667F3BCC909)
_START = np.uint64(0xBB67AE8584CAA73B)
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5,
                     0x85EBCA77C2B2AE63], np.uint64)


class Block:
    """Tokens and n-grams of one block of documents."""

    def __init__(self, rows: pa.Table, order: int):
        self.ids = rows.column("doc_id")
        self.held_out = rows.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
        data, off = string_bytes(rows.column("text"))
        hashes, first = words(LOWER[data], off, SPACE)
        docs = len(off) - 1
        # one end token behind each document's words
        self.first = first + np.arange(docs + 1)
        total = int(self.first[-1])
        tokens = np.empty(total, np.uint64)
        is_end = np.zeros(total, bool)
        is_end[self.first[1:] - 1] = True
        tokens[~is_end], tokens[is_end] = hashes, _END
        self.train = np.repeat(~self.held_out, np.diff(self.first))
        place = np.arange(total) - np.repeat(self.first[:-1], np.diff(self.first))
        self.keys, self.place = [tokens], place
        key = tokens * _FACTORS[0]
        for n in range(2, order + 1):
            back = np.full(total, _START, np.uint64)
            ok = place >= n - 1
            back[ok] = tokens[np.flatnonzero(ok) - (n - 1)]
            key = key + back * _FACTORS[n - 1]
            self.keys.append(mix(key + np.uint64(n)))
        self.unique, self.index, self.own = [], [], []
        for n, keys in enumerate(self.keys):
            if not n:
                keys = np.append(keys, _START)
            unique, index = np.unique(keys, return_inverse=True)
            train = self.train if n else np.append(self.train, False)
            own = np.bincount(index[train], minlength=len(unique))
            if not n:
                # how often a document starts: the count of the first context
                own[index[-1]] = int((~self.held_out).sum())
                self.start, index = int(index[-1]), index[:-1]
            self.unique.append(unique)
            self.index.append(index)
            self.own.append(own)

    def context(self, n: int, counts: list[np.ndarray]) -> np.ndarray:
        """How often each token's context of ``n - 1`` tokens was seen, from per-type counts."""
        out = np.full(len(self.place), counts[0][self.start], np.int64)
        ok = np.flatnonzero(self.place >= 1)
        if n >= 2:
            # the n-1-gram that ends before this token; at a start it begins with start marks
            out[ok] = counts[n - 2][self.index[n - 2][ok - 1]]
        return out


def _ask(bits: int, order: int):
    def run(key, rows):
        block = Block(rows, order)
        out = {"n": [], "slice": [], "block": [], "keys": [], "counts": []}
        for n in range(order):
            unique, own = block.unique[n], block.own[n]
            part = (unique >> np.uint64(64 - bits)).astype(np.int64)
            # the slices that the block has something in, not all there are
            cuts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else part
            ends = np.append(cuts[1:], len(part))
            raw = (unique if not n else unique << np.uint64(bits)).astype(">u8").view(np.uint8).reshape(-1, 8)
            raw = raw if not n else np.ascontiguousarray(raw[:, :GRAM_BYTES])
            for a, b in zip(cuts.tolist(), ends.tolist()[:len(cuts)], strict=True):
                out["n"].append(n + 1)
                out["slice"].append(int(part[a]))
                out["block"].append(key[0].as_py())
                out["keys"].append(raw[a:b].tobytes())
                out["counts"].append(_packed(own[a:b]))
        return pa.table(out, schema=pa.schema([("n", pa.int32()), ("slice", pa.int32()), ("block", pa.int64()),
                                               ("keys", pa.binary()), ("counts", pa.binary())]))

    return run


def _packed(counts: np.ndarray) -> bytes:
    top = int(counts.max()) if len(counts) else 0
    width = next(w for w in (1, 2, 4, 8) if top < 1 << 8 * w)
    return counts.astype(f"<u{width}").tobytes()


def _unpacked(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, f"<u{len(raw) // n}").astype(np.int64)


def _answer(key, rows):
    """Totals of one slice, for every block in the order it asked."""
    n, slice_ = key[0].as_py(), key[1].as_py()
    width = 8 if n == 1 else GRAM_BYTES
    raw, counts = [r.as_buffer() for r in rows.column("keys").combine_chunks()], rows.column("counts").to_pylist()
    sizes = [len(r) // width for r in raw]
    keys = np.zeros((sum(sizes), 8), np.uint8)
    at = np.cumsum([0, *sizes])
    for r, a, b in zip(raw, at[:-1], at[1:], strict=True):
        keys[a:b, :width] = np.frombuffer(r, np.uint8).reshape(-1, width)
    unique, index = np.unique(keys.view(">u8").reshape(-1).astype(np.uint64), return_inverse=True)
    own = np.concatenate([_unpacked(c, s) for c, s in zip(counts, sizes, strict=True)])
    total = np.bincount(index, own, len(unique)).astype(np.int64)
    word = (unique != _START) if n == 1 else np.zeros(len(unique), bool)
    blocks = rows.column("block").to_pylist()
    return pa.table({
        "block": pa.array(blocks, pa.int64()), "n": pa.array([n] * len(blocks), pa.int32()),
        "slice": pa.array([slice_] * len(blocks), pa.int32()),
        "totals": pa.array([_packed(total[index[a:b]]) for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary()),
        "size": pa.array(sizes, pa.int64()),
        # of the slice as a whole, on its first row
        "types": pa.array([int((total[word] > 0).sum()), *[0] * (len(blocks) - 1)], pa.int64()),
        "tokens": pa.array([int(total[word].sum()), *[0] * (len(blocks) - 1)], pa.int64())})


def _totals(answers: pa.Table, order: int) -> list[np.ndarray]:
    """Corpus counts of a block's types, per order."""
    rows = sorted(answers.select(["n", "slice", "totals", "size"]).to_pylist(), key=lambda r: (r["n"], r["slice"]))
    return [np.concatenate([_unpacked(r["totals"], r["size"]) for r in rows if r["n"] == n] or [np.zeros(0, np.int64)])
            for n in range(1, order + 1)]


def _estimates(block: Block, totals: list[np.ndarray], tokens: int, types: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Component probabilities of every token, and its context's frequency bucket."""
    parts = [np.full(len(block.place), 1.0 / (types + 1)), totals[0][block.index[0]] / max(tokens, 1)]
    seen = np.zeros(len(block.place), np.int64)
    for n in range(2, len(totals) + 1):
        seen = block.context(n, totals)
        parts.append(totals[n - 1][block.index[n - 1]] / np.maximum(seen, 1))
        parts[-1][seen <= 0] = 0
    return parts, np.minimum(np.log2(np.maximum(seen, 0) + 1.0).astype(np.int64), BUCKETS - 1)


def _levels(p: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        q = np.rint(-np.log2(p) * LEVELS_PER_OCTAVE)
    return np.where(p > 0, np.minimum(q, LEVELS - 2), LEVELS - 1).astype(np.int64)


def _histogram(order: int, tokens: int, types: int):
    def run(key, rows, answers):
        spot = np.zeros(0, np.int64)
        if rows.num_rows:
            block = Block(rows, order)
            # held out: what the rest of the corpus says about this block's training tokens
            rest = [t - own for t, own in zip(_totals(answers, order), block.own, strict=True)]
            parts, bucket = _estimates(block, rest, tokens - int(block.train.sum()), types)
            spot = bucket
            for p in parts[1:]:
                spot = spot * LEVELS + _levels(p)
            spot = spot[block.train]
        at, n = np.unique(spot, return_counts=True)
        return pa.table({"spot": pa.array(at, pa.int64()), "tokens": pa.array(n.astype(np.int64), pa.int64())})

    return run


def weights(histogram: list[tuple[int, int]], order: int, types: int) -> np.ndarray:
    """Mixture weights (buckets x components) by expectation-maximisation."""
    spot = np.array([s for s, _ in histogram], np.int64)
    count = np.array([n for _, n in histogram], float)
    parts = []
    for _ in range(order):
        level = spot % LEVELS
        parts.append(np.where(level == LEVELS - 1, 0.0, 2.0 ** (-level / LEVELS_PER_OCTAVE)))
        spot = spot // LEVELS
    p = np.stack([np.full(len(spot), 1.0 / (types + 1)), *parts[::-1]], 1)
    out = np.full((BUCKETS, order + 1), 1.0 / (order + 1))
    for b in range(BUCKETS):
        rows = spot == b
        if not rows.any():
            continue
        for _ in range(ROUNDS):
            share = p[rows] * out[b]
            share = share / share.sum(1, keepdims=True) * count[rows, None]
            # one pseudo-token a component keeps every weight above zero
            out[b] = (share.sum(0) + 1) / (share.sum() + order + 1)
    return out


def _score(order: int, tokens: int, types: int, mixture: np.ndarray):
    def run(key, rows, answers):
        names = ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"]
        kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        if not rows.num_rows:
            return pa.table({n: pa.array([], k) for n, k in zip(names, kinds, strict=True)})
        block = Block(rows, order)
        totals = _totals(answers, order)
        parts, bucket = _estimates(block, totals, tokens, types)
        mixed = sum(mixture[bucket, j] * p for j, p in enumerate(parts))
        known = totals[0][block.index[0]]
        start = block.first[:-1]
        n = np.diff(block.first)
        base = np.add.reduceat(np.log10(known + 0.1), start) - n * math.log10(tokens + 0.1 * (types + 1))
        values = [block.ids, pa.array(block.held_out), pa.array(n), pa.array(np.add.reduceat((known > 0).astype(np.int64), start)),
                  pa.array(base), pa.array(np.add.reduceat(np.log10(mixed), start))]
        return pa.table(dict(zip(names, values, strict=True))).cast(pa.schema(list(zip(names, kinds, strict=True))))

    return run


def scores(docs: DataFrame, held_out, order: int = ORDER) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    ``held_out``: a Boolean column over ``docs``; its rows are scored but not learnt from.
    ``base_score`` is the unigram score with 0.1 added to every count.
    """
    spark = docs.sparkSession
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"),
                      F.coalesce(F.col("text"), F.lit("")).alias("text"))
    size = src.agg(F.sum(F.octet_length("text") + 8)).first()[0] or 0
    blocks = max(LEAST_BLOCKS, -(-size // BLOCK_BYTES))
    bits = max(4, math.ceil(math.log2(max(1, size / SLICE_BYTES))))
    dealt = src.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)))
    asked = dealt.groupBy("block").applyInArrow(
        _ask(bits, order), "n int, slice int, block long, keys binary, counts binary")
    answers = cut(asked.groupBy("n", "slice").applyInArrow(
        _answer, "block long, n int, slice int, totals binary, size long, types long, tokens long"))
    del asked
    release(spark)
    types, tokens = answers.agg(F.sum("types"), F.sum("tokens")).first()
    types, tokens = types or 0, tokens or 0

    def per_block(run, schema):
        return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, schema)

    histogram = per_block(_histogram(order, tokens, types), "spot long, tokens long").groupBy("spot").agg(
        F.sum("tokens").alias("tokens"))
    mixture = weights([tuple(r) for r in histogram.collect()], order, types)
    del histogram
    release(spark)
    got = per_block(_score(order, tokens, types, mixture),
                    "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return got.withColumn("train_tokens", F.lit(tokens).cast("long"))


def digest(docs: DataFrame) -> DataFrame:
    got = scores(docs, crc32_mod("doc_id", 10) == 0)
    return got.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
