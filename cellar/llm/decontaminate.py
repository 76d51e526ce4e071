"""Benchmark decontamination by spaced-seed hashing.

Tokens are runs of letters, digits and non-ASCII characters, A-Z lower-cased; a character of a
script without spaces (``SCRIPTS``) is a token of its own. A document is contaminated by a
benchmark item when ``WINDOW`` aligned tokens of both agree in all but ``substitutions(WINDOW)``
places (0.8 or more alike); an item of fewer tokens counts as one window. An item of fewer than
``MIN_TOKENS`` says too little within a sentence: it contaminates the documents that have it as a
whole line (exact equality of the token sequences, found by a join; a text of one line is a line).

Seeds: fixed masks ignore some positions. However the substitutions of a window fall, one of the
``MASKS`` has a place in the window where none of its positions is hit, so equal seed hashes
bring every contaminated pair together (short items have masks of their own: all ways to leave
out their substitutions). Documents are scanned once: a bit table of fixed size over the
benchmark's seed hashes lets through only the neighbourhood of possible hits; those join the
benchmark's seeds on the hash, and the tokens around each hit are compared position by position.
The table's size doesn't grow with either side, and the join is exact whatever it lets through.

Null or empty texts of either side have no seeds. A null ``doc_id`` or ``item_id`` is reported as
such. Repeated rows are reported once.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellar.llm.common import LOWER, bit_filter, cut, in_filter, mix, pieces, string_bytes, words
from cellar.operators.ordinal import fresh, quoted

WINDOW = 13
MIN_TOKENS = 5
#: Positions that count; together they survive any two substitutions in 13 tokens (tested).
MASKS = ((0, 1, 3, 4, 5, 6), (0, 1, 2, 3, 7, 9))
FILTER_BITS = 23
#: Scripts written without spaces (fixed names of Unicode scripts).
SCRIPTS = ("Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar")
_ALONE = "([" + "".join(f"\\p{{Is{s}}}" for s in SCRIPTS) + "])"
#: Where these scripts lie: a quick look before the scripts themselves.
_FAR = "[\u0e00-\u1fff\u2e80-\ud7ff\uf900-\ufaff\U00020000-\U0003ffff]"
_TOKEN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_CHARS = np.arange(256)
SEPARATOR = ~(((_CHARS >= 48) & (_CHARS < 58)) | ((_CHARS >= 65) & (_CHARS < 91))
              | ((_CHARS >= 97) & (_CHARS < 123)) | (_CHARS >= 128))


def substitutions(n: int) -> int:
    """Places in which ``n`` aligned tokens may differ."""
    return n // 5


def short_masks(n: int) -> list[tuple[int, ...]]:
    """Masks of items of ``n < WINDOW`` tokens: what any choice of substitutions leaves."""
    return [tuple(i for i in range(n) if i not in gone) for gone in combinations(range(n), substitutions(n))]


def _weights(count: int) -> np.ndarray:
    return mix(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def seeds(tokens: np.ndarray, masks: list[tuple[int, tuple[int, ...]]]) -> list[np.ndarray]:
    """Seed hashes of every place of a token array, a row per mask (id, positions)."""
    out = []
    for tag, mask in masks:
        n = len(tokens) - mask[-1]
        if n <= 0:
            out.append(np.zeros(0, np.uint64))
            continue
        total = np.full(n, tag, np.uint64)
        for w, o in zip(_weights(len(mask)), mask, strict=True):
            total += tokens[o:o + n] * w
        out.append(mix(total))
    return out


def _spaced(text: Column) -> Column:
    """The text with spaces around the characters that are tokens of their own."""
    return F.when(text.rlike(_FAR), F.regexp_replace(text, _ALONE, " $1 ")).otherwise(text)


def _sequence(text: Column) -> Column:
    """The tokens of a text as an array."""
    return F.regexp_extract_all(F.translate(_spaced(text), _UPPER, _LOWER), F.lit(_TOKEN), F.lit(0))


def _whole_lines(docs: DataFrame, benchmark: DataFrame) -> DataFrame | None:
    """(doc_id, item_id, matched, compared) of the items that are too short for windows; None without such items."""
    few = benchmark.select(F.col("item_id").cast("long").alias("item_id"), _sequence(F.col("text").cast("string")).alias("t"))
    few = few.where(F.size("t").between(1, MIN_TOKENS - 1)).select("item_id", F.array_join("t", " ").alias("line"),
                                                                  F.size("t").alias("n")).distinct()
    if not few.limit(1).count():
        return None
    line = F.explode(F.split(F.col("text").cast("string"), r"[\r\n]+"))
    lines = docs.select(F.col("doc_id").cast("long").alias("doc_id"), line.alias("l")).select("doc_id", _sequence(F.col("l")).alias("t"))
    lines = lines.where(F.size("t").between(1, MIN_TOKENS - 1)).select("doc_id", F.array_join("t", " ").alias("line")).distinct()
    return lines.join(few, "line").select("doc_id", "item_id", F.col("n").alias("matched"), F.col("n").alias("compared"))


def _items(benchmark: DataFrame) -> DataFrame:
    """(item_id, tokens): token hashes of every item that is looked for."""

    def run(batches):
        for batch in batches:
            data, off = string_bytes(batch.column(1))
            hashes, first = words(LOWER[data], off, SEPARATOR)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(
                pa.array(first, pa.int32()), pa.array(hashes.view(np.int64)))], ["item_id", "tokens"])

    src = benchmark.select(F.col("item_id").cast("long").alias("item_id"), _spaced(F.col("text").cast("string")).alias("text"))
    return src.mapInArrow(run, "item_id long, tokens array<long>").where(F.size("tokens") >= MIN_TOKENS).distinct()


def _item_seeds(items: DataFrame) -> DataFrame:
    """(hash, item_id, place) of every seed of every item."""

    def run(batches):
        for batch in batches:
            got = {"hash": [], "item_id": [], "place": []}
            for item, tokens in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                array = np.array(tokens, np.int64).view(np.uint64)
                n = len(array)
                masks = [(i, m) for i, m in enumerate(MASKS)] if n >= WINDOW else [(n << 16 | i, m)
                                                                                  for i, m in enumerate(short_masks(n))]
                for k, found in enumerate(seeds(array, masks)):
                    if n < WINDOW and masks[k][1]:
                        found = found[:1]
                    got["hash"] += found.view(np.int64).tolist()
                    got["place"] += range(len(found))
                    got["item_id"] += [item] * len(found)
            yield pa.RecordBatch.from_arrays([pa.array(got["hash"], pa.int64()), pa.array(got["item_id"], pa.int64()),
                                              pa.array(got["place"], pa.int32())], ["hash", "item_id", "place"])

    return items.select("item_id", "tokens").mapInArrow(run, "hash long, item_id long, place int").distinct()


def _regions(docs: DataFrame, table_: np.ndarray, lengths: list[int]) -> DataFrame:
    """(doc_id, start, tokens, hits): the tokens around possible hits, and the hits."""
    shared = docs.sparkSession.sparkContext.broadcast(table_)
    masks = list(enumerate(MASKS)) + [(n << 16 | i, m) for n in lengths for i, m in enumerate(short_masks(n))]
    schema = "doc_id long, start long, tokens array<long>, hits array<struct<hash:long,at:long>>"
    hit_type = pa.list_(pa.struct([("hash", pa.int64()), ("at", pa.int64())]))

    def run(batches):
        for batch in batches:
            data, off = string_bytes(batch.column(1))
            ids = batch.column(0).to_pylist()
            out = {"doc_id": [], "start": [], "tokens": [], "hits": []}
            for begin, end in pieces(data, off):
                part = off[begin:end + 1]
                tokens, first = words(LOWER[data[part[0]:part[-1]]], part - part[0], SEPARATOR)
                where, what = [], []
                for (_, mask), found in zip(masks, seeds(tokens, masks), strict=True):
                    at = np.flatnonzero(in_filter(shared.value, FILTER_BITS, found))
                    row = np.searchsorted(first, at, side="right")
                    inside = at + mask[-1] < first[np.minimum(row, len(first) - 1)]
                    where.append(at[inside])
                    what.append(found[at[inside]])
                at, hashes = np.concatenate(where), np.concatenate(what)
                if not len(at):
                    continue
                order = np.argsort(at, kind="stable")
                at, hashes = at[order], hashes[order].view(np.int64)
                row = np.searchsorted(first, at, side="right") - 1
                low = np.maximum(at - WINDOW, first[row])
                high = np.minimum(at + 2 * WINDOW, first[row + 1])
                cuts = np.flatnonzero(np.concatenate([[True], (low[1:] > np.maximum.accumulate(high)[:-1])
                                                      | (row[1:] != row[:-1])]))
                for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(at)], strict=True):
                    lo, hi, doc = int(low[a]), int(high[a:b].max()), int(row[a])
                    out["doc_id"].append(ids[begin + doc])
                    out["start"].append(lo - int(first[doc]))
                    out["tokens"].append(tokens[lo:hi].view(np.int64))
                    out["hits"].append([{"hash": h, "at": t} for h, t in
                                        zip(hashes[a:b].tolist(), (at[a:b] - lo).tolist(), strict=True)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["doc_id"], pa.int64()), pa.array(out["start"], pa.int64()),
                 pa.array(out["tokens"], pa.list_(pa.int64())), pa.array(out["hits"], hit_type)],
                ["doc_id", "start", "tokens", "hits"])

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _spaced(F.col("text").cast("string")).alias("text"))
    return src.mapInArrow(run, schema)


def _verify(candidates: DataFrame) -> DataFrame:
    """Best aligned window of every candidate (doc_id, item_id, shift, tokens, item)."""

    def run(batches):
        for batch in batches:
            best, size = [], []
            for shift, tokens, item in zip(*[batch.column(c) for c in (2, 3, 4)], strict=True):
                shift = shift.as_py()
                x = tokens.values.to_numpy(zero_copy_only=False)
                y = item.values.to_numpy(zero_copy_only=False)
                n = min(WINDOW, len(y))
                lo, hi = max(0, shift), min(len(x), shift + len(y))
                alike = np.concatenate([[0], np.cumsum(x[lo:hi] == y[lo - shift:hi - shift])]) if hi > lo else []
                best.append(int((alike[n:] - alike[:-n]).max()) if len(alike) > n else 0)
                size.append(n)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(best, pa.int32()),
                                              pa.array(size, pa.int32())], ["doc_id", "item_id", "matched", "compared"])

    return candidates.select("doc_id", "item_id", "shift", "tokens", "item").mapInArrow(
        run, "doc_id long, item_id long, matched int, compared int")


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, matched, compared): contaminated pairs, the best window of each."""
    items = cut(_items(benchmark))
    item_seeds = cut(_item_seeds(items))
    # the few distinct lengths below the window size
    lengths = [r[0] for r in items.select(F.size("tokens").alias("n")).where(f"n < {WINDOW}").distinct().collect()]
    table_ = bit_filter(item_seeds, "hash", FILTER_BITS)
    regions = cut(_regions(docs, table_, sorted(lengths)))
    hits = regions.select("doc_id", "start", F.explode("hits").alias("h")).select(
        "doc_id", "start", F.col("h.hash").alias("hash"), F.col("h.at").alias("at"))
    pairs = (hits.join(item_seeds, "hash").select("doc_id", "start", "item_id", (F.col("at") - F.col("place")).alias("shift"))
             .distinct())
    texts = regions.select("doc_id", "start", "tokens").withColumnsRenamed({"doc_id": "__d", "start": "__s"})
    named = items.select(F.col("item_id").alias("__i"), F.col("tokens").alias("item"))
    candidates = (pairs.join(texts, F.col("doc_id").eqNullSafe(F.col("__d")) & (F.col("start") == F.col("__s")))
                  .join(named, F.col("item_id").eqNullSafe(F.col("__i"))))
    got = _verify(candidates).where(F.expr("compared - matched <= floor(compared / 5)"))
    whole = _whole_lines(docs, benchmark)
    got = got if whole is None else got.union(whole)
    return got.groupBy("doc_id", "item_id").agg(F.max("matched").alias("matched"), F.max("compared").alias("compared"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that overlap an item. Rows without an id can't be named as
    contaminated and stay."""
    (name,) = fresh(docs, "__bad")
    bad = cut(overlaps(docs, benchmark).select(F.col("doc_id").alias(name)).distinct())
    return docs.join(bad, docs["doc_id"] == F.col(name), "left_anti").select(*map(quoted, docs.columns))
