"""Repeated windows by a depth-limited radix sort of suffixes.

A suffix matters only through its first ``window`` bytes. Suffixes are ordered digit by digit,
most significant first, and a group leaves the sort as soon as it lies within one document;
what is still together after the last digit are exactly the repeated windows.

The first digit is the anchor of a window: its smallest ``ANCHOR`` -byte gram by hash (leftmost
among equals). Equal windows have equal anchors at the same place, and the roughly
``(window - ANCHOR) / 2`` consecutive suffixes that share an anchor move as one run of text, so
that only anchors are counted for all text:

1. Anchors by hash with their smallest and largest document (partial aggregates, so an anchor in
   any number of rows costs one entry a task). Anchors of one document are finished.
2. Runs around the remaining anchors, each with its bytes. A bit table of fixed size keeps most
   finished anchors out; a full table only lets more through. Of equal runs within a piece of
   input the first is sent on, the others are already known to repeat it. Anchors that are in
   very many places (``HOT``) are not a grouping key of their own: what is left of their
   windows is, one by one, so no task gets all rows of a frequent phrase.
3. Within a key equal runs are settled at once, then the remaining digits of the windows of
   distinct runs, eight bytes each, are sorted in passes. A window found in a smaller document
   is removed; neighbouring windows join to spans.

Temporary arrays are made for ``STEP_BYTES`` of text or runs at a time, and the windows of a key with
many runs are sorted by their distance from the anchor, one distance after another: equal windows
have the same.

Windows are bytes of UTF-8 and never cross documents. A null text counts as empty. A null or
repeated ``doc_id``: rows with one id count as one document for the test "in a smaller
document"; a null id is larger than all others. Every row is returned, with the spans of its own
id (rows that repeat an id with other text get the spans that lie in them).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellar.llm.common import bit_filter, cut, in_filter, mix, pieces, release, string_bytes

WINDOW = 50
ANCHOR = 20
FILTER_BITS = 27
#: An anchor that occurs more often than this is grouped by its windows instead.
HOT = 250_000
#: Bytes of text within which equal runs are looked for before they are sent.
SCOPE = 4 << 20
#: Bytes of text or runs, and windows, that a task has temporary arrays for at a time.
STEP_BYTES = 1 << 19
STEP_WINDOWS = 1 << 18
_BASE = np.uint64(0x9E3779B97F4A7C15)
_LAST = np.iinfo(np.int64).max


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes from every position (the last positions are cut off)."""
    n = len(data) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    # doubling: hash of 2k bytes from two hashes of k bytes
    h = data.astype(np.uint64) + np.uint64(1)
    done, factor, out, length = 1, _BASE, None, 0
    rest = size
    while rest:
        if rest & 1:
            part = h[length:length + n]
            out = part.copy() if out is None else out * factor + part
            length += done
        rest >>= 1
        if rest:
            h = h[:len(h) - done] * factor + h[done:]
            done *= 2
            with np.errstate(over="ignore"):
                factor = factor * factor
    return mix(out)


def _least(values: np.ndarray, size: int) -> np.ndarray:
    """Minimum of the ``size`` values from every position."""
    out, done = values, 1
    while done * 2 <= size:
        out = np.minimum(out[:-done], out[done:])
        done *= 2
    return np.minimum(out[:len(values) - size + 1], out[size - done:size - done + len(values) - size + 1])


def anchors(data: np.ndarray, off: np.ndarray, window: int, gram: int):
    """Runs of windows with a common anchor: (row, first window, last window, place, hash).

    Windows and places are positions in ``data``. Rows shorter than a window have none.
    """
    width = window - gram + 1
    starts = len(data) - window + 1
    if starts <= 0:
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),)
    grams = gram_hashes(data, gram)
    # place as the lower part of the order: leftmost among equal hashes (of 40 bits)
    order = grams >> np.uint64(24) << np.uint64(24) | np.arange(len(grams), dtype=np.uint64)
    place = (_least(order, width) & np.uint64((1 << 24) - 1)).astype(np.int64)[:starts]
    row = np.searchsorted(off, np.arange(starts), side="right") - 1
    inside = np.arange(starts) + window <= off[row + 1]
    new = np.ones(starts, bool)
    new[1:] = (place[1:] != place[:-1]) | (inside[1:] != inside[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], starts) - 1
    keep = inside[first]
    first, last = first[keep], last[keep]
    # anchors are minima, so their hashes crowd at the low end: mix again before any use by value
    return row[first], first, last, place[first], mix(grams[place[first]] ^ _BASE)


def _ids(column: pa.Array) -> np.ndarray:
    return column.fill_null(_LAST).to_numpy(zero_copy_only=False)


def _parts(data: np.ndarray, off: np.ndarray, window: int, size: int):
    """Pieces of rows of about ``size`` bytes; a row beyond twice that comes in parts that overlap
    by a window."""
    for begin, end in pieces(data, off, size):
        part = off[begin:end + 1]
        if part[-1] - part[0] <= 2 * size:
            yield begin, 0, data[part[0]:part[-1]], part - part[0]
            continue
        lo, hi = int(part[0]), int(part[-1])
        for at in range(lo, hi, size):
            stop = min(at + size + window - 1, hi)
            yield begin, at - lo, data[at:stop], np.array([0, stop - at])


def _slices(weights: np.ndarray, limit: int):
    """Ranges of items of about ``limit`` in all; a heavier item is a range of its own."""
    total = np.concatenate([[0], np.cumsum(weights)])
    at = 0
    while at < len(weights):
        end = max(int(np.searchsorted(total, total[at] + limit, side="right")) - 1, at + 1)
        yield at, end
        at = end


def _anchor_rows(docs: DataFrame, window: int, gram: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            data, off = string_bytes(batch.column(1))
            ids = _ids(batch.column(0))
            for begin, _, text, rows in _parts(data, off, window, STEP_BYTES):
                row, _, _, _, h = anchors(text, rows, window, gram)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(ids[begin + row])], ["h", "id"])

    return docs.mapInArrow(run, "h long, id long")


def _known(doc, lead, count, head, tail) -> np.ndarray:
    """Which runs of a piece equal one of a smaller document in it.

    A run is told by its windows' number, those before its anchor's place and the hashes of its
    first and last window, which between them cover all its bytes.
    """
    keys = (doc, lead, count, tail, head)
    order = np.lexsort(keys)
    same = np.ones(len(order), bool)
    for k in keys[1:]:
        k = k[order]
        same[1:] &= k[1:] == k[:-1]
    same[:1] = False
    start = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
    out = np.zeros(len(order), bool)
    out[order] = doc[order] > doc[order][start]
    return out


def _gather(text: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of the slices of ``text`` that begin at ``first``."""
    off = np.concatenate([[0], np.cumsum(size)])
    return text[np.repeat(first - off[:-1], size) + np.arange(off[-1])], off


def _sorted_rows(text, h, doc, first, at, count, lead, window):
    """Rows of kind 0, in batches of about ``STEP_BYTES`` of runs."""
    size = count + window - 1
    for i, j in _slices(size, STEP_BYTES):
        run, off = _gather(text, first[i:j], size[i:j])
        runs = pa.Array.from_buffers(pa.binary(), j - i, [None, pa.py_buffer(off.astype(np.int32)), pa.py_buffer(run)])
        yield pa.RecordBatch.from_arrays([
            pa.array(np.zeros(j - i, np.int32)), pa.array(h[i:j].view(np.int64)), pa.array(doc[i:j]),
            pa.array(at[i:j]), runs, pa.array(lead[i:j].astype(np.int32))], _RUN_NAMES)


def _known_rows(doc, at, count):
    """Rows of kind 1; neighbouring runs of a document go as one."""
    k = np.lexsort((at, doc))
    doc, at, count = doc[k], at[k], count[k]
    joins = np.zeros(len(k), bool)
    joins[1:] = (doc[1:] == doc[:-1]) & (at[1:] == at[:-1] + count[:-1])
    begin = np.flatnonzero(~joins)
    if not len(begin):
        return
    doc, at, count = doc[begin], at[begin], np.add.reduceat(count, begin)
    # known runs need no company: a key of their own spreads those of a frequent anchor
    alone = mix(doc.astype(np.int64).view(np.uint64) * _SPREAD + at.astype(np.int64).view(np.uint64))
    yield pa.RecordBatch.from_arrays([
        pa.array(np.ones(len(doc), np.int32)), pa.array(alone.view(np.int64)), pa.array(doc), pa.array(at),
        pa.array([b""] * len(doc), pa.binary()), pa.array(count.astype(np.int32))], _RUN_NAMES)


def _taken_apart(text, h, doc, first, at, count, window):
    """The windows of runs of frequent anchors one by one, in steps of about ``STEP_WINDOWS``."""
    order = np.argsort(h, kind="stable")  # equal windows have equal anchors: one step has most of them
    for i, j in _slices(count[order], STEP_WINDOWS):
        k = order[i:j]
        run, off = _gather(text, first[k], count[k] + window - 1)
        index = np.repeat(np.arange(len(k)), count[k])
        inner = np.arange(len(index)) - np.repeat(np.cumsum(count[k]) - count[k], count[k])
        single = off[index] + inner
        whole = gram_hashes(run, window)[single]
        who, place, one = doc[k][index], at[k][index] + inner, np.ones(len(index), np.int64)
        known = _known(who, one, one, whole, whole)
        yield from _known_rows(who[known], place[known], one[known])
        new = ~known
        yield from _sorted_rows(run, whole[new], who[new], single[new], place[new], one[new], np.zeros(int(new.sum()), np.int64),
                                window)


_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_RUN = "kind int, key long, id long, at long, run binary, lead int"
_RUN_NAMES = ["kind", "key", "id", "at", "run", "lead"]


def _runs(text, rows, ids, shift, table_, window, gram):
    """Runs of a piece of text whose anchors the bit table lets through, step by step: hash of the
    anchor, id, place in the piece and in the document, windows, windows before the anchor's place,
    hashes of the first and the last window."""
    for begin, inner, part, off in _parts(text, rows, window, STEP_BYTES):
        row, first, last, place, h = anchors(part, off, window, gram)
        keep = in_filter(table_, FILTER_BITS, h)
        row, first, last, place, h = row[keep], first[keep], last[keep], place[keep], h[keep]
        if not len(row):
            continue
        whole = gram_hashes(part, window)
        at = first - off[row] + inner
        yield (h, ids[begin + row], rows[begin + row] + at, at + shift, last - first + 1, place - first,
               whole[first], whole[last])


def _run_rows(docs: DataFrame, bits: np.ndarray, hot: np.ndarray, window: int, gram: int) -> DataFrame:
    """Kind 0: a run to sort (``lead`` windows precede its anchor). Kind 1: windows ``at`` to
    ``at + lead - 1`` of a document are known to repeat."""
    shared = docs.sparkSession.sparkContext.broadcast((bits, hot))

    def run(batches):
        table, frequent = shared.value
        for batch in batches:
            data, off = string_bytes(batch.column(1))
            ids = _ids(batch.column(0))
            for begin, shift, text, rows in _parts(data, off, window, SCOPE):
                found = list(zip(*_runs(text, rows, ids[begin:], shift, table, window, gram), strict=True))
                if not found:
                    continue
                h, doc, first, at, count, lead, head, tail = (np.concatenate(x) for x in found)
                again = _known(doc, lead, count, head, tail)
                # an anchor of very many documents: its windows one by one
                many = ~again & np.isin(h, frequent)
                new = ~again & ~many
                yield from _known_rows(doc[again], at[again], count[again])
                yield from _taken_apart(text, *(x[many] for x in (h, doc, first, at, count)), window)
                yield from _sorted_rows(text, *(x[new] for x in (h, doc, first, at, count, lead)), window)

    return docs.mapInArrow(run, _RUN)


def repeated(key: np.ndarray, doc: np.ndarray, at: np.ndarray, lead: np.ndarray, runs: list[bytes],
             window: int) -> np.ndarray:
    """(doc, first window, windows) of runs of windows that are in a smaller document too.

    Rows are whole keys, in key order. Equal runs are settled at once; the windows of the distinct
    ones are sorted in most-significant-digit passes.
    """
    least: dict[tuple, int] = {}
    for name, d in zip(zip(key.tolist(), lead.tolist(), runs, strict=True), doc.tolist(), strict=True):
        if least.setdefault(name, d) > d:
            least[name] = d
    names = zip(key.tolist(), lead.tolist(), runs, strict=True)
    first_doc = np.fromiter((least[n] for n in names), np.int64, len(runs))
    size = np.fromiter(map(len, runs), np.int64, len(runs))
    later = doc > first_doc
    whole = np.stack([doc[later], at[later], size[later] - window + 1], 1)
    _, group = np.unique(key, return_inverse=True)
    # only keys with several distinct runs can have more repeated windows
    live = ~later
    other = np.zeros(int(group.max()) + 2 if len(group) else 1, bool)
    low, high = np.full(len(other), _LAST), np.full(len(other), -_LAST - 1)
    np.minimum.at(low, group[live], doc[live])
    np.maximum.at(high, group[live], doc[live])
    other = low < high
    rows = np.flatnonzero(live & other[group])
    if not len(rows):
        return whole
    group, doc, at, size = group[rows], doc[rows], at[rows], size[rows]
    text = np.frombuffer(b"".join([runs[i] for i in rows.tolist()]) + bytes(8), np.uint8)
    count = size - window + 1
    begin = np.cumsum(size) - size
    digits = np.ndarray((len(text) - 7,), ">u8", text, strides=(1,))
    run, offset = [], []
    # equal windows of a key are at the same place before its anchor, so many go place by place
    ahead = lead[rows]
    for of, inner in _windows(count, ahead):
        gone = _later_windows(digits, begin[of] + inner, group[of], doc[of], window)
        run.append(of[gone])
        offset.append(inner[gone])
    run, offset = np.concatenate(run), np.concatenate(offset)
    if not len(run):
        return whole
    order = np.lexsort((offset, run))
    run, offset = run[order], offset[order]
    new = np.ones(len(run), bool)
    new[1:] = (offset[1:] != offset[:-1] + 1) | (run[1:] != run[:-1])
    cuts = np.flatnonzero(new)
    parts = np.stack([doc[run[cuts]], at[run[cuts]] + offset[cuts], np.diff(np.append(cuts, len(run)))], 1)
    return np.concatenate([whole, parts])


def _windows(count: np.ndarray, lead: np.ndarray):
    """(run, window of it) of all windows of runs, at once or, if many, by distance from the anchor."""
    if count.sum() <= 2 * STEP_WINDOWS:
        run = np.repeat(np.arange(len(count)), count)
        yield run, np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count)
        return
    for ahead in range(int((lead - count).min()) + 1, int(lead.max()) + 1):
        run = np.flatnonzero((lead >= ahead) & (lead - count < ahead))
        if len(run):
            yield run, lead[run] - ahead


def _later_windows(digits: np.ndarray, place: np.ndarray, group: np.ndarray, owner: np.ndarray, window: int) -> np.ndarray:
    """Indexes of the windows (by their places; groups ascend) that are in a smaller document too."""
    alive = np.arange(len(place))
    depth = 0
    while len(alive):
        # leave out the groups that lie within one document
        starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        who = owner[alive]
        least, most = np.minimum.reduceat(who, starts), np.maximum.reduceat(who, starts)
        width = np.diff(np.append(starts, len(group)))
        keep = np.repeat(least < most, width)
        if depth >= window:
            return alive[keep & (who > np.repeat(least, width))]
        alive, group = alive[keep], group[keep]
        digit = digits[place[alive] + depth].astype(np.uint64)
        if window - depth < 8:
            digit >>= np.uint64(8 * (8 - (window - depth)))
        order = np.lexsort((digit, group))
        alive, group, digit = alive[order], group[order], digit[order]
        new = np.zeros(len(group), np.int64)
        new[1:] = (group[1:] != group[:-1]) | (digit[1:] != digit[:-1])
        group = np.cumsum(new)
        depth += 8
    return alive


#: Bytes of runs that one sort takes at least, where keys allow.
SORT_BYTES = 2 << 20


def _spans(runs: DataFrame, window: int) -> DataFrame:
    """(id, at, windows) of all repeated windows."""

    def sort(batches):
        held, size = [], 0

        def flush(rows: pa.Table):
            known = rows.filter(pc.equal(rows.column("kind"), 1))
            rows = rows.filter(pc.equal(rows.column("kind"), 0))
            got = repeated(rows.column("key").to_numpy(), rows.column("id").to_numpy(), rows.column("at").to_numpy(),
                           rows.column("lead").to_numpy(), rows.column("run").to_pylist(), window)
            got = np.concatenate([got, np.stack([known.column(c).to_numpy() for c in ("id", "at", "lead")], 1)
                                  .astype(np.int64).reshape(-1, 3)])
            return pa.RecordBatch.from_arrays([pa.array(got[:, i]) for i in range(3)], ["id", "at", "windows"])

        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size < SORT_BYTES:
                continue
            rows = pa.Table.from_batches(held)
            key = rows.column("key").to_numpy()
            cutoff = int(np.flatnonzero(key == key[-1])[0])
            if cutoff:
                yield flush(rows.slice(0, cutoff))
                rows = rows.slice(cutoff)
            held, size = rows.combine_chunks().to_batches(), rows.nbytes
        if held:
            rows = pa.Table.from_batches(held)
            if rows.num_rows:
                yield flush(rows)

    parts = int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # kind 1 rows need no sorting but come along, so that the runs are made once and not stored
    return (runs.repartition(parts, "key").sortWithinPartitions("key")
            .mapInArrow(sort, "id long, at long, windows long"))


def removed(docs: DataFrame, window: int = WINDOW, gram: int = ANCHOR) -> DataFrame:
    """(id, spans): per document the windows found in a smaller document, as arrays of
    (first window, number of windows); ids of documents without any are absent."""
    spark = docs.sparkSession
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    seen = cut(_anchor_rows(src, window, gram).groupBy("h").agg(
        F.min("id").alias("least"), F.max("id").alias("most"), F.count(F.lit(1)).alias("times"))
        .where("least < most").select("h", "times"))
    bits = bit_filter(seen, "h", FILTER_BITS)
    # at most (anchors / HOT) rows
    hot = np.array([r[0] for r in seen.where(F.col("times") > HOT).select("h").collect()], np.int64).view(np.uint64)
    release(spark)
    spans = _spans(_run_rows(src, bits, hot, window, gram), window)
    return spans.groupBy("id").agg(F.collect_list(F.struct("at", "windows")).alias("spans"))


def deduplicate(docs: DataFrame, window: int = WINDOW, keep_text: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row, the kept bytes on request."""
    spans = cut(removed(docs, window))
    release(docs.sparkSession)
    src = docs.select("doc_id", "text", F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("id"))
    both = src.join(spans, "id", "left").select("doc_id", "text", "spans")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"

    def run(batches):
        for batch in batches:
            data, off = string_bytes(batch.column(1))
            out = {n: [] for n in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")}
            for i, spans_ in enumerate(batch.column(2)):
                text = data[off[i]:off[i + 1]]
                gone, n_spans = 0, 0
                if spans_.is_valid:
                    pairs = spans_.values.flatten()
                    first, count = (p.to_numpy(zero_copy_only=False) for p in pairs)
                    edge = np.zeros(len(text) + 1, np.int64)
                    ok = first < len(text)
                    np.add.at(edge, first[ok], 1)
                    np.add.at(edge, np.minimum(first + count + window - 1, len(text))[ok], -1)
                    out_of = np.cumsum(edge)[:-1] > 0
                    gone = int(out_of.sum())
                    n_spans = int((np.diff(out_of.astype(np.int8), prepend=0) == 1).sum())
                    text = text[~out_of]
                out["n_bytes"].append(int(off[i + 1] - off[i]))
                out["n_removed"].append(gone)
                out["n_spans"].append(n_spans)
                out["kept_sha256"].append(hashlib.sha256(text.tobytes()).hexdigest())
                if keep_text:
                    out["kept"].append(text.tobytes())
            arrays = [batch.column(0).cast(pa.int64()), *[pa.array(out[n], pa.int64()) for n in ("n_bytes", "n_removed", "n_spans")],
                      pa.array(out["kept_sha256"], pa.string())]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if keep_text:
                arrays.append(pa.array(out["kept"], pa.binary()))
                names.append("kept")
            yield pa.RecordBatch.from_arrays(arrays, names)

    return both.mapInArrow(run, schema + (", kept binary" if keep_text else ""))
