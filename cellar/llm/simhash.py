"""SimHash near-duplicates with pivot distance tables.

Fingerprints: XXH64 (seed 42) of every word shingle, repeats included; a bit is set where more
than half the hashes have it. Distinct fingerprints stand for their documents, so exact copies
of any number cost one row.

Links: fingerprints at ``max_bits`` or fewer differing bits. The 64 bits are cut into
``BLOCKS`` blocks; ``max_bits`` differences leave ``BLOCKS - max_bits`` blocks alike, so equal
block combinations bring every linked pair into one bucket. Each fingerprint has a row in a
pivot table, its Hamming distances to ``PIVOTS`` reference fingerprints: by the triangle
inequality a pair whose rows differ by more than ``max_bits`` anywhere can't be linked and is
discarded; survivors are verified. A bucket returns at most one link per member (a spanning
forest of its links), which is what components need.

Dense buckets (near copies with many distinct fingerprints) don't compare all pairs: two
fingerprints within three bits have a common neighbour at one bit from the one and at most two
from the other. The bucket's one-bit neighbours are stored, two-bit neighbours are looked up;
the cost is linear in the members.

Null texts count as empty; texts without words have fingerprint zero. A null ``doc_id`` never
is a ``component_id`` unless all documents of the component lack one. Repeated rows give
repeated results.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellar.llm.common import cut
from cellar.llm.components import components
from cellar.operators.ordinal import fresh, quoted

SEED = 42
BLOCKS = 6
PIVOTS = 16
#: Buckets up to this size compare their pivot rows pair by pair, in strips.
PAIRWISE = 16384
_STRIP = 1 << 20
_TEXT_PART = 1 << 20
_SHINGLES = 1 << 14


def word_parts(text: bytes, shingle: int) -> Iterator[list[bytes]]:
    """Words of a text in parts; each part begins with the last words of the one before, so
    that every shingle is whole in exactly one part."""
    if len(text) <= _TEXT_PART:
        yield text.lower().split()
        return
    carry: list[bytes] = []
    begin, rest = 0, b""
    while begin < len(text):
        chunk = rest + text[begin:begin + _TEXT_PART]
        begin += _TEXT_PART
        if begin < len(text):
            # the last word may go on in the next part
            cutoff = max(chunk.rfind(bytes([s])) for s in b"\x20\t\n\r\x0b\x0c")
            chunk, rest = chunk[:cutoff + 1], chunk[cutoff + 1:]
        part = carry + chunk.lower().split()
        if begin < len(text) and len(part) < shingle:
            carry = part
            continue
        yield part
        carry = part[len(part) - shingle + 1:] if shingle > 1 else []
    return


def fingerprint(text: str | None, shingle: int = 3) -> int:
    digest = xxhash.xxh64_intdigest
    ones, total = np.zeros(64, np.int64), 0
    whole: list[bytes] = []
    for part in word_parts((text or "").encode("utf-8"), shingle):
        if len(part) < shingle:
            whole = part
            continue
        n = len(part) - shingle + 1
        # neighbours joined by one space: slices of the joined part
        flat = b" ".join(part)
        ends = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)) + 1)
        starts = [0, *ends[:n - 1].tolist()]
        stops = (ends[shingle - 1:] - 1).tolist()
        for k in range(0, n, _SHINGLES):
            hashes = np.array([digest(flat[a:b], SEED) for a, b in
                               zip(starts[k:k + _SHINGLES], stops[k:k + _SHINGLES], strict=True)], "<u8")
            ones += np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
        total += n
    if not total and whole:
        return digest(b" ".join(whole), SEED)
    bits = (2 * ones > total).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed 64-bit number. One map, no shuffle."""

    def run(batches):
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    src = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return src.mapInArrow(run, "doc_id long, fp long")


# ---------------------------------------------------------------- links within buckets


def pivots(count: int = PIVOTS) -> np.ndarray:
    """The reference fingerprints: fixed pseudo-random values."""
    return np.array([xxhash.xxh64_intdigest(b"pivot %d" % i, SEED) for i in range(count)], np.uint64)


def pivot_table(fps: np.ndarray, count: int = PIVOTS) -> np.ndarray:
    """A row per fingerprint: its Hamming distances to the pivots."""
    return np.bitwise_count(fps[:, None] ^ pivots(count)[None, :]).astype(np.int8)


class _Forest:
    def __init__(self, n: int):
        self.up = list(range(n))
        self.links: list[tuple[int, int]] = []

    def root(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def link(self, x: int, y: int) -> None:
        a, b = self.root(x), self.root(y)
        if a != b:
            self.up[max(a, b)] = min(a, b)
            self.links.append((x, y))


def bucket_links(fps: np.ndarray, max_bits: int = 3) -> list[tuple[int, int]]:
    """Links (index pairs) that join the members of a bucket as all its links would."""
    forest = _Forest(len(fps))
    if len(fps) <= PAIRWISE or max_bits not in (2, 3):
        rows = pivot_table(fps)
        step = max(1, _STRIP // len(fps))
        for i in range(0, len(fps), step):
            near = np.ones((min(step, len(fps) - i), len(fps) - i), bool)
            for p in range(rows.shape[1]):
                # discard by coordinate difference, one pivot after the other
                near &= np.abs(rows[i:i + step, p, None] - rows[None, i:, p]) <= max_bits
            x, y = np.nonzero(near)
            x, y = x[x < y] + i, y[x < y] + i
            close = np.bitwise_count(fps[x] ^ fps[y]) <= max_bits
            for a, b in zip(x[close].tolist(), y[close].tolist(), strict=True):
                forest.link(a, b)
        return forest.links
    bit = np.uint64(1) << np.arange(64, dtype=np.uint64)
    one = np.concatenate([np.zeros(1, np.uint64), bit])
    two = np.array([a | b for a, b in combinations(bit.tolist(), 2)], np.uint64)
    members = np.arange(len(fps))
    # everything within one bit of a member, with one owner; members that share one are linked
    spot = (fps[None, :] ^ one[:, None]).reshape(-1)
    owner = np.tile(members, len(one))
    order = np.argsort(spot, kind="stable")
    spot, owner = spot[order], owner[order]
    same = np.flatnonzero(spot[1:] == spot[:-1])
    for a, b in np.unique(np.stack([owner[same], owner[same + 1]], 1), axis=0).tolist():
        forest.link(a, b)
    first = np.concatenate([[True], spot[1:] != spot[:-1]])
    spot, owner = spot[first], owner[first]
    if max_bits == 3:
        for mask in two:
            at = np.searchsorted(spot, look := fps ^ mask)
            hit = at < len(spot)
            hit[hit] = spot[at[hit]] == look[hit]
            for a, b in zip(members[hit].tolist(), owner[at[hit]].tolist(), strict=True):
                if np.bitwise_count(fps[a] ^ fps[b]) <= 3:
                    forest.link(a, b)
    return forest.links


def _keys(max_bits: int) -> list[int]:
    """Masks of the block combinations of which one is alike in every linked pair."""
    edges = np.linspace(0, 64, BLOCKS + 1).astype(int)
    blocks = [sum(1 << b for b in range(lo, hi)) for lo, hi in zip(edges[:-1], edges[1:], strict=True)]
    return [sum(c) for c in combinations(blocks, BLOCKS - max_bits)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def links(fps: DataFrame, max_bits: int = 3) -> DataFrame:
    """(a, b): fingerprints to link, from a table of distinct fingerprints (``fp``)."""
    keys = F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
                     for i, m in enumerate(_keys(max_bits))])
    rows = fps.select("fp", F.explode(keys).alias("k")).select("fp", F.xxhash64("k.t", "k.key").alias("bucket"))

    def run(batches):
        # rows come sorted by bucket: whole buckets are handed on, the last one waits
        rest_fp, rest_key = np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def emit(fp, key):
            cuts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            size = np.diff(np.append(cuts, len(key)))
            found = []
            for at, n in zip(cuts[size > 1].tolist(), size[size > 1].tolist(), strict=True):
                members = np.unique(fp[at:at + n])
                if len(members) == 2:
                    if np.bitwise_count(members[0] ^ members[1]) <= max_bits:
                        found.append(members)
                elif len(members) > 2:
                    found += [members[[a, b]] for a, b in bucket_links(members, max_bits)]
            pairs = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

        for batch in batches:
            fp = np.concatenate([rest_fp, batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)])
            key = np.concatenate([rest_key, batch.column(1).to_numpy(zero_copy_only=False)])
            if not len(key):
                continue
            last = int(np.searchsorted(key, key[-1], side="left"))
            rest_fp, rest_key = fp[last:], key[last:]
            if last:
                yield emit(fp[:last], key[:last])
        if len(rest_key):
            yield emit(rest_fp, rest_key)

    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (rows.repartition(parts, "bucket").sortWithinPartitions("bucket")
            .mapInArrow(run, "a long, b long"))


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """(doc_id, fp, component_id) per row: the smallest ``doc_id`` reachable over links."""
    fps = cut(fingerprints(docs, shingle))
    distinct = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    joined = components(links(distinct, max_bits))
    # component by fingerprint value, then its smallest document
    member = distinct.join(joined, distinct["fp"] == joined["node"], "left").select(
        "fp", "rep", F.coalesce("component", "fp").alias("c"))
    least = member.groupBy("c").agg(F.min("rep").alias("component_id"))
    label = cut(member.join(least, "c").select(F.col("fp").alias("__fp"), "component_id"))
    # equal fingerprints may be a third of all rows: only skew-splittable joins on them
    return fps.join(label, fps["fp"] == label["__fp"]).select("doc_id", "fp", "component_id")


def digest(docs: DataFrame) -> DataFrame:
    got = near_duplicates(docs)
    return got.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """One document of each group: that with the smallest ``doc_id``.

    Of rows that repeat a ``doc_id`` the one with the smallest text stays. Rows without an id
    can't be told apart and stay.
    """
    got = cut(near_duplicates(docs, shingle, max_bits))
    gone, again, n = fresh(docs, "__gone", "__again", "__n")
    columns = [quoted(c) for c in docs.columns]
    lost = got.where("doc_id <> component_id").select(F.col("doc_id").alias(gone)).distinct()
    kept = docs.join(lost, docs["doc_id"] == F.col(gone), "left_anti")
    twice = cut(got.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias(again)).agg(F.count(F.lit(1)).alias(n))
                .where(F.col(n) > 1).select(again))
    order = Window.partitionBy("doc_id").orderBy("text")
    first = (kept.join(twice, F.col("doc_id") == F.col(again), "left_semi").withColumn(n, F.row_number().over(order))
             .where(F.col(n) == 1).select(*columns))
    return kept.join(twice, F.col("doc_id") == F.col(again), "left_anti").select(*columns).union(first)
