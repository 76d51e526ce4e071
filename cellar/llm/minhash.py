"""MinHash near-duplicates with sequential Bayesian verification.

A document's set holds its distinct word shingles (a text of fewer words is one shingle as a
whole). Documents of equal sets are one class, so copies of any number cost one row from then on.

Candidates: ``BANDS`` bands of ``ROWS`` minima each; two classes that agree in a band share a
bucket. At a similarity of 0.8 all 45 bands differ with a probability of 1.7e-8.

Verification: the signatures of a candidate pair are compared batch by batch. After ``n``
comparisons with ``m`` agreements, under a uniform prior, the similarity reaches the threshold with
the posterior probability ``P(Bin(n + 1, t) <= m)``; below ``MISS`` the pair is pruned. Signatures
are cut to one byte a minimum, whose chance agreements only let more pairs through. Survivors are
confirmed on their full sets; only the sets of classes that share a bucket are computed again.

Buckets never emit all their pairs. Buckets of two or three members are pairs with their smallest
and largest member. Larger ones are dealt to chunks and two chunks meet in a task, which looks at
a pair in the first band only that it shares, prunes it by the posterior and by an upper bound of
its similarity (sets cut to 16 bits a shingle), and lets out one link between two components as
it knows them then. If a link so let out is not confirmed, links left out on its account may be
missing: then the step is run again over what is still apart and lets out all its survivors. So
every candidate pair is either compared or already connected.

Rows: null, empty and wordless texts have an empty set and are linked with nothing. The component
of a class without any ``doc_id`` is null. Repeated rows give repeated results. Other columns are
not looked at.
"""

from __future__ import annotations

from fractions import Fraction
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellar.llm.common import LOWER, SPACE, bit_filter, cut, in_filter, mix, pieces, string_bytes, words
from cellar.llm.components import components

SHINGLE = 2
PERCENT = 80
BANDS, ROWS = 45, 5
#: Comparisons between two looks at the posterior.
BATCH = 25
#: Posterior probability of a similar pair below which a pair is pruned.
MISS = 1e-9
FILTER_BITS = 24
#: Members of a bucket that meet with so many others in one task.
CHUNK = 1024
_PART = 1 << 12

_SEEDS = (mix(np.arange(1, 2 * BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32)
_XOR, _TIMES = _SEEDS[::2], _SEEDS[1::2] | np.uint32(1)
_NEXT, _ALONE = np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


# ---------------------------------------------------------------- sets and signatures


def shingle_sets(texts, shingle: int = SHINGLE):
    """Sorted distinct shingle hashes of each text of an Arrow column, in order."""
    data, off = string_bytes(texts)
    for begin, end in pieces(data, off):
        part = data[off[begin]:off[end]]
        hashes, first = words(LOWER[part], off[begin:end + 1] - off[begin], SPACE)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            w = hashes[a:b]
            if len(w) >= shingle:
                h = w[:len(w) - shingle + 1]
                for i in range(1, shingle):
                    h = mix(h * _NEXT + w[i:len(w) - shingle + 1 + i])
                yield np.unique(h)
            elif len(w):
                h = w[:1]
                for i in range(1, len(w)):
                    h = mix(h * _NEXT + w[i:i + 1])
                yield mix(h + _ALONE * np.uint64(len(w)))
            else:
                yield w


def signature(found: np.ndarray, count: int = BANDS * ROWS) -> np.ndarray:
    """One byte of the minimum of each of ``count`` permutations of a set's hashes (32 bits of them)."""
    least = np.full(count, np.iinfo(np.uint32).max, np.uint32)
    values = (found >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(values), _PART):
        h = values[None, i:i + _PART] ^ _XOR[:count, None]
        h *= _TIMES[:count, None]
        np.minimum(least, h.min(1), out=least)
    # minima are small numbers: mix them before a byte is taken
    least = (least ^ (least >> np.uint32(15))) * np.uint32(0x85EBCA6B)
    return ((least ^ (least >> np.uint32(13))) * np.uint32(0xC2B2AE35) >> np.uint32(24)).astype(np.uint8)


def set_id(found: np.ndarray) -> bytes:
    """Identity of a set in 128 bits."""
    n = np.uint64(len(found))
    low = np.bitwise_xor.reduce(mix(found + _NEXT), keepdims=True)
    high = np.add.reduce(mix(found ^ _ALONE), keepdims=True) * _NEXT
    return np.concatenate([mix(low + n), mix(high + n)]).astype(">u8").tobytes()


def signatures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, n, cid, sig): set size, set identity, one byte a minimum. One map."""

    def run(batches):
        for batch in batches:
            n, cid, sig = [], [], []
            for found in shingle_sets(batch.column(1), shingle):
                n.append(len(found))
                cid.append(set_id(found) if len(found) else None)
                sig.append(signature(found).tobytes() if len(found) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(cid, pa.binary()),
                                              pa.array(sig, pa.binary())], ["doc_id", "n", "cid", "sig"])

    src = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, n long, cid binary, sig binary")


# ---------------------------------------------------------------- sequential verification


@lru_cache
def least_agreements(total: int, batch: int = BATCH, percent: int = PERCENT, miss: float = MISS) -> list[tuple[int, int]]:
    """(comparisons, agreements): from so many agreements on a pair is kept after each batch."""
    out = []
    for n in range(min(batch, total), total + batch, batch):
        n = min(n, total)
        # exact: P(Bin(n + 1, t) <= m) in hundredths to the power of n + 1
        limit, mass, m = Fraction(miss) * 100 ** (n + 1), 0, -1
        while mass < limit:
            m += 1
            mass += comb(n + 1, m) * percent ** m * (100 - percent) ** (n + 1 - m)
        out.append((n, m))
        if n == total:
            break
    return out


def survivors(x: np.ndarray, y: np.ndarray, percent: int = PERCENT, miss: float = MISS) -> np.ndarray:
    """Row numbers of the pairs (signatures row by row) that no batch prunes."""
    alive, agreed, begin = np.arange(len(x)), np.zeros(len(x), np.int64), 0
    for end, least in least_agreements(x.shape[1], BATCH, percent, miss):
        agreed += (x[alive, begin:end] == y[alive, begin:end]).sum(1)
        keep = agreed >= least
        alive, agreed, begin = alive[keep], agreed[keep], end
    return alive


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.cast(pa.large_binary())
    if not len(column):
        return np.zeros((0, BANDS * ROWS), np.uint8)
    _, _, data = column.buffers()
    off = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    return np.frombuffer(data, np.uint8)[off[0]:off[-1]].reshape(len(column), -1)


def _size_fits(a: str, b: str, percent: int) -> Column:
    """Sets whose sizes alone rule the similarity out are no candidates."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _prune(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(a, b) that survive the sequential test, of distinct pairs of classes."""

    def run(batches):
        for batch in batches:
            kept = pa.array(survivors(_matrix(batch.column(2)), _matrix(batch.column(3)), percent))
            yield batch.select([0, 1]).take(kept)

    one = classes.select(F.col("cid").alias("a"), F.col("n").alias("na"), F.col("sig").alias("sa"))
    two = classes.select(F.col("cid").alias("b"), F.col("n").alias("nb"), F.col("sig").alias("sb"))
    both = pairs.join(one, "a").join(two, "b").where(_size_fits("na", "nb", percent))
    return both.select("a", "b", "sa", "sb").mapInArrow(run, "a binary, b binary")


def _sets(docs: DataFrame, members: DataFrame, doc_id: str, text: str, shingle: int) -> DataFrame:
    """(cid, items): the full sets of the classes ``members`` (cid, rep), computed again from one of
    their documents. Others are left out in the map, by a bit table of fixed size over the ids."""
    known = F.coalesce(F.xxhash64("doc_id"), F.lit(0))
    ids = members.select(F.col("rep").alias("doc_id")).distinct().select(known.alias("h"))
    table = bit_filter(ids, "h", FILTER_BITS)

    def run(batches):
        for batch in batches:
            h = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            texts = batch.column(1).filter(pa.array(in_filter(table, FILTER_BITS, h)))
            sets = [s for s in shingle_sets(texts, shingle) if len(s)]
            at = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)
            values = pa.array(np.concatenate([np.zeros(0, np.int64), *(s.view(np.int64) for s in sets)]))
            yield pa.RecordBatch.from_arrays([pa.array([set_id(s) for s in sets], pa.binary()), pa.LargeListArray.from_arrays(
                pa.array(at), values).cast(pa.list_(pa.int64()))], ["cid", "items"])

    src = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    found = src.select(known.alias("h"), "text").mapInArrow(run, "cid binary, items array<long>")
    return found.join(members.select("cid"), "cid", "left_semi").dropDuplicates(["cid"])


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets reach the similarity."""
    one = sets.select(F.col("cid").alias("a"), F.col("items").alias("ia"))
    two = sets.select(F.col("cid").alias("b"), F.col("items").alias("ib"))
    shared = F.size(F.array_intersect("ia", "ib")).cast("long")
    both = pairs.join(one, "a").join(two, "b").select("a", "b", shared.alias("shared"), (F.size("ia") + F.size("ib")).alias("sum"))
    return both.where(100 * F.col("shared") >= percent * (F.col("sum") - F.col("shared"))).select("a", "b")


# ---------------------------------------------------------------- candidates


def _shared_buckets(classes: DataFrame) -> DataFrame:
    """(key, band, cid, members, low, high): classes in buckets of two or more."""
    keys = F.array(*[F.struct(F.lit(i).alias("band"), F.xxhash64(F.lit(i), F.substring("sig", ROWS * i + 1, ROWS)).alias("key"))
                     for i in range(BANDS)])
    rows = classes.select("cid", F.explode(keys).alias("k")).select("cid", "k.key", "k.band")
    ends = rows.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.min("cid").alias("low"),
                                   F.max("cid").alias("high")).where("members > 1")
    return rows.join(ends, "key")


class _Members:
    """Members of a bucket (or of two of its chunks) in a task."""

    def __init__(self, group: pa.Table, percent: int):
        self.percent = percent
        self.cid, self.n = group.column("cid").to_pylist(), group.column("n").to_numpy()
        self.chunk, self.label = group.column("chunk").to_numpy(), group.column("component").to_numpy().copy()
        self.band = group.column("band")[0].as_py()
        self.sig = _matrix(group.column("sig").combine_chunks())
        sketch = group.column("sketch").combine_chunks()
        self.off = np.concatenate([[0], np.cumsum(sketch.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
        code = sketch.flatten().to_numpy(zero_copy_only=False).view(np.uint16).astype(np.int64)
        # equal values of a set stand side by side: number them, so that a set has no code twice
        new = np.ones(len(code), bool)
        new[1:] = code[1:] != code[:-1]
        new[self.off[:-1]] = True
        at = np.arange(len(code))
        self.code = code + ((at - np.maximum.accumulate(np.where(new, at, 0))) << 16)
        self.table = np.zeros(int(self.code.max(initial=0)) + 1, bool)

    def near(self, i: int, rest: np.ndarray) -> np.ndarray:
        """Members of ``rest`` that may be as similar to member i as is asked, and share this band first."""
        n, p = self.n, self.percent
        rest = rest[np.minimum(n[rest], n[i]) * 100 >= np.maximum(n[rest], n[i]) * p]
        if not len(rest):
            return rest
        rest = rest[survivors(np.broadcast_to(self.sig[i], (len(rest), self.sig.shape[1])), self.sig[rest], p)]
        bands = (self.sig[rest] == self.sig[i]).reshape(len(rest), BANDS, ROWS).all(2)
        rest = rest[bands[:, self.band] & ~bands[:, :self.band].any(1)]
        if not len(rest):
            return rest
        # no fewer codes are shared than shingles
        own = self.code[self.off[i]:self.off[i + 1]]
        self.table[own] = True
        size = self.off[rest + 1] - self.off[rest]
        first = np.cumsum(size) - size
        at = np.arange(size.sum()) + np.repeat(self.off[rest] - first, size)
        shared = np.add.reduceat(self.table[self.code[at]].astype(np.int64), first)
        self.table[own] = False
        return rest[100 * shared >= p * (n[rest] + n[i] - shared)]

    def links(self, forest: bool) -> list[tuple[bytes, bytes]]:
        # the largest component last: its members need not be compared with each other
        _, of, size = np.unique(self.label, return_inverse=True, return_counts=True)
        order = np.argsort(size[of], kind="stable")
        out, apart = [], len(np.unique(self.chunk)) > 1
        for k, i in enumerate(order.tolist()):
            rest = order[k + 1:]
            rest = rest[self.label[rest] != self.label[i]]
            if apart:
                rest = rest[self.chunk[rest] != self.chunk[i]]
            found = self.near(i, rest) if len(rest) else rest
            if forest and len(found):
                found = found[np.unique(self.label[found], return_index=True)[1]]
                self.label[np.isin(self.label, self.label[found])] = self.label[i]
            out += [(min(self.cid[i], self.cid[j]), max(self.cid[i], self.cid[j])) for j in found.tolist()]
        return out


def _pairs(buckets: DataFrame) -> DataFrame:
    """All pairs of the buckets of two or three members, each once."""
    few = buckets.where("members <= 3")
    return few.select(F.col("low").alias("a"), F.col("cid").alias("b")).union(few.select("cid", "high")).where(
        "a <> b").distinct()


def _large_buckets(buckets: DataFrame, classes: DataFrame, sets: DataFrame, percent: int,
                   joined: DataFrame | None = None) -> DataFrame:
    """Survivors among the members of the buckets of more than three: one between two components
    of a task, or, if components are given (``joined``), all between different ones."""
    forest = joined is None
    left = buckets.where("members > 3").select("key", "band", "cid", "members")
    if forest:
        named = left.withColumn("component", F.col("cid"))
    else:
        named = left.join(joined.select(F.col("node").alias("cid"), "component"), "cid", "left").withColumn(
            "component", F.coalesce("component", "cid"))
        mixed = named.groupBy("key").agg(F.min("component").alias("c0"), F.max("component").alias("c1")).where("c0 <> c1")
        named = named.join(mixed.select("key"), "key")
    sketch = sets.select("cid", F.transform("items", lambda x: F.shiftright(x, 48).cast("short")).alias("sketch"))
    rows = named.join(classes.select("cid", "n", "sig").join(sketch, "cid"), "cid")
    # chunk i of a bucket meets every chunk j >= i, in the group (i, j)
    chunks = F.ceil(F.col("members") / F.lit(CHUNK)).cast("long")
    rows = rows.withColumn("chunks", chunks).withColumn("chunk", F.pmod(F.xxhash64("cid"), F.col("chunks")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    rows = rows.select(F.xxhash64("key", F.least("chunk", "other"), F.greatest("chunk", "other")).alias("g"), "cid",
                       "band", "chunk", "n", "sig", "sketch", F.xxhash64("component").alias("component"))

    def compare(group: pa.Table):
        pairs = _Members(group, percent).links(forest)
        for i in range(0, len(pairs), 1 << 16):
            part = pairs[i:i + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in part], pa.binary()),
                                              pa.array([b for _, b in part], pa.binary())], ["a", "b"])

    def run(batches):
        # rows come sorted by group, which has two chunks at most; the last one waits
        rest: pa.Table | None = None
        for batch in batches:
            got = pa.Table.from_batches([batch])
            rest = pa.concat_tables([rest, got]) if rest is not None else got
            g = rest.column("g").to_numpy()
            cuts = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]])) if len(g) else np.zeros(0, np.int64)
            for begin, end in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                yield from compare(rest.slice(begin, end - begin))
            rest = rest.slice(int(cuts[-1])) if len(cuts) else rest
        if rest is not None and rest.num_rows:
            yield from compare(rest)

    parts = int(buckets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, "g").sortWithinPartitions("g").mapInArrow(run, "a binary, b binary").distinct()


def near_duplicates(docs: DataFrame, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text",
                    shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row: the smallest ``doc_id`` reachable over links."""
    rows = cut(signatures(docs, doc_id, text, shingle))
    classes = cut(rows.where("cid IS NOT NULL").groupBy("cid").agg(
        F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("sig").alias("sig")))
    buckets = cut(_shared_buckets(classes))
    members = classes.join(buckets.select("cid").distinct(), "cid", "left_semi").select("cid", "rep")
    sets = cut(_sets(docs, members, doc_id, text, shingle))
    late = cut(_prune(_pairs(buckets), classes, percent).union(_large_buckets(buckets, classes, sets, percent)).distinct())
    links = cut(_confirm(late, sets, percent))
    joined = cut(components(links))
    if links.count() < late.count():
        more = cut(_confirm(_large_buckets(buckets, classes, sets, percent, joined), sets, percent))
        if more.limit(1).count():
            joined = cut(components(links.union(more)))
    named = classes.select("cid", "rep").join(joined.select(F.col("node").alias("cid"), "component"), "cid", "left").withColumn(
        "component", F.coalesce("component", "cid"))
    first = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    label = cut(named.join(first, "component").select("cid", "component_id"))
    # equal sets may be a third of all rows: only a join on them that can be split
    return (rows.select("doc_id", "n", "cid").join(label, "cid", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("cid").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")))


def digest(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
