"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import time
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellar.session import checkpoint_root

#: Texts are handled in pieces of about so many bytes, so that the temporary arrays of a task
#: stay small whatever the size of an Arrow batch.
PIECE_BYTES = 2 << 20

#: ASCII white space (fixed values of the query contracts): 0x09-0x0D and 0x20.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

#: A-Z to a-z, every other byte unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop shuffle files of plans nobody refers to any more.

    The Python gateway hands references back about once a second, so wait for that before the
    JVM looks for unreachable plans.
    """
    for _ in range(2):
        gc.collect()
        time.sleep(1.2)
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)


def crc32_mod(doc_id: Column | str, mod: int) -> Column:
    """``crc32`` of the id as text, modulo ``mod``; a null id counts as the empty text."""
    text = (F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string")
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary")) % mod


# ---------------------------------------------------------------- texts as bytes


def string_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a string column; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def pieces(data: np.ndarray, off: np.ndarray, size: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes; a longer row is a range of its own."""
    row, rows = 0, len(off) - 1
    while row < rows:
        end = int(np.searchsorted(off, off[row] + size, side="right")) - 1
        end = min(max(end, row + 1), rows)
        yield row, end
        row = end


_POWERS = np.ones(64, np.uint64)


def _powers(n: int) -> np.ndarray:
    """First ``n`` powers of the hash base, modulo 2**64."""
    global _POWERS
    if len(_POWERS) < n or _POWERS[1] == 1:
        steps = np.full(max(n, 1024), _BASE, np.uint64)
        steps[0] = 1
        _POWERS = np.multiply.accumulate(steps)
    return _POWERS


def mix(h: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash so that all its bits depend on all input bits."""
    h = (h ^ (h >> np.uint64(32))) * _MIX
    h = (h ^ (h >> np.uint64(29))) * _MIX
    return h ^ (h >> np.uint64(32))


def words(data: np.ndarray, off: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word (run of bytes that are no separators) and each row's first word.

    A word never crosses rows. Works in slices cut at word ends, so that the per-byte
    arrays stay small for a very long row too.
    """
    hashes, counts = [], np.zeros(len(off) - 1, np.int64)
    begin, total = 0, len(data)
    while begin < total:
        end = min(begin + PIECE_BYTES, total)
        if end < total:
            # go back to a separator or the start of a row, else on to the next one
            back = np.flatnonzero(separator[data[begin:end]])
            row = off[np.searchsorted(off, end, side="right") - 1]
            best = max(begin + int(back[-1]) + 1 if len(back) else 0, int(row))
            if best > begin:
                end = best
            else:
                nxt = int(off[np.searchsorted(off, end, side="left")])
                step = end
                while step < nxt:
                    ahead = np.flatnonzero(separator[data[step:min(step + PIECE_BYTES, nxt)]])
                    if len(ahead):
                        nxt = step + int(ahead[0]) + 1
                        break
                    step += PIECE_BYTES
                end = nxt
        part = data[begin:end]
        inside = ~separator[part]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        rows = off[np.searchsorted(off, begin, side="left"):np.searchsorted(off, end, side="left")] - begin
        first[rows] = inside[rows]
        starts = np.flatnonzero(first)
        if len(starts):
            index = np.cumsum(first) - 1
            place = np.arange(len(part)) - starts[np.maximum(index, 0)]
            value = (part.astype(np.uint64) + np.uint64(1)) * _powers(int(place.max()) + 1)[np.maximum(place, 0)]
            value[~inside] = 0
            hashes.append(mix(np.add.reduceat(value, starts)))
            of = np.searchsorted(off, starts + begin, side="right") - 1
            counts += np.bincount(of, minlength=len(counts))
        begin = end
    first_word = np.zeros(len(off), np.int64)
    np.cumsum(counts, out=first_word[1:])
    return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)), first_word


def rows_to_batch(columns: dict[str, Iterable], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


# ---------------------------------------------------------------- a filter of fixed size


def bit_filter(hashes: DataFrame, column: str, bits_log2: int) -> np.ndarray:
    """Bit table of fixed size (``2**bits_log2`` bits) over a column of 64-bit hashes.

    Built by Spark from 4 KiB pieces; its size does not grow with the data. A full table only
    lets more rows through to the exact join that always follows.
    """
    bit = F.expr(f"shiftrightunsigned({column}, {64 - bits_log2})")
    got = (hashes.select(F.shiftright(bit, 15).alias("piece"), (bit % 32768).alias("bit"))
           .groupBy("piece").agg(F.bitmap_construct_agg("bit").alias("bits")))
    table_ = np.zeros((1 << bits_log2 - 15, 4096), np.uint8)
    for r in got.toLocalIterator():
        table_[r["piece"]] = np.frombuffer(r["bits"], np.uint8)
    return table_.reshape(-1)


def in_filter(table_: np.ndarray, bits_log2: int, hashes: np.ndarray) -> np.ndarray:
    bit = hashes >> np.uint64(64 - bits_log2)
    return (table_[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 > 0
