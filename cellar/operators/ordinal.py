"""Distributed row ordinals without a single-partition window.

A global ``row_number()`` pulls every row into one task. Instead:

1. Spark range-partitions the rows by (keys, a hash of the row, the input partition) and sorts
   within partitions: a hot key value, and even a row that repeats, spans several partitions;
   NULL keys come first. The sorted partitions are cut off with a reliable ``checkpoint()`` in
   ``spark.checkpoint.dir``, so that no later job and no re-run task sees other contents
   (Spark's range bounds may differ between two plans over the same data);
2. the rows of each partition are counted (one row per partition) and the counts become offsets
   by ``running_sum``, a prefix scan in levels of ``SCAN_BLOCK`` rows a task;
3. ordinal = offset of the partition + position in the partition, where the position comes from
   ``monotonically_increasing_id`` (partition id << 33 | position).

No bound and no count passes through the driver as a literal or a collected table. When no
ordering key is given, the input order is all there is and step 1 is the checkpoint alone.
Helper columns get names that the table does not have.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_root

# small tables (one row per partition, group or file) are broadcast below so many measured bytes, else shuffle-joined
BROADCAST_OFFSETS_BYTES = 64 << 20
SCAN_BLOCK = 1024


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have (names differ by more than case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def quoted(name: str) -> Column:
    """A column by its exact name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def stable_partitions(df: DataFrame, order_by: list[str] | None = None, group: str | None = None,
                      partitions: int | None = None) -> DataFrame:
    """The rows in (group, order) order, in partitions whose contents never change."""
    checkpoint_root(df.sparkSession)
    keys = ([group] if group else []) + list(order_by or [])
    if not keys:
        return df.checkpoint(eager=True)
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tie, pid = fresh(df, "__tie", "__pid")
    plain = [f.name for f in df.schema.fields if not any(t in f.dataType.simpleString() for t in ("map<", "variant"))]
    tied = df.withColumn(tie, F.xxhash64(*[quoted(c) for c in plain])).withColumn(pid, F.spark_partition_id())
    by = [quoted(k) for k in keys] + [quoted(tie), quoted(pid)]
    return tied.repartitionByRange(n, *by).sortWithinPartitions(*by).drop(tie, pid).checkpoint(eager=True)


def running_sum(df: DataFrame, index: str, value: str, out: str) -> DataFrame:
    """Exclusive running sum of ``value`` over the distinct, not negative numbers ``index``.

    A window sees ``SCAN_BLOCK`` consecutive indices at most; the sums of the blocks are summed in
    the same way, level by level. One number per level count (the largest index) reaches the driver.
    """
    most = df.agg(F.max(index)).first()[0] or 0
    block, base = fresh(df, "__block", "__base")
    marked = df.withColumn(block, (F.col(index) / SCAN_BLOCK).cast("long"))
    w = Window.partitionBy(block).orderBy(index).rowsBetween(Window.unboundedPreceding, -1)
    inner = marked.withColumn(out, F.coalesce(F.sum(value).over(w), F.lit(0)).cast("long"))
    if most < SCAN_BLOCK:
        return inner.drop(block)
    totals = running_sum(marked.groupBy(block).agg(F.sum(value).alias("v")).select(F.col(block).alias("i"), "v"), "i", "v", base)
    totals = totals.select(F.col("i").alias(block), base)
    return inner.join(totals, block).withColumn(out, F.col(out) + F.col(base)).drop(block, base)


def _offsets(staged: DataFrame, value: Column, part: str, offset: str) -> DataFrame:
    """(part, offset): sum of ``value`` over the partitions before each partition."""
    sums = staged.groupBy(F.spark_partition_id().alias(part)).agg(F.sum(value).cast("long").alias("v")).checkpoint(eager=True)
    return small_side(running_sum(sums, part, "v", offset).select(part, offset))


def with_ordinals(staged: DataFrame, out: str = "__n", group: str | None = None) -> DataFrame:
    """Add a 0-based ordinal (per ``group`` when given) to rows from ``stable_partitions``, in their order."""
    part, mono, offset, key, start = fresh(staged, "__part", "__mono", "__offset", "__key", "__start")
    df = staged.withColumn(part, F.spark_partition_id()).withColumn(mono, F.monotonically_increasing_id())
    local = F.col(mono) - F.shiftleft(F.col(part).cast("long"), 33)
    joined = df.join(_offsets(staged, F.lit(1), part, offset), part)
    joined = joined.withColumn(out, F.col(offset) + local).drop(part, mono, offset)
    if group is None:
        return joined
    starts = joined.groupBy(quoted(group).alias(key)).agg(F.min(quoted(out)).alias(start))
    small = is_small(starts)
    # null-safe: rows without a group form a group of their own
    numbered = (joined.join(F.broadcast(starts) if small else starts, quoted(group).eqNullSafe(F.col(key)))
                .withColumn(out, quoted(out) - F.col(start)).drop(start, key))
    # a shuffle join loses the order of the rows, which writers rely on
    return numbered if small else numbered.sortWithinPartitions(quoted(group), quoted(out))


def is_small(df: DataFrame) -> bool:
    """Whether the measured size of ``df`` allows a broadcast."""
    width = sum((F.coalesce(F.octet_length(quoted(c).cast("string")), F.lit(0)) + 16 for c in df.columns), F.lit(0))
    return (df.agg(F.sum(width)).first()[0] or 0) <= BROADCAST_OFFSETS_BYTES


def small_side(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint if its measured size allows one."""
    return F.broadcast(df) if is_small(df) else df


def prefix_sum(df: DataFrame, order_by: list[str], value: str, out: str = "__off") -> DataFrame:
    """Exclusive running sum of ``value`` in ``order_by`` order, without a single-partition window.

    Ordinals number the rows; the running sum over them goes level by level.
    """
    (n,) = fresh(df, "__n")
    numbered = with_ordinals(stable_partitions(df, order_by), n)
    return running_sum(numbered, n, value, out).drop(n)
