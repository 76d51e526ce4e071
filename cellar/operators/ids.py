"""Row identifiers (W1-W6) and row-id checks.

Ordinals over (file, seq) come from per-file row counts: ``seq`` is the dense data-row
number the decoding task assigns within its file, so the global ordinal is the file's
offset (a prefix sum over the one-row-per-file table, itself spread over range buckets)
plus ``seq``. No window spans the data rows or the whole file list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_root
from .ordinal import fresh, prefix_sum, quoted, small_side, stable_partitions, with_ordinals


def file_offsets(df: DataFrame, file_col: str, seq_col: str, order_col: str | None = None) -> DataFrame:
    """(file, __off): rows of earlier files (in ``order_col`` or file order) before this file."""
    per_file = df.groupBy(quoted(file_col).alias("__file")).agg(
        (F.max(quoted(seq_col)) + 1).alias("__rows"), *([F.min(quoted(order_col)).alias("__ord")] if order_col else []))
    return prefix_sum(per_file, ["__ord" if order_col else "__file"], "__rows").select(
        F.col("__file").alias(file_col), "__off")


SEQ_SPLIT_SHIFT = 40


def running_index(df: DataFrame, file_col: str, seq_col: str, out: str = "__ord") -> DataFrame:
    """0-based ordinal continuous over files (file order, then seq).

    ``seq`` may carry a split number in its high bits (split << 40 | position in split):
    offsets are then taken per (file, split) from the small table of split sizes.
    """
    split = F.shiftright(quoted(seq_col), SEQ_SPLIT_SHIFT)
    local = quoted(seq_col).bitwiseAND(F.lit((1 << SEQ_SPLIT_SHIFT) - 1))
    parts = df.select(quoted(file_col).alias("__file"), split.alias("__split"), local.alias("__local")).groupBy(
        "__file", "__split").agg((F.max("__local") + 1).alias("__rows"))
    # one row per (file, split): a prefix sum over range buckets, no single-partition window
    offs = prefix_sum(parts, ["__file", "__split"], "__rows")
    f, s, o = fresh(df, "__file", "__split", "__off")
    offs = small_side(offs.select(F.col("__file").alias(f), F.col("__split").alias(s), F.col("__off").alias(o)))
    joined = df.join(offs, quoted(file_col).eqNullSafe(F.col(f)) & (split == F.col(s)))
    return joined.withColumn(out, F.col(o) + local).drop(f, s, o)


def generated_row_ids(df: DataFrame, file_col: str, seq_col: str, out: str = "RowID", prefix: str = "Row") -> DataFrame:
    """Row0, Row1, ... continuous over all files (file order, then row order)."""
    (n,) = fresh(df, "__ord")
    df = running_index(df, file_col, seq_col, n)
    return df.withColumn(out, F.concat(F.lit(prefix), F.col(n).cast("string"))).drop(n)


def index_row_ids(df: DataFrame, file_col: str, row_idx_col: str, file_no_col: str, out: str = "RowID") -> DataFrame:
    """Ids from the sheet row index plus the offset of earlier files (added once: Q10)."""
    f, o = fresh(df, "__file", "__off")
    offs = file_offsets(df, file_col, row_idx_col, file_no_col).toDF(f, o)
    joined = df.join(small_side(offs), quoted(file_col).eqNullSafe(F.col(f)))
    return joined.withColumn(out, F.concat(F.lit("Row"), (F.col(o) + quoted(row_idx_col)).cast("string"))).drop(f, o)


def plain_row_ids(df: DataFrame, file_col: str, seq_col: str, out: str = "RowID") -> DataFrame:
    """Running index + 1, no prefix."""
    (n,) = fresh(df, "__ord")
    df = running_index(df, file_col, seq_col, n)
    return df.withColumn(out, (F.col(n) + 1).cast("string")).drop(n)


def empty_id_to_generated(id_col: Column, generated: Column) -> Column:
    """An empty id is replaced by the generated one."""
    return F.when(id_col.isNull() | (id_col == ""), generated).otherwise(id_col)


def make_unique(df: DataFrame, id_col: str, order_col, out: str | None = None) -> DataFrame:
    """Ids in ``order_col`` order; the first of an id keeps it, later ones get _1, _2, ...

    A row that comes to a name already given goes on to that name's next suffix, wherever the name
    came from: from another row's number or from an id of its own. So a name with suffix j has
    the row of arrival j (from 0) at its stem as its only visitor besides the rows of that very id,
    and only ids that look like a numbered copy of another id depend on one another. Those
    (``children``: one row per such id) are settled stem before copy, a round per nesting level
    (a, a_1, a_1_1: two rounds); all other names follow from the rows' numbers within their id.
    These are distributed ordinals, so a hot id is spread over many tasks. Rows without an id keep none.
    """
    out = out or id_col
    order = [order_col] if isinstance(order_col, str) else list(order_col)
    checkpoint_root(df.sparkSession)
    t, k = fresh(df, "__t", "__k")
    given = stable_partitions(df.filter(quoted(id_col).isNotNull()), order)
    timed = with_ordinals(given, t)
    # (id, k): the row's number within its id, in order
    rows = with_ordinals(stable_partitions(timed, [t], group=id_col), k, group=id_col)
    name, num = quoted(id_col), F.col(k)
    numbered = rows.select(name.cast("string").alias("id"), num.alias("k"), F.col(t).alias("t"))
    moved = _moved(numbered)
    if moved is None:
        label = F.when(num == 0, name).otherwise(F.concat(name, F.lit("_"), num.cast("string")))
        named = rows.withColumn(out, label)
    else:
        visits, names = moved
        vid, vt, mt, new = fresh(rows, "__vid", "__vt", "__mt", "__new")
        visits = small_side(visits.select(F.col("id").alias(vid), F.col("t").alias(vt)))
        names = small_side(names.select(F.col("t").alias(mt), F.col("name").alias(new)))
        both = rows.join(visits, name == F.col(vid), "left").join(names, F.col(t) == F.col(mt), "left")
        at = num + F.coalesce((F.col(vt) < F.col(t)).cast("long"), F.lit(0))
        label = F.when(F.col(new).isNotNull(), F.col(new)).when(at == 0, name).otherwise(
            F.concat(name, F.lit("_"), at.cast("string")))
        named = both.withColumn(out, label)
    named = named.select(*[quoted(c) for c in dict.fromkeys([*df.columns, out])])
    without = df.filter(quoted(id_col).isNull()).withColumn(out, F.lit(None).cast("string"))
    return named.unionByName(without.select(*[quoted(c) for c in named.columns]))


def _moved(numbered: DataFrame) -> tuple[DataFrame, DataFrame] | None:
    """For rows (id, k, t): the visitors of ids, (id, t), and the names of rows that visit, (t, name).

    None where no id is a numbered copy of another one that gets so far.
    """
    nodes = numbered.groupBy("id").agg(F.count(F.lit(1)).alias("rows"))
    copy = r"^(?s)(.*)_([1-9][0-9]{0,17})$"
    stem = nodes.filter(F.col("id").rlike(copy)).select(
        "id", F.regexp_extract("id", copy, 1).alias("stem"), F.regexp_extract("id", copy, 2).cast("long").alias("j"))
    # arrival j exists for j up to the stem's rows (its visitor included)
    children = stem.join(nodes.withColumnRenamed("id", "stem"), "stem").filter("j <= rows").select("id", "stem", "j").checkpoint()
    if not children.limit(1).count():
        return None
    rank = numbered.select(F.col("id").alias("of"), F.col("k").alias("rank"), F.col("t").alias("rank_t"))
    later = children.select(F.col("id").alias("above"))
    todo = children.join(later, F.col("stem") == F.col("above"), "left_anti").withColumn("vt", F.lit(None).cast("long")).withColumn(
        "before", F.lit(None).cast("long"))
    done = None
    while True:
        # the stem's arrival j: its visitor comes after ``before`` rows of its own
        want = F.when(F.col("before").isNull() | (F.col("j") < F.col("before")), F.col("j")).when(
            F.col("j") > F.col("before"), F.col("j") - 1)
        asked = todo.withColumn("want", want)
        found = asked.join(rank, (F.col("stem") == F.col("of")) & (F.col("want") == F.col("rank")), "left")
        visits = found.select("id", F.when(F.col("want").isNull(), F.col("vt")).otherwise(F.col("rank_t")).alias("t"))
        earlier = visits.join(rank, (F.col("id") == F.col("of")) & (F.col("rank_t") < F.col("t")), "left")
        level = earlier.groupBy("id", "t").agg(F.count("of").alias("before")).checkpoint()
        done = level if done is None else done.unionByName(level)
        above = level.select(F.col("id").alias("stem"), F.col("t").alias("vt"),
                             F.when(F.col("t").isNotNull(), F.col("before")).alias("before"))
        todo = children.join(above, "stem").checkpoint()
        if not todo.limit(1).count():
            break
    visits = done.filter("t IS NOT NULL")
    # where a visitor stays: at the id, or at its next suffix unless that is an id to visit as well
    name = F.when(F.col("before") == 0, F.col("id")).otherwise(F.concat("id", F.lit("_"), F.col("before").cast("string")))
    ends = visits.select("t", "before", name.alias("name")).join(
        children.select(F.col("id").alias("name")).withColumn("goes_on", F.lit(True)), "name", "left")
    return visits.select("id", "t"), ends.filter("before = 0 OR goes_on IS NULL").select("t", "name")


def duplicate_ids(df: DataFrame, id_col: str) -> DataFrame:
    """Ids occurring more than once (the reference fails on any)."""
    return df.groupBy(id_col).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def assert_unique_ids(df: DataFrame, id_col: str) -> None:
    dup = duplicate_ids(df, id_col).limit(5).collect()
    if dup:
        raise ValueError(f"Duplicate row ids, e.g. {[r[id_col] for r in dup]}")
