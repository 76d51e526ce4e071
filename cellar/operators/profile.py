"""Column profiles over the cell form (A4, A11, A12) and sheet-level row rules.

The only windows here see the runs at the edges of row segments (``type_runs``). Empty-row materialisation has none: a block grid per file is exploded in
parallel and left-joined to the present rows on (path, row_idx).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.cells import staged_typing
from ..session import checkpoint_root

BLOCK_ROWS = 65536


def long_cells(rows: DataFrame, date1904=False) -> DataFrame:
    """rows (path, row_idx, cells) -> (path, row_idx, col, cell typed with bit ``b``).

    Cells are exploded, then typed one by one.
    """
    ex = rows.select("path", "row_idx", F.explode("cells").alias("col", "c"))
    ex, (v,) = staged_typing(ex, ["c"], date1904)
    return ex.select("path", "row_idx", "col", F.struct(v.k.alias("k"), v.n.alias("n"), v.s.alias("s"),
                                                       v.ts.alias("ts"), v.b.alias("b")).alias("cell"))


def column_masks(rows: DataFrame, cols: list[int] | None = None, date1904=False) -> DataFrame:
    """A1 on the cell form: (path, col, mask) for every column with at least one cell.

    Cells are exploded and typed one by one, so the generated code is of one size for any number of
    columns (with all columns of a row in one projection it grows beyond what the JVM compiles).
    They are OR-ed per (file, column) by a partial + final hash aggregate.
    """
    return _typed_cells(rows, cols, date1904).groupBy("path", "col").agg(F.bit_or("b").alias("mask"))


def _typed_cells(rows: DataFrame, cols: list[int] | None = None, date1904=False) -> DataFrame:
    """(path, row_idx, col, b): the lattice bit of every cell that is there.

    The filter of the map keeps the explode out of the generated code of what made the map: joined, both
    are one method that the JVM leaves uncompiled.
    """
    there = F.map_filter("cells", lambda _, c: c.isNotNull())
    cells = rows.select("path", "row_idx", F.explode(there).alias("col", "c"))
    if cols is not None:
        cells = cells.where(F.col("col").isin(list(cols)))
    cells, (v,) = staged_typing(cells, ["c"], date1904)
    return cells.select("path", "row_idx", "col", v.b.alias("b"))


def sheet_profile(rows: DataFrame) -> DataFrame:
    """A4 + A6: (path, sheet, width, last_row, n_rows) of decoded rows with cells: the columns up to the last
    one that holds a cell, and the last row that does. One partial aggregate over the splits."""
    return rows.where(F.size("cells") > 0).groupBy("path", "sheet").agg(
        (F.max(F.array_max(F.map_keys("cells"))) + 1).alias("width"), F.max("row_idx").alias("last_row"),
        F.count(F.lit(1)).alias("n_rows"))


RUN_BLOCK_BITS = 16  # rows of a file that are sorted together: 2**16


def _segment_runs(path, row_idx, blk, bits):
    """Runs of every column in rows sorted by (path, blk, row_idx), as arrays
    (row, col, b, first_row, last_row, seg, head, edge); ``row`` is a row number of the run's file.

    A segment is what one call sees of a block. Blanks between two typed cells of a segment are
    runs of type 0. The first typed run of a segment (``head``) and the last one may go on in
    the neighbouring segments: both are ``edge`` runs.
    """
    import numpy as np

    n = len(row_idx)
    new = np.ones(n, bool)
    new[1:] = (blk[1:] != blk[:-1]) | (path[1:] != path[:-1])
    seg = row_idx[np.maximum.accumulate(np.where(new, np.arange(n), 0))]
    number = np.cumsum(new)
    out = []
    for j in range(bits.shape[1]):
        at = np.flatnonzero(bits[:, j])
        if not len(at):
            continue
        b, r, s = bits[at, j], row_idx[at], number[at]
        fresh_seg = np.ones(len(at), bool)
        fresh_seg[1:] = s[1:] != s[:-1]
        begin = fresh_seg.copy()
        begin[1:] |= (r[1:] != r[:-1] + 1) | (b[1:] != b[:-1])
        first = np.flatnonzero(begin)
        last = np.append(first[1:], len(at)) - 1
        head = fresh_seg[first]
        edge = head | np.append(head[1:], True)
        out.append((at[first], np.full(len(first), j), b[first], r[first], r[last], seg[at[first]], head, edge))
        # blanks before a run that is not the first of its segment
        gap = np.flatnonzero(~head & (r[first] > r[first - 1] + 1))
        if len(gap):
            k = first[gap]
            no = np.zeros(len(gap), bool)
            out.append((at[k], np.full(len(gap), j), np.zeros(len(gap), b.dtype), r[k - 1] + 1, r[k] - 1, seg[at[k]], no, no))
    return [np.concatenate(c) for c in zip(*out, strict=True)] if out else None


def type_runs(rows: DataFrame, cols: list[int] | None = None) -> DataFrame:
    """Run-length type profile: maximal runs of equal cell type per (file, column).

    A run breaks where the type changes or rows are skipped; the rows between two typed cells
    that have no cell or a blank one form a run of type 0 (missing).

    Runs are a mergeable aggregate: each segment of a block of 2**16 rows folds to its closed
    runs and the two at its edges (one pass over all columns, no explode, no sort but by row), and
    the edge runs of neighbouring segments are joined by a scan over these alone. As row
    numbers are ints, a column has a few 100,000 edge runs at most, however long the file.
    """
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    if cols is None:
        cols = _columns(rows)
    picked = rows.select("path", "row_idx", *[F.element_at("cells", F.lit(j)).alias(f"__c{j}") for j in cols])
    picked, views = staged_typing(picked, [f"__c{j}" for j in cols])
    block = F.shiftright("row_idx", RUN_BLOCK_BITS)
    typed = picked.select("path", block.alias("blk"), F.col("row_idx").cast("long").alias("row_idx"),
                          F.array(*[v.b.cast("short") for v in views]).alias("bits"))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = typed.repartition(parts, "path", "blk").sortWithinPartitions("path", "blk", "row_idx")
    width, number = len(cols), np.array(cols, np.int64)

    def fold(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            bits = batch.column(3).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            code = pc.dictionary_encode(batch.column(0), null_encoding="encode").indices.to_numpy()
            got = _segment_runs(code, batch.column(2).to_numpy(), batch.column(1).to_numpy(), bits)
            if got is None:
                continue
            at, j, b, first, last, seg, head, edge = got
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at)), pa.array(number[j].astype(np.int32)), pa.array(b.astype(np.int32)),
                 pa.array(first), pa.array(last), pa.array(seg), pa.array(head), pa.array(edge)],
                ["path", "col", "b", "first_row", "last_row", "seg", "head", "edge"])

    checkpoint_root(rows.sparkSession)
    runs = dealt.mapInArrow(fold, f"path {rows.schema['path'].dataType.simpleString()}, col int, b int, first_row long, "
                                  "last_row long, seg long, head boolean, edge boolean").checkpoint(eager=True)
    along = Window.partitionBy("path", "col").orderBy("first_row")
    edge = runs.filter("edge").withColumn("before", F.lag("last_row").over(along)).withColumn(
        "goes_on", F.col("head") & (F.col("before") + 1 == F.col("first_row")) & (F.lag("b").over(along) == F.col("b")))
    edge = edge.withColumn("run", F.sum(F.when(F.col("goes_on"), 0).otherwise(1)).over(along))
    joined = edge.groupBy("path", "col", "run").agg(F.first("b").alias("b"), F.min("first_row").alias("first_row"),
                                                   F.max("last_row").alias("last_row"))
    gaps = edge.filter("head AND first_row > before + 1").select(
        "path", "col", F.lit(0).alias("b"), (F.col("before") + 1).alias("first_row"), (F.col("first_row") - 1).alias("last_row"))
    out = ["path", "col", "b", "first_row", "last_row"]
    found = runs.filter("NOT edge").select(*out).unionByName(joined.select(*out)).unionByName(gaps)
    return found.withColumn("n_rows", F.col("last_row") - F.col("first_row") + 1)


def _columns(rows: DataFrame) -> list[int]:
    """Column numbers up to the last one with a cell (one number reaches the driver)."""
    width = rows.agg(F.max(F.array_max(F.map_keys("cells")))).first()[0]
    return list(range((width if width is not None else -1) + 1))


def empty_columns(rows: DataFrame, first_row: int = 0, last_row: int | None = None, header_row: int | None = None,
                  ignore_errors: bool = True) -> DataFrame:
    """Per (file, column): is every cell in the row range empty (header row and errors ignored)?"""
    lc = long_cells(rows)
    cond = F.col("row_idx") >= first_row
    if last_row is not None:
        cond &= F.col("row_idx") <= last_row
    if header_row is not None:
        cond &= F.col("row_idx") != header_row
    lc = lc.filter(cond)
    counts = (F.col("cell.b") != 0) & ~(F.lit(ignore_errors) & (F.col("cell.k") == "e"))
    return lc.groupBy("path", "col").agg(F.bool_and(~counts).alias("all_empty"))


def is_empty_row(cells) -> F.Column:
    """a row without any non-missing cell (blank text counts as missing)."""
    return F.size(F.map_filter(cells, lambda k, v: v.isNotNull() & ~((v["k"] == "s") & v["s"].rlike(
        r"^[\x00-\x20]*$")))) == 0


def filter_rows(rows: DataFrame, first_row: int = 0, last_row: int | None = None, skip_empty: bool = True,
                skip_hidden: bool = True, header_row: int | None = None) -> DataFrame:
    """F2, F3, F5, F9, F12 as chained filters: header out -> row range -> empty -> hidden."""
    out = rows
    if header_row is not None:
        out = out.filter(F.col("row_idx") != header_row)
    out = out.filter(F.col("row_idx") >= first_row)
    if last_row is not None:
        out = out.filter(F.col("row_idx") <= last_row)
    if skip_empty:
        out = out.filter(~is_empty_row(F.col("cells")))
    if skip_hidden:
        out = out.filter(~F.col("hidden"))
    return out


def materialise_empty_rows(rows: DataFrame, first_row: int = 0, last_row: int | None = None,
                           skip_hidden: bool = True, all_present: bool = False, files: DataFrame | None = None) -> DataFrame:
    """F6 + F7 + Q5: with empty rows kept, every index from ``first_row`` to the last non-empty
    row (or to ``last_row`` when given) exists; synthesised and empty rows are visible.

    The index grid is generated per (file, block of BLOCK_ROWS) in parallel, then left-joined
    to the non-empty rows on (path, row_idx) -- a balanced equi-join, no window. With
    ``all_present`` no row given is empty; ``files`` (path) are all files, also those without rows.
    """
    nonempty = rows if all_present else rows.filter(~is_empty_row(F.col("cells")))
    nonempty = nonempty.filter(F.col("row_idx") >= first_row)
    if last_row is not None:
        nonempty = nonempty.filter(F.col("row_idx") <= last_row)
        bounds = (rows if files is None else files).select("path").distinct().withColumn("hi", F.lit(last_row))
    else:
        bounds = nonempty.groupBy("path").agg(F.max("row_idx").alias("hi"))
    lo = F.lit(first_row)
    blocks = bounds.filter(F.col("hi") >= lo).select(
        "path", "hi", F.explode(F.sequence((lo / BLOCK_ROWS).cast("int"), (F.col("hi") / BLOCK_ROWS).cast("int")))
        .alias("blk"))
    grid = blocks.repartition("path", "blk").select(
        "path", F.explode(F.sequence(F.greatest(F.col("blk") * BLOCK_ROWS, lo),
                                     F.least(F.col("blk") * BLOCK_ROWS + (BLOCK_ROWS - 1), F.col("hi")))).alias(
            "row_idx"))
    kept = nonempty if not skip_hidden else nonempty.filter(~F.col("hidden"))
    hidden_keys = nonempty.filter(F.col("hidden")).select("path", "row_idx") if skip_hidden else None
    out = grid.join(kept, ["path", "row_idx"], "left")
    if hidden_keys is not None:
        out = out.join(hidden_keys, ["path", "row_idx"], "left_anti")
    return out.withColumn("cells", F.coalesce(F.col("cells"), F.create_map().cast(rows.schema["cells"].dataType))
                          ).withColumn("hidden", F.coalesce(F.col("hidden"), F.lit(False)))
