"""Workbook streams.

G1: workbooks dropped into a folder are a Structured Streaming source: ``readStream``
of ``binaryFile`` with the fixed file schema, decoded by the same Arrow map as the batch
reader. ``read_excel_stream`` has the columns of the files present at start (or given by the
user) for good: a later file with another column fails the stream. ``grow_excel_stream`` infers
every micro-batch and keeps the lattice bits of each column as its state, stored per batch:
columns are added and types widen at the borders of batches, and a batch that is run again
starts from the state before it.

G2: a stream of rows appended to one workbook with ``foreachBatch``. The number of the batch
is stored in the workbook file itself, so that rows and number appear at once by the replacing
move: a batch that is run again finds its number there and leaves the file alone.
``append_stream_to_workbooks`` writes a workbook of its own per batch instead.
"""

from __future__ import annotations

import zipfile
from collections.abc import Callable
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import remove_tree
from ..sinks import fsio
from ..sinks.excel import write_excel
from ..sinks.zipout import read_marks
from ..sources.arrowrows import ROWS_DDL
from ..sources.excel import ColumnSpec, ReadOptions, _lattice_col, _rows_fn, decode_rows, infer_schema, list_files, project

BINARY_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def read_excel_stream(spark: SparkSession, folder: str, opts: ReadOptions | None = None,
                      glob: str = "*.xlsx") -> DataFrame:
    opts = opts or ReadOptions()
    opts.validate()
    if opts.schema:
        specs = [ColumnSpec(n, t.upper()) for n, t in opts.schema.items()]
    else:
        specs = infer_schema(list_files(spark, folder), opts)
    ordinals = {s.name: j for j, s in enumerate(specs)}
    files = (spark.readStream.format("binaryFile").schema(BINARY_SCHEMA).option("pathGlobFilter", glob)
             .load(folder))
    rows = files.select("path", "content").mapInArrow(_rows_fn(asdict(opts), ordinals, known_only=True), ROWS_DDL)
    return project(rows, specs, opts)


def append_stream_to_workbooks(stream: DataFrame, folder: str, sheet: str, checkpoint: str, order_by=None,
                               **write_opts):
    """Each micro-batch becomes ``<folder>/batch-<id>.xlsx`` (re-runs overwrite the same file)."""

    def each(batch: DataFrame, batch_id: int):
        if batch.isEmpty():
            return
        write_excel({sheet: batch}, f"{folder.rstrip('/')}/batch-{batch_id:08d}.xlsx", order_by=order_by,
                    mode="overwrite", **write_opts)

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)


#: States of earlier batches that are kept.
KEPT_STATES = 10


def _known(spark: SparkSession, state: str, batch_id: int) -> dict[str, int]:
    """Column names in order with their lattice bits, as they were before a batch."""
    if not fsio.exists(state):
        return {}
    rows = spark.read.schema("batch long, pos int, name string, mask int").parquet(f"{state}/batch-*").where(F.col("batch") < batch_id)
    last = rows.agg(F.max("batch")).first()[0]
    if last is None:
        return {}
    return {r["name"]: r["mask"] for r in rows.where(F.col("batch") == last).orderBy("pos").collect()}  # a row per column


def grow_excel_stream(spark: SparkSession, folder: str, each: Callable[[DataFrame, int], None], state: str, checkpoint: str,
                      opts: ReadOptions | None = None, glob: str = "*.xlsx", max_files: int | None = None):
    """G1 with a growing schema: ``each(rows, batch_id)`` gets the typed rows of every micro-batch, with all
    columns known so far in their widest type so far. Returns the stream writer to start."""
    opts = opts or ReadOptions()
    opts.validate()
    if opts.schema or opts.combine != "union" or opts.select:
        raise ValueError("a growing stream takes the columns as they come: no schema, selection or intersection")

    def batch(files: DataFrame, batch_id: int):
        if files.select("path").isEmpty():
            return
        session = files.sparkSession
        known = _known(session, state, batch_id)
        found = infer_schema(files, opts)
        for s in found:
            known[s.name] = known.get(s.name, 0) | s.mask
        rows = [(batch_id, i, name, mask) for i, (name, mask) in enumerate(known.items())]
        masks = session.createDataFrame(rows, "batch long, pos int, name string, mask int")
        masks.coalesce(1).write.mode("overwrite").parquet(f"{state}/batch-{batch_id:012d}")
        if batch_id >= KEPT_STATES:
            remove_tree(session, f"{state}/batch-{batch_id - KEPT_STATES:012d}")
        formats = {s.name: s.formats for s in found}
        typed = masks.withColumn("type", _lattice_col(opts)(F.col("mask"))).orderBy("pos").collect()
        specs = [ColumnSpec(r["name"], r["type"], r["mask"] != 0, formats=formats.get(r["name"]), mask=r["mask"]) for r in typed]
        each(project(decode_rows(files, opts, {s.name: j for j, s in enumerate(specs)}), specs, opts), batch_id)

    source = spark.readStream.format("binaryFile").schema(BINARY_SCHEMA).option("pathGlobFilter", glob)
    if max_files:
        source = source.option("maxFilesPerTrigger", max_files)
    return source.load(folder).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)


def last_batch(path: str, name: str) -> int:
    """The last batch of a stream that a workbook holds, -1 for none."""
    if not fsio.exists(path):
        return -1
    with fsio.open_input_file(path) as fh:
        return read_marks(zipfile.ZipFile(fh).comment).get(name, -1)


def append_batch(batch: DataFrame, batch_id: int, path: str, sheet: str, name: str, order_by=None, **write_opts) -> bool:
    """Append a batch to a sheet unless the workbook has it already; whether anything was written."""
    if last_batch(path, name) >= batch_id or batch.isEmpty():
        return False
    write_excel({sheet: batch}, path, order_by=order_by, mode="append", sheet_exists="append", marks={name: batch_id}, **write_opts)
    return True


def append_stream_to_workbook(stream: DataFrame, path: str, sheet: str, checkpoint: str, name: str | None = None, order_by=None,
                              **write_opts):
    """Every micro-batch is appended to ``sheet`` of the workbook ``path`` once, over continuation sheets
    as it fills up. ``name`` tells streams that share a workbook apart (the checkpoint's path by default)."""

    def each(batch: DataFrame, batch_id: int):
        append_batch(batch, batch_id, path, sheet, name or checkpoint, order_by, **write_opts)

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
