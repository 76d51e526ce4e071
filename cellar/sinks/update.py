"""Addressed cell updates of a workbook, in place or into a new file.

The workbook stays what it is: only the rows of patched sheets are taken apart, into raw cells
(column, style, XML as it stands). Plan:

1. sheets and their parts from the zip directory; the head of each patched sheet gives its
   ``<cols>`` style intervals (one row per sheet);
2. rows of the patched sheets as raw cells, in byte-range splits of the sheet XML;
3. patches, reduced to the last of an address, find the style of their column by a range join with
   the intervals, are gathered per row (at most 16,384) and meet the rows by a full outer
   equi-join on (sheet, row). A patched cell keeps its own style; a cell that was not there takes
   that of its row, else of its column (J6). All other cells pass as they are;
4. rows are ordered, deflated and committed like any written sheet; the commit copies every other
   part of the workbook byte by byte and keeps what stands before and behind the sheet's rows.
   It writes beside the target and then replaces it, so the old file is whole until then.

A cleared cell is removed. The list of formula cells (calcChain) is left out, as applications
make it anew; dependants of a patched master of a shared formula are not rewritten.
"""

from __future__ import annotations

import re
import uuid
import zipfile

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.address import col_label
from ..operators.ordinal import small_side, stable_partitions
from ..operators.patch import CLEARED, last_write_wins, patches_from_table, require_sheets
from ..session import scratch_dir
from ..sources import ooxml
from . import existing as EX
from . import fsio, parts
from .render import xml_escape
from .zipout import ZipWriter

#: Bytes of a sheet's XML per split.
RAW_SPLIT = 64 << 20

_ATTR_S = re.compile(rb'(?:^|\s)s="(\d+)"')
_ATTR_STYLE = re.compile(rb'(?:^|\s)style="(\d+)"')
_SPANS = re.compile(rb'\s(?:r|spans)="[^"]*"')
_DIMENSION = re.compile(rb"<(?:[A-Za-z_][\w.-]*:)?dimension\b[^>]*?(?:/>|>\s*</(?:[A-Za-z_][\w.-]*:)?dimension>)")


def sheet_index(spark: SparkSession, path: str) -> DataFrame:
    """(sheet_pos, sheet, part, size, n_xf, max_fmt): sheets with the size of their XML, and the
    workbook's style counts. Only the zip directory and the small parts are read."""

    def run(batches):
        for batch in batches:
            for place in batch.column(0).to_pylist():
                with fsio.open_input_file(place) as fh:
                    zf = zipfile.ZipFile(fh)
                    sheets = [s for s in ooxml.open_workbook(zf, with_styles=False).sheets if s.part in zf.namelist()]
                    n_xf, max_fmt = EX.style_counts(zf)
                    yield pa.RecordBatch.from_pydict(
                        {"sheet_pos": [s.pos for s in sheets], "sheet": [s.name for s in sheets], "part": [s.part for s in sheets],
                         "size": [zf.getinfo(s.part).file_size for s in sheets], "n_xf": [n_xf] * len(sheets),
                         "max_fmt": [max_fmt] * len(sheets)},
                        pa.schema([("sheet_pos", pa.int32()), ("sheet", pa.string()), ("part", pa.string()), ("size", pa.int64()),
                                   ("n_xf", pa.int64()), ("max_fmt", pa.int64())]))

    return spark.createDataFrame([(path,)], "path string").mapInArrow(
        run, "sheet_pos int, sheet string, part string, size long, n_xf long, max_fmt long")


def _head(zf: zipfile.ZipFile, part: str) -> tuple[bytes, bytes]:
    """(everything before the rows, namespace prefix of the sheet's tags)."""
    head = b""
    with zf.open(part) as stream:
        for chunk in ooxml._read_raw(stream, part):
            head += chunk
            m = ooxml._SHEETDATA_RE.search(head)
            if m:
                return head[:m.start()], m.group(1)
    raise ooxml.CorruptWorkbook("sheet without sheetData")


def column_styles(path: str, sheets: DataFrame) -> DataFrame:
    """(sheet_pos, prefix, intervals): the namespace prefix of a sheet and the styles of its column intervals."""

    def run(batches):
        for batch in batches:
            for pos, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with fsio.open_input_file(path) as fh:
                    head, prefix = _head(zipfile.ZipFile(fh), part)
                free, got = 0, []
                for m in ooxml._COL_RE.finditer(head):
                    lo, hi, style = (p.search(m.group(1)) for p in (ooxml._ATTR_MIN, ooxml._ATTR_MAX, _ATTR_STYLE))
                    if lo and hi:
                        first = max(free, int(lo.group(1)) - 1)
                        free = max(free, int(hi.group(1)))
                        if style and first < free:
                            got.append({"lo": first, "hi": free - 1, "style": int(style.group(1))})
                yield pa.RecordBatch.from_arrays(
                    [pa.array([pos], pa.int32()), pa.array([prefix.decode()]), pa.array([got], pa.list_(pa.struct(
                        [("lo", pa.int32()), ("hi", pa.int32()), ("style", pa.int32())])))], ["sheet_pos", "prefix", "intervals"])

    return sheets.select("sheet_pos", "part").mapInArrow(
        run, "sheet_pos int, prefix string, intervals array<struct<lo:int,hi:int,style:int>>")


_CELLS = "array<struct<col:int,style:int,xml:string>>"


def raw_rows(path: str, sheets: DataFrame, with_cells: bool = True) -> DataFrame:
    """(sheet_pos, row, attrs, style, cells): rows as they stand in the sheets' XML.

    ``attrs`` are the row's attributes but its number and spans, ``style`` its style or null.
    Without ``with_cells`` the cells are not looked at.
    """
    n = F.greatest(F.ceil(F.col("size") / F.lit(RAW_SPLIT)).cast("int"), F.lit(1))
    splits = sheets.select("sheet_pos", "part", n.alias("n"), F.explode(F.sequence(F.lit(0), n - 1)).alias("split"))
    cell_type = pa.list_(pa.struct([("col", pa.int32()), ("style", pa.int32()), ("xml", pa.string())]))
    names = ["sheet_pos", "row", "attrs", "style", "cells"]
    kinds = [pa.int32(), pa.int64(), pa.string(), pa.int32(), cell_type]

    def cells_of(body: bytes, tok) -> list[dict]:
        out, col = [], -1
        for m in tok.cell.finditer(body):
            attrs = m.group(1)
            i = attrs.find(b' r="')
            col = ooxml._col_of(attrs[i + 4:attrs.find(b'"', i + 4)]) if i >= 0 else col + 1
            style = _ATTR_S.search(attrs)
            out.append({"col": col, "style": int(style.group(1)) if style else 0, "xml": m.group(0).decode("utf-8")})
        return out

    def rows_of(zf, part, split, n_splits):
        size = zf.getinfo(part).file_size
        lo, hi = split * size // n_splits, (split + 1) * size // n_splits
        buf, base, tok, number = b"", 0, None, -1
        with zf.open(part) as stream:
            for chunk in ooxml._read_raw(stream, part):
                buf += chunk
                if tok is None:
                    m = ooxml._SHEETDATA_RE.search(buf)
                    if not m:
                        continue
                    if m.group(2) == b"/":
                        return
                    tok = ooxml._Tokens(m.group(1))
                    base += m.end()
                    buf = buf[m.end():]
                if base + len(buf) <= lo:
                    base += len(buf)
                    buf = b""
                    continue
                start = max(0, lo - base)
                end = tok.end.search(buf, start)
                at = start
                for m in tok.row.finditer(buf, start, end.start() if end else len(buf)):
                    if split < n_splits - 1 and base + m.start() >= hi:
                        return
                    attrs = m.group(1)
                    i = attrs.find(b' r="')
                    number = int(attrs[i + 4:attrs.find(b'"', i + 4)]) - 1 if i >= 0 else number + 1
                    style = _ATTR_S.search(attrs)
                    yield (number, _SPANS.sub(b"", attrs).rstrip(b"/ ").decode("utf-8"), int(style.group(1)) if style else None,
                           cells_of(m.group(2) or b"", tok) if with_cells else [])
                    at = m.end()
                if end:
                    return
                base += at
                buf = buf[at:]

    def run(batches):
        for batch in batches:
            for pos, part, n_splits, split in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
                with fsio.open_input_file(path) as fh:
                    zf = zipfile.ZipFile(fh)
                    if not ooxml.rows_are_numbered(zf, ooxml.SheetRef(pos, "", part)):
                        # such rows can only be counted from the first on
                        if split:
                            continue
                        n_splits = 1
                    held, bytes_ = [], 0
                    for row in rows_of(zf, part, split, n_splits):
                        held.append((pos, *row))
                        bytes_ += sum(len(c["xml"]) for c in row[3])
                        if bytes_ > 4 << 20 or len(held) >= 10_000:
                            yield pa.RecordBatch.from_arrays([pa.array([h[i] for h in held], k) for i, k in enumerate(kinds)], names)
                            held, bytes_ = [], 0
                    if held:
                        yield pa.RecordBatch.from_arrays([pa.array([h[i] for h in held], k) for i, k in enumerate(kinds)], names)

    return splits.repartition("sheet_pos", "split").select("sheet_pos", "part", "n", "split").mapInArrow(
        run, f"sheet_pos int, row long, attrs string, style int, cells {_CELLS}")


def last_used_rows(path: str, sheets: DataFrame) -> DataFrame:
    """(sheet_pos, last_row) of every sheet, -1 for a sheet without rows; read in splits."""
    used = raw_rows(path, sheets, with_cells=False).groupBy("sheet_pos").agg(F.max("row").alias("last_row"))
    return sheets.select("sheet_pos").join(used, "sheet_pos", "left").select("sheet_pos", F.coalesce("last_row", F.lit(-1).cast("long"))
                                                                              .alias("last_row"))


def workbook_layout(spark: SparkSession, path: str) -> dict:
    """Sheets (name, part, last used row) and style counts of one existing workbook."""
    index = sheet_index(spark, path).collect()  # one small row per sheet
    sheets = spark.createDataFrame(index, "sheet_pos int, sheet string, part string, size long, n_xf long, max_fmt long")
    last = {r["sheet_pos"]: r["last_row"] for r in last_used_rows(path, sheets).collect()}
    return {"sheets": [{"name": r["sheet"], "part": r["part"], "last_row": last[r["sheet_pos"]]}
                       for r in sorted(index, key=lambda r: r["sheet_pos"])],
            "n_xf": index[0]["n_xf"] if index else 1, "max_fmt": index[0]["max_fmt"] if index else 163}


def _cell(ref, prefix, style, k, n, s):
    """XML of a patched cell."""
    tag = F.concat(prefix, F.lit("c"))
    value = F.concat(F.lit("<"), prefix, F.lit("v>%s</"), prefix, F.lit("v>"))
    text = F.regexp_replace(F.coalesce(s, F.lit("")), "_(x[0-9A-Fa-f]{4}_)", "_x005F_$1")
    inline = F.concat(F.lit("<"), prefix, F.lit("is><"), prefix, F.lit('t xml:space="preserve">'), xml_escape(text), F.lit("</"), prefix,
                      F.lit("t></"), prefix, F.lit("is>"))
    kind = F.when(k == "b", F.lit(' t="b"')).when(k == "e", F.lit(' t="e"')).when(k.isin("n", "d"), F.lit("")).otherwise(
        F.lit(' t="inlineStr"'))
    body = (F.when(k.isin("n", "d"), F.replace(value, F.lit("%s"), n.cast("string")))
            .when(k == "b", F.replace(value, F.lit("%s"), F.when(n == 1.0, F.lit("1")).otherwise(F.lit("0"))))
            .when(k == "e", F.replace(value, F.lit("%s"), xml_escape(s))).otherwise(inline))
    styled = F.when(style > 0, F.concat(F.lit(' s="'), style.cast("string"), F.lit('"'))).otherwise(F.lit(""))
    return F.concat(F.lit("<"), tag, F.lit(' r="'), ref, F.lit('"'), styled, kind, F.lit(">"), body, F.lit("</"), tag, F.lit(">"))


def merged_rows(rows: DataFrame, patches: DataFrame, heads: DataFrame, date_style: int) -> DataFrame:
    """(sheet_pos, row, xml): every row with its patches applied.

    ``patches``: (sheet_pos, row, col, k, n, s), one per address; ``date_style``: for dates without a style.
    """
    intervals = heads.select(F.col("sheet_pos").alias("__p"), F.explode("intervals").alias("i")).select("__p", "i.lo", "i.hi", "i.style")
    known = patches.join(small_side(intervals), (F.col("sheet_pos") == F.col("__p")) & F.col("col").between(F.col("lo"), F.col("hi")),
                         "left").select("sheet_pos", F.col("row").cast("long").alias("row"), "col", "k", "n", "s",
                                        F.coalesce("style", F.lit(0)).alias("col_style"))
    by_row = known.groupBy("sheet_pos", "row").agg(F.collect_list(F.struct("col", "k", "n", "s", "col_style")).alias("patches"))
    prefix = small_side(heads.select("sheet_pos", "prefix"))
    both = rows.join(by_row, ["sheet_pos", "row"], "full_outer").join(prefix, "sheet_pos")
    both = both.withColumn("cells", F.coalesce("cells", F.array().cast(_CELLS))).withColumn(
        "own", F.map_from_entries(F.transform("cells", lambda c: F.struct(c["col"], c["style"]))))
    number = (F.col("row") + 1).cast("string")

    def patched(p):
        kept = F.coalesce(F.element_at("own", p["col"]), F.col("style"), p["col_style"])
        style = F.when((p["k"] == "d") & (kept == 0), F.lit(date_style)).otherwise(kept)
        return F.struct(p["col"].alias("col"), _cell(F.concat(col_label(p["col"]), number), F.col("prefix"), style, p["k"], p["n"],
                                                     p["s"]).alias("xml"))

    new = F.transform(F.filter("patches", lambda p: p["k"] != CLEARED), patched)
    old = F.transform(F.filter("cells", lambda c: ~F.array_contains(F.col("patches.col"), c["col"])),
                      lambda c: F.struct(c["col"].alias("col"), c["xml"].alias("xml")))
    cells = F.when(F.col("patches").isNull(), F.col("cells.xml")).otherwise(
        F.transform(F.array_sort(F.concat(old, new)), lambda c: c["xml"]))
    tag = F.concat(F.col("prefix"), F.lit("row"))
    xml = F.concat(F.lit("<"), tag, F.lit(' r="'), number, F.lit('"'), F.coalesce("attrs", F.lit("")), F.lit(">"),
                   F.array_join(cells, ""), F.lit("</"), tag, F.lit(">"))
    return both.select("sheet_pos", "row", xml.alias("xml"))


def update_workbook(spark: SparkSession, path: str, patches: DataFrame, out_path: str | None = None,
                    address_col: str | None = None, seq_col: str | None = None, missing: str | None = None) -> DataFrame:
    """N10 + J1-J7: apply addressed patches (column ``sheet``, else the first sheet) to a workbook.

    Without ``out_path`` the workbook itself is replaced. Returns (wb, path, sheets, rows) after the commit.
    """
    from .excel import _FRAG_DDL, _fragment_fn, _materialize

    index = sheet_index(spark, path).collect()  # one small row per sheet
    if not index:
        raise ooxml.CorruptWorkbook(f"{path}: no sheets")
    sheets = spark.createDataFrame(index, "sheet_pos int, sheet string, part string, size long, n_xf long, max_fmt long")
    first = min(index, key=lambda r: r["sheet_pos"])["sheet"]
    found = patches_from_table(patches, address_col, sheet=None if "sheet" in patches.columns else first, seq_col=seq_col,
                               missing=missing)
    require_sheets(found, sheets)
    named = last_write_wins(found).join(small_side(sheets.groupBy("sheet").agg(F.min("sheet_pos").alias("sheet_pos"))), "sheet")
    touched = {r[0] for r in named.select("sheet_pos").distinct().collect()}  # as many as sheets at most
    some = sheets.where(F.col("sheet_pos").isin(sorted(touched)) if touched else F.lit(False))
    heads = column_styles(path, some)
    n_xf, max_fmt = index[0]["n_xf"], index[0]["max_fmt"]
    rows = merged_rows(raw_rows(path, some), named.select("sheet_pos", "row", "col", "k", "n", "s"), heads, n_xf + 1)
    staged = stable_partitions(rows.select(F.col("sheet_pos").alias("__t"), F.col("row").alias("__n"),
                                           F.lit(0).cast("long").alias("__sheet"), F.col("xml").alias("__xml")), ["__n"], group="__t")
    stage = scratch_dir(spark, "xlsx-stage")
    meta = staged.mapInArrow(_fragment_fn(stage, None, False, sparse=True), _FRAG_DDL)
    nothing = spark.createDataFrame([("", -1, 0, 0, 0, None, 0, 0, 0)], _FRAG_DDL)
    spec = {"path": path, "out": out_path or path, "max_fmt": max_fmt,
            "parts": {r["part"]: r["sheet_pos"] for r in index if r["sheet_pos"] in touched}}
    result = meta.unionByName(nothing).groupBy("wb").applyInPandas(
        lambda pdf: _commit(spec, pdf), "wb string, path string, sheets int, rows long")
    return _materialize(result, stage)


def _tail(zf: zipfile.ZipFile, part: str, prefix: bytes) -> bytes:
    """What stands behind the rows, found without holding them."""
    close = b"</" + prefix + b"sheetData>"
    empty = re.compile(rb"<" + re.escape(prefix) + rb"sheetData\b[^>]*?/>")
    out, rest = None, b""
    with zf.open(part) as stream:
        for chunk in ooxml._read_raw(stream, part):
            if out is not None:
                out += chunk
                continue
            rest += chunk
            at = rest.find(close)
            if at >= 0:
                out = rest[at + len(close):]
            elif m := empty.search(rest):
                out = rest[m.end():]
            else:
                # a tag may be cut by the end of the chunk
                rest = rest[-(len(close) + 256):]
    if out is None:
        raise ooxml.CorruptWorkbook(f"{part}: the rows have no end")
    return out


def _commit(spec: dict, pdf: pd.DataFrame) -> pd.DataFrame:
    """One task per workbook: other parts copied as they are, patched sheets around their new rows."""
    tmp = f"{spec['out']}.{uuid.uuid4().hex[:8]}.tmp"
    with fsio.open_input_file(spec["path"]) as fh, fsio.open_output(tmp) as target:
        src, z = zipfile.ZipFile(fh), ZipWriter(target)
        chain = [n for n in src.namelist() if n.lower().endswith("calcchain.xml")]
        for info in src.infolist():
            name = info.filename
            if name in chain:
                continue
            if name in spec["parts"]:
                head, prefix = _head(src, name)
                tag = prefix + b"sheetData>"
                rows = pdf[(pdf["table_no"] == spec["parts"][name]) & pdf["file"].notna()].sort_values("first_n")
                pieces = [EX._deflated(_DIMENSION.sub(b"", head) + b"<" + tag)]
                pieces += [((lambda f=f: fsio.read_bytes(f)), int(c) & 0xFFFFFFFF, int(r), int(k)) for f, c, r, k in
                           zip(rows["file"], rows["crc"], rows["raw"], rows["comp"], strict=True)]
                z.add_pieces(name, [*pieces, EX._deflated(b"</" + tag + _tail(src, name, prefix))])
            elif chain and (name == "[Content_Types].xml" or name.endswith(".rels")):
                z.add_bytes(name, re.sub(rb"<(?:Override|Relationship)\b[^>]*calcChain\.xml[^>]*?/>", b"", src.read(name)))
            elif name.lower().endswith("styles.xml"):
                z.add_bytes(name, EX.extend_styles(src.read(name), spec["max_fmt"],
                                                   [parts.FORMAT_DATE, parts.FORMAT_DATETIME, parts.FORMAT_TIME]))
            else:
                z.copy_member(src, fh, info)
        z.close(src.comment)
    fsio.move(tmp, spec["out"])
    return pd.DataFrame({"wb": [""], "path": [spec["out"]], "sheets": [len(spec["parts"])],
                         "rows": [int(pdf["n_rows"].fillna(0).sum())]})
