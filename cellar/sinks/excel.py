"""Workbook sinks.

Plan of a write:

1. columns are renamed to their positions, so that no name of the caller's meets one of the
   writer's; ``stable_partitions``: optional range partitioning by the caller's order, then a
   reliable checkpoint so partition contents are fixed (executor loss cannot reshuffle rows);
2. ordinals from per-partition counts (``operators.ordinal``), sheet assignment (W7):
   ``sheet = n div capacity``, ``row = n mod capacity + header``;
3. ``<row>`` XML rendered by Spark expressions; each task deflates its run of rows per
   sheet into a fragment file in the staging folder and reports (sheet, part, crc, sizes);
4. one commit task per workbook concatenates the fragments into the zip (I/O only) and
   moves the finished file into place (write to temp, then replace: N5).

For many workbooks at once (N2) the same plan runs with a group column: the ordinals are
per group and each group's workbook is committed by its own task.
"""

from __future__ import annotations

import json
import re
import uuid

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.address import XLS_MAX_COLS, XLS_MAX_ROWS, XLSX_MAX_COLS, XLSX_MAX_ROWS
from ..functions.text import ILLEGAL_SHEET_CHARS, MAX_SHEET_NAME
from ..operators.ordinal import fresh, quoted, stable_partitions, with_ordinals
from ..session import remove_tree, scratch_dir
from . import fsio, parts
from .render import check_types, header_xml, row_xml, xml_escape_py
from .zipout import ZipWriter, deflate_fragment, with_marks

FRAGMENT_BYTES = 8 << 20  # raw XML per fragment before it is deflated and stored


def validate_sheet_name(name: str) -> None:
    """C22 on the driver."""
    if name is None or not name.strip():
        raise ValueError("A sheet needs a name that is not blank.")
    if len(name) > MAX_SHEET_NAME:
        raise ValueError(f"Sheet name {name!r} has {len(name)} characters; {MAX_SHEET_NAME} fit.")
    if re.search(ILLEGAL_SHEET_CHARS, name):
        raise ValueError(f"Sheet name {name!r} has a character that sheet names cannot hold.")


def continuation_name(name: str, i: int) -> str:
    """C23 on the driver / in the commit task."""
    out = f"{name} ({i})"
    if len(out) > MAX_SHEET_NAME:
        raise ValueError(
            f"The rows fill several sheets and continuation sheet {out!r} is longer than {MAX_SHEET_NAME} "
            f"characters; choose a name that leaves room for the number.")
    return out


def _fragment_fn(stage: str, table_no: int | None, group: bool, sparse: bool = False):
    """Deflate runs of consecutive rows into fragment files.

    A run ends at a new (workbook, table, sheet), and where dense ordinals jump. ``sparse`` row
    numbers ascend within a partition, which holds one range of them.
    """

    def fn(batches):
        buf: list[bytes] = []
        size = 0
        cur = None  # (group, sheet)
        first_n = None
        count = 0
        seqno = 0
        out = {k: [] for k in ("wb", "table_no", "sheet_no", "first_n", "n_rows", "file", "crc", "raw", "comp")}

        def flush():
            nonlocal buf, size, count, seqno, first_n
            if not buf:
                return
            data = b"".join(buf)
            comp, crc, raw = deflate_fragment(data)
            fname = f"{stage}/t{cur[2]}-s{cur[1]}-n{first_n}-{uuid.uuid4().hex[:8]}.bin"
            fsio.write_bytes(fname, comp)
            out["wb"].append(cur[0])
            out["table_no"].append(cur[2])
            out["sheet_no"].append(cur[1])
            out["first_n"].append(first_n)
            out["n_rows"].append(count)
            out["file"].append(fname)
            out["crc"].append(crc)
            out["raw"].append(raw)
            out["comp"].append(len(comp))
            buf, size, count, first_n = [], 0, 0, None
            seqno += 1

        for b in batches:
            wbs = b.column("__wb").to_pylist() if group else [""] * b.num_rows
            sheets = b.column("__sheet").to_pylist()
            ns = b.column("__n").to_pylist()
            xmls = b.column("__xml").to_pylist()
            tnos = b.column("__t").to_pylist() if table_no is None else [table_no] * b.num_rows
            for wb, sh, n, x, t in zip(wbs, sheets, ns, xmls, tnos):
                key = (wb, sh, t)
                if key != cur or (not sparse and first_n is not None and n != first_n + count):
                    # a new sheet, or a jump in the ordinals
                    flush()
                    cur = key
                if first_n is None:
                    first_n = n
                enc = x.encode("utf-8")
                buf.append(enc)
                size += len(enc)
                count += 1
                if size >= FRAGMENT_BYTES:
                    flush()
        flush()
        yield pa.RecordBatch.from_pydict(out, schema=_FRAG_SCHEMA)

    return fn


_FRAG_SCHEMA = pa.schema([("wb", pa.string()), ("table_no", pa.int32()), ("sheet_no", pa.int64()),
                          ("first_n", pa.int64()), ("n_rows", pa.int64()), ("file", pa.string()),
                          ("crc", pa.int64()), ("raw", pa.int64()), ("comp", pa.int64())])
_FRAG_DDL = ("wb string, table_no int, sheet_no long, first_n long, n_rows long, file string, crc long, "
             "raw long, comp long")


def _commit_fn(spec: dict):
    """Runs in one task per workbook: assemble the zip from fragments (copy only)."""

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        wb = pdf["wb"].iloc[0]
        if spec.get("layout"):
            return _commit_into_existing(spec, pdf)
        target = spec["path"] if not spec.get("group") else spec["folder"].rstrip("/") + "/" + _file_for(wb)
        tables = spec["tables"]
        sheets = []  # (sheet name, table_no, sheet_no)
        for t_no, t in enumerate(tables):
            rows_t = pdf[(pdf["table_no"] == t_no) & pdf["file"].notna()]
            n_sheets = int(rows_t["sheet_no"].max()) + 1 if len(rows_t) else 1
            for s in range(n_sheets):
                name = t["sheet"] if s == 0 else continuation_name(t["sheet"], s)
                sheets.append((name, t_no, s))
        tmp = f"{target}.{uuid.uuid4().hex[:8]}.tmp"
        with fsio.open_output(tmp) as fh:
            z = ZipWriter(fh)
            z.add_bytes("[Content_Types].xml", parts.content_types(len(sheets)).encode())
            z.add_bytes("_rels/.rels", parts.ROOT_RELS.encode())
            z.add_bytes("xl/workbook.xml", parts.workbook_xml([s[0] for s in sheets]).encode())
            z.add_bytes("xl/_rels/workbook.xml.rels", parts.workbook_rels(len(sheets)).encode())
            z.add_bytes("xl/styles.xml", parts.STYLES_XML.encode())
            for i, (name, t_no, s_no) in enumerate(sheets):
                t = tables[t_no]
                head = parts.sheet_head(t.get("widths")) + (header_xml(t["names"], 0) if t["header"] else "")
                tail = parts.sheet_tail(spec.get("orientation"), spec.get("paper"))
                frs = pdf[(pdf["table_no"] == t_no) & (pdf["sheet_no"] == s_no) & pdf["file"].notna()]
                frs = frs.sort_values("first_n")
                pieces = [deflate_fragment(head.encode())]
                pieces = [(pieces[0][0], pieces[0][1], pieces[0][2], len(pieces[0][0]))]
                for _, r in frs.iterrows():
                    pieces.append((_reader(r["file"]), int(r["crc"]) & 0xFFFFFFFF, int(r["raw"]), int(r["comp"])))
                tc, tcrc, traw = deflate_fragment(tail.encode())
                pieces.append((tc, tcrc, traw, len(tc)))
                z.add_pieces(f"xl/worksheets/sheet{i + 1}.xml", pieces)
            z.close(with_marks(b"", spec.get("marks")))
        if spec.get("mode") == "errorifexists" and fsio.exists(target):
            fsio.delete_file(tmp)
            raise FileExistsError(f"{target} exists")
        # the move replaces an old workbook at once; there is no moment without one
        fsio.move(tmp, target)
        rows = int(pdf["n_rows"].fillna(0).sum())
        return pd.DataFrame({"wb": [wb], "path": [target], "sheets": [len(sheets)], "rows": [rows]})

    return fn


def _reader(file):
    return lambda: fsio.read_bytes(file)


def _file_for(key: str) -> str:
    """File name of a key's workbook; keys that need sanitising get a short hash so that two
    keys never share a file (e.g. "a/b" and "a_b")."""
    import hashlib

    key = "" if key is None else str(key)
    safe = re.sub(r"[^A-Za-z0-9._-]+", "_", key)
    if safe != key or not safe or safe.startswith((".", "_")):
        # names that begin with a dot or an underscore are hidden from file listings
        safe = f"key{safe}-{hashlib.sha1(key.encode('utf-8')).hexdigest()[:8]}"
    return f"{safe}.xlsx"


def _prepare_table(df: DataFrame, sheet: str, order_by, header: bool, missing, max_rows: int, max_cols: int,
                   row_key: str | None, group: str | None, autosize: bool, chain: list[int] | None = None,
                   styles: tuple[int, int, int] = (1, 2, 3), helper: str | None = None):
    """Rendered rows and the sheet's specification. ``helper``: a column that is not written."""
    validate_sheet_name(sheet)
    names = df.columns
    at = {c: f"c{j}" for j, c in enumerate(names)}
    lower = {c.lower(): p for c, p in at.items()}

    def place(name: str) -> str:
        if name not in at and name.lower() not in lower:
            raise ValueError(f"The table of sheet '{sheet}' has no column '{name}'.")
        return at.get(name) or lower[name.lower()]

    df = df.toDF(*[f"c{j}" for j in range(len(names))])
    order = [place(c) for c in order_by or []]
    key, wb = (place(c) if c is not None else None for c in (row_key, group))
    hidden = {p for p in (wb, place(helper) if helper is not None else None) if p}
    schema = T.StructType([f for f in df.schema.fields if f.name not in hidden])
    shown = {f"c{j}": c for j, c in enumerate(names)}
    if len(schema.fields) > max_cols:
        raise ValueError(f"The table has {len(schema.fields)} columns; a sheet holds at most {max_cols}.")
    check_types(schema, shown)
    staged = stable_partitions(df, order, wb)
    numbered = with_ordinals(staged, "__n", wb)
    if chain:
        # Append after the last used row of each existing sheet of the chain
        from ..operators.layout import append_chain

        chain_df = df.sparkSession.createDataFrame([(i, last) for i, last in enumerate(chain)],
                                                   "sheet_no long, last_row long")
        numbered = append_chain(numbered, "__n", chain_df, max_rows, header, "__sheet_no", "__row")
        sheet_col, row0 = F.col("__sheet_no"), F.col("__row")
    else:
        cap = max_rows - (1 if header else 0)
        sheet_col, row0 = (F.col("__n") / cap).cast("long"), (F.col("__n") % cap) + (1 if header else 0)
    xml = row_xml(schema, row0, missing, key, styles, shown)
    cols = [F.col("__n"), sheet_col.alias("__sheet"), xml.alias("__xml")]
    if wb:
        cols.insert(0, F.col(wb).cast("string").alias("__wb"))
    # in the order of the rendered cells: the row key is the first of them
    cells = [f.name for f in schema.fields if f.name != key]
    titles = [shown[c] for c in cells]
    if key is not None:
        cells, titles = [key, *cells], ["RowID", *titles]
    widths = column_widths(staged.select(*cells), titles, header) if autosize else None
    return numbered.select(*cols), {"sheet": sheet, "names": titles, "header": header, "widths": widths,
                                    "chain": len(chain or [])}


def column_widths(df: DataFrame, names: list[str], header: bool) -> list[float]:
    """Longest rendered value per column (header included) -> column widths."""
    aggs = [F.max(F.length(quoted(c).cast("string"))).alias(f"w{j}") for j, c in enumerate(df.columns)]
    row = df.agg(*aggs).collect()[0]
    out = []
    for j, name in enumerate(names[: len(df.columns)]):
        w = row[f"w{j}"] or 0
        if header:
            w = max(w, len(name))
        out.append(min(255.0, w + 2.0))
    return out


def write_excel(tables, path: str, order_by=None, header: bool = True, missing: str | None = None,
                fmt: str = "xlsx", row_key: str | None = None, mode: str = "overwrite", autosize: bool = False,
                orientation: str | None = None, paper: str | None = None, max_rows: int | None = None,
                sheet_exists: str = "fail", create_folders: bool = True, marks: dict[str, int] | None = None) -> DataFrame:
    """Write one or more DataFrames to one workbook, one sheet each (split by capacity).

    ``mode`` (file exists, N4): "overwrite", "errorifexists" or "append" (write into the
    existing workbook); ``sheet_exists`` (N3, with append): "fail", "overwrite" (replace the
    sheet in place) or "append" (after its last used row, over its continuation sheets).
    Without ``create_folders`` a missing target folder fails the write. ``marks`` (stream name: batch
    number) are stored in the file itself, so that they and the rows appear at once (G2).

    ``tables`` is a DataFrame (sheet ``default_1``) or a dict / list of (sheet name, DataFrame).
    ``order_by`` gives the row order (a DataFrame has none of its own). Returns a one-row
    DataFrame (wb, path, sheets, rows) after the commit.
    """
    if isinstance(tables, DataFrame):
        tables = [("default_1", tables)]
    elif isinstance(tables, dict):
        tables = list(tables.items())
    names = [n for n, _ in tables]
    helpers: dict[str, str] = {}
    if len(set(names)) != len(names):
        if sheet_exists != "append":
            raise ValueError("Two tables go to one sheet; give each a sheet of its own or sheet_exists='append'.")
        tables, order_by, helpers = _merge_same_sheet(tables, order_by)
    if fmt == "xls":
        raise ValueError("The binary xls format is not supported for writing (see README); use xlsx.")
    if not create_folders and "/" in path and not fsio.exists(path.rsplit("/", 1)[0]):
        raise FileNotFoundError(f"folder of '{path}'")
    cap_rows = max_rows or XLSX_MAX_ROWS
    spark = tables[0][1].sparkSession
    layout = None
    if fsio.exists(path):
        if mode == "errorifexists":
            raise FileExistsError(f"The file '{path}' exists.")
        if mode == "append":
            from .update import workbook_layout

            layout = workbook_layout(spark, path)
    stage = scratch_dir(spark, "xlsx-stage")
    styles = (1, 2, 3) if layout is None else (layout["n_xf"], layout["n_xf"] + 1, layout["n_xf"] + 2)
    existing = {s["name"]: s for s in layout["sheets"]} if layout else {}
    frags = []
    specs = []
    for t_no, (sheet, df) in enumerate(tables):
        ob = order_by.get(sheet) if isinstance(order_by, dict) else order_by
        chain = []
        if sheet in existing:
            if sheet_exists == "fail":
                raise ValueError(f"The sheet '{sheet}' exists in '{path}'.")
            if sheet_exists == "append":
                i = 0
                while (sheet if i == 0 else f"{sheet} ({i})") in existing:
                    chain.append(existing[sheet if i == 0 else f"{sheet} ({i})"]["last_row"])
                    i += 1
        rendered, spec = _prepare_table(df, sheet, ob, header, missing, cap_rows, XLSX_MAX_COLS, row_key, None,
                                        autosize, chain, styles, helpers.get(sheet))
        spec["action"] = "append" if chain else ("replace" if sheet in existing else "new")
        frags.append(rendered.mapInArrow(_fragment_fn(stage, t_no, False), _FRAG_DDL))
        specs.append(spec)
    meta = frags[0]
    for f in frags[1:]:
        meta = meta.unionByName(f)
    spec = {"path": path, "tables": specs, "mode": mode, "orientation": orientation, "paper": paper,
            "layout": layout, "marks": marks}
    # the commit sees fragment descriptors only (one per sheet part), never rows
    placeholder = meta.sparkSession.createDataFrame(
        [("", t_no, 0, 0, 0, None, 0, 0, 0) for t_no in range(len(specs))], _FRAG_DDL)
    meta = meta.unionByName(placeholder)
    result = meta.groupBy("wb").applyInPandas(_commit_fn(spec), "wb string, path string, sheets int, rows long")
    return _materialize(result, stage)


def _merge_same_sheet(tables, order_by):
    """Tables sharing a sheet name are written into that sheet one after the other.

    Their number is a column of its own, which orders the rows and is not written.
    """
    merged: dict[str, list] = {}
    for name, df in tables:
        merged.setdefault(name, []).append(df)
    out, orders, helpers = [], {}, {}
    for name, dfs in merged.items():
        ob = order_by.get(name) if isinstance(order_by, dict) else order_by
        if len(dfs) == 1:
            out.append((name, dfs[0]))
            orders[name] = ob
            continue
        (number,) = fresh(dfs[0], "__tno")
        parts = [df.withColumn(number, F.lit(i)) for i, df in enumerate(dfs)]
        u = parts[0]
        for part in parts[1:]:
            u = u.unionByName(part)
        out.append((name, u))
        orders[name], helpers[name] = [number, *(ob or [])], number
    return out, orders, helpers


def write_excel_by_key(df: DataFrame, key: str, folder: str, sheet: str = "default_1", order_by=None,
                       header: bool = True, missing: str | None = None, max_rows: int | None = None,
                       mode: str = "overwrite") -> DataFrame:
    """One workbook per distinct ``key`` value (file ``<folder>/<key>.xlsx``), in parallel.

    A hot key is split over several range partitions, each rendering its own fragments;
    only its commit (byte copy) is a single task.
    """
    cap_rows = max_rows or XLSX_MAX_ROWS
    stage = scratch_dir(df.sparkSession, "xlsx-stage")
    rendered, spec_t = _prepare_table(df, sheet, order_by, header, missing, cap_rows, XLSX_MAX_COLS, None, key, False)
    meta = rendered.mapInArrow(_fragment_fn(stage, 0, True), _FRAG_DDL).filter(F.col("file").isNotNull())
    spec = {"folder": folder, "group": True, "tables": [spec_t], "mode": mode}
    result = meta.groupBy("wb").applyInPandas(_commit_fn(spec), "wb string, path string, sheets int, rows long")
    return _materialize(result, stage)


def _materialize(result: DataFrame, stage: str) -> DataFrame:
    """Run the commit once; its report (one row per workbook) goes to the shared folder, not to
    the driver. The staged fragments are removed once the workbooks are in place."""
    spark = result.sparkSession
    report = scratch_dir(spark, "report") + "/rows"
    result.write.parquet(report)
    remove_tree(spark, stage)
    return spark.read.parquet(report)


def sheets_needed(n_rows: int, header: bool = True, max_rows: int = XLSX_MAX_ROWS) -> int:
    """A8 on the driver."""
    cap = max_rows - (1 if header else 0)
    return max(1, -(-n_rows // cap))


__all__ = ["write_excel", "write_excel_by_key", "sheets_needed", "column_widths", "validate_sheet_name",
           "continuation_name", "XLS_MAX_ROWS", "XLS_MAX_COLS", "json"]


def _commit_into_existing(spec: dict, pdf: pd.DataFrame) -> pd.DataFrame:
    """N3/N4 append: rebuild the workbook around the new fragments (one task, byte copies)."""
    import zipfile

    from . import existing as EX

    path = spec["path"]
    layout = spec["layout"]
    tables = spec["tables"]
    src = zipfile.ZipFile(fsio.open_input_file(path))
    by_name = {s["name"]: s for s in layout["sheets"]}
    actions: dict[str, tuple] = {}  # existing part -> (action, t_no, s_no)
    new_sheets = []  # (name, t_no, s_no)
    for t_no, t in enumerate(tables):
        rows_t = pdf[(pdf["table_no"] == t_no) & pdf["file"].notna()]
        n_sheets = int(rows_t["sheet_no"].max()) + 1 if len(rows_t) else 1
        for s_no in range(n_sheets):
            name = t["sheet"] if s_no == 0 else continuation_name(t["sheet"], s_no)
            if name in by_name and (t["action"] == "replace" or s_no < t["chain"]):
                actions[by_name[name]["part"]] = ("append" if s_no < t["chain"] else "replace", t_no, s_no)
            elif name in by_name:
                actions[by_name[name]["part"]] = ("replace", t_no, s_no)
            else:
                new_sheets.append((name, t_no, s_no))

    def fragments(t_no, s_no):
        frs = pdf[(pdf["table_no"] == t_no) & (pdf["sheet_no"] == s_no) & pdf["file"].notna()].sort_values("first_n")
        return [(_reader(r["file"]), int(r["crc"]) & 0xFFFFFFFF, int(r["raw"]), int(r["comp"]))
                for _, r in frs.iterrows()]

    def new_sheet_pieces(t_no, s_no, with_header=True):
        t = tables[t_no]
        head = parts.sheet_head(t.get("widths")) + (header_xml(t["names"], 0) if (t["header"] and with_header)
                                                    else "")
        tail = parts.sheet_tail(spec.get("orientation"), spec.get("paper"))
        tc, tcrc, traw = deflate_fragment(tail.encode())
        hc, hcrc, hraw = deflate_fragment(head.encode())
        return [(hc, hcrc, hraw, len(hc))] + fragments(t_no, s_no) + [(tc, tcrc, traw, len(tc))]

    wb_part = next((s for s in src.namelist() if s.lower().endswith("workbook.xml") and "/" in s), "xl/workbook.xml")
    folder = wb_part.rsplit("/", 1)[0]
    rels_part = f"{folder}/_rels/{wb_part.rsplit('/', 1)[1]}.rels"
    wb_xml = src.read(wb_part)
    max_id = max([int(x) for x in re.findall(rb'sheetId="(\d+)"', wb_xml)] + [0])
    add_sheets, add_rels, add_types = "", "", ""
    new_parts = []
    # names that neither the workbook nor an earlier append has
    taken, rels_xml, number = set(src.namelist()), src.read(rels_part), 0
    for k, (name, t_no, s_no) in enumerate(new_sheets):
        number += 1
        while f"{folder}/worksheets/cellar_sheet{number}.xml" in taken or f'"rIdCellar{number}"'.encode() in rels_xml:
            number += 1
        part = f"{folder}/worksheets/cellar_sheet{number}.xml"
        new_parts.append((part, t_no, s_no))
        add_sheets += f'<sheet name="{xml_escape_py(name)}" sheetId="{max_id + k + 1}" r:id="rIdCellar{number}"/>'
        add_rels += (f'<Relationship Id="rIdCellar{number}" Type="http://schemas.openxmlformats.org/officeDocument/'
                     f'2006/relationships/worksheet" Target="worksheets/cellar_sheet{number}.xml"/>')
        add_types += (f'<Override PartName="/{part}" ContentType="application/vnd.openxmlformats-officedocument.'
                      'spreadsheetml.worksheet+xml"/>')
    tmp = f"{path}.{uuid.uuid4().hex[:8]}.tmp"
    with fsio.open_output(tmp) as fh:
        z = ZipWriter(fh)
        for info in src.infolist():
            name = info.filename
            if name == "[Content_Types].xml":
                data = src.read(name).replace(b"</Types>", add_types.encode() + b"</Types>")
                z.add_bytes(name, data)
            elif name == wb_part:
                if not re.search(rb'xmlns:r="', wb_xml):
                    raise ValueError("workbook without the relationships namespace")
                z.add_bytes(name, re.sub(rb"</((?:[A-Za-z_][\w.-]*:)?)sheets>",
                                         lambda m: add_sheets.encode() + m.group(0), wb_xml, count=1))
            elif name == rels_part:
                z.add_bytes(name, src.read(name).replace(b"</Relationships>", add_rels.encode() + b"</Relationships>"))
            elif name.lower().endswith("styles.xml") and name.startswith(folder):
                z.add_bytes(name, EX.extend_styles(src.read(name), layout["max_fmt"],
                                                   [parts.FORMAT_DATE, parts.FORMAT_DATETIME, parts.FORMAT_TIME]))
            elif name in actions:
                action, t_no, s_no = actions[name]
                if action == "replace":
                    z.add_pieces(name, new_sheet_pieces(t_no, s_no))
                else:
                    head, tail = EX.split_sheet(src.read(name))
                    hc = EX._deflated(head)
                    tc = EX._deflated(tail)
                    z.add_pieces(name, [hc] + fragments(t_no, s_no) + [tc])
            else:
                z.add_bytes(name, src.read(name))
        for part, t_no, s_no in new_parts:
            z.add_pieces(part, new_sheet_pieces(t_no, s_no))
        z.close(with_marks(src.comment, spec.get("marks")))
    src.close()
    fsio.move(tmp, path)
    rows = int(pdf["n_rows"].fillna(0).sum())
    return pd.DataFrame({"wb": [""], "path": [path], "sheets": [len(layout["sheets"]) + len(new_sheets)],
                         "rows": [rows]})


def write_cells(cells: DataFrame, path: str, sheets: list[str] | None = None, mode: str = "overwrite") -> DataFrame:
    """Long-form cells (sheet, row, col, k, n, s) -> a workbook, one sheet per name.

    Cell XML is rendered by Spark expressions, rows are assembled by a group-by on
    (sheet, row) -- a row holds at most 16 384 cells -- and written through the same
    fragment / commit path as ``write_excel`` (sparse rows keep their row numbers).
    """
    from ..functions.address import col_label
    from .render import STYLE_DATETIME, text_cell, xml_escape

    spark = cells.sparkSession
    if sheets is None:
        sheets = [r[0] for r in cells.select("sheet").distinct().orderBy("sheet").collect()]  # names only
    for name in sheets:
        validate_sheet_name(name)
    stage = scratch_dir(spark, "xlsx-stage")
    ref = F.concat(col_label(F.col("col")), (F.col("row") + 1).cast("string"))
    k, n, s = F.col("k"), F.col("n"), F.col("s")
    cell = (
        F.when(k == "n", F.concat(F.lit('<c r="'), ref, F.lit('"><v>'), n.cast("string"), F.lit("</v></c>")))
        .when(k == "d", F.concat(F.lit('<c r="'), ref, F.lit(f'" s="{STYLE_DATETIME}"><v>'), n.cast("string"),
                                 F.lit("</v></c>")))
        .when(k == "b", F.concat(F.lit('<c r="'), ref, F.lit('" t="b"><v>'),
                                 F.when(n == 1.0, F.lit("1")).otherwise(F.lit("0")), F.lit("</v></c>")))
        .when(k == "e", F.concat(F.lit('<c r="'), ref, F.lit('" t="e"><v>'), xml_escape(s), F.lit("</v></c>")))
        .otherwise(text_cell(ref, F.coalesce(s, F.lit(""))))
    )
    t_no = F.element_at(F.create_map(*[x for i, nm in enumerate(sheets) for x in (F.lit(nm), F.lit(i))]),
                        F.col("sheet"))
    rows = cells.select("sheet", "row", "col", cell.alias("__x")).groupBy("sheet", "row").agg(
        F.sort_array(F.collect_list(F.struct("col", "__x"))).alias("__cs"))
    rows = rows.select(
        t_no.alias("__t"), F.col("row").cast("long").alias("__n"), F.lit(0).cast("long").alias("__sheet"),
        F.concat(F.lit('<row r="'), (F.col("row") + 1).cast("string"), F.lit('">'),
                 F.array_join(F.transform("__cs", lambda c: c["__x"]), ""), F.lit("</row>")).alias("__xml"))
    staged = stable_partitions(rows, ["__n"], group="__t")
    meta = staged.mapInArrow(_fragment_fn(stage, None, False, sparse=True), _FRAG_DDL)
    placeholder = spark.createDataFrame([("", t, 0, 0, 0, None, 0, 0, 0) for t in range(len(sheets))], _FRAG_DDL)
    spec = {"path": path, "mode": mode,
            "tables": [{"sheet": nm, "names": [], "header": False, "widths": None} for nm in sheets]}
    result = meta.unionByName(placeholder).groupBy("wb").applyInPandas(
        _commit_fn(spec), "wb string, path string, sheets int, rows long")
    return _materialize(result, stage)
