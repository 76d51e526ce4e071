"""Workbook sources: read sheets into DataFrames, list sheets, inventory files.

Plan of ``read_excel`` (three Spark jobs, two of them tiny):

1. ``binaryFile`` listing with the file filters (S5).
2. Inference job: each task decodes the selected sheet of its files (the sheets of big ones are
   first cut into pieces, once, in the shared folder) and emits records of (file, column, name, a bounded number of cells). Spark
   computes each cell's lattice bit and ``bit_or``s them by column name -- a partial + final
   hash aggregate (A1, U1-U4). All rows are looked at unless a scan limit is asked for. Only
   the resulting schema (one row per column) reaches the driver.
3. Read job: the same decode; cells are re-keyed by column *name* to the final ordinal, file by
   file, so files may hold a column at different positions. The typed table is a projection
   ``element_at(cells, j)`` with the conversion rules of ``plans.cells``. No shuffle of file
   bytes or rows. There is one path for one file or many, small or big.

Row rules (header, range, empty/hidden rows) run inside the decoding task, where the row
stream is sequential anyway; column rules (range, hidden, names) too. Everything after the
decode is plain DataFrame code.
"""

from __future__ import annotations

import atexit
import fnmatch
import io
import uuid
import zipfile
from dataclasses import asdict, dataclass, field, replace
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import ERROR_PATTERN, unique_names
from ..functions.types import spark_type as _spark_type
from ..operators.ordinal import fresh, quoted, small_side, stable_partitions, with_ordinals
from ..plans import cells as C
from ..session import checkpoint_root, remove_tree, scratch_dir
from .arrowrows import ROWS_DDL, SAMPLE_DDL, RowsBuilder, sample_batch
from . import ooxml

EXCEL_EXTENSIONS = ("xlsx", "xlsm")


# ---------------------------------------------------------------- options


@dataclass
class ReadOptions:
    # None = first sheet with data (S7), str = name (S8), int = 0-based (S9); a list of names or numbers = these
    # sheets one below the other, columns matched by name
    sheet: str | int | list | tuple | range | None = None
    header_row: int | None = 1  # 1-based row holding the names; None = no header row
    column_names: str = "letters"  # without header: "letters" (A, B, ...) or "index" (Col0, Col1, ...)
    empty_prefix: str = "empty_"  # blank header: prefix + suffix
    empty_suffix: str = "letters"  # "letters" (empty_F) or "index" (empty_5)
    first_col: str = ""  # label or 1-based number; "" = open
    last_col: str = ""
    first_row: int | None = None  # 1-based, inclusive
    last_row: int | None = None
    skip_empty_rows: bool = True  # F5
    skip_hidden_rows: bool = True  # F9
    skip_hidden_cols: bool = True  # F10
    skip_empty_cols: bool = False  # F11
    use15: bool = True  # C6
    blank_to_missing: bool = True  # C14
    error_pattern: str | None = ERROR_PATTERN  # C15; None = error cells are missing
    scan_limit: int | None = None  # A2: rows per file that types are inferred from; None = all
    combine: str = "union"  # U1 union / U2 intersection / U3 fail
    row_id: str | None = None  # None, "generated" (W1) or a column label / number (W4)
    path_column: str | None = None  # S11, e.g. "Path"
    schema: dict | None = None  # user schema {name: type name}, skips inference
    on_misfit: str = "failfast"  # or "permissive"
    raw: bool = False  # 1-based row number as first column
    lattice: str = "current"  # "legacy" (A10) or "oldest" (A13)
    unique_ids: bool = False  # W5 on the row id column
    select: dict | None = None  # {name: new name or None} picks, renames and orders; None drops
    types: dict | None = None  # {name: type name} overrides inferred types
    enforce_types: bool = True  # a cell that misfits its ``types`` entry fails (else it is missing)
    displayed: bool = False  # C32: numbers in text columns as their number format shows them
    on_corrupt: str = "failfast"  # S12: "failfast" raises with the path, "skip" leaves the file out

    def validate(self) -> None:
        """option checks before any plan is built."""
        fc, lc = _col_idx(self.first_col, 0), _col_idx(self.last_col, -1)
        if fc < 0:
            raise ValueError(f"first_col={self.first_col!r} is no column (letters, or a number from 1)")
        if lc >= 0 and lc < fc:
            raise ValueError(f"last_col={self.last_col!r} lies left of first_col={self.first_col!r}")
        for r in (self.first_row, self.last_row, self.header_row):
            if r is not None and r < 1:
                raise ValueError(f"rows count from 1, got {r}")
        if self.first_row and self.last_row and self.last_row < self.first_row:
            raise ValueError(f"last_row={self.last_row} lies above first_row={self.first_row}")
        if self.combine not in ("union", "intersection", "fail"):
            raise ValueError(f"Unknown combine mode {self.combine!r}")
        if self.many_sheets:
            if not len(self.sheet):
                raise ValueError("sheet=[] names no sheet")
            if (self.scan_limit is not None or not self.skip_empty_rows or self.combine != "union"
                    or self.on_corrupt != "failfast"):
                raise ValueError("a list of sheets is read whole: no scan limit, kept empty rows, other combine mode "
                                 "or corrupt files left out")

    @property
    def many_sheets(self) -> bool:
        return isinstance(self.sheet, (list, tuple, range))

    def sheets(self) -> list:
        """The sheets to read of a file, in order."""
        return list(self.sheet) if self.many_sheets else [self.sheet]

    def scan_options(self, max_rows: int | None) -> ooxml.ScanOptions:
        rid = None
        if self.row_id not in (None, "generated"):
            rid = _col_idx(self.row_id, -1)
            if rid < 0:
                raise ValueError(f"row_id={self.row_id!r} is no column (letters, or a number from 1)")
        lc = _col_idx(self.last_col, -1)
        return ooxml.ScanOptions(
            first_row=(self.first_row - 1) if self.first_row else 0,
            last_row=(self.last_row - 1) if self.last_row else None,
            first_col=_col_idx(self.first_col, 0),
            last_col=lc if lc >= 0 else None,
            header_row=(self.header_row - 1) if self.header_row else None,
            skip_empty_rows=self.skip_empty_rows,
            skip_hidden_rows=self.skip_hidden_rows,
            skip_hidden_cols=self.skip_hidden_cols,
            rowid_col=rid,
            use15=self.use15,
            blank_to_missing=self.blank_to_missing,
            error_as_missing=self.error_pattern is None,
            max_data_rows=max_rows,
            number_formats=self.displayed,
        )


def _col_idx(text: str | int | None, default: int) -> int:
    """C3 on the driver: number (1-based) or letters -> 0-based; blank -> default."""
    if text is None:
        return default
    s = str(text).strip()
    if not s:
        return default
    try:
        return int(s) - 1
    except ValueError:
        pass
    if not s.isascii() or not s.isalpha() or not s.isupper():
        raise ValueError(f"{s!r} is no column: capital letters or a number")
    v = 0
    for ch in s:
        v = v * 26 + (ord(ch) - 64)
    return v - 1


def col_label_py(i: int) -> str:
    out = ""
    n = i + 1
    while n > 0:
        n, r = divmod(n - 1, 26)
        out = chr(65 + r) + out
    return out


# ---------------------------------------------------------------- files


def list_files(spark: SparkSession, paths, extensions=EXCEL_EXTENSIONS, name_glob: str | None = None,
               name_regex: str | None = None, recursive: bool = True, case_sensitive: bool = False,
               include_hidden: bool = False) -> DataFrame:
    """File discovery. Returns ``binaryFile`` rows (path, modificationTime, length, content).

    ``content`` is only read by Spark when a later step selects it.
    """
    if isinstance(paths, str):
        paths = [paths]
    reader = spark.read.format("binaryFile")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    exts = [e.lower().lstrip(".") for e in extensions or ()]
    if exts and all(e.isalnum() for e in exts):
        # other files are not even listed
        any_case = ["".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in e) for e in exts]
        reader = reader.option("pathGlobFilter", "*.{" + ",".join(any_case) + "}")
    df = reader.load(paths)
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    cmp_name = name if case_sensitive else F.lower(name)
    if exts:
        df = df.filter(F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)).isin(exts))
    if name_glob:
        pat = fnmatch.translate(name_glob if case_sensitive else name_glob.lower())
        df = df.filter(cmp_name.rlike(pat.replace(r"\Z", "$")))
    if name_regex:
        df = df.filter(name.rlike(name_regex if case_sensitive else f"(?i){name_regex}"))
    if not include_hidden:
        df = df.filter(~name.startswith("."))
    return df


def inventory(files: DataFrame) -> DataFrame:
    """(path, format, reason) per file, from magic bytes; reason is NULL for readable files."""

    def fn(batches):
        from ..sinks import fsio

        for b in batches:
            paths = b.column("path").to_pylist()
            fmts, reasons = [], []
            for p in paths:
                with fsio.open_input_file(p) as fh:
                    fmt, why = ooxml.sniff(fh.read(8), p)
                fmts.append(fmt)
                reasons.append(why)
            yield pa.RecordBatch.from_arrays(
                [pa.array(paths, pa.string()), pa.array(fmts, pa.string()), pa.array(reasons, pa.string())],
                names=["path", "format", "reason"],
            )

    return files.select("path").mapInArrow(fn, "path string, format string, reason string")


def rejects(files: DataFrame, opts: ReadOptions | None = None) -> DataFrame:
    """S6 + S12: (path, reason) for every file the reader cannot use: not a workbook, a format
    we do not decode, a missing sheet, or corrupt sheet XML (the whole sheet is checked)."""
    opts = opts or ReadOptions()
    so = opts.scan_options(None)

    def fn(batches):
        for b in batches:
            paths, reasons = [], []
            for p, content in zip(b.column("path").to_pylist(), b.column("content").to_pylist()):
                fmt, why = ooxml.sniff((content or b"")[:8], p)
                if why is None:
                    try:
                        zf = ooxml.open_zip(content)
                        wb = ooxml.open_workbook(zf)
                        sst = ooxml.load_shared_strings(zf, wb.shared_strings_part)
                        for wanted in opts.sheets():
                            for _ in ooxml.scan_sheet(zf, wb, _select_sheet(zf, wb, wanted), so, sst):
                                pass
                    except Exception as exc:  # noqa: BLE001 - this is the report
                        why = f"{type(exc).__name__}: {exc}"
                if why is not None:
                    paths.append(p)
                    reasons.append(why)
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(reasons, pa.string())],
                                             names=["path", "reason"])

    return files.select("path", "content").mapInArrow(fn, "path string, reason string")


# ---------------------------------------------------------------- sheets


def _select_sheet(zf, wb, sel):
    if not wb.sheets:
        raise ooxml.CorruptWorkbook("workbook without sheets")
    if sel is None:
        sst_cache = {}

        def sst():
            if "v" not in sst_cache:
                sst_cache["v"] = ooxml.load_shared_strings(zf, wb.shared_strings_part)
            return sst_cache["v"]

        for sh in wb.sheets:
            if ooxml.sheet_has_data(zf, wb, sh, sst):
                return sh
        return wb.sheets[0]
    if isinstance(sel, int):
        if sel < 0 or sel >= len(wb.sheets):
            raise ValueError(f"The selected sheet index {sel} does not exist (the workbook has "
                             f"{len(wb.sheets)} sheets)")
        return wb.sheets[sel]
    for sh in wb.sheets:
        if sh.name == sel:
            return sh
    raise ValueError(f"The selected sheet '{sel}' does not exist")


def sheets_table(files: DataFrame, with_data_flag: bool = True) -> DataFrame:
    """One small record per sheet: (path, sheet_pos, sheet, state, date1904, has_data, hidden_cols).

    ``hidden_cols`` (A5) comes from the ``<cols>`` head of the sheet XML (parsing stops at
    ``<sheetData>``).

    ``has_data`` is evaluated like the reference's first-sheet search: sheets are opened in
    order until one with content is found; later sheets are NULL (not examined).
    """

    def fn(batches):
        from ..sinks import fsio

        for b in batches:
            out = {k: [] for k in ("path", "sheet_pos", "sheet", "state", "date1904", "has_data", "hidden_cols")}
            for p in b.column("path").to_pylist():
                # the zip directory, the workbook part and the head of each sheet: not the file's content
                zf = zipfile.ZipFile(fsio.open_input_file(p))
                wb = ooxml.open_workbook(zf, with_styles=False)
                found = not with_data_flag
                cache = {}

                def sst():
                    if "v" not in cache:
                        cache["v"] = ooxml.load_shared_strings(zf, wb.shared_strings_part)
                    return cache["v"]

                for sh in wb.sheets:
                    flag = None
                    if not found:
                        flag = ooxml.sheet_has_data(zf, wb, sh, sst)
                        found = flag
                    out["hidden_cols"].append(sorted(ooxml.hidden_columns(zf, sh)))
                    out["path"].append(p)
                    out["sheet_pos"].append(sh.pos)
                    out["sheet"].append(sh.name)
                    out["state"].append(sh.state)
                    out["date1904"].append(wb.date1904)
                    out["has_data"].append(flag)
                zf.fp.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["path"], pa.string()), pa.array(out["sheet_pos"], pa.int32()),
                 pa.array(out["sheet"], pa.string()), pa.array(out["state"], pa.string()),
                 pa.array(out["date1904"], pa.bool_()), pa.array(out["has_data"], pa.bool_()),
                 pa.array(out["hidden_cols"], pa.list_(pa.int32()))],
                names=["path", "sheet_pos", "sheet", "state", "date1904", "has_data", "hidden_cols"],
            )

    return files.select("path").mapInArrow(
        fn, "path string, sheet_pos int, sheet string, state string, date1904 boolean, has_data boolean, "
            "hidden_cols array<int>"
    )


def select_first_sheet(sheets: DataFrame) -> DataFrame:
    """First sheet with data, else the first sheet -- per path (tiny aggregate)."""
    return sheets.groupBy("path").agg(
        F.coalesce(F.min(F.when(F.col("has_data"), F.col("sheet_pos"))), F.min("sheet_pos")).alias("sheet_pos")
    ).join(sheets.select("path", "sheet_pos", "sheet"), ["path", "sheet_pos"])


def list_sheets(spark: SparkSession, paths, path_column: str = "Path", sheet_column: str = "Sheet",
                **file_opts) -> DataFrame:
    """(Path, Sheet) in workbook order, duplicate-free per file, files in path order."""
    files = list_files(spark, paths, **file_opts)
    sheets = sheets_table(files, with_data_flag=False)
    dedup = sheets.groupBy("path", "sheet").agg(F.min("sheet_pos").alias("sheet_pos"))
    return dedup.select(F.col("path").alias(path_column), F.col("sheet").alias(sheet_column), "sheet_pos")


# ---------------------------------------------------------------- decoding tasks


def _header_text(cell) -> str | None:
    """text of a header cell; blank -> None."""
    _, k, n, s = cell
    if k in ("s", "e"):
        txt = s
    elif k == "b":
        txt = "true" if n == 1.0 else "false"
    elif k == "n":
        txt = str(int(n)) if n == int(n) and abs(n) < 2**63 else repr(n)
    else:
        txt = repr(n)
    if txt is None or not txt.strip(" \t\r\n\x00\x0b\x0c"):
        return None
    return txt


class _Namer:
    """Per-file column names.

    Header texts (F4: blank -> none) are made unique among themselves in position order;
    a column without header text gets a generated name (prefix + letter of its original
    index, or an index), made unique against the header names.
    """

    def __init__(self, opts: ReadOptions, so: ooxml.ScanOptions, hidden: set[int]):
        import bisect

        self.opts, self.so, self.hidden = opts, so, hidden
        self._sorted_hidden = sorted(hidden)
        self._bisect = bisect.bisect_left
        self.header: dict[int, str] = {}
        self.taken: set[str] = set()
        self.cache: dict[int, str] = {}

    def set_header(self, cells):
        hdr = {}
        for cell in cells:
            t = _header_text(cell)
            if t is not None and self.is_column(cell[0]):
                hdr[cell[0]] = t
        positions = sorted(hdr)
        uniq = unique_names([hdr[p] for p in positions])
        self.header = dict(zip(positions, uniq))
        self.taken = set(uniq)
        self.cache = {}

    def is_column(self, pos: int) -> bool:
        so = self.so
        if pos < so.first_col or (so.last_col is not None and pos > so.last_col):
            return False
        if so.skip_hidden_cols and pos in self.hidden:
            return False
        return not (so.rowid_col is not None and pos == so.rowid_col)

    def visible_index(self, p: int) -> int:
        so = self.so
        cnt = p - so.first_col
        if so.skip_hidden_cols:
            cnt -= self._bisect(self._sorted_hidden, p) - self._bisect(self._sorted_hidden, so.first_col)
        if so.rowid_col is not None and so.first_col <= so.rowid_col < p and not (
                so.skip_hidden_cols and so.rowid_col in self.hidden):
            cnt -= 1
        return cnt

    def generated(self, p: int) -> str:
        o = self.opts
        if o.header_row is not None:
            suffix = col_label_py(p) if o.empty_suffix == "letters" else str(self.visible_index(p))
            return o.empty_prefix + suffix
        if o.column_names == "index":
            return f"Col{self.visible_index(p)}"
        return col_label_py(p)

    def name_of(self, p: int) -> str:
        if p in self.header:
            return self.header[p]
        got = self.cache.get(p)
        if got is None:
            g = self.generated(p)
            got, k = g, 1
            while got in self.taken:
                k += 1
                got = f"{g}_{k}"
            self.cache[p] = got
        return got


def _positions(so: ooxml.ScanOptions, hidden: set[int], width: int) -> list[int]:
    out = []
    hi = width if so.last_col is None else so.last_col + 1
    for p in range(so.first_col, hi):
        if so.skip_hidden_cols and p in hidden:
            continue
        if so.rowid_col is not None and p == so.rowid_col:
            continue
        out.append(p)
    return out


class _Source:
    """One sheet being decoded: names first, then data rows.

    ``rows()`` yields (row_idx, seq, hidden, cells, rowid); ``namer`` knows all column names by
    the time the first row comes out. Rows above a header row wait for it (at most as many as
    stand above the header). ``part``: the number in front of the rows' ``seq``.
    """

    def __init__(self, path, wb, sheet, opts: ReadOptions, so: ooxml.ScanOptions, part: int = 0):
        self.path, self.wb, self.sheet, self.opts, self.so, self.part = path, wb, sheet, opts, so, part
        self.hidden: set[int] = set()
        self.namer = _Namer(opts, so, self.hidden)
        self.width = 0
        self.split, self.take = 0, None  # a split's number, and how many of its rows are wanted
        self.items = iter(())

    def _hidden(self, cols):
        self.hidden = set(cols)
        self.namer = _Namer(self.opts, self.so, self.hidden)

    def rows(self):
        rows = self._all_rows() if self.take is None else islice(self._all_rows(), self.take)
        if not self.part:
            return rows
        return ((r, (self.part << SEQ_SPLIT_SHIFT) | seq, *rest) for r, seq, *rest in rows)

    def _all_rows(self):
        pending = []
        for item in self.items:
            if item[0] == "hidden_cols":
                self._hidden(item[1])
                continue
            r, seq, is_hidden, cells, rowid, is_header = item
            if cells:
                self.width = max(self.width, cells[-1][0] + 1)
            if is_header:
                self.namer.set_header(cells)
                yield from pending
                pending = []
            elif self.so.header_row is not None and r < self.so.header_row:
                pending.append((r, seq, is_hidden, cells, rowid))
            else:
                yield r, seq, is_hidden, cells, rowid
        yield from pending


def _open_sheets(zf, path, opts: ReadOptions, so: ooxml.ScanOptions):
    """(sources of the sheets that are read, shared strings) of a workbook."""
    wb = ooxml.open_workbook(zf)
    found = [_Source(path, wb, _select_sheet(zf, wb, wanted), opts, so, i) for i, wanted in enumerate(opts.sheets())]
    return found, ooxml.load_shared_strings(zf, wb.shared_strings_part)


class _LastWorkbook:
    """The workbook that a task opened last: its sheets' pieces come one after the other, and what is common
    to them is read once."""

    def __init__(self):
        self.path = self.fh = None

    def open(self, path: str, **parts):
        if path != self.path:
            from ..sinks import fsio

            self.close()
            self.fh = fsio.open_input_file(path)
            self.zf = zipfile.ZipFile(self.fh)
            self.wb = ooxml.open_workbook(self.zf, **parts)
            self.path, self.sst = path, None
        return self.zf, self.wb

    def strings(self) -> list[str]:
        if self.sst is None:
            self.sst = ooxml.load_shared_strings(self.zf, self.wb.shared_strings_part)
        return self.sst

    def close(self):
        if self.fh is not None:
            self.fh.close()
        self.path = self.fh = None


def _whole_files(batches, opts: ReadOptions, so: ooxml.ScanOptions):
    """The sources of the files of (path, content) batches.

    With ``on_corrupt="skip"`` a file that cannot be opened or whose sheet XML is corrupt is
    left out (``rejects`` lists such files with the reason); otherwise the error names the path.
    """
    for b in batches:
        for p, content in zip(b.column("path").to_pylist(), b.column("content").to_pylist()):
            try:
                zf = ooxml.open_zip(content)
                found, sst = _open_sheets(zf, p, opts, so)
                if opts.on_corrupt == "skip":
                    # a corrupt sheet must not leave half a file behind: check it whole first
                    for _ in ooxml.scan_sheet(zf, found[0].wb, found[0].sheet, so, sst):
                        pass
            except Exception as exc:  # noqa: BLE001 - reported with the path
                if opts.on_corrupt == "skip":
                    continue
                raise type(exc)(f"{p}: {exc}") from exc
            for src in found:
                src.items = ooxml.iter_data_rows(zf, src.wb, src.sheet, so, sst)
                yield src


class _Piece:
    """A piece of a sheet's XML in place of the zip that the sheet is in."""

    def __init__(self, data: bytes):
        self.data = data

    def open(self, part: str):
        return io.BytesIO(self.data)


def _cut_fn(opts_dict: dict, stage: str, piece_bytes: int):
    """(path, nth, split, piece) of (path, nth): the XML of a file's sheet cut between rows into files of the shared folder.

    A deflated sheet can only be read from its beginning, so it is inflated once here and not
    once more for every split. Each piece has the sheet's head. Rows without numbers stay together.
    """
    opts = ReadOptions(**opts_dict)

    def pieces(zf, part, cuttable):
        head, held, size, tag = b"", [], 0, None
        close = b""
        with zf.open(part) as stream:
            for chunk in ooxml._read_raw(stream, part):
                if tag is None:
                    head += chunk
                    m = ooxml._SHEETDATA_RE.search(head)
                    if not m:
                        continue
                    tag, close = b"<" + m.group(1) + b"row ", b"</" + m.group(1) + b"sheetData>"
                    head, chunk = head[:m.end()], head[m.end():]
                held.append(chunk)
                size += len(chunk)
                if cuttable and size >= piece_bytes:
                    data = b"".join(held)
                    # numbered rows have an attribute, so their tag goes on after a space
                    at = data.rfind(tag)
                    if at > 0:
                        yield head + data[:at] + close
                        data = data[at:]
                    held, size = [data], len(data)
        yield head + b"".join(held)

    def fn(batches):
        from ..sinks import fsio

        book, sheets = _LastWorkbook(), opts.sheets()
        for b in batches:
            for path, nth in zip(b.column("path").to_pylist(), b.column("nth").to_pylist()):
                written = []
                try:
                    zf, wb = book.open(path, with_styles=False)
                    sheet = _select_sheet(zf, wb, sheets[nth])
                    for data in pieces(zf, sheet.part, ooxml.rows_are_numbered(zf, sheet)):
                        written.append(f"{stage}/{uuid.uuid4().hex}.xml")
                        fsio.write_bytes(written[-1], data)
                except Exception as exc:  # noqa: BLE001 - reported with the path
                    if opts.on_corrupt == "skip":
                        continue
                    raise type(exc)(f"{path}: {exc}") from exc
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(written)), pa.array([nth] * len(written), pa.int32()),
                                                  pa.array(range(len(written)), pa.int32()), pa.array(written, pa.string())],
                                                 ["path", "nth", "split", "piece"])
        book.close()

    return fn


def _file_splits(batches, opts: ReadOptions, so: ooxml.ScanOptions):
    """A source per (path, nth, split, piece, take): one piece of a big file's sheet.

    The task opens the file itself for its small parts and parses the piece. Sheets whose rows carry
    no number are one piece.
    """
    from ..sinks import fsio

    book, sheets = _LastWorkbook(), opts.sheets()
    for b in batches:
        for path, nth, split, piece, take in zip(*[b.column(c).to_pylist() for c in ("path", "nth", "split", "piece", "take")]):
            zf, wb = book.open(path)
            src = _Source(path, wb, _select_sheet(zf, wb, sheets[nth]), opts, so)
            sst = book.strings()
            src.split, src.take = split, take
            rows = _Piece(fsio.read_bytes(piece))
            if not ooxml.rows_are_numbered(rows, src.sheet):
                src.items, src.part = ooxml.iter_data_rows(rows, src.wb, src.sheet, so, sst), split
                yield src
                continue
            header = []
            if so.header_row is not None:
                for item in ooxml.scan_sheet(zf, src.wb, src.sheet, replace(so, last_row=so.header_row), sst):
                    if item[0] == so.header_row:
                        header = item[2]
            src.items = _piece_rows(rows, src, sst, split, header)
            yield src
    book.close()


def _piece_rows(zf: _Piece, src: _Source, sst, split: int, header: list):
    so = src.so
    local = 0
    for item in ooxml.scan_sheet(zf, src.wb, src.sheet, so, sst):
        if item[0] == "hidden_cols":
            yield item
            if so.header_row is not None:
                yield so.header_row, -1, False, header, None, True
            continue
        r, is_hidden, cells, rowid = item
        if r == so.header_row or r < so.first_row:
            continue
        if so.last_row is not None and r > so.last_row:
            break
        if (not cells and rowid is None) or (is_hidden and so.skip_hidden_rows):
            continue
        yield r, (split << SEQ_SPLIT_SHIFT) | local, is_hidden, cells, rowid, False
        local += 1


#: Cells that an inference task holds before it hands them on.
SAMPLE_CELLS = 1 << 16


def _sample_fn(opts_dict: dict, sources):
    opts = ReadOptions(**opts_dict)
    so = opts.scan_options(opts.scan_limit)

    def fn(batches):
        records, kept = [], 0
        for src in sources(batches, opts, so):
            cols: dict[int, list] = {}
            held, seen = 0, set()
            for _, _, _, cells, _ in src.rows():
                for c in cells:
                    if src.namer.is_column(c[0]):
                        cols.setdefault(c[0], []).append((c[1], c[2], c[3]))
                held += len(cells)
                if held >= SAMPLE_CELLS:
                    yield sample_batch([(src.path, pos, src.namer.name_of(pos), src.wb.date1904, got)
                                        for pos, got in cols.items()])
                    seen.update(cols)
                    cols, held = {}, 0
            for pos in _positions(so, src.hidden, src.width):
                if pos in cols or pos not in seen:
                    records.append((src.path, pos, src.namer.name_of(pos), src.wb.date1904, cols.get(pos, [])))
            kept += held
            if len(records) >= 4096 or kept >= SAMPLE_CELLS:
                yield sample_batch(records)
                records, kept = [], 0
        if records:
            yield sample_batch(records)

    return fn


def _rows_fn(opts_dict: dict, ordinals: dict[str, int] | None, sources=_whole_files, known_only: bool = False):
    """Full decode; cells are re-keyed to the final column ordinal (or kept by position).

    A column that has no ordinal because it only begins after an explicit scan limit, or (with
    ``known_only``) in a file that came later, fails the read: it is never dropped without a word.
    """
    opts = ReadOptions(**opts_dict)
    so = opts.scan_options(None)
    strict = ((known_only or opts.scan_limit is not None) and not opts.schema and opts.combine == "union"
              and not opts.skip_empty_cols and not opts.select)

    def fn(batches):
        out = RowsBuilder()
        for src in sources(batches, opts, so):
            rekey: dict[int, int | None] = {}
            for r, seq, is_hidden, cells, rowid in src.rows():
                if ordinals is not None:
                    new_cells = []
                    for c in cells:
                        pos = c[0]
                        if pos not in rekey:
                            name = src.namer.name_of(pos) if src.namer.is_column(pos) else None
                            rekey[pos] = ordinals.get(name)
                            if strict and name is not None and rekey[pos] is None:
                                raise ValueError(f"{src.path}: column {name!r} (row {r + 1}) is not among the columns "
                                                 "inferred so far; raise the scan limit or give a schema")
                        if rekey[pos] is not None:
                            new_cells.append((rekey[pos], c[1], c[2], c[3]))
                    cells = new_cells
                out.add(src.path, src.sheet.name, r, seq, is_hidden, src.wb.date1904, rowid, cells)
                if out.full():
                    yield out.flush()
        if len(out):
            yield out.flush()

    return fn


SPLIT_BYTES = 8 << 20  # compressed bytes of a workbook per parallel split of its sheet
SEQ_SPLIT_SHIFT = 40  # seq of a split row = split << 40 | position in the split


#: Bytes of XML per compressed byte, about: sets the size of pieces.
INFLATION = 8


def _splits(files: DataFrame, opts: ReadOptions) -> tuple[DataFrame, DataFrame]:
    """Files up to the split size, and (path, nth, split, piece, take) of the bigger ones.

    Pieces are cut once for ``files``, whatever is then read from them, and go when the driver ends.
    """
    spark = files.sparkSession
    split_bytes = int(spark.conf.get("cellar.read.splitBytes", str(SPLIT_BYTES)))
    small, large = files.filter(F.col("length") <= split_bytes), files.filter(F.col("length") > split_bytes)
    known = files.__dict__.setdefault("_cellar_pieces", {})
    key = (opts.many_sheets, tuple(opts.sheets()), opts.on_corrupt, split_bytes)
    if key not in known:
        ddl = "path string, nth int, split int, piece string"
        if large.select("path").isEmpty():
            known[key] = spark.createDataFrame([], ddl)
        else:
            stage = scratch_dir(spark, "pieces")
            atexit.register(_drop, spark, stage)
            par = spark.sparkContext.defaultParallelism
            each = large.select("path", F.explode(F.sequence(F.lit(0), F.lit(len(opts.sheets()) - 1))).alias("nth"))
            cut = each.repartition(par * 2).mapInArrow(_cut_fn(asdict(opts), stage, split_bytes * INFLATION), ddl)
            if opts.many_sheets:
                # a file's pieces are numbered on over its sheets; one row per piece
                order = Window.partitionBy("path").orderBy("nth", "split")
                cut = cut.checkpoint().withColumn("split", F.row_number().over(order) - 1)
            known[key] = cut.checkpoint()
    return small, known[key].withColumn("take", F.lit(None).cast("long"))


def _drop(spark: SparkSession, folder: str) -> None:
    if spark.sparkContext._jsc is not None:  # else the session ended before
        remove_tree(spark, folder)


def _over_splits(splits: DataFrame, fn, ddl: str) -> DataFrame:
    return splits.repartition(splits.sparkSession.sparkContext.defaultParallelism * 2).mapInArrow(fn, ddl)


def _decode(files: DataFrame, opts: ReadOptions, make, ddl: str, limit: int | None = None) -> DataFrame:
    """``make(sources)`` run over all files: files up to the split size one task each (content
    from ``binaryFile``), bigger ones as parallel pieces; ``limit``: the first data
    rows of each file only."""
    small, big = _splits(files, opts)
    if opts.on_corrupt == "skip":
        big = _sound(big, opts)
    if limit is not None:
        big = _first_rows(big, opts, limit)
    one = small.select("path", "content").mapInArrow(make(_whole_files), ddl)
    return one.unionByName(_over_splits(big, make(_file_splits), ddl))


def _sound(splits: DataFrame, opts: ReadOptions) -> DataFrame:
    """The splits of files all of whose splits can be read. A file is judged by all its splits, each of
    which is tried in a task of its own."""
    so = opts.scan_options(None)

    def votes(batches):
        for b in batches:
            bad = []
            for i in range(b.num_rows):
                try:
                    for src in _file_splits([b.slice(i, 1)], opts, so):
                        for _ in src.rows():
                            pass
                except Exception:  # noqa: BLE001 - the file is left out, ``rejects`` says why
                    bad.append(b.column("path")[i].as_py())
            yield pa.RecordBatch.from_arrays([pa.array(bad, pa.string())], ["path"])

    checkpoint_root(splits.sparkSession)
    bad = _over_splits(splits, votes, "path string").distinct().checkpoint()
    return splits.join(bad, "path", "left_anti")


def _first_rows(splits: DataFrame, opts: ReadOptions, limit: int) -> DataFrame:
    """A2: the splits that hold the first ``limit`` data rows of their file, with the rows to take of each.

    The first splits are counted alone, as they mostly hold enough; only files that are not done
    with then have their other splits counted, in parallel, up to the limit each.
    """
    so = opts.scan_options(None)

    def count(batches):
        for src in _file_splits(batches, opts, so):
            yield pa.RecordBatch.from_arrays([pa.array([src.path]), pa.array([src.split], pa.int32()),
                                              pa.array([sum(1 for _ in src.rows())], pa.int64())], ["path", "split", "rows"])

    def counted(some: DataFrame) -> DataFrame:
        return _over_splits(some.withColumn("take", F.lit(limit).cast("long")), count, "path string, split int, rows long").checkpoint()

    checkpoint_root(splits.sparkSession)
    first = counted(splits.where("split = 0"))
    short = first.where(F.col("rows") < limit).select("path")
    rest = counted(splits.where("split > 0").join(short, "path", "left_semi"))
    # one row per split of a file
    w = Window.partitionBy("path").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    known = first.unionByName(rest).withColumn("take", F.lit(limit) - F.coalesce(F.sum("rows").over(w), F.lit(0)))
    wanted = known.where("take > 0 AND (rows > 0 OR split = 0)").select("path", "split", F.col("take").cast("long").alias("take"))
    return splits.drop("take").join(wanted, ["path", "split"])


def decode_rows(files: DataFrame, opts: ReadOptions, ordinals: dict[str, int] | None) -> DataFrame:
    """Decoded rows of all files, cells keyed by column ordinal."""
    if opts.many_sheets:
        opts.validate()
    od = asdict(opts)
    if opts.skip_empty_rows:
        return _decode(files, opts, lambda sources: _rows_fn(od, ordinals, sources), ROWS_DDL)
    small, big = _splits(files, opts)
    one = small.select("path", "content").mapInArrow(_rows_fn(od, ordinals, _whole_files), ROWS_DDL)
    if big.isEmpty():
        return one
    return one.unionByName(_with_empty_rows(big, opts, ordinals))


def _with_empty_rows(big: DataFrame, opts: ReadOptions, ordinals: dict[str, int] | None) -> DataFrame:
    """F6 + F7 over splits: the rows with cells are decoded in parallel, the grid of all rows is joined to them."""
    from ..operators.profile import materialise_empty_rows

    so = opts.scan_options(None)
    if opts.on_corrupt == "skip":
        big = _sound(big, opts)
    # hidden rows with cells must be known to be left out of the grid
    od = asdict(replace(opts, skip_empty_rows=True, skip_hidden_rows=False, scan_limit=None))
    rows = _over_splits(big, _rows_fn(od, ordinals, _file_splits), ROWS_DDL)
    about = small_side(rows.groupBy("path").agg(F.max("sheet").alias("s"), F.max("date1904").alias("d")))
    grid = materialise_empty_rows(rows, so.first_row, so.last_row, opts.skip_hidden_rows, all_present=True, files=big)
    if so.header_row is not None:
        grid = grid.where(F.col("row_idx") != so.header_row)
    full = grid.join(about, "path", "left").select(
        "path", F.coalesce("sheet", "s").alias("sheet"), "row_idx", "hidden", F.coalesce("date1904", "d", F.lit(False)).alias("date1904"),
        "rowid", "cells")
    # the rows are numbered anew, as empty ones count
    numbered = with_ordinals(stable_partitions(full, ["row_idx"], group="path"), "seq", group="path")
    return numbered.select(*[F.col(f.name).cast(f.dataType) for f in rows.schema.fields])


# ---------------------------------------------------------------- schema inference


@dataclass
class ColumnSpec:
    name: str
    type: str
    has_type: bool = True
    files: int = 0
    order: tuple = field(default_factory=tuple)
    forced: bool = False  # the type is the caller's, not inferred
    formats: list | None = None  # C32: number format codes that occur
    mask: int = 0  # the lattice bits seen


def _lattice_col(opts: ReadOptions):
    return {"legacy": C.legacy_lattice_type, "oldest": C.oldest_lattice_type}.get(opts.lattice, C.lattice_type)


def infer_schema(files: DataFrame, opts: ReadOptions) -> list[ColumnSpec]:
    """A1-A4 + U1-U4: the combined schema, computed by Spark from the files' cells."""
    # empty rows have no types, and the scan limit counts rows alike in small and big files
    opts = replace(opts, skip_empty_rows=True)
    od = asdict(opts)
    sample = _decode(files, opts, lambda sources: _sample_fn(od, sources), SAMPLE_DDL, opts.scan_limit)
    err = opts.error_pattern
    per_col = sample.select(
        "path", "col", "name",
        C.mask_of_array(F.col("cells"), F.col("date1904"), err, opts.blank_to_missing).alias("mask"),
        F.array_distinct(F.transform(F.filter("cells", lambda c: (c["k"] == "n") & c["s"].isNotNull()), lambda c: c["s"]))
        .alias("formats"),
    )
    # column order = first appearance in (path, position) order; no file numbering needed
    n_files = files.select("path").count()  # listing only, no content read
    agg = per_col.groupBy("name").agg(
        F.bit_or("mask").alias("mask"),
        F.min(F.struct("path", "col")).alias("first"),
        F.countDistinct("path").alias("files"),
        F.array_distinct(F.flatten(F.collect_set("formats"))).alias("formats"),
    )
    rows = agg.withColumn("type", _lattice_col(opts)(F.col("mask"))).collect()
    specs = []
    for r in sorted(rows, key=lambda x: (x["first"]["path"], x["first"]["col"])):
        specs.append(ColumnSpec(r["name"], r["type"], r["mask"] != 0, r["files"],
                                (r["first"]["path"], r["first"]["col"]), formats=sorted(r["formats"]), mask=int(r["mask"])))
    if opts.combine == "intersection":
        specs = [s for s in specs if s.files == n_files]
    elif opts.combine == "fail":
        odd = [s.name for s in specs if s.files != n_files]
        if odd:
            raise ValueError(f"The files have different columns: {odd[:20]}")
    if opts.skip_empty_cols:
        specs = [s for s in specs if s.has_type]
    return specs


# ---------------------------------------------------------------- read


def read_rows(spark: SparkSession, paths, opts: ReadOptions | None = None, ordinals=None, **file_opts) -> DataFrame:
    """Decoded sheet rows (path, sheet, row_idx, seq, hidden, date1904, rowid, cells)."""
    opts = opts or ReadOptions()
    files = list_files(spark, paths, **file_opts)
    return decode_rows(files, opts, ordinals)


def read_excel(spark: SparkSession, paths, opts: ReadOptions | None = None, **kw) -> DataFrame:
    """Read the selected sheet of every matching workbook into one typed DataFrame."""
    file_keys = {"extensions", "name_glob", "name_regex", "recursive", "case_sensitive", "include_hidden"}
    file_opts = {k: kw.pop(k) for k in list(kw) if k in file_keys}
    opts = opts or ReadOptions(**kw)
    opts.validate()
    files = list_files(spark, paths, **file_opts)
    if opts.schema:
        specs = [ColumnSpec(n, t.upper()) for n, t in opts.schema.items()]
    else:
        specs = infer_schema(files, opts)
    specs = transform_columns(specs, opts)
    ordinals = {s.name: j for j, s in enumerate(specs)}
    rows = decode_rows(files, opts, ordinals)
    out = project(rows, specs, opts)
    names = {old: new for old, new in (opts.select or {}).items() if new is not None and new != old}
    return out.withColumnsRenamed(names) if names else out


def transform_columns(specs: list[ColumnSpec], opts: ReadOptions) -> list[ColumnSpec]:
    """pick, drop, order and retype columns before anything is decoded for them.

    ``select`` names the columns to keep, in order, with their new names; columns mapped to
    ``None`` go. If it only drops, the others stay as they are. Unknown names fail.
    """
    known = {s.name: s for s in specs}
    unknown = [n for n in [*(opts.select or {}), *(opts.types or {})] if n not in known]
    if unknown:
        raise ValueError(f"no such columns: {unknown}")
    if opts.select:
        kept = [n for n, new in opts.select.items() if new is not None]
        dropped = {n for n, new in opts.select.items() if new is None}
        specs = [known[n] for n in kept] if kept else [s for s in specs if s.name not in dropped]
        new = [opts.select.get(s.name) or s.name for s in specs]
        if len(set(new)) != len(new):
            raise ValueError(f"columns with one name: {sorted(n for n in set(new) if new.count(n) > 1)}")
    for s in specs:
        if s.name in (opts.types or {}):
            s.type, s.forced = opts.types[s.name].upper(), True
    return specs


def project(rows: DataFrame, specs: list[ColumnSpec], opts: ReadOptions, pick=None) -> DataFrame:
    """Typed projection of decoded rows: one ``element_at`` + conversion per column.

    ``pick(j)`` overrides how the cell of output column j is found (default: map key j).
    """
    names = [s.name for s in specs]
    if opts.path_column and opts.path_column in names:
        raise ValueError(f"The path column name '{opts.path_column}' collides with a column of the table")
    where = F.concat(F.col("path"), F.lit(" row "), (F.col("row_idx") + 1).cast("string"))
    # one struct column per output column, then timestamp and bit stages: all code-generated
    if pick is None:
        picks = [F.element_at(F.col("cells"), F.lit(j)).alias(f"__c{j}") for j in range(len(specs))]
    else:
        picks = [pick(j).alias(f"__c{j}") for j in range(len(specs))]
    rows = rows.select("path", "row_idx", "seq", "date1904", "rowid", *picks)
    rows, views = C.staged_typing(rows, [f"__c{j}" for j in range(len(specs))], F.col("date1904"),
                                  opts.error_pattern, opts.blank_to_missing)
    cols = []
    for s, v in zip(specs, views):
        misfit = opts.on_misfit if not s.forced else "failfast" if opts.enforce_types else "permissive"
        cols.append(C.value_typed(v, s.type, opts.error_pattern, misfit, where, s.formats).alias(s.name))
    lead = []
    if opts.raw:
        lead.append((F.col("row_idx") + 1).cast("int").alias("row"))
    if opts.row_id not in (None, "generated"):
        lead.append(C.render_cell(F.col("rowid"), F.col("date1904"), opts.error_pattern).alias("RowID"))
    tail = []
    if opts.path_column:
        tail.append(F.col("path").alias(opts.path_column))
    out = rows.select(*lead, *cols, *tail)
    if opts.row_id is None or (opts.row_id != "generated" and not opts.unique_ids):
        return out
    path, seq = fresh(out, "__path", "__seq")
    out = rows.select(*lead, *cols, *tail, F.col("path").alias(path), F.col("seq").alias(seq))
    if opts.row_id == "generated":
        from ..operators.ids import generated_row_ids

        out = generated_row_ids(out, path, seq, "RowID").drop(path, seq)
    else:
        # Repeated ids get _1, _2, ... in file then row order
        from ..operators.ids import make_unique

        out = make_unique(out, "RowID", [path, seq]).drop(path, seq)
    return out.select("RowID", *[quoted(c) for c in out.columns if c != "RowID"])


def spark_type(type_name: str) -> T.DataType:
    return _spark_type(type_name)
