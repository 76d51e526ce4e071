"""Executor-side decoding of OOXML workbooks (xlsx / xlsm) with the standard library only.

Everything here runs inside Spark tasks (``mapInArrow``); the driver never sees file bytes.
The sheet XML is inflated and parsed as a stream (bounded memory), rows are emitted in
Arrow batches as the sparse intermediate form

    row_idx INT, hidden BOOLEAN, cells MAP<INT, STRUCT<k STRING, n DOUBLE, s STRING>>

with the cell kinds of ``functions.types`` (n, d, b, s, e).
"""

from __future__ import annotations

import html
import io
import posixpath
import re
import zipfile
from dataclasses import dataclass, field
from datetime import date, datetime
from xml.etree.ElementTree import XMLPullParser

from ..functions.display import BUILTIN_NUMBER_FORMATS
from ..functions.numbers import round15_value

# Namespaces of transitional and strict OOXML.
_NS_MAIN = (
    "http://schemas.openxmlformats.org/spreadsheetml/2006/main",
    "http://purl.oclc.org/ooxml/spreadsheetml/main",
)
_NS_REL = (
    "http://schemas.openxmlformats.org/officeDocument/2006/relationships",
    "http://purl.oclc.org/ooxml/officeDocument/relationships",
)
_NS_PKG_REL = "http://schemas.openxmlformats.org/package/2006/relationships"

# Built-in number format ids that display dates or times.
BUILTIN_DATE_FORMAT_IDS = frozenset(list(range(14, 23)) + [45, 46, 47])

# File signatures.
MAGIC_ZIP = b"PK\x03\x04"
MAGIC_OLE2 = b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1"

_CHUNK = 1 << 20


class CorruptWorkbook(ValueError):
    """A workbook whose content contradicts the format (reported with its path)."""


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


# ---------------------------------------------------------------- format sniffing


def sniff(head: bytes, path: str = "") -> tuple[str, str | None]:
    """Return (format, reason-if-rejected) from the first bytes and the file name."""
    if not head:
        return "empty", "empty file"
    if head.startswith(MAGIC_OLE2):
        return "ole2", "OLE2 container (xls or encrypted workbook) is not supported"
    if head.startswith(MAGIC_ZIP):
        low = path.lower()
        if low.endswith(".xlsb"):
            return "xlsb", "binary workbook (xlsb) is not supported"
        if low.endswith(".ods"):
            return "ods", "OpenDocument spreadsheet is not supported"
        return "ooxml", None
    return "other", "not a workbook"


# ---------------------------------------------------------------- number formats

_QUOTED = re.compile(r'"[^"]*"')
_ESCAPED = re.compile(r"\\.")
_PADDING = re.compile(r"[_*].")
_BRACKET = re.compile(r"\[[^\]]*\]")
_ELAPSED = re.compile(r"^\[(h+|m+|s+)\]", re.IGNORECASE)
_AMPM = re.compile(r"(AM/PM|am/pm|A/P|a/p)")
_DATE_CHARS = re.compile(r"^[yYmMdDhHsSeEgGbB\-/,. :T0年月日]+$")
_DATE_LETTER = re.compile(r"[yYmMdDhHsS]")


def is_date_format(fmt_id: int, code: str | None) -> bool:
    """C11: does a number format display a date/time?"""
    if fmt_id in BUILTIN_DATE_FORMAT_IDS:
        return True
    if not code or code.lower() == "general":
        return False
    fs = code
    sep = fs.find(";")
    if 0 < sep < len(fs) - 1:
        fs = fs[:sep]
    elif sep == len(fs) - 1:
        fs = fs[:-1]
    if _ELAPSED.match(fs):
        return True
    fs = _ESCAPED.sub("", fs)
    fs = _QUOTED.sub("", fs)
    fs = _PADDING.sub("", fs)
    fs = _BRACKET.sub("", fs)
    fs = _AMPM.sub("", fs)
    if not fs or not _DATE_LETTER.search(fs):
        return False
    return bool(_DATE_CHARS.match(fs))


def bool_format(code: str | None):
    """For a format that displays TRUE/FALSE, return a function 0/1 -> bool, else None."""
    if not code or ("TRUE" not in code and "FALSE" not in code):
        return None
    sections = code.split(";")

    def shown(v: float) -> str:
        if v == 0 and len(sections) >= 3:
            sec = sections[2]
        else:
            sec = sections[0]
        return _QUOTED.sub(lambda m: m.group(0)[1:-1], sec).strip()

    def conv(v: float):
        text = shown(v)
        if text.startswith("TRUE"):
            return True
        if text.startswith("FALSE"):
            return False
        return None

    return conv


# ---------------------------------------------------------------- workbook parts


@dataclass
class SheetRef:
    pos: int
    name: str
    part: str  # path of the sheet XML inside the zip
    state: str = "visible"


@dataclass
class Workbook:
    sheets: list[SheetRef]
    date1904: bool
    style_kind: list[str] = field(default_factory=list)  # per xf index: 'n' | 'd' | 'b'
    style_bool: dict = field(default_factory=dict)  # xf index -> bool converter
    style_code: dict = field(default_factory=dict)  # xf index -> format code of numbers, without the general one
    shared_strings_part: str | None = None


def _parse_small(zf: zipfile.ZipFile, name: str):
    """Parse a small XML part to an Element (refusing DTDs)."""
    from xml.etree.ElementTree import fromstring

    data = zf.read(name)
    _refuse_dtd(data, name)
    return fromstring(data)


def _rels(zf: zipfile.ZipFile, part: str) -> dict[str, str]:
    folder, base = posixpath.split(part)
    rel_name = posixpath.join(folder, "_rels", base + ".rels")
    try:
        root = _parse_small(zf, rel_name)
    except KeyError:
        return {}
    out = {}
    for rel in root:
        target = rel.get("Target", "")
        if target.startswith("/"):
            resolved = target.lstrip("/")
        else:
            resolved = posixpath.normpath(posixpath.join(folder, target))
        out[rel.get("Id")] = resolved
    return out


def _workbook_part(zf: zipfile.ZipFile) -> str:
    try:
        root = _parse_small(zf, "_rels/.rels")
        for rel in root:
            if rel.get("Type", "").endswith("/officeDocument"):
                return rel.get("Target", "xl/workbook.xml").lstrip("/")
    except KeyError:
        pass
    return "xl/workbook.xml"


def open_workbook(zf: zipfile.ZipFile, with_styles: bool = True) -> Workbook:
    wb_part = _workbook_part(zf)
    root = _parse_small(zf, wb_part)
    rels = _rels(zf, wb_part)
    date1904 = False
    sheets: list[SheetRef] = []
    for el in root.iter():
        tag = _local(el.tag)
        if tag == "workbookPr":
            v = el.get("date1904", "0").lower()
            date1904 = v in ("1", "true")
        elif tag == "sheet":
            rid = None
            for ns in _NS_REL:
                rid = el.get(f"{{{ns}}}id")
                if rid:
                    break
            part = rels.get(rid, "")
            sheets.append(SheetRef(len(sheets), el.get("name", ""), part, el.get("state", "visible")))
    wb = Workbook(sheets=sheets, date1904=date1904)
    sst = None
    styles = None
    for target in rels.values():
        low = target.lower()
        if low.endswith("sharedstrings.xml"):
            sst = target
        elif low.endswith("styles.xml"):
            styles = target
    wb.shared_strings_part = sst
    if with_styles and styles:
        _load_styles(zf, styles, wb)
    return wb


def _load_styles(zf: zipfile.ZipFile, part: str, wb: Workbook) -> None:
    try:
        root = _parse_small(zf, part)
    except KeyError:
        return
    codes: dict[int, str] = {}
    kinds: list[str] = []
    for el in root:
        tag = _local(el.tag)
        if tag == "numFmts":
            for nf in el:
                try:
                    codes[int(nf.get("numFmtId"))] = nf.get("formatCode", "")
                except (TypeError, ValueError):
                    continue
        elif tag == "cellXfs":
            for i, xf in enumerate(el):
                try:
                    fid = int(xf.get("numFmtId", "0"))
                except ValueError:
                    fid = 0
                code = codes.get(fid)
                if is_date_format(fid, code):
                    kinds.append("d")
                else:
                    shown = code or BUILTIN_NUMBER_FORMATS.get(fid)
                    if shown and shown.lower() != "general":
                        wb.style_code[i] = shown
                    conv = bool_format(code)
                    if conv is not None:
                        wb.style_bool[i] = conv
                    kinds.append("n")
    wb.style_kind = kinds


def load_shared_strings(zf: zipfile.ZipFile, part: str | None) -> list[str]:
    """S3: the shared string table, streamed (rich text runs concatenated)."""
    if not part:
        return []
    try:
        stream = zf.open(part)
    except KeyError:
        return []
    out: list[str] = []
    parser = XMLPullParser(events=("end",))
    first = True
    buf: list[str] = []
    while True:
        chunk = stream.read(_CHUNK)
        if first:
            _refuse_dtd(chunk, part)
            first = False
        if not chunk:
            break
        parser.feed(chunk)
        for _, el in parser.read_events():
            tag = _local(el.tag)
            if tag == "t":
                buf.append(el.text or "")
            elif tag == "rPh":  # phonetic runs are not part of the value
                if buf:
                    buf.pop()
            elif tag == "si":
                out.append("".join(buf))
                buf = []
                el.clear()
    parser.close()
    return out


_PROLOG = re.compile(rb"(?:\xef\xbb\xbf)?(?:\s+|<\?.*?\?>|<!--.*?-->)*", re.S)


def _refuse_dtd(head: bytes, part: str) -> None:
    """A DOCTYPE before the root element is refused (entity expansion guard), whatever
    comments stand in front of it; so is a prolog that does not end within the first piece."""
    rest = head[_PROLOG.match(head).end():]
    if rest[:9].upper() == b"<!DOCTYPE" or rest.startswith((b"<!--", b"<?")):
        raise CorruptWorkbook(f"DTD is not allowed in {part}")


# ---------------------------------------------------------------- cell references


def split_ref(ref: str) -> tuple[int, int]:
    """'B7' -> (row 6, col 1)."""
    col = 0
    i = 0
    n = len(ref)
    while i < n:
        c = ref[i]
        o = ord(c)
        if 65 <= o <= 90:
            col = col * 26 + (o - 64)
        elif 97 <= o <= 122:
            col = col * 26 + (o - 96)
        elif c == "$":
            pass
        else:
            break
        i += 1
    row = int(ref[i:].replace("$", "")) - 1 if i < n else -1
    return row, col - 1


# ---------------------------------------------------------------- the sheet scan


@dataclass
class ScanOptions:
    first_row: int = 0  # 0-based inclusive
    last_row: int | None = None  # 0-based inclusive; None = open
    first_col: int = 0
    last_col: int | None = None
    header_row: int | None = 0  # 0-based; None = no header
    skip_empty_rows: bool = True
    skip_hidden_rows: bool = True
    skip_hidden_cols: bool = True
    rowid_col: int | None = None
    use15: bool = True
    blank_to_missing: bool = True
    error_as_missing: bool = False
    max_data_rows: int | None = None  # stop after this many data rows (inference sample)
    number_formats: bool = False  # number cells carry their format code as text
    corrupt: str = "failfast"  # or "skip"


_BLANK = re.compile(r"^[\x00-\x20]*$")


# Tokens of the sheet XML, matched on the inflated bytes. Bodies use the unrolled form
# [^<]*(?:<(?!/x>)[^<]*)* instead of a lazy dot (linear, no per-character backtracking).
# A namespace prefix (e.g. "x:") is detected once from the sheetData tag. Working on bytes
# keeps byte offsets exact, so a sheet can be split into byte ranges of its XML.
_SHEETDATA_RE = re.compile(rb"<((?:[A-Za-z_][\w.-]*:)?)sheetData\b[^>]*?(/?)>")
_COL_RE = re.compile(rb"<(?:[A-Za-z_][\w.-]*:)?col\b([^>]*)>")
_ATTR_HIDDEN = re.compile(rb'(?:^|\s)hidden="(1|true)"')
_ATTR_MIN = re.compile(rb'(?:^|\s)min="(\d+)"')
_ATTR_MAX = re.compile(rb'(?:^|\s)max="(\d+)"')
_ESC_X = re.compile(r"_x([0-9A-Fa-f]{4})_")


class _Tokens:
    """Compiled patterns for one namespace prefix."""

    _cache: dict = {}

    def __new__(cls, prefix: bytes):
        got = cls._cache.get(prefix)
        if got is not None:
            return got
        self = super().__new__(cls)
        p = re.escape(prefix)
        self.row = re.compile(rb"<" + p + rb"row\b([^>]*?)(?:/>|>([^<]*(?:<(?!/" + p + rb"row>)[^<]*)*)</" + p
                              + rb"row>)")
        self.cell = re.compile(rb"<" + p + rb"c\b([^>]*?)(?:/>|>([^<]*(?:<(?!/" + p + rb"c>)[^<]*)*)</" + p
                               + rb"c>)")
        self.v = re.compile(rb"<" + p + rb"v(?:\s[^>]*)?>([^<]*)</" + p + rb"v>")
        self.t = re.compile(rb"<" + p + rb"t(?:\s[^>]*)?>([^<]*(?:<(?!/" + p + rb"t>)[^<]*)*)</" + p + rb"t>")
        self.rph = re.compile(rb"<" + p + rb"rPh\b.*?</" + p + rb"rPh>", re.S)
        self.end = re.compile(rb"</" + p + rb"sheetData>")
        # canonical cells only (attributes r, s, t in this order; value or inline text)
        self.fast = re.compile(
            rb"<" + p + rb"c r=\"([A-Z]{1,3})\d+\"(?: s=\"(\d+)\")?(?: t=\"(\w+)\")?(?:/>|>(?:<" + p + rb"v>([^<]*)</"
            + p + rb"v>|<" + p + rb"is><" + p + rb"t(?: xml:space=\"preserve\")?>([^<]*)</" + p + rb"t></" + p
            + rb"is>)?</" + p + rb"c>)")
        self.c_tags = (b"<" + prefix + b"c ", b"<" + prefix + b"c>", b"<" + prefix + b"c/")
        self.v_open, self.v_close = b"<" + prefix + b"v>", b"</" + prefix + b"v>"
        cls._cache[prefix] = self
        return self


_COL_CACHE: dict[bytes, int] = {}


def _col_of(ref: bytes) -> int:
    got = _COL_CACHE.get(ref)
    if got is None:
        letters = ref.rstrip(b"0123456789").replace(b"$", b"").upper()
        v = 0
        for ch in letters:
            v = v * 26 + (ch - 64)
        got = v - 1
        if len(_COL_CACHE) < 200000:
            _COL_CACHE[ref] = got
    return got


def _unescape(text: str) -> str:
    if "&" in text:
        if "<![CDATA[" in text:
            text = text.replace("<![CDATA[", "").replace("]]>", "")
        text = html.unescape(text)
    if "_x" in text:
        text = _ESC_X.sub(lambda m: chr(int(m.group(1), 16)), text)
    return text


def _text_of(body: bytes, tok) -> str:
    if b"rPh" in body:
        body = tok.rph.sub(b"", body)
    return "".join(_unescape(m.group(1).decode("utf-8")) for m in tok.t.finditer(body))


def _read_raw(stream, part: str):
    """Inflate a part and yield byte chunks (refusing a DOCTYPE at the head)."""
    first = True
    while True:
        raw = stream.read(_CHUNK)
        if first:
            _refuse_dtd(raw, part)
            first = False
        if not raw:
            return
        yield raw


def scan_sheet(zf: zipfile.ZipFile, wb: Workbook, sheet: SheetRef, opts: ScanOptions, sst: list[str],
               byte_range: tuple[int, int | None] | None = None):
    """Yield ('hidden_cols', set) once, then (row_idx, hidden, cells, rowid) per ``<row>``.

    ``cells`` is a list of (col, kind, num, txt) in column order, already restricted to the
    column range, without hidden columns (when skipped) and without missing values.
    With ``byte_range`` = (lo, hi) only rows whose tag starts at an offset in [lo, hi) of
    the sheet XML are parsed (rows must then carry their ``r`` attribute).
    """
    part = sheet.part
    stream = zf.open(part)
    style_kind = wb.style_kind
    style_bool = wb.style_bool
    code_of = (wb.style_code if opts.number_formats else {}).get
    date1904 = wb.date1904
    n_styles = len(style_kind)
    last_row = opts.last_row
    first_col, last_col = opts.first_col, opts.last_col
    rowid_col = opts.rowid_col
    use15 = opts.use15
    blank_to_missing = opts.blank_to_missing
    error_as_missing = opts.error_as_missing
    skip_hidden_cols = opts.skip_hidden_cols
    blank = _BLANK.match
    hidden_cols: set[int] = set()
    lo, hi = byte_range if byte_range else (0, None)

    buf = b""
    base = 0  # absolute offset of buf[0]
    in_data = False
    done = False
    cur_row = -1
    tok = None
    for chunk in _read_raw(stream, part):
        buf += chunk
        if not in_data:
            m = _SHEETDATA_RE.search(buf)
            if not m:
                continue
            head = buf[: m.start()]
            for cm in _COL_RE.finditer(head):
                a = cm.group(1)
                if _ATTR_HIDDEN.search(a):
                    lmin, lmax = _ATTR_MIN.search(a), _ATTR_MAX.search(a)
                    if lmin and lmax:
                        hidden_cols.update(range(int(lmin.group(1)) - 1, int(lmax.group(1))))
            yield ("hidden_cols", hidden_cols)
            in_data = True
            tok = _Tokens(m.group(1))
            if m.group(2) == b"/":
                done = True
                break
            base += m.end()
            buf = buf[m.end():]
        if base + len(buf) <= lo:
            base += len(buf)
            buf = b""
            continue
        start_at = max(0, lo - base)
        pos = start_at
        end_m = tok.end.search(buf, start_at)
        limit = end_m.start() if end_m else len(buf)
        cell_re, v_re, fast_re, c_tags = tok.cell, tok.v, tok.fast, tok.c_tags
        v_open, v_close = tok.v_open, tok.v_close
        lv_open, lv_close = len(v_open), -len(v_close)
        for rm in tok.row.finditer(buf, start_at, limit):
            if hi is not None and base + rm.start() >= hi:
                done = True
                break
            attrs = rm.group(1)
            i = attrs.find(b' r="')
            if i >= 0:
                cur_row = int(attrs[i + 4: attrs.find(b'"', i + 4)]) - 1
            elif byte_range and lo > 0:
                raise CorruptWorkbook("rows without an r attribute cannot be read in byte ranges")
            else:
                cur_row += 1
            row_hidden = _ATTR_HIDDEN.search(attrs) is not None if b"hidden" in attrs else False
            cells = []
            rowid = None
            body = rm.group(2)
            fast = None
            if body:
                fast = fast_re.findall(body)
                if len(fast) != body.count(c_tags[0]) + body.count(c_tags[1]) + body.count(c_tags[2]):
                    fast = None
            if fast is not None:
                cur_col = -1
                for letters, s_, ty, v, itext in fast:
                    col = _COL_CACHE.get(letters)
                    if col is None:
                        col = _col_of(letters)
                    if col <= cur_col:
                        raise CorruptWorkbook(
                            f"cell references out of order: {letters.decode()} after column {cur_col}")
                    cur_col = col
                    is_rowid = rowid_col is not None and col == rowid_col
                    if not is_rowid:
                        if col < first_col or (last_col is not None and col > last_col):
                            continue
                        if skip_hidden_cols and col in hidden_cols:
                            continue
                    cell = None
                    if not ty or ty == b"n":
                        if v:
                            x = float(v)
                            si = int(s_) if s_ else 0
                            if si < n_styles and style_kind[si] == "d":
                                cell = (col, "d", x, None)
                            else:
                                if use15 and len(v) > 15:
                                    x = round15_value(x)
                                conv = style_bool.get(si) if (x == 0.0 or x == 1.0) else None
                                bv = conv(x) if conv is not None else None
                                cell = (col, "n", x, code_of(si)) if bv is None else (col, "b", 1.0 if bv else 0.0, None)
                    elif ty == b"inlineStr":
                        txt = _unescape(itext.decode("utf-8")) if itext else ""
                        if not (blank_to_missing and blank(txt)):
                            cell = (col, "s", None, txt)
                    elif ty == b"s":
                        if v and v.strip():
                            txt = sst[int(v)]
                            if not (blank_to_missing and blank(txt)):
                                cell = (col, "s", None, txt)
                    elif ty == b"str":
                        txt = _unescape(v.decode("utf-8")) if v else ""
                        if not (blank_to_missing and blank(txt)):
                            cell = (col, "s", None, txt)
                    elif ty == b"b":
                        if v:
                            cell = (col, "b", 0.0 if v.strip()[:1] == b"0" else 1.0, None)
                    elif ty == b"e":
                        if not error_as_missing:
                            cell = (col, "e", None, _unescape(v.decode("utf-8")) if v else "")
                    elif ty == b"d":
                        if v:
                            cell = (col, "d", _iso_to_serial(v.decode(), date1904), None)
                    if cell is None:
                        continue
                    if is_rowid:
                        rowid = cell
                    else:
                        cells.append(cell)
            elif body:
                cur_col = -1
                for cm in cell_re.finditer(body):
                    ca, cbody = cm.groups()
                    i = ca.find(b' r="')
                    if i >= 0:
                        ref = ca[i + 4: ca.find(b'"', i + 4)]
                        col = _col_of(ref)
                        if col <= cur_col:
                            raise CorruptWorkbook(
                                f"cell references out of order: {ref.decode()} after column {cur_col}")
                        cur_col = col
                    else:
                        cur_col += 1
                        col = cur_col
                    is_rowid = rowid_col is not None and col == rowid_col
                    if not is_rowid:
                        if col < first_col or (last_col is not None and col > last_col):
                            continue
                        if skip_hidden_cols and col in hidden_cols:
                            continue
                    if not cbody:
                        continue
                    i = ca.find(b' t="')
                    ty = ca[i + 4: ca.find(b'"', i + 4)] if i >= 0 else b"n"
                    cell = None
                    if ty == b"n":
                        if cbody.startswith(v_open) and cbody.endswith(v_close):
                            v = cbody[lv_open:lv_close]
                        else:
                            vm = v_re.search(cbody)
                            v = vm.group(1) if vm else None
                        if v:
                            x = float(v)
                            i = ca.find(b' s="')
                            si = int(ca[i + 4: ca.find(b'"', i + 4)]) if i >= 0 else 0
                            if si < n_styles and style_kind[si] == "d":
                                cell = (col, "d", x, None)
                            else:
                                if use15 and len(v) > 15:
                                    x = round15_value(x)
                                conv = style_bool.get(si) if (x == 0.0 or x == 1.0) else None
                                bv = conv(x) if conv is not None else None
                                if bv is not None:
                                    cell = (col, "b", 1.0 if bv else 0.0, None)
                                else:
                                    cell = (col, "n", x, code_of(si))
                    elif ty == b"s":
                        vm = v_re.search(cbody)
                        if vm and vm.group(1).strip():
                            txt = sst[int(vm.group(1))]
                            if not (blank_to_missing and blank(txt)):
                                cell = (col, "s", None, txt)
                    elif ty == b"inlineStr":
                        txt = _text_of(cbody, tok)
                        if not (blank_to_missing and blank(txt)):
                            cell = (col, "s", None, txt)
                    elif ty == b"str":
                        vm = v_re.search(cbody)
                        txt = _unescape(vm.group(1).decode("utf-8")) if vm else ""
                        if not (blank_to_missing and blank(txt)):
                            cell = (col, "s", None, txt)
                    elif ty == b"b":
                        vm = v_re.search(cbody)
                        if vm and vm.group(1):
                            cell = (col, "b", 0.0 if vm.group(1).strip()[:1] == b"0" else 1.0, None)
                    elif ty == b"e":
                        if not error_as_missing:
                            vm = v_re.search(cbody)
                            cell = (col, "e", None, _unescape(vm.group(1).decode("utf-8")) if vm else "")
                    elif ty == b"d":
                        vm = v_re.search(cbody)
                        if vm and vm.group(1):
                            cell = (col, "d", _iso_to_serial(vm.group(1).decode(), date1904), None)
                    if cell is None:
                        continue
                    if is_rowid:
                        rowid = cell
                    else:
                        cells.append(cell)
            yield (cur_row, row_hidden, cells, rowid)
            pos = rm.end()
            if last_row is not None and cur_row >= last_row:
                done = True
                break
        if done or end_m:
            break
        base += pos
        buf = buf[pos:]
    if not in_data:
        yield ("hidden_cols", hidden_cols)
    stream.close()


def _iso_to_serial(text: str, date1904: bool) -> float:
    try:
        if "T" in text or " " in text:
            dt = datetime.fromisoformat(text.replace("Z", ""))
        elif ":" in text:
            t = datetime.fromisoformat("1899-12-31T" + text)
            return (t - datetime(1899, 12, 31)).total_seconds() / 86400.0
        else:
            dt = datetime.combine(date.fromisoformat(text), datetime.min.time())
    except ValueError:
        return -1.0
    base = datetime(1904, 1, 1) if date1904 else datetime(1899, 12, 30)
    days = (dt - base).total_seconds() / 86400.0
    if not date1904 and dt < datetime(1900, 3, 1):
        days -= 1
    return days


def iter_data_rows(zf, wb, sheet, opts: ScanOptions, sst):
    """Apply the reader's row rules on top of ``scan_sheet``.

    Yields ('hidden_cols', set) first, then tuples
    (row_idx, seq, hidden, cells, rowid, is_header) where ``seq`` numbers the data rows
    (the header row has seq -1).
    """
    seq = 0
    last_phys = opts.first_row - 1  # last physical row index accounted for
    header = opts.header_row
    last_row = opts.last_row
    max_rows = opts.max_data_rows

    def materialise(lo, hi):
        # rows lo..hi (inclusive) have no cells: they exist only if empty rows are kept
        nonlocal seq
        for r in range(lo, hi + 1):
            if header is not None and r == header:
                yield (r, -1, False, [], None, True)
                continue
            if r < opts.first_row or (last_row is not None and r > last_row):
                continue
            if opts.skip_empty_rows:
                continue
            yield (r, seq, False, [], None, False)
            seq += 1

    for item in scan_sheet(zf, wb, sheet, opts, sst):
        if item[0] == "hidden_cols":
            yield item
            continue
        r, hidden, cells, rowid = item
        empty = not cells and rowid is None
        if header is not None and r == header:
            # rows between get materialised first
            if not opts.skip_empty_rows and r - 1 > last_phys:
                for out in materialise(max(last_phys + 1, opts.first_row), r - 1):
                    yield out
                    if max_rows is not None and seq >= max_rows:
                        return
            yield (r, -1, hidden, cells, rowid, True)
            last_phys = max(last_phys, r)
            continue
        if r < opts.first_row:
            continue
        if last_row is not None and r > last_row:
            break
        if empty:
            continue  # counted as a gap, materialised later if needed
        if not opts.skip_empty_rows and r - 1 > last_phys:
            for out in materialise(last_phys + 1, r - 1):
                yield out
                if max_rows is not None and seq >= max_rows:
                    return
        last_phys = r
        if hidden and opts.skip_hidden_rows:
            continue
        yield (r, seq, hidden, cells, rowid, False)
        seq += 1
        if max_rows is not None and seq >= max_rows:
            return
    # trailing empty rows up to an explicit last row
    if not opts.skip_empty_rows and last_row is not None and last_row > last_phys:
        for out in materialise(last_phys + 1, last_row):
            yield out
            if max_rows is not None and seq >= max_rows:
                return


def sheet_has_data(zf: zipfile.ZipFile, wb: Workbook, sheet: SheetRef, sst_loader) -> bool:
    """True at the first cell with content; style-only cells do not count."""
    if not sheet.part:
        return False
    try:
        stream = zf.open(sheet.part)
    except KeyError:
        return False
    parser = XMLPullParser(events=("end",))
    first = True
    sst = None
    while True:
        chunk = stream.read(_CHUNK)
        if first:
            _refuse_dtd(chunk, sheet.part)
            first = False
        if not chunk:
            return False
        parser.feed(chunk)
        for _, el in parser.read_events():
            t = _local(el.tag)
            if t == "c":
                ty = el.get("t", "n")
                for ch in el:
                    ct = _local(ch.tag)
                    if ct == "v" and ch.text not in (None, ""):
                        if ty == "s":
                            if sst is None:
                                sst = sst_loader()
                            try:
                                if sst[int(ch.text)] != "":
                                    return True
                            except (IndexError, ValueError):
                                return True
                        else:
                            return True
                    if ct == "is" and "".join(ch.itertext()) != "":
                        return True
                el.clear()
            elif t == "sheetData":
                return False


def rows_are_numbered(zf: zipfile.ZipFile, sheet: SheetRef) -> bool:
    """Whether the sheet's first row has an ``r`` attribute (needed to read it in byte ranges)."""
    with zf.open(sheet.part) as stream:
        buf = b""
        while chunk := stream.read(_CHUNK):
            buf += chunk
            m = re.search(rb"<(?:[A-Za-z_][\w.-]*:)?row\b([^>]*)>", buf)
            if m:
                return b' r="' in m.group(1)
            buf = buf[-4096:]
    return True


def hidden_columns(zf: zipfile.ZipFile, sheet: SheetRef) -> set[int]:
    """A5: hidden column indexes of a sheet, from the XML head only."""
    if not sheet.part:
        return set()
    stream = zf.open(sheet.part)
    head = b""
    for chunk in _read_raw(stream, sheet.part):
        head += chunk
        m = _SHEETDATA_RE.search(head)
        if m:
            head = head[: m.start()]
            break
    stream.close()
    out: set[int] = set()
    for cm in _COL_RE.finditer(head):
        a = cm.group(1)
        if _ATTR_HIDDEN.search(a):
            lmin, lmax = _ATTR_MIN.search(a), _ATTR_MAX.search(a)
            if lmin and lmax:
                out.update(range(int(lmin.group(1)) - 1, int(lmax.group(1))))
    return out


def open_zip(content: bytes) -> zipfile.ZipFile:
    return zipfile.ZipFile(io.BytesIO(content))
