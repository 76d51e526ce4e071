"""Writing into an existing workbook (N3 sheet exists: fail / overwrite / append; N4 file exists).

The existing workbook's layout -- sheets in order with their last used row (A6), the count
of cell styles and the highest custom number format id -- comes from ``update.workbook_layout``. Rows are then rendered and deflated in parallel as for a new workbook; the
commit task copies the untouched parts (author metadata included, N13), splices appended
rows before ``</sheetData>`` of the existing sheet, and extends workbook, relationships,
content types and styles with what is new.
"""

from __future__ import annotations

import re
import zipfile
import zlib

from ..sources import ooxml

_XF_COUNT = re.compile(rb"<(?:[A-Za-z_][\w.-]*:)?cellXfs\b[^>]*>")
_XF = re.compile(rb"<(?:[A-Za-z_][\w.-]*:)?xf\b")
_NUMFMT_ID = re.compile(rb"numFmtId=\"(\d+)\"")


def style_counts(zf: zipfile.ZipFile) -> tuple[int, int]:
    """(cell styles, highest number format id) of a workbook."""
    n_xf, max_fmt = 1, 163
    styles = [n for n in zf.namelist() if n.lower().endswith("styles.xml")]
    if styles:
        st = zf.read(styles[0])
        m = _XF_COUNT.search(st)
        if m:
            end = st.find(b"cellXfs>", m.end())
            n_xf = len(_XF.findall(st[m.end():end]))
        max_fmt = max([163, *(int(x) for x in _NUMFMT_ID.findall(st))])
    return n_xf, max_fmt


def _deflated(data: bytes, level: int = 1):
    co = zlib.compressobj(level, zlib.DEFLATED, -15)
    out = co.compress(data) + co.flush(zlib.Z_SYNC_FLUSH)
    return out, zlib.crc32(data), len(data), len(out)


_SHEETDATA_END = re.compile(rb"</(?:[A-Za-z_][\w.-]*:)?sheetData>")
_SHEETDATA_EMPTY = re.compile(rb"<((?:[A-Za-z_][\w.-]*:)?)sheetData\s*/>")


def split_sheet(xml: bytes) -> tuple[bytes, bytes]:
    """Existing sheet XML -> (everything before </sheetData>, the rest)."""
    m = _SHEETDATA_END.search(xml)
    if m:
        return xml[: m.start()], xml[m.start():]
    m = _SHEETDATA_EMPTY.search(xml)
    if m:
        p = m.group(1)
        return xml[: m.start()] + b"<" + p + b"sheetData>", b"</" + p + b"sheetData>" + xml[m.end():]
    raise ooxml.CorruptWorkbook("sheet without sheetData")


def extend_styles(xml: bytes, base_fmt: int, formats: list[str]) -> bytes:
    """Append our number formats and one cell style per format (ids base_fmt+1...)."""
    fmts = "".join(f'<numFmt numFmtId="{base_fmt + 1 + i}" formatCode="{f}"/>' for i, f in enumerate(formats))
    xfs = "".join(f'<xf numFmtId="{base_fmt + 1 + i}" fontId="0" fillId="0" borderId="0" xfId="0" '
                  'applyNumberFormat="1"/>' for i in range(len(formats)))
    m = re.search(rb"<((?:[A-Za-z_][\w.-]*:)?)numFmts\b[^>]*>", xml)
    if m:
        end = xml.find(b"numFmts>", m.end())
        close = xml.rfind(b"</", 0, end)
        xml = xml[:close] + fmts.encode() + xml[close:]
    else:
        m2 = re.search(rb"<((?:[A-Za-z_][\w.-]*:)?)styleSheet\b[^>]*>", xml)
        xml = xml[: m2.end()] + f"<numFmts>{fmts}</numFmts>".encode() + xml[m2.end():]
    m = _XF_COUNT.search(xml)
    end = xml.find(b"cellXfs>", m.end())
    close = xml.rfind(b"</", 0, end)
    xml = xml[:close] + xfs.encode() + xml[close:]
    return re.sub(rb"(<(?:[A-Za-z_][\w.-]*:)?cellXfs\b[^>]*?)\scount=\"\d+\"", rb"\1", xml)
