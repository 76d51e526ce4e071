"""Tiny workbook builder for test fixtures (hand-written sheet XML, stdlib zipfile)."""

from __future__ import annotations

import zipfile
from xml.sax.saxutils import escape

MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PKG = "http://schemas.openxmlformats.org/package/2006/relationships"

# cellXfs: 0 general, 1 date (built-in 14), 2 date-time (built-in 22), 3 time, 4 TRUE/FALSE display
STYLES = f"""<?xml version="1.0" encoding="UTF-8"?>
<styleSheet xmlns="{MAIN}"><numFmts count="2"><numFmt numFmtId="164" formatCode="hh:mm:ss"/><numFmt numFmtId="165" formatCode="&quot;TRUE&quot;;&quot;TRUE&quot;;&quot;FALSE&quot;"/></numFmts>
<cellXfs count="5"><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="22"/><xf numFmtId="164"/><xf numFmtId="165"/></cellXfs></styleSheet>"""

DATE, DATETIME, TIME, BOOLFMT = 1, 2, 3, 4


def num(ref, v, s=None):
    st = f' s="{s}"' if s is not None else ""
    return f'<c r="{ref}"{st}><v>{v}</v></c>'


def text(ref, t):
    return f'<c r="{ref}" t="inlineStr"><is><t>{escape(t)}</t></is></c>'


def shared(ref, idx):
    return f'<c r="{ref}" t="s"><v>{idx}</v></c>'


def boolean(ref, b):
    return f'<c r="{ref}" t="b"><v>{1 if b else 0}</v></c>'


def error(ref, code="#DIV/0!"):
    return f'<c r="{ref}" t="e"><v>{code}</v></c>'


def styled_empty(ref, s=1):
    return f'<c r="{ref}" s="{s}"/>'


def row(r, *cells, hidden=False):
    h = ' hidden="1"' if hidden else ""
    return f'<row r="{r}"{h}>{"".join(cells)}</row>'


def sheet_xml(rows, hidden_cols=(), doctype=False):
    cols = ""
    if hidden_cols:
        cols = "<cols>" + "".join(f'<col min="{c + 1}" max="{c + 1}" hidden="1"/>' for c in hidden_cols) + "</cols>"
    dt = '<!DOCTYPE worksheet [<!ENTITY a "b">]>' if doctype else ""
    return f'<?xml version="1.0" encoding="UTF-8"?>{dt}<worksheet xmlns="{MAIN}">{cols}<sheetData>{"".join(rows)}</sheetData></worksheet>'


def build(path, sheets, date1904=False, strings=None, styles=STYLES):
    """sheets: list of (name, sheet XML)."""
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        over = "".join(
            f'<Override PartName="/xl/worksheets/sheet{i + 1}.xml" '
            'ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>'
            for i in range(len(sheets)))
        z.writestr("[Content_Types].xml",
                   '<?xml version="1.0"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
                   '<Default Extension="xml" ContentType="application/xml"/>' + over + "</Types>")
        z.writestr("_rels/.rels", f'<?xml version="1.0"?><Relationships xmlns="{PKG}"><Relationship Id="rId1" '
                   'Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" '
                   'Target="xl/workbook.xml"/></Relationships>')
        sh = "".join(f'<sheet name="{escape(n)}" sheetId="{i + 1}" r:id="rId{i + 1}"/>' for i, (n, _) in enumerate(sheets))
        z.writestr("xl/workbook.xml", f'<?xml version="1.0"?><workbook xmlns="{MAIN}" xmlns:r="{REL}">'
                   f'<workbookPr date1904="{1 if date1904 else 0}"/><sheets>{sh}</sheets></workbook>')
        rels = "".join(f'<Relationship Id="rId{i + 1}" Type="{REL}/worksheet" Target="worksheets/sheet{i + 1}.xml"/>'
                       for i in range(len(sheets)))
        n = len(sheets)
        rels += f'<Relationship Id="rId{n + 1}" Type="{REL}/styles" Target="styles.xml"/>'
        if strings is not None:
            rels += f'<Relationship Id="rId{n + 2}" Type="{REL}/sharedStrings" Target="sharedStrings.xml"/>'
            sst = "".join(f"<si><t>{escape(s)}</t></si>" for s in strings)
            z.writestr("xl/sharedStrings.xml", f'<?xml version="1.0"?><sst xmlns="{MAIN}">{sst}</sst>')
        z.writestr("xl/_rels/workbook.xml.rels", f'<?xml version="1.0"?><Relationships xmlns="{PKG}">{rels}</Relationships>')
        z.writestr("xl/styles.xml", styles)
        for i, (_, xml) in enumerate(sheets):
            z.writestr(f"xl/worksheets/sheet{i + 1}.xml", xml)
    return path
