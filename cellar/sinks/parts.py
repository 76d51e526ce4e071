"""Static parts of the workbooks we write (no author metadata: N13)."""

from __future__ import annotations

from .render import xml_escape_py

# Number formats of the written styles (cellXfs 1..3), C27.
FORMAT_DATE = "yyyy-mm-dd"
FORMAT_DATETIME = "yyyy-mm-dd hh:mm:ss"
FORMAT_TIME = "hh:mm:ss;@"

# Paper size codes of <pageSetup paperSize=...>.
PAPER_SIZES = {"letter": 1, "legal": 5, "a3": 8, "a4": 9, "a5": 11, "b4": 12, "b5": 13, "executive": 7,
               "envelope_10": 20, "envelope_dl": 27, "envelope_c5": 28, "envelope_monarch": 37}

_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PKG = "http://schemas.openxmlformats.org/package/2006/relationships"

STYLES_XML = f"""<?xml version="1.0" encoding="UTF-8" standalone="yes"?>
<styleSheet xmlns="{_MAIN}"><numFmts count="3"><numFmt numFmtId="164" formatCode="{FORMAT_DATE}"/><numFmt numFmtId="165" formatCode="{FORMAT_DATETIME}"/><numFmt numFmtId="166" formatCode="{FORMAT_TIME}"/></numFmts><fonts count="1"><font><sz val="11"/><name val="Calibri"/></font></fonts><fills count="2"><fill><patternFill patternType="none"/></fill><fill><patternFill patternType="gray125"/></fill></fills><borders count="1"><border><left/><right/><top/><bottom/><diagonal/></border></borders><cellStyleXfs count="1"><xf numFmtId="0" fontId="0" fillId="0" borderId="0"/></cellStyleXfs><cellXfs count="4"><xf numFmtId="0" fontId="0" fillId="0" borderId="0" xfId="0"/><xf numFmtId="164" fontId="0" fillId="0" borderId="0" xfId="0" applyNumberFormat="1"/><xf numFmtId="165" fontId="0" fillId="0" borderId="0" xfId="0" applyNumberFormat="1"/><xf numFmtId="166" fontId="0" fillId="0" borderId="0" xfId="0" applyNumberFormat="1"/></cellXfs><cellStyles count="1"><cellStyle name="Normal" xfId="0" builtinId="0"/></cellStyles></styleSheet>"""


def content_types(n_sheets: int, macro: bool = False) -> str:
    main = ("application/vnd.ms-excel.sheet.macroEnabled.main+xml" if macro else
            "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml")
    sheets = "".join(
        f'<Override PartName="/xl/worksheets/sheet{i + 1}.xml" '
        f'ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>'
        for i in range(n_sheets)
    )
    return (
        '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'
        '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
        '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
        '<Default Extension="xml" ContentType="application/xml"/>'
        f'<Override PartName="/xl/workbook.xml" ContentType="{main}"/>'
        '<Override PartName="/xl/styles.xml" '
        'ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.styles+xml"/>'
        f"{sheets}</Types>"
    )


ROOT_RELS = (
    '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'
    f'<Relationships xmlns="{_PKG}"><Relationship Id="rId1" '
    'Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" '
    'Target="xl/workbook.xml"/></Relationships>'
)


def workbook_xml(names: list[str]) -> str:
    sheets = "".join(
        f'<sheet name="{xml_escape_py(n)}" sheetId="{i + 1}" r:id="rId{i + 1}"/>' for i, n in enumerate(names)
    )
    return (
        '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'
        f'<workbook xmlns="{_MAIN}" xmlns:r="{_REL}"><workbookPr date1904="false"/>'
        f"<sheets>{sheets}</sheets></workbook>"
    )


def workbook_rels(n_sheets: int) -> str:
    rels = "".join(
        f'<Relationship Id="rId{i + 1}" '
        'Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" '
        f'Target="worksheets/sheet{i + 1}.xml"/>'
        for i in range(n_sheets)
    )
    rels += (
        f'<Relationship Id="rId{n_sheets + 1}" '
        'Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/styles" Target="styles.xml"/>'
    )
    return f'<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n<Relationships xmlns="{_PKG}">{rels}</Relationships>'


def sheet_head(widths: list[float] | None = None) -> str:
    cols = ""
    if widths:
        cols = "<cols>" + "".join(
            f'<col min="{j + 1}" max="{j + 1}" width="{w:.2f}" customWidth="1"/>' for j, w in enumerate(widths)
        ) + "</cols>"
    return (
        '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'
        f'<worksheet xmlns="{_MAIN}" xmlns:r="{_REL}">{cols}<sheetData>'
    )


def sheet_tail(orientation: str | None = None, paper: str | None = None) -> str:
    setup = ""
    if orientation or paper:
        attrs = ""
        if paper:
            attrs += f' paperSize="{PAPER_SIZES[paper.lower()]}"'
        if orientation:
            attrs += f' orientation="{orientation.lower()}"'
        setup = f'<pageMargins left="0.7" right="0.7" top="0.75" bottom="0.75" header="0.3" footer="0.3"/>' \
                f"<pageSetup{attrs}/>"
    return f"</sheetData>{setup}</worksheet>"
