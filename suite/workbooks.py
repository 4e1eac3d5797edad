"""Write small .xlsx files with the standard library."""

import sys
import zipfile
from xml.sax.saxutils import escape

from pyspark.cloudpickle import register_pickle_by_value

# Tasks get the functions below by value; workers need no copy of the suite.
register_pickle_by_value(sys.modules[__name__])

MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
DOC = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PACKAGE = "http://schemas.openxmlformats.org/package/2006/relationships"

# Cell styles: 0 plain, 1 built-in date, 2 own date format, 3 own number format.
STYLES = (
    f'<styleSheet xmlns="{MAIN}"><numFmts count="2">'
    '<numFmt numFmtId="164" formatCode="yyyy\\-mm\\-dd hh:mm"/>'
    '<numFmt numFmtId="165" formatCode="[Red]0.00&quot;days&quot;"/></numFmts>'
    '<cellXfs count="4"><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="164"/>'
    '<xf numFmtId="165"/></cellXfs></styleSheet>'
)


def letters(position):
    text = ""
    position += 1
    while position:
        position, rest = divmod(position - 1, 26)
        text = chr(65 + rest) + text
    return text


def cell(value, reference, shared):
    if value is None:
        return ""
    if isinstance(value, bool):
        return f'<c r="{reference}" t="b"><v>{int(value)}</v></c>'
    if isinstance(value, tuple):  # (number, style)
        return f'<c r="{reference}" s="{value[1]}"><v>{value[0]}</v></c>'
    if isinstance(value, (int, float)):
        return f'<c r="{reference}"><v>{value}</v></c>'
    if value.startswith("="):
        return f'<c r="{reference}" t="str"><f>1</f><v>{escape(value[1:])}</v></c>'
    if value.startswith("#"):
        return f'<c r="{reference}" t="e"><v>{value}</v></c>'
    if value.startswith("'"):
        return f'<c r="{reference}" t="inlineStr"><is><t>{escape(value[1:])}</t></is></c>'
    shared.append(value)
    return f'<c r="{reference}" t="s"><v>{len(shared) - 1}</v></c>'


def write_workbook(path, sheets):
    """``sheets`` maps sheet name to rows of cell values."""
    shared, parts, listed, links = [], {}, [], []
    for i, (name, rows) in enumerate(sheets.items(), 1):
        body = "".join(
            f'<row r="{r}">'
            + "".join(cell(v, f"{letters(c)}{r}", shared) for c, v in enumerate(row))
            + "</row>"
            for r, row in enumerate(rows, 1)
        )
        parts[f"xl/worksheets/sheet{i}.xml"] = (
            f'<worksheet xmlns="{MAIN}"><sheetData>{body}</sheetData></worksheet>'
        )
        listed.append(f'<sheet name="{escape(name)}" sheetId="{i}" r:id="rId{i}"/>')
        links.append(f'<Relationship Id="rId{i}" Target="worksheets/sheet{i}.xml"/>')
    parts["xl/workbook.xml"] = (
        f'<workbook xmlns="{MAIN}" xmlns:r="{DOC}"><sheets>{"".join(listed)}</sheets>'
        "</workbook>"
    )
    parts["xl/_rels/workbook.xml.rels"] = (
        f'<Relationships xmlns="{PACKAGE}">{"".join(links)}</Relationships>'
    )
    strings = "".join(f"<si><r><t>{escape(s)}</t></r></si>" for s in shared)
    parts["xl/sharedStrings.xml"] = f'<sst xmlns="{MAIN}">{strings}</sst>'
    parts["xl/styles.xml"] = STYLES
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as book:
        for part, text in parts.items():
            book.writestr(part, text)
