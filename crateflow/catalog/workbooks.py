"""A minimal XLSX writer, so that workbook reading can be checked on the given tables."""

from __future__ import annotations

import io
import zipfile
from datetime import date, datetime
from xml.sax.saxutils import escape

_NS = "http://schemas.openxmlformats.org"
_MAIN = f'xmlns="{_NS}/spreadsheetml/2006/main"'
_REL = f"{_NS}/officeDocument/2006/relationships"
_PARTS = {
    "xl/workbook.xml": (
        f'<workbook {_MAIN} xmlns:r="{_REL}"><sheets>'
        '<sheet name="data" sheetId="1" r:id="rId1"/></sheets></workbook>'
    ),
    "xl/_rels/workbook.xml.rels": (
        f'<Relationships xmlns="{_NS}/package/2006/relationships">'
        f'<Relationship Id="rId1" Type="{_REL}/worksheet" Target="worksheets/sheet1.xml"/>'
        "</Relationships>"
    ),
    # style 1 shows a number as a date, style 2 as date and time
    "xl/styles.xml": (
        f'<styleSheet {_MAIN}><numFmts count="1">'
        '<numFmt numFmtId="164" formatCode="yyyy\\-mm\\-dd\\ hh:mm"/></numFmts>'
        '<cellXfs count="3"><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="164"/></cellXfs>'
        "</styleSheet>"
    ),
}


def encode_workbook(header: list[str], rows: list[tuple]) -> bytes:
    """A workbook with one sheet."""
    lines = "".join(f"<row>{''.join(map(_cell, row))}</row>" for row in [tuple(header), *rows])
    sheet = f"<worksheet {_MAIN}><sheetData>{lines}</sheetData></worksheet>"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        for name, text in {**_PARTS, "xl/worksheets/sheet1.xml": sheet}.items():
            book.writestr(name, text)
    return out.getvalue()


def _cell(value) -> str:
    if value is None:
        return "<c/>"
    if isinstance(value, bool):
        return f'<c t="b"><v>{int(value)}</v></c>'
    if isinstance(value, (datetime, date)):
        moment = value if isinstance(value, datetime) else datetime(value.year, value.month, value.day)
        serial = (moment - datetime(1899, 12, 30)).total_seconds() / 86_400
        return f'<c s="{2 if isinstance(value, datetime) else 1}"><v>{serial!r}</v></c>'
    if isinstance(value, (int, float)):
        return f"<c><v>{value!r}</v></c>"
    return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(value)}</t></is></c>'
