"""Workbooks written from rows, for the queries and tests that read them."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterable, Sequence
from xml.sax.saxutils import escape

from pricelab.sources.workbook import MAIN, RELATION_ID


def write(
    titles: Sequence[str], header: Sequence[str], data: Iterable[Sequence], date_columns: set[int]
) -> bytes:
    """A workbook with one sheet: title rows, a header row, data rows."""

    def cell(value, style: int) -> str:
        if value is None or value != value:
            return "<c/>"
        if isinstance(value, str):
            return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(value)}</t></is></c>'
        return f'<c s="{style}"><v>{float(value)!r}</v></c>'

    def row(number: int, values: Sequence, dated: set[int]) -> str:
        cells = "".join(cell(v, int(i in dated)) for i, v in enumerate(values))
        return f'<row r="{number}">{cells}</row>'

    lines = [row(i + 1, [t], set()) for i, t in enumerate(titles)]
    lines.append(row(len(titles) + 1, header, set()))
    lines += [row(len(titles) + 2 + i, values, date_columns) for i, values in enumerate(data)]
    namespace = MAIN[1:-1]
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as book:
        book.writestr(
            "xl/workbook.xml",
            f'<workbook xmlns="{namespace}" xmlns:r="{RELATION_ID[1:-3]}">'
            '<sheets><sheet name="Sales" sheetId="1" r:id="rId1"/></sheets></workbook>',
        )
        book.writestr(
            "xl/_rels/workbook.xml.rels",
            '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
            '<Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>',
        )
        book.writestr(
            "xl/styles.xml",
            f'<styleSheet xmlns="{namespace}"><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/>'
            "</cellXfs></styleSheet>",
        )
        book.writestr(
            "xl/worksheets/sheet1.xml",
            f'<worksheet xmlns="{namespace}"><sheetData>{"".join(lines)}</sheetData></worksheet>',
        )
    return out.getvalue()
