"""Cells of an ``.xlsx`` file, row by row. Runs inside tasks; needs no Spark."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

# Fixed values of the file format.
MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
RELATION_ID = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
DATA, ROW, CELL, VALUE, INLINE, TEXT, RUN = (MAIN + tag for tag in ("sheetData", "row", "c", "v", "is", "t", "r"))
DATE_FORMATS = {14, 15, 16, 17, 18, 19, 20, 21, 22, 45, 46, 47}

EMPTY = ("", False)


def parse_address(address: str) -> tuple[str, int, int]:
    """``0!A5`` -> sheet ``0``, row 5, column 0."""
    sheet, _, cell = address.rpartition("!")
    letters, digits = re.fullmatch(r"\$?([A-Z]+)\$?(\d+)", cell.upper()).groups()
    return sheet.strip("'") or "0", int(digits), column_number(letters)


def column_number(letters: str) -> int:
    number = 0
    for letter in letters:
        number = number * 26 + ord(letter) - ord("A") + 1
    return number - 1


def rows(
    content: bytes, sheet: str, first_row: int, first_column: int, width: int | None = None
) -> Iterator[list[tuple[str, bool]]]:
    """(text, is a date) per cell from the given cell on; rows without text are left out.

    The sheet is streamed: a row already given out leaves nothing behind.
    """
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        texts = _shared_texts(book)
        dates = _date_styles(book)
        with book.open(_sheet_member(book, sheet)) as xml:
            number, parent = 0, None
            for event, node in ElementTree.iterparse(xml, ("start", "end")):
                if event == "start":
                    parent = node if node.tag == DATA else parent
                    continue
                if node.tag != ROW:
                    continue
                number = int(node.get("r", number + 1))
                if number >= first_row:
                    cells = _cells(node, texts, dates, first_column, width)
                    if any(cell[0] for cell in cells):
                        yield cells
                parent.remove(node)


def column_types(
    content: bytes, sheet: str, header_row: int, first_column: int
) -> list[tuple[str, str]]:
    """(name, type) per header cell: ``double``, ``date`` or ``string`` by the data below.

    The type is empty where there is no data below.
    """
    found = rows(content, sheet, header_row, first_column)
    names = [text.strip() for text, _ in next(found, [])]
    while names and not names[-1]:
        names.pop()
    kinds: list[set[str]] = [set() for _ in names]
    for cells in found:
        for kind, (text, is_date) in zip(kinds, cells):
            if text.strip():
                kind.add("date" if is_date else "double" if _is_number(text) else "string")
    return [
        (name, "string" if len(kind) > 1 else "".join(kind)) for name, kind in zip(names, kinds)
    ]


def _is_number(text: str) -> bool:
    try:
        float(text)
    except ValueError:
        return False
    return True


def _shared_texts(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    texts = []
    with book.open("xl/sharedStrings.xml") as xml:
        for _, node in ElementTree.iterparse(xml):
            if node.tag == MAIN + "si":
                texts.append(_text(node))
                node.clear()
    return texts


def _text(node: ElementTree.Element) -> str:
    """Plain and rich text, without the phonetic guides."""
    if len(node) == 1 and node[0].tag == TEXT:
        return node[0].text or ""
    runs = [part for run in node if run.tag == RUN for part in run]
    return "".join(part.text or "" for part in [*node, *runs] if part.tag == TEXT)


def _date_styles(book: zipfile.ZipFile) -> set[str]:
    if "xl/styles.xml" not in book.namelist():
        return set()
    styles = ElementTree.fromstring(book.read("xl/styles.xml"))
    own = {
        int(f.get("numFmtId"))
        for f in styles.iter(MAIN + "numFmt")
        if re.search(r"[dmyh]", re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", f.get("formatCode", "").lower()))
    }
    formats = styles.findall(f"{MAIN}cellXfs/{MAIN}xf")
    return {
        str(i) for i, f in enumerate(formats) if int(f.get("numFmtId", 0)) in DATE_FORMATS | own
    }


def _sheet_member(book: zipfile.ZipFile, sheet: str) -> str:
    top = ElementTree.fromstring(book.read("xl/workbook.xml"))
    settings = top.find(f"{MAIN}workbookPr")
    if settings is not None and settings.get("date1904", "0") in ("1", "true"):
        raise ValueError("workbooks that count days from 1904 are not supported")
    sheets = top.findall(f"{MAIN}sheets/{MAIN}sheet")
    if sheet.isdigit():
        chosen = sheets[int(sheet)]
    else:
        chosen = next(s for s in sheets if s.get("name") == sheet)
    links = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    target = next(r.get("Target") for r in links if r.get("Id") == chosen.get(RELATION_ID))
    return target.lstrip("/") if target.startswith("/") else "xl/" + target


def _cells(
    row: ElementTree.Element,
    texts: list[str],
    dates: set[str],
    first_column: int,
    width: int | None,
) -> list[tuple[str, bool]]:
    cells: list[tuple[str, bool]] = [EMPTY] * (width or 0)
    at = -1
    for node in row:
        if node.tag != CELL:
            continue
        get = node.get
        reference = get("r")
        at = column_number(reference.rstrip("0123456789")) if reference else at + 1
        place = at - first_column
        if place < 0 or (width is not None and place >= width):
            continue
        while len(cells) <= place:
            cells.append(EMPTY)
        kind = get("t", "n")
        if kind == "inlineStr":
            inline = node.find(INLINE)
            cells[place] = ("" if inline is None else _text(inline), False)
            continue
        value = node.findtext(VALUE, "")
        if kind == "n":
            cells[place] = (value, get("s") in dates)
        elif kind == "s" and value:
            cells[place] = (texts[int(value)], False)
        elif kind != "e":
            cells[place] = (value, False)
    return cells
