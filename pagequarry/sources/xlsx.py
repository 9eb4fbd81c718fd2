"""Workbooks as bytes, such as Spark's binaryFile source reads: rows of their sheets, and sheets made of rows."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS = "name string, sheet string, row long, cells array<string>"
#: Namespaces and parts of the format.
MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
LINKS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PACKAGE = "http://schemas.openxmlformats.org/package/2006"
HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'
_BAD = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f￾￿]")


def _text(element) -> str:
    return "".join(t.text or "" for t in element.iter(f"{{{MAIN}}}t"))


def _column(reference: str) -> int:
    """0 for A, 26 for AA."""
    n = 0
    for c in re.match("[A-Z]*", reference).group():
        n = n * 26 + ord(c) - 64
    return n - 1


def parsed(content: bytes) -> Iterator[tuple[str, int, list[str | None]]]:
    """(sheet, number of the row, cells) of a workbook, absent cells null; values as text, true and false as 1 and 0."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        names = set(book.namelist())
        shared = [_text(x) for x in ElementTree.fromstring(book.read("xl/sharedStrings.xml")).findall(f"{{{MAIN}}}si")] if "xl/sharedStrings.xml" in names else []
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
        for sheet in ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{{{MAIN}}}sheet"):
            path = targets[sheet.get(f"{{{LINKS}}}id")]
            with book.open(path.lstrip("/") if path.startswith("/") else f"xl/{path}") as part:
                at = 0
                for _, row in ElementTree.iterparse(part):
                    if row.tag != f"{{{MAIN}}}row":
                        continue
                    at = int(row.get("r") or at + 1)
                    cells: list[str | None] = []
                    for c in row.findall(f"{{{MAIN}}}c"):
                        place = _column(c.get("r")) if c.get("r") else len(cells)
                        cells += [None] * (place + 1 - len(cells))
                        value = c.find(f"{{{MAIN}}}v")
                        kind = c.get("t")
                        cells[place] = _text(c) if kind == "inlineStr" else None if value is None or value.text is None else shared[int(value.text)] if kind == "s" else value.text
                    yield sheet.get("name"), at, cells
                    row.clear()


def rows_of(books: DataFrame, name: str = "path", content: str = "content") -> DataFrame:
    """(name, sheet, row, cells) of all sheets of all workbooks; a workbook is one task's work."""

    def each(batches):
        for batch in batches:
            for book, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = [(book, *r) for r in parsed(raw)] if raw else []
                yield pa.record_batch([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.string(), pa.int64(), pa.list_(pa.string())))], ["name", "sheet", "row", "cells"])

    return books.select(F.col(name).cast("string"), content).mapInArrow(each, ROWS)


def _letters(k: int) -> str:
    out = ""
    k += 1
    while k:
        k, r = divmod(k - 1, 26)
        out = chr(65 + r) + out
    return out


def written_book(sheets: dict[str, list[tuple[int, list[str | None]]]]) -> bytes:
    """A workbook of these sheets: (number of the row, cells) each; null cells are absent, control characters that XML can't hold go."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        every = range(1, len(sheets) + 1)
        kinds = "".join(f'<Override PartName="/xl/worksheets/sheet{k}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for k in every)
        book.writestr("[Content_Types].xml", f'{HEAD}<Types xmlns="{PACKAGE}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>{kinds}</Types>')
        book.writestr("_rels/.rels", f'{HEAD}<Relationships xmlns="{PACKAGE}/relationships"><Relationship Id="rId1" Type="{LINKS}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        names = "".join(f'<sheet name="{escape(n, {chr(34): "&quot;"})}" sheetId="{k}" r:id="rId{k}"/>' for k, n in zip(every, sheets))
        book.writestr("xl/workbook.xml", f'{HEAD}<workbook xmlns="{MAIN}" xmlns:r="{LINKS}"><sheets>{names}</sheets></workbook>')
        links = "".join(f'<Relationship Id="rId{k}" Type="{LINKS}/worksheet" Target="worksheets/sheet{k}.xml"/>' for k in every)
        book.writestr("xl/_rels/workbook.xml.rels", f'{HEAD}<Relationships xmlns="{PACKAGE}/relationships">{links}</Relationships>')
        for k, rows in zip(every, sheets.values()):
            cell = lambda r, c, v: f'<c r="{_letters(c)}{r}" t="inlineStr"><is><t xml:space="preserve">{escape(_BAD.sub("", v), {chr(13): "&#13;"})}</t></is></c>'
            body = "".join(f'<row r="{r}">{"".join(cell(r, c, v) for c, v in enumerate(cells) if v is not None)}</row>' for r, cells in rows)
            book.writestr(f"xl/worksheets/sheet{k}.xml", f'{HEAD}<worksheet xmlns="{MAIN}"><sheetData>{body}</sheetData></worksheet>')
    return out.getvalue()


def books_of(rows: DataFrame) -> DataFrame:
    """(name, content): a workbook for each name out of (name, sheet, row, cells), its sheets by name; each is one task's work, as a file of the format is."""

    def build(table: pa.Table) -> pa.Table:
        sheets: dict[str, list] = {}
        for sheet, row, cells in zip(*(table.sort_by([("sheet", "ascending"), ("row", "ascending")]).column(c).to_pylist() for c in ("sheet", "row", "cells"))):
            sheets.setdefault(sheet, []).append((row, cells or []))
        return pa.table({"name": table.column("name")[:1].to_pylist(), "content": [written_book(sheets)]}, schema=pa.schema([("name", pa.string()), ("content", pa.binary())]))

    return rows.select("name", "sheet", F.col("row").cast("long").alias("row"), "cells").groupBy("name").applyInArrow(build, "name string, content binary")
