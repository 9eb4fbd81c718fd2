"""Workbooks of others' making, cells of odd characters, and pages blended over all of their chunks."""

import io
import zipfile

import numpy as np

from pagequarry.operators.similarity import blended_top_k
from pagequarry.sources import xlsx


def test_workbook_of_another_maker():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as book:
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{xlsx.MAIN}" xmlns:r="{xlsx.LINKS}"><sheets><sheet name="A &amp; B" r:id="x"/></sheets></workbook>')
        book.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="x" Target="/xl/worksheets/one.xml"/></Relationships>')
        book.writestr("xl/sharedStrings.xml", f'<sst xmlns="{xlsx.MAIN}"><si><t>plain</t></si><si><r><t>rich </t></r><r><t>text</t></r></si></sst>')
        rows = '<row r="2"><c r="B2" t="s"><v>1</v></c><c r="AA2"><v>1.5</v></c></row><row><c t="b"><v>1</v></c><c><f>A1</f></c><c t="s"><v>0</v></c></row>'
        book.writestr("xl/worksheets/one.xml", f'<worksheet xmlns="{xlsx.MAIN}"><sheetData>{rows}</sheetData></worksheet>')
    assert list(xlsx.parsed(out.getvalue())) == [("A & B", 2, [None, "rich text", *[None] * 24, "1.5"]), ("A & B", 3, ["1", None, "plain"])]


def test_workbook_round_trip(spark):
    rows = [("b1", "one", k, [f"<{k}>&\"' \n\t é😀", None, "", " x "]) for k in range(1, 60)] + [("b1", "two", 7, ["a\r\nb\x01"]), ("b2", "one", 1, []), ("b2", "one", 3, None)]
    books = xlsx.books_of(spark.createDataFrame(rows, "name string, sheet string, row long, cells array<string>"))
    got = {(r.name, r.sheet, r.row): r.cells for r in xlsx.rows_of(books, "name").collect()}
    assert got == {(b, s, k): ["a\r\nb"] if s == "two" else [c for c in cells or []] for b, s, k, cells in rows}
    assert [xlsx._letters(k) for k in (0, 25, 26, 701, 702)] == ["A", "Z", "AA", "ZZ", "AAA"] and all(xlsx._column(xlsx._letters(k) + "1") == k for k in range(2000))


def test_blended(spark):
    rng = np.random.default_rng(1)
    rows = [(int(p), bool(t), [float(x) for x in rng.normal(size=6)]) for p in range(80) for t in ([True] if p % 7 else []) + [False] * (p % 5)]
    asked = [(k, [float(x) for x in rng.normal(size=6)]) for k in range(9)]
    parts, queries = spark.createDataFrame(rows + [(900, True, None)], "page long, title boolean, v array<float>").repartition(3), spark.createDataFrame(asked, "id long, v array<float>")
    unit = lambda v: np.array(v, np.float32).astype(float) / np.linalg.norm(np.array(v, np.float32).astype(float))
    want = set()
    for q, v in asked:
        scored = []
        for p in {p for p, t, _ in rows if t}:
            sims = {kind: [unit(v) @ unit(x) for pp, t, x in rows if pp == p and t == kind] for kind in (True, False)}
            scored.append((-round(0.5 * sims[True][0] + 0.5 * max(sims[False], default=-1), 6), p))
        want |= {(q, p, n + 1) for n, (_, p) in enumerate(sorted(scored)[:12])}
    for block, groups in ((1024, 1), (4, 5)):
        assert {(r.query_id, r.page, r.rn) for r in blended_top_k(queries, parts, 12, "id", "page", "title", "v", block=block, groups=groups).collect()} == want
