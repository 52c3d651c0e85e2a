"""HTML grids with spans, workbooks and typed CSV against plain readings."""

import random
import re
import zipfile

import pytest

from kpiloom.sources.html_grid import html_grid, read_html_grid
from kpiloom.sources.typed_csv import read_csv_typed
from kpiloom.sources.workbook import header_names, read_workbook, sheet_rows

HAND = [
    ("<table><tr><th>a<th>b</tr><tr><td rowspan=2>x<td>1</tr><tr><td>2</tr></table>", [["a", "b"], ["x", "1"], ["x", "2"]]),
    ("<table><tr><td colspan=2>h</td><td>i</td></tr><tr><td>1<td>2<td>3</table>", [["h", "h", "i"], ["1", "2", "3"]]),
    ("<table><tr><td>a<table><tr><td>in</td></tr></table>b</td><td>c</td></tr><tr><td>d</table><table><tr><td>no</table>", [["ab", "c"], ["d"]]),
    ("<p>x<table><tr><td>&#35;&#x41;&eacute;&amp;&lt; </td></tr></table>", [["#Aé&<"]]),
    ("<table><tr><td rowspan=0>a<td>b</tr><tr><td>c</tr><tr></tr></table>", [["a", "b"], ["a", "c"], ["a"]]),
    ("<table><tr><td>1<td rowspan=2>s<td>3</tr><tr><td colspan=2>w</tr></table>", [["1", "s", "3"], ["w", "s", "w"]]),
    ("<table><tr><td rowspan=x colspan=-1>a<td><script>if (a<b) {}</script>t</tr>", [["a", "t"]]),
    ("<table><!-- <tr><td>no</td></tr> --><TR><TD>y</TD></TR></table>", [["y"]]),
    ("<table></table><table><tr><td>second</table>", []), ("no table", []), ("", []), (None, []),
]


def test_hand_made_grids(spark):
    df = spark.createDataFrame([(i, h) for i, (h, _) in enumerate(HAND)], "doc long, html string")
    got = {}
    for r in html_grid(df, "html", ["doc"]).orderBy("doc", "row_no").collect():
        got.setdefault(r.doc, []).append(list(r.cells))
    assert got == {i: g for i, (_, g) in enumerate(HAND) if g}
    assert html_grid(df.limit(0), "html").count() == 0


def test_random_grids_come_back(spark):
    """A grid is cut into random rectangles, each written as one cell in the row it starts in."""
    rng, docs, want = random.Random(2), [], {}
    for doc in range(120):
        high, wide = rng.randint(1, 7), rng.randint(1, 6)
        grid = [[None] * wide for _ in range(high)]
        html = "<table>"
        for i in range(high):
            html += "<tr>"
            for j in range(wide):
                if grid[i][j] is not None:
                    continue
                across = 1
                while j + across < wide and grid[i][j + across] is None and rng.random() < 0.3:
                    across += 1
                down = rng.randint(1, high - i) if rng.random() < 0.3 else 1
                text = f"{i}.{j}"
                for a in range(i, i + down):
                    for b in range(j, j + across):
                        grid[a][b] = text
                html += f"<td rowspan={down} colspan='{across}'> {text}" + rng.choice(["</td>", "", "<table><tr><td>z</table>"])
            html += rng.choice(["</tr>", ""])
        docs.append((doc, html + "</table>"))
        want[doc] = grid
    got = {}
    for r in html_grid(spark.createDataFrame(docs, "doc long, html string").repartition(3), "html", ["doc"]).orderBy("doc", "row_no").collect():
        got.setdefault(r.doc, []).append(list(r.cells))
    assert got == want


def test_named_grid_columns(spark):
    docs = spark.createDataFrame([(1, "<table><tr><th>Query Name<th>N</tr><tr><td>q<td>1</table>"), (2, "<table><tr><th>n<th>query name</tr><tr><td>2</table>")], "row_no long, html string")
    docs = docs.withColumnRenamed("row_no", "doc")
    got = read_html_grid(docs, "html", ["query_name", "n", "gone"], ["doc"]).collect()
    assert sorted((r.doc, r.query_name, r.n, r.gone) for r in got) == [(1, "q", "1", None), (2, None, "2", None)]


NS = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'


def write_book(path, sheets, shared=(), formats=(0, 14, 20, 200), date1904=False):
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {NS} xmlns:r="{rel}"><workbookPr date1904="{int(date1904)}"/><sheets>'
                   + "".join(f'<sheet name="{n}" sheetId="{i}" r:id="r{i}"/>' for i, n in enumerate(sheets)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", "<Relationships>" + "".join(f'<Relationship Id="r{i}" Target="worksheets/sheet{i}.xml"/>' for i in range(len(sheets))) + "</Relationships>")
        z.writestr("xl/sharedStrings.xml", f"<sst {NS}>" + "".join(f"<si>{s}</si>" for s in shared) + "</sst>")
        z.writestr("xl/styles.xml", f'<styleSheet {NS}><numFmts><numFmt numFmtId="200" formatCode="yyyy\\-mm\\-dd hh:mm"/></numFmts><cellXfs>'
                   + "".join(f'<xf numFmtId="{f}"/>' for f in formats) + "</cellXfs></styleSheet>")
        for i, body in enumerate(sheets.values()):
            z.writestr(f"xl/worksheets/sheet{i}.xml", f"<worksheet {NS}>{body}</worksheet>")


@pytest.fixture(scope="module")
def book(tmp_path_factory):
    path = str(tmp_path_factory.mktemp("book") / "report.xlsx")
    rows = ('<sheetData><row r="2"><c r="A2" t="s"><v>0</v></c><c r="C2" t="s"><v>1</v></c><c r="D2" t="s"><v>0</v></c></row>'
            '<row r="3"><c r="A3"><v>1</v></c><c r="B3" s="1"><v>45000</v></c><c r="C3" s="3"><v>45000.5</v></c><c r="D3" t="b"><v>1</v></c></row>'
            '<row r="5"><c r="A5"><v>2</v></c><c r="C5" t="e"><v>#N/A</v></c><c r="D5" t="b"><v>0</v></c><c r="E5" t="str"><f>X</f><v>wide</v></c></row>'
            '</sheetData><mergeCells><mergeCell ref="D5:D6"/></mergeCells>')
    write_book(path, {"First": rows, "Empty": "<sheetData/>", "Times": '<sheetData><row><c t="inlineStr"><is><t>at</t></is></c></row><row><c s="2"><v>0.75</v></c></row></sheetData>'},
               ["<t>id</t>", "<r><t>wh</t></r><r><t>en</t></r><rPh><t>no</t></rPh>"])
    return path


def test_workbook(spark, book):
    tables, skipped = read_workbook(spark, book, existing={"times"})
    assert skipped == ["Times"] and list(tables) == ["First", "Empty"] and tables["Empty"].columns == []
    first = tables["First"]
    assert dict(first.dtypes) == {"id": "bigint", "Unnamed: 1": "date", "when": "timestamp_ntz", "id.1": "boolean", "Unnamed: 4": "string"}
    assert [tuple(map(str, r)) for r in first.orderBy("id").collect()] == [
        ("1", "2023-03-15", "2023-03-15 12:00:00", "True", "None"), ("2", "None", "None", "False", "wide")]
    assert list(read_workbook(spark, book, "p")[0]) == ["p_First", "p_Empty", "p_Times"]
    alone, _ = read_workbook(spark, book, "p", sheets=["Times"])
    assert list(alone) == ["p"] and alone["p"].first()[0] == "18:00:00"
    with pytest.raises(ValueError):
        read_workbook(spark, book, sheets=["gone"])


def test_merged_cells_and_1904(spark, book, tmp_path):
    books = spark.read.format("binaryFile").load(book)
    rows = sheet_rows(books, sheet="First", fill_merged=True).orderBy("row_no").collect()
    assert [list(r.cells) for r in rows][2:] == [["2", None, None, "false", "wide"], [None, None, None, "false"]]
    write_book(tmp_path / "b.xlsx", {"s": '<sheetData><row><c s="1"><v>0</v></c></row></sheetData>'}, date1904=True)
    assert sheet_rows(spark.read.format("binaryFile").load(str(tmp_path / "b.xlsx"))).first().cells == ["1904-01-01"]
    assert header_names(["a", None, "A", "a.1"]) == ["a", "Unnamed: 1", "A.1", "a.1.1"]


def plain_type(values, tolerance):
    from datetime import datetime
    def day(v, f):
        try:
            return bool(datetime.strptime(v, f))
        except ValueError:
            return False
    fits = {"boolean": lambda v: v.lower() in ("true", "false"), "bigint": lambda v: bool(re.fullmatch("[+-]?[0-9]+", v)) and -2**63 <= int(v) < 2**63,
            "double": lambda v: bool(re.fullmatch(r"[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?", v)), "date": lambda v: day(v, "%Y-%m-%d"),
            "timestamp_ntz": lambda v: day(v, "%Y-%m-%d") or day(v.replace("T", " "), "%Y-%m-%d %H:%M:%S")}
    kind = next((k for k, f in fits.items() if values and sum(not f(v) for v in values) <= tolerance * len(values)), "string")
    return kind, fits.get(kind, lambda v: True)


@pytest.mark.parametrize("tolerance", [0.0, 0.1])
def test_typed_csv(spark, tmp_path, tolerance):
    rng = random.Random(5)
    kinds = {"i": ["1", "-20", "+3"], "big": ["9223372036854775807", "9223372036854775808"], "d": ["1.5", "2", ".5", "1e3"], "day": ["2024-01-31", "2024-02-29"],
             "t": ["2024-01-31 10:00:00", "2024-01-31"], "b": ["true", "FALSE"], "s": ["x", "1"], "none": [""], "odd": ["12", "13"]}
    rows = [{c: rng.choice([*v, ""]) for c, v in kinds.items()} for _ in range(400)]
    for r in rows[::40]:
        r["i"], r["odd"], r["day"] = "1.5", "12d", "2023-02-30"
    text = ",".join(kinds) + "\n" + "".join(",".join(r.values()) + "\n" for r in rows) + "1,2\n" + ",".join(["1"] * 12) + "\n"
    (tmp_path / "f.csv").write_text(text)
    kept, aside = read_csv_typed(spark, str(tmp_path / "f.csv"), tolerance)
    want = {c: plain_type([r[c] for r in rows if r[c]], tolerance) for c in kinds}
    assert dict(kept.dtypes) == {c: k for c, (k, _) in want.items()}
    misfit = [[c for c in kinds if r[c] and not want[c][1](r[c])] for r in rows]
    assert kept.count() == kept.select("s").count() == sum(not m for m in misfit)
    assert sorted(list(r.misfits) for r in aside.collect() if r.misfits != ["(row)"] and "(row)" not in r.misfits) == sorted(m for m in misfit if m)
    assert kept.count() + aside.count() == len(rows) + 2
    assert aside.where("array_contains(misfits, '(row)')").count() == 2
    nulls = kept.selectExpr("count_if(i IS NULL) AS n").first().n
    assert nulls == sum(not r["i"] and not m for r, m in zip(rows, misfit))  # nothing became a null
