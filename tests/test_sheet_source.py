"""Workbook sheets through the data source."""

import tracemalloc
import zipfile

from textloom.sources import workbooks
from textloom.sources.sheet_source import _Reader, _Sheet, sheets

NS = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def book(path, named, shared=None):
    """A workbook of sheets given as (name, iterable of row XML)."""
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("xl/workbook.xml", f'<workbook {NS} xmlns:r="{REL}"><sheets>' + "".join(f'<sheet name="{n}" sheetId="{i}" r:id="r{i}"/>' for i, (n, _) in enumerate(named)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">' + "".join(f'<Relationship Id="r{i}" Type="t" Target="worksheets/s{i}.xml"/>' for i in range(len(named))) + "</Relationships>")
        if shared is not None:
            z.writestr("xl/sharedStrings.xml", f"<sst {NS}>" + "".join(f"<si><r><t>{s[:1]}</t></r><r><t>{s[1:]}</t></r></si>" for s in shared) + "</sst>")
        for i, (_, rows) in enumerate(named):
            with z.open(f"xl/worksheets/s{i}.xml", "w") as out:
                out.write(f"<worksheet {NS}><sheetData>".encode())
                for r in rows:
                    out.write(r.encode())
                out.write(b"</sheetData></worksheet>")


def inline(n, *texts):
    return f'<row r="{n}">' + "".join(f'<c r="{chr(65 + k)}{n}" t="inlineStr"><is><t>{t}</t></is></c>' for k, t in enumerate(texts)) + "</row>"


def test_all_kinds_and_faults(spark, tmp_path):
    kinds = '<row r="1"><c r="A1" t="s"><v>1</v></c><c r="B1"><v>5</v></c><c r="C1" t="b"><v>1</v></c><c r="D1" t="e"><v>#N/A</v></c><c r="E1"><f>A1</f><v>5</v></c><c r="F1"/><c r="AA1" t="str"><v>x</v></c></row>'
    book(tmp_path / "a.xlsx", [("One", [kinds]), ("Two", [inline(1, "p", "é &amp;"), inline(7, "q")])], ["zero", "uné"])
    book(tmp_path / "lost.xlsx", [("One", [inline(1, "ok"), '<row r="2"><c r="A2" t="s"><v>9</v></c></row>'])], ["only"])
    (tmp_path / "bad.xlsx").write_bytes(b"no archive")
    (tmp_path / "skip.txt").write_text("x")
    got = [(r.path.rsplit("/", 1)[1], r.sheet, r.row, r.column, r.kind, r.value) for r in sheets(spark, str(tmp_path)).where("error is null").collect()]
    assert sorted(got) == sorted([
        ("a.xlsx", "One", 1, 1, "text", "uné"), ("a.xlsx", "One", 1, 2, "number", "5"), ("a.xlsx", "One", 1, 3, "boolean", "1"), ("a.xlsx", "One", 1, 4, "error", "#N/A"),
        ("a.xlsx", "One", 1, 5, "formula", "5"), ("a.xlsx", "One", 1, 27, "text", "x"), ("a.xlsx", "Two", 1, 1, "text", "p"), ("a.xlsx", "Two", 1, 2, "text", "é &"), ("a.xlsx", "Two", 7, 1, "text", "q"), ("lost.xlsx", "One", 1, 1, "text", "ok")])
    errors = {r.path.rsplit("/", 1)[1]: r.error for r in sheets(spark, str(tmp_path)).where("error is not null").collect()}
    assert set(errors) == {"bad.xlsx", "lost.xlsx"} and "shared string" in errors["lost.xlsx"]


def test_same_cells_as_the_whole_reader(spark, tmp_path):
    for n in range(3):
        (tmp_path / f"b{n}.xlsx").write_bytes(workbooks.literal_workbook([["a", None, f"<{n}>"], [], ["", "x\ny"]], f"S{n}"))
    key = lambda df: sorted((r.path.rsplit("/", 1)[1], r.sheet, r.row, r.column, r.kind, r.value) for r in df.collect())
    assert key(sheets(spark, str(tmp_path))) == key(workbooks.cells(spark, str(tmp_path)))


def test_conditions_reach_the_reader(spark, tmp_path):
    book(tmp_path / "a.xlsx", [(n, [inline(i, n, i) for i in range(1, 50)]) for n in ("x", "y", "z")])
    df = sheets(spark, str(tmp_path))
    assert df.rdd.getNumPartitions() == 3
    one = df.where("sheet = 'y' and row < 10")
    assert one.rdd.getNumPartitions() == 1 and one.count() == 18
    two = df.where("sheet in ('x', 'z') and row <= 3 and column = 2 and value <> '2'")
    assert two.rdd.getNumPartitions() == 2 and sorted((r.sheet, r.value) for r in two.collect()) == [("x", "1"), ("x", "3"), ("z", "1"), ("z", "3")]
    assert df.where("sheet = 'none'").count() == 0


def test_long_sheet_takes_fixed_memory(tmp_path):
    """Four times the rows do not take more memory."""

    def peak(n):
        path = tmp_path / f"long{n}.xlsx"
        book(path, [("S", (inline(i, f"text {i}", "b") for i in range(1, n + 1)))])
        reader = _Reader(str(path), "*")
        tracemalloc.start()
        cells = sum(b.num_rows for b in reader.read(_Sheet(str(path), "S", "xl/worksheets/s0.xml")))
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert cells == 2 * n
        return most

    short, long = peak(20_000), peak(80_000)
    assert long < 1.2 * short and long < 30e6
