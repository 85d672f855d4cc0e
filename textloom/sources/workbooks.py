"""Spreadsheet workbooks: a distributed reader on the standard library.

Files come through Spark's binaryFile source, so any store that Spark reads
will do, and each file is parsed in its own row. Cells must be literal text:
formulas, error values and other types are faults, not silently converted.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Sequence
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import cell, is_blank, is_error_literal, size_pair, text, trim
from ..operators.segments import fill_down, section_of
from ..schemas import CONTENT_HEADERS
from .files import write_files

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


def _column(address: str) -> int:
    n = 0
    for c in re.match("[A-Z]+", address)[0]:
        n = n * 26 + ord(c) - 64
    return n


def read_sheets(raw: bytes, most_bytes: int = 256 << 20) -> list[tuple[str, int, int, str, str]]:
    """(sheet, row, column, kind, value) of all cells with content; kinds are
    text, number, boolean, error and formula."""
    out = []
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        if sum(i.file_size for i in z.infolist()) > most_bytes:
            raise ValueError("workbook is over the size bound")
        names = set(z.namelist())

        def load(name):
            return ElementTree.fromstring(z.read(name))

        shared = []
        if "xl/sharedStrings.xml" in names:
            shared = ["".join(t.text or "" for t in si.iter(f"{_MAIN}t")) for si in load("xl/sharedStrings.xml").findall(f"{_MAIN}si")]
        targets = {r.get("Id"): r.get("Target") for r in load("xl/_rels/workbook.xml.rels")}
        for sheet in load("xl/workbook.xml").iter(f"{_MAIN}sheet"):
            target = targets[sheet.get(f"{_REL}id")].lstrip("/")
            for c in load(target if target.startswith("xl/") else f"xl/{target}").iter(f"{_MAIN}c"):
                kind, value = c.get("t", "n"), c.findtext(f"{_MAIN}v")
                if kind == "inlineStr":
                    value = "".join(t.text or "" for t in c.iter(f"{_MAIN}t"))
                elif kind == "s" and value is not None:
                    value = shared[int(value)]
                if value is None and c.find(f"{_MAIN}f") is None:
                    continue
                named = "formula" if c.find(f"{_MAIN}f") is not None else {"s": "text", "inlineStr": "text", "str": "text", "e": "error", "b": "boolean"}.get(kind, "number")
                address = c.get("r")
                out.append((sheet.get("name"), int(re.search(r"\d+", address)[0]), _column(address), named, value or ""))
    return out


CELLS = "sheet string, row int, column int, kind string, value string"


def cells(spark: SparkSession, path: str, glob: str = "*.xlsx") -> DataFrame:
    """(path, sheet, row, column, kind, value, error) of workbooks under
    ``path``; a file that cannot be read gives one row with its error."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path).select("path", "content")

    def run(batches):
        for pdf in batches:
            for name, raw in zip(pdf["path"], pdf["content"]):
                try:
                    rows = [(name, *r, None) for r in read_sheets(raw)]
                except (ValueError, KeyError, zipfile.BadZipFile, ElementTree.ParseError) as e:
                    rows = [(name, None, None, None, None, None, str(e) or type(e).__name__)]
                yield pd.DataFrame(rows, columns=["path", "sheet", "row", "column", "kind", "value", "error"]).astype({"row": "Int32", "column": "Int32"})

    return files.mapInPandas(run, f"path string, {CELLS}, error string")


def content_table(found: DataFrame) -> DataFrame:
    """Four-column content rows of single-sheet workbooks, cells normalised."""
    wide = found.where("column <= 4 and row > 1").groupBy("path", "row").agg(*(F.max(F.when(F.col("column") == i + 1, F.col("value"))).alias(f"c{i}") for i in range(4)))
    names = ["psr_id", "psr_content", "content_tag", "content"]
    return wide.select("path", (F.col("row") - 1).cast("long").alias("row_no"), *(cell(F.col(f"c{i}")).alias(n) for i, n in enumerate(names)))


def workbook_faults(found: DataFrame, headers: Sequence[str] = CONTENT_HEADERS) -> DataFrame:
    """(path, fault): unreadable, several sheets, cells that are no literal
    text, other headers, no data row, content beyond the last header column."""
    good = found.where("error is null")
    say = lambda df, fault: df.select("path", fault.alias("fault"))
    head = good.where("row = 1").groupBy("path", "sheet").agg(F.map_from_entries(F.collect_list(F.struct("column", trim(F.col("value"))))).alias("h"))
    # The condition is spelled per column, so any missing header counts.
    other = head.where(F.exists(F.array(*(~F.coalesce(F.try_element_at("h", F.lit(i + 1)), F.lit("")).eqNullSafe(F.lit(n)) for i, n in enumerate(headers))), lambda x: x))
    beyond = good.where((F.col("column") > len(headers)) & (text(F.col("value")) != "")).groupBy("path").agg(F.min(F.struct("row", "column")).alias("at"))
    return (
        say(found.where("error is not null"), F.col("error"))
        .union(say(good.groupBy("path").agg(F.countDistinct("sheet").alias("n")).where("n > 1"), F.lit("several sheets")))
        .union(say(good.where((F.col("kind") != "text") | is_error_literal(F.col("value"))), F.concat_ws(" ", F.lit("no literal text in row"), "row", F.lit("column"), "column")))
        .union(say(other, F.lit("other headers")))
        .union(say(good.groupBy("path").agg(F.max("row").alias("n")).where("n < 2"), F.lit("no data rows")))
        .union(say(beyond, F.concat_ws(" ", F.lit("content beyond the columns in row"), F.col("at.row"))))
    )


def header_issues(found: DataFrame, headers: Sequence[str] = CONTENT_HEADERS) -> DataFrame:
    """Issue rows of workbooks without a data row, and of each header cell
    that is not the contract's."""
    good = found.where("error is null")
    head = good.where("row = 1").groupBy("path").agg(F.map_from_entries(F.collect_list(F.struct("column", trim(F.col("value"))))).alias("h"))
    shape = good.groupBy("path").agg(F.max("row").alias("n")).join(head, "path", "left").withColumn("h", F.coalesce("h", F.create_map().cast("map<int,string>")))
    cell_of = lambda i: F.coalesce(F.try_element_at("h", F.lit(i + 1)), F.lit(""))
    say = lambda column, code, message: F.struct(F.lit(column).cast("int").alias("column_no"), F.lit(code).alias("code"), message.alias("message"))
    changed = [F.when((F.col("n") >= 2) & (cell_of(i) != name), say(i + 1, "HEADER_CHANGED", F.concat(F.lit(f"header must be {name}, found "), cell_of(i)))) for i, name in enumerate(headers)]
    empty = F.when(F.col("n") < 2, say(None, "WORKBOOK_EMPTY", F.lit("no data rows")))
    each = shape.select("path", F.explode(F.array_compact(F.array(empty, *changed))).alias("i"))
    return each.select("path", F.lit(1).cast("long").alias("row_no"), "i.column_no", F.lit("").alias("content_id"), F.lit("error").alias("severity"), "i.code", "i.message")


def glossary_sheet(found: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    """(glossary, faults) of a sheet whose first column is the source and
    whose first row names the fields; blank rows are skipped. Faults: blank
    or repeated source, an untrimmed cell, an error literal."""
    head = found.where("row = 1").select("path", "column", F.col("value").alias("field"))
    body = found.where("row > 1").select("path", "row", "column", text(F.col("value")).alias("value"))
    filled = body.groupBy("path", "row").agg(F.max(F.when(F.col("column") == 1, F.col("value"))).alias("source"), F.bool_or(~is_blank(F.col("value"))).alias("any")).where("any")
    rows = filled.select("path", "row", text(F.col("source")).alias("source"))
    faults = rows.where(is_blank(F.col("source"))).select("path", "row", F.lit("blank source").alias("fault"))
    faults = faults.union(rows.groupBy("path", "source").agg(F.max("row").alias("row"), F.count("*").alias("n")).where("n > 1 and source <> ''").select("path", "row", F.lit("repeated source")))
    faults = faults.union(body.where(trim(F.col("value")) != F.col("value")).select("path", "row", F.lit("untrimmed cell")))
    faults = faults.union(body.where(is_error_literal(F.col("value"))).select("path", "row", F.lit("error literal")))
    named = rows.join(head.where("column > 1"), "path").join(body, ["path", "row", "column"], "left")
    return named.select(F.lit(kind).alias("kind"), "source", "field", text(F.col("value")).alias("value"), F.col("row").cast("long").alias("ord")), faults


def published_sheet(rows: DataFrame, book: str, languages: Sequence[str], cells_per_language: int, heading: str | None = None) -> DataFrame:
    """Published glossary rows of a sheet given as (row_no, cells array): the
    first cell is the English term, the second its definition, then two or
    three cells (term, definition, combined) for each language. From a row
    that is ``heading`` on, kinds are words."""
    marked = section_of(rows, F.lower(trim(F.get("cells", F.lit(0)))) == (heading or "\x00").lower(), ())  # the rows of one sheet
    at = lambda i: trim(F.get("cells", F.lit(i)))
    entry = lambda i: F.struct(*(at(2 + i * cells_per_language + k).alias(n) if k < cells_per_language else F.lit("").alias(n) for k, n in enumerate(["term", "definition", "combined_definition"])))
    maps = F.map_from_arrays(F.array(*map(F.lit, languages)), F.array(*(entry(i) for i in range(len(languages)))))
    kept = marked.where((at(0) != "") & (F.lower(at(0)) != (heading or "\x00").lower()))
    return kept.select(F.lit(book).alias("book"), F.col("row_no").cast("int").alias("row"), F.when(F.col("in_section"), "words").otherwise("acronyms").alias("kind"), at(0).alias("english"), at(1).alias("english_definition"), maps.alias("translations"))


def symbol_table(rows: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """(source, target, ord) of a table with paired source and target columns,
    blank pairs left out."""
    each = rows.select("row_no", F.explode(F.array(*(F.struct(trim(F.col(a)).alias("source"), trim(F.col(b)).alias("target")) for a, b in pairs))).alias("p"))
    return each.select("p.source", "p.target", F.col("row_no").alias("ord")).where("source <> '' and target <> ''")


def typography_matrix(rows: DataFrame, languages: Sequence[str], books: Sequence[str]) -> DataFrame:
    """Long form of a size matrix given as (row_no, trim_size, style_tree1,
    style_tree2, paragraph_style, sizes array): three levels are filled down,
    one row for each size cell; a cell of another form is an error."""
    filled = fill_down(rows, ["trim_size", "style_tree1", "style_tree2"], ())  # the rows of one sheet
    each = filled.where(~is_blank(F.col("paragraph_style"))).select("*", F.posexplode("sizes").alias("i", "raw")).where(~is_blank(F.col("raw")))
    pair = F.coalesce(size_pair(F.col("raw")), F.raise_error(F.concat(F.lit("no size and leading: "), F.col("raw"))).cast("struct<size:double,leading:double,alternatives:array<double>>"))
    name = lambda names: F.get(F.array(*map(F.lit, names)), F.col("i"))
    out = each.withColumn("p", pair).withColumn("language", name(languages)).withColumn("book", name(books))
    address = F.concat(F.chr((F.col("i") + 69).cast("long")), F.col("row_no").cast("string"))
    return out.select("trim_size", "style_tree1", "style_tree2", "paragraph_style", "language", "book", "p.size", "p.leading", "p.alternatives", address.alias("source_cell"))


def fill_right(header: Sequence[str]) -> list[str]:
    """Blank header cells take the name to their left."""
    out: list[str] = []
    for h in header:
        out.append(h.strip() or (out[-1] if out else ""))
    return out


def rich_value(value: object) -> str:
    """Flattened cell value of a rich-text, formula or link object."""
    if value is None:
        return ""
    if isinstance(value, dict):
        if isinstance(value.get("richText"), list):
            return "".join(str(p.get("text", "")) for p in value["richText"])
        return str(next((value[k] for k in ("text", "result") if value.get(k) is not None), ""))
    return str(value)


def rich_text(cell: Column) -> Column:
    """Flattened text of a cell given as JSON: runs of rich text joined, else
    the text of a link or the result of a formula; other cells as they are."""
    value = F.from_json(cell, "struct<richText:array<struct<text:string>>,text:string,result:string>")
    runs = F.array_join(F.transform(value["richText"], lambda r: F.coalesce(r["text"], F.lit(""))), "")
    flat = F.when(value["richText"].isNotNull(), runs).otherwise(F.coalesce(value["text"], value["result"], F.lit("")))
    return F.when(F.ltrim(cell).startswith("{"), flat).otherwise(F.coalesce(cell, F.lit("")))


def to_frame(spark: SparkSession, rows: Sequence[tuple], ddl: str) -> DataFrame:
    return spark.createDataFrame(list(rows), T._parse_datatype_string(ddl))


# --- writing ----------------------------------------------------------------

_PARTS = {
    "[Content_Types].xml": '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/></Types>',
    "_rels/.rels": f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Type="{_REL[1:-1]}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
    "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Type="{_REL[1:-1]}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
}


def _address(row: int, column: int) -> str:
    letters = ""
    while column:
        column, rest = divmod(column - 1, 26)
        letters = chr(65 + rest) + letters
    return f"{letters}{row}"


def literal_workbook(rows: Sequence[Sequence[str | None]], sheet: str = "Sheet1") -> bytes:
    """A workbook of one sheet whose cells are all literal text: nothing in it
    is a formula, a number or a date. Empty and null cells are left out.
    ValueError for characters that XML forbids."""
    root = ElementTree.Element(f"{_MAIN}worksheet")
    data = ElementTree.SubElement(root, f"{_MAIN}sheetData")
    for r, cells_ in enumerate(rows, 1):
        line = ElementTree.SubElement(data, f"{_MAIN}row", r=str(r))
        for c, value in enumerate(cells_, 1):
            if value:
                if re.search("[\x00-\x08\x0b\x0c\x0e-\x1f\ufffe\uffff]", value):
                    raise ValueError(f"character that no workbook holds in {_address(r, c)}")
                text_ = ElementTree.SubElement(ElementTree.SubElement(ElementTree.SubElement(line, f"{_MAIN}c", r=_address(r, c), t="inlineStr"), f"{_MAIN}is"), f"{_MAIN}t")
                text_.set("{http://www.w3.org/XML/1998/namespace}space", "preserve")
                text_.text = value
    book = ElementTree.Element(f"{_MAIN}workbook")
    ElementTree.SubElement(ElementTree.SubElement(book, f"{_MAIN}sheets"), f"{_MAIN}sheet", {"name": sheet, "sheetId": "1", f"{_REL}id": "r1"})
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
        parts = {**_PARTS, "xl/workbook.xml": ElementTree.tostring(book, encoding="unicode"), "xl/worksheets/sheet1.xml": ElementTree.tostring(root, encoding="unicode")}
        for name, body in parts.items():
            # A fixed date, so that equal rows give equal bytes.
            z.writestr(zipfile.ZipInfo(name, (1980, 1, 1, 0, 0, 0)), body.encode("utf-8"))
    return held.getvalue()


def write_workbooks(books: DataFrame, folder: str, sheet: str = "Sheet1") -> int:
    """Write books (name, rows: arrays of cells in order) as literal workbooks
    into a shared folder; returns how many."""

    @F.pandas_udf("binary")
    def made(rows: pd.Series) -> pd.Series:
        return pd.Series([literal_workbook([list(r) for r in book], sheet) for book in rows], dtype=object)

    return write_files(books.select("name", made.asNondeterministic()("rows").alias("content")), folder)
