"""Source packages: numbered stories, their archive and their workbook, built
and published as one version of a file set in one job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.segments import prefix_sums
from ..operators.structure import index_stories
from ..schemas import CONTENT_HEADERS
from .file_sets import set_files, write_set
from .files import written
from .workbooks import _MAIN, _PARTS, _REL

RECORD = "source_package.json"
#: Rows of a sheet after its header: the most that the file format has.
SHEET_ROWS = 1_048_575
#: Bytes of stories that share an archive.
VOLUME = 256 << 20
SHEET = "xl/worksheets/sheet1.xml"
COLUMNS = ["psr_id", "psr_content", "content_tag", "content"]


def _numbered(stem: str, n: Column, end: str) -> Column:
    """The first file has the plain name, the next ones a number."""
    return F.concat(F.lit(stem), F.when(n > 0, F.format_string("-%05d", n + 1)).otherwise(""), F.lit(end))


def _xml(value: Column) -> Column:
    plain = F.coalesce(value, F.lit(""))
    fine = F.when(plain.rlike("[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\ufffe\\uffff]"), F.raise_error(F.concat(F.lit("character that no workbook holds: "), F.hex(plain))).cast("string")).otherwise(plain)
    # A bare carriage return would be read back as a line feed.
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("\r", "&#13;")):
        fine = F.replace(fine, F.lit(char), F.lit(entity))
    return fine


def _sheet_row(number: Column, values: Sequence[Column]) -> Column:
    """A row of literal text cells; empty ones are left out."""
    at = number.cast("string")
    cells = [F.when(F.coalesce(v, F.lit("")) != "", F.concat(F.lit(f'<c r="{chr(65 + i)}'), at, F.lit('" t="inlineStr"><is><t xml:space="preserve">'), _xml(v), F.lit("</t></is></c>"))).otherwise("") for i, v in enumerate(values)]
    return F.concat(F.lit('<row r="'), at, F.lit('">'), *cells, F.lit("</row>"))


def workbook_chunks(rows: DataFrame, order: str, columns: Sequence[str], headers: Sequence[str], stem: str = "content_export", sheet: str = "Content", most_rows: int = SHEET_ROWS) -> DataFrame:
    """Chunks, for ``write_set``, of literal workbooks of the columns
    ``columns`` of rows numbered 1, 2, ... in ``order``; more rows than a
    sheet has go into further workbooks. No rows give a workbook of its header
    alone."""
    place = F.col(order).cast("long") - 1
    book, line = F.floor(place / most_rows).cast("long"), place % most_rows + 2
    body = rows.select(_numbered(stem, book, ".xlsx").alias("name"), F.lit(SHEET).alias("member"), line.alias("seq"), _sheet_row(line, [F.col(c) for c in columns]).alias("content"))
    # The number of books is the last row's, so books need no pass of their own.
    last = rows.agg(F.coalesce(F.floor((F.max(F.col(order).cast("long")) - 1) / most_rows), F.lit(0)).cast("long").alias("last"))
    books = last.select(F.explode(F.sequence(F.lit(0).cast("long"), "last")).alias("book")).select(_numbered(stem, F.col("book"), ".xlsx").alias("name"))
    head = f'<worksheet xmlns="{_MAIN[1:-1]}"><sheetData><row r="1">' + "".join(f'<c r="{chr(65 + i)}1" t="inlineStr"><is><t>{h}</t></is></c>' for i, h in enumerate(headers)) + "</row>"
    parts = {**_PARTS, "xl/workbook.xml": f'<workbook xmlns="{_MAIN[1:-1]}" xmlns:r="{_REL[1:-1]}"><sheets><sheet name="{sheet}" sheetId="1" r:id="r1"/></sheets></workbook>'}
    fixed = [(m, 0, c) for m, c in parts.items()] + [(SHEET, 0, head), (SHEET, most_rows + 2, "</sheetData></worksheet>")]
    each = F.array(*(F.struct(F.lit(m).alias("member"), F.lit(n).cast("long").alias("seq"), F.lit(c).alias("content")) for m, n, c in fixed))
    frame = books.select("name", F.inline(each))
    return body.unionByName(frame).select("name", "member", "seq", F.encode("content", "UTF-8").alias("content"))


def package_files(stories: DataFrame, volume: int = VOLUME, sheet_rows: int = SHEET_ROWS) -> tuple[DataFrame, dict]:
    """(chunks for ``write_set``, counts) of the package of stories (file_no,
    file_name, xml): the stories with ids under Text/, archives of them of
    about ``volume`` bytes, and the workbook of their content rows."""
    rows, numbered = index_stories(stories)
    texts = written(numbered.select("file_no", "file_name", F.encode("xml", "UTF-8").alias("content")), "stories")
    rows = written(rows, "rows")
    sizes = prefix_sums(texts.select("file_no", F.octet_length("content").cast("long").alias("bytes")), "file_no", ["bytes"])
    nth = F.floor(F.col("before_bytes") / volume).cast("long")
    plain = texts.select(F.concat(F.lit("Text/"), "file_name").alias("name"), F.lit(None).cast("string").alias("member"), F.lit(0).cast("long").alias("seq"), "content")
    zipped = texts.join(sizes, "file_no").select(_numbered("Text", nth, ".zip").alias("name"), F.concat(F.lit("Text/"), "file_name").alias("member"), F.lit(0).cast("long").alias("seq"), "content")
    chunks = plain.unionByName(zipped).unionByName(workbook_chunks(rows, "row_no", COLUMNS, CONTENT_HEADERS, most_rows=sheet_rows))
    counted = rows.agg(F.count("*").alias("dataRows"), F.count(F.when(F.col("psr_id") != "", 1)).alias("paragraphs")).first()
    return chunks, {"status": "complete", "storyCount": texts.count(), **counted.asDict()}


def build_package(stories: DataFrame, folder: str, volume: int = VOLUME, sheet_rows: int = SHEET_ROWS) -> int:
    """Publish the package of stories into the file set of ``folder``, with a
    record of all files, their bytes and hashes; returns the version. Stories
    without rows or of one name are refused."""
    if stories.groupBy("file_name").count().where("count > 1").limit(1).count():
        raise ValueError("two stories of one name")
    chunks, counts = package_files(stories, volume, sheet_rows)
    if not counts["storyCount"]:
        raise ValueError("a package needs a story")
    return write_set(chunks, folder, overwrite=True, record=RECORD, facts=counts)


def package_faults(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """(name, fault): contents that are missing or damaged, and members of
    archives that are not the story of their name."""
    found = set_files(spark, folder, version)
    sha = F.sha2("content", 256)
    texts = found.where("error is null and member is null and name like 'Text/%'").select(F.col("name").alias("story"), sha.alias("want"))
    members = found.where("member is not null and name like 'Text%.zip'").select("name", F.col("member").alias("story"), sha.alias("got"))
    other = members.join(texts, "story", "full").where("not want <=> got")
    faults = other.select(F.coalesce("name", "story").alias("name"), F.concat(F.lit("archive and story differ: "), "story").alias("fault"))
    return found.where("error is not null").select("name", F.col("error").alias("fault")).union(faults)
