"""Workbook sheets as a data source of its own: one task for each sheet.

``spark.read.format("textloom_sheets").load(folder)`` gives the cells of all
workbooks in a folder. A sheet's XML is parsed as it is inflated and each row
is forgotten once its cells are out, so a sheet of any length takes the same
memory; only its table of shared strings is held, as one block of bytes.
Conditions on the sheet's name and an upper bound of the row reach the reader.
"""

from __future__ import annotations

import fnmatch
import json
import os
import re
import zipfile
from array import array
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition, LessThan, LessThanOrEqual

from .workbooks import _MAIN, _REL, _column

FORMAT = "textloom_sheets"
SCHEMA = "path string, sheet string, row int, column int, kind string, value string, error string"
#: Cells that a task hands on at once.
BATCH = 8192
# Cell types of the file format, as kinds.
KINDS = {"s": "text", "inlineStr": "text", "str": "text", "e": "error", "b": "boolean"}
_UNREADABLE = (ValueError, KeyError, IndexError, EOFError, zipfile.BadZipFile, ElementTree.ParseError)


def _store(url: str):
    """(file system, path) of a folder or file; None for a local path."""
    if "://" in url and not url.startswith("file:"):
        from pyarrow import fs

        return fs.FileSystem.from_uri(url)
    return None, "/" + url.split(":", 1)[1].lstrip("/") if url.startswith("file:") else url


def _listed(folder: str, glob: str) -> list[str]:
    store, path = _store(folder)
    if store is None:
        found = [os.path.join(d, n) for d, _, names in os.walk(path) for n in names] if os.path.isdir(path) else [path]
    else:
        from pyarrow import fs

        head = folder.split("://", 1)[0]
        selector = fs.FileSelector(path, recursive=True)
        found = [f"{head}://{i.path}" for i in store.get_file_info(selector) if i.is_file]
    return sorted(f for f in found if fnmatch.fnmatch(f.rsplit("/", 1)[-1], glob))


def _opened(url: str):
    store, path = _store(url)
    return open(path, "rb") if store is None else store.open_input_file(path)


def _elements(stream, tag: str, within: str):
    """Elements of a tag as they end; what lies in ``within`` is then dropped."""
    holder = None
    for event, e in ElementTree.iterparse(stream, events=("start", "end")):
        if event == "start" and e.tag == within:
            holder = e
        elif event == "end" and e.tag == tag:
            yield e
            if holder is not None:
                holder.clear()


class _Strings:
    """Shared strings of a workbook: their bytes in one block, and offsets."""

    def __init__(self, archive: zipfile.ZipFile):
        self.block, self.ends = bytearray(), array("Q", [0])
        if "xl/sharedStrings.xml" in archive.namelist():
            with archive.open("xl/sharedStrings.xml") as stream:
                for e in _elements(stream, f"{_MAIN}si", f"{_MAIN}sst"):
                    self.block += "".join(t.text or "" for t in e.iter(f"{_MAIN}t")).encode("utf-8")
                    self.ends.append(len(self.block))

    def __getitem__(self, i: int) -> str:
        if not 0 <= i < len(self.ends) - 1:
            raise IndexError("shared string that the workbook does not have")
        return self.block[self.ends[i] : self.ends[i + 1]].decode("utf-8")


def sheet_parts(archive: zipfile.ZipFile) -> list[tuple[str, str]]:
    """(name, part) of the sheets of a workbook, in its order."""
    targets = {r.get("Id"): r.get("Target").lstrip("/") for r in ElementTree.fromstring(archive.read("xl/_rels/workbook.xml.rels"))}
    named = [(s.get("name"), targets[s.get(f"{_REL}id")]) for s in ElementTree.fromstring(archive.read("xl/workbook.xml")).iter(f"{_MAIN}sheet")]
    return [(name, t if t.startswith("xl/") else f"xl/{t}") for name, t in named]


def sheet_cells(archive: zipfile.ZipFile, part: str, last_row: int | None = None):
    """(row, column, kind, value) of a sheet's cells with content."""
    strings = None
    with archive.open(part) as stream:
        for row in _elements(stream, f"{_MAIN}row", f"{_MAIN}sheetData"):
            for c in row.iter(f"{_MAIN}c"):
                address = c.get("r")
                number = int(re.search(r"[0-9]+", address)[0])
                if last_row is not None and number > last_row:
                    return
                kind, value, formula = c.get("t", "n"), c.findtext(f"{_MAIN}v"), c.find(f"{_MAIN}f") is not None
                if kind == "inlineStr":
                    value = "".join(t.text or "" for t in c.iter(f"{_MAIN}t"))
                elif kind == "s" and value is not None:
                    strings = strings or _Strings(archive)
                    value = strings[int(value)]
                if value is None and not formula:
                    continue
                yield number, _column(address), "formula" if formula else KINDS.get(kind, "number"), value or ""


class _Sheet(InputPartition):
    def __init__(self, path: str, sheet: str | None, part: str | None, error: str | None = None):
        self.path, self.sheet, self.part, self.error = path, sheet, part, error


class _Reader(DataSourceReader):
    def __init__(self, folder: str, glob: str, files: str | None = None):
        self.folder, self.glob, self.files = folder, glob, files
        self.names: set[str] | None = None
        self.last_row: int | None = None

    def pushFilters(self, filters):
        """Keep what the reader does not do: all but conditions on the sheet
        (equal, in) and upper bounds of the row."""
        for f in filters:
            column = getattr(f, "attribute", None)
            if isinstance(f, (EqualTo, In)) and column == ("sheet",):
                wanted = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.names = wanted if self.names is None else self.names & wanted
            elif isinstance(f, (LessThan, LessThanOrEqual)) and column == ("row",):
                most = f.value - isinstance(f, LessThan)
                self.last_row = most if self.last_row is None else min(self.last_row, most)
                yield f  # unreadable workbooks have no row
            else:
                yield f

    def partitions(self):
        out = []
        named = [f"{self.folder.rstrip('/')}/{n}" for n in json.loads(self.files)] if self.files else _listed(self.folder, self.glob)
        for path in named:
            try:
                with _opened(path) as raw, zipfile.ZipFile(raw) as archive:
                    out += [_Sheet(path, *s) for s in sheet_parts(archive) if self.names is None or s[0] in self.names]
            except _UNREADABLE as e:
                if self.names is None:
                    out.append(_Sheet(path, None, None, str(e) or type(e).__name__))
        return out

    def read(self, partition: _Sheet | None):
        if partition is None:  # no sheet at all
            return
        p, rows = partition, []

        def batch():
            columns = list(zip(*rows))
            kinds = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["path", "sheet", "row", "column", "kind", "value", "error"])

        if p.part is None:
            rows.append((p.path, None, None, None, None, None, p.error))
        else:
            try:
                with _opened(p.path) as raw, zipfile.ZipFile(raw) as archive:
                    for cell in sheet_cells(archive, p.part, self.last_row):
                        rows.append((p.path, p.sheet, *cell, None))
                        if len(rows) >= BATCH:
                            yield batch()
                            rows = []
            except _UNREADABLE as e:
                rows.append((p.path, p.sheet, None, None, None, None, str(e) or type(e).__name__))
        if rows:
            yield batch()


class SheetSource(DataSource):
    """Options: path (a folder or file), glob (default ``*.xlsx``), files
    (JSON list of names in the folder, which is then not listed)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> _Reader:
        return _Reader(self.options["path"], self.options.get("glob", "*.xlsx"), self.options.get("files"))


def sheets(spark: SparkSession, path: str, glob: str = "*.xlsx", names: list[str] | None = None) -> DataFrame:
    """Cells of all sheets below ``path``, or of the files ``names`` in it:
    (path, sheet, row, column, kind, value, error). A workbook, or sheet, that cannot be read gives a row with
    its error (after the cells before the fault). Folders of stores that only
    Spark reads go through ``workbooks.cells`` instead."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(SheetSource)
    reader = spark.read.format(FORMAT).option("glob", glob)
    return (reader if names is None else reader.option("files", json.dumps(names))).load(path)
