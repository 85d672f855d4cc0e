"""File sets written by tasks, and the packages built on them."""

import io
import json
import subprocess
import sys
import zipfile

import pytest
from pyspark.sql import functions as F

from textloom.plans.commit import CommitError, FileSet, LocalStore
from textloom.sources import file_sets, packages
from textloom.sources.sheet_source import sheets
from textloom.sources.workbooks import read_sheets

ROWS = "name string, member string, seq long, content binary"


def chunks(spark, rows):
    return spark.createDataFrame(rows, ROWS)


def names(folder):
    return FileSet(LocalStore(folder)).version()[1]


def test_plain_files_and_archives(spark, tmp_path):
    rows = [("a/one.txt", None, i, str(i).encode()) for i in range(12)] + [("z.zip", "m/big", i, b"x" * 1000) for i in range(50)] + [("z.zip", "m/small", 0, "é".encode()), ("z.zip", "void", 3, None), ("none", None, 0, None)]
    assert file_sets.write_set(chunks(spark, rows), str(tmp_path), record="list.json", facts={"n": 1}) == 1
    held = FileSet(LocalStore(tmp_path))
    assert held.read("a/one.txt") == b"01234567891011" and held.read("none") == b""
    with zipfile.ZipFile(io.BytesIO(held.read("z.zip"))) as z:
        assert z.testzip() is None and z.namelist() == ["m/big", "m/small", "void"]
        assert z.read("m/big") == b"x" * 50_000 and z.read("m/small") == "é".encode() and z.read("void") == b""
    listed = json.loads(held.read("list.json"))
    assert listed["n"] == 1 and {n: f["sha256"] for n, f in listed["files"].items()} == {n: s for n, s in names(tmp_path).items() if n != "list.json"}
    assert listed["files"]["a/one.txt"]["bytes"] == 14
    # The same rows in other partitions give the same bytes.
    assert file_sets.write_set(chunks(spark, rows[::-1]).repartition(7), str(tmp_path), record="list.json", facts={"n": 1}) == 2
    assert held.version(1)[1] == held.version(2)[1]


def test_append_overwrite_and_empty(spark, tmp_path):
    file_sets.write_set(chunks(spark, [("a", None, 0, b"1"), ("b", None, 0, b"2")]), str(tmp_path))
    assert file_sets.write_set(chunks(spark, [("b", None, 0, b"3")]), str(tmp_path)) == 2
    held = FileSet(LocalStore(tmp_path))
    assert (held.read("a"), held.read("b"), held.read("b", 1)) == (b"1", b"3", b"2")
    assert file_sets.write_set(chunks(spark, []), str(tmp_path)) == 2  # nothing to add
    assert file_sets.write_set(chunks(spark, [("c", None, 0, b"4")]), str(tmp_path), overwrite=True) == 3
    assert set(names(tmp_path)) == {"c"}
    file_sets.write_set(chunks(spark, []), str(tmp_path), overwrite=True)
    assert names(tmp_path) == {}


@pytest.mark.parametrize("rows", [
    [("a", None, 0, b"1"), ("a", None, 0, b"2")],
    [("a", None, None, b"1")],
    [("a", None, 0, b"1"), ("a", "m", 1, b"2")],
    [("../a", None, 0, b"1")],
    [(None, None, 0, b"1")],
    [("a.zip", "../m", 0, b"1")],
    [("a.zip", "m", 0, b"1"), ("a.zip", "M", 0, b"2")],
])
def test_refused_rows_publish_nothing(spark, tmp_path, rows):
    file_sets.write_set(chunks(spark, [("kept", None, 0, b"1")]), str(tmp_path))
    with pytest.raises(Exception, match="CommitError|WRITE|chunks|inside|member"):
        file_sets.write_set(chunks(spark, [*rows, ("fine", None, 0, b"1")]), str(tmp_path))
    assert set(names(tmp_path)) == {"kept"}
    assert not list((tmp_path / "staged").iterdir())


def test_failed_job_publishes_nothing(spark, tmp_path):
    boom = F.when(F.col("name") == "n7", F.raise_error(F.lit("lost"))).otherwise(F.col("content"))
    rows = chunks(spark, [(f"n{i}", None, 0, b"x") for i in range(20)]).repartition(4)
    with pytest.raises(Exception, match="lost"):
        file_sets.write_set(rows.withColumn("content", boom.cast("binary")), str(tmp_path))
    assert names(tmp_path) == {}


def test_other_writer(tmp_path):
    writer = file_sets._Writer(str(tmp_path), False, None, None)
    message = file_sets._Stored(list(file_sets.stored([("a", None, 0, b"mine")], str(tmp_path))))
    FileSet(LocalStore(tmp_path)).commit({"b": "other"})
    FileSet(LocalStore(tmp_path)).commit({"a": "theirs"})
    with pytest.raises(CommitError, match="another writer"):
        writer.commit([message])
    late = file_sets._Writer(str(tmp_path), False, None, None)
    FileSet(LocalStore(tmp_path)).commit({"b": "newer"})
    late.commit([message, None])  # another file: both are kept
    held = FileSet(LocalStore(tmp_path))
    assert (held.read("a"), held.read("b")) == (b"mine", b"newer")
    with pytest.raises(CommitError, match="two tasks"):
        late.commit([message, message])


def test_lost_task(tmp_path):
    """A task dies after it stored files; its next attempt writes them again."""
    script = f"""
import os, pyspark.sql.functions as F
from pyspark.sql import SparkSession
from textloom.sources.file_sets import write_set
spark = SparkSession.builder.master("local[2,4]").config("spark.sql.shuffle.partitions", "1").config("spark.ui.enabled", "false").getOrCreate()
import textloom.sources.file_sets as fs
real = fs._Content.keep
def keep(self):
    out = real(self)
    try:
        open({str(tmp_path / "died")!r}, "x").close()
    except FileExistsError:
        return out
    os._exit(1)
class Dying(fs._Writer):
    def write(self, iterator):
        fs._Content.keep = keep
        return super().write(iterator)
class Sink(fs.FileSetSink):
    def writer(self, schema, overwrite):
        return Dying(self.options["path"], overwrite, None, None)
fs.FileSetSink = Sink
df = spark.range(40).select(F.concat(F.lit("n"), (F.col("id") % 8).cast("string")).alias("name"), F.lit(None).cast("string").alias("member"), F.col("id").alias("seq"), F.col("id").cast("string").cast("binary").alias("content"))
print("version", write_set(df, {str(tmp_path / "set")!r}))
"""
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=180)
    assert "version 1" in done.stdout, done.stderr[-2000:]
    assert (tmp_path / "died").exists()
    held = FileSet(LocalStore(tmp_path / "set"))
    assert {n: held.read(n) for n in held.version()[1]} == {f"n{k}": "".join(str(i) for i in range(k, 40, 8)).encode() for k in range(8)}
    assert held.faults() == []


def stories(spark, n):
    para = lambda *c: "<ParagraphStyleRange>" + "".join(f"<Content>{x}</Content>" for x in c) + "</ParagraphStyleRange>"
    return spark.createDataFrame([(i, f"Page_{i}.icml", "<Story>" + para(f"=A{i}", " x &amp; y\r\n") + para("") + para() + para(f"last {i}\t") + "</Story>") for i in range(n)], "file_no int, file_name string, xml string")


def test_package(spark, tmp_path):
    folder = str(tmp_path / "p")
    assert packages.build_package(stories(spark, 30), folder, volume=2000, sheet_rows=50) == 1
    held = FileSet(LocalStore(folder))
    files = held.version()[1]
    books, zips = sorted(n for n in files if n.endswith(".xlsx")), sorted(n for n in files if n.endswith(".zip"))
    assert books == ["content_export-00002.xlsx", "content_export-00003.xlsx", "content_export.xlsx"] and len(zips) > 2 and "Text.zip" in zips
    record = json.loads(held.read(packages.RECORD))
    assert (record["status"], record["storyCount"], record["dataRows"]) == ("complete", 30, 120)
    assert {n: f["sha256"] for n, f in record["files"].items()} == {n: s for n, s in files.items() if n != packages.RECORD}
    members = {}
    for z in zips:
        with zipfile.ZipFile(io.BytesIO(held.read(z))) as archive:
            for n in archive.namelist():
                assert n not in members
                members[n] = archive.read(n)
    assert members == {n: held.read(n) for n in files if n.startswith("Text/")} and len(members) == 30
    rows = []
    for b in ["content_export.xlsx", *books[:2]]:
        cells = read_sheets(held.read(b))
        assert {c[3] for c in cells} == {"text"}
        assert [c[4] for c in cells if c[1] == 1] == packages.CONTENT_HEADERS
        last = max(c[1] for c in cells)
        at = {(c[1], c[2]): c[4] for c in cells}
        rows += [tuple(at.get((r, c), "") for c in (1, 2, 3, 4)) for r in range(2, last + 1)]
    want = []
    for i in range(30):
        p, c = 4 * i, 4 * i
        want += [(f"{p:05d}", f"=A{i} x &amp; y\n", f"{c:05d}", f"=A{i}"), ("", "", f"{c + 1:05d}", " x &amp; y\n"), (f"{p + 1:05d}", "", f"{c + 2:05d}", ""), (f"{p + 3:05d}", f"last {i}\t", f"{c + 3:05d}", f"last {i}\t")]
    assert rows == want
    story = held.read("Text/Page_2.icml").decode()
    assert story == '<Story><ParagraphStyleRange id="00008"><Content id="00008">=A2</Content><Content id="00009"> x &amp; y\n</Content></ParagraphStyleRange><ParagraphStyleRange id="00009"><Content id="00010"></Content></ParagraphStyleRange><ParagraphStyleRange id="00010"></ParagraphStyleRange><ParagraphStyleRange id="00011"><Content id="00011">last 2\t</Content></ParagraphStyleRange></Story>'
    assert packages.package_faults(spark, folder).count() == 0
    assert sheets(spark, f"{folder}/data", names=[files[b] for b in books]).where("error is null and column = 3 and row > 1").count() == 120


def test_package_faults(spark, tmp_path):
    folder = str(tmp_path / "p")
    packages.build_package(stories(spark, 4), folder)
    held = FileSet(LocalStore(folder))
    held.commit({"Text/Page_1.icml": "other", "Text/Page_9.icml": "new"})
    damaged = tmp_path / "p" / "data" / held.version()[1]["content_export.xlsx"]
    damaged.write_bytes(damaged.read_bytes() + b"x")
    assert sorted(r.name for r in packages.package_faults(spark, folder).collect()) == ["Text.zip", "Text/Page_9.icml", "content_export.xlsx"]
    assert packages.package_faults(spark, folder, 1).count() == 1  # the damage is in both versions
    with pytest.raises(ValueError, match="one name"):
        packages.build_package(stories(spark, 2).withColumn("file_name", F.lit("a")), folder)
    with pytest.raises(ValueError, match="needs a story"):
        packages.build_package(stories(spark, 0), folder)
    with pytest.raises(Exception, match="no workbook holds"):
        packages.build_package(stories(spark, 2).withColumn("xml", F.replace("xml", F.lit("last"), F.lit("\x01"))), folder)
    assert held.version()[0] == 2


def test_a_long_list_is_never_held(spark, tmp_path, monkeypatch):
    """Lists in parts: written as runs, published as parts, read by tasks; the
    driver never asks for a version's whole list."""
    import pyarrow as pa

    from textloom.plans import commit

    def refused(*_):
        raise AssertionError("the whole list is held")

    folder = str(tmp_path / "set")
    rows = [(f"n{k:04d} é\n", None, 0, str(k).encode()) for k in range(1500)]

    def write(rows, overwrite=False, record=None, facts=None):
        """As tasks and the driver do, in this process; two tasks."""
        writer = file_sets._Writer(folder, overwrite, record, facts)
        tasks = [[r for i, r in enumerate(rows) if i % 2 == k] for k in (0, 1)]
        batches = [pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*t), (pa.string(), pa.string(), pa.int64(), pa.binary()))], names=["name", "member", "seq", "content"]) for t in tasks if t]
        messages = [writer.write(iter([b])) for b in batches]
        writer.commit(messages)
        return writer, messages

    with monkeypatch.context() as m:
        m.setattr(commit, "PART", 400)
        m.setattr(file_sets, "RUN", 300)
        m.setattr(file_sets, "READ", 1000)
        m.setattr(FileSet, "version", refused)
        _, messages = write(rows, True, "r.json", '{"a": 1}')
        assert [(len(t.files), len(t.runs)) for t in messages] == [(0, 3), (0, 3)]
        write([(rows[0][0], None, 0, b"new"), ("zz", None, 0, b"z")])
        assert FileSet(folder).newest() == 2
        found = {r.name: bytes(r.content) for r in file_sets.set_files(spark, folder).where("error is null").collect()}
        log = json.loads((tmp_path / "set" / "log" / "000000000002.json").read_text())
    want = {r[0]: r[3] for r in rows}
    record = json.loads(found.pop("r.json"))
    assert found == {**want, rows[0][0]: b"new", "zz": b"z"} and len(log["parts"]) == 4 and "files" not in log
    assert record["a"] == 1 and list(record["files"]) == sorted(want) and {v["bytes"] for v in record["files"].values()} == {1, 2, 3, 4}
    held = FileSet(LocalStore(tmp_path / "set"))
    assert len(held.version(1)[1]) == 1501 and held.read(rows[0][0], 1) == b"0" and held.read(rows[0][0]) == b"new" and not held.faults()
    assert not list((tmp_path / "set" / "staged").glob("*.run"))
    late = file_sets._Writer(folder, True, None, None)
    write([("zz", None, 0, b"y")])
    with pytest.raises(CommitError, match="another writer"):
        late.commit([file_sets._Stored([("zz", held.version()[1]["zz"], 1)])])
    write([("one", None, 0, b"1")], True)
    assert held.newest() == 4 and list(held.version()[1]) == ["one"]
    held.collect(keep=2)
    assert len(held.version(3)[1]) == 1502 and not held.faults(3)
