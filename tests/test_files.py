"""Stories, workbooks, archives, transactions and the stream."""

import zipfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from textloom.operators import structure as st
from textloom.plans import commit
from textloom.sources import files, workbooks
from textloom.streaming import segments as stream

B = " "


def para(*contents, style="Body"):
    return f'<ParagraphStyleRange AppliedParagraphStyle="ParagraphStyle/{style}">' + "".join(f"<CharacterStyleRange>{c}</CharacterStyleRange>" for c in contents) + "</ParagraphStyleRange>"


def test_spacing_across_runs_only():
    x = "<S>" + para('<Content id="1">12 </Content>', '<Content id="2">km 3 &lt; 4&#32;km</Content>') + "</S>"
    new, report = st.typeset(x, "English")
    assert new == x.replace("12 ", f"12{B}").replace("3 &lt; 4", f"3{B}&lt;{B}4").replace("4&#32;km", f"4{B}km")
    assert st.typeset(new, "English")[0] == new and dict((r[0], r[2]) for r in report)["unit_nbsp"] == 2


def test_boundaries_and_protection():
    cells = "<S>" + para("<Table><Cell>" + para("<Content>12 </Content>") + "</Cell><Cell>" + para("<Content>km</Content>") + "</Cell></Table>") + "</S>"
    assert st.typeset(cells, "English")[0] == cells
    for x in (para("<Content>3 km</Content>", style="Credits"), para('<Content id="0004">3 km</Content>'), para("<CrossReferenceSource><Content>3 km</Content></CrossReferenceSource>")):
        x = f"<S>{x}</S>"
        assert st.typeset(x, "English", protected_ids=["4"])[0] == x


@pytest.mark.parametrize("bad", ["<a>", "<!DOCTYPE a><a/>", "<a>&x;</a>", f"<S>{para('<Content>x<b/></Content>')}</S>", "<S><Content/></S>", f"<S>{para('<Content id=\"7\"/>', '<Content id=\"007\"/>')}</S>", f"<S>{para('<Content>&#0;</Content>')}</S>", "<S></S>"])
def test_malformed(bad):
    with pytest.raises(ValueError):
        st.typeset(bad, "English")


def test_splice_rejects_overlap():
    assert st.splice(b"abcd", [(2, 3, "X"), (0, 0, "Y")]) == b"YabXd"
    with pytest.raises(ValueError):
        st.splice(b"abcd", [(0, 2, "x"), (1, 3, "y")])


def test_indexing(spark):
    inner = para("<Content>in</Content>")
    x = "<S>" + para(f"<Content>a</Content><Table>{inner}</Table><Content />") + para('<Content id="9">b</Content>') + "</S>"
    df = spark.createDataFrame([(0, "a", x), (1, "b", x)], "file_no int, file_name string, xml string")
    rows, numbered = st.index_stories(df)
    got = [(r.psr_id, r.psr_content, r.content_tag, r.content) for r in rows.orderBy("row_no").collect()]
    assert got == [("00000", "ain", "00000", "a"), ("", "", "00001", "in"), ("", "", "00002", ""), ("00001", "b", "00003", "b"), ("00002", "ain", "00004", "a"), ("", "", "00005", "in"), ("", "", "00006", ""), ("00003", "b", "00007", "b")]
    again = st.content_units(numbered)
    assert [r.content_id for r in again.orderBy("file_name", "pos").collect()] == [str(i) for i in range(8)]
    new = st.replace_contents(numbered, spark.createDataFrame([("a", "3", "neu")], "file_name string, content_id string, text string"))
    assert '<Content id="00003">neu</Content>' in new.where("file_name = 'a'").first().xml and new.where("file_name = 'b'").first().xml == numbered.where("file_name = 'b'").first().xml


def reference(text, page, self="u1", name="r1"):
    return f'<CrossReferenceSource Self="{self}" Name="{name}"><Content id="1">{text}</Content><TextVariableInstance Self="{self}v" ResultText="{page}"/></CrossReferenceSource>'


def test_reconcile():
    before = f"<S>{para('<Content id=\"0\">x</Content>' + reference('old', '1'))}</S>"
    after = f"<S>{para('<Content>x</Content>' + reference('new', 'iv', 'u9'))}</S>"
    out = st.reconcile(before, after, ["r1"])
    assert out == before.replace("old", "new").replace('"1"/>', '"iv"/>')
    assert st.reconcile(before, after, []) == before
    with pytest.raises(ValueError):
        st.reconcile(before, after.replace(">x<", ">y<"), ["r1"])
    with pytest.raises(ValueError):
        st.reconcile(before, after, ["r2"])


def test_realign():
    bad = lambda s: s.startswith("#")
    assert st.realign("a=1+2b", ["a", "#NAME?", "b"], bad) == ["a", "=1+2", "b"]
    assert st.realign("= ab", ["a", "b"], bad) == ["= a", "b"]
    for composite, segs in [("ab", ["#A", "#B"]), ("axb", ["a", "b"]), ("ax", ["a"]), ("a q b", ["a", "#N", "b"])]:
        with pytest.raises(ValueError):
            st.realign(composite, segs, bad)


def xlsx(path: Path, rows, sheets=("S",)):
    ns = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{ns}" xmlns:r="{rel}"><sheets>' + "".join(f'<sheet name="{s}" sheetId="{i + 1}" r:id="r{i}"/>' for i, s in enumerate(sheets)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", "<Relationships>" + "".join(f'<Relationship Id="r{i}" Target="worksheets/s{i}.xml"/>' for i in range(len(sheets))) + "</Relationships>")
        for i in range(len(sheets)):
            body = "".join(f'<row r="{n + 1}">' + "".join(f'<c r="{chr(65 + k)}{n + 1}" t="inlineStr"><is><t xml:space="preserve">{v}</t></is></c>' if not v.startswith("=") else f'<c r="{chr(65 + k)}{n + 1}"><f>{v[1:]}</f><v>1</v></c>' for k, v in enumerate(r) if v) + "</row>" for n, r in enumerate(rows))
            z.writestr(f"xl/worksheets/s{i}.xml", f'<worksheet xmlns="{ns}"><sheetData>{body}</sheetData></worksheet>')


def test_workbooks(spark, tmp_path):
    from textloom.schemas import CONTENT_HEADERS

    xlsx(tmp_path / "good.xlsx", [CONTENT_HEADERS, ["Body", "a b", "1", "a "], ["", "", "2", "b"]])
    xlsx(tmp_path / "bad.xlsx", [[*CONTENT_HEADERS[:3], "x", "y"], ["Body", "", "1", "=1+1", "#REF!"]], ("S", "T"))
    (tmp_path / "broken.xlsx").write_bytes(b"no archive")
    found = workbooks.cells(spark, str(tmp_path))
    t = workbooks.content_table(found.where("path like '%good%'")).orderBy("row_no").collect()
    assert [(r.row_no, r.psr_id, r.content_tag, r.content) for r in t] == [(1, "Body", "1", "a "), (2, "", "2", "b")]
    faults = workbooks.workbook_faults(found).select(F.regexp_extract("path", r"(\w+)\.xlsx", 1).alias("f"), "fault").collect()
    assert not [r for r in faults if r.f == "good"]
    assert {r.fault.split(" in row")[0] for r in faults if r.f == "bad"} >= {"several sheets", "no literal text", "other headers", "content beyond the columns"}
    assert [r for r in faults if r.f == "broken"]


def test_glossary_sheet_and_json(spark, tmp_path):
    rows = [(1, "English", "French"), (2, "cat", "chat"), (3, "", " "), (4, "cat", "x "), (5, "", "y")]
    df = spark.createDataFrame([("p", r, c + 1, v) for r, *vs in rows for c, v in enumerate(vs)], "path string, row int, column int, value string")
    g, faults = workbooks.glossary_sheet(df, "words")
    assert {(r.row, r.fault) for r in faults.collect()} >= {(4, "repeated source"), (5, "blank source"), (4, "untrimmed cell")}
    assert {(r.source, r.value) for r in g.where("ord = 2").collect()} == {("cat", "chat")}
    (tmp_path / "w.json").write_text('﻿{"EX":{"French":"EX","French Definition":"Exemple"}}', encoding="utf-8")
    assert {(r.source, r.field, r.value) for r in files.glossary_json(spark, str(tmp_path / "w.json"), "acronyms").collect()} == {("EX", "French", "EX"), ("EX", "French Definition", "Exemple")}


def test_published_and_matrix(spark):
    rows = spark.createDataFrame([(1, ["A", "da", "ta", "tda"]), (2, ["Words", "", "", ""]), (3, ["cat", "", "chat", ""])], "row_no long, cells array<string>")
    got = {r.english: (r.kind, r.translations["French"].term) for r in workbooks.published_sheet(rows, "b", ["French"], 2, "Words").collect()}
    assert got == {"A": ("acronyms", "ta"), "cat": ("words", "chat")}
    m = spark.createDataFrame([(4, "6x9", "B", "x", "Body", ["10 pt / 12 pt", ""]), (5, "", "", "", "Head", ["", "9 pt/11 or 12 pt"])], "row_no long, trim_size string, style_tree1 string, style_tree2 string, paragraph_style string, sizes array<string>")
    out = workbooks.typography_matrix(m, ["English", "French"], ["Default", "B1"]).orderBy("source_cell").collect()
    assert [(r.trim_size, r.language, r.size, r.alternatives, r.source_cell) for r in out] == [("6x9", "English", 10.0, [], "E4"), ("6x9", "French", 9.0, [12.0], "F5")]


def test_stories_and_archives(spark, tmp_path):
    for n, name in enumerate(["Page_10.icml", "Page_2.icml", "intro.icml"]):
        (tmp_path / name).write_text(f"﻿<S{n}/>", encoding="utf-8")
    assert [r.file_name for r in files.stories(spark, str(tmp_path)).orderBy("file_no").collect()] == ["Page_2.icml", "Page_10.icml", "intro.icml"]
    good, bad = tmp_path / "z" / "good.zip", tmp_path / "z" / "bad.zip"
    good.parent.mkdir()
    for p, name in ((good, "a/b.txt"), (bad, "../x")):
        with zipfile.ZipFile(p, "w") as z:
            z.writestr(name, "t")
    got = {(r.member, r.error is None) for r in files.archive_members(spark, str(good.parent)).collect()}
    assert got == {("a/b.txt", True), (None, False)}
    with pytest.raises(ValueError):
        files.expand_archive(str(bad), str(tmp_path / "out"))


@pytest.fixture(params=["local", "shared"])
def fileset(request, spark, tmp_path):
    return commit.FileSet(commit.LocalStore(tmp_path / "set") if request.param == "local" else commit.SharedStore(spark, f"file://{tmp_path}/set"))


def test_versions_publish_all_or_nothing(fileset, tmp_path):
    assert fileset.commit({"a": "old", "c": "same"}) == 1
    for stop in ("stored", "publishing"):

        def probe(name, stop=stop):
            if name.startswith(stop):
                raise KeyError("stop")

        with pytest.raises(KeyError):
            fileset.commit({"a": "new", "b": "made"}, probe=probe)
        assert fileset.version()[0] == 1 and fileset.read("a") == b"old" and "b" not in fileset.version()[1]
    assert fileset.commit({"a": "new", "d/b": "made", "c": None}, expected={"d/b": None}) == 2
    assert (fileset.read("a"), fileset.read("a", 1), sorted(fileset.version()[1])) == (b"new", b"old", ["a", "d/b"])
    assert fileset.checkout(tmp_path / "out") == 2 and fileset.checkout(tmp_path / "out") == 0
    assert (tmp_path / "out" / "d" / "b").read_text() == "made"
    assert fileset.collect(keep=1) >= 2 and fileset.faults() == [] and fileset.read("a") == b"new"
    with pytest.raises(commit.CommitError):
        fileset.version(1)


def test_versions_refuse(fileset):
    fileset.commit({"a": "x", "b": "y"})
    for files, expected in [({}, None), ({"../a": "z"}, None), ({"a": "z"}, {"a": "0" * 64}), ({"c": "z"}, {"a": None})]:
        with pytest.raises(commit.CommitError):
            fileset.commit(files, expected)

    def other(name, files):
        if name == "publishing" and not done:
            done.append(1)
            fileset.commit(files)

    done = []
    assert fileset.commit({"a": "mine"}, probe=lambda n: other(n, {"b": "theirs"})) == 3 and fileset.read("b") == b"theirs" and fileset.read("a") == b"mine"
    done = []
    with pytest.raises(commit.CommitError):
        fileset.commit({"a": "again"}, probe=lambda n: other(n, {"a": "theirs"}))
    assert fileset.read("a") == b"theirs"
    fileset.store.delete(f"data/{fileset.version()[1]['a']}")
    assert fileset.faults() == ["a", "b"]  # equal contents are one object
    fileset.store.create("log/000000000009.json", b"{}")
    with pytest.raises(commit.CommitError):
        fileset.version()


def test_review_and_settings(fileset):
    import json

    fileset.commit({"job.json": json.dumps({"status": "imported", "import": {"n": 1}, "layout": 2}), "output": "text"})
    assert commit.prepare_review(fileset, b"p1") == "prepared" and commit.prepare_review(fileset, b"p1") == "already prepared"
    record = json.loads(fileset.read("job.json"))
    assert (record["status"], record["invalidated"], "import" in record) == ("exported", {"import": {"n": 1}, "layout": 2}, False)
    assert fileset.read("review/baseline") == b"text" and fileset.version()[0] == 2
    with pytest.raises(commit.CommitError):
        commit.prepare_review(fileset, b"p2")
    fileset.commit({"review/baseline": "other"})
    with pytest.raises(commit.CommitError):
        commit.prepare_review(fileset, b"p1")
    assert [commit.positive_setting(v, "n", 7) for v in (None, " ", "12", 3)] == [7, 7, 12, 3]
    for bad in ("0", "-1", "1.5", True, "x", 99):
        with pytest.raises(ValueError):
            commit.positive_setting(bad, "n", 7, most=50)
    commit.batch_succeeded(0, 2)
    for pair in ((1, 2), (0, 0), (3, 2)):
        with pytest.raises(commit.CommitError):
            commit.batch_succeeded(*pair)


def test_job_states(tmp_path):
    job = commit.Job(tmp_path / "job.json")
    job.move("exported")
    job.move("translating")
    with pytest.raises(commit.CommitError):
        job.move("imported")
    assert job.status == "translating"
    store = commit.StateStore(tmp_path / "s.json")
    assert commit.resume_plan(store, {"a": 1}) is False and commit.resume_plan(store, {"a": 1}) is True
    with pytest.raises(commit.CommitError):
        commit.resume_plan(store, {"a": 2})
    (tmp_path / "w").mkdir()
    commit.archive_job(tmp_path / "w", tmp_path / "arch" / "w", "imported")
    assert (tmp_path / "arch" / "w").is_dir()


def test_stream_translates_once(spark, tmp_path):
    ddl = "segment_id long, content string"
    src, out, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))
    calls = []

    def translate(df):
        calls.append(df.count())
        return stream.stub_translator("French")(df)

    for rows in ([(1, "a"), (2, "b")], [(2, "b"), (3, "c")]):
        spark.createDataFrame(rows, ddl).write.mode("append").parquet(src)
        stream.translate_stream(stream.segment_stream(spark, src, ddl), out, cp, translate).awaitTermination()
    assert sorted((r.segment_id, r.translated) for r in spark.read.parquet(out).collect()) == [(1, "[French] a"), (2, "[French] b"), (3, "[French] c")]
    assert calls == [2, 1]


def test_rich_values():
    assert workbooks.rich_value({"richText": [{"text": "a"}, {"text": "b"}]}) == "ab"
    assert workbooks.rich_value({"result": 3}) == "3" and workbooks.rich_value(None) == ""
    assert workbooks.fill_right(["a", "", "b", ""]) == ["a", "a", "b", "b"]


def test_stories_of_one_name_in_two_folders(spark, tmp_path):
    for folder, text in (("a", "one"), ("b", "two")):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "Page_1.icml").write_text(text)
    (tmp_path / "b" / "Page_0.icml").write_text("zero")
    got = files.stories(spark, str(tmp_path)).orderBy("file_no").collect()
    assert [(r.file_no, r.file_name, r.xml) for r in got] == [(0, "Page_0.icml", "zero"), (1, "Page_1.icml", "one"), (2, "Page_1.icml", "two")]
