import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.operators import validation as v

MAP = "map<string,struct<term:string,definition:string,combined_definition:string>>"


def faults(df):
    return {(r.key, r.fault) for r in df.collect()}


def test_published(spark):
    ddl = f"book string, row int, kind string, english string, english_definition string, translations {MAP}"
    fr = {"French": ("a", "", "")}
    rows = [("b", 1, "words", "x", "", fr), ("b", 2, "verbs", " ", "", {"German": ("a", "", "")}), ("b", 3, "words", "y", "#REF!", {"French": (" a", "", "")}), ("b", 3, "words", "x", "", fr)]
    assert faults(v.published_faults(spark.createDataFrame(rows, ddl), ["French"])) == {("b#2", "unknown kind"), ("b#2", "blank source"), ("b#2", "untrimmed cell"), ("b#2", "other languages"), ("b#3", "untrimmed cell"), ("b#3", "error literal"), ("b#3", "repeated row number"), ("b#1", "repeated row")}


def test_manifest_and_styles(spark):
    import hashlib

    h = hashlib.sha256(b"t").hexdigest()
    m = spark.createDataFrame([("7", "t", h.upper()), ("007", "t", h), ("8", "u", h), (" ", "t", h)], "content_id string, source_text string, sha256 string")
    assert faults(v.manifest_faults(m, 3)) == {("7", "repeated id"), ("8", "text differs from its hash"), ("", "blank id"), ("", "other number of texts")}
    s = spark.createDataFrame([("a", 9.0, "ok"), ("A", 2000.0, "-x"), ("", None, None)], "path string, size double, label string")
    assert faults(v.style_faults(s)) == {("A", "size out of range"), ("A", "label of another form"), ("", "blank path"), ("", "size out of range"), ("", "label of another form"), ("a", "repeated path")}


def test_glossary_contracts(spark):
    g = spark.createDataFrame([("words", "cat", "French", "x "), ("words", "cat", "English Definition", "HQ Co"), ("words", "dog", "French", "#N/A")], "kind string, source string, field string, value string")
    assert faults(v.field_faults(g, ["French", "English Definition"])) == {("words/cat", "untrimmed value"), ("words/dog", "other fields"), ("words/dog", "error literal")}
    e = spark.createDataFrame([("CAT",), ("bird",)], "term string")
    assert faults(v.exclusion_faults(g, e, ["HQ"])) == {("bird", "not in the glossary")}
    assert faults(v.exclusion_faults(g, e.where("term = 'bird'"), ["HQ"])) == {("bird", "not in the glossary"), ("cat", "protected definition is not excluded")}
    f = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "1"), ("b", "1")], "family string, signature string")
    assert [tuple(r) for r in v.signature_conflicts(f).collect()] == [("a", ["1", "2"])]


def test_profiles_and_senses(spark):
    p = spark.createDataFrame([("b", "fr", "x"), ("b", "fr", "y"), ("b", "de", "z"), ("c", "fr", "x"), ("c", "fr", "y")], "book string, language string, profile string")
    d = spark.createDataFrame([("b", "fr", "y")], "book string, language string, profile string")
    assert {tuple(r) for r in v.default_profile(p, d).collect()} == {("b", "fr", "y"), ("b", "de", "z"), ("c", "fr", None)}
    s = spark.createDataFrame([("camera", ["a", "b"]), ("lens", ["c", "d"])], "source string, alternatives array<string>")
    c = spark.createDataFrame([(1, "a Camera, old"), (2, "cameras")], "k int, t string")
    assert [(r.k, r.source) for r in v.senses_in_context(c, s, "k", "t").collect()] == [(1, "camera")]


def test_maps(spark):
    df = spark.createDataFrame([("x", {"French": " a ", "French Definition": "", "_1": "d1", "German": "", "": "q"})], "source string, fields map<string,string>")
    assert df.select(v.definition_for(F.col("fields"), F.lit("French"), F.lit(1))).first()[0] == "d1"
    assert [tuple(r) for r in v.by_language(df).collect()] == [("French", "x", "a")]


def test_prompt(spark):
    r = spark.createDataFrame([("fr", 2, "b", "two", ["text"]), ("fr", 1, "a", "one", ["text", "icml"]), ("fr", 3, "c", "no", ["icml"])], "language string, ord int, id string, instruction string, stages array<string>")
    assert v.prompt_text(r, "text", "H", "T").first().prompt == "H\n[a] one\n[b] two\nT"


def test_nested_requests(spark):
    df = spark.createDataFrame([(["a\x00", None], {"k": ("b\r\n", 3)})], "a array<string>, m map<string,struct<s:string,n:int>>")
    r = df.select(v.request_values(F.col("a"), df.schema["a"].dataType).alias("a"), v.request_values(F.col("m"), df.schema["m"].dataType).alias("m")).first()
    assert r.a == ["a", None] and tuple(r.m["k"]) == ("b\n", 3)
    assert isinstance(df.schema["m"].dataType, T.MapType)


def test_collapse(spark):
    for t in ["", "  ", " a  b\n", "x y"]:
        made, at = v.collapse(t)
        assert made == " ".join(t.split()) and all(t[i] == c or c == " " for i, c in zip(at, made))
    assert spark.createDataFrame([(" a  b",)], "t string").select(v.collapsed(F.col("t")).alias("c")).first().c.places == [1, 2, 4]


def test_ranges(spark):
    f = spark.createDataFrame([(0, "one two"), (1, "abc"), (2, "abc"), (3, "q")], "frame_index int, text string")
    i = spark.createDataFrame([(0, 4, 3, "deux"), (0, 0, 3, "un"), (1, 0, 2, "x"), (1, 1, 1, "y"), (2, 2, 5, "z")], "frame_index int, start int, length int, target string")
    assert {r.frame_index: (r.text, r.fault) for r in v.apply_ranges(f, i).collect()} == {0: ("un deux", None), 1: ("abc", "ranges overlap"), 2: ("abc", "range leaves the text"), 3: ("q", None)}


@pytest.mark.parametrize("text,want", [("---\nname: a b \nx: 1\n---\nname: no", "a b"), ("---\nname: a\nname: b\n---", None), ("name: a", None)])
def test_front_matter(spark, text, want):
    assert v.front_matter(spark.createDataFrame([(text,)], "text string"), "name").first().name == want
