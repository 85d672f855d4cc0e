"""Scalars against plain Python and the stated fixtures."""

import hashlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textloom.functions import hashing, markup
from textloom.functions import text as tx

TEXTS = ["", " ", " a ", "﻿ x ", "007", "000", "7x", "a\r\nb\rc\nd e", None, "😀é", "#ref!", " #N/A ", "12, 3 – 4", "Ã©t", "x\u0085"]


def test_blank_and_trim(spark, values):
    space = " \t\n\x0b\x0c\r                 　﻿"
    assert values(spark, TEXTS, tx.trim) == [(t or "").strip(space) for t in TEXTS]
    assert values(spark, ["", " ", None], tx.has_content) == [False, True, False]


def test_content_ids(spark, values):
    assert values(spark, ["007", " 7 ", "000", "a07", ""], tx.content_id) == ["7", "7", "0", "a07", ""]


def test_breaks(spark, values):
    assert values(spark, ["a\r\nb\rc\nd e ", ""], tx.line_breaks) == [["\r\n", "\r", "\n", " ", " "], []]
    assert values(spark, ["a\r\nb", "a\rb\n", "a\n", "a"], tx.break_style) == ["\r\n", "\r", "\n", None]
    assert values(spark, ["a\r\nb\rc\n"], lambda c: tx.convert_breaks(c, F.lit("\r\n"))) == ["a\r\nb\r\nc\r\n"]


def test_outer_whitespace_concatenates(spark, values):
    got = values(spark, ["  a b\t", " ", "x", "", "\n\nq"], tx.outer_whitespace)
    assert [tuple(r) for r in got] == [("  ", "a b", "\t"), (" ", "", ""), ("", "x", ""), ("", "", ""), ("\n\n", "q", "")]


def test_error_literals_and_skips(spark, values):
    assert values(spark, ["#ref!", " #N/A ", "#NAME", ""], tx.is_error_literal) == [True, True, False, False]
    assert values(spark, ["12, 3 – 4", " ", "3 km", "(1)[2]{3}"], tx.should_skip) == [True, True, False, True]


def test_names(spark, values):
    assert values(spark, ['a<b>: "c"/d', "x" * 130], tx.file_part) == ["a_b____c__d", "x" * 120]
    assert values(spark, ["  My  Book!  v1.0 "], tx.path_part) == ["My_Book_v1.0"]
    assert values(spark, ["Diagram__A  b.AI"], tx.file_name_key) == ["diagram a b.ai"]
    assert values(spark, ["x Page_012.ai", "none"], tx.page_of) == [12, None]
    assert values(spark, ["ParagraphStyle/A%3aB+c", "bad%zz"], tx.decode_style) == ["A:B+c", "bad%zz"]
    assert values(spark, ["ABCDEF+OpenSans-Bold", "SourceCodePro", "Arial"], tx.font_class) == ["prose", "sourceCode", "unknown"]


def test_repairs(spark, values):
    assert values(spark, ["Ã©t", "Ãx€", "ok"], tx.repair_mojibake) == ["ét", "Ãx€", "ok"]
    assert values(spark, ["a\x00b\tc"], tx.strip_control) == ["ab\tc"]
    assert values(spark, ["ﬁne  a\nb"], tx.plain_line) == ["fine a b"]


def test_term_patterns(spark):
    rows = [("Task", "x Task, y", True), ("Task", "Tasks", False), ("Task", "éTask", False), ("C.O.", "the C.O.", True), ("MWD", "mwd", False), ("mile", "MILE", True), ("kelvin", "Kelvin", True)]
    df = spark.createDataFrame(rows, "term string, t string, want boolean")
    bad = df.where(F.regexp_like("t", tx.term_pattern(F.col("term"))) != F.col("want")).collect()
    assert not bad
    # The ASCII form never folds other characters onto ASCII.
    assert not spark.createDataFrame([("kelvin", "Kelvin")], "a string, b string").where(tx.contains_term(F.col("b"), F.col("a"))).count()


def test_normal_form_and_blanks(spark, values):
    assert values(spark, ["e\u0301", None, "a"], tx.nfc) == ["é", None, "a"]
    assert values(spark, ["a HQ Co b", "", None], lambda c: tx.blank_out(c, "HQ Co")) == ["a       b", "", ""]


def test_sizes_and_columns(spark, values):
    got = values(spark, ["10 pt / 12 pt or 13 pt", "9.5pt/11", "x"], tx.size_pair)
    assert [tuple(g) if g else None for g in got] == [(10.0, 12.0, [13.0]), (9.5, 11.0, []), None]
    assert values(spark, ["A1", "Z9", "AA1", "AB12"], tx.column_index) == [0, 25, 26, 27]
    assert values(spark, ["1.10.2"], tx.version_parts) == [[1, 10, 2]]


def _fnv(text):
    h = 2166136261
    raw = text.encode("utf-16-be")
    for i in range(0, len(raw), 2):
        h = ((h ^ int.from_bytes(raw[i : i + 2], "big")) * 16777619) & 0xFFFFFFFF
    return f"{h:08X}"


def test_fingerprints(spark, values):
    texts = ["", "a", "😀é", "x" * 300]
    assert values(spark, texts, hashing.fnv1a32) == [_fnv(t) for t in texts]
    assert values(spark, texts, hashing.sha256_upper) == [hashlib.sha256(t.encode()).hexdigest().upper() for t in texts]


def test_markup(spark, values):
    assert values(spark, ["a<?x\ny?><b/>&amp;é1"], markup.visible_letters) == ["abé"]
    assert values(spark, ['5 < 6 & <b a="1">&amp; &x</b> > <?p <?>'], markup.escape_xml) == ['5 &lt; 6 &amp; <b a="1">&amp; &amp;x</b> &gt; <?p <?>']
    assert values(spark, ['<P a="1">', '<P id="1" b="2"/>'], lambda c: markup.set_id(c, F.lit("9"))) == ['<P id="9" a="1">', '<P id="9" b="2"/>']
    assert values(spark, ["&amp;lt;", "&lt;"], markup.double_escaped) == [True, False]
    df = spark.createDataFrame([("a<b/>\n", "a <b/>")], "s string, t string")
    assert df.select(markup.changed_parts(F.col("s"), F.col("t"))).first()[0] == ["line breaks", "boundary whitespace"]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="a \t\r\n  é#", max_size=12), min_size=1, max_size=30))
def test_split_is_lossless(spark, values, texts):
    parts = values(spark, texts, tx.outer_whitespace)
    assert ["".join(p) for p in parts] == texts
