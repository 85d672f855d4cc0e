import random

import pytest
from pyspark.sql import functions as F

from textloom.functions import typography as ty

N, B = " ", " "
CASES = [
    ("French", "4 Oct 2010", f"4{B}octobre{B}2010"), ("French", "1 janv. 2010", f"1er{B}janvier{B}2010"), ("French", "32 Oct 2010", "32 Oct 2010"),
    ("French", "note : 8 %", f"note{N}: 8{N}%"), ("French", "« a » ; b — c !", f"«{N}a{N}»{N}; b —{N}c{N}!"), ("German", "Wert: 8%", f"Wert: 8{B}%"),
    ("English", "Rate: 8%", "Rate: 8%"), ("English", "Rate: 8 %", "Rate: 8%"), ("Turkish", "8 %", "8 %"), ("Spanish", "4 feb 2010", f"4{B}de{B}febrero{B}de{B}2010"),
    ("Portuguese", "4 fev 2010", "4 fev 2010"), ("Polish", "7 + 2", f"7{B}+{B}2"), ("Dutch", "9mm", "9mm"), ("Italian", "9 mm.", f"9{B}mm."), ("Swedish", "x http://a.b/9%20m 3 km", f"x http://a.b/9%20m 3{B}km"),
    ("German", "3 km\tm", f"3{B}km\tm"), ("Brazilian Portuguese", "3 %", f"3{B}%"),
]


@pytest.mark.parametrize("language,text,want", CASES)
def test_python_form(language, text, want):
    assert ty.normalise_text(text, language) == want
    assert ty.normalise_text(want, language) == want


def test_protected_strings():
    assert ty.normalise_text("Tag: 3 km", "French", ["Tag: 3 km"]) == "Tag: 3 km"
    assert ty.normalise_text("0 et 10 %", "French", ["0", "10"]) == f"0 et 10{N}%"
    assert ty.normalise_text("http://a.b/km3 4 km", "German", ["km3"]) == f"http://a.b/km3 4{B}km"
    with pytest.raises(ValueError):
        ty.normalise_text("", "German")


def test_matrix_sizes():
    assert len(ty.matrix("French")) == 8 and all(len(ty.matrix(k)) == 4 for k in ty.LOCALES if k != "French")


def test_column_form_is_the_python_form(spark):
    rng = random.Random(3)
    parts = ["4 Oct 2010", "1er janv. 2010", "01 mars 1999", "12 km", "3 %", "«", "»", " ; ", "!", " : ", "—", "x", "é", "<b>", "&amp;", "http://a.b/4 km", "7 + 2", "= 3", "\t", " ", B, N, "\n", "31 de março de 2011", "½", "a@b.co", "14 Mar. 2013"]
    rows = [("".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randint(1, 8))),) for _ in range(400)]
    df = spark.createDataFrame(rows, "t string")
    for language in ty.LOCALES:
        for r in df.select("t", ty.normalise(F.col("t"), language).alias("n")).collect():
            assert r.n == ty.normalise_text(r.t, language), (language, r.t)
            assert ty.normalise_text(r.n, language) == r.n
            strip = str.maketrans("", "", f" {B}{N} ")
            if language in ("English", "Turkish"):
                continue
            if not any(c.isdigit() for c in r.t):
                assert r.n.translate(strip) == r.t.translate(strip)


def test_protected_column(spark):
    df = spark.createDataFrame([("a 3 km 4 km", ["3 km"]), (None, None)], "t string, p array<string>")
    got = [r[0] for r in df.select(ty.normalise_protected("German")("t", "p")).collect()]
    assert got == [f"a 3 km 4{B}km", ""]


def test_rule_table(spark):
    rules = ty.rules_for(ty.rule_table(spark), "French")
    assert rules.count() == 17 and rules.where("applies").count() == 8
    assert rules.where("not applies and reason is null").count() == 0


def test_native_run_equals_the_reports(spark):
    texts = ["12 km + 3 = 4", "a : b ; « c » — d", "4 oct. 2010 et 3 <a b=\"3 km\"> 5 kg", "1 octobre 2010 !", "", None, "x — y—z", "3 + +4 × −2 %"]
    df = spark.createDataFrame(enumerate(texts), "i int, t string")
    for language in ("French", "English", "Spanish"):
        for r in df.select("i", ty.matrix_run(F.col("t"), language).alias("r")).collect():
            want, counts = ty.matrix_report(texts[r.i], language)
            assert r.r.typeset == want and [tuple(x) for x in r.r.counts] == counts
    with pytest.raises(Exception, match="reserved"):
        spark.createDataFrame([("a\ue102",)], "t string").select(ty.matrix_run(F.col("t"), "English")).collect()
