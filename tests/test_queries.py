"""Every query with SQL gives DuckDB's rows, and none is vacuous."""

import pytest

import __spark_entry__ as entry_point
from textloom import queries

SF = "/root/testdata/sf0.001"
MAY_BE_EMPTY: set[str] = set()


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(name, against_sql):
    rows = against_sql(queries.QUERIES[name], queries.ORACLE_SQL[name], SF)
    assert rows or name in MAY_BE_EMPTY


def test_affected_rows_are_not_zero(spark):
    changed = queries.typography_unit_nbsp(spark, SF).agg({"changed": "sum"}).first()[0]
    assert changed > 0
    untidy = queries.typography_idempotence(spark, SF).first()
    assert untidy.n > 0 and untidy.untidy == 0


def test_claims_without_sql(spark):
    from textloom.operators.glossary import claims

    got = {}
    for r in queries.glossary_match_claims(spark, SF).collect():
        got.setdefault(r.doc_id, []).append((r.source, r.mode))
    terms = [(t, False, True) for t in sorted(queries.TERMS, key=lambda t: (-len(t), queries.TERMS.index(t)))]
    for r in queries.table(spark, SF, "documents").select("doc_id", "text").collect():
        assert sorted(got.get(r.doc_id, [])) == sorted(claims(r.text, terms))


def test_qa_reads_whole_texts(spark):
    texts = {r.doc_id: r.text for r in queries.table(spark, SF, "documents").collect()}
    source, _ = queries._content_tables(spark, SF)
    assert {r.row_no: r.content for r in source.collect()} == {k: f"Text {t}<b/>" for k, t in texts.items()}


def test_all_row_rules_by_brute_force(spark):
    import re
    from collections import Counter

    from textloom.functions.typography import normalise_text

    ERRORS = lambda code: "warning" if code == "UNCHANGED_SOURCE_TEXT" else "error"
    source, out = {}, {}
    rows = [(r.doc_id, r.lang, f"Text {r.text or ''}<b/>") for r in queries.table(spark, SF, "documents").collect()]
    for k, _, c in rows:
        tag = "" if k % 199 == 5 else str(k - (k % 100 == 7))
        source[k] = (tag, c)
        out[k] = " " if k % 7 == 0 else c + "<i/>" if k % 11 == 0 else c + " " if k % 13 == 0 else "&amp;lt; " + c if k % 17 == 0 else "<?x?>" + c if k % 19 == 0 else "a\n" + c if k % 23 == 0 else c if k % 3 == 0 else "Neu " + c
    firsts = {}
    for k in sorted(source):
        firsts.setdefault(source[k][0], k)
    protected = {source[k][0] for k in source if k % 29 == 0} - {""}
    panel = {source[k][0]: source[k][1] for k in source if k % 31 == 0 and source[k][0]}
    breaks = lambda t: re.findall("\r\n|[\r\n\u2028\u2029]", t)
    outer = lambda t: (re.match(r"[ \t\r\n]*", t)[0], re.search(r"[ \t\r\n]*\Z", t)[0])
    tags = lambda t: re.findall(r"</?[A-Za-z][^>]*>", t)
    want = Counter()
    for k, lang, s in rows:
        tag, o = source[k][0], out[k]
        free = tag not in protected and tag not in panel
        letters = re.sub("[^A-Za-zÀ-ÖØ-öø-ÿ]", "", re.sub("&[a-z]+;", " ", s.replace("Text", " ")))  # "<b/>" has one letter
        found = {
            "MISSING_CONTENT_ID": tag == "",
            "DUPLICATE_CONTENT_ID": tag != "" and firsts[tag] < k,
            "PROTECTED_FIELD_CHANGED": k % 50 == 0,
            "PANEL_REFERENCE_CACHE_CHANGED": tag in panel and o != panel[tag],
            "PROTECTED_SOURCE_TEXT_CHANGED": tag in protected and s != o,
            "BLANK_TRANSLATION": not o.strip(),
            "PROCESSING_INSTRUCTION_CHANGED": re.findall(r"(?s)<\?.*?\?>", s) != re.findall(r"(?s)<\?.*?\?>", o),
            "MARKUP_CHANGED": tags(s) != tags(o),
            "LINE_BREAK_CHANGED": breaks(s) != breaks(o),
            "BOUNDARY_WHITESPACE_CHANGED": outer(s) != outer(o),
            "DOUBLE_ESCAPED_ENTITY": "&amp;lt;" in o,
            "UNCHANGED_SOURCE_TEXT": free and len(letters) >= 4 and s.strip() == o.strip(),
            "EDITORIAL_TYPOGRAPHY": free and normalise_text(o, queries.QA_LANGUAGES[lang]) != o,
            "BOOK_INSTRUCTION_FORBIDDEN_TARGET": free and "Neu" in o,
            "BOOK_SOURCE_NAME_CHANGED": free and s.count("Text") != o.count("Text"),
        }
        want.update((lang, code) for code, bad in found.items() if bad)
    got = queries.qa_all_row_rules(spark, SF).collect()
    assert {(r.lang, r.code): r.n for r in got} == want and all(r.severity == ERRORS(r.code) for r in got)
    assert len({code for _, code in want}) == 15


def test_entry_and_registry(spark):
    assert entry_point.entry(spark).count() > 0
    names = set(entry_point.queries())
    assert set(queries.QUERIES) <= names and set(entry_point.oracle_sql()) <= names
