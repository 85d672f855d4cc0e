"""Segments, glossaries, locks, checks, ledgers, audits against small cases."""

import random

import pytest
from pyspark.sql import functions as F

from textloom.operators import audit, glossary, ledger, locks, packing, qa, relational, segments


def content(spark, rows):
    return spark.createDataFrame([(i + 1, *r) for i, r in enumerate(rows)], "row_no long, psr_id string, psr_content string, content_tag string, content string")


def test_groups_and_orphans(spark):
    t = content(spark, [("", "", "orphan", "lost"), ("Body", " x", "id-1", " "), ("", "", "id-2", "x"), ("Title", "", "id-3", "")])
    g = segments.content_groups(t, []).orderBy("group_no").collect()
    assert [(r.group_id, r.start_row, r.rows, r.segments) for r in g] == [("group_000001", 2, [2, 3], [" ", "x"]), ("group_000002", 4, [4], [])]
    assert [r.row_no for r in segments.orphan_rows(t, []).collect()] == [1]
    assert [r.psr_content for r in segments.rebuild_composites(t, t, []).orderBy("row_no").collect()] == ["", " x", "", ""]
    assert qa.composite_issues(t, t, []).count() == 0


def entries(spark, rows):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "source string, target string, kind string, source_term string, ord long")


def test_compile(spark):
    c = {r.source: r for r in glossary.compile_entries(entries(spark, [("a", "x", "definition", "A"), ("a", "y", "definition", "B"), ("a", "x", "definition", "C"), ("BLAST", "b1", "word", ""), ("Blast", "b2", "word", ""), ("solo", "s", "word", ""), ("", "q", "word", "")])).collect()}
    assert c["a"].contextual and [tuple(x) for x in c["a"].alternatives] == [("x", "A"), ("y", "B")] and not c["a"].allow_ci
    assert not c["BLAST"].allow_ci and not c["Blast"].allow_ci and c["solo"].allow_ci and "" not in c
    with pytest.raises(Exception, match="conflicting targets"):
        glossary.compile_entries(entries(spark, [("a", "x", "word", ""), ("a", "y", "definition", "")])).collect()


def test_claims_longest_first_and_folded():
    terms = [("fire team", False, True), ("fire", False, True), ("IR", False, False)]
    assert glossary.claims("the fire team", terms) == [("fire team", "exact")]
    assert glossary.claims("Fire, fire team", terms) == [("fire team", "exact"), ("fire", "case-insensitive-unique")]
    assert glossary.claims("ir", terms) == [] and glossary.claims("fireé", terms) == []


def test_matching_equals_all_terms_on_all_texts(spark):
    rng = random.Random(5)
    words = ["fire", "team", "Fire", "C.O.", "é", "fireteam", "IR", "ſide", "side", ",", "x-ray", "naïve"]
    c = glossary.compile_entries(entries(spark, [(s, f"t-{s}", "word", "") for s in ["fire", "fire team", "C.O.", "IR", "side", "x-ray", "naïve", "é"]]))
    docs = spark.createDataFrame([(i, " ".join(rng.choice(words) for _ in range(8))) for i in range(60)], "row_no long, content string")
    terms = [(r.source, r.contextual, r.allow_ci) for r in glossary.by_length(c).collect()]
    for r in glossary.match_terms(docs, c).collect():
        assert [tuple(m) for m in r.matches] == glossary.claims(r.content, terms)


def test_matching_of_any_script_and_key(spark):
    sources = ["кот", "черный кот", "ΟΔΟΣ", "数据", "§", "C++", "a b", "—x"]
    c = glossary.compile_entries(entries(spark, [(s, f"t-{s}", "word", "") for s in sources]))
    texts = ["Черный КОТ и кот", "который", "οδος και οδοσ", "数据 数据库", "§ 5", "use C++ now", "A b", "y —x.", "", None]
    docs = spark.createDataFrame([(None if i % 2 else i % 4, t) for i, t in enumerate(texts)], "row_no long, content string")
    terms = [(r.source, r.contextual, r.allow_ci) for r in glossary.by_length(c).collect()]
    got = glossary.match_terms(docs, c).collect()
    assert len(got) == len(texts)
    for r in got:
        assert [tuple(m) for m in r.matches] == (glossary.claims(r.content, terms) if r.content else [])
    assert sum(len(r.matches) for r in got) >= 7
    # No token is shared by terms that no text shares: nothing meets all texts.
    tokens = [r[0] for r in c.select(glossary._term_token(F.col("source"))).collect()]
    assert len(set(tokens)) >= len(tokens) - 1 and "" not in tokens


def test_pairs_between_ascii_boundaries(spark):
    pairs = spark.createDataFrame([(s, "t") for s in ["the", "кот", "naïve", "-", "m"]], "source string, target string")
    docs = spark.createDataFrame([(0, "éThe"), (1, "который"), (2, "a NAïVE man"), (3, "x-y"), (4, "5\u212am"), (5, "then")], "k int, t string")
    assert {(r.k, r.source) for r in glossary.term_pairs(docs, pairs, "k", "t").collect()} == {(0, "the"), (1, "кот"), (2, "naïve"), (4, "m")}


def test_terms_that_fold_onto_ascii(spark):
    c = glossary.compile_entries(entries(spark, [(s, "t", "word", "") for s in ["\u017ftar", "\u212aelvin"]]))
    docs = spark.createDataFrame(enumerate(["a star", "a \u017ftar", "one kelvin", "one \u212aelvin", "tar"]), "row_no long, content string")
    key = lambda df: {r.row_no: [m.source for m in r.matches] for r in df.collect()}
    want = {0: ["\u017ftar"], 1: ["\u017ftar"], 2: ["\u212aelvin"], 3: ["\u212aelvin"], 4: []}
    assert key(glossary.match_terms(docs, c)) == want
    groups = docs.selectExpr("row_no AS group_id", "content AS source_text", "'' AS target_text")
    queried = {r.group_id for r in glossary.select_for_delta(groups, c).where("queried").collect()}
    assert {1, 3} <= queried and 4 not in queried


def test_targets(spark):
    rows = [("German", "Kompanien kamen", "Kompanie", "definition", True), ("German", "Zugang", "Zug", "definition", False), ("German", "fortgeschrittenes", "fortgeschritten", "acronym", True), ("German", "Aufklärungs- und", "Aufklärung", "definition", True), ("French", "blessées", "blessé", "definition", True), ("French", "blessées", "blessé", "word", False), ("English", "a b", "b", "word", True)]
    for language, text, target, kind, want in rows:
        df = spark.createDataFrame([(text, target, kind)], "t string, g string, k string")
        assert df.select(glossary.contains_target(F.col("t"), F.col("g"), F.col("k"), language)).first()[0] is want, (text, target)


def test_overlay_cases(spark):
    base = spark.createDataFrame([("words", "camera", f, v, 1) for f, v in [("French", "caméra"), ("French Definition", "d")]], "kind string, source string, field string, value string, ord long")
    pub = spark.createDataFrame([("b", 1, "words", "Camera", "", {"French": ("", "neu", "")})], "book string, row int, kind string, english string, english_definition string, translations map<string,struct<term:string,definition:string,combined_definition:string>>")
    out, senses = glossary.overlay(base, pub, {"French": "French"})
    got = {(r.source, r.field): r.value for r in out.collect()}
    assert got == {("camera", "French"): "caméra", ("camera", "French Definition"): "neu"} and senses.count() == 0
    two = pub.union(pub.withColumn("row", F.lit(2)))
    out, senses = glossary.overlay(base, two, {"French": "French"})
    assert {r.value for r in out.collect()} == {""} and len(senses.first().alternatives) == 2


def test_replacing(spark):
    t = spark.createDataFrame([("the IR sight",), ("Ranger’s",)], "content string")
    r = glossary.replace_in(t, [("sight", "visée", "word"), ("IR", "infrarouge", "acronym"), ("ranger's", "garde", "word")]).collect()
    assert r[0].replaced == "the infrarouge visée" and [a.n for a in r[0].applied] == [1, 1] and r[1].replaced == "garde"


def test_table_rows(spark):
    t = spark.createDataFrame([(1, " a \tdef ", "term"), (2, "x", "")], "row_no long, content string, z string")
    m = spark.createDataFrame([("a", "def", "A", "")], "term string, definition string, target_term string, target_definition string")
    assert {r.row_no: r.expected for r in glossary.expected_table_rows(t, m).collect()} == {1: " A \tdef ", 2: None}


def test_locks_round_trip(spark):
    c = glossary.compile_entries(entries(spark, [("fire team", "équipe", "word", "")]))
    g = spark.createDataFrame([("g1", ["a fire team\nx", "HQ B Co", ""])], "group_id string, segments array<string>")
    p = locks.prepare_groups(g, c, [("unit", r"\b[A-Z] Co\b")])
    r = p.first()
    assert r.prepared == ["⟦S_g1_001⟧a ⟦G_g1_0001⟧⟦L_g1_1_1⟧x", "⟦S_g1_002⟧HQ ⟦B_g1_0001⟧", "⟦S_g1_003⟧"]
    back = p.select(locks.restore_segments(F.col("prepared"), F.col("group_id"), F.col("locks"))).first()[0]
    assert back == ["a équipe\nx", "HQ B Co", ""]
    swapped = p.withColumn("prepared", F.array(F.lit("⟦S_g1_001⟧a"), F.lit("⟦S_g1_002⟧⟦G_g1_0001⟧⟦B_g1_0001⟧⟦X_1⟧"), F.lit("no")))
    assert set(swapped.select(locks.token_faults(F.col("prepared"), F.col("group_id"), F.col("locks"))).first()[0]) == {"anchor", "missing", "invented"}


def test_break_restoring(spark):
    df = spark.createDataFrame([("a\r\nb c", "x\x0by\nz", "x y")], "s string, t string, u string")
    r = df.select(locks.restore_break_kinds(F.col("s"), F.col("t")).alias("a"), locks.restore_break_kinds(F.col("s"), F.col("u")).alias("b")).first()
    assert r.a == "x\r\ny z" and r.b == "x y"
    k = df.select(locks.lock_breaks(F.col("s"), F.lit("g"), F.lit(0)).alias("l"))
    with pytest.raises(Exception, match="line-break token"):
        k.select(locks.restore_breaks(F.lit("⟦L_g_1_2⟧⟦L_g_1_1⟧"), F.col("l.locks"))).collect()


def test_acronym_locks(spark):
    df = spark.createDataFrame([("use RPG, not RPGs", ["RPG", "ABC", "RPG"])], "t string, a array<string>")
    k = df.withColumn("k", locks.acronym_locks(F.col("t"), F.col("a")))
    locked = k.withColumn("x", locks.apply_acronyms(F.col("t"), F.col("k")))
    r = locked.select("x", locks.restore_acronyms(F.col("x"), F.col("k")).alias("y")).first()
    assert r.x == "use __lock_acronym_1__, not RPGs" and r.y == "use RPG, not RPGs"


def collected(severities, most):
    kept = []
    for i, s in enumerate(severities):
        if len(kept) < most:
            kept.append((i, s))
        elif s == "error":
            for j in range(most - 1, -1, -1):
                if kept[j][1] == "warning":
                    kept[j] = (i, s)
                    break
    return kept


def test_bounded_retention(spark):
    rng = random.Random(2)
    cases = [["warning"] * 4 + ["error"]] + [[rng.choice(["warning", "error"]) for _ in range(rng.randint(0, 12))] for _ in range(40)]
    rows = [(d, i, s) for d, c in enumerate(cases) for i, s in enumerate(c)]
    got = {}
    for r in qa.retained(spark.createDataFrame(rows, "d int, ord int, severity string"), 3, ["d"]).collect():
        got.setdefault(r.d, {})[r.slot] = (r.ord, r.severity)
    for d, c in enumerate(cases):
        assert [v for _, v in sorted(got.get(d, {}).items())] == collected(c, 3), c


def test_table_level_issues(spark):
    t = content(spark, [("p", "", str(i), f"Text number {i} stays") for i in range(12)])
    pairs = qa.paired(t, t, [])
    codes = {r.code for r in qa.table_issues(t, t.where("row_no < 12"), qa.paired(t, t, []), 12, 11).collect()}
    assert codes == {"ROW_COUNT_CHANGED", "TRANSLATION_COVERAGE_LOW", "EXPORT_CONTENT_ID_COUNT_MISMATCH"}
    some = qa.row_issues(pairs, language="German", forbidden=[("f", "number 3", "no threes")], preserved=[("n", r"number \d+")])
    assert some.where("code = 'BOOK_INSTRUCTION_FORBIDDEN_TARGET'").count() == 1


def next_fit(sizes, most_chars, most_groups, most_segments):
    out, b, n, c, s = [], 0, 0, 0, 0
    for chars, segs in sizes:
        if b == 0 or (n and (c + chars > most_chars or n >= most_groups or s + segs > most_segments)):
            b, n, c, s = b + 1, 0, 0, 0
        n, c, s = n + 1, c + chars, s + segs
        out.append(b)
    return out


def test_packing(spark):
    rng = random.Random(1)
    sizes = [(rng.randint(1, 9), rng.randint(1, 4)) for _ in range(80)]
    df = spark.createDataFrame([(i, c, s) for i, (c, s) in enumerate(sizes)], "ord long, chars long, segments long")
    got = [r.batch_no for r in packing.text_batches(df, [], (20, 5, 8)).orderBy("ord").collect()]
    assert got == next_fit(sizes, 20, 5, 8)
    scans = spark.createDataFrame([(i, 10, 10) for i in range(17)] + [(99, 500, 10)], "ord long, items long, chars long")
    assert [r[1] for r in packing.diagram_batches(scans, []).groupBy("batch_no").count().orderBy("batch_no").collect()] == [8, 8, 1, 1]
    with pytest.raises(Exception, match="over the limit"):
        packing.text_batches(df.withColumn("chars", F.lit(50)), [], (20, 5, 8)).collect()


def test_recheck_asks_only_for_failures(spark):
    asked = []

    def ask(df, attempt):
        asked.append(sorted(r.group_id for r in df.collect()))
        return df.withColumn("v", F.lit("ok"))

    df = spark.createDataFrame([("a", "bad"), ("b", "ok")], "group_id string, v string")
    out = packing.recheck(df, lambda d: d.where("v = 'bad'"), ask)
    assert asked == [["a"]] and {r.v for r in out.collect()} == {"ok"}
    with pytest.raises(ValueError):
        packing.recheck(df, lambda d: d.where("v = 'bad'"), lambda d, n: d)


def test_partial_protection_is_an_error(spark):
    g = spark.createDataFrame([("a", [1, 2]), ("b", [3])], "group_id string, rows array<long>")
    ok = packing.partition_protected(g, spark.createDataFrame([(3,)], "row_no long"))
    assert {r.group_id: r.is_protected for r in ok.collect()} == {"a": False, "b": True}
    with pytest.raises(Exception, match="partly protected"):
        packing.partition_protected(g, spark.createDataFrame([(1,)], "row_no long")).collect()


UNITS = "file string, pos long, id string, kind string, plain string, translations map<string,string>"


def test_ledger(spark):
    led = spark.createDataFrame([("a.ai", "1" * 64), ("b.ai", "2" * 64), ("c_x.ai", "2" * 64)], "file string, sha256 string")
    files = spark.createDataFrame([("q", "1" * 64), ("C X.ai", "2" * 64), ("zz", "2" * 64), ("n", "3" * 64)], "file string, sha256 string")
    assert {r.file: (r.entry_file, r.matched_by) for r in ledger.match_files(files, led).collect()} == {"q": ("a.ai", "sha256"), "C X.ai": ("c_x.ai", "sha256+name"), "zz": (None, "ambiguous"), "n": (None, "none")}
    u = spark.createDataFrame([("f", 0, "1", "prose", "one", {"French": "un"}), ("f", 1, "2", "prose", "two", None), ("f", 2, "3", "sourceCode", "x", None)], UNITS)
    assert [r.id for r in ledger.pending_units(u, "French").collect()] == ["2"]
    new = spark.createDataFrame([("f", "2", "deux"), ("f", "1", "un")], "file string, id string, target string")
    assert {r.id: r.changed for r in ledger.record_translations(u, new, "French").collect()} == {"1": False, "2": True, "3": False}
    rep = spark.createDataFrame([("f", "prose", "1", " one ", 5), ("f", "prose", "2", "TWO", 6)], "file string, kind string, id string, text string, pos long")
    assert {(r.kind, r.fault) for r in ledger.match_report(u, rep).collect()} == {("prose", "other text"), ("sourceCode", "not in report")}
    frames = spark.createDataFrame([("f", 0, "two one"), ("f", 1, "two  x")], "file string, frame_index int, text string")
    assert [(r.id, r.frame_index, r.start) for r in ledger.cursor_match(frames, u).collect()] == [("1", 0, 4), ("2", 1, 0), ("3", 1, 4)]


def test_alias_round_trip(spark):
    items = ledger.compact(spark.createDataFrame([("f", 1, "a", None), ("f", 2, "b", "local"), ("f", 3, "c", None)], "file string, pos int, id string, local string"))
    good, bad = ledger.expand(items, spark.createDataFrame([("f", "t1", "A"), ("f", "t9", "Z")], "file string, alias string, translated string"))
    assert {(r.id, r.translated) for r in good.collect()} == {("a", "A"), ("b", "local")}
    assert {(r.alias, r.fault) for r in bad.collect()} == {("t2", "missing"), ("t9", "unknown")}


def test_captions(spark):
    s = spark.createDataFrame([(1, "a", "x", ""), (2, "b", " ", ""), (3, "c", "y", "p")], "row_no long, image string, english string, portuguese string")
    todo = ledger.caption_pending(s)
    assert [(r.row_no, r.row_id) for r in todo.collect()] == [(1, "row_000001")]
    new = todo.select("row_no", F.lit("t").alias("translated"))
    out = ledger.put_captions(s, new)
    assert ledger.caption_changes(s, out, new).count() == 0
    assert ledger.caption_changes(s, out.withColumn("image", F.lit("z")), new).count() == 3


def test_audit_and_templates(spark, values):
    r = audit.audit_rows(spark.createDataFrame([("STORY|index=0|id=12|name=a%3D+b",)], "line string")).first()
    assert r.kind == "STORY" and r.fields == {"index": "0", "id": "12", "name": "a= b"}
    assert [b[0] for b in audit.template_blocks(audit.TEMPLATES["English"][0])] == [audit.CUSTOM, audit.FULL, audit.CUSTOM, audit.PAGE, audit.CUSTOM]
    with pytest.raises(ValueError):
        audit.template_blocks("^X <b>")
    assert values(spark, ["a\x18b\x18"], lambda c: audit.rendered_reference(c, F.array(F.lit("1"), F.lit("2")))) == ["a1b2"]


def test_layout_plan(spark):
    want = audit.template_blocks(audit.TEMPLATES["German"][0])
    blocks = spark.createDataFrame([(f, i, t, "old" if f == 2 and t == audit.CUSTOM else x, d) for f in (1, 2) for i, (t, x, d) in enumerate(want)], "format_id int, pos int, type string, text string, delimiter string")
    formats = spark.createDataFrame([(1, "Image"), (2, "Image"), (3, "Other")], "format_id int, name string")
    refs = spark.createDataFrame([(10, 1, "(Siehe Bild, S. 3.)", "s"), (11, 1, "wrong", "s"), (12, 2, "x", "s"), (13, 3, "x", "p/Credits")], "ref_id int, format_id int, text string, style string")
    plan, due = audit.layout_plan(formats, blocks, refs, "German", ["Credits"])
    assert {r.format_id: r.action for r in plan.collect()} == {1: "keep", 2: "edit", 3: "protected"}
    assert {r.ref_id: r.update for r in due.collect()} == {10: False, 11: True, 12: True, 13: False}


def test_relational(spark):
    a = spark.createDataFrame([("1", "x"), ("2", "y"), ("2", "y")], "k string, v string")
    b = spark.createDataFrame([("1", "z"), ("3", "q")], "k string, v string")
    assert {(r.k, r.state) for r in relational.differences(a, b, ["k"], "v").collect()} == {("1", "differs"), ("2", "left only"), ("3", "right only")}
    base = spark.createDataFrame([("a", "1", 1), ("b", "2", 2)], "id string, p string, ord int")
    more = spark.createDataFrame([("b", "9", 1), ("c", "3", 2)], "id string, p string, ord int")
    assert [(r.id, r.p) for r in relational.merge_rules(base, more).orderBy("ord").collect()] == [("a", "1"), ("b", "9"), ("c", "3")]
    s = spark.createDataFrame([("Aa", 1), ("b", 2)], "value string, ord int")
    t = spark.createDataFrame([("aA", 1), ("c", 2)], "value string, ord int")
    assert [r.value for r in relational.merge_strings(s, t).collect()] == ["Aa", "b", "c"]
    from re import search

    assert search(relational.effective_pattern("official_unit_type_abbreviation", "[A-Z]Co"), "the Headquarters and Service BCo")[0] == "Headquarters and Service BCo"
    stages = spark.createDataFrame([("All", "a", ["text"]), ("French", "b", ["text"]), ("French", "c", ["icml"]), ("German", "d", ["text"])], "language string, id string, stages array<string>")
    assert {r.id for r in relational.stage_rules(stages, "french", "text").collect()} == {"a", "b"}
    p = spark.createDataFrame([("ParagraphStyle/G%3aCredits",), ("ParagraphStyle/H%3aCredits",), ("Body",)], "style string")
    found, faults = relational.select_styles(p, ["credits", "body", "G:Credits", "none"])
    assert {(r.selector, r.fault) for r in faults.collect()} == {("credits", "ambiguous"), ("none", "not found")} and found.count() == 4
    asked = spark.createDataFrame([("1", "a\nb", False), ("2", "7", True), ("3", "q", False)], "id string, source string, skip boolean")
    got = spark.createDataFrame([("1", "x"), ("2", "8"), ("9", "z")], "id string, translated string")
    assert {(r.id, r.fault) for r in relational.response_faults(asked, got).collect()} == {("1", "line breaks differ"), ("2", "changed a skipped text"), ("3", "missing"), ("9", "unknown")}
