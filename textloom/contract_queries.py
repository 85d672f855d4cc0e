"""More registered queries: scans of stories, ledgers, audits and layouts,
locks, glossary contracts, rule sets, scalars, and spreadsheet tables.

As in ``queries``, inputs are derived from columns of whole tables, faults are
seeded by arithmetic on a key, and the SQL states the result independently.
"""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .functions import markup, typography
from .functions import text as tx
from .functions.text import NBSP
from .operators import audit, glossary, ledger, locks, packing, qa, relational, structure, validation
from .operators.orders import ranked
from .queries import query, spread, table


def cat(*parts) -> Column:
    """Texts and columns as one text."""
    return F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))


def every(k: Column, n: int, at: int = 0) -> Column:
    """Every n-th key."""
    return k % n == at


# --- stories ----------------------------------------------------------------


def _line_stories(spark, sf_dir) -> DataFrame:
    """One story per document: a paragraph for each line, every fourth one
    inside a generated reference."""
    d = spread(table(spark, sf_dir, "documents"))
    lines = F.split(F.regexp_replace(F.coalesce("text", F.lit("")), r"[<>&\r]", " "), "\n", -1)

    def paragraph(x, i):
        content = F.concat(F.lit('<Content id="'), F.format_string("%04d", i), F.lit('">'), x, F.lit("</Content>"))
        held = F.when(i % 4 == 3, F.concat(F.lit('<CrossReferenceSource Name="r">'), content, F.lit("</CrossReferenceSource>"))).otherwise(content)
        return F.concat(F.lit('<ParagraphStyleRange AppliedParagraphStyle="ParagraphStyle/S'), (i % 3).cast("string"), F.lit('">'), held, F.lit("</ParagraphStyleRange>"))

    xml = cat("<Story>", F.array_join(F.transform(lines, paragraph), ""), "</Story>")
    return d.select("doc_id", F.col("doc_id").cast("string").alias("file_name"), xml.alias("xml"))


_LINES = r"""WITH t AS (SELECT doc_id, string_split(regexp_replace(coalesce(text, ''), '[<>&\r]', ' ', 'g'), chr(10)) AS x FROM documents),
l AS (SELECT doc_id, i, x[i + 1] AS line FROM (SELECT doc_id, x, unnest(range(0, len(x))) AS i FROM t)),
p AS (SELECT doc_id, i, line, printf('%04d', i) AS id, i % 4 = 3 AS held FROM l)"""


@query(_LINES + """
SELECT doc_id, i::BIGINT AS pos, i::VARCHAR AS content_id, sha256(line) AS digest FROM p
""")
def content_scan(spark, sf_dir):
    """All Content elements of all stories, by a plain scan."""
    found = structure.content_units(_line_stories(spark, sf_dir))
    return found.select(F.col("file_name").cast("long").alias("doc_id"), F.col("pos").cast("long").alias("pos"), "content_id", F.sha2("content", 256).alias("digest"))


@query(_LINES + "SELECT doc_id, i::VARCHAR AS content_id, length(line)::BIGINT AS chars FROM p WHERE held")
def panel_scan(spark, sf_dir):
    """Content of generated references only."""
    found = structure.panel_content(_line_stories(spark, sf_dir))
    return found.select(F.col("file_name").cast("long").alias("doc_id"), "content_id", F.length("text").cast("long").alias("chars"))


@query(_LINES + """
SELECT doc_id, i::BIGINT AS pos, 'ParagraphStyle/S' || i % 3 AS style, length(line)::BIGINT + length(id) + 25 + CASE WHEN held THEN 54 ELSE 0 END AS chars FROM p
""")
def paragraph_scan(spark, sf_dir):
    """Paragraphs of all stories with their styles."""
    found = structure.styled_paragraphs(_line_stories(spark, sf_dir))
    return found.select(F.col("file_name").cast("long").alias("doc_id"), F.col("pos").cast("long").alias("pos"), "style", F.length("xml").cast("long").alias("chars"))


@query(_LINES + """
, q AS (SELECT doc_id, i, '<Content id="' || id || '">' || CASE WHEN i % 5 = 2 THEN 'new ' || i ELSE line END || '</Content>' AS c, held FROM p)
SELECT doc_id, sha256('<Story>' || string_agg('<ParagraphStyleRange AppliedParagraphStyle="ParagraphStyle/S' || i % 3 || '">' || CASE WHEN held THEN '<CrossReferenceSource Name="r">' || c || '</CrossReferenceSource>' ELSE c END || '</ParagraphStyleRange>', '' ORDER BY i) || '</Story>') AS digest FROM q GROUP BY doc_id
""")
def content_replacement(spark, sf_dir):
    """Texts of listed content ids put in place, the rest byte for byte."""
    s = _line_stories(spark, sf_dir)
    values = structure.content_units(s).where("pos % 5 = 2").select("file_name", "content_id", cat("new ", F.col("pos")).alias("text"))
    return structure.replace_contents(s.drop("doc_id"), values).select(F.col("file_name").cast("long").alias("doc_id"), F.sha2("xml", 256).alias("digest"))


@query("""
SELECT c_custkey AS k, CASE WHEN c_custkey % 3 = 0 THEN 'text or structure outside references differs' WHEN c_custkey % 5 = 0 THEN 'allowed reference is not in the story' END AS error,
  CASE WHEN c_custkey % 3 = 0 OR c_custkey % 5 = 0 THEN NULL ELSE '<S><ParagraphStyleRange id="7"><CharacterStyleRange><Content id="0">' || c_name || '</Content><CrossReferenceSource Self="u1" Name="r1"><Content id="1">new ' || c_custkey || '</Content><TextVariableInstance Self="u2" ResultText="' || (c_custkey % 90 + 1) || '"/></CrossReferenceSource></CharacterStyleRange></ParagraphStyleRange></S>' END AS xml
FROM customer
""")
def panel_reconciliation(spark, sf_dir):
    """Results of generated references taken over, other changes refused."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")

    def story(name, content_id, ids, words, page, ref):
        return cat('<S><ParagraphStyleRange id="7"><CharacterStyleRange><Content', content_id, ">", name, f'</Content><CrossReferenceSource Self="{ids[0]}" Name="', ref, f'"><Content id="1">', words, f'</Content><TextVariableInstance Self="{ids[1]}" ResultText="', page, '"/></CrossReferenceSource></CharacterStyleRange></ParagraphStyleRange></S>')

    ref = F.when(every(k, 5), F.lit("r9")).otherwise(F.lit("r1"))
    before = story(F.col("c_name"), ' id="0"', ("u1", "u2"), F.lit("old"), F.lit("1"), ref)
    after = story(F.when(every(k, 3), F.lit("other")).otherwise(F.col("c_name")), "", ("u8", "u9"), cat("new ", k), k % 90 + 1, ref)
    pairs = c.select(k.alias("k"), before.alias("before"), after.alias("after"))
    return structure.reconcile_stories(pairs, ["r1"]).select("k", "error", "xml")


@query("""
SELECT doc_id, CASE WHEN doc_id % 3 <> 0 THEN 'T' || doc_id END AS title, lang AS stage FROM documents
""")
def front_matter_fields(spark, sf_dir):
    """Fields of a front matter; one that repeats has no value."""
    d = table(spark, sf_dir, "documents")
    head = cat("---\ntitle: T", F.col("doc_id"), "\nstage:  ", F.col("lang"), " \n", F.when(every(F.col("doc_id"), 3), "title: again\n").otherwise(""), "---\n")
    t = d.select("doc_id", F.concat(head, F.coalesce("text", F.lit(""))).alias("text"))
    return validation.front_matter(validation.front_matter(t, "title"), "stage").select("doc_id", "title", "stage")


# --- ledgers ----------------------------------------------------------------


@query("""
WITH c AS (SELECT c_custkey AS k, c_name AS file, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE c_custkey || 'a' END AS a, CASE WHEN c_custkey % 9 = 0 THEN 'dup' ELSE c_custkey || 'b' END AS b FROM customer),
u AS (SELECT file, a AS id FROM c UNION ALL SELECT file, b FROM c)
SELECT file, 'name, hash or units missing' AS fault FROM c WHERE k % 7 = 0
UNION ALL SELECT file, 'unit without id or text' FROM c WHERE k % 5 = 0
UNION ALL SELECT file, 'unit without id or text' FROM c WHERE k % 8 = 0
UNION ALL SELECT file, 'unknown kind of unit ' || a FROM c WHERE k % 6 = 0
UNION ALL SELECT min(file), 'repeated unit ' || id FROM u GROUP BY id HAVING count(*) > 1
""")
def ledger_contract(spark, sf_dir):
    """Faults of ledger rows and units."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    unit = lambda i, kind, plain: F.struct(i.alias("id"), kind.alias("kind"), plain.alias("plain"))
    units = F.array(
        unit(F.when(every(k, 5), "").otherwise(cat(k, "a")), F.when(every(k, 6), "odd").otherwise("prose"), F.col("c_name")),
        unit(F.when(every(k, 9), "dup").otherwise(cat(k, "b")), F.lit("sourceCode"), F.when(every(k, 8), "").otherwise("x")),
    )
    return ledger.ledger_faults(c.select(F.col("c_name").alias("file"), F.when(every(k, 7), "bad").otherwise(F.sha2("c_name", 256)).alias("sha256"), units.alias("units")))


@query("""
WITH a AS (SELECT c_mktsegment AS file, c_name AS id, c_name AS t, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) AS n FROM customer),
b AS (SELECT c_mktsegment AS file, CASE WHEN c_custkey % 11 = 0 THEN 'x' ELSE c_name END AS id, CASE WHEN c_custkey % 13 = 0 THEN 'y' ELSE c_name END AS t, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) AS n FROM customer WHERE c_custkey < 700 OR c_custkey > 720)
SELECT coalesce(a.file, b.file) AS file, 'prose' AS kind, coalesce(a.n, b.n) AS n, CASE WHEN a.id IS NULL THEN 'not in ledger' WHEN b.id IS NULL THEN 'not in report' WHEN a.id <> b.id THEN 'other unit' ELSE 'other text' END AS fault
FROM a FULL JOIN b ON a.file = b.file AND a.n = b.n WHERE a.id IS NULL OR b.id IS NULL OR a.id <> b.id OR a.t <> b.t
""")
def ledger_report_match(spark, sf_dir):
    """A report's units against the ledger's, by place within file and kind."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    units = c.select(F.col("c_mktsegment").alias("file"), F.lit("prose").alias("kind"), F.col("c_name").alias("id"), cat(" ", F.col("c_name")).alias("plain"), k.alias("pos"))
    report = c.where("c_custkey < 700 or c_custkey > 720").select(F.col("c_mktsegment").alias("file"), F.lit("prose").alias("kind"), F.when(every(k, 11), "x").otherwise(F.col("c_name")).alias("id"), F.when(every(k, 13), "y").otherwise(cat(F.col("c_name"), "\t")).alias("text"), k.alias("pos"))
    return ledger.match_report(units, report).select("file", "kind", F.col("n").cast("long").alias("n"), "fault")


@query("SELECT c_name AS id FROM customer WHERE c_custkey % 4 = 0 OR c_custkey % 10 = 1")
def ledger_missing_units(spark, sf_dir):
    """Units whose text is not in the text of their page."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    units = c.select(F.col("c_name").alias("file"), F.col("c_name").alias("id"), F.replace("c_name", F.lit("#"), F.lit(" # ")).alias("plain"))
    pages = c.where("c_custkey % 10 <> 1").select(F.col("c_name").alias("file"), F.when(every(k, 4), "none").otherwise(cat("a ", F.replace("c_name", F.lit("0"), F.lit("0\n")), " z")).alias("text"))
    return ledger.missing_units(units, pages).select("id")


@query("""
SELECT o_custkey::VARCHAR AS file, 'u' || o_orderkey AS id, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderkey END AS frame_index, CASE WHEN o_orderkey % 4 <> 0 THEN 11 END::BIGINT AS start FROM orders
""")
def unit_positions(spark, sf_dir):
    """Units found one after the other in the frames of their file."""
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("file"), F.col("o_orderkey").alias("k"))
    number = F.format_string("%09d", "k")
    frames = o.select("file", F.col("k").alias("frame_index"), cat("A", number, " \n B", number).alias("text"))
    units = o.select("file", F.col("k").alias("pos"), cat("u", F.col("k")).alias("id"), F.when(every(F.col("k"), 4), "none").otherwise(cat("B", number)).alias("plain"))
    return ledger.cursor_match(frames, units)


@query("""
SELECT c_name AS id, CASE WHEN c_custkey % 4 = 0 THEN 'de ' || c_name END AS german, CASE c_custkey % 3 WHEN 0 THEN 'German' WHEN 1 THEN 'Portuguese' ELSE 'Latin' END AS language FROM customer
""")
def ledger_languages(spark, sf_dir):
    """Units of a ledger, exploded, with their translation and the canonical
    name of a language."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    done = F.when(every(k, 4), F.create_map(F.lit("German"), cat("de ", F.col("c_name"))))
    unit = F.struct(F.col("c_name").alias("id"), F.lit("prose").alias("kind"), F.col("c_name").alias("plain"), done.alias("translations"))
    each = ledger.exploded_units(c.select(F.lit("b").alias("book"), F.col("c_name").alias("file"), F.array(unit).alias("units")))
    known = ledger.translations_for(each, " German ").select("id", F.col("target").alias("german"))
    said = F.when(every(k, 3), " German").when(every(k, 3, 1), "Brazilian Portuguese").otherwise("Latin ")
    return c.select(F.col("c_name").alias("id"), ledger.language_key(said).alias("language")).join(known, "id", "left")


@query("""
SELECT c_custkey AS row_no, col AS "column", CASE col WHEN 'english' THEN c_name WHEN 'portuguese' THEN 'pt' END AS expected, 'z' AS actual FROM customer, (VALUES ('english'), ('portuguese')) v(col) WHERE c_custkey % 10 = 3
""")
def caption_changes(spark, sf_dir):
    """Cells of a caption sheet that an update changed without being asked."""
    k = F.col("row_no")
    sheet = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("row_no"), F.col("c_name").alias("english"), F.lit("pt").alias("portuguese"))
    new = sheet.where("row_no % 2 = 0").select("row_no", cat("pt ", F.col("english")).alias("translated"))
    after = ledger.put_captions(sheet, new)
    spoilt = after.select("row_no", *(F.when(every(k, 10, 3), "z").otherwise(F.col(c)).alias(c) for c in ("english", "portuguese")))
    return ledger.caption_changes(sheet, spoilt, new)


# --- audits and layouts -----------------------------------------------------


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_partkey % 5 = 0 THEN 'style' WHEN l_suppkey % 7 < l_linenumber + 2 AND l_suppkey % 7 + 2 > l_linenumber THEN 'reference' END AS reason FROM lineitem
""")
def match_protection(spark, sf_dir):
    """Why matches may not change: their style, or a range they overlap."""
    l = table(spark, sf_dir, "lineitem")
    ranges = F.array(F.struct((F.col("l_suppkey") % 7).alias("start"), (F.col("l_suppkey") % 7 + 2).alias("end")))
    style = F.when(every(F.col("l_partkey"), 5), "Credits").otherwise("Body")
    return l.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", audit.protection_of(F.col("l_linenumber"), F.col("l_linenumber") + 2, style, ranges, ["Credits"]).alias("reason"))


def _styled(spark, sf_dir):
    k = F.col("p_partkey")
    return table(spark, sf_dir, "part").select("p_partkey", cat("ParagraphStyle/G", k % 3, "%3aS", k % 4).alias("style"))


@query("""
WITH p AS (SELECT p_partkey, 'G' || p_partkey % 3 AS g, 'S' || p_partkey % 4 AS s FROM part)
SELECT 'S1' AS selector, g || ':' || s AS applied_style, count(*) AS n FROM p WHERE s = 'S1' GROUP BY ALL UNION ALL SELECT 'g2:s3', g || ':' || s, count(*) FROM p WHERE g = 'G2' AND s = 'S3' GROUP BY ALL
""")
def style_selection(spark, sf_dir):
    """Paragraphs named by whole paths or last parts of their styles."""
    found, _ = relational.select_styles(_styled(spark, sf_dir), ["S1", "g2:s3", "none"])
    return found.groupBy("selector", "applied_style").agg(F.count("*").alias("n"))


@query("SELECT 'S1' AS selector, 'ambiguous' AS fault UNION ALL SELECT 'none', 'not found'")
def style_selector_faults(spark, sf_dir):
    """Selectors that name no style, or several."""
    _, faults = relational.select_styles(_styled(spark, sf_dir), ["S1", "g2:s3", "none"])
    return faults


@query("""
WITH e AS (SELECT o_orderkey AS story, r, 'r' || r AS rule FROM orders, (VALUES (0), (1), (2)) v(r)),
x AS (SELECT *, CASE WHEN story % 10 = r THEN 0 WHEN story % 7 = 0 AND r = 1 THEN 2 ELSE 1 END AS n_runs FROM e)
SELECT story, rule, n_runs::BIGINT AS n_runs, CASE WHEN n_runs = 0 THEN 0 ELSE story % 3 END AS declared, CASE WHEN story % 11 = 0 THEN 0 ELSE story % 3 END AS n_found, n_runs = 1 AND story % 3 = CASE WHEN story % 11 = 0 THEN 0 ELSE story % 3 END AS complete FROM x
""")
def rule_run_plan(spark, sf_dir):
    """Whether each rule ran once on each story and found what it declares."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("story"))
    story = F.col("story")
    rules = spark.createDataFrame([(f"r{i}",) for i in range(3)], "rule string")
    pairs = o.select("story", F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(f"r{i}").alias("rule")) for i in range(3)))).alias("x")).select("story", "x.i", "x.rule")
    times = F.when(story % 10 == F.col("i"), 0).when(every(story, 7) & (F.col("i") == 1), 2).otherwise(1)
    runs = pairs.withColumn("times", times).where("times > 0").select("story", "rule", (story % 3).alias("declared"), F.explode(F.sequence(F.lit(1), F.col("times"))))
    matches = pairs.where((story % 3 > 0) & ~every(story, 11)).select("story", "rule", F.explode(F.sequence(F.lit(1).cast("long"), story % 3)))
    return audit.rule_plan(o, rules, runs.drop("col"), matches.drop("col"))


_FORMAT_NAMES = ["Image", "In the text", "Credits", "Other"]


def _layout(spark, sf_dir, include=None):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("format_id"))
    k = F.col("format_id")
    name = F.get(F.array(*map(F.lit, _FORMAT_NAMES)), (k % 4).cast("int"))
    templates = dict(zip(audit.KINDS_OF_TEMPLATE, audit.TEMPLATES["German"]))
    literal = F.when(every(k, 4), audit.blocks_literal(templates["image"])).when(every(k, 4, 1), audit.blocks_literal(templates["text"])).otherwise(audit.blocks_literal(templates["credit"]))
    formats = c.select("format_id", name.alias("name"), F.size(literal).alias("blocks"))
    each = c.select("format_id", F.size(literal).alias("n"), F.posexplode(literal).alias("pos", "b")).where(~(every(k, 7) & (F.col("pos") == F.col("n") - 1)))
    custom = F.col("b.type") == audit.CUSTOM
    blocks = each.select("format_id", "pos", F.col("b.type").alias("type"), F.when(every(k, 5) & custom, "old").otherwise(F.col("b.text")).alias("text"), F.when(every(k, 11) & ~custom, "x").otherwise(F.col("b.delimiter")).alias("delimiter"), *([include.alias("include_delimiter")] if include is not None else []))
    fits = F.when(k % 4 >= 2, "Bild:").otherwise(f"(Siehe Bild, S.{NBSP}3.)")
    both = F.array(F.struct((k * 2).alias("ref_id"), fits.alias("text"), F.when(every(k, 6), "p/Credits").otherwise("s").alias("style")), F.struct((k * 2 + 1).alias("ref_id"), F.lit("wrong").alias("text"), F.when(k % 6 <= 1, "p/Credits").otherwise("s").alias("style")))
    refs = c.select("format_id", F.explode(both).alias("r")).select("r.ref_id", "format_id", "r.text", "r.style")
    lost = c.where("format_id % 50 = 0").select((-1 - k).alias("ref_id"), (-1 - k).alias("format_id"), F.lit("x").alias("text"), F.lit("s").alias("style"))
    return audit.layout_plan(formats, blocks, refs.union(lost), "German", ["Credits"])


_LAYOUT = """WITH f AS (SELECT c_custkey AS k, ['Image', 'In the text', 'Credits', 'Other'][c_custkey % 4 + 1] AS name FROM customer),
a AS (SELECT *, CASE WHEN k % 6 = 0 THEN 'protected' WHEN k % 6 = 1 THEN 'shared with protected content' WHEN k % 4 = 3 THEN 'no template for this format' WHEN k % 7 = 0 THEN 'count of blocks differs' WHEN k % 11 = 0 THEN 'structure differs' WHEN k % 5 = 0 THEN 'edit' ELSE 'keep' END AS action FROM f)
"""


@query(_LAYOUT + "SELECT k AS format_id, name, action FROM a")
def layout_formats(spark, sf_dir):
    """What has to happen to each cross-reference format in use."""
    return _layout(spark, sf_dir)[0]


@query(_LAYOUT + """
SELECT k * 2 AS ref_id, k AS format_id, action, action = 'edit' AS "update" FROM a
UNION ALL SELECT k * 2 + 1, k, action, action IN ('edit', 'keep') FROM a
UNION ALL SELECT -1 - k, -1 - k, 'format not inspected', false FROM a WHERE k % 50 = 0
""")
def layout_references(spark, sf_dir):
    """References to be updated, by their format and their text."""
    return _layout(spark, sf_dir)[1]


@query("""
SELECT c_custkey AS doc, 'layers in another order' AS fault FROM customer WHERE c_custkey % 9 = 0
UNION ALL SELECT c_custkey, 'style to be reviewed: Body Text No Indent' FROM customer WHERE c_custkey % 4 = 0
UNION ALL SELECT c_custkey, 'style to be reviewed: Body Text Indented' FROM customer WHERE c_custkey % 5 = 0
""")
def layout_documents(spark, sf_dir):
    """Documents with other layers or body styles than the house style's."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("doc"))
    k = F.col("doc")
    names = F.array(*map(F.lit, audit.LAYERS))
    layers = c.select("doc", F.posexplode(F.when(every(k, 9), F.reverse(names)).otherwise(names)).alias("pos", "name"))
    style = lambda name, indent: F.struct(F.lit(name).alias("name"), indent.cast("double").alias("first_line_indent"))
    both = F.array(style("Body Text No Indent", F.when(every(k, 4), 3).otherwise(0)), style("Body Text Indented", F.lit(12)))
    styles = c.select("doc", F.explode(both).alias("s")).select("doc", "s.*").where(~(every(k, 5) & (F.col("name") == "Body Text Indented")))
    return audit.document_layout(layers, styles, ["doc"])


@query("""
SELECT user_id, sum(event_id % 5)::BIGINT AS rows, sum(event_id % 3)::BIGINT AS links, sum(event_id % 2)::BIGINT AS overflows, user_id % 10 <> 0 AS complete FROM events GROUP BY user_id
""")
def overflow_totals(spark, sf_dir):
    """Sums of partial inventories against what they declare as a whole."""
    e = table(spark, sf_dir, "events")
    pages = e.select("user_id", *((F.col("event_id") % n).alias(c) for c, n in (("rows", 5), ("links", 3), ("overflows", 2))))
    stated = pages.groupBy("user_id").agg(*(F.sum(c).alias(c) for c in ("rows", "links", "overflows")))
    return audit.overflow_totals(pages, stated.withColumn("links", F.col("links") + F.when(every(F.col("user_id"), 10), 1).otherwise(0)), ["user_id"])


#: SHA-256 of "engine", in capitals.
_ENGINE = "ED9F6F25068608EFD412958DA4DFC19328CA3511251FA6D5F9C42BAF230E32F8"


@query("""
SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'see ' || c_name || ', p. ' || c_custkey || '.' END AS rendered, c_custkey % 2 = 0 AS accepted FROM customer
""")
def rendered_references(spark, sf_dir):
    """Reference texts filled with their results, and accepted engines."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    results = F.when(every(k, 3), F.array(F.col("c_name"))).otherwise(F.array(F.col("c_name"), k.cast("string")))
    digest = F.when(every(k, 2), F.sha2(F.lit("engine"), 256)).otherwise(F.sha2("c_name", 256))
    return c.select("c_custkey", audit.rendered_reference(F.lit("see \x18, p. \x18."), results).alias("rendered"), audit.accepted_engine(digest, [_ENGINE]).alias("accepted"))


# --- locks ------------------------------------------------------------------


_LOCKED = """WITH p AS (SELECT p_partkey AS k, p_partkey::VARCHAR AS g, p_brand, p_type FROM part)
SELECT k, CASE k % 3 WHEN 2 THEN '' ELSE '⟦S_' || g || '_001⟧' END || 'see ' || CASE k % 3 WHEN 1 THEN '' ELSE '⟦G_' || g || '_0001⟧' END || ' now|⟦S_' || g || '_002⟧a⟦L_' || g || '_2_1⟧' || p_type || '|⟦S_' || g || '_003⟧plain' AS answer,
  2 AS n_locks, CASE k % 3 WHEN 0 THEN '' WHEN 1 THEN 'missing' ELSE 'anchor,missing' END AS faults, CASE WHEN k % 3 = 0 THEN 'see T-' || p_brand || ' now|a' || chr(10) || p_type || '|plain' END AS restored FROM p"""


@query(_LOCKED)
def lock_groups(spark, sf_dir):
    """Segments locked for a translator, and answers checked and restored."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    groups = p.select("p_partkey", k.cast("string").alias("group_id"), F.array(cat("see ", F.col("p_brand"), " now"), cat("a\n", F.col("p_type")), F.lit("plain")).alias("segments"))
    terms = p.groupBy(F.col("p_brand").alias("source")).agg(F.min("p_partkey").alias("ord")).select("source", cat("T-", F.col("source")).alias("target"), F.lit("word").alias("kind"), F.lit("").alias("source_term"), "ord")
    ready = locks.prepare_groups(groups, glossary.compile_entries(terms))
    first = F.get("prepared", F.lit(0))
    spoilt = F.when(every(k, 3, 1), F.regexp_replace(first, "⟦G_[^⟧]+⟧", "")).when(every(k, 3, 2), F.regexp_replace(first, "^⟦S_[^⟧]+⟧", "")).otherwise(first)
    answer = F.concat(F.array(spoilt), F.slice("prepared", 2, 2))
    faults = locks.token_faults(F.col("answer"), F.col("group_id"), F.col("locks"))
    told = ready.withColumn("answer", answer)
    restored = F.when(every(k, 3), locks.restore_segments(F.col("answer"), F.col("group_id"), F.col("locks")))
    return told.select(k.alias("k"), F.array_join("answer", "|").alias("answer"), F.size("locks").alias("n_locks"), F.array_join(faults, ",").alias("faults"), F.array_join(restored, "|").alias("restored"))


@query("""
SELECT c_custkey, c_name || ' in __lock_acronym_1__ __lock_acronym_2__!' AS locked, c_name || ' in ' || c_mktsegment || ' XX!' AS restored FROM customer
""")
def acronym_lock_roundtrip(spark, sf_dir):
    """Acronym targets locked in a text and put back."""
    c = table(spark, sf_dir, "customer")
    value = cat(F.col("c_name"), " in ", F.lower("c_mktsegment"), " XX!")
    held = locks.acronym_locks(value, F.array(F.col("c_mktsegment"), F.lit("XX"), F.lit("none"), F.lit("XX")))
    locked = c.select("c_custkey", held.alias("l"), locks.apply_acronyms(value, held).alias("locked"))
    return locked.select("c_custkey", "locked", locks.restore_acronyms(F.col("locked"), F.col("l")).alias("restored"))


# --- glossaries -------------------------------------------------------------


@query("""
WITH p AS (SELECT p_partkey AS k, p_brand AS b, CASE WHEN p_brand = 'Brand#11' THEN 'T11' ELSE replace(p_brand, 'Brand', 'B') END AS t FROM part)
SELECT k, CASE WHEN k % 2 = 0 THEN t ELSE 'a ' || t || ', ' || t END AS replaced, CASE WHEN k % 2 = 0 THEN 1 ELSE 2 END AS n, CASE WHEN k % 2 = 0 AND b = 'Brand#11' THEN 'T11' END AS answer FROM p
""")
def glossary_replacement(spark, sf_dir):
    """Terms replaced in order, and texts that this answers by itself."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    rows = p.select(k.alias("k"), F.when(every(k, 2), F.col("p_brand")).otherwise(cat("a ", F.col("p_brand"), ", ", F.col("p_brand"))).alias("content"))
    done = glossary.replace_in(rows, [("Brand", "B", "word"), ("Brand#11", "T11", "word")])
    n = F.aggregate("applied", F.lit(0), lambda acc, x: acc + x["n"])
    return done.select("k", "replaced", n.alias("n"), glossary.local_answer(F.col("content"), F.col("replaced"), F.col("applied")).alias("answer"))


@query("""
SELECT p_partkey, p_brand AS source, 'T' || p_size % 3 AS target, 'about ' || p_brand || CASE WHEN p_size % 3 = 1 THEN 1 ELSE 0 END AS context, CASE WHEN p_size % 3 = 1 THEN 'word' ELSE 'acronym' END AS kind FROM part
""")
def glossary_enrichment(spark, sf_dir):
    """Matches with context and kind of their pair, else of their source."""
    p = table(spark, sf_dir, "part")
    matches = p.select("p_partkey", cat(" ", F.col("p_brand")).alias("source"), cat("t", F.col("p_size") % 3, " ").alias("target"))
    both = F.explode(F.array(*(F.struct(F.lit(f"T{i}").alias("target"), F.lit(kind).alias("kind"), F.lit(i).alias("ord")) for i, kind in enumerate(["acronym", ""]))))
    known = p.select(F.col("p_brand").alias("source")).distinct().select("source", both.alias("x")).select("source", "x.target", cat("about ", F.col("source"), F.col("x.ord")).alias("context"), "x.kind", "x.ord")
    out = glossary.enrich(matches, known)
    return out.withColumn("target", F.upper("target"))


def _part_glossary(spark, sf_dir):
    """An exploded glossary: one source per part."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    fields = F.array(*(F.struct(F.lit(f).alias("field"), v.alias("value")) for f, v in [("English Definition", cat("about ", F.col("p_type"), " ", k)), ("French", F.when(every(k, 4), " ").otherwise(cat("fr ", k))), ("French Definition", F.when(every(k, 3), "").otherwise(cat("de ", k)))]))
    kind = F.when(every(k, 2), "acronyms").otherwise("words")
    return p.select(kind.alias("kind"), cat(F.col("p_name"), " ", k).alias("source"), F.explode(fields).alias("f"), k.alias("ord")).select("kind", "source", "f.field", "f.value", "ord")


_PART = """WITH p AS (SELECT p_partkey AS k, p_name || ' ' || p_partkey AS s, 'about ' || p_type || ' ' || p_partkey AS e, CASE WHEN p_partkey % 4 = 0 THEN '' ELSE 'fr ' || p_partkey END AS t, CASE WHEN p_partkey % 3 = 0 THEN '' ELSE 'de ' || p_partkey END AS d, p_partkey % 2 = 0 AS acronym FROM part)
"""


@query(_PART + """
SELECT s AS source, CASE WHEN t <> '' THEN t WHEN acronym THEN d ELSE '' END AS target, CASE WHEN acronym THEN 'acronym' ELSE 'word' END AS kind, '' AS source_term, k * 2 AS ord FROM p WHERE CASE WHEN t <> '' THEN t WHEN acronym THEN d ELSE '' END <> ''
UNION ALL SELECT e, d, 'definition', s, k * 2 + 1 FROM p WHERE acronym AND d <> ''
""")
def glossary_entries(spark, sf_dir):
    """Term and definition entries of an exploded glossary."""
    return glossary.entries(_part_glossary(spark, sf_dir), "French", "French Definition")


@query(_PART + """
SELECT s AS term, e AS definition, t AS target_term, d AS target_definition FROM p WHERE t <> '' OR d <> ''
""")
def glossary_table_map(spark, sf_dir):
    """Pairs of term and definition with their targets."""
    return glossary.table_map(_part_glossary(spark, sf_dir), "French", "French Definition")


@query("""
WITH b AS (SELECT DISTINCT p_brand AS s FROM part)
SELECT s AS source, CASE WHEN ends_with(s, '1') THEN 'ac ' ELSE 'w ' END || s AS target, CASE WHEN ends_with(s, '1') THEN 'ca' ELSE 'cw' END AS context, CASE WHEN ends_with(s, '1') THEN 'acronym' ELSE 'word' END AS kind FROM b
""")
def glossary_pairs(spark, sf_dir):
    """Words and acronyms as pairs; an acronym replaces an equal word."""
    b = table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("source")).agg(F.min("p_partkey").alias("ord"))
    words = b.select("source", cat("w ", F.col("source")).alias("target"), F.lit("cw ").alias("context"), "ord")
    acronyms = b.where("source like '%1'").select(cat(" ", F.col("source")).alias("source"), cat("ac ", F.col("source")).alias("target"), F.lit("ca").alias("context"), "ord")
    return glossary.pairs_for(words, acronyms)


@query("""
WITH b AS (SELECT DISTINCT p_brand AS s FROM part)
SELECT lower(s) AS folded, upper(s) || ',' || s AS sources, 'U,T' AS targets FROM b
""")
def glossary_ambiguities(spark, sf_dir):
    """Case folds with several sources."""
    b = table(spark, sf_dir, "part").groupBy("p_brand").agg(F.min("p_partkey").alias("ord"))
    both = F.explode(F.array(F.struct(F.col("p_brand").alias("source"), F.lit("T").alias("target")), F.struct(F.upper("p_brand").alias("source"), F.lit("U").alias("target"))))
    rows = b.select(both.alias("x"), "ord").select("x.source", "x.target", F.lit("word").alias("kind"), F.lit("").alias("source_term"), "ord")
    found = glossary.ambiguities(glossary.compile_entries(rows))
    return found.select("folded", F.array_join("sources", ",").alias("sources"), F.array_join("targets", ",").alias("targets"))


@query("""
SELECT lower(c_name) AS folded, 'undeclared' AS state FROM customer WHERE c_custkey % 2 = 0 AND c_custkey % 10 <> 0 UNION ALL SELECT 'x' || c_custkey, 'stale' FROM customer WHERE c_custkey % 10 = 1
""")
def collision_contract(spark, sf_dir):
    """Case collisions that are not declared, and declared ones that are gone."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    spelt = c.select(F.explode(F.when(every(k, 2), F.array(F.col("c_name"), F.upper("c_name"))).otherwise(F.array(F.col("c_name")))).alias("source"))
    allowed = c.where("c_custkey % 10 = 0").select(F.lower("c_name").alias("folded")).union(c.where("c_custkey % 10 = 1").select(cat("x", k)))
    return glossary.collision_changes(glossary.case_collisions(spelt), allowed)


@query("""
SELECT p_name || ' ' || p_partkey AS source, row_number() OVER (ORDER BY length(p_name || ' ' || p_partkey) DESC, p_partkey) AS by_length,
  row_number() OVER (ORDER BY p_partkey % 2 = 0 DESC, length(p_name || ' ' || p_partkey) DESC, p_partkey) AS by_kind FROM part
""")
def glossary_orders(spark, sf_dir):
    """Place of every source in both orders of replacement."""
    p = table(spark, sf_dir, "part")
    rows = p.select(cat(F.col("p_name"), " ", F.col("p_partkey")).alias("source"), F.when(every(F.col("p_partkey"), 2), "acronym").otherwise("word").alias("kind"), F.col("p_partkey").alias("ord"))
    out = glossary.placed(glossary.placed(rows, "by_length"), "by_kind", acronyms_first=True)
    return out.select("source", "by_length", "by_kind")


@query(_PART + """
SELECT CASE WHEN acronym THEN 'acronyms/' ELSE 'words/' END || s AS key, 'other fields' AS fault FROM p WHERE k % 7 = 0
UNION ALL SELECT CASE WHEN acronym THEN 'acronyms/' ELSE 'words/' END || s, 'untrimmed value' FROM p WHERE k % 4 = 0 AND k % 7 <> 0
""")
def glossary_field_contract(spark, sf_dir):
    """Compiled sources with other fields than stated or untrimmed values."""
    g = _part_glossary(spark, sf_dir).where(~(every(F.col("ord"), 7) & (F.col("field") == "French")))
    return validation.field_faults(g, ["English Definition", "French", "French Definition"])


@query(_PART + """
SELECT 'gone ' || k AS key, 'not in the glossary' AS fault FROM p WHERE k % 100 = 0
UNION ALL SELECT s, 'protected definition is not excluded' FROM p WHERE e LIKE 'about PROMO%' AND k % 5 <> 0
""")
def glossary_exclusions(spark, sf_dir):
    """Exclusions without a term, and protected definitions not excluded."""
    g = _part_glossary(spark, sf_dir)
    k = F.col("ord")
    sources = g.where("field = 'French'")
    excluded = sources.where(every(k, 5)).select(F.upper("source").alias("term")).union(sources.where(every(k, 100)).select(cat("gone ", k)))
    return validation.exclusion_faults(g, excluded, ["^about PROMO"])


@query(_PART + """
SELECT k, count(*) AS n FROM (SELECT k, unnest(['red', 'ring', 'blue widget']) AS w, s FROM p) WHERE regexp_matches(lower(s), '(^|[^a-z0-9_])' || w || '($|[^a-z0-9_])') GROUP BY k
""")
def sense_contexts(spark, sf_dir):
    """Ambiguous senses whose source occurs in the context."""
    contexts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), cat(F.col("p_name"), " ", F.col("p_partkey")).alias("words"))
    senses = spark.createDataFrame([(w, [w + "1", w + "2"]) for w in ("Red", "ring", "blue widget")], "source string, alternatives array<string>")
    return validation.senses_in_context(contexts, senses, "k", "words").groupBy("k").agg(F.count("*").alias("n"))


# --- contracts --------------------------------------------------------------


@query("""
SELECT n_nationkey AS book, m AS language, CASE WHEN n_nationkey % 3 = 0 THEN 'p1' WHEN n_nationkey % 3 = 1 THEN 'p0' END AS profile FROM nation, (VALUES ('French'), ('German')) v(m)
""")
def default_profiles(spark, sf_dir):
    """The stated default profile, else the only one, else none."""
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("book"), F.explode(F.array(F.lit("French"), F.lit("German"))).alias("language"))
    k = F.col("book")
    profiles = n.select("book", "language", F.explode(F.when(every(k, 3, 1), F.array(F.lit("p0"))).otherwise(F.array(F.lit("p0"), F.lit("p1")))).alias("profile"))
    return validation.default_profile(profiles, n.where("book % 3 = 0").withColumn("profile", F.lit("p1")))


@query("""
SELECT p_brand AS family, array_to_string(list_sort(list_distinct(list('S' || p_size % 2))), ',') AS signatures FROM part GROUP BY 1 HAVING count(DISTINCT p_size % 2) > 1
""")
def family_signatures(spark, sf_dir):
    """Families that are declared with several signatures."""
    p = table(spark, sf_dir, "part").select(F.col("p_brand").alias("family"), cat("S", F.col("p_size") % 2).alias("signature"))
    return validation.signature_conflicts(p).withColumn("signatures", F.array_join("signatures", ","))


@query("""
WITH s AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 20 = 1 THEN ' ' ELSE 'Path/' || p_partkey // 2 || CASE WHEN p_partkey % 10 < 9 THEN '/' || p_partkey ELSE '' END END AS path FROM part),
r AS (SELECT lower(path) AS key FROM s GROUP BY 1 HAVING count(*) > 1)
SELECT path AS key, 'blank path' AS fault FROM s WHERE path = ' ' UNION ALL SELECT path, 'size out of range' FROM s WHERE k % 7 = 0 UNION ALL SELECT path, 'label of another form' FROM s WHERE k % 9 = 0
UNION ALL SELECT key, 'repeated path' FROM r
""")
def style_settings(spark, sf_dir):
    """Faults of style settings: paths, sizes, labels."""
    k = F.col("p_partkey")
    path = F.when(every(k, 20, 1), " ").otherwise(cat("Path/", F.floor(k / 2), F.when(k % 10 < 9, cat("/", k)).otherwise("")))
    s = table(spark, sf_dir, "part").select(path.alias("path"), F.when(every(k, 14), 0.0).when(every(k, 7), 1001.0).otherwise(12.0).alias("size"), F.when(every(k, 9), "-bad").otherwise("Body 1").alias("label"))
    return validation.style_faults(s)


@query("""
WITH c AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 13 = 0 THEN '' ELSE (c_custkey - CASE WHEN c_custkey % 100 = 7 THEN 1 ELSE 0 END)::VARCHAR END AS id FROM customer)
SELECT id AS key, 'blank id' AS fault FROM c WHERE id = '' UNION ALL SELECT id, 'text differs from its hash' FROM c WHERE k % 11 = 0
UNION ALL SELECT id, 'repeated id' FROM c GROUP BY id HAVING count(*) > 1 UNION ALL SELECT '', 'other number of texts'
""")
def protected_manifest(spark, sf_dir):
    """Faults of a manifest of protected texts."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    ident = F.when(every(k, 13), " ").otherwise(F.format_string("%06d", k - F.when(every(k, 100, 7), 1).otherwise(0)))
    rows = c.select(ident.alias("content_id"), F.col("c_name").alias("source_text"), F.sha2(F.when(every(k, 11), "x").otherwise(F.col("c_name")), 256).alias("sha256"))
    return validation.manifest_faults(rows, stated_count=3)


def _rules(spark, sf_dir):
    """Rules of two books: a base and exceptions by language."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    scope = F.when(every(k, 4), "French").when(every(k, 4, 1), "german").otherwise("base")
    return p.select(cat("b", k % 2).alias("book"), scope.alias("scope"), F.col("p_type").alias("rule_type"), cat("r", F.floor(k / 4) % 50).alias("id"), F.col("p_name").alias("pattern"), k.alias("ord"))


_RULES = """WITH r AS (SELECT 'b' || p_partkey % 2 AS book, CASE p_partkey % 4 WHEN 0 THEN 'French' WHEN 1 THEN 'german' ELSE 'base' END AS scope, p_type AS rule_type, 'r' || (p_partkey // 4) % 50 AS id, p_name AS pattern, p_partkey AS ord FROM part)
"""


@query(_RULES + """
SELECT rule_type, id, ord FROM r WHERE book = 'b0' AND (scope = 'French' OR (scope = 'base' AND (rule_type, id) NOT IN (SELECT (rule_type, id) FROM r WHERE book = 'b0' AND scope = 'French')))
""")
def book_rule_set(spark, sf_dir):
    """Rules of a book with a language's exceptions in place."""
    return relational.rule_set(_rules(spark, sf_dir), "b0", "french").select("rule_type", "id", "ord")


def _staged(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    language = F.when(every(k, 3), "All").when(every(k, 3, 1), "French").otherwise("German")
    return p.select(language.alias("language"), cat("r", k).alias("id"), F.when(every(k, 2), F.array(F.lit("text"), F.lit("icml"))).otherwise(F.array(F.lit("layout"))).alias("stages"), F.col("p_name").alias("instruction"), k.alias("ord"))


@query("SELECT 'r' || p_partkey AS id FROM part WHERE p_partkey % 3 <> 2 AND p_partkey % 2 = 0")
def stage_rule_set(spark, sf_dir):
    """Shared rules and those of a language that hold at a stage."""
    return relational.stage_rules(_staged(spark, sf_dir), " french ", "icml").select("id")


@query("""
SELECT ['All', 'French', 'German'][p_partkey % 3 + 1] AS language, sha256('Do:' || chr(10) || string_agg('[r' || p_partkey || '] ' || p_name, chr(10) ORDER BY p_partkey) || chr(10) || 'End.') AS digest FROM part WHERE p_partkey % 2 = 0 GROUP BY 1
""")
def stage_prompts(spark, sf_dir):
    """The instructions of a stage as one text for each language."""
    return validation.prompt_text(_staged(spark, sf_dir), "text", "Do:", "End.").select("language", F.sha2("prompt", 256).alias("digest"))


@query("""
WITH r AS (SELECT c_nationkey::VARCHAR AS rule_type, CASE WHEN c_custkey % 5 = 0 THEN ' ' WHEN c_custkey % 7 = 0 THEN 'same' ELSE c_name END AS id, c_custkey % 4 = 0 AS broken FROM customer)
SELECT rule_type, id, 'blank or repeated id' AS fault FROM r GROUP BY ALL HAVING count(*) > 1 OR id = ' ' UNION ALL SELECT DISTINCT rule_type, id, 'pattern does not compile' FROM r WHERE broken
""")
def rule_pattern_faults(spark, sf_dir):
    """Rules with a blank or repeated id, or a pattern that does not compile."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    rules = c.select(F.col("c_nationkey").cast("string").alias("rule_type"), F.when(every(k, 5), " ").when(every(k, 7), "same").otherwise(F.col("c_name")).alias("id"), F.when(every(k, 4), "(x").otherwise("x+").alias("pattern"))
    return relational.pattern_faults(rules)


@query("""
WITH a AS (SELECT c_custkey AS k, c_name AS id FROM customer)
SELECT id, CASE WHEN k % 10 = 0 THEN 'missing' WHEN k % 10 = 1 THEN 'repeated' WHEN k % 10 = 2 THEN 'changed a skipped text' WHEN k % 10 = 3 THEN 'blank' WHEN k % 10 = 4 THEN 'line breaks differ' ELSE 'lock missing' END AS fault FROM a WHERE k % 10 < 6
UNION ALL SELECT 'new ' || k, 'unknown' FROM a WHERE k % 100 = 0
""")
def response_contract(spark, sf_dir):
    """Faults of translations against what was asked for."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    asked = c.select(F.col("c_name").alias("id"), cat(F.col("c_name"), "\n", "[L]").alias("source"), every(k, 10, 2).alias("skip"))
    reply = F.when(every(k, 10, 3), " ").when(every(k, 10, 4), "[L] one line").when(every(k, 10, 5), "a\nb").otherwise("neu\n[L]")
    answered = c.where("c_custkey % 10 <> 0").select(F.col("c_name").alias("id"), F.explode(F.when(every(k, 10, 1), F.array(F.lit("a"), F.lit("b"))).otherwise(F.array(reply))).alias("translated"))
    extra = c.where("c_custkey % 100 = 0").select(cat("new ", k).alias("id"), F.lit("x").alias("translated"))
    return relational.response_faults(asked, answered.union(extra), F.array(F.lit("[L]")))


@query("""
SELECT c_custkey AS k, CASE c_custkey % 7 WHEN 0 THEN 'try 1' WHEN 1 THEN 'try 2' ELSE 'ok' END AS answer FROM customer
""")
def recheck_rounds(spark, sf_dir):
    """Groups asked again until valid, others left alone."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("group_id"), F.when(F.col("c_custkey") % 7 < 2, "bad").otherwise("ok").alias("answer"))
    ask = lambda df, n: df.withColumn("answer", F.when(F.col("group_id") % 7 < n, F.lit(f"try {n}")).otherwise(F.col("answer")))
    done = packing.recheck(c, lambda df: df.where("answer = 'bad'"), ask)
    return done.select(F.col("group_id").alias("k"), "answer")


@query("""
SELECT c_custkey AS k, CASE WHEN c_custkey % 4 = 0 THEN 'kept ' || c_custkey ELSE c_name END AS text, c_custkey % 6 = 0 AS gone FROM customer
""")
def protected_restore(spark, sf_dir):
    """Protected texts put back by key, and keys without a row."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("text"))
    kept = c.where("k % 4 = 0").select("k", cat("kept ", F.col("k")).alias("value"))
    gone = relational.missing(c.select("k"), c.where("k % 6 <> 0"), "k").withColumn("gone", F.lit(True))
    return relational.update_values(c, kept, "k", "text").join(gone, "k", "left").select("k", "text", F.coalesce("gone", F.lit(False)).alias("gone"))


@query("""
WITH b AS (SELECT c_name AS v, 0 AS part, c_custkey AS o FROM customer WHERE c_custkey % 3 <> 0 UNION ALL SELECT upper(c_name), 1, c_custkey FROM customer)
SELECT arg_min(v, part * 10000000 + o) AS value, row_number() OVER (ORDER BY min(part * 10000000 + o)) AS place FROM b GROUP BY lower(v)
""")
def vocabulary_merge(spark, sf_dir):
    """Two ordered lists as one: case aside, the first spelling stays."""
    c = table(spark, sf_dir, "customer")
    base = c.where("c_custkey % 3 <> 0").select(F.col("c_name").alias("value"), F.col("c_custkey").alias("ord"))
    more = c.select(F.upper("c_name").alias("value"), F.col("c_custkey").alias("ord"))
    both = relational.merge_strings(base, more)
    old = F.when(F.col("value") == F.upper("value"), 1).otherwise(0)
    return ranked(both.select("value", "ord", old.alias("old")), ["old", "ord"], "place").select("value", "place")


@query("""
SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY ALL
""")
def first_rows(spark, sf_dir):
    """The first row of each key, in order."""
    from .operators.segments import first_of

    e = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id")
    return first_of(e, ["user_id", "event_type"], "event_id")


@query("""
SELECT c_custkey, array_to_string(list_sort(['French=f' || c_custkey, 'German=g']), ';') AS languages, CASE WHEN c_custkey % 2 = 0 THEN 'own' ELSE 'placed' END AS definition FROM customer
""")
def definition_fields(spark, sf_dir):
    """Language entries of a map of fields, and a definition by language or
    by place."""
    k = F.col("c_custkey")
    fields = F.create_map(F.lit("French"), cat(" f", k), F.lit("German"), F.lit("g "), F.lit("_1"), F.lit("placed"), F.lit("French Definition"), F.when(every(k, 2), "own").otherwise(""), F.lit(""), F.lit("none"))
    c = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_custkey").alias("source"), fields.alias("fields"))
    each = validation.by_language(c).groupBy(F.col("source").alias("c_custkey")).agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", "language", "target"))), ";").alias("languages"))
    return c.select("c_custkey", validation.definition_for(F.col("fields"), F.lit("French"), F.lit(1)).alias("definition")).join(each, "c_custkey")


# --- scalars ----------------------------------------------------------------


@query("""
SELECT c_custkey, 'a' || chr(10) || c_name AS cell, c_name AS clean, 'a_b_c_' || c_name AS file_part, 'ffi ' || c_name || ' x' AS plain, ' |' || c_name || '|' || chr(9) AS outer_parts, '"q" ' || c_name || ' -' AS punctuation,
  c_custkey % 2 = 0 AS folds, c_custkey % 10 > 2 AS newer, ['prose', 'sourceCode', 'unknown'][c_custkey % 3 + 1] AS font, c_custkey % 3 <> 2 AS font_match, 'x' || repeat(' ', 5) || 'y' AS blanked, 'é' AS request, '2 x' AS spaced
FROM customer
""")
def text_scalars_more(spark, sf_dir):
    """Cells, names, fonts, versions and repairs over customer names."""
    c = table(spark, sf_dir, "customer")
    k, n = F.col("c_custkey"), F.col("c_name")
    font = F.when(every(k, 3), "/ABCDEF+OpenSans-Bold").when(every(k, 3, 1), "SourceCodePro").otherwise("Arial")
    parts = tx.outer_whitespace(F.concat(F.lit(" "), n, F.lit("\t")))
    return c.select(
        "c_custkey",
        tx.cell(cat("a\r\n", n)).alias("cell"),
        tx.strip_control(F.concat(F.lit("\x01"), n, F.lit("\x0b"))).alias("clean"),
        tx.file_part(cat("a:b c/", n)).alias("file_part"),
        tx.plain_line(F.concat(F.lit(" ﬃ\n "), n, F.lit("\u00a0x"))).alias("plain"),
        F.concat_ws("|", parts["leading"], parts["core"], parts["trailing"]).alias("outer_parts"),
        tx.plain_punctuation(F.concat(F.lit("“q” "), n, F.lit(" –"))).alias("punctuation"),
        tx.may_fold_to_ascii(F.when(every(k, 2), "\u212aelvin").otherwise(n)).alias("folds"),
        (tx.version_parts(cat("1.", k % 10)) > tx.version_parts(F.lit("1.2"))).alias("newer"),
        tx.font_class(font).alias("font"),
        tx.font_matches(font, F.array(F.lit("open sans"), F.lit("code-pro"))).alias("font_match"),
        tx.blank_out(F.lit("x12345y"), "[0-9]+").alias("blanked"),
        tx.request_text(F.lit("Ã©"), repair=True).alias("request"),
        validation.collapsed(F.concat(F.lit(" 2 \n x "), F.repeat(F.lit(" "), (k % 3).cast("int"))))["text"].alias("spaced"),
    )


@query("""
SELECT p_partkey AS k, CASE p_partkey % 6 WHEN 0 THEN 'processing instructions' WHEN 1 THEN 'markup tags' WHEN 2 THEN 'line breaks' WHEN 3 THEN 'boundary whitespace' WHEN 4 THEN 'invalid character' ELSE '' END AS changed,
  '<p id="' || p_partkey || '" a="1">' AS tag, 'a &lt; ' || p_name || ' &amp;' AS escaped FROM part
""")
def markup_changes(spark, sf_dir):
    """What differs between a marked-up text and its translation, ids set in
    tags, and escapes."""
    p = table(spark, sf_dir, "part")
    k, n = F.col("p_partkey"), F.col("p_name")
    s = cat("<?a?><b>", n, "</b>\nx")
    o = F.when(every(k, 6), cat("<?z?><b>", n, "</b>\nx")).when(every(k, 6, 1), cat("<?a?><i>", n, "</i>\nx")).when(every(k, 6, 2), cat("<?a?><b>", n, "</b> x")).when(every(k, 6, 3), cat("<?a?><b>", n, "</b>\nx ")).when(every(k, 6, 4), cat("<?a?><b>", n, "</b>\nx\x02")).otherwise(s)
    tag = F.when(every(k, 2), F.lit('<p id="old" a="1">')).otherwise(F.lit('<p a="1">'))
    return p.select(k.alias("k"), F.array_join(markup.changed_parts(s, o), ",").alias("changed"), markup.set_id(tag, k.cast("string")).alias("tag"), markup.escape_xml(cat("a < ", n, " &amp;")).alias("escaped"))


# --- typography -------------------------------------------------------------

_MONTH_SQL = {
    "English": "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec",
    "Portuguese": "janeiro fevereiro março abril maio junho julho agosto setembro outubro novembro dezembro",
    "Dutch": "jan feb mrt apr mei jun jul aug sep okt nov dec",
    "Italian": "gen feb mar apr mag giu lug ago set ott nov dic",
    "Turkish": "Oca Şub Mar Nis May Haz Tem Ağu Eyl Eki Kas Ara",
    "Polish": "sty lut mar kwi maj cze lip sie wrz paź lis gru",
    "Swedish": "jan feb mar apr maj jun jul aug sep okt nov dec",
}


def _month_sql(language: str) -> str:
    names = "[" + ", ".join(f"'{m}'" for m in _MONTH_SQL[language].split()) + "]"
    de = " || 'de' || chr(160)" if language == "Portuguese" else ""
    return f"day(o_orderdate) || chr(160){de} || {names}[month(o_orderdate)] || chr(160){de} || year(o_orderdate) AS {language.lower()}"


@query("SELECT o_orderkey, " + ", ".join(map(_month_sql, _MONTH_SQL)) + " FROM orders")
def typography_dates_more(spark, sf_dir):
    """Order dates, months spelled out, set by the rules of seven languages."""
    o = spread(table(spark, sf_dir, "orders"))

    def spelled(language):
        names = F.array(*(F.lit(forms[-1]) for forms in typography.MONTHS[language]))
        de = " de " if language == "Portuguese" else " "
        return cat(F.dayofmonth("o_orderdate"), de, F.get(names, F.month("o_orderdate") - 1), de, F.year("o_orderdate"))

    return o.select("o_orderkey", *(typography.normalise(spelled(name), name).alias(name.lower()) for name in _MONTH_SQL))


@query("""
SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_custkey || ' kg' ELSE c_custkey || chr(160) || 'kg' END || ' <a b="3 km"/> 4' || chr(160) || 'km' AS text FROM customer
""")
def typography_protected(spark, sf_dir):
    """Typography that leaves protected strings and markup as they are."""
    c = spread(table(spark, sf_dir, "customer"))
    k = F.col("c_custkey")
    kept = F.when(every(k, 2), F.array(cat(k, " kg"), F.lit(""))).otherwise(F.array().cast("array<string>"))
    return c.select("c_custkey", typography.normalise_protected("English")(cat(k, ' kg <a b="3 km"/> 4 km'), kept).alias("text"))


# --- packing ----------------------------------------------------------------

_FIT = """WITH RECURSIVE g AS (SELECT source, doc_id // 5000 AS job, doc_id, {size} AS a, {other} AS c, row_number() OVER (PARTITION BY source, doc_id // 5000 ORDER BY doc_id) AS i FROM documents),
f AS (SELECT source, job, doc_id, i, a, c, 1 AS n, 1 AS b FROM g WHERE i = 1
  UNION ALL SELECT g.source, g.job, g.doc_id, g.i, CASE WHEN {over} THEN g.a ELSE f.a + g.a END, CASE WHEN {over} THEN g.c ELSE f.c + g.c END, CASE WHEN {over} THEN 1 ELSE f.n + 1 END, f.b + CASE WHEN {over} THEN 1 ELSE 0 END
  FROM f JOIN g ON g.source = f.source AND g.job = f.job AND g.i = f.i + 1)
SELECT source, job, doc_id, b AS batch_no FROM f"""


def _job_rows(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("source", F.expr("doc_id div 5000").alias("job"), F.col("doc_id").alias("ord"), F.size(F.split("text", "\n", -1)).alias("items"), F.col("n_chars").alias("chars"))


@query(_FIT.format(size="len(string_split(text, chr(10)))::BIGINT", other="n_chars", over="(f.a + g.a > 160 OR f.c + g.c > 24000 OR f.n >= 8)"))
def diagram_packing(spark, sf_dir):
    """Scans of each job in batches; an oversize one stands alone."""
    return packing.diagram_batches(_job_rows(spark, sf_dir), ["source", "job"]).select("source", "job", F.col("ord").alias("doc_id"), "batch_no")


@query(_FIT.format(size="n_chars", other="0::BIGINT", over="(f.a + g.a > 12000 OR f.n >= 40)"))
def caption_packing(spark, sf_dir):
    """Captions of each job in batches; an oversize one stands alone."""
    return packing.caption_batches(_job_rows(spark, sf_dir), ["source", "job"]).select("source", "job", F.col("ord").alias("doc_id"), "batch_no")


# --- quality checks ---------------------------------------------------------


@query("""
SELECT l_linenumber, 'EDITORIAL_TYPOGRAPHY' AS code, 4 AS column_no, count(*) AS n FROM lineitem WHERE l_partkey % 3 = 0 GROUP BY 1
""")
def qa_typography_issues(spark, sf_dir):
    """Order lines whose output breaks the typography of its language."""
    l = spread(table(spark, sf_dir, "lineitem"))
    key = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    s = cat(F.col("l_partkey"), " kg")
    o = F.when(every(F.col("l_partkey"), 3), s).otherwise(cat(F.col("l_partkey"), f"{NBSP}kg"))
    pairs = l.select("l_linenumber", key.alias("row_no"), F.lit("").alias("s_psr_id"), F.lit("").alias("o_psr_id"), key.cast("string").alias("s_content_tag"), key.cast("string").alias("o_content_tag"), key.cast("string").alias("content_id"), s.alias("s_content"), o.alias("o_content"), F.lit(False).alias("is_protected"), F.lit(None).cast("string").alias("panel_text"), key.alias("first_row"))
    found = qa.row_issues(pairs, ["l_linenumber"], "German")
    return found.where("code = 'EDITORIAL_TYPOGRAPHY'").groupBy("l_linenumber", "code", "column_no").agg(F.count("*").alias("n"))


@query("""
SELECT p_partkey AS row_no, 'GLOSSARY_TABLE_ROW_MISMATCH' AS code FROM part WHERE p_partkey % 3 = 0 AND p_partkey % 2 = 1
""")
def qa_table_rows(spark, sf_dir):
    """Two-cell glossary rows that the output has otherwise."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    pairs = p.select(F.col("p_brand").alias("term"), F.col("p_type").alias("definition"), cat("T-", F.col("p_brand")).alias("target_term"), F.lit("").alias("target_definition")).distinct()
    content = F.when(every(k, 3), F.concat("p_brand", F.lit("\t"), "p_type")).otherwise(F.col("p_brand"))
    out = F.when(every(k, 2), F.concat(F.lit("T-"), "p_brand", F.lit("\t"), "p_type")).otherwise("x")
    rows = p.select(k.alias("row_no"), k.cast("string").alias("content_id"), content.alias("content"), out.alias("o_content"))
    return qa.row_mismatches(rows, pairs).select("row_no", "code")


@query("""
SELECT 'ROW_COUNT_CHANGED' AS code, 'rows: ' || count(*) || ' to ' || count(*) FILTER (c_custkey % 10 <> 0) AS message FROM customer
UNION ALL SELECT 'TRANSLATION_COVERAGE_LOW', count(*) FILTER (c_custkey % 10 <> 0 AND c_custkey % 2 = 0) || ' of ' || count(*) FILTER (c_custkey % 10 <> 0) || ' unchanged' FROM customer
UNION ALL SELECT 'EXPORT_ROW_COUNT_MISMATCH', 'rows: ' || count(*) FROM customer
UNION ALL SELECT 'EXPORT_CONTENT_ID_COUNT_MISMATCH', 'ids: ' || count(*) FILTER (c_custkey % 10 <> 0) FROM customer
""")
def qa_table_issues(spark, sf_dir):
    """Issues of whole tables: rows, ids, coverage."""
    c = table(spark, sf_dir, "customer")
    s = c.select(F.col("c_custkey").alias("row_no"), F.lit("").alias("psr_id"), F.lit("").alias("psr_content"), F.col("c_custkey").cast("string").alias("content_tag"), F.col("c_name").alias("content"))
    o = s.where("row_no % 10 <> 0").withColumn("content", F.when(every(F.col("row_no"), 2), F.col("content")).otherwise(cat("neu ", F.col("content"))))
    return qa.table_issues(s, o, qa.paired(s, o, []), 7, 8).select("code", "message")


@query("""
SELECT c_custkey AS job_id, 'EDITORIAL_POLICY_CHANGED' AS code FROM customer WHERE c_custkey % 5 = 1 UNION ALL SELECT c_custkey, 'EDITORIAL_REVIEW_INCOMPLETE' FROM customer WHERE c_custkey % 5 IN (1, 2, 3)
""")
def qa_policy_issues(spark, sf_dir):
    """Jobs under another policy, or without a complete review."""
    k = F.col("c_custkey")
    old, now = F.lit("0" * 64), F.lit("1" * 64)
    jobs = table(spark, sf_dir, "customer").select(k.alias("job_id"), F.when(every(k, 5, 1), old).when(k % 5 > 1, now).alias("prepared_sha256"), F.when(every(k, 5, 2), old).when(every(k, 5, 4), now).alias("reviewed_sha256"))
    return qa.policy_issues(jobs, "1" * 64).select("job_id", "code")


@query("""
SELECT l_orderkey * 10 + l_linenumber AS ord, '[' || CASE WHEN l_linenumber % 2 = 0 THEN 'ERROR' ELSE 'WARNING' END || '] C' || l_linenumber || ' (row ' || l_orderkey || CASE WHEN l_linenumber % 3 = 0 THEN '' ELSE ', column 4' END || ', id ' || l_partkey || '): m' AS line
FROM (SELECT l_orderkey, l_linenumber, max(l_partkey) AS l_partkey FROM lineitem GROUP BY ALL) ORDER BY ord LIMIT 250
""")
def qa_report(spark, sf_dir):
    """The first 250 lines of a text report: the limit is the feature."""
    l = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_partkey").alias("l_partkey"))
    n = F.col("l_linenumber")
    issues = l.select((F.col("l_orderkey") * 10 + n).alias("ord"), F.col("l_orderkey").alias("row_no"), F.when(~every(n, 3), 4).alias("column_no"), F.col("l_partkey").cast("string").alias("content_id"), F.when(every(n, 2), "error").otherwise("warning").alias("severity"), cat("C", n).alias("code"), F.lit("m").alias("message"))
    return qa.report_lines(issues)


# --- spreadsheets and files -------------------------------------------------


def _cells(spark, sf_dir, value) -> DataFrame:
    """Cells of one workbook per nation, a row per customer after a header."""
    c = table(spark, sf_dir, "customer")
    from pyspark.sql import Window as W

    row = (F.row_number().over(W.partitionBy("c_nationkey").orderBy("c_custkey")) + 1).cast("int")
    numbered = c.withColumn("row", row)
    cells = F.posexplode(F.array(*value))
    body = numbered.select(cat("n", F.col("c_nationkey")).alias("path"), "row", cells.alias("i", "value"), "c_nationkey", "c_custkey")
    return body.select("path", F.lit("S").alias("sheet"), "row", (F.col("i") + 1).alias("column"), F.lit("text").alias("kind"), "value", F.lit(None).cast("string").alias("error"), "c_nationkey", "c_custkey")


_CONTENT_CELLS = """WITH c AS (SELECT 'n' || c_nationkey AS path, c_nationkey AS n, c_custkey AS k, c_name, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS row_no FROM customer)
"""


def _content_cells(spark, sf_dir):
    from .schemas import CONTENT_HEADERS

    k = F.col("c_custkey")
    body = _cells(spark, sf_dir, [F.when(every(k, 5), cat("p", k)).otherwise(""), F.lit(""), k.cast("string"), cat(F.col("c_name"), "\r\nx")])
    names = body.select("path", "c_nationkey").distinct()
    head = names.select("path", "c_nationkey", F.posexplode(F.array(*map(F.lit, CONTENT_HEADERS))).alias("i", "value"))
    changed = F.when(every(F.col("c_nationkey"), 4) & (F.col("i") == 1), "other").otherwise(F.col("value"))
    head = head.select("path", F.lit("S").alias("sheet"), F.lit(1).alias("row"), (F.col("i") + 1).alias("column"), F.lit("text").alias("kind"), changed.alias("value"), F.lit(None).cast("string").alias("error"))
    odd = every(F.col("c_custkey"), 50) & (F.col("column") == 4)
    rest = body.withColumn("kind", F.when(odd, "formula").otherwise("text")).select(*head.columns)
    far = body.where("c_custkey % 97 = 3 and column = 1").withColumn("column", F.lit(6)).withColumn("value", F.lit("far")).select(*head.columns)
    return head.unionByName(rest).unionByName(far)


@query(_CONTENT_CELLS + "SELECT path, row_no, CASE WHEN k % 5 = 0 THEN 'p' || k ELSE '' END AS psr_id, '' AS psr_content, k::VARCHAR AS content_tag, c_name || chr(10) || 'x' AS content FROM c")
def workbook_content(spark, sf_dir):
    """Content rows of workbooks, cells normalised."""
    from .sources import workbooks

    return workbooks.content_table(_content_cells(spark, sf_dir))


@query(_CONTENT_CELLS + """
SELECT path, 'no literal text in row ' || (row_no + 1) || ' column 4' AS fault FROM c WHERE k % 50 = 0
UNION ALL SELECT DISTINCT path, 'other headers' FROM c WHERE n % 4 = 0
UNION ALL SELECT path, 'content beyond the columns in row ' || min(row_no + 1) FROM c WHERE k % 97 = 3 GROUP BY path
""")
def workbook_contract(spark, sf_dir):
    """Faults of content workbooks."""
    from .sources import workbooks

    return workbooks.workbook_faults(_content_cells(spark, sf_dir))


@query("SELECT DISTINCT 'n' || c_nationkey AS path, 2 AS column_no, 'HEADER_CHANGED' AS code FROM customer WHERE c_nationkey % 4 = 0")
def workbook_headers(spark, sf_dir):
    """Header cells that are not the contract's, as issues."""
    from .sources import workbooks

    return workbooks.header_issues(_content_cells(spark, sf_dir)).select("path", "column_no", "code")


@query("SELECT DISTINCT 'n' || c_nationkey AS path, 'WORKBOOK_EMPTY' AS code FROM customer")
def workbook_empty(spark, sf_dir):
    """Workbooks without a data row, as issues."""
    from .sources import workbooks

    return workbooks.header_issues(_content_cells(spark, sf_dir).where("row = 1")).select("path", "code")


_TERM_CELLS = """WITH c AS (SELECT 'n' || c_nationkey AS path, c_custkey AS k, CASE WHEN c_custkey % 40 = 0 THEN '' WHEN c_custkey % 41 = 0 THEN 'same' ELSE c_name END AS s, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) + 1 AS row FROM customer)
"""


def _term_sheet(spark, sf_dir):
    from .sources import workbooks

    k = F.col("c_custkey")
    body = _cells(spark, sf_dir, [F.when(every(k, 40), "").when(every(k, 41), "same").otherwise(F.col("c_name")), F.when(every(k, 30), "x ").otherwise(cat("f", k))])
    head = body.select("path").distinct().select("path", F.posexplode(F.array(F.lit("English"), F.lit("French"))).alias("i", "value"))
    head = head.select("path", F.lit("S").alias("sheet"), F.lit(1).alias("row"), (F.col("i") + 1).alias("column"), F.lit("text").alias("kind"), "value", F.lit(None).cast("string").alias("error"))
    return workbooks.glossary_sheet(head.unionByName(body.select(*head.columns)), "words")


@query(_TERM_CELLS + "SELECT s AS source, 'French' AS field, CASE WHEN k % 30 = 0 THEN 'x ' ELSE 'f' || k END AS value, row AS ord FROM c")
def workbook_glossary(spark, sf_dir):
    """Exploded glossaries of spreadsheets."""
    return _term_sheet(spark, sf_dir)[0].drop("kind")


@query(_TERM_CELLS + """
SELECT path, row::INT AS row, 'blank source' AS fault FROM c WHERE s = '' UNION ALL SELECT path, max(row)::INT, 'repeated source' FROM c WHERE s <> '' GROUP BY path, s HAVING count(*) > 1
UNION ALL SELECT path, row::INT, 'untrimmed cell' FROM c WHERE k % 30 = 0
""")
def workbook_glossary_faults(spark, sf_dir):
    """Faults of glossary spreadsheets."""
    return _term_sheet(spark, sf_dir)[1]


@query("""
SELECT p_partkey AS row, CASE WHEN p_partkey > 1000 THEN 'words' ELSE 'acronyms' END AS kind, p_name AS english, 'd' || p_partkey AS english_definition, 'f' || p_partkey AS term, 'g' AS definition FROM part WHERE p_partkey <> 1000
""")
def published_rows(spark, sf_dir):
    """Published rows of a sheet whose words follow a heading."""
    from .sources import workbooks

    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    cells = F.when(k == 1000, F.array(F.lit("Words"), F.lit(""), F.lit(""), F.lit(""))).otherwise(F.array(F.col("p_name"), cat("d", k), cat(" f", k), F.lit("g")))
    out = workbooks.published_sheet(p.select(k.alias("row_no"), cells.alias("cells")), "b", ["French"], 2, "Words")
    t = F.col("translations")["French"]
    return out.select(F.col("row").cast("long").alias("row"), "kind", "english", "english_definition", t["term"].alias("term"), t["definition"].alias("definition"))


@query("""
SELECT p_name AS source, 't' || p_partkey AS target, p_partkey AS ord FROM part UNION ALL SELECT p_type, 'u', p_partkey FROM part WHERE p_partkey % 2 = 0
""")
def symbol_pairs(spark, sf_dir):
    """Pairs of a table with paired columns, blank ones left out."""
    from .sources import workbooks

    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    rows = p.select(k.alias("row_no"), "p_name", cat("t", k, " ").alias("t"), "p_type", F.when(every(k, 2), "u").otherwise(" ").alias("u"))
    return workbooks.symbol_table(rows, [("p_name", "t"), ("p_type", "u")])


@query("""
WITH p AS (SELECT p_partkey AS k, p_name FROM part), l AS (SELECT k, p_name, last_value(CASE WHEN k % 3 = 0 THEN 'T' || k END IGNORE NULLS) OVER (ORDER BY k ROWS UNBOUNDED PRECEDING) AS trim_size FROM p)
SELECT trim_size, p_name AS paragraph_style, 'English' AS language, (8 + k % 5)::DOUBLE AS size, 12.5::DOUBLE AS leading, 'E' || k AS source_cell FROM l UNION ALL SELECT trim_size, p_name, 'French', 9::DOUBLE, 11::DOUBLE, 'F' || k FROM l WHERE k % 2 = 0
""")
def size_matrix(spark, sf_dir):
    """Sizes of a matrix in long form, levels filled down."""
    from .sources import workbooks

    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    rows = p.select(k.alias("row_no"), F.when(every(k, 3), cat("T", k)).otherwise("").alias("trim_size"), F.lit("B").alias("style_tree1"), F.lit("x").alias("style_tree2"), F.col("p_name").alias("paragraph_style"), F.array(cat(k % 5 + 8, " pt / 12.5 pt"), F.when(every(k, 2), "9 pt/11").otherwise("")).alias("sizes"))
    return workbooks.typography_matrix(rows, ["English", "French"], ["Default", "B1"]).select("trim_size", "paragraph_style", "language", "size", "leading", "source_cell")


def _bound(rows: DataFrame, size: int, key: str, *cells: Column) -> DataFrame:
    """(book, rows): ``size`` keys a book, their cells in order."""
    each = rows.select(F.expr(f"{key} div {size}").alias("book"), F.col(key).alias("k"), F.array(*cells).alias("c"))
    return each.groupBy("book").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "c"))), lambda x: x["c"]).alias("rows"))


@query("""
SELECT c_custkey // 200 AS book, c_custkey % 200 + 1 AS row_no, CASE WHEN c_custkey % 5 = 0 THEN 'p' || c_custkey ELSE '' END AS psr_id, ' ' || c_name || chr(10) || 'é <&> ' AS content FROM customer
""")
def workbook_round_trip(spark, sf_dir):
    """Content workbooks of two hundred rows written as files and read back."""
    from .schemas import CONTENT_HEADERS
    from .sources import files, workbooks

    k = F.col("c_custkey")
    books = _bound(table(spark, sf_dir, "customer"), 200, "c_custkey", F.when(every(k, 5), cat("p", k)).otherwise(""), F.lit(""), k.cast("string"), cat(" ", F.col("c_name"), "\r\né <&> "))
    folder = files.shared_folder(spark, "books")
    head = F.array(F.array(*map(F.lit, CONTENT_HEADERS)))
    workbooks.write_workbooks(books.select(cat("book_", F.col("book"), ".xlsx").alias("name"), F.concat(head, "rows").alias("rows")), folder)
    found = workbooks.cells(spark, folder)
    rows = workbooks.content_table(found.join(workbooks.workbook_faults(found).select("path").distinct(), "path", "left_anti"))
    return rows.select(F.regexp_extract("path", "book_([0-9]+)", 1).cast("long").alias("book"), "row_no", "psr_id", "content")


_BOOKS = """WITH b AS (SELECT doc_id // 50 AS book, string_agg(coalesce(text, ''), chr(10) ORDER BY doc_id) AS body FROM documents GROUP BY 1)
"""


def _document_files(spark, sf_dir):
    """Files of fifty documents each, written by the tasks; their folder."""
    from .sources import files

    d = table(spark, sf_dir, "documents").withColumn("text", F.coalesce("text", F.lit("")))
    books = _bound(d, 50, "doc_id", F.col("text"))
    folder = files.shared_folder(spark, "stories")
    body = F.array_join(F.transform("rows", lambda r: r[0]), "\n")
    files.write_files(books.select(cat("part/Page_", F.col("book"), ".icml").alias("name"), F.encode(F.concat(F.lit("\ufeff"), body), "UTF-8").alias("content")), folder)
    return folder


@query(_BOOKS + """
SELECT row_number() OVER (ORDER BY book) - 1 AS file_no, 'Page_' || book || '.icml' AS file_name, sha256(body) AS digest FROM b
""")
def story_files(spark, sf_dir):
    """Story files in the order of their pages, byte-order marks dropped."""
    from .sources import files

    found = files.stories(spark, _document_files(spark, sf_dir))
    return found.select(F.col("file_no").cast("long").alias("file_no"), "file_name", F.sha2("xml", 256).alias("digest"))


@query(_BOOKS + """
SELECT 'Page_' || book || '.icml' AS file_name, octet_length(encode(body))::BIGINT + 3 AS bytes, sha256(encode(chr(65279) || body)) AS sha256 FROM b WHERE book % 10 < 8 AND book % 10 <> 1
""")
def hashed_inventory(spark, sf_dir):
    """Hashes and sizes of files, some left out by name."""
    from .sources import files

    found = files.hashed_files(spark, _document_files(spark, sf_dir), pattern=r"/part/Page_[0-9]*[0-7]\.", without=r"Page_[0-9]*[1]\.")
    return found.select(F.regexp_extract("path", r"([^/]+)\z", 1).alias("file_name"), "bytes", "sha256")


@query("""
SELECT doc_id // 50 AS book, 'd/' || doc_id || '.txt' AS member, sha256(coalesce(text, '')) AS digest, false AS refused FROM documents WHERE doc_id // 50 % 4 <> 1
UNION ALL SELECT DISTINCT doc_id // 50, NULL, NULL, true FROM documents WHERE doc_id // 50 % 4 = 1
""")
def archive_members(spark, sf_dir):
    """Members of archives; an archive that a member leaves is refused."""
    from .sources import files

    d = table(spark, sf_dir, "documents")
    books = _bound(d, 50, "doc_id", F.col("doc_id").cast("string"), F.coalesce("text", F.lit("")))

    @F.pandas_udf("binary")
    def packed(numbers: pd.Series, rows: pd.Series) -> pd.Series:
        out = []
        for n, book in zip(numbers, rows):
            held = io.BytesIO()
            with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
                for ident, body in book:
                    z.writestr(f"{'../' if n % 4 == 1 else ''}d/{ident}.txt", body)
            out.append(held.getvalue())
        return pd.Series(out, dtype=object)

    folder = files.shared_folder(spark, "archives")
    files.write_files(books.select(cat("b_", F.col("book"), ".zip").alias("name"), packed.asNondeterministic()("book", "rows").alias("content")), folder)
    found = files.archive_members(spark, folder)
    return found.select(F.regexp_extract("path", "b_([0-9]+)", 1).cast("long").alias("book"), "member", F.sha2("content", 256).alias("digest"), F.col("error").isNotNull().alias("refused"))


@query("""
SELECT c_name AS source, f AS field, CASE f WHEN 'French' THEN 'f' || c_custkey ELSE 'about "' || c_mktsegment || '"' END AS value FROM customer, (VALUES ('French'), ('English Definition')) v(f)
""")
def json_glossary(spark, sf_dir):
    """Glossaries read from files of JSON objects."""
    from .sources import files

    c = table(spark, sf_dir, "customer")
    fields = F.create_map(F.lit("French"), cat("f", F.col("c_custkey")), F.lit("English Definition"), cat('about "', F.col("c_mktsegment"), '"'))
    each = c.select(F.expr("c_custkey div 500").alias("book"), F.struct(F.col("c_name").alias("key"), fields.alias("value")).alias("e"))
    books = each.groupBy("book").agg(F.to_json(F.map_from_entries(F.collect_list("e"))).alias("json"))
    folder = files.shared_folder(spark, "glossaries")
    files.write_files(books.select(cat(F.col("book"), ".json").alias("name"), F.encode(F.concat(F.lit("\ufeff"), "json"), "UTF-8").alias("content")), folder)
    return files.glossary_json(spark, folder, "words").select("source", "field", "value")


# --- small contracts --------------------------------------------------------


@query("""
SELECT c_mktsegment AS file, c_custkey AS pos, '{"id":"' || c_name || '","kind":"prose","plain":"say \\"' || c_custkey || '\\""' || CASE WHEN c_custkey % 4 = 0 THEN ',"translations":{"German":"de ' || c_custkey || '"}' ELSE '' END || '}' AS line FROM customer
""")
def ledger_json_lines(spark, sf_dir):
    """Units as JSON lines in order."""
    k = F.col("c_custkey")
    done = F.when(every(k, 4), F.create_map(F.lit("German"), cat("de ", k)))
    units = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("file"), k.alias("pos"), F.col("c_name").alias("id"), F.lit("prose").alias("kind"), cat('say "', k, '"').alias("plain"), done.alias("translations"))
    return ledger.ledger_lines(units)


@query("""
SELECT DISTINCT p_brand AS source, 'T' || p_size % 3 AS target, min(p_partkey) AS ord FROM part WHERE p_brand <> 'Brand#7' GROUP BY ALL
""")
def glossary_distinct_pairs(spark, sf_dir):
    """Entries without the excluded sources, each pair once."""
    p = table(spark, sf_dir, "part").select(F.col("p_brand").alias("source"), cat("T", F.col("p_size") % 3).alias("target"), F.col("p_partkey").alias("ord"))
    return glossary.distinct_pairs(glossary.without(p, spark.createDataFrame([("BRAND#7",)], "term string")))


@query("SELECT true AS same, false AS other")
def set_equality(spark, sf_dir):
    """A table against a copy in another order, and against one with a change."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    changed = c.withColumn("c_name", F.when(F.col("c_custkey") == 3, "x").otherwise(F.col("c_name")))
    return spark.createDataFrame([(relational.same_set(c, c.orderBy(F.desc("c_name"))), relational.same_set(c, changed))], "same boolean, other boolean")


@query("SELECT DISTINCT c_mktsegment AS name FROM customer WHERE c_mktsegment = 'BUILDING'")
def named_entry(spark, sf_dir):
    """The one entry of a name, in any case."""
    names = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("name")).distinct()
    return relational.exactly_one(names, F.lit("Building"))


@query("""
SELECT c_custkey, 'é' AS repaired, c_name || 'x' AS name, 'a' || chr(10) || c_custkey AS first, 'v' AS value FROM customer
""")
def request_values(spark, sf_dir):
    """Every text in a nested value as it may leave the system."""
    c = table(spark, sf_dir, "customer")
    nested = F.struct(F.lit("Ã©").alias("a"), F.array(cat("a\r\n", F.col("c_custkey"))).alias("b"), F.create_map(F.lit("k"), F.lit("v\x01")).alias("c"), F.struct(cat(F.col("c_name"), "\x02x").alias("d"), F.lit(1).alias("e")).alias("f"))
    rows = c.select("c_custkey", nested.alias("n"))
    out = rows.select("c_custkey", validation.request_values(F.col("n"), rows.schema["n"].dataType, repair=True).alias("n"))
    return out.select("c_custkey", F.col("n.a").alias("repaired"), F.col("n.f.d").alias("name"), F.col("n.b")[0].alias("first"), F.col("n.c")["k"].alias("value"))


@query("""
SELECT c_custkey, replace(c_name, '#', '_') || '.' || substr(sha1('a/b/' || c_name || '.ai'), 1, 12) AS stem, 'x_' || c_custkey AS part, c_custkey % 2 = 0 AS invalid FROM customer
""")
def safe_names(spark, sf_dir):
    """Stems of work files, path components, and texts that XML forbids."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select("c_custkey", tx.file_stem(cat("a/b/", F.col("c_name"), ".ai")).alias("stem"), tx.path_part(cat(" x é ", k, "?")).alias("part"), markup.invalid_xml(F.when(every(k, 2), "a\x0bb").otherwise("ab")).alias("invalid"))


@query("""
SELECT c_custkey AS batch_no FROM customer WHERE c_custkey % 3 <> 0 ORDER BY 1 LIMIT 25
""")
def next_batches(spark, sf_dir):
    """The next twenty-five batches without a result: the limit is the
    feature."""
    b = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("batch_no"), cat("b", F.col("c_custkey")).alias("batch_id"))
    return packing.remaining(b, b.where("batch_no % 3 = 0").select("batch_id"), limit=25).select("batch_no")


@query("""
WITH v(language, code, "decimal") AS (VALUES ('English', 'en', '.'), ('French', 'fr', ','), ('German', 'de', ','), ('Spanish', 'es', ','), ('Portuguese', 'pt', ','), ('Dutch', 'nl', ','), ('Italian', 'it', ','), ('Turkish', 'tr', ','), ('Polish', 'pl', ','), ('Swedish', 'sv', ','))
SELECT language, code, "decimal", count(doc_id) AS n_documents, coalesce(sum(n_chars), 0)::BIGINT AS n_chars FROM v LEFT JOIN documents ON lang = code GROUP BY ALL
""")
def locale_settings(spark, sf_dir):
    """Languages that have typography, and the documents each applies to."""
    d = table(spark, sf_dir, "documents").groupBy(F.col("lang").alias("code")).agg(F.count("*").alias("n_documents"), F.sum("n_chars").alias("n_chars"))
    locales = typography.locale_table(spark).select("language", "code", "decimal")
    return locales.join(d, "code", "left").na.fill(0, ["n_documents", "n_chars"]).select("language", "code", "decimal", "n_documents", "n_chars")
