"""Registered queries of the engine, each with its DuckDB SQL.

Natural texts of the test tables hardly trigger localization rules, so the
queries derive segments from columns of whole tables. Each query runs the
library's operator; the SQL states the result independently.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import hashing, markup, typography
from .functions import text as tx
from .functions.text import NBSP
from .operators import audit, glossary, ledger, locks, packing, qa, relational, segments, structure, validation

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def put(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores. A small table is one row group, hence one task;
    where there are fewer splits than cores its rows are dealt out before
    costly text work. Larger tables have splits enough and stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def _named(spark, sf_dir) -> DataFrame:
    """Customers as numbered names in parts."""
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("part"))


def whole(c: str):
    """A double column as a whole number."""
    return F.col(c).cast("int")


# --- typography -------------------------------------------------------------


@query("""
WITH t AS (SELECT l_linenumber, l_quantity::INT || ' kg of ' || l_partkey || ' at ' || l_linenumber || ' % off' AS s FROM lineitem),
n AS (SELECT l_linenumber, s, replace(replace(s, ' kg', chr(160) || 'kg'), ' %', '%') AS r FROM t)
SELECT l_linenumber, count(*) AS n, count(*) FILTER (r <> s) AS changed, sum(length(r))::BIGINT AS chars FROM n GROUP BY 1
""")
def typography_unit_nbsp(spark, sf_dir):
    """English units and percentages of every order line."""
    t = spread(table(spark, sf_dir, "lineitem")).select("l_linenumber", F.concat(whole("l_quantity"), F.lit(" kg of "), "l_partkey", F.lit(" at "), "l_linenumber", F.lit(" % off")).alias("s"))
    n = t.withColumn("r", typography.normalise(F.col("s"), "English"))
    return n.groupBy("l_linenumber").agg(F.count("*").alias("n"), F.count_if(F.col("r") != F.col("s")).alias("changed"), F.sum(F.length("r").cast("long")).alias("chars"))


@query("""
SELECT o_orderkey, 'sent ' || day(o_orderdate) || chr(160) || ['Jan', 'Feb', 'Mär', 'Apr', 'Mai', 'Jun', 'Jul', 'Aug', 'Sep', 'Okt', 'Nov', 'Dez'][month(o_orderdate)] || chr(160) || year(o_orderdate) || '.' AS german,
  day(o_orderdate) || chr(160) || 'de' || chr(160) || ['enero', 'febrero', 'marzo', 'abril', 'mayo', 'junio', 'julio', 'agosto', 'septiembre', 'octubre', 'noviembre', 'diciembre'][month(o_orderdate)] || chr(160) || 'de' || chr(160) || year(o_orderdate) AS spanish,
  CASE WHEN day(o_orderdate) = 1 THEN '1er' ELSE day(o_orderdate)::VARCHAR END || chr(160) || ['janvier', 'février', 'mars', 'avril', 'mai', 'juin', 'juillet', 'août', 'septembre', 'octobre', 'novembre', 'décembre'][month(o_orderdate)] || chr(160) || year(o_orderdate) AS french
FROM orders
""")
def typography_dates_by_locale(spark, sf_dir):
    """Order dates in full month names, set by the rules of three languages."""
    o = spread(table(spark, sf_dir, "orders")).select("o_orderkey", F.dayofmonth("o_orderdate").alias("d"), F.month("o_orderdate").alias("m"), F.year("o_orderdate").alias("y"))

    def spelled(language, form):
        names = [forms[min(form, len(forms) - 1)].replace("\\.?", "") for forms in typography.MONTHS[language]]
        return F.get(F.array(*map(F.lit, names)), F.col("m") - 1)

    german = F.concat(F.lit("sent "), "d", F.lit(" "), spelled("German", 1), F.lit(" "), "y", F.lit("."))
    spanish = F.concat("d", F.lit(" "), spelled("Spanish", 1), F.lit(" de "), "y")
    french = F.concat("d", F.lit(" "), spelled("French", 0), F.lit(" "), "y")
    return o.select("o_orderkey", typography.normalise(german, "German").alias("german"), typography.normalise(spanish, "Spanish").alias("spanish"), typography.normalise(french, "French").alias("french"))


@query("""
WITH loc(i, language, gap) AS (VALUES (0, 'English', ''), (1, 'French', chr(8239)), (2, 'German', chr(160)), (3, 'Spanish', chr(160)), (4, 'Portuguese', chr(160)),
  (5, 'Dutch', ''), (6, 'Italian', chr(160)), (7, 'Turkish', NULL), (8, 'Polish', ''), (9, 'Swedish', chr(160))),
t AS (SELECT language, gap, round(l_discount * 100)::INT || ' %' AS s, round(l_tax * 100)::INT || '%' AS u FROM lineitem JOIN loc ON l_orderkey % 10 = i),
r AS (SELECT language, s || '/' || u AS a, CASE WHEN gap IS NULL THEN s || '/' || u ELSE replace(replace(s, ' %', gap || '%') || '/' || replace(u, '%', gap || '%'), gap || gap, gap) END AS b FROM t)
SELECT language, count(*) AS n, count(*) FILTER (a <> b) AS changed, min(b) AS least, max(b) AS most FROM r GROUP BY 1
""")
def typography_percent_by_locale(spark, sf_dir):
    """Discounts and taxes as percentages in all ten languages."""
    names = F.array(*map(F.lit, typography.LOCALES))
    l = spread(table(spark, sf_dir, "lineitem")).select(F.get(names, (F.col("l_orderkey") % 10).cast("int")).alias("language"), F.concat(F.round(F.col("l_discount") * 100).cast("int"), F.lit(" %/"), F.round(F.col("l_tax") * 100).cast("int"), F.lit("%")).alias("a"))
    r = l.withColumn("b", typography.normalise_by(F.col("a"), F.col("language")))
    return r.groupBy("language").agg(F.count("*").alias("n"), F.count_if(F.col("a") != F.col("b")).alias("changed"), F.min("b").alias("least"), F.max("b").alias("most"))


@query("""
SELECT c_custkey, c_name || chr(8239) || ': «' || chr(8239) || c_mktsegment || chr(8239) || '»' || chr(8239) || '; oui —' || chr(8239) || 'non' || chr(8239) || '?' AS set FROM customer
""")
def typography_french_punct(spark, sf_dir):
    """French punctuation of a phrase about every customer."""
    c = spread(table(spark, sf_dir, "customer"))
    s = F.concat("c_name", F.lit(" : « "), "c_mktsegment", F.lit("» ; oui — non ?"))
    return c.select("c_custkey", typography.normalise(s, "French").alias("set"))


@query("""
SELECT l_orderkey, l_linenumber, l_quantity::INT || chr(160) || '+' || chr(160) || l_linenumber || chr(160) || '=' || chr(160) || (l_quantity::INT + l_linenumber) AS sum FROM lineitem
""")
def typography_math(spark, sf_dir):
    """Operators between numbers, on every order line."""
    l = spread(table(spark, sf_dir, "lineitem"))
    s = F.concat(whole("l_quantity"), F.lit(" + "), "l_linenumber", F.lit(" = "), whole("l_quantity") + F.col("l_linenumber"))
    return l.select("l_orderkey", "l_linenumber", typography.normalise(s, "German").alias("sum"))


@query("""
WITH r(place, language, rule) AS (VALUES (1, 'French', 'fr_punctuation'), (2, 'French', 'fr_em_dash'), (3, 'French', 'fr_open_quote'), (4, 'French', 'fr_close_quote'), (5, 'All', 'unit_nbsp'), (6, 'All', 'math_before'), (7, 'All', 'math_after'),
  (8, 'English', 'date_english'), (9, 'French', 'date_french'), (10, 'German', 'date_german'), (11, 'Spanish', 'date_spanish'), (12, 'Portuguese', 'date_portuguese'), (13, 'Dutch', 'date_dutch'), (14, 'Italian', 'date_italian'), (15, 'Turkish', 'date_turkish'), (16, 'Polish', 'date_polish'), (17, 'Swedish', 'date_swedish')),
n AS (SELECT count(*) AS n, count(*) FILTER (l_linenumber % 2 = 0) AS even FROM lineitem)
SELECT place, language, rule, language IN ('All', 'English') AS applies,
  CASE WHEN rule = 'unit_nbsp' THEN n WHEN rule IN ('math_before', 'math_after') THEN even ELSE 0 END AS matches, CASE WHEN rule = 'unit_nbsp' THEN n WHEN rule IN ('math_before', 'math_after') THEN even ELSE 0 END AS changes FROM r, n
""")
def grep_rule_report(spark, sf_dir):
    """The matrix run over every order line: matches and changes of each rule,
    also of those without any. Every second line has one space that is set
    already."""
    after = F.when(F.col("l_linenumber") % 2 == 0, F.lit(" ")).otherwise(F.lit(NBSP))
    l = spread(table(spark, sf_dir, "lineitem")).select(F.concat(whole("l_quantity"), F.lit(" km "), "l_linenumber", F.lit(" +"), after, "l_linenumber").alias("s"))
    ran = l.select(F.explode(typography.matrix_run(F.col("s"), "English")["counts"]).alias("x")).select("x.*")
    rules = typography.rules_for(typography.rule_table(spark), "English")
    return audit.rule_totals(rules, ran).select("place", "language", "rule", "applies", "matches", "changes")


@query("""
SELECT 'German' AS language, count(*) AS n, 0::BIGINT AS untidy FROM lineitem
""")
def typography_idempotence(spark, sf_dir):
    """Texts that a second run would still change: none."""
    l = spread(table(spark, sf_dir, "lineitem"))
    s = F.concat(whole("l_quantity"), F.lit(" kg + "), "l_linenumber", F.lit(" % = 3 Mai 2010"))
    once = l.select(typography.normalise(s, "German").alias("t"))
    return once.agg(F.count("*").alias("n"), F.count_if(typography.is_untidy(F.col("t"), "German")).alias("untidy")).select(F.lit("German").alias("language"), "n", "untidy")


# --- segments ---------------------------------------------------------------


@query("""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS content, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents)
SELECT doc_id, pos::BIGINT AS pos, printf('%05d', row_number() OVER (ORDER BY doc_id, pos) - 1 + 1) AS global_id, length(content)::BIGINT AS chars FROM l
""")
def segment_index(spark, sf_dir):
    """Ids of all lines of all documents, from per-document counts."""
    d = table(spark, sf_dir, "documents")
    lines = d.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "content"))
    return segments.global_ids(lines, "doc_id", "pos").select("doc_id", F.col("pos").cast("long").alias("pos"), "global_id", F.length("content").cast("long").alias("chars"))


def _turns(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    head = F.when(F.col("role") == "user", F.concat(F.lit("p"), "turn")).otherwise("")
    return c.select("conv_id", F.col("turn").alias("row_no"), head.alias("psr_id"), F.lit("").alias("psr_content"), F.concat("conv_id", F.lit("-"), "turn").alias("content_tag"), F.coalesce("text", F.lit("")).alias("content"))


_TURNS = """WITH t AS (SELECT conv_id, turn AS row_no, role, coalesce(text, '') AS content, sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS g FROM conversations)"""


@query(_TURNS + """
SELECT conv_id, g::BIGINT AS group_no, printf('group_%06d', g) AS group_id, min(row_no) AS start_row, count(*) AS n_rows, count(*) FILTER (content <> '') AS n_segments, sha256(string_agg(content, '' ORDER BY row_no)) AS digest FROM t WHERE g > 0 GROUP BY conv_id, g
""")
def content_groups(spark, sf_dir):
    """Groups of turns, each begun by a user's turn."""
    g = segments.content_groups(_turns(spark, sf_dir), ["conv_id"])
    return g.select("conv_id", "group_no", "group_id", "start_row", F.size("rows").cast("long").alias("n_rows"), F.size("segments").cast("long").alias("n_segments"), F.sha2(F.array_join("segments", ""), 256).alias("digest"))


@query(_TURNS + """
SELECT conv_id, row_no FROM t WHERE content <> '' OR role = 'user' QUALIFY count(*) FILTER (role <> 'user') OVER (PARTITION BY conv_id ORDER BY row_no) = 0
""")
def orphan_rows(spark, sf_dir):
    """Turns before the first answer."""
    t = _turns(spark, sf_dir)
    return segments.orphan_rows(t, ["conv_id"], F.col("psr_id") == "").select("conv_id", "row_no")


@query("""
SELECT (doc_id % 90)::VARCHAR AS content_id, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1
""")
def content_id_dups(spark, sf_dir):
    """Padded ids that are the same content id."""
    d = table(spark, sf_dir, "documents").select(F.concat(F.lit(" "), F.repeat(F.lit("0"), (F.col("doc_id") % 4).cast("int")), F.col("doc_id") % 90).alias("content_tag"))
    return relational.by_content_id(d).groupBy("content_id").agg(F.count("*").alias("n")).where("n > 1")


@query("""
WITH e AS (SELECT user_id, event_id, event_type, CASE WHEN lag(event_type) OVER w IS NOT DISTINCT FROM event_type AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS s FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
r AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY event_id) AS run_no FROM (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS event_id, event_type, CASE WHEN lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NOT DISTINCT FROM event_type AND row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) > 1 THEN 0 ELSE 1 END AS s FROM events))
SELECT user_id, run_no::BIGINT AS run_no, event_type, min(event_id) AS first, max(event_id) AS last, count(*) AS n FROM r GROUP BY ALL
""")
def style_runs(spark, sf_dir):
    """Runs of equal events of each user: gaps and islands."""
    from pyspark.sql import Window as W

    e = table(spark, sf_dir, "events").withColumn("pos", F.row_number().over(W.partitionBy("user_id").orderBy("ts", "event_id")).cast("long"))
    return segments.style_runs(e, "event_type", "event_type", ["user_id"], "pos").drop("text")


@query("""
WITH p AS (SELECT p_partkey AS row_no, p_brand, CASE WHEN p_partkey % 3 = 1 THEN p_type ELSE '' END AS level FROM part)
SELECT row_no, coalesce(last_value(nullif(level, '') IGNORE NULLS) OVER (PARTITION BY p_brand ORDER BY row_no ROWS UNBOUNDED PRECEDING), '') AS level, (10 + row_no % 5)::DOUBLE AS size, (12.5 + row_no % 3)::DOUBLE AS leading, '14.0,15.5' AS alternatives FROM p
""")
def fill_down_matrix(spark, sf_dir):
    """Filled-down levels and parsed sizes of a part listing."""
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("row_no"), "p_brand", F.when(F.col("p_partkey") % 3 == 1, F.col("p_type")).otherwise("").alias("level"))
    f = segments.fill_down(p, ["level"], ["p_brand"])
    raw = F.concat(10 + F.col("row_no") % 5, F.lit(" pt / "), (12.5 + F.col("row_no") % 3).cast("string"), F.lit(" pt or 14 pt, 15.5 pt"))
    pair = tx.size_pair(raw)
    return f.select("row_no", "level", pair["size"].alias("size"), pair["leading"].alias("leading"), F.array_join(pair["alternatives"].cast("array<string>"), ",").alias("alternatives"))


@query("""
WITH l AS (SELECT part, k AS row_no, name FROM (SELECT c_custkey AS k, c_name AS name, c_nationkey AS part FROM customer) named),
h AS (SELECT part, row_no, name, max(CASE WHEN row_no % 3 = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY part ORDER BY row_no) = 1 AS in_section FROM l)
SELECT part, row_no, name, in_section FROM h
""")
def section_mode(spark, sf_dir):
    """Customers of a nation listed after its first heading row."""
    n = _named(spark, sf_dir).select("part", F.col("k").alias("row_no"), "name")
    return segments.section_of(n, F.col("row_no") % 3 == 0, ["part"])


@query(_TURNS + """
, c AS (SELECT conv_id, g, min(row_no) AS row_no, string_agg(content, '' ORDER BY row_no) AS composite FROM t WHERE g > 0 GROUP BY ALL)
SELECT conv_id, row_no, 'COMPOSITE_MISMATCH' AS code FROM c WHERE conv_id % 4 = 0 AND composite <> ''
""")
def composite_mismatch(spark, sf_dir):
    """Group heads whose stated composite was emptied in every fourth table."""
    t = _turns(spark, sf_dir)
    out = segments.rebuild_composites(t, t, ["conv_id"]).withColumn("psr_content", F.when(F.col("conv_id") % 4 == 0, "").otherwise(F.col("psr_content")))
    return qa.composite_issues(t, out, ["conv_id"]).select("conv_id", "row_no", "code")


# --- scalars ----------------------------------------------------------------


@query("""
WITH p AS (SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN ' #ref! ' WHEN 1 THEN '#N/A' WHEN 2 THEN '#NAME' WHEN 3 THEN '12.5' WHEN 4 THEN ' ' ELSE p_name END AS c FROM part)
SELECT p_partkey, upper(trim(c)) IN ('#REF!', '#N/A') AS is_error, p_partkey % 6 IN (3, 4) AS skip FROM p
""")
def excel_error_literals(spark, sf_dir):
    """Error literals and texts without anything to translate."""
    k = F.col("p_partkey") % 6
    c = F.when(k == 0, " #ref! ").when(k == 1, "#N/A").when(k == 2, "#NAME").when(k == 3, "12.5").when(k == 4, " ").otherwise(F.col("p_name"))
    return table(spark, sf_dir, "part").select("p_partkey", tx.is_error_literal(c).alias("is_error"), tx.should_skip(c).alias("skip"))


@query("""
SELECT c_custkey, replace(c_name || '_x  Y', '#', '_') AS part, lower(replace(c_name, '_', ' ')) || ' x' AS name_key, (c_custkey % 500)::INT AS page,
  length(c_name)::BIGINT + 2 AS utf16, 2 AS breaks, 'a' || chr(10) || c_name || chr(10) AS lf, 'leaf' AS leaf, len(string_split(c_name, '0')) - 1 AS zeros, (c_custkey % 26 + 26)::INT AS col
FROM customer
""")
def text_scalars(spark, sf_dir):
    """A sheaf of scalar functions over customer names."""
    c = table(spark, sf_dir, "customer")
    n = F.col("c_name")
    return c.select(
        "c_custkey",
        F.replace(tx.text(F.replace(F.concat(n, F.lit("_x  Y")), F.lit("#"), F.lit("_"))), F.lit("|"), F.lit("")).alias("part"),
        tx.file_name_key(F.concat(n, F.lit("_ _X "))).alias("name_key"),
        tx.page_of(F.concat(F.lit("Chapter page_"), F.col("c_custkey") % 500, F.lit(".ai"))).alias("page"),
        tx.utf16_length(F.concat(n, F.lit("😀"))).alias("utf16"),
        tx.count_breaks(F.concat(F.lit("a\r\n"), n, F.lit("\r"))).alias("breaks"),
        tx.to_lf(F.concat(F.lit("a\r\n"), n, F.lit("\r"))).alias("lf"),
        tx.style_leaf(F.concat(F.lit("ParagraphStyle/Group%3a"), n, F.lit("/leaf"))).alias("leaf"),
        tx.count_exact(n, F.lit("0")).cast("long").alias("zeros"),
        tx.column_index(F.concat(F.lit("A"), F.chr(F.col("c_custkey") % 26 + 65), F.lit("7"))).alias("col"),
    )


@query("""
SELECT doc_id, upper(sha256(text)) AS sha256, doc_id || chr(31) || text || chr(30) AS payload FROM documents
""")
def fingerprint_sha256(spark, sf_dir):
    """Upper-case digests and payload texts, one document per key."""
    d = table(spark, sf_dir, "documents")
    p = hashing.payload_text(d.select("doc_id", F.lit(1).alias("row_no"), F.col("doc_id").alias("content_tag"), F.col("text").alias("content")), keys=("doc_id",))
    return d.select("doc_id", hashing.sha256_upper(F.col("text")).alias("sha256")).join(p, "doc_id")


@query("""
SELECT source, book, count(*) AS n_files, upper(sha256(string_agg(p || chr(0) || sha256(text) || chr(10), '' ORDER BY p))) AS set_sha256 FROM (SELECT source, doc_id // 1000 AS book, text, printf('d/%08d', doc_id) AS p FROM documents) GROUP BY source, book
""")
def set_hash(spark, sf_dir):
    """Ordered hash of the files of each book: a thousand ids of a source."""
    d = table(spark, sf_dir, "documents").select("source", F.expr("doc_id div 1000").alias("book"), F.format_string("d/%08d", "doc_id").alias("path"), F.sha2("text", 256).alias("sha256"))
    return hashing.set_hash(d, keys=("source", "book"))


@query("""
SELECT c_custkey, upper(printf('%08x', list_reduce(list_prepend(2166136261::BIGINT, list_transform(string_split(c_name, ''), lambda x: ascii(x)::BIGINT)), lambda a, b: (xor(a, b) * 16777619) & 4294967295))) AS fnv FROM customer
""")
def fingerprint_fnv1a(spark, sf_dir):
    """FNV-1a of customer names."""
    return table(spark, sf_dir, "customer").select("c_custkey", hashing.fnv1a32(F.col("c_name")).alias("fnv"))


# --- quality checks ---------------------------------------------------------


def _mutated(base):
    """``base`` and a copy with the faults that the row rules look for."""
    k, c = F.col("row_no"), F.col("content")
    new = F.when(k % 7 == 0, " ").when(k % 11 == 0, F.concat(c, F.lit("<i/>"))).when(k % 13 == 0, F.concat(c, F.lit(" "))).when(k % 17 == 0, F.concat(F.lit("&amp;lt; "), c)).when(k % 19 == 0, F.concat(F.lit("<?x?>"), c)).when(k % 23 == 0, F.concat(F.lit("a\n"), c)).when(k % 3 == 0, c).otherwise(F.concat(F.lit("Neu "), c))
    out = base.withColumn("content", new).withColumn("psr_id", F.when(k % 50 == 0, F.lit("q")).otherwise(F.col("psr_id")))
    return base, out


def _content_tables(spark, sf_dir):
    """Content of the whole texts, and its mutated copy."""
    d = spread(table(spark, sf_dir, "documents")).select("doc_id", "lang", F.coalesce("text", F.lit("")).alias("t"))
    return _mutated(d.select("lang", F.col("doc_id").alias("row_no"), F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit("p"), "doc_id")).otherwise("").alias("psr_id"), F.lit("").alias("psr_content"), F.format_string("%06d", F.col("doc_id") - F.when(F.col("doc_id") % 100 == 7, 1).otherwise(0)).alias("content_tag"), F.concat(F.lit("Text "), "t", F.lit("<b/>")).alias("content")))


# What the row rules are given.
QA_LANGUAGES = {"de": "German", "en": "English", "es": "Spanish", "fr": "French"}
QA_FORBIDDEN = [("no_new", "Neu", "not to be used")]
QA_PRESERVED = [("head", "Text")]


_PAIRS = r"""WITH b AS (SELECT doc_id AS k, lang, 'Text ' || coalesce(text, '') || '<b/>' AS s, CASE WHEN doc_id % 199 = 5 THEN NULL ELSE doc_id - CASE WHEN doc_id % 100 = 7 THEN 1 ELSE 0 END END AS tag FROM documents),
q AS (SELECT *, min(k) OVER (PARTITION BY tag) AS first_row, CASE WHEN k % 7 = 0 THEN ' ' WHEN k % 11 = 0 THEN s || '<i/>' WHEN k % 13 = 0 THEN s || ' ' WHEN k % 17 = 0 THEN '&amp;lt; ' || s WHEN k % 19 = 0 THEN '<?x?>' || s WHEN k % 23 = 0 THEN 'a' || chr(10) || s WHEN k % 3 = 0 THEN s ELSE 'Neu ' || s END AS o FROM b),
prot AS (SELECT DISTINCT tag FROM b WHERE k % 29 = 0 AND tag IS NOT NULL), pan AS (SELECT tag, s AS panel FROM b WHERE k % 31 = 0 AND tag IS NOT NULL),
p AS (SELECT q.*, prot.tag IS NOT NULL AS guarded, panel, prot.tag IS NULL AND panel IS NULL AS free,
  length(regexp_replace(regexp_replace(regexp_replace(replace(s, 'Text', ' '), '<\?(?s:.*?)\?>', '', 'g'), '&(?:amp|lt|gt|quot|apos|#[0-9]+|#x[0-9A-Fa-f]+);|(?i:<Br\b[^>]*/>)', ' ', 'g'), '[^A-Za-zÀ-ÖØ-öø-ÿ]', '', 'g')) >= 4 AS worded
  FROM q LEFT JOIN prot ON prot.tag = q.tag LEFT JOIN pan ON pan.tag = q.tag)"""


def _row_pairs(spark, sf_dir):
    """Whole documents beside their mutated copy, with ids, protection and
    panel texts; some rows have no content id."""
    k = F.col("row_no")
    tag = F.when(k % 199 == 5, "").otherwise(F.col("content_tag"))
    s, o = (t.withColumn("content_tag", tag) for t in _content_tables(spark, sf_dir))
    ids = s.where("content_tag <> ''").withColumnRenamed("content_tag", "content_id")
    # Ids, protection and panel are found on narrow rows; then each text moves once.
    bare = [x.withColumn("content", F.lit("")) for x in (s, o)]
    facts = qa.paired(*bare, keys=(), protected=ids.where(k % 29 == 0).select("content_id"), panel=ids.where(k % 31 == 0).select("content_id", F.col("content").alias("text")))
    # The source and its copy come from one row, so one join brings both.
    both = s.select("row_no", "lang", F.col("content").alias("s_content")), o.select("row_no", F.col("content").alias("o_content"))
    return facts.drop("s_content", "o_content").join(both[0], "row_no").join(both[1], "row_no")


@query(_PAIRS + r"""
, i AS (
  SELECT 'MISSING_CONTENT_ID' AS code, 'error' AS severity FROM p WHERE tag IS NULL
  UNION ALL SELECT 'DUPLICATE_CONTENT_ID', 'error' FROM p WHERE tag IS NOT NULL AND first_row < k
  UNION ALL SELECT 'PROTECTED_FIELD_CHANGED', 'error' FROM p WHERE k % 50 = 0
  UNION ALL SELECT 'PANEL_REFERENCE_CACHE_CHANGED', 'error' FROM p WHERE o <> panel
  UNION ALL SELECT 'PROTECTED_SOURCE_TEXT_CHANGED', 'error' FROM p WHERE guarded AND s <> o
  UNION ALL SELECT 'BLANK_TRANSLATION', 'error' FROM p WHERE trim(o) = ''
  UNION ALL SELECT 'PROCESSING_INSTRUCTION_CHANGED', 'error' FROM p WHERE regexp_extract_all(s, '<\?(?s:.*?)\?>') <> regexp_extract_all(o, '<\?(?s:.*?)\?>')
  UNION ALL SELECT 'MARKUP_CHANGED', 'error' FROM p WHERE regexp_extract_all(s, '</?[A-Za-z][^>]*>') <> regexp_extract_all(o, '</?[A-Za-z][^>]*>')
  UNION ALL SELECT 'LINE_BREAK_CHANGED', 'error' FROM p WHERE regexp_extract_all(s, '\r\n|[\r\n\x{2028}\x{2029}]') <> regexp_extract_all(o, '\r\n|[\r\n\x{2028}\x{2029}]')
  UNION ALL SELECT 'BOUNDARY_WHITESPACE_CHANGED', 'error' FROM p WHERE ends_with(o, ' ')
  UNION ALL SELECT 'DOUBLE_ESCAPED_ENTITY', 'error' FROM p WHERE regexp_matches(o, '(?i)&amp;(?:amp|lt|gt|quot|apos|#[0-9]+|#x[0-9A-Fa-f]+);')
  UNION ALL SELECT 'UNCHANGED_SOURCE_TEXT', 'warning' FROM p WHERE free AND worded AND trim(o) = s
  UNION ALL SELECT 'BOOK_INSTRUCTION_FORBIDDEN_TARGET', 'error' FROM p WHERE free AND contains(o, 'Neu')
  UNION ALL SELECT 'BOOK_SOURCE_NAME_CHANGED', 'error' FROM p WHERE free AND len(string_split(s, 'Text')) <> len(string_split(o, 'Text')))
SELECT code, severity, count(*) AS n FROM i GROUP BY ALL
""")
def qa_issue_counts(spark, sf_dir):
    """Issues of all row rules but typography on whole documents."""
    found = qa.row_issues(_row_pairs(spark, sf_dir), forbidden=QA_FORBIDDEN, preserved=QA_PRESERVED)
    return found.groupBy("code", "severity").agg(F.count("*").alias("n"))


@query()
def qa_all_row_rules(spark, sf_dir):
    """Issues of all row rules on whole documents, by language; some rows have
    no content id, some are protected, and some show a panel's text."""
    language = F.create_map(*(F.lit(x) for kv in QA_LANGUAGES.items() for x in kv))[F.col("lang")]
    return qa.row_issues(_row_pairs(spark, sf_dir), ["lang"], language, QA_FORBIDDEN, QA_PRESERVED, list(QA_LANGUAGES.values())).groupBy("lang", "code", "severity").agg(F.count("*").alias("n"))


@query(_PAIRS.replace("replace(s, 'Text', ' ')", "s") + """
SELECT lang, count(*) FILTER (worded) AS eligible, count(*) FILTER (worded AND trim(o) = s) AS unchanged, round(count(*) FILTER (worded AND trim(o) = s) / count(*) FILTER (worded), 6) AS share, count(*) FILTER (worded AND trim(o) = s) >= 10 AND count(*) FILTER (worded AND trim(o) = s) / count(*) FILTER (worded) >= 0.2 AS low FROM p GROUP BY lang
""")
def qa_coverage_by_lang(spark, sf_dir):
    """Share of unchanged text by language."""
    s, o = _content_tables(spark, sf_dir)
    pairs = qa.paired(s, o.drop("lang"), ()).join(s.select("row_no", "lang"), "row_no")
    return qa.coverage_of(pairs, ["lang"]).withColumn("share", F.round("share", 6))


@query("""
SELECT page_id, len(regexp_extract_all(html, '</?[A-Za-z][^>]*>'))::INT AS n_tags, len(regexp_extract_all(html, '&(?:amp|lt|gt|quot|apos|#[0-9]+|#x[0-9A-Fa-f]+);'))::INT AS n_entities,
  length(regexp_replace(regexp_replace(regexp_replace(html, '<\\?(?s:.*?)\\?>', '', 'g'), '&(?:amp|lt|gt|quot|apos|#[0-9]+|#x[0-9A-Fa-f]+);|(?i:<Br\\b[^>]*/>)', ' ', 'g'), '[^A-Za-zÀ-ÖØ-öø-ÿ]', '', 'g'))::INT AS letters FROM pages
""")
def qa_markup_inventory(spark, sf_dir):
    """Markup inventories of all pages."""
    h = F.col("html")
    return spread(table(spark, sf_dir, "pages")).select("page_id", F.size(markup.tags(h)).alias("n_tags"), F.regexp_count(h, F.lit(markup.ENTITY)).alias("n_entities"), F.length(markup.visible_letters(h)).alias("letters"))


@query("""
WITH i AS (SELECT l_orderkey, l_linenumber AS ord, CASE WHEN l_discount >= 0.05 THEN 'error' ELSE 'warning' END AS severity, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS n FROM lineitem),
h AS (SELECT *, CASE WHEN severity = 'warning' THEN row_number() OVER (PARTITION BY l_orderkey, severity ORDER BY n DESC) END AS k FROM i WHERE n <= 2),
e AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY n) AS k FROM i WHERE n > 2 AND severity = 'error'),
f AS (SELECT h.l_orderkey, coalesce(e.severity, h.severity) AS severity FROM h LEFT JOIN e ON e.l_orderkey = h.l_orderkey AND e.k = h.k)
SELECT t.l_orderkey, t.errors, t.warnings, t.total, f.retained, f.kept_errors, t.total - f.retained AS omitted FROM
 (SELECT l_orderkey, count(*) FILTER (severity = 'error') AS errors, count(*) FILTER (severity = 'warning') AS warnings, count(*) AS total FROM i GROUP BY 1) t
 JOIN (SELECT l_orderkey, count(*) AS retained, count(*) FILTER (severity = 'error') AS kept_errors FROM f GROUP BY 1) f USING (l_orderkey)
""")
def qa_bounded_report(spark, sf_dir):
    """At most two issues kept per order, errors before warnings."""
    from pyspark.sql import Window as W

    l = table(spark, sf_dir, "lineitem")
    i = l.select("l_orderkey", F.row_number().over(W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")).alias("ord"), F.when(F.col("l_discount") >= 0.05, "error").otherwise("warning").alias("severity"))
    kept = qa.retained(i, 2, ["l_orderkey"]).groupBy("l_orderkey").agg(F.count("*").alias("retained"), F.count_if(F.col("severity") == "error").alias("kept_errors"))
    return qa.totals(i, ["l_orderkey"]).join(kept, "l_orderkey").withColumn("omitted", F.col("total") - F.col("retained"))


# --- glossaries -------------------------------------------------------------


def _name_glossary(spark, sf_dir):
    n = _named(spark, sf_dir)
    fields = F.array(*(F.struct(F.lit(f).alias("field"), v.alias("value")) for f, v in [("English Definition", F.concat(F.lit("about "), "name")), ("French", F.concat("name", F.lit("-fr"))), ("French Definition", F.when(F.col("k") % 3 == 0, "").otherwise(F.concat(F.lit("de "), "name")))]))
    kind = F.when(F.col("k") % 2 == 0, "acronyms").otherwise("words")
    return n.select(kind.alias("kind"), F.col("name").alias("source"), F.explode(fields).alias("f"), F.col("k").cast("long").alias("ord")).select("kind", "source", "f.field", "f.value", "ord")


_NAMES_SQL = """WITH g AS (SELECT k, name AS source, CASE WHEN k % 2 = 0 THEN 'acronyms' ELSE 'words' END AS kind, 'about ' || name AS ed, name || '-fr' AS fr, CASE WHEN k % 3 = 0 THEN '' ELSE 'de ' || name END AS fd FROM (SELECT c_custkey AS k, c_name AS name, c_nationkey AS part FROM customer) named)"""


@query(_NAMES_SQL + """
, p AS (SELECT *, CASE WHEN k % 5 = 0 THEN 'sense' WHEN k % 5 = 1 THEN 'new-' || source END AS term FROM g WHERE k % 5 < 3),
o AS (SELECT g.kind, g.source, g.ed AS ed, CASE WHEN p.k IS NULL THEN g.fr WHEN p.k % 5 = 0 THEN '' ELSE coalesce(p.term, g.fr) END AS fr, CASE WHEN p.k IS NOT NULL AND p.k % 5 = 0 THEN '' ELSE g.fd END AS fd FROM g LEFT JOIN p USING (k))
SELECT kind, source, 'English Definition' AS field, ed AS value FROM o UNION ALL SELECT kind, source, 'French', fr FROM o UNION ALL SELECT kind, source, 'French Definition', fd FROM o
""")
def glossary_overlay(spark, sf_dir):
    """A published glossary laid over a base: new terms, blanks that keep,
    and sources with two senses."""
    base = _name_glossary(spark, sf_dir)
    n = _named(spark, sf_dir).where("k % 5 < 3").withColumn("i", F.explode(F.when(F.col("k") % 5 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    term = F.when(F.col("k") % 5 == 0, F.concat(F.lit("sense"), "i")).when(F.col("k") % 5 == 1, F.concat(F.lit("new-"), "name")).otherwise("")
    entry = F.struct(term.alias("term"), F.lit("").alias("definition"), F.lit("").alias("combined_definition"))
    pub = n.select(F.lit("b").alias("book"), (F.col("k") * 2 + F.col("i")).cast("int").alias("row"), F.when(F.col("k") % 2 == 0, "acronyms").otherwise("words").alias("kind"), F.lower("name").alias("english"), F.lit("").alias("english_definition"), F.create_map(F.lit("French"), entry).alias("translations"))
    out, _ = glossary.overlay(base, pub, {"French": "French"})
    return out.select("kind", "source", "field", "value")


@query("""
WITH e AS (SELECT p_brand AS source, 'T' || p_size % 3 AS target, p_partkey AS ord FROM part)
SELECT source, arg_min(target, ord) AS target, count(DISTINCT target) > 1 AS contextual, CASE WHEN count(DISTINCT target) > 1 THEN count(DISTINCT target) ELSE 0 END::INT AS n_alternatives, count(DISTINCT target) = 1 AS allow_ci FROM e GROUP BY source
UNION ALL SELECT upper(n_name) || 'x', 'w', false, 0, false FROM nation UNION ALL SELECT upper(n_name) || 'X', 'w', false, 0, false FROM nation
""")
def glossary_compile(spark, sf_dir):
    """Compiled entries: definitions of several senses, case twins."""
    p = table(spark, sf_dir, "part").select(F.col("p_brand").alias("source"), F.concat(F.lit("T"), F.col("p_size") % 3).alias("target"), F.lit("definition").alias("kind"), F.lit("").alias("source_term"), F.col("p_partkey").alias("ord"))
    n = table(spark, sf_dir, "nation").select(F.explode(F.array(F.concat(F.upper("n_name"), F.lit("x")), F.concat(F.upper("n_name"), F.lit("X")))).alias("source"), F.lit("w").alias("target"), F.lit("word").alias("kind"), F.lit("").alias("source_term"), F.col("n_nationkey").cast("long").alias("ord"))
    c = glossary.compile_entries(p.union(n))
    return c.select("source", "target", "contextual", F.size("alternatives").alias("n_alternatives"), "allow_ci")


@query("""
WITH s AS (SELECT name AS source FROM (SELECT c_custkey AS k, c_name AS name, c_nationkey AS part FROM customer) named UNION ALL SELECT upper(name) FROM (SELECT c_custkey AS k, c_name AS name, c_nationkey AS part FROM customer) named UNION ALL SELECT lower(name) FROM (SELECT c_custkey AS k, c_name AS name, c_nationkey AS part FROM customer) named WHERE k % 2 = 0 UNION ALL SELECT r_name FROM region)
SELECT lower(source) AS folded, array_to_string(list_sort(list_distinct(list(source))), ',') AS sources FROM s GROUP BY 1 HAVING count(DISTINCT source) > 1
""")
def casefold_collisions(spark, sf_dir):
    """Spellings that differ by case only."""
    n, r = _named(spark, sf_dir), table(spark, sf_dir, "region")
    s = n.select(F.col("name").alias("source")).union(n.select(F.upper("name"))).union(n.where("k % 2 = 0").select(F.lower("name"))).union(r.select("r_name"))
    return glossary.case_collisions(s).withColumn("sources", F.array_join("sources", ","))


# Terms that occur in the texts.
TERMS = ["the", "Apache License", "GNU General Public License", "token", "and", "version", "disgusting", "De La", "re", "und"]


@query("""
WITH t AS (SELECT unnest(['the', 'Apache License', 'GNU General Public License', 'token', 'and', 'version', 'disgusting', 'De La', 're', 'und']) AS source)
SELECT doc_id, t.source, 'x-' || t.source AS target FROM documents, t WHERE regexp_matches(text, '(?i)(^|[^A-Za-z0-9_])' || t.source || '($|[^A-Za-z0-9_])')
""")
def glossary_match_pairs(spark, sf_dir):
    """Every term in every document, overlaps allowed, ASCII boundaries."""
    pairs = spark.createDataFrame([(t, f"x-{t}") for t in TERMS], "source string, target string")
    return glossary.term_pairs(spread(table(spark, sf_dir, "documents").select("doc_id", "text")), pairs, "doc_id", "text")


def _claims_sql() -> str:
    """Blanks each term that claims a place, exactly first and then in any
    case, the longest term first: one step of SQL for each term and form."""
    ranked = sorted(TERMS, key=lambda t: (-len(t), TERMS.index(t)))
    ctes, last, found = ["s0 AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)"], 0, []
    edge = r"[^\p{L}\p{M}\p{N}_]"
    for mode, flag in (("exact", ""), ("case-insensitive-unique", "(?i)")):
        for k, term in enumerate(ranked):
            pattern = f"(^|{edge}){flag}{term}($|{edge})" if not flag else f"(^|{edge})(?i:{term})($|{edge})"
            blank = " " * len(term)
            free = "true" if mode == "exact" else f"NOT m{k}"
            once = f"regexp_replace(t, '{pattern}', '\\1{blank}\\2', 'g')"
            twice = f"regexp_replace({once}, '{pattern}', '\\1{blank}\\2', 'g')"
            name = f"m{k}" if mode == "exact" else f"c{k}"
            ctes.append(f"s{last + 1} AS (SELECT * EXCLUDE (t), {free} AND regexp_matches(t, '{pattern}') AS {name}, CASE WHEN {free} THEN {twice} ELSE t END AS t FROM s{last})")
            found.append(f"SELECT doc_id, '{term}' AS source, '{mode}' AS mode FROM last WHERE {name}")
            last += 1
    return "WITH " + ",\n".join(ctes) + f",\nlast AS MATERIALIZED (SELECT * FROM s{last})\n" + "\nUNION ALL ".join(found)


@query(_claims_sql())
def glossary_match_claims(spark, sf_dir):
    """Terms that claim a place in each document, the longest first."""
    rows = [(t, f"x-{t}", "word", "", i) for i, t in enumerate(TERMS)]
    c = glossary.compile_entries(spark.createDataFrame(rows, "source string, target string, kind string, source_term string, ord long"))
    m = glossary.match_terms(spread(table(spark, sf_dir, "documents").select("doc_id", "text")), c, "doc_id", "text")
    return m.select("doc_id", F.explode("matches").alias("m")).select("doc_id", "m.source", "m.mode")


@query(_NAMES_SQL + """
SELECT kind, count(*) AS n_sources, 0::BIGINT AS missing_terms, count(*) FILTER (fd = '') AS missing_definitions FROM g GROUP BY kind
""")
def profile_coverage(spark, sf_dir):
    """Missing terms and definitions by kind."""
    return glossary.coverage(_name_glossary(spark, sf_dir), "French", "French Definition")


@query("""
WITH t(i, source, old, new) AS (VALUES (0, 'the', 'x', 'y'), (1, 'token', 'x', 'x'), (2, 'version', 'x', 'z'), (3, 'disgusting', NULL, 'q'))
SELECT doc_id, EXISTS (SELECT 1 FROM t WHERE old IS DISTINCT FROM new AND regexp_matches(text, '(?:^|[^\\p{L}\\p{M}\\p{N}_])(?i:' || source || ')(?:$|[^\\p{L}\\p{M}\\p{N}_])')) AS queried FROM documents
""")
def profile_delta(spark, sf_dir):
    """Documents that a changed glossary entry applies to."""
    make = lambda rows: spark.createDataFrame([(s, t, "word", "", i) for i, (s, t) in enumerate(rows)], "source string, target string, kind string, source_term string, ord long")
    new = glossary.compile_entries(make([("the", "y"), ("token", "x"), ("version", "z"), ("disgusting", "q")]))
    old = make([("the", "x"), ("token", "x"), ("version", "x")])
    docs = spread(table(spark, sf_dir, "documents")).select(F.col("doc_id").alias("group_id"), F.col("text").alias("source_text"), F.lit("").alias("target_text"))
    return glossary.select_for_delta(docs, glossary.changed_entries(new, old)).select(F.col("group_id").alias("doc_id"), "queried")


@query("""
SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN 'T-' || p_brand WHEN p_partkey % 4 = 1 THEN 'T-' || p_brand ELSE 'none ' || p_partkey END AS target FROM part
""")
def symbol_lookup_fallback(spark, sf_dir):
    """Exact key, else the key but for case, else the text itself."""
    p = table(spark, sf_dir, "part")
    symbols = p.groupBy(F.col("p_brand").alias("source")).agg(F.min("p_partkey").alias("ord")).withColumn("target", F.concat(F.lit("T-"), "source"))
    k = F.col("p_partkey") % 4
    rows = p.select("p_partkey", F.when(k == 0, F.col("p_brand")).when(k == 1, F.lower("p_brand")).otherwise(F.concat(F.lit("none "), "p_partkey")).alias("text"))
    return glossary.lookup(rows, symbols).select("p_partkey", "target")


# --- batches, ledgers, jobs -------------------------------------------------


@query("""
SELECT lang, toxic_set AS is_protected, count(*) AS n FROM (SELECT lang, coalesce(toxic = 1, false) AS toxic_set FROM documents LEFT JOIN labels USING (doc_id)) GROUP BY ALL
""")
def protected_partition(spark, sf_dir):
    """Documents split by a protected set, by language."""
    d = table(spark, sf_dir, "documents").select("lang", F.col("doc_id").cast("string").alias("group_id"), F.array("doc_id").alias("rows"))
    protected = table(spark, sf_dir, "labels").where("toxic = 1").select(F.col("doc_id").alias("row_no"))
    return packing.partition_protected(d, protected).groupBy("lang", "is_protected").agg(F.count("*").alias("n"))


_PACK = """WITH RECURSIVE g AS (SELECT source, doc_id // 5000 AS job, doc_id, n_chars AS c, (len(string_split(text, chr(10))))::BIGINT AS s, row_number() OVER (PARTITION BY source, doc_id // 5000 ORDER BY doc_id) AS i FROM documents),
f AS (SELECT source, job, doc_id, i, c, s, 1 AS n, 1 AS b FROM g WHERE i = 1
  UNION ALL SELECT g.source, g.job, g.doc_id, g.i,
    CASE WHEN f.c + g.c > 24000 OR f.n >= 20 OR f.s + g.s > 300 THEN g.c ELSE f.c + g.c END,
    CASE WHEN f.c + g.c > 24000 OR f.n >= 20 OR f.s + g.s > 300 THEN g.s ELSE f.s + g.s END,
    CASE WHEN f.c + g.c > 24000 OR f.n >= 20 OR f.s + g.s > 300 THEN 1 ELSE f.n + 1 END,
    f.b + CASE WHEN f.c + g.c > 24000 OR f.n >= 20 OR f.s + g.s > 300 THEN 1 ELSE 0 END
  FROM f JOIN g ON g.source = f.source AND g.job = f.job AND g.i = f.i + 1)"""


def _packed(spark, sf_dir):
    """Jobs of 5,000 ids of a source; a longer document stands alone."""
    d = table(spark, sf_dir, "documents").select("source", F.expr("doc_id div 5000").alias("job"), F.col("doc_id").alias("ord"), F.col("n_chars").alias("chars"), F.size(F.split("text", "\n", -1)).alias("segments"))
    return packing.text_batches(d, ["source", "job"], (24_000, 20, 300), oversize="alone")


@query(_PACK + "SELECT source, job, doc_id, b AS batch_no, printf('batch_%04d', b) AS batch_id FROM f")
def batch_packing(spark, sf_dir):
    """Greedy batches of each source's documents, in order."""
    return _packed(spark, sf_dir).select("source", "job", F.col("ord").alias("doc_id"), "batch_no", "batch_id")


@query(_PACK + "SELECT source, job, b AS batch_no, count(*) AS n, sum(g.c)::BIGINT AS chars FROM f JOIN g USING (source, job, doc_id) WHERE b % 3 <> 0 GROUP BY ALL")
def batch_resume(spark, sf_dir):
    """Batches that have no result yet: every third one has."""
    b = _packed(spark, sf_dir).withColumn("key", F.concat_ws("/", "source", "job", "batch_id"))
    done = b.where("batch_no % 3 = 0").select("key")
    return packing.remaining(b, done, "key").groupBy("source", "job", "batch_no").agg(F.count("*").alias("n"), F.sum("chars").alias("chars"))


@query("""
WITH l AS (SELECT sha256(text) AS h, printf('Doc_%d.ai', doc_id) AS file, doc_id FROM documents), c AS (SELECT h, count(*) AS n, min(file) AS f FROM l GROUP BY h)
SELECT printf('doc  %d.AI', doc_id) AS file, CASE WHEN n = 1 THEN f WHEN n > 1 THEN printf('Doc_%d.ai', doc_id) END AS entry_file, CASE WHEN n = 1 THEN 'sha256' ELSE 'sha256+name' END AS matched_by FROM l JOIN c USING (h)
""")
def ledger_hash_match(spark, sf_dir):
    """Files found in a ledger by content, and by name among equal ones."""
    d = table(spark, sf_dir, "documents")
    entries = d.select(F.sha2("text", 256).alias("sha256"), F.format_string("Doc_%d.ai", "doc_id").alias("file"))
    files = d.select(F.sha2("text", 256).alias("sha256"), F.format_string("doc  %d.AI", "doc_id").alias("file"))
    return ledger.match_files(files, entries).select("file", "entry_file", "matched_by")


def _units(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    german = F.create_map(F.lit("German"), F.concat(F.lit("de "), "c_name"))
    return c.select(F.lit("b").alias("book"), "c_mktsegment", F.col("c_mktsegment").alias("file"), F.col("c_custkey").alias("pos"), F.col("c_name").alias("id"), F.when(F.col("c_custkey") % 10 == 0, "sourceCode").otherwise("prose").alias("kind"), F.col("c_name").alias("plain"), F.when(F.col("c_custkey") % 4 == 0, german).alias("translations"))


@query("""
SELECT c_mktsegment AS file, 'German' AS language, count(*) FILTER (c_custkey % 10 <> 0 AND c_custkey % 4 <> 0) AS pending, count(*) FILTER (c_custkey % 4 = 0 AND c_custkey % 3 <> 0) AS reused FROM customer GROUP BY 1
""")
def ledger_reuse_pending(spark, sf_dir):
    """Pending units of each file, and translations kept where the text is
    the same as before."""
    u = _units(spark, sf_dir)
    before = u.withColumn("plain", F.when(F.col("pos") % 3 == 0, F.concat(F.lit("old "), "plain")).otherwise(F.col("plain")))
    reused = ledger.reuse_translations(u, before).groupBy("file").agg(F.count_if("reused").alias("reused"))
    return ledger.pending_counts(u, ["German"]).join(reused, "file")


@query("""
SELECT c_name AS id, c_custkey % 2 = 0 AND NOT c_custkey % 8 = 0 AS changed, CASE WHEN c_custkey % 2 = 0 THEN CASE WHEN c_custkey % 8 = 0 THEN 'de ' || c_name ELSE 'neu ' || c_custkey END WHEN c_custkey % 4 = 0 THEN 'de ' || c_name END AS german FROM customer
""")
def translation_upsert(spark, sf_dir):
    """Translations recorded for every second unit, changes counted."""
    u = _units(spark, sf_dir)
    new = u.where("pos % 2 = 0").select("file", "id", F.when(F.col("pos") % 8 == 0, F.concat(F.lit("de "), "plain")).otherwise(F.concat(F.lit("neu "), "pos")).alias("target"))
    out = ledger.record_translations(u, new, "German")
    return out.select("id", "changed", F.try_element_at("translations", F.lit("German")).alias("german"))


@query("""
SELECT event_id, 'EVENT' AS kind, event_type AS type, user_id, 'a b|=' AS note FROM events
""")
def audit_rows_parse(spark, sf_dir):
    """Encoded audit lines back to typed fields."""
    e = table(spark, sf_dir, "events").select("event_id", F.concat(F.lit("EVENT|type="), "event_type", F.lit("|user="), "user_id", F.lit("|note=a+b%7C%3D")).alias("line"))
    r = audit.audit_rows(e)
    return r.select("event_id", "kind", audit.field("type").alias("type"), audit.field("user", "bigint").alias("user_id"), audit.field("note").alias("note"))


@query("""
SELECT user_id, n + CASE WHEN user_id % 10 = 0 THEN 1 ELSE 0 END AS declared, n AS found FROM (SELECT user_id, count(*) AS n FROM events GROUP BY 1) WHERE user_id % 10 = 0
""")
def audit_completeness(spark, sf_dir):
    """Users whose declared number of events was not collected."""
    e = table(spark, sf_dir, "events")
    declared = e.groupBy("user_id").agg(F.count("*").alias("n")).withColumn("n", F.col("n") + F.when(F.col("user_id") % 10 == 0, 1).otherwise(0))
    return audit.completeness(declared, e, "user_id")


@query("""
SELECT o_orderkey, o_orderkey % 3 <> 2 AS fits FROM orders
""")
def template_match(spark, sf_dir):
    """Generated references that fit the German template."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey") % 3
    s = F.when(k == 0, F.concat(F.lit("(Siehe Bild "), "o_orderkey", F.lit(f", S.{NBSP}"), "o_custkey", F.lit(".)"))).when(k == 1, F.lit(f"(Siehe a.b, S.{NBSP}iv–2.)")).otherwise(F.concat(F.lit(f"(Siehe , S.{NBSP}"), "o_custkey", F.lit(")")))
    return o.select("o_orderkey", audit.matches_template(s, audit.blocks_literal(audit.TEMPLATES["German"][0])).alias("fits"))


@query("""
SELECT doc_id, len(string_split(text, chr(10))) - 1 AS n_locks, true AS same, true AS kinds FROM documents
""")
def lock_restore_roundtrip(spark, sf_dir):
    """Line breaks locked as tokens and restored, in every document."""
    d = spread(table(spark, sf_dir, "documents")).select("doc_id", "text", locks.lock_breaks(F.col("text"), F.col("doc_id").cast("string"), F.lit(0)).alias("l"))
    back = locks.restore_breaks(F.col("l.text"), F.col("l.locks"))
    kinds = locks.restore_break_kinds(F.col("text"), F.replace("text", F.lit("\n"), F.lit("\x0b")))
    return d.select("doc_id", F.size("l.locks").cast("long").alias("n_locks"), (back == F.col("text")).alias("same"), (kinds == F.col("text")).alias("kinds"))


@query("""
WITH e AS (SELECT user_id, ['exported', 'translating', 'translated', 'imported', 'complete'][(event_id % 5 + 1)::INT] AS status, lag(['exported', 'translating', 'translated', 'imported', 'complete'][(event_id % 5 + 1)::INT]) OVER (PARTITION BY user_id ORDER BY event_id) AS previous FROM events)
SELECT previous, status, (previous || '>' || status) IN ('exported>translating', 'translating>translating', 'translating>translated', 'translated>imported', 'imported>imported', 'imported>complete', 'complete>complete', 'complete>exported', 'imported>exported', 'translated>exported') AS valid, count(*) AS n FROM e WHERE previous IS NOT NULL GROUP BY ALL
""")
def status_transitions(spark, sf_dir):
    """Changes of status in a job log, and whether they are allowed."""
    states = F.array(*map(F.lit, ["exported", "translating", "translated", "imported", "complete"]))
    log = table(spark, sf_dir, "events").select("user_id", "event_id", F.get(states, (F.col("event_id") % 5).cast("int")).alias("status"))
    return packing.status_changes(log, packing.TRANSITIONS, ["user_id"], "event_id").groupBy("previous", "status", "valid").agg(F.count("*").alias("n"))


@query("""
SELECT c_custkey AS row_no, CASE WHEN c_custkey % 3 = 0 THEN 'pt ' || c_name ELSE '' END AS portuguese, c_custkey % 3 = 0 AS pending FROM customer
""")
def caption_update(spark, sf_dir):
    """Pending captions translated, one column changed."""
    c = table(spark, sf_dir, "customer")
    sheet = c.select(F.col("c_custkey").alias("row_no"), F.when(F.col("c_custkey") % 3 == 0, F.col("c_name")).otherwise(" ").alias("english"), F.lit("").alias("portuguese"))
    todo = ledger.caption_pending(sheet)
    out = ledger.put_captions(sheet, todo.select("row_no", F.concat(F.lit("pt "), "english").alias("translated")))
    return out.join(todo.select("row_no", F.lit(True).alias("pending")), "row_no", "left").select("row_no", "portuguese", F.coalesce("pending", F.lit(False)).alias("pending"))


def _stories(spark, sf_dir):
    n = spread(_named(spark, sf_dir))
    para = lambda x: F.concat(F.lit('<ParagraphStyleRange AppliedParagraphStyle="ParagraphStyle/Body"><Content>'), x, F.lit("</Content><Content /></ParagraphStyleRange>"))
    return n.select(F.col("k").alias("file_no"), F.concat("name", F.lit(".icml")).alias("file_name"), F.concat(F.lit("<Story>"), para(F.concat("k", F.lit(" km &amp; 3 + 4"))), para(F.col("name")), F.lit("</Story>")).alias("xml"))


@query("""
WITH n AS (SELECT k AS f, name, unnest(range(0, 4)) AS i FROM (SELECT c_custkey AS k, c_name AS name, c_nationkey AS part FROM customer) named)
SELECT f AS file_no, f * 4 + i + 1 AS row_no, CASE WHEN i % 2 = 0 THEN printf('%05d', f * 2 + i // 2) ELSE '' END AS psr_id, CASE i WHEN 0 THEN f || ' km &amp; 3 + 4' WHEN 2 THEN name ELSE '' END AS psr_content, printf('%05d', f * 4 + i) AS content_tag, CASE i WHEN 0 THEN f || ' km &amp; 3 + 4' WHEN 2 THEN name ELSE '' END AS content FROM n
""")
def story_index(spark, sf_dir):
    """Content rows of marked-up stories, ids running over all files."""
    rows, _ = structure.index_stories(_stories(spark, sf_dir))
    return rows.drop("file_name")


@query("""
SELECT k AS file_no, true AS changed, '<Story><ParagraphStyleRange AppliedParagraphStyle="ParagraphStyle/Body"><Content>' || k || chr(160) || 'km &amp; 3' || chr(160) || '+' || chr(160) || '4</Content><Content /></ParagraphStyleRange><ParagraphStyleRange AppliedParagraphStyle="ParagraphStyle/Body"><Content>' || name || '</Content><Content /></ParagraphStyleRange></Story>' AS typeset FROM (SELECT c_custkey AS k, c_name AS name, c_nationkey AS part FROM customer) named
""")
def story_typography(spark, sf_dir):
    """The typography matrix applied inside marked-up stories, in place."""
    return structure.typeset_stories(_stories(spark, sf_dir), "English").select("file_no", "changed", "typeset")


@query("""
SELECT k, name || '|=' || k || '|x' AS recovered FROM (SELECT c_custkey AS k, c_name AS name, c_nationkey AS part FROM customer) named
""")
def recover_segments(spark, sf_dir):
    """Segments whose equation a spreadsheet replaced by an error value."""
    n = _named(spark, sf_dir).select("k", F.concat("name", F.lit("="), "k", F.lit("x")).alias("composite"), F.array(F.col("name"), F.lit("#NAME?"), F.lit("x")).alias("segments"))
    return structure.recover_groups(n).select("k", F.array_join("recovered", "|").alias("recovered"))



# --- contracts and reconciliation -------------------------------------------


@query("""
SELECT doc_id, 'token' AS source FROM documents WHERE regexp_matches(text, '(^|[^\\p{L}\\p{M}\\p{N}_])(?i:token)($|[^\\p{L}\\p{M}\\p{N}_])') AND doc_id % 2 = 0
UNION ALL SELECT doc_id, 'disgusting' FROM documents WHERE regexp_matches(text, '(^|[^\\p{L}\\p{M}\\p{N}_])(?i:disgusting)($|[^\\p{L}\\p{M}\\p{N}_])')
""")
def qa_glossary_targets(spark, sf_dir):
    """Documents whose translation lacks the target of a term they hold."""
    c = glossary.compile_entries(spark.createDataFrame([("token", "jeton", "word", "", 0), ("disgusting", "répugné", "definition", "", 1)], "source string, target string, kind string, source_term string, ord long"))
    d = spread(table(spark, sf_dir, "documents")).select(F.col("doc_id").alias("row_no"), F.col("doc_id").cast("string").alias("content_id"), F.col("text").alias("content"), F.when(F.col("doc_id") % 2 == 1, "le Jeton").otherwise("jetons, répugnant").alias("o_content"))
    m = glossary.match_terms(d, c)
    found = qa.glossary_issues(m, c, "French")
    return found.select(F.col("row_no").alias("doc_id"), F.regexp_extract("message", r"for (\w+)", 1).alias("source"))


@query("""
SELECT doc_id, p AS phrase, count(*) AS expected, CASE WHEN doc_id % 2 = 0 THEN 0 ELSE len(string_split(any_value(text), p)) - 1 END::BIGINT AS actual
FROM (SELECT doc_id, text, unnest(regexp_extract_all(text, '(?:Apache|Public) License')) AS p FROM documents) GROUP BY doc_id, p
""")
def preserved_names(spark, sf_dir):
    """Protected names counted in a text and its translation."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("source"), F.when(F.col("doc_id") % 2 == 0, F.replace("text", F.lit("License"), F.lit("Licence"))).otherwise(F.col("text")).alias("target"))
    return glossary.preserved_counts(d, [("license", "(?:Apache|Public) License")]).select("doc_id", "phrase", "expected", "actual")


@query("""
SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN ' T-' || p_brand || ' ' || chr(9) || p_type WHEN p_partkey % 3 = 1 THEN NULL END AS expected FROM part
""")
def glossary_table_rows(spark, sf_dir):
    """Two-cell rows whose pair is in the glossary, as they must read."""
    p = table(spark, sf_dir, "part")
    pairs = p.select(F.col("p_brand").alias("term"), F.col("p_type").alias("definition"), F.concat(F.lit("T-"), "p_brand").alias("target_term"), F.lit("").alias("target_definition")).distinct()
    k = F.col("p_partkey") % 3
    rows = p.select("p_partkey", F.when(k == 0, F.concat(F.lit(" "), "p_brand", F.lit(" \t"), "p_type")).when(k == 1, F.concat("p_brand", F.lit("\t"), "p_type", F.lit("\t"))).otherwise(F.col("p_brand")).alias("content"))
    return glossary.expected_table_rows(rows, pairs).select("p_partkey", "expected")


@query("""
WITH a AS (SELECT o_orderkey AS k, o_custkey AS v FROM orders WHERE o_orderkey % 5 <> 0), b AS (SELECT o_orderkey AS k, o_custkey + CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END AS v FROM orders WHERE o_orderkey % 6 <> 0)
SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.k IS NULL THEN 'left only' WHEN a.k IS NULL THEN 'right only' ELSE 'differs' END AS state FROM a FULL JOIN b ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL OR a.v <> b.v
""")
def keyed_differences(spark, sf_dir):
    """Full-outer reconciliation of two versions of a table."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("v"))
    a = o.where("k % 5 <> 0")
    b = o.where("k % 6 <> 0").withColumn("v", F.col("v") + F.when(F.col("k") % 7 == 0, 1).otherwise(0))
    return relational.differences(a, b, ["k"], "v")


@query("""
SELECT p_partkey::VARCHAR AS id, CASE WHEN p_partkey % 2 = 0 THEN 'new ' || p_brand ELSE p_brand END AS pattern FROM part UNION ALL SELECT 'x' || n_nationkey, n_name FROM nation
""")
def rule_upsert(spark, sf_dir):
    """Rules with exceptions upserted by id."""
    base = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("id"), F.col("p_brand").alias("pattern"), F.col("p_partkey").alias("ord"))
    more = base.where("ord % 2 = 0").withColumn("pattern", F.concat(F.lit("new "), "pattern"))
    extra = table(spark, sf_dir, "nation").select(F.concat(F.lit("x"), "n_nationkey").alias("id"), F.col("n_name").alias("pattern"), (F.col("n_nationkey") + 10**9).cast("long").alias("ord"))
    return relational.merge_rules(base, more.union(extra)).select("id", "pattern")


@query("""
SELECT c_name AS path, CASE WHEN c_custkey % 10 = 0 THEN 'changed' ELSE 'missing' END AS fault FROM customer WHERE c_custkey % 10 IN (0, 1)
""")
def inventory_check(spark, sf_dir):
    """Listed files that are missing or differ."""
    c = table(spark, sf_dir, "customer").select(F.col("c_name").alias("path"), "c_custkey", F.sha2("c_name", 256).alias("sha256"))
    present = c.where("c_custkey % 10 <> 1").withColumn("sha256", F.when(F.col("c_custkey") % 10 == 0, F.sha2(F.lit("x"), 256)).otherwise(F.upper("sha256")))
    return relational.inventory_faults(c.select("path", "sha256"), present.select("path", "sha256"))


@query("""
SELECT c_custkey AS frame_index, CASE WHEN c_custkey % 5 = 0 THEN c_name ELSE '<' || substr(c_name, 1, 3) || '>' || substr(c_name, 5, 2) || '-' || substr(c_name, 8) END AS text, CASE WHEN c_custkey % 5 = 0 THEN 'ranges overlap' END AS fault FROM customer
""")
def range_replacement(spark, sf_dir):
    """Ranges of frames replaced in one pass, overlaps refused."""
    c = table(spark, sf_dir, "customer")
    frames = c.select(F.col("c_custkey").cast("int").alias("frame_index"), F.col("c_name").alias("text"))
    second = F.when(F.col("c_custkey") % 5 == 0, 3).otherwise(6)
    both = F.array(F.struct(second.alias("start"), F.lit(1).alias("length"), F.lit("-").alias("target")), F.struct(F.lit(0).alias("start"), F.lit(4).alias("length"), F.concat(F.lit("<"), F.substring("c_name", 1, 3), F.lit(">")).alias("target")))
    items = c.select(F.col("c_custkey").cast("int").alias("frame_index"), F.explode(both).alias("x")).select("frame_index", "x.*")
    return validation.apply_ranges(frames, items).select(F.col("frame_index").cast("long").alias("frame_index"), "text", "fault")


@query("""
SELECT c_mktsegment AS file, c_name AS id, CASE WHEN c_custkey % 3 = 0 THEN 'local' ELSE 'T' || n END AS translated FROM (SELECT *, sum(CASE WHEN c_custkey % 3 = 0 THEN 0 ELSE 1 END) OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) AS n FROM customer)
""")
def alias_round_trip(spark, sf_dir):
    """Units under short names, and their answers mapped back."""
    items = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("file"), F.col("c_custkey").alias("pos"), F.col("c_name").alias("id"), F.when(F.col("c_custkey") % 3 == 0, "local").alias("local"))
    named = ledger.compact(items)
    answers = named.where("alias is not null").select("file", "alias", F.upper("alias").alias("translated"))
    return ledger.expand(named, answers)[0]


@query("""
SELECT k::VARCHAR AS key, f AS fault FROM (SELECT k, unnest(list_filter([CASE WHEN k % 3 = 0 THEN 'untrimmed cell' END, CASE WHEN k % 4 = 0 THEN 'unknown kind' END, CASE WHEN k % 5 = 0 THEN 'error literal' END], lambda x: x IS NOT NULL)) AS f FROM (SELECT c_custkey AS k, c_name AS name, c_nationkey AS part FROM customer) named)
""")
def publication_contract(spark, sf_dir):
    """Faults of published glossary rows."""
    n = _named(spark, sf_dir)
    k = F.col("k")
    entry = F.struct(F.when(k % 3 == 0, " x").otherwise("x").alias("term"), F.when(k % 5 == 0, "#N/A").otherwise("").alias("definition"), F.lit("").alias("combined_definition"))
    p = n.select(F.lit("b").alias("book"), k.cast("int").alias("row"), F.when(k % 4 == 0, "verbs").otherwise("words").alias("kind"), F.col("name").alias("english"), F.lit("").alias("english_definition"), F.create_map(F.lit("French"), entry).alias("translations"))
    return validation.published_faults(p, ["French"]).select(F.regexp_replace("key", "^b#", "").alias("key"), "fault")


@query("""
SELECT k, 'é' || name AS repaired, 'a &lt; b &amp; <b>' || name || '</b>&amp;' AS escaped FROM (SELECT c_custkey AS k, c_name AS name, c_nationkey AS part FROM customer) named
""")
def text_repairs(spark, sf_dir):
    """Repaired encodings, and escapes that keep markup."""
    n = _named(spark, sf_dir)
    return n.select("k", tx.repair_mojibake(F.concat(F.lit("Ã©"), "name")).alias("repaired"), markup.escape_xml(F.concat(F.lit("a < b & <b>"), "name", F.lit("</b>&amp;"))).alias("escaped"))


from . import contract_queries, entry_queries, scale_queries  # noqa: E402, F401 - register their queries here
