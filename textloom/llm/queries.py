"""Queries of the training-data operators, and their SQL where it exists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .decontam import contamination
from .divergence import divergence
from .exact_index import exact_duplicates
from .minhash import near_duplicates
from .nbsvm import fit, score
from .pii import pseudonymise
from .poisson_mix import mix
from .quality_rules import quality
from .search import search
from .secrets import secret_spans
from .token_counts import token_counts
from .urlfilter import judge_urls
from .warc import read_archives, write_archives


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents at square-root source weights, as many rows as came in."""
    return mix(_read(spark, sf_dir, "documents"))


def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document at similarity 0.75 of five-word shingles."""
    return near_duplicates(_read(spark, sf_dir, "documents"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of every document. A source is an owner, its documents of
    one language are one of its repositories, and a value that an owner keeps
    in three or more of them is no live credential."""
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    documents = _read(spark, sf_dir, "documents").withColumn("repository", F.concat(blank("source"), F.lit("/"), blank("lang")))
    return secret_spans(documents, "repository", "source", live_repositories=2).drop("labels")


#: Ranks of the public byte-pair vocabulary, and an id above all of its own.
VOCABULARY, END_OF_DOCUMENT = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken", 50256


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, counted in flat token files."""
    return token_counts(_read(spark, sf_dir, "documents"), VOCABULARY, END_OF_DOCUMENT)


def surrogate_key(spark: SparkSession) -> str:
    """Key of the surrogates: the session's setting or, for the synthetic
    tables of tests and checks only, a public one."""
    return spark.conf.get("spark.textloom.surrogate.key", "synthetic tables only")


def op5_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with surrogates, and what was replaced."""
    new = pseudonymise(_read(spark, sf_dir, "documents"), surrogate_key(spark))
    return new.select("doc_id", "lang", "source", "text", F.size("pii").cast("long").alias("n_entities"), F.transform("pii", lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])).alias("entities"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learnt from labels not held out."""
    documents = _read(spark, sf_dir, "documents")
    return score(documents, fit(documents, _read(spark, sf_dir, "labels")))


# The rules that every page is judged by.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def listed_urls(pages: DataFrame) -> DataFrame:
    """URLs to block in all their spellings: those of pages whose html has a
    run of three symbols for each two hundred characters or fewer."""
    html = F.col("html").cast("string")
    junk = 200 * F.regexp_count(html, F.lit(r"[#*$%&]{3}")) >= F.length(html)
    return pages.where(junk & (F.length(html) > 0)).select("url", F.lit("block").alias("verdict"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page by the fixed rules and, where none fits, by the
    list of canonical URLs that the pages themselves give."""
    pages = _read(spark, sf_dir, "pages")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return judge_urls(pages, rules, listed_urls(pages))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows found in every document."""
    found = contamination(_read(spark, sf_dir, "documents").select("doc_id", "text"), _read(spark, sf_dir, "benchmark"))
    c = F.col("contamination")
    return found.select(
        "doc_id",
        c["n_words"].alias("n_words"),
        c["n_hit"].alias("n_hit"),
        F.size(c["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(c["items"]), ","), 256).alias("items_sha256"),
        (c["n_hit"] > 0).alias("contaminated"),
    )


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    judged = quality(_read(spark, sf_dir, "documents").select("doc_id", "lang", "text"))
    return judged.select("doc_id", "quality.*")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of all pages, read back from the archives they were written to."""
    records = read_archives(write_archives(_read(spark, sf_dir, "pages")))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty highest-scoring documents of every benchmark item."""
    return search(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources of each language against each other and the language."""
    return divergence(_read(spark, sf_dir, "documents"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row that stays for every document, by its whole normalised text."""
    return exact_duplicates(_read(spark, sf_dir, "documents"))


QUERIES = {
    "op1_poisson_mix": op1_poisson_mix,
    "op2_minhash_dedup": op2_minhash_dedup,
    "op3_secret_scan": op3_secret_scan,
    "op4_token_counts": op4_token_counts,
    "op5_pii_surrogates": op5_pii_surrogates,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_url_filter": op7_url_filter,
    "op8_decontamination": op8_decontamination,
    "op9_quality_rules": op9_quality_rules,
    "op10_warc": op10_warc,
    "op11_lexical_search": op11_lexical_search,
    "op12_source_divergence": op12_source_divergence,
    "op13_exact_dedup": op13_exact_dedup,
}

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["op1_poisson_mix"] = """
WITH sizes AS (
  SELECT source, count(*) AS n, pow(count(*)::DOUBLE, 0.5) AS w FROM documents GROUP BY source
), rate AS (
  SELECT source, w * (sum(n) OVER ()::DOUBLE / sum(w) OVER ()) / n AS rate FROM sizes
), span AS (
  SELECT source, rate, greatest(floor(rate - 12 * sqrt(rate) - 30), 0)::BIGINT AS first, ceil(rate + 12 * sqrt(rate) + 30)::BIGINT AS last FROM rate
), steps AS (
  SELECT source, rate, first, unnest(range(first, last + 1)) AS k FROM span
), cdf AS (
  SELECT source, first, k, sum(exp(k * ln(rate) - rate - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS c FROM steps
), lists AS (
  SELECT source, first, list(c) AS cs FROM cdf GROUP BY source, first
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, text, lang, source, n_chars) AS occurrence FROM documents
), drawn AS (
  SELECT d.*, ('0x' || substr(sha256('mix-1:' || coalesce(doc_id::VARCHAR, 'null') || ':' || coalesce(text, 'null') || ':' || coalesce(lang, 'null') || ':'
    || coalesce(d.source, 'null') || ':' || coalesce(n_chars::VARCHAR, 'null') || ':' || occurrence), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 AS u, first, cs
  FROM numbered d JOIN lists ON lists.source IS NOT DISTINCT FROM d.source
), counted AS (
  SELECT *, (first + len(list_filter(cs, lambda c: c <= u)))::BIGINT AS n_copies FROM drawn
)
SELECT doc_id, text, lang, source, n_chars, n_copies, unnest(range(1, n_copies + 1))::BIGINT AS copy FROM counted WHERE n_copies > 0
"""

ORACLE_SQL["op3_secret_scan"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, coalesce(source, '') AS owner, coalesce(source, '') || '/' || coalesce(lang, '') AS repo FROM documents
), hits AS (
  SELECT rid, owner, repo, 0 AS kind, regexp_split_to_array(text, p) AS pieces, regexp_extract_all(text, p, 0) AS ms, regexp_extract_all(text, p, 2) AS vs
  FROM docs, (SELECT '((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)' AS p)
  UNION ALL
  SELECT rid, owner, repo, 1, regexp_split_to_array(text, 'AKIA[A-Z0-9]+'), regexp_extract_all(text, 'AKIA[A-Z0-9]+'), regexp_extract_all(text, 'AKIA[A-Z0-9]+') FROM docs
  UNION ALL
  SELECT rid, owner, repo, 2, regexp_split_to_array(text, '[0-9a-f]{24,}'), regexp_extract_all(text, '[0-9a-f]{24,}'), regexp_extract_all(text, '[0-9a-f]{24,}') FROM docs
  UNION ALL
  SELECT rid, owner, repo, 3, regexp_split_to_array(text, '[A-Za-z0-9+/_-]{20,}'), regexp_extract_all(text, '[A-Za-z0-9+/_-]{20,}'), regexp_extract_all(text, '[A-Za-z0-9+/_-]{20,}') FROM docs
), parts AS (
  SELECT rid, owner, repo, kind, i, length(pieces[i]) AS lp, length(ms[i]) AS lm, vs[i] AS v
  FROM (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM hits WHERE len(ms) > 0)
), spans AS (
  SELECT rid, owner, repo, kind, lm, v,
    sum(lp + lm) OVER (PARTITION BY rid, kind ORDER BY i) - lm AS a, sum(lp + lm) OVER (PARTITION BY rid, kind ORDER BY i) AS b
  FROM parts
), base AS (
  SELECT * FROM spans WHERE (kind = 0 AND length(v) >= 6) OR (kind = 1 AND length(v) >= 20) OR kind = 2
), found AS (
  SELECT * FROM base UNION ALL
  SELECT * FROM spans s WHERE kind = 3 AND regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]')
    AND length(v) * length(v) >= 9 * list_sum(list_transform(list_distinct(string_split(v, '')), lambda c: (length(v) - length(replace(v, c, ''))) ** 2))
    AND 4 * len(regexp_extract_all(regexp_replace(v, '[+/_-]', '', 'g'), '[a-z]+|[A-Z]+|[0-9]+')) >= length(regexp_replace(v, '[+/_-]', '', 'g'))
    AND NOT EXISTS (SELECT 1 FROM base x WHERE x.rid = s.rid AND x.a < s.b AND x.b > s.a)
), owners AS (
  SELECT v, count(DISTINCT owner) AS owners, count(DISTINCT (owner, repo)) AS repos FROM found GROUP BY v
), shown AS (
  SELECT f.*, owners, repos, ['assign', 'access', 'hex', 'owned'][kind + 1] || ':' || a || ':' || b AS span FROM found f JOIN owners USING (v)
  WHERE kind < 3 OR (owners = 1 AND repos <= 2)
), per AS (
  SELECT rid, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
    string_agg(span, ',' ORDER BY a, kind) FILTER (kind < 3) AS base, string_agg(span, ',' ORDER BY a, kind) AS spans,
    count(*) FILTER (kind < 3 AND owners = 1 AND repos <= 2) AS n_live, count(*) FILTER (kind < 3 AND owners >= 3) AS n_copied,
    max(repos) FILTER (kind < 3) AS n_repositories
  FROM shown GROUP BY rid
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_copied, 0) AS n_copied,
  coalesce(n_repositories, 0) AS n_repositories
FROM docs LEFT JOIN per USING (rid)
"""

ORACLE_SQL["op7_url_filter"] = r"""
WITH rules(rh, rp, rv) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
parts AS (
  SELECT row_number() OVER () AS rid, page_id, url, html,
    CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), split AS (
  SELECT rid, page_id, url, html, translate(regexp_extract(coalesce(rest, ''), '\A[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(rest, ''), '\A[^/?#]*([^?#]*)', 1) AS path, regexp_extract(coalesce(rest, ''), '\A[^?#]*\?([^#]*)', 1) AS query FROM parts
), cut AS (
  SELECT *, regexp_replace(regexp_replace(host, '\A[^@]*@', ''), '\A(?:www\.)?(.*?)\.?(?::(?:80|443))?\z', '\1') AS plain,
    array_to_string(list_sort(list_filter(string_split(query, '&'), lambda q: q <> '' AND NOT regexp_matches(q, '(?i)\A(?:utm_[a-z]+|ref|fbclid|gclid|sessionid|sid)(?:=|\z)'))), '&') AS asked FROM split
), named AS (
  SELECT *, CASE WHEN instr(url, '://') > 0 THEN plain || CASE WHEN path = '' THEN '/' ELSE path END || CASE WHEN asked = '' THEN '' ELSE '?' || asked END END AS c FROM cut
), marked AS (
  SELECT DISTINCT c FROM named WHERE length(html) > 0 AND 200 * len(regexp_extract_all(html, '[#*$%&]{3}')) >= length(html)
), best AS (
  SELECT rid, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(rv, length(rh || rp)) AS rv
  FROM split JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY rid
)
SELECT page_id, host, path, rule, coalesce(rv, CASE WHEN marked.c IS NOT NULL THEN 'block' END, 'allow') AS verdict
FROM named LEFT JOIN best USING (rid) LEFT JOIN marked ON marked.c = named.c
"""

ORACLE_SQL["op10_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS top FROM
  (SELECT page_id, html, encode(html) AS b FROM p))
SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, sha1(html) AS payload_digest,
  CASE WHEN octet_length(b) >= 1000 AND page_id IS DISTINCT FROM top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN octet_length(b) >= 1000 AND page_id IS DISTINCT FROM top THEN top END AS refers_to
FROM m
"""

ORACLE_SQL["op2_minhash_dedup"] = r"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i : i + 4], chr(0)) AS g FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), link AS (
  SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)
), edge AS (
  SELECT a, b FROM link UNION SELECT b, a FROM link
), reach AS (
  SELECT a AS node, a AS other FROM edge UNION SELECT node, edge.b FROM reach JOIN edge ON edge.a = other
), comp AS (
  SELECT node, min(other) AS component FROM reach GROUP BY node
)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component, w.doc_id) AS component_id, w.doc_id = coalesce(component, w.doc_id) AS kept
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN comp ON comp.node = w.doc_id
"""

_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+')"

ORACLE_SQL["op8_decontamination"] = f"""
WITH b AS (
  SELECT item_id, {_WORDS} AS ws FROM benchmark
), win AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS width, array_to_string(ws[i : i + least(len(ws), 10) - 1], ' ') AS g
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM b WHERE len(ws) > 0)
), d AS (
  SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS ws FROM documents
), hit AS (
  SELECT rid, i, width, item_id FROM (
    SELECT rid, i, width, array_to_string(ws[i : i + width - 1], ' ') AS g
    FROM (SELECT rid, ws, width, unnest(range(1, len(ws) - width + 2)) AS i FROM d, (SELECT DISTINCT width FROM win) WHERE len(ws) >= width)
  ) JOIN win USING (width, g)
), words AS (
  SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + width)) AS p FROM hit) GROUP BY rid
), items AS (
  SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT rid, item_id::VARCHAR AS item_id FROM hit) GROUP BY rid
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL["op11_lexical_search"] = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_LOWER}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS ws FROM documents
), total AS (
  SELECT count(*)::BIGINT AS N, sum(len(ws))::BIGINT AS L FROM d WHERE len(ws) > 0
), m AS (
  SELECT rid, doc_id, ws, 75 + (25 * len(ws) * N) // L AS m FROM d, total WHERE len(ws) > 0
), asked AS (
  SELECT iid, item_id, t, count(*)::BIGINT AS q FROM (
    SELECT row_number() OVER () AS iid, item_id, unnest(regexp_extract_all({_LOWER}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')) AS t FROM benchmark) GROUP BY ALL
), held AS (
  SELECT rid, t, count(*)::BIGINT AS tf FROM (SELECT rid, unnest(ws) AS t FROM m) WHERE t IN (SELECT t FROM asked) GROUP BY ALL
), weights AS (
  SELECT t, floor(1000 * ln((2 * N + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM (SELECT t, count(*) AS df FROM held GROUP BY t), total
), scored AS (
  SELECT iid, item_id, doc_id, sum(q * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM asked JOIN held USING (t) JOIN weights USING (t) JOIN m USING (rid) GROUP BY iid, item_id, rid, doc_id
)
SELECT item_id, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 20
"""

ORACLE_SQL["op12_source_divergence"] = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all({_LOWER}, '[a-z\\x{{80}}-\\x{{10FFFF}}]+') AS ws FROM documents
), tf AS (
  SELECT rid, lang, source, t, count(*) AS n FROM (SELECT rid, lang, source, unnest(ws) AS t FROM d) GROUP BY ALL
), kept AS (
  SELECT lang, t, sum(n) AS n FROM tf GROUP BY lang, t HAVING count(*) >= 3
), lg AS (
  SELECT lang, count(*) AS V, sum(n) AS N FROM kept GROUP BY lang
), grp AS (
  SELECT lang, source, t, sum(tf.n) AS n FROM tf JOIN kept USING (lang, t) GROUP BY ALL
), g AS (
  SELECT lang, source, coalesce(N, 0) AS N FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN (SELECT lang, source, sum(n) AS N FROM grp GROUP BY ALL) USING (lang, source)
), p AS (
  SELECT g.lang, g.source, kept.t, 1 + (1000000000::HUGEINT * (coalesce(grp.n, 0) + 1)) // (g.N + lg.V) AS p, coalesce(grp.n, 0) AS own,
    1 + (1000000000::HUGEINT * (kept.n + 1)) // (lg.N + lg.V) AS q
  FROM g JOIN lg USING (lang) JOIN kept USING (lang) LEFT JOIN grp ON grp.lang = g.lang AND grp.source = g.source AND grp.t = kept.t
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.t = b.t AND a.source <> b.source GROUP BY ALL
), parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL
  SELECT lang, source, 'term', t, (((p - q) * (p - q)) // q)::BIGINT FROM p WHERE own > 0 AND p > q
)
SELECT lang, source, part, item, value, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
FROM parts QUALIFY part = 'pair' OR rank <= 200
"""

ORACLE_SQL["op13_exact_dedup"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
), w AS (
  SELECT doc_id, sha256(t) AS text_sha256, count(*) OVER (PARTITION BY t) AS group_size,
    first_value(doc_id) OVER (PARTITION BY t ORDER BY doc_id, rid) AS keep_id, row_number() OVER (PARTITION BY t ORDER BY doc_id, rid) = 1 AS kept FROM d
)
SELECT doc_id, keep_id, group_size, kept, text_sha256, 1 AS chain FROM w
"""
