"""Registered queries of operators that no other query reaches: JSON files,
pending units, repeated keys, cells, patterns, exclusions, catalogs."""

from __future__ import annotations

from pyspark.sql import functions as F

from .contract_queries import _layout, cat, every
from .functions import text as tx
from .operators import audit, ledger, relational
from .queries import _stories, query, table
from .sources import file_sets, files, packages, sheet_source, workbooks


@query("SELECT c_custkey AS k, c_name AS name, c_nationkey AS nation FROM customer")
def json_documents(spark, sf_dir):
    """Customers as JSON files, one for each nation, every second with a
    byte-order mark, written by tasks and read with a schema."""
    c = table(spark, sf_dir, "customer")
    item = F.struct(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"))
    each = c.groupBy("c_nationkey").agg(F.to_json(F.collect_list(item)).alias("body"))
    folder = files.shared_folder(spark, "json")
    mark = F.when(every(F.col("c_nationkey"), 2), "\ufeff").otherwise("")
    files.write_files(each.select(cat("n", F.col("c_nationkey"), ".json").alias("name"), F.encode(F.concat(mark, "body"), "UTF-8").alias("content")), folder)
    return files.json_table(spark, folder, "k long, name string, nation int")


def _units(spark, sf_dir):
    k = F.col("c_custkey")
    known = F.create_map(F.lit("French"), F.when(every(k, 4), " ").otherwise(cat("t", k)))
    kind = F.when(every(k, 3), "sourceCode").otherwise("prose")
    unit = F.struct(k.alias("n"), cat("u", k).alias("id"), kind.alias("kind"), F.col("c_name").alias("plain"), F.when(every(k, 5), F.create_map().cast("map<string,string>")).otherwise(known).alias("translations"))
    in_order = lambda units: F.array_sort(units, lambda a, b: F.when(a["n"] < b["n"], -1).otherwise(1))
    units = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").cast("string").alias("file")).agg(in_order(F.collect_list(unit)).alias("units"))
    return ledger.exploded_units(units.withColumn("book", F.lit("b")))


@query("""
SELECT c_nationkey::VARCHAR AS file, 'u' || c_custkey AS id, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS pos FROM customer
QUALIFY c_custkey % 3 <> 0 AND (c_custkey % 4 = 0 OR c_custkey % 5 = 0)
""")
def ledger_pending(spark, sf_dir):
    """Prose units that have no French text yet, blank ones included."""
    return ledger.pending_units(_units(spark, sf_dir), " French ").select("file", "id", F.col("pos").cast("long").alias("pos"))


@query("SELECT user_id, count(*) AS n FROM events GROUP BY 1 HAVING count(*) > 1 ORDER BY 1 LIMIT 20")
def first_duplicates(spark, sf_dir):
    """The first twenty keys that repeat: the limit is the feature."""
    return relational.duplicates(table(spark, sf_dir, "events"), "user_id")


@query("""
SELECT c_custkey AS k, CASE c_custkey % 5 WHEN 0 THEN c_name || '!' WHEN 1 THEN c_name WHEN 2 THEN c_custkey::VARCHAR WHEN 3 THEN '' ELSE c_name END AS flat FROM customer
""")
def rich_cells(spark, sf_dir):
    """Cells of rich text, links, formulas and plain text as flat texts."""
    c = table(spark, sf_dir, "customer")
    k, name = F.col("c_custkey"), F.col("c_name")
    runs = F.to_json(F.struct(F.array(F.struct(name.alias("text")), F.struct(F.lit(None).cast("string").alias("text")), F.struct(F.lit("!").alias("text"))).alias("richText")))
    link = F.to_json(F.struct(name.alias("text"), F.lit("http://x").alias("hyperlink")))
    formula = F.to_json(F.struct(F.lit("A1+1").alias("formula"), k.alias("result")))
    cell = F.when(every(k, 5), runs).when(every(k, 5, 1), link).when(every(k, 5, 2), formula).when(every(k, 5, 3), F.lit(None).cast("string")).otherwise(name)
    return c.select(k.alias("k"), workbooks.rich_text(cell).alias("flat"))


@query("""
SELECT c_custkey AS k, CASE c_custkey % 4 WHEN 0 THEN 'Headquarters and Support 3rd Bn' WHEN 1 THEN '3rd Bn' WHEN 2 THEN 'Headquarters  3rd Bn' ELSE '3rd Bn' END AS official,
  '3rd Bn' AS other FROM customer
""")
def qualified_patterns(spark, sf_dir):
    """What an abbreviated unit's pattern takes with its qualifier, and what
    the same pattern of another rule takes."""
    k = F.col("c_custkey")
    head = F.when(every(k, 4), "Headquarters and Support ").when(every(k, 4, 1), "Main headquarters ").when(every(k, 4, 2), "the Headquarters  ").otherwise("xHeadquarters ")
    t = cat(head, "3rd Bn of ", F.col("c_name"))
    found = lambda rule: F.regexp_extract(t, relational.effective_pattern(rule, "[0-9](?:st|nd|rd|th) Bn"), 0)
    return table(spark, sf_dir, "customer").select(k.alias("k"), found(relational.QUALIFIED_RULE).alias("official"), found("other_rule").alias("other"))


_AT = "regexp_matches(coalesce(text, ''), '(?i)(^|[^A-Za-z0-9_]){}($|[^A-Za-z0-9_])')"


@query(f"SELECT doc_id, {_AT.format('license')} AS license, {_AT.format('the')} AS the_, {_AT.format('st')} AS st FROM documents")
def term_containment(spark, sf_dir):
    """Whether each document has a term between ASCII boundaries."""
    has = lambda t: tx.contains_term(F.col("text"), F.lit(t))
    return table(spark, sf_dir, "documents").select("doc_id", has("License").alias("license"), has("the").alias("the_"), has("ST").alias("st"))


@query("""
WITH r AS (SELECT unnest(range(1, 10)) AS rule)
SELECT 'r' || rule AS rule, count(l_orderkey) AS scopes, coalesce(sum(CASE WHEN l_partkey % 5 = 0 THEN 0 ELSE l_quantity::BIGINT END), 0)::BIGINT AS matches,
  coalesce(sum(CASE WHEN l_partkey % 5 = 0 THEN 0 ELSE l_quantity::BIGINT // 2 END), 0)::BIGINT AS changes, coalesce(sum(CASE WHEN l_partkey % 5 = 0 THEN l_quantity::BIGINT ELSE 0 END), 0)::BIGINT AS excluded
FROM r LEFT JOIN lineitem ON l_linenumber = rule GROUP BY rule
""")
def rule_exclusions(spark, sf_dir):
    """Scopes, matches, changes and excluded matches of each rule, rules
    without any included; a protected scope's matches are excluded."""
    n, free = F.col("l_quantity").cast("long"), ~every(F.col("l_partkey"), 5)
    ran = table(spark, sf_dir, "lineitem").select(cat("r", F.col("l_linenumber")).alias("rule"), F.when(free, n).otherwise(0).alias("matches"), F.when(free, F.floor(n / 2)).otherwise(0).alias("changes"), F.when(free, 0).otherwise(n).alias("excluded"))
    rules = spark.range(1, 10).select(cat("r", F.col("id")).alias("rule"))
    return audit.rule_totals(rules, ran).select("rule", "scopes", "matches", "changes", "excluded")


@query("""
SELECT c_custkey AS format_id, CASE WHEN c_custkey % 6 = 0 THEN 'protected' WHEN c_custkey % 6 = 1 THEN 'shared with protected content' WHEN c_custkey % 4 = 3 THEN 'no template for this format' WHEN c_custkey % 7 = 0 THEN 'count of blocks differs'
  WHEN c_custkey % 11 = 0 THEN 'structure differs' WHEN c_custkey % 4 IN (0, 2) AND c_custkey % 3 <> 1 THEN 'structure differs' WHEN c_custkey % 5 = 0 THEN 'edit' ELSE 'keep' END AS action FROM customer
""")
def layout_delimiters(spark, sf_dir):
    """Actions where blocks say whether they include their delimiter: only
    those that say "false" keep their structure."""
    k = F.col("format_id")
    return _layout(spark, sf_dir, F.when(every(k, 3), "true").when(every(k, 3, 1), "false"))[0].select("format_id", "action")


@query("""
SELECT 'm' || c_custkey AS slug, CASE WHEN c_custkey % 6 = 0 THEN 'absent' WHEN c_custkey % 6 = 1 THEN 'repeated' WHEN c_custkey % 6 = 2 THEN 'hidden' WHEN c_custkey % 6 = 3 THEN 'superseded' ELSE 'chosen' END AS state FROM customer
""")
def catalog_choices(spark, sf_dir):
    """Whether the one entry of each name may be taken from a catalog."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    name = cat("m", k).alias("slug")
    times = F.when(every(k, 6), F.array().cast("array<int>")).when(every(k, 6, 1), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    catalog = c.select(name, F.when(every(k, 6, 2), "hide").otherwise("list").alias("visibility"), F.when(every(k, 6, 3), "m9").alias("upgrade"), F.explode(times))
    return relational.catalog_choice(catalog.drop("col"), c.select(name))


@query("""
SELECT c_custkey // 500 AS book, c_custkey % 500 + 2 AS "row", 2 AS "column", 'text' AS kind, c_name AS value FROM customer WHERE c_custkey % 500 < 399 AND (c_custkey // 500) % 3 <> 2
UNION ALL SELECT c_custkey // 500, c_custkey % 500 + 2, 1, 'text', 'p' || c_custkey FROM customer WHERE c_custkey % 500 < 399 AND (c_custkey // 500) % 3 <> 2
""")
def sheet_cells(spark, sf_dir):
    """Cells of the first 400 rows of the sheets of one name, in workbooks that
    tasks wrote; the name and the bound reach the source."""
    from .contract_queries import _bound
    from .sources.sheet_source import sheets

    k = F.col("c_custkey")
    books = _bound(table(spark, sf_dir, "customer"), 500, "c_custkey", cat("p", k), F.col("c_name"))
    folder = files.shared_folder(spark, "sheets")
    head = F.array(F.array(F.lit("id"), F.lit("name")))
    for name, at in (("Sheet1", [0, 1]), ("Other", [2])):
        made = books.where((F.col("book") % 3).isin(at)).select(cat("book_", F.col("book"), ".xlsx").alias("name"), F.concat(head, "rows").alias("rows"))
        workbooks.write_workbooks(made, folder, sheet=name)
    found = sheets(spark, folder).where("sheet = 'Sheet1' AND row <= 400 AND row > 1")
    return found.select(F.regexp_extract("path", "book_([0-9]+)", 1).cast("long").alias("book"), F.col("row").cast("long").alias("row"), "column", "kind", "value")


# --- packages ---------------------------------------------------------------

_STORY = """'<Story><ParagraphStyleRange id="' || printf('%05d', k * 2) || '" AppliedParagraphStyle="ParagraphStyle/Body"><Content id="' || printf('%05d', k * 4) || '">' || k || ' km &amp; 3 + 4</Content><Content id="' || printf('%05d', k * 4 + 1) || '" /></ParagraphStyleRange><ParagraphStyleRange id="' || printf('%05d', k * 2 + 1) || '" AppliedParagraphStyle="ParagraphStyle/Body"><Content id="' || printf('%05d', k * 4 + 2) || '">' || name || '</Content><Content id="' || printf('%05d', k * 4 + 3) || '" /></ParagraphStyleRange></Story>'"""


@query(f"""
WITH n AS (SELECT c_custkey AS k, c_name AS name FROM customer), s AS (SELECT name, sha256({_STORY}) AS h FROM n),
c AS (SELECT k * 4 AS r, printf('%05d', k * 2) || '|' || k || ' km &amp; 3 + 4|' || printf('%05d', k * 4) || '|' || k || ' km &amp; 3 + 4' AS v FROM n
  UNION ALL SELECT k * 4 + 1, '||' || printf('%05d', k * 4 + 1) || '|' FROM n
  UNION ALL SELECT k * 4 + 2, printf('%05d', k * 2 + 1) || '|' || name || '|' || printf('%05d', k * 4 + 2) || '|' || name FROM n
  UNION ALL SELECT k * 4 + 3, '||' || printf('%05d', k * 4 + 3) || '|' FROM n)
SELECT 'story' AS part, 'Text/' || name || '.icml' AS name, h AS value FROM s
UNION ALL SELECT 'member', 'Text/' || name || '.icml', h FROM s
UNION ALL SELECT 'row', (r + 1)::VARCHAR, v FROM c
""")
def source_package(spark, sf_dir):
    """A package of all customers' stories, published by tasks and read back:
    hashes of the stories and of the archives' members, rows of the workbooks."""
    folder = files.shared_folder(spark, "package")
    packages.build_package(_stories(spark, sf_dir), folder, volume=1 << 20, sheet_rows=20_000)
    found = file_sets.set_files(spark, folder, archives=r"\.zip$", only="name like 'Text/%' or name like '%.zip'")
    story = F.col("member").isNull()
    hashes = found.where("error is null and (member is not null or name like 'Text/%')").select(F.when(story, "story").otherwise("member").alias("part"), F.coalesce("member", "name").alias("name"), F.sha2("content", 256).alias("value"))
    return hashes.union(_package_rows(spark, folder))


def _package_rows(spark, folder):
    """(part, name, value) of the content rows of a package's workbooks."""
    books = {r.sha: r.name for r in file_sets.set_entries(spark, folder).where("name like '%.xlsx'").collect()}
    number = F.regexp_extract(F.create_map(*(F.lit(x) for pair in books.items() for x in pair))[F.element_at(F.split("path", "/"), -1)], "-([0-9]+)[.]xlsx", 1)
    nth = F.when(number == "", 0).otherwise(number.try_cast("long") - 1)
    cells = sheet_source.sheets(spark, f"{folder}/data", names=list(books)).where("error is null and row > 1")
    at = [F.coalesce(F.max(F.when(F.col("column") == i, F.col("value"))), F.lit("")) for i in (1, 2, 3, 4)]
    rows = cells.groupBy((nth * 20_000 + F.col("row") - 1).alias("n")).agg(F.concat_ws("|", *at).alias("value"))
    return rows.select(F.lit("row").alias("part"), F.col("n").cast("string").alias("name"), "value")
