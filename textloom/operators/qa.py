"""Quality checks of a translated table against its source, as issue rows.

Source and output are content tables; ``paired`` joins them by position once,
and all row rules are evaluated in that single pass as an array of issues, so
a table of any size costs one join and one scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import markup
from ..functions.text import boundary_whitespace, content_id, count_exact, is_blank, same_breaks, text, trim
from ..functions.typography import is_untidy, normalise_by
from .glossary import contains_target
from .segments import composites

# Severity and column of each row rule.
RULES = {
    "MISSING_CONTENT_ID": ("error", 3),
    "DUPLICATE_CONTENT_ID": ("error", 3),
    "PROTECTED_FIELD_CHANGED": ("error", 1),
    "PANEL_REFERENCE_CACHE_CHANGED": ("error", 4),
    "PROTECTED_SOURCE_TEXT_CHANGED": ("error", 4),
    "BLANK_TRANSLATION": ("error", 4),
    "PROCESSING_INSTRUCTION_CHANGED": ("error", 4),
    "MARKUP_CHANGED": ("error", 4),
    "LINE_BREAK_CHANGED": ("error", 4),
    "BOUNDARY_WHITESPACE_CHANGED": ("error", 4),
    "DOUBLE_ESCAPED_ENTITY": ("error", 4),
    "UNCHANGED_SOURCE_TEXT": ("warning", 4),
    "EDITORIAL_TYPOGRAPHY": ("error", 4),
    "BOOK_INSTRUCTION_FORBIDDEN_TARGET": ("error", 4),
    "BOOK_SOURCE_NAME_CHANGED": ("error", 4),
    "GLOSSARY_TABLE_ROW_MISMATCH": ("error", 4),
    "GLOSSARY_TARGET_MISSING": ("error", 4),
    "COMPOSITE_MISMATCH": ("error", 2),
}
TAG_COLUMN = 3
UNCHANGED_LEAST, UNCHANGED_SHARE = 10, 0.2


def paired(source: DataFrame, output: DataFrame, keys: Sequence[str], protected: DataFrame | None = None, panel: DataFrame | None = None) -> DataFrame:
    """Positional join over the common rows, with the normalised id, the row
    that had it first, and the protected and panel texts."""
    cells = ["psr_id", "psr_content", "content_tag", "content"]
    s = source.select(*keys, "row_no", *(text(F.col(c)).alias(f"s_{c}") for c in cells))
    o = output.select(*keys, "row_no", *(text(F.col(c)).alias(f"o_{c}") for c in cells))
    both = s.join(o, [*keys, "row_no"]).withColumn("content_id", content_id(F.col("s_content_tag")))
    # Rows without an id are groups of one, so that they are no hot group.
    alone = F.when(F.col("content_id") == "", F.col("row_no"))
    first = F.min("row_no").over(W.partitionBy(*keys, "content_id", alone))
    both = both.withColumn("first_row", F.when(F.col("content_id") != "", first))
    none = F.lit(None).cast("string")
    if protected is not None:
        both = both.join(protected.select(content_id(F.col("content_id")).alias("content_id"), F.lit(True).alias("is_protected")).distinct(), "content_id", "left")
    else:
        both = both.withColumn("is_protected", F.lit(False))
    if panel is not None:
        both = both.join(panel.select(content_id(F.col("content_id")).alias("content_id"), F.col("text").alias("panel_text")), "content_id", "left")
    else:
        both = both.withColumn("panel_text", none)
    return both.withColumn("is_protected", F.coalesce("is_protected", F.lit(False)))


def eligible(pairs: DataFrame, phrases: Sequence[str] = ()) -> Column:
    """To be translated: neither protected nor from the panel, and at least
    four visible letters outside protected phrases."""
    seen = F.col("s_content")
    for p in phrases:
        seen = F.regexp_replace(seen, p, " ")
    return ~F.col("is_protected") & F.col("panel_text").isNull() & (F.length(markup.visible_letters(seen)) >= 4)


def row_issues(pairs: DataFrame, keys: Sequence[str] = (), language: str | Column | None = None, forbidden: Sequence[tuple[str, str, str]] = (), preserved: Sequence[tuple[str, str]] = (), languages: Sequence[str] | None = None) -> DataFrame:
    """Issues of all rules that look at one row pair. ``language`` is a name, or
    a column of names, of which ``languages`` may list those that occur; rows of
    an unknown one have no typography rule."""
    s, o = F.col("s_content"), F.col("o_content")
    free = ~F.col("is_protected") & F.col("panel_text").isNull()
    # Inventories are taken of texts that differ only, and letters are counted
    # of texts that do not.
    differ = s != o
    checks: list[tuple] = [  # code, condition, message, and a column other than the rule's
        ("MISSING_CONTENT_ID", F.col("content_id") == "", F.lit("row has no content id")),
        ("DUPLICATE_CONTENT_ID", F.col("first_row") < F.col("row_no"), F.concat(F.lit("content id of row "), F.col("first_row").cast("string"))),
        ("PROTECTED_FIELD_CHANGED", F.col("s_psr_id") != F.col("o_psr_id"), F.lit("paragraph id differs")),
        ("PROTECTED_FIELD_CHANGED", F.col("s_content_tag") != F.col("o_content_tag"), F.lit("content tag differs"), TAG_COLUMN),
        ("PANEL_REFERENCE_CACHE_CHANGED", F.col("panel_text").isNotNull() & (o != F.col("panel_text")), F.lit("generated reference text differs")),
        ("PROTECTED_SOURCE_TEXT_CHANGED", F.col("is_protected") & (s != o), F.lit("protected text differs")),
        ("BLANK_TRANSLATION", ~is_blank(s) & is_blank(o), F.lit("translation is blank")),
        ("PROCESSING_INSTRUCTION_CHANGED", differ & (s.contains("<?") | o.contains("<?")) & (markup.instructions(s) != markup.instructions(o)), F.lit("processing instructions differ")),
        ("MARKUP_CHANGED", differ & (s.contains("<") | o.contains("<")) & (markup.tags(s) != markup.tags(o)), F.lit("markup elements differ")),
        ("LINE_BREAK_CHANGED", differ & ~same_breaks(s, o), F.lit("line breaks differ")),
        ("BOUNDARY_WHITESPACE_CHANGED", differ & (boundary_whitespace(s) != boundary_whitespace(o)), F.lit("outer white space differs")),
        ("DOUBLE_ESCAPED_ENTITY", o.contains("&") & markup.double_escaped(o), F.lit("entity is escaped twice")),
        ("UNCHANGED_SOURCE_TEXT", (trim(s) == trim(o)) & eligible(pairs, [p for _, p in preserved]), F.lit("text is unchanged")),
    ]
    if language is not None:
        untidy = normalise_by(o, language, languages) != o if isinstance(language, Column) else is_untidy(o, language)
        checks.append(("EDITORIAL_TYPOGRAPHY", free & untidy, F.lit("typography differs from the language's")))
    for rule, pattern, message in forbidden:
        checks.append(("BOOK_INSTRUCTION_FORBIDDEN_TARGET", free & o.rlike(pattern), F.lit(message or f"forbidden by {rule}")))
    for rule, pattern in preserved:
        phrases = F.array_distinct(F.regexp_extract_all(s, F.lit(pattern), F.lit(0)))
        changed = F.exists(phrases, lambda p: count_exact(o, p) != F.size(F.filter(F.regexp_extract_all(s, F.lit(pattern), F.lit(0)), lambda q: q == p)))
        checks.append(("BOOK_SOURCE_NAME_CHANGED", free & changed, F.lit(f"protected name of {rule} differs")))
    made = [
        F.when(bad, F.struct(F.lit(RULES[code][0]).alias("severity"), F.lit(column[0] if column else RULES[code][1]).alias("column_no"), F.lit(code).alias("code"), message.alias("message")))
        for code, bad, message, *column in checks
    ]
    found = pairs.select(*keys, "row_no", F.col("s_content_tag").alias("content_id"), F.explode(F.filter(F.array(*made), lambda x: x.isNotNull())).alias("i"))
    return found.select(*keys, "row_no", "i.column_no", "content_id", "i.severity", "i.code", "i.message")


def composite_issues(source: DataFrame, output: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Group heads whose composite is not the text of the group's rows."""
    bounds = source.select(*keys, "row_no", F.col("psr_id").alias("_id"), text(F.col("content_tag")).alias("_tag"))
    rows = output.drop("psr_id").join(bounds, [*keys, "row_no"]).withColumnRenamed("_id", "psr_id")
    made = composites(rows, keys)
    heads = rows.select(*keys, F.col("row_no").alias("start_row"), text(F.col("psr_content")).alias("stated"), "_tag")
    wrong = made.join(heads, [*keys, "start_row"]).where("stated <> composite")
    return wrong.select(*keys, F.col("start_row").alias("row_no"), F.lit(2).alias("column_no"), F.col("_tag").alias("content_id"), F.lit("error").alias("severity"), F.lit("COMPOSITE_MISMATCH").alias("code"), F.lit("composite differs from its segments").alias("message"))


def glossary_issues(matched: DataFrame, compiled: DataFrame, language: str, keys: Sequence[str] = ()) -> DataFrame:
    """Missing targets: ``matched`` has o_content, content_id and matches."""
    each = matched.select(*keys, "row_no", "content_id", "o_content", F.explode("matches").alias("m")).withColumn("source", F.col("m.source"))
    known = each.join(compiled.select("source", "target", "kind"), "source")
    gone = known.where(~contains_target(F.col("o_content"), F.col("target"), F.col("kind"), language))
    message = F.concat(F.lit("expected "), F.col("target"), F.lit(" for "), F.col("source"))
    return gone.select(*keys, "row_no", F.lit(4).alias("column_no"), "content_id", F.lit("error").alias("severity"), F.lit("GLOSSARY_TARGET_MISSING").alias("code"), message.alias("message"))


def coverage_of(pairs: DataFrame, keys: Sequence[str] = (), phrases: Sequence[str] = ()) -> DataFrame:
    """(eligible, unchanged, share, low): how much text stayed unchanged."""
    can = eligible(pairs, phrases)
    same = can & (trim(F.col("s_content")) == trim(F.col("o_content")))
    out = pairs.groupBy(*keys).agg(F.count_if(can).alias("eligible"), F.count_if(same).alias("unchanged"))
    share = F.coalesce(F.try_divide("unchanged", "eligible"), F.lit(0.0))
    return out.withColumn("share", share).withColumn("low", (F.col("unchanged") >= UNCHANGED_LEAST) & (share >= UNCHANGED_SHARE))


def table_issues(source: DataFrame, output: DataFrame, pairs: DataFrame, expected_rows: int | None = None, expected_ids: int | None = None, phrases: Sequence[str] = ()) -> DataFrame:
    """Issues of whole tables: counts and coverage, without a row."""
    parts = [
        source.agg(F.count("*").alias("n_source")),
        output.agg(F.count("*").alias("n_output")),
        pairs.agg(F.countDistinct(F.nullif("content_id", F.lit(""))).alias("n_ids")),
        coverage_of(pairs, (), phrases),
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    facts = rows.agg(*(F.max(c).alias(c) for c in rows.columns))
    say = lambda bad, code, text_: F.when(bad, F.struct(F.lit(code).alias("code"), text_.alias("message")))
    checks = [
        say(F.col("n_source") == 0, "WORKBOOK_EMPTY", F.lit("no data rows")),
        say(F.col("n_source") != F.col("n_output"), "ROW_COUNT_CHANGED", F.concat_ws(" ", F.lit("rows:"), "n_source", F.lit("to"), "n_output")),
        say(F.col("low"), "TRANSLATION_COVERAGE_LOW", F.concat_ws(" ", "unchanged", F.lit("of"), "eligible", F.lit("unchanged"))),
        say(F.lit(expected_rows is not None) & (F.col("n_source") != F.lit(expected_rows or 0)), "EXPORT_ROW_COUNT_MISMATCH", F.concat_ws(" ", F.lit("rows:"), "n_source")),
        say(F.lit(expected_ids is not None) & (F.col("n_ids") != F.lit(expected_ids or 0)), "EXPORT_CONTENT_ID_COUNT_MISMATCH", F.concat_ws(" ", F.lit("ids:"), "n_ids")),
    ]
    found = facts.select(F.explode(F.filter(F.array(*checks), lambda x: x.isNotNull())).alias("i"))
    return found.select(F.lit(None).cast("long").alias("row_no"), F.lit(None).cast("int").alias("column_no"), F.lit("").alias("content_id"), F.lit("error").alias("severity"), "i.code", "i.message")


def row_mismatches(rows: DataFrame, table: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Rows (row_no, content_id, content, o_content) whose source is a two-cell
    glossary row and whose output is not that row as the glossary has it."""
    from .glossary import expected_table_rows

    wrong = expected_table_rows(rows, table).where("expected is not null and expected <> o_content")
    return wrong.select(*keys, "row_no", F.lit(4).alias("column_no"), "content_id", F.lit("error").alias("severity"), F.lit("GLOSSARY_TABLE_ROW_MISMATCH").alias("code"), F.lit("row differs from the glossary's").alias("message"))


def policy_issues(jobs: DataFrame, policy_sha256: str) -> DataFrame:
    """Issues of jobs (job_id, prepared_sha256, reviewed_sha256) that were
    prepared under another policy, or whose review under the present one is
    not complete. Jobs prepared without a policy have none."""
    say = lambda bad, code, words: F.when(bad, F.struct(F.lit(code).alias("code"), F.lit(words).alias("message")))
    prepared = F.col("prepared_sha256").isNotNull()
    checks = F.array(
        say(prepared & (F.col("prepared_sha256") != policy_sha256), "EDITORIAL_POLICY_CHANGED", "the policy changed since the review was prepared"),
        say(prepared & ~F.col("reviewed_sha256").eqNullSafe(F.lit(policy_sha256)), "EDITORIAL_REVIEW_INCOMPLETE", "no complete review under the present policy"),
    )
    return jobs.select("job_id", F.explode(F.array_compact(checks)).alias("i")).select("job_id", F.lit("error").alias("severity"), "i.code", "i.message")


def totals(issues: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return issues.groupBy(*keys).agg(F.count_if(F.col("severity") == "error").alias("errors"), F.count_if(F.col("severity") == "warning").alias("warnings"), F.count("*").alias("total"))


def retained(issues: DataFrame, most: int, keys: Sequence[str], order: str = "ord") -> DataFrame:
    """At most ``most`` issues per key, with their ``slot``: the first ones,
    except that the k-th later error takes the slot of the k-th last warning
    among these."""
    by = W.partitionBy(*keys).orderBy(order)
    ranked = issues.withColumn("slot", F.row_number().over(by))
    head, late = ranked.where(F.col("slot") <= most), ranked.where((F.col("slot") > most) & (F.col("severity") == "error"))
    head = head.withColumn("k", F.when(F.col("severity") == "warning", F.row_number().over(W.partitionBy(*keys, "severity").orderBy(F.col(order).desc()))))
    late = late.withColumn("k", F.row_number().over(by))
    cols = [*keys, *[c for c in issues.columns if c not in keys]]
    taken = late.drop("slot").join(head.where("k is not null").select(*keys, "k", "slot"), [*keys, "k"]).select(*cols, "slot")
    kept = head.join(late.select(*keys, "k"), [*keys, "k"], "left_anti")
    return kept.select(*cols, "slot").unionByName(taken)


def report_lines(issues: DataFrame, most: int = 250, order: str = "ord") -> DataFrame:
    """Text report: one line for each of the first issues."""
    place = F.concat_ws(", ", F.when(F.col("row_no").isNotNull(), F.concat(F.lit("row "), F.col("row_no"))), F.when(F.col("column_no").isNotNull(), F.concat(F.lit("column "), F.col("column_no"))), F.when(F.col("content_id") != "", F.concat(F.lit("id "), F.col("content_id"))))
    line = F.concat(F.lit("["), F.upper("severity"), F.lit("] "), F.col("code"), F.when(place != "", F.concat(F.lit(" ("), place, F.lit(")"))).otherwise(F.lit("")), F.lit(": "), F.col("message"))
    return issues.orderBy(order).limit(most).select(order, line.alias("line"))


def status(errors: int, evidence_current: bool = False) -> str:
    """Status after a check."""
    return "qa_failed" if errors else "imported" if evidence_current else "ready_for_import"
