"""Audit lines, completeness of inventories, layout plans and templates."""

from __future__ import annotations

from collections.abc import Sequence
from xml.etree import ElementTree

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import NBSP, NARROW, escape_regex, text

# Cross-reference templates of each language.
TEMPLATES = {
    "English": ('(See <fullPara delim=":" />, Pg.^S<pageNum />.)', "(See <paraText />, Pg.^S<pageNum />.)", '<fullPara delim=":" />:'),
    "French": ("(consulter l'<fullPara delim=\":\" />, p.^S<pageNum />)", f"(consulter «{NARROW}<paraText />{NARROW}», p.^S<pageNum />)", f'<fullPara delim=":" />{NARROW}:'),
    "German": ('(Siehe <fullPara delim=":" />, S.^S<pageNum />.)', "(Siehe <paraText />, S.^S<pageNum />.)", '<fullPara delim=":" />:'),
    "Spanish": ('(Ver <fullPara delim=":" />, pág.^S<pageNum />)', "(Ver <paraText />, pág.^S<pageNum />)", '<fullPara delim=":" />:'),
    "Portuguese": ('(Consulte a <fullPara delim=":" />, P.^S<pageNum />.)', "(Consulte <paraText />, P.^S<pageNum />.)", '<fullPara delim=":" />:'),
    "Dutch": ('(Zie <fullPara delim=":" />, p.^S<pageNum />.)', "(Zie <paraText />, p.^S<pageNum />.)", '<fullPara delim=":" />:'),
    "Italian": ('(Vedere <fullPara delim=":" />, pag.^S<pageNum />.)', "(Vedere <paraText />, pag.^S<pageNum />.)", '<fullPara delim=":" />:'),
    "Turkish": ('(Bkz. <fullPara delim=":" />, s.^S<pageNum />.)', "(Bkz. <paraText />, s.^S<pageNum />.)", '<fullPara delim=":" />:'),
    "Polish": ('(Zobacz <fullPara delim=":" />, s.^S<pageNum />.)', "(Zobacz <paraText />, s.^S<pageNum />.)", '<fullPara delim=":" />:'),
    "Swedish": ('(Se <fullPara delim=":" />, s.^S<pageNum />.)', "(Se <paraText />, s.^S<pageNum />.)", '<fullPara delim=":" />:'),
}
KINDS_OF_TEMPLATE = ("image", "text", "credit")
CUSTOM, FULL, PARAGRAPH, PAGE = "CUSTOM_STRING_BUILDING_BLOCK", "FULL_PARAGRAPH_BUILDING_BLOCK", "PARAGRAPH_TEXT_BUILDING_BLOCK", "PAGE_NUMBER_BUILDING_BLOCK"


def audit_rows(lines: DataFrame, line: str = "line") -> DataFrame:
    """``lines`` as kind and fields: KIND|key=value|..., percent-encoded."""
    parts = F.split(F.col(line), r"\|", -1)
    pairs = F.transform(F.filter(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), lambda p: p.contains("=")), lambda p: F.struct(F.substring_index(p, "=", 1).alias("key"), F.coalesce(F.try_url_decode(F.substring(p, F.instr(p, "=") + 1, F.length(p))), F.lit("")).alias("value")))
    return lines.select(*[c for c in lines.columns if c != line], parts[0].alias("kind"), F.map_from_entries(pairs).alias("fields"))


def field(name: str, kind: str = "string") -> Column:
    return F.try_element_at("fields", F.lit(name)).try_cast(kind)


def completeness(declared: DataFrame, collected: DataFrame, key: str, count: str = "n") -> DataFrame:
    """Keys whose declared number is not what was collected."""
    have = collected.groupBy(key).agg(F.count("*").alias("found"))
    both = declared.select(key, F.col(count).cast("long").alias("declared")).join(have, key, "full_outer")
    both = both.select(key, F.coalesce("declared", F.lit(0)).alias("declared"), F.coalesce("found", F.lit(0)).alias("found"))
    return both.where("declared <> found")


def rule_plan(stories: DataFrame, rules: DataFrame, runs: DataFrame, matches: DataFrame) -> DataFrame:
    """For each story and rule: whether exactly one run is recorded and the
    matches it declares were found. ``rules`` is a small fixed list: each
    story is exploded by it, no product of tables."""
    names = [r[0] for r in rules.select("rule").distinct().orderBy("rule").collect()]
    every = stories.select("story", F.explode(F.array(*map(F.lit, names))).alias("rule"))
    ran = runs.groupBy("story", "rule").agg(F.count("*").alias("n_runs"), F.max("declared").alias("declared"))
    found = matches.groupBy("story", "rule").agg(F.count("*").alias("n_found"))
    out = every.join(ran, ["story", "rule"], "left").join(found, ["story", "rule"], "left").na.fill(0, ["n_runs", "declared", "n_found"])
    return out.withColumn("complete", (F.col("n_runs") == 1) & (F.col("declared") == F.col("n_found")))


def rule_totals(rules: DataFrame, applied: DataFrame) -> DataFrame:
    """Per rule: scopes, matches, changes and excluded matches (those of a
    protected scope; a column ``excluded`` of ``applied``, may be absent),
    rules without any included."""
    out = F.sum("excluded") if "excluded" in applied.columns else F.lit(0).cast("long")
    sums = applied.groupBy("rule").agg(F.count("*").alias("scopes"), F.sum("matches").alias("matches"), F.sum("changes").alias("changes"), out.alias("excluded"))
    return rules.join(sums, "rule", "left").na.fill(0, ["scopes", "matches", "changes", "excluded"])


def overflow_totals(pages: DataFrame, declared: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sums of the rows, links and overflows of partial inventories (one row
    a call), and whether they are the ``declared`` ones."""
    cols = ["rows", "links", "overflows"]
    sums = pages.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in cols))
    both = sums.join(declared.select(*keys, *(F.col(c).alias(f"_{c}") for c in cols)), list(keys), "full_outer").na.fill(0)
    same = F.lit(True)
    for c in cols:
        same = same & (F.col(c) == F.col(f"_{c}"))
    return both.select(*keys, *cols, same.alias("complete"))


def accepted_engine(c: Column, accepted: Sequence[str]) -> Column:
    """Whether a SHA-256 is one of the accepted ones, in any case."""
    return F.coalesce(F.upper(text(c)).isin(*(a.upper() for a in accepted)), F.lit(False))


# --- templates --------------------------------------------------------------

_LINE_TEXT = r"[^\r\n]+?"
# Building block and rendered text of each template tag.
TAGS = {
    "fullPara": (FULL, _LINE_TEXT),
    "paraText": (PARAGRAPH, _LINE_TEXT),
    "pageNum": (PAGE, "[0-9A-Za-z–-]+"),
}
# Format names that have a template, and its kind.
FORMAT_KINDS = {"In the text": "text", "Image": "image", "Credits": "credit"}
# Layers in their order; body styles and whether they indent.
LAYERS = ["KDP", "Images", "Body", "Peripheral", "Background"]
BODY_STYLES = {"Body Text No Indent": False, "Body Text Indented": True}
_BLOCKS = "array<struct<type:string,text:string,delimiter:string>>"


def template_blocks(template: str) -> list[tuple[str, str, str]]:
    """Building blocks (type, text, delimiter) of a template: its tags, read
    as elements, and the texts between them with "^S" as a no-break space."""
    try:
        root = ElementTree.fromstring(f"<t>{template}</t>")
    except ElementTree.ParseError as e:
        raise ValueError(f"unknown template syntax: {template}") from e
    pieces: list[tuple[str, str, str]] = [(CUSTOM, root.text or "", "")]
    for tag in root:
        if tag.tag not in TAGS or set(tag.attrib) - {"delim"} or len(tag) or tag.text:
            raise ValueError(f"unknown template tag: {tag.tag}")
        pieces += [(TAGS[tag.tag][0], "", tag.get("delim", "")), (CUSTOM, tag.tail or "", "")]
    blocks = [(kind, words.replace("^S", NBSP), delim) for kind, words, delim in pieces if kind != CUSTOM or words]
    if any("^" in words for _, words, _ in blocks):
        raise ValueError(f"unknown template mark: {template}")
    return blocks


def blocks_literal(template: str) -> Column:
    rows = [F.struct(F.lit(t).alias("type"), F.lit(x).alias("text"), F.lit(d).alias("delimiter")) for t, x, d in template_blocks(template)]
    return F.array(*rows)


def matches_template(c: Column, blocks: Column) -> Column:
    """Whether a rendered text is what the blocks (type, text) can render."""
    rendered = F.create_map(*(F.lit(x) for pair in TAGS.values() for x in pair))
    parts = F.transform(blocks, lambda b: F.coalesce(F.try_element_at(rendered, b["type"]), escape_regex(b["text"])))
    return F.regexp_like(text(c), F.concat(F.lit(r"\A"), F.array_join(parts, ""), F.lit(r"\z")))


def _wanted(language: str) -> Column:
    """Blocks that a format's name asks for, or null."""
    by_kind = dict(zip(KINDS_OF_TEMPLATE, TEMPLATES[language]))
    known = F.create_map(*(x for name, kind in FORMAT_KINDS.items() for x in (F.lit(name), blocks_literal(by_kind[kind]))))
    return F.try_element_at(known, F.col("name"))


def document_layout(layers: DataFrame, styles: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, fault) of documents whose ``layers`` (pos, name) are not LAYERS
    in order, or whose ``styles`` (name, first_line_indent) lack one of the
    body styles, repeat it, or indent it otherwise."""
    order = layers.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "name"))), lambda x: x["name"]).alias("have"))
    faults = [order.where(F.col("have") != F.array(*map(F.lit, LAYERS))).select(*keys, F.lit("layers in another order").alias("fault"))]
    for name, indents in BODY_STYLES.items():
        right = (F.col("first_line_indent") > 0) if indents else (F.col("first_line_indent") == 0)
        found = styles.where(F.col("name") == name).groupBy(*keys).agg(F.count("*").alias("n"), F.bool_and(F.coalesce(right, F.lit(False))).alias("fine"))
        every = styles.select(*keys, F.lit(1).alias("_one")).distinct()
        judged = (every.join(found, list(keys), "left") if keys else every.join(found.withColumn("_one", F.lit(1)), "_one", "left")).where(~F.coalesce((F.col("n") == 1) & F.col("fine"), F.lit(False)))
        faults.append(judged.select(*keys, F.lit(f"style to be reviewed: {name}").alias("fault")))
    out = faults[0]
    for f in faults[1:]:
        out = out.unionByName(f)
    return out


def layout_plan(formats: DataFrame, blocks: DataFrame, references: DataFrame, language: str, protected: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(formats, references) with what must change.

    ``formats`` (format_id, name; blocks: how many it declares, may be
    absent), ``blocks`` (format_id, pos, type, text, delimiter, and
    include_delimiter, which may be absent: a block with a delimiter must not
    include it, "false" in the column, else it is of another structure),
    ``references``
    (ref_id, format_id, text, style). Every fact about a format in use is a
    row of its own, and the row of the highest rank names its ``action``:
    protected (all its references are), an error text (shared with protected
    content, no template for its name, another count of blocks, another
    structure), edit, or keep. A reference is to be updated if its format is
    edited or its text does not fit the template; one whose format is not
    listed gets the action "format not inspected", one without a style
    "style not inspected".
    """
    block = F.struct(*(text(F.col(c)).alias(c) for c in ("type", "text", "delimiter")))
    keeps = text(F.col("include_delimiter").cast("string")) if "include_delimiter" in blocks.columns else F.lit("false")
    listed = F.array_sort(F.collect_list(F.struct("pos", block.alias("b"), keeps.alias("include"))))
    have = blocks.groupBy("format_id").agg(F.transform(listed, lambda x: x["b"]).alias("have"), F.transform(listed, lambda x: x["include"]).alias("included"))
    guarded = F.coalesce(F.col("style").isin(*protected) | F.substring_index("style", "/", -1).isin(*protected), F.lit(False)) if protected else F.lit(False)
    refs = references.withColumn("is_protected", guarded)
    used = refs.groupBy("format_id").agg(F.bool_and("is_protected").alias("all_protected"), F.bool_or("is_protected").alias("any_protected"))
    declared = F.col("blocks").cast("int") if "blocks" in formats.columns else F.size("have")
    known = formats.withColumn("want", _wanted(language)).join(have, "format_id", "left").withColumn("have", F.coalesce("have", F.array().cast(_BLOCKS)))
    known = known.join(used, "format_id")
    shape = lambda a: F.transform(a, lambda b: F.struct(b["type"], b["delimiter"]))
    facts = [
        (F.col("all_protected"), "protected"),
        (F.col("any_protected"), "shared with protected content"),
        (F.col("want").isNull(), "no template for this format"),
        ((F.size("have") != F.size("want")) | (declared != F.size("have")), "count of blocks differs"),
        (shape("have") != shape("want"), "structure differs"),
        (F.exists(F.zip_with("want", "included", lambda b, x: (b["delimiter"] != "") & (x != "false")), lambda bad: bad), "structure differs"),
        (F.col("have") != F.col("want"), "edit"),
        (F.lit(True), "keep"),
    ]
    ranked = F.array(*(F.when(F.coalesce(holds, F.lit(False)), F.lit(name)) for holds, name in facts))
    planned = known.withColumn("action", F.array_compact(ranked)[0])
    told = refs.join(planned.select("format_id", "action", "want"), "format_id", "left")
    action = F.when(F.col("style").isNull() | (F.col("style") == ""), "style not inspected").otherwise(F.coalesce("action", F.lit("format not inspected")))
    misfit = (F.col("action") == "keep") & ~matches_template(F.col("text"), F.col("want"))
    due = F.coalesce(((F.col("action") == "edit") | misfit) & ~F.col("is_protected"), F.lit(False))
    return planned.select("format_id", "name", "action"), told.select("ref_id", "format_id", action.alias("action"), due.alias("update"))


def rendered_reference(source: Column, results: Column) -> Column:
    """Text with its U+0018 marks replaced by results in order; null if their
    number differs."""
    pieces = F.split(text(source), "\x18", -1)
    return F.when(F.size(pieces) - 1 == F.size(results), F.array_join(F.zip_with(pieces, results, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), ""))


def protection_of(start: Column, end: Column, style: Column, ranges: Column, styles: Sequence[str]) -> Column:
    """Why a match may not change: its style, an overlapping range, or null."""
    overlap = F.exists(ranges, lambda r: (r["start"] < end) & (r["end"] > start))
    return F.when(style.isin(*styles) if styles else F.lit(False), "style").when(overlap, "reference")
