"""Markup inventories and comparisons as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import boundary_whitespace, line_breaks, text

INSTRUCTION = r"(?s)<\?.*?\?>"
TAG = r"</?[A-Za-z][^>]*>"
ENTITY = r"&(?:amp|lt|gt|quot|apos|#[0-9]+|#x[0-9A-Fa-f]+);"


def instructions(c: Column) -> Column:
    return F.regexp_extract_all(text(c), F.lit(INSTRUCTION), F.lit(0))


def tags(c: Column) -> Column:
    return F.regexp_extract_all(text(c), F.lit(TAG), F.lit(0))


def visible_letters(c: Column) -> Column:
    """Latin letters outside markup, as one string."""
    t = F.regexp_replace(text(c), INSTRUCTION, "")
    t = F.regexp_replace(t, r"(?i)<Br\b[^>]*/>", " ")
    return F.regexp_replace(F.regexp_replace(t, ENTITY, " "), "[^A-Za-zÀ-ÖØ-öø-ÿ]", "")


def double_escaped(c: Column) -> Column:
    return text(c).rlike(r"(?i)&amp;(?:amp|lt|gt|quot|apos|#[0-9]+|#x[0-9A-Fa-f]+);")


def invalid_xml(c: Column) -> Column:
    return text(c).rlike(r"[\x00-\x08\x0B\x0C\x0E-\x1F\x{FFFE}\x{FFFF}]")


def changed_parts(source: Column, target: Column) -> Column:
    """Names of the inventories in which the texts differ."""
    parts = {
        "processing instructions": instructions(source) != instructions(target),
        "markup tags": tags(source) != tags(target),
        "line breaks": line_breaks(source) != line_breaks(target),
        "boundary whitespace": boundary_whitespace(source) != boundary_whitespace(target),
        "invalid character": invalid_xml(target),
    }
    return F.filter(F.array(*(F.when(bad, F.lit(name)) for name, bad in parts.items())), lambda x: x.isNotNull())


def set_id(tag: Column, value: Column) -> Column:
    """Start tag with its id attribute set or added."""
    quoted = F.concat(F.lit(' id="'), value, F.lit('"'))
    put = F.regexp_replace(tag, F.lit(r'\sid="[^"]*"'), F.regexp_replace(quoted, r"([\\$])", r"\\$1"))
    add = F.concat(F.regexp_extract(tag, r"\A(<[^\s/>]+)", 1), quoted, F.regexp_replace(tag, r"\A<[^\s/>]+", ""))
    return F.when(tag.rlike(r'\sid="'), put).otherwise(add)


def escape_xml(c: Column) -> Column:
    """Escape "&", "<" and ">" outside instructions, tags and entities.

    Tokens that stay and stretches between them alternate; only the latter
    are escaped, then both are joined again.
    """
    keep = rf"(?:{INSTRUCTION.removeprefix('(?s)')}|{TAG}|{ENTITY})"
    pattern = "(?s)" + keep
    between = F.transform(F.split(text(c), pattern, -1), lambda p: F.replace(F.replace(F.replace(p, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")))
    kept = F.regexp_extract_all(text(c), F.lit(pattern), F.lit(0))
    return F.array_join(F.zip_with(between, kept, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
