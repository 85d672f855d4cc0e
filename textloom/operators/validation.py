"""Contracts of publications, manifests, profiles and settings, as fault rows;
and small lookups that go with them."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import content_id, is_blank, is_error_literal, request_text, text, trim
from .glossary import term_pairs


def _faults(df: DataFrame, key: str, checks: Sequence[tuple[Column, str]]) -> DataFrame:
    made = F.filter(F.array(*(F.when(bad, F.lit(name)) for bad, name in checks)), lambda x: x.isNotNull())
    return df.select(F.col(key).cast("string").alias("key"), F.explode(made).alias("fault"))


def published_faults(published: DataFrame, languages: Sequence[str]) -> DataFrame:
    """(key, fault) of published glossary rows: unknown kind, blank or
    untrimmed English, other languages than stated, untrimmed or error cells,
    a row number that repeats within a book, a row that repeats as a whole."""
    cells = F.flatten(F.transform(F.map_values("translations"), lambda t: F.array(text(t["term"]), text(t["definition"]), text(t["combined_definition"]))))
    every = F.concat(cells, F.array(text(F.col("english")), text(F.col("english_definition"))))
    named = published.withColumn("_key", F.concat_ws("#", "book", "row"))
    out = _faults(
        named,
        "_key",
        [
            (~F.coalesce(F.col("kind").isin("acronyms", "words"), F.lit(False)), "unknown kind"),
            (is_blank(F.col("english")), "blank source"),
            (F.array_sort(F.map_keys("translations")) != F.array(*map(F.lit, sorted(languages))), "other languages"),
            (F.exists(every, lambda c: trim(c) != c), "untrimmed cell"),
            (F.exists(every, is_error_literal), "error literal"),
        ],
    )
    twice = named.groupBy("_key").agg(F.count("*").alias("n")).where("n > 1").select(F.col("_key").alias("key"), F.lit("repeated row number").alias("fault"))
    whole = named.groupBy("book", "kind", "english", F.to_json("translations").alias("t")).agg(F.min("_key").alias("key"), F.count("*").alias("n")).where("n > 1").select("key", F.lit("repeated row").alias("fault"))
    return out.union(twice).union(whole)


def manifest_faults(protected: DataFrame, stated_count: int | None = None) -> DataFrame:
    """(key, fault) of protected texts (content_id, source_text, sha256):
    blank or repeated ids, texts that are not those of their hash, a count
    that is not the stated one."""
    rows = protected.withColumn("_id", content_id(F.col("content_id")))
    out = _faults(rows, "_id", [(F.col("_id") == "", "blank id"), (F.upper(F.sha2(text(F.col("source_text")), 256)) != F.upper(text(F.col("sha256"))), "text differs from its hash")])
    twice = rows.groupBy("_id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("_id").alias("key"), F.lit("repeated id").alias("fault"))
    out = out.union(twice)
    if stated_count is not None:
        n = rows.agg(F.count("*").alias("n")).where(F.col("n") != stated_count)
        out = out.union(n.select(F.lit("").alias("key"), F.lit("other number of texts").alias("fault")))
    return out


def exclusion_faults(glossary: DataFrame, excluded: DataFrame, protected_patterns: Sequence[str] = ()) -> DataFrame:
    """(key, fault): excluded terms that the glossary lacks, and sources with
    a definition inside a protected phrase that are not excluded."""
    terms = excluded.select(F.col(excluded.columns[0]).alias("term")).distinct()
    known = glossary.select(F.lower("source").alias("_k")).distinct()
    gone = terms.withColumn("_k", F.lower("term")).join(known, "_k", "left_anti").select(F.col("term").alias("key"), F.lit("not in the glossary").alias("fault"))
    if not protected_patterns:
        return gone
    defined = glossary.where((F.col("field") == "English Definition") & ~is_blank(F.col("value"))).select("source", F.lower("source").alias("_k"), "value")
    guarded = F.exists(F.array(*map(F.lit, protected_patterns)), lambda p: F.regexp_like("value", p))
    open_ = defined.where(guarded).join(terms.select(F.lower("term").alias("_k")), "_k", "left_anti")
    return gone.union(open_.select(F.col("source").alias("key"), F.lit("protected definition is not excluded").alias("fault")))


def field_faults(glossary: DataFrame, fields: Sequence[str]) -> DataFrame:
    """(key, fault) of compiled sources: another set of fields, untrimmed
    values, error literals."""
    each = glossary.groupBy("kind", "source").agg(F.sort_array(F.collect_set("field")).alias("f"), F.bool_or(trim(F.col("value")) != F.col("value")).alias("u"), F.bool_or(is_error_literal(F.col("value"))).alias("e"))
    named = each.withColumn("_key", F.concat_ws("/", "kind", "source"))
    return _faults(named, "_key", [(F.col("f") != F.array(*map(F.lit, sorted(fields))), "other fields"), (F.col("u"), "untrimmed value"), (F.col("e"), "error literal")])


def signature_conflicts(families: DataFrame, key: str = "family", signature: str = "signature") -> DataFrame:
    """Families that are declared with several signatures."""
    return families.groupBy(key).agg(F.sort_array(F.collect_set(signature)).alias("signatures")).where(F.size("signatures") > 1)


def style_faults(styles: DataFrame) -> DataFrame:
    """(key, fault) of style settings (path, size, label)."""
    out = _faults(
        styles,
        "path",
        [
            (is_blank(F.col("path")), "blank path"),
            (~F.coalesce((F.col("size") > 0) & (F.col("size") <= 1000), F.lit(False)), "size out of range"),
            (~F.coalesce(F.col("label").rlike(r"\A[A-Za-z0-9][A-Za-z0-9 _.-]*\z"), F.lit(False)), "label of another form"),
        ],
    )
    twice = styles.groupBy(F.lower("path").alias("key")).agg(F.count("*").alias("n")).where("n > 1")
    return out.union(twice.select("key", F.lit("repeated path").alias("fault")))


def default_profile(profiles: DataFrame, defaults: DataFrame) -> DataFrame:
    """(book, language, profile): the default one of each book and language,
    else the only one that is supported; null if there are several."""
    sole = profiles.groupBy("book", "language").agg(F.count("*").alias("n"), F.min("profile").alias("only"))
    chosen = sole.join(defaults.select("book", "language", F.col("profile").alias("stated")), ["book", "language"], "left")
    return chosen.select("book", "language", F.coalesce("stated", F.when(F.col("n") == 1, F.col("only"))).alias("profile"))


def senses_in_context(contexts: DataFrame, senses: DataFrame, key: str, value: str) -> DataFrame:
    """(key, source, alternatives): ambiguous senses whose source occurs in
    the context, between ASCII boundaries."""
    found = term_pairs(contexts, senses.select("source", F.lit("").alias("target")), key, value)
    return found.select(key, "source").join(senses, "source")


def definition_for(fields: Column, language: Column, place: Column) -> Column:
    """Definition of a language in a map of fields: its own key, else the key
    of its place ("_1", "_2", ...)."""
    return F.coalesce(F.nullif(F.try_element_at(fields, F.concat(language, F.lit(" Definition"))), F.lit("")), F.try_element_at(fields, F.concat(F.lit("_"), place.cast("string"))))


def language_fields(fields: Column) -> Column:
    """Entries of a map of fields that name languages."""
    return F.map_filter(fields, lambda k, _: (k != "") & ~k.startswith("_") & ~k.rlike("(?i) Definition$"))


def by_language(entries: DataFrame) -> DataFrame:
    """(language, source, target) of (source, map of fields), blanks out."""
    each = entries.select("source", F.explode(F.map_entries(language_fields(F.col("fields")))).alias("e"))
    return each.select(F.col("e.key").alias("language"), "source", trim(F.col("e.value")).alias("target")).where("target <> ''")


def prompt_text(rules: DataFrame, stage: str, head: str, tail: str) -> DataFrame:
    """One text per language: head, the stage's rules in order, tail."""
    own = rules.where(F.array_contains("stages", stage))
    line = F.concat(F.lit("["), F.col("id"), F.lit("] "), F.col("instruction"))
    lines = F.transform(F.array_sort(F.collect_list(F.struct("ord", line.alias("l")))), lambda x: x["l"])
    return own.groupBy("language").agg(F.array_join(F.concat(F.array(F.lit(head)), lines, F.array(F.lit(tail))), "\n").alias("prompt"))


def request_values(c: Column, kind: T.DataType, repair: bool = False) -> Column:
    """Every string in a nested value as it may leave the system."""
    if isinstance(kind, T.StringType):
        return F.when(c.isNotNull(), request_text(c, repair))
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: request_values(x, kind.elementType, repair))
    if isinstance(kind, T.MapType):
        return F.transform_values(c, lambda _, v: request_values(v, kind.valueType, repair))
    if isinstance(kind, T.StructType):
        return F.when(c.isNotNull(), F.struct(*(request_values(c[f.name], f.dataType, repair).alias(f.name) for f in kind.fields)))
    return c


def collapse(value: str) -> tuple[str, list[int]]:
    """Text with white-space runs as single spaces, trimmed, and for each of
    its characters the place in the original."""
    out, at = [], []
    for i, c in enumerate(value):
        if c.isspace() or c == "﻿":
            if out and out[-1] != " ":
                out.append(" ")
                at.append(i)
        else:
            out.append(c)
            at.append(i)
    if out and out[-1] == " ":
        out.pop()
        at.pop()
    return "".join(out), at


def collapsed(c: Column) -> Column:
    @F.pandas_udf("text string, places array<int>")
    def run(values: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([collapse(v or "") for v in values], columns=["text", "places"])

    return run(c)


def apply_ranges(frames: DataFrame, items: DataFrame) -> DataFrame:
    """``frames`` (frame_index, text) with the items (frame_index, start,
    length, target) put in place; ``fault`` where ranges overlap or leave the
    text, which then stays as it is."""
    packed = items.groupBy("frame_index").agg(F.array_sort(F.collect_list(F.struct("start", "length", "target"))).alias("_i"))
    out = frames.join(packed, "frame_index", "left").withColumn("_i", F.coalesce("_i", F.array().cast("array<struct<start:int,length:int,target:string>>")))
    ends = F.transform("_i", lambda x: x["start"] + x["length"])
    clash = F.exists(F.sequence(F.lit(1), F.greatest(F.size("_i") - 1, F.lit(1))), lambda k: F.coalesce(F.get("_i", k)["start"] < F.get(ends, k - 1), F.lit(False)))
    beyond = F.exists("_i", lambda x: (x["start"] < 0) | (x["length"] < 0) | (x["start"] + x["length"] > F.length("text")))
    step = lambda acc, x: F.concat(F.substring(acc, F.lit(1), x["start"]), x["target"], F.substring(acc, x["start"] + x["length"] + 1, F.length(acc)))
    fault = F.when(beyond, "range leaves the text").when(clash, "ranges overlap")
    made = F.aggregate(F.reverse("_i"), F.col("text"), step)
    return out.withColumn("fault", fault).withColumn("text", F.when(F.col("fault").isNull(), made).otherwise(F.col("text"))).drop("_i")


def front_matter(documents: DataFrame, name: str, value: str = "text") -> DataFrame:
    """``documents`` with the value of one front-matter field; null unless it
    stands there exactly once."""
    head = F.regexp_extract(F.col(value), r"(?s)\A---\r?\n(.*?)\r?\n---", 1)
    found = F.regexp_extract_all(head, F.lit(rf"(?m)^{name}:[ \t]*(.*?)[ \t]*$"), F.lit(1))
    return documents.withColumn(name, F.when(F.size(found) == 1, found[0]))
