"""Glossaries: entries, compilation, overlay, collisions, matching.

An exploded glossary is (kind, source, field, value, ord); term entries are
(source, target, kind, source_term, ord). Keys are matched exactly first and
by case fold only where that is unambiguous.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.text import WORD, count_exact, fold, plain_punctuation, term_pattern, text, trim
from .orders import ranked
from .segments import first_of
from .term_automaton import FOLD_FROM, FOLD_TO, Applying, AsciiPairs, Claims

#: Bytes of a list of terms that may be sent to every task.
MOST_BYTES = 32 << 20


# --- entries ----------------------------------------------------------------


def entries(glossary: DataFrame, term_field: str, definition_field: str, definition_fallback: str = "acronyms", definition_rows: str = "acronyms") -> DataFrame:
    """Term and definition entries of an exploded glossary.

    A blank term falls back to the definition, and definition entries are
    made, for the kinds named: "acronyms" or "all".
    """
    field = lambda name: trim(F.max(F.when(F.col("field") == name, F.col("value"))))
    wide = glossary.groupBy("kind", "source").agg(
        F.min("ord").alias("ord"), field(term_field).alias("term"), field(definition_field).alias("definition"), field("English Definition").alias("english")
    )
    acronym = F.col("kind") == "acronyms"
    may_fall = F.lit(True) if definition_fallback == "all" else acronym
    has_rows = F.lit(True) if definition_rows == "all" else acronym
    target = F.when(F.col("term") != "", F.col("term")).when(may_fall, F.col("definition")).otherwise(F.lit(""))
    kind = F.when(acronym, F.lit("acronym")).otherwise(F.lit("word"))
    both = F.array(
        F.struct(F.col("source").alias("source"), target.alias("target"), kind.alias("kind"), F.lit("").alias("source_term"), (F.col("ord") * 2).alias("ord")),
        F.struct(F.when(has_rows, F.col("english")).otherwise(F.lit("")).alias("source"), F.col("definition").alias("target"), F.lit("definition").alias("kind"), F.col("source").alias("source_term"), (F.col("ord") * 2 + 1).alias("ord")),
    )
    return wide.select(F.explode(both).alias("e")).select("e.*").where("source <> '' and target <> ''")


def without(rows: DataFrame, excluded: DataFrame, source: str = "source") -> DataFrame:
    """Rows whose source is not excluded, case aside."""
    gone = excluded.select(F.lower(F.col(excluded.columns[0])).alias("_x")).distinct()
    return rows.withColumn("_x", F.lower(source)).join(gone, "_x", "left_anti").drop("_x")


def distinct_pairs(rows: DataFrame) -> DataFrame:
    """First entry of each exact (source, target)."""
    return first_of(rows, ["source", "target"], "ord")


def compile_entries(rows: DataFrame) -> DataFrame:
    """One row per exact source. Equal targets keep the first entry; several
    definitions make it contextual, with its alternatives; any other conflict
    is an error. ``allow_ci``: the only source of its case fold, and not
    contextual."""
    item = F.struct("ord", "target", "kind", "source_term")
    packed = rows.where((text(F.col("source")) != "") & (text(F.col("target")) != "")).groupBy("source").agg(F.array_sort(F.collect_list(item)).alias("x"))
    first = F.col("x")[0]
    targets = F.array_distinct(F.transform("x", lambda i: i["target"]))
    other = F.filter("x", lambda i: i["target"] != F.col("x")[0]["target"])
    clash = (F.size(targets) > 1) & ((first["kind"] != "definition") | F.exists(other, lambda i: i["kind"] != "definition"))
    choice = lambda t: F.struct(t.alias("target"), F.coalesce(F.filter("x", lambda i: i["target"] == t)[0]["source_term"], F.lit("")).alias("source_term"))
    contextual = F.when(clash, F.raise_error(F.concat(F.lit("conflicting targets for source: "), F.col("source"))).cast("boolean")).otherwise(F.size(targets) > 1)
    out = packed.select("source", first["target"].alias("target"), first["kind"].alias("kind"), first["source_term"].alias("source_term"), first["ord"].alias("ord"), contextual.alias("contextual"), F.transform(targets, choice).alias("alternatives"), fold(F.col("source")).alias("folded"))
    alone = F.count("*").over(W.partitionBy("folded")) == 1
    none = F.array().cast("array<struct<target:string,source_term:string>>")
    return out.withColumn("allow_ci", alone & ~F.col("contextual")).withColumn("alternatives", F.when(F.col("contextual"), F.col("alternatives")).otherwise(none))


def by_length(rows: DataFrame) -> DataFrame:
    """Longest source first, then the given order."""
    return rows.orderBy(F.length("source").desc(), "ord")


def replacement_order(rows: DataFrame) -> DataFrame:
    """Acronyms first, then the longest source."""
    return rows.orderBy((F.col("kind") == "acronym").desc(), F.length("source").desc(), "ord")


def placed(rows: DataFrame, name: str, acronyms_first: bool = False) -> DataFrame:
    """``rows`` with the place (1, 2, ...) of each in the order of
    ``by_length`` or ``replacement_order``, by ranges and not in one task."""
    keyed = rows.withColumn("_kind", F.col("kind") != "acronym" if acronyms_first else F.lit(False)).withColumn("_short", -F.length("source"))
    return ranked(keyed, ["_kind", "_short", "ord"], name).drop("_kind", "_short")


def ambiguities(compiled: DataFrame) -> DataFrame:
    """Case folds with several sources."""
    pair = F.array_sort(F.collect_list(F.struct("source", "target")))
    found = compiled.groupBy("folded").agg(pair.alias("x")).where(F.size("x") > 1)
    return found.select("folded", F.transform("x", lambda p: p["source"]).alias("sources"), F.transform("x", lambda p: p["target"]).alias("targets"))


def case_collisions(sources: DataFrame) -> DataFrame:
    """(folded, sources): spellings that differ by case only."""
    spelt = sources.groupBy(fold(F.col("source")).alias("folded")).agg(F.sort_array(F.collect_set("source")).alias("sources"))
    return spelt.where(F.size("sources") > 1)


def collision_changes(actual: DataFrame, allowed: DataFrame, key: str = "folded") -> DataFrame:
    """(key, state): collisions not allowed (undeclared), and allowed ones
    that do not occur (stale)."""
    a, b = actual.select(key).distinct(), allowed.select(key).distinct()
    return a.join(b, key, "left_anti").withColumn("state", F.lit("undeclared")).union(b.join(a, key, "left_anti").withColumn("state", F.lit("stale")))


def coverage(glossary: DataFrame, term_field: str, definition_field: str) -> DataFrame:
    """Per kind: sources, and how many miss term or definition."""
    has = lambda name: F.max(F.when((F.col("field") == name) & (trim(F.col("value")) != ""), 1).otherwise(0))
    each = glossary.groupBy("kind", "source").agg(has(term_field).alias("t"), has(definition_field).alias("d"))
    return each.groupBy("kind").agg(F.count("*").alias("n_sources"), F.count_if(F.col("t") == 0).alias("missing_terms"), F.count_if(F.col("d") == 0).alias("missing_definitions"))


def overlay(base: DataFrame, published: DataFrame, fields: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(glossary, senses): ``published`` laid over an exploded ``base``.

    A published source takes the base's exact spelling, else the only one of
    its case fold, else its own; several are an error. ``fields`` binds
    languages to target fields. Blank values keep the base's. A source with
    several published rows gets blank targets, its rows become senses.
    """
    keys = base.select("source").distinct()
    exact = keys.select(F.col("source").alias("exact"))
    folded = keys.groupBy(fold(F.col("source")).alias("f")).agg(F.min("source").alias("only"), F.count("*").alias("n"))
    spelt = published.withColumn("f", fold(F.col("english"))).join(exact, F.col("english") == F.col("exact"), "left").join(folded, "f", "left")
    doubt = F.raise_error(F.concat(F.lit("ambiguous base spelling: "), F.col("english")))
    key = F.coalesce("exact", F.when(F.col("n") > 1, doubt).otherwise(F.col("only")), "english")
    spelt = spelt.withColumn("source", key).drop("exact", "f", "only", "n")
    counts = spelt.groupBy("source").agg(F.count("*").alias("n"), F.countDistinct("kind").alias("kinds"))
    mixed = F.raise_error(F.concat(F.lit("conflicting kinds for: "), F.col("source"))).cast("bigint")
    counts = counts.select("source", F.when(F.col("kinds") > 1, mixed).otherwise(F.col("n")).alias("n"))
    known = spelt.join(counts, "source")

    values = []
    for language, field in fields.items():
        t = F.col("translations")[language]
        values.append(F.struct(F.lit(field).alias("field"), text(t["term"]).alias("value")))
        values.append(F.struct(F.lit(f"{field} Definition").alias("field"), text(t["definition"]).alias("value")))
    english = F.struct(F.lit("English Definition").alias("field"), text(F.col("english_definition")).alias("value"))
    one = known.where("n = 1").select("kind", "source", F.explode(F.array(english, *values)).alias("x"))
    one = one.select("kind", "source", "x.field", "x.value").where("value <> ''")
    many = known.where("n > 1").select("kind", "source").distinct()
    blank = many.select("kind", "source", F.explode(F.array(*(F.lit(f) for field in fields.values() for f in (field, f"{field} Definition")))).alias("field")).withColumn("value", F.lit(""))
    new = one.unionByName(blank)
    joined = base.join(new.withColumnRenamed("value", "put"), ["kind", "source", "field"], "full_outer")
    glossary = joined.select("kind", "source", "field", F.coalesce("put", "value").alias("value"), F.coalesce("ord", F.lit(2**53)).alias("ord"))

    sense = lambda t: F.struct(text(t["term"]).alias("target"), text(t["definition"]).alias("definition"))
    each = known.where("n > 1").select("source", "row", F.explode(F.array(*(F.struct(F.lit(f).alias("field"), sense(F.col("translations")[lang]).alias("s")) for lang, f in fields.items()))).alias("x"))
    packed = each.groupBy(F.col("x.field").alias("field"), "source").agg(F.array_sort(F.collect_list(F.struct("row", "x.s"))).alias("a"))
    alternatives = F.transform("a", lambda i: F.struct(i["s"]["target"].alias("target"), i["s"]["definition"].alias("definition"), i["row"].alias("source_row")))
    return glossary, packed.select("field", "source", alternatives.alias("alternatives"))


def pairs_for(words: DataFrame, acronyms: DataFrame) -> DataFrame:
    """(source, target, context, kind): acronyms replace equal words."""
    all_ = words.withColumn("kind", F.lit("word")).withColumn("_rank", F.lit(0)).unionByName(acronyms.withColumn("kind", F.lit("acronym")).withColumn("_rank", F.lit(1)))
    kept = all_.where(trim(F.col("target")) != "").groupBy(trim(F.col("source")).alias("source"))
    last = F.max_by(F.struct(trim(F.col("target")).alias("target"), trim(F.col("context")).alias("context"), "kind"), F.struct("_rank", "ord"))
    return kept.agg(last.alias("x")).select("source", "x.target", "x.context", "x.kind")


# --- matching ---------------------------------------------------------------


@lru_cache(maxsize=10_000)
def pattern_of(term: str, case_sensitive: bool):
    left = rf"(?<![{WORD}])" if regex.match(rf"[{WORD}]", term) else ""
    right = rf"(?![{WORD}])" if regex.search(rf"[{WORD}]\Z", term) else ""
    return regex.compile(left + regex.escape(term) + right, 0 if case_sensitive else regex.IGNORECASE)


def claims(value: str, terms: Sequence[tuple[str, bool, bool]]) -> list[tuple[str, str]]:
    """(source, mode) of the terms that claim a place in ``value``.

    ``terms`` are (source, contextual, allow_ci), the longest first. Exact
    matches claim before case-insensitive ones; a claimed place is blanked,
    so it can be claimed once.
    """
    left, out, taken = value, [], set()
    for exact in (True, False):
        for source, contextual, allow_ci in terms:
            if contextual or source in taken or not (exact or allow_ci):
                continue
            if exact and source not in left:
                continue
            pattern = pattern_of(source, exact)
            if pattern.search(left):
                out.append((source, "exact" if exact else "case-insensitive-unique"))
                taken.add(source)
                left = pattern.sub(lambda m: " " * len(m[0]), left)
    return out


_MATCH = "array<struct<source:string,mode:string>>"


_RUN, _MARK = r"[\p{L}\p{N}]+", r"[^\p{L}\p{N}\s]"


def _folded(c: Column) -> Column:
    """Lower case, and one letter for all that match each other in any case."""
    return F.translate(F.lower(F.translate(c, "İ", "i")), FOLD_FROM, FOLD_TO)


def _term_token(c: Column) -> Column:
    """What a text must have to hold the term: of its runs of letters and
    digits the longest, folded; without any, its first other character.

    Boundaries stand at both ends of a term that is matched, and what is no
    letter or digit stands between its runs: so the runs of the term are whole
    runs of the text.
    """
    runs = F.regexp_extract_all(_folded(c), F.lit(_RUN), F.lit(0))
    longest = F.array_max(F.transform(runs, lambda r: F.struct(F.length(r).alias("n"), r.alias("r"))))["r"]
    return F.coalesce(longest, F.nullif(F.regexp_extract(c, _MARK, 0), F.lit("")), F.lit(" "))


def _text_tokens(texts: DataFrame, key: str, value: Column) -> DataFrame:
    """(key, _t): the distinct tokens of each text. The text is not repeated."""
    tokens = F.concat(F.regexp_extract_all(_folded(value), F.lit(_RUN), F.lit(0)), F.regexp_extract_all(value, F.lit(_MARK), F.lit(0)))
    return texts.select(key, F.explode(F.array_distinct(tokens)).alias("_t"))


def candidates(texts: DataFrame, compiled: DataFrame, key: str, value: str, extra: Sequence[str] = ("contextual", "allow_ci")) -> DataFrame:
    """(key, terms): for each text the terms whose token it has, by an
    equi-join; terms of any script have a token, so none meets every text."""
    item = F.struct(F.length("source").alias("n"), "ord", "source", *extra)
    named = compiled.select(_term_token(F.col("source")).alias("_t"), item.alias("e"))
    return _text_tokens(texts, key, F.col(value)).join(named, "_t").groupBy(key).agg(F.array_sort(F.collect_list("e")).alias("terms"))


#: Automata of this worker, by the key of their list of terms.
_BUILT: dict[str, object] = {}


def _built(shared, make):
    """What ``make`` builds of a broadcast list of terms, once per worker."""
    key, columns = shared.value
    if key not in _BUILT:
        while len(_BUILT) > 1:
            del _BUILT[next(iter(_BUILT))]
        _BUILT[key] = make(list(zip(*(c.to_pylist() for c in columns))))
    return _BUILT[key]


def _shards(rows: DataFrame, *sizes: str):
    """Broadcast lists of the rows of ``rows``, in its order, as columns; the
    strings of one list have at most MOST_BYTES. There is one list at least."""
    def sent(table: pa.Table):
        return rows.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, [c.combine_chunks() for c in table.columns]))

    long = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in sizes), F.lit(0))
    if rows.agg(F.coalesce(F.sum(long), F.lit(0))).first()[0] <= MOST_BYTES:
        yield sent(rows.toArrow())
        return
    # Rows come to the driver by partitions, and leave it by lists.
    schema, held, size = to_arrow_schema(rows.schema), [], 0
    table = lambda: pa.Table.from_pylist([r.asDict() for r in held], schema)
    for r in rows.toLocalIterator():
        more = sum(len((r[c] or "").encode("utf-8", "surrogatepass")) for c in sizes)
        if held and size + more > MOST_BYTES:
            yield sent(table())
            held, size = [], 0
        held.append(r)
        size += more
    yield sent(table())


def match_terms(texts: DataFrame, compiled: DataFrame, key: str = "row_no", value: str = "content") -> DataFrame:
    """``texts`` with ``matches``: the glossary terms that claim a place.

    One trie of the words of all terms reads each text once; texts are not
    moved. A glossary of over MOST_BYTES is not sent to all tasks: there a
    text meets the terms whose token it has, joined to it once. A null key is
    a key; texts that share one are judged each by its own words.
    """
    bytes_ = compiled.agg(F.coalesce(F.sum(F.octet_length("source")), F.lit(0))).first()[0]
    if bytes_ <= MOST_BYTES:
        (shared,) = _shards(by_length(compiled).select("source", "contextual", "allow_ci"), "source")

        @F.pandas_udf(_MATCH)
        def claimed(values: pd.Series) -> pd.Series:
            find = _built(shared, lambda terms: Claims(terms, pattern_of))
            return pd.Series(list(find.many(values)), dtype=object)

        return texts.withColumn("matches", claimed.asNondeterministic()(text(F.col(value))))

    @F.pandas_udf(_MATCH)
    def run(values: pd.Series, own: pd.Series) -> pd.Series:
        out = []
        for v, terms in zip(values, own):
            ranked = sorted(terms if terms is not None else [], key=lambda e: (-e["n"], e["ord"]))
            out.append(claims(v, [(e["source"], e["contextual"], e["allow_ci"]) for e in ranked]) if v else [])
        return pd.Series(out, dtype=object)

    found = candidates(texts, compiled, key, value).withColumnRenamed(key, "_key")
    joined = texts.join(found, F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")
    return joined.withColumn("matches", run.asNondeterministic()(text(F.col(value)), F.col("terms"))).drop("terms")


def _numbered_hits(texts: DataFrame, pairs: DataFrame, key: str, value: str):
    """For each MOST_BYTES of sources: (key, numbers), the numbers of the
    sources that each text has, and the source of a number."""
    def hits(shared) -> tuple[DataFrame, Callable[[Column], Column]]:
        @F.arrow_udf("array<int>")
        def run(values: pa.Array) -> pa.Array:
            find = _built(shared, lambda terms: AsciiPairs([t[0] for t in terms]))
            sizes, numbers = [[0]], [[]]
            for n, found in find.many(values.to_pylist()):
                sizes.append(n)
                numbers.append(found)
            ends = np.cumsum(np.concatenate(sizes)).astype(np.int32)
            return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(numbers).astype(np.int32)))

        @F.pandas_udf("string")
        def name(numbers: pd.Series) -> pd.Series:
            return pd.Series(shared.value[1][0].take(pa.array(numbers)).to_pylist(), dtype=object)

        found = texts.select(key, run.asNondeterministic()(text(F.col(value))).alias("numbers"))
        return found, lambda number: name.asNondeterministic()(number)

    sources = pairs.where(F.length("source") > 0).select("source").distinct()
    return map(hits, _shards(sources, "source"))


def term_pairs(texts: DataFrame, pairs: DataFrame, key: str, value: str) -> DataFrame:
    """(key, source, target): every pair whose source occurs in the text
    between ASCII boundaries, in any ASCII case; overlaps are allowed.

    Texts are read by one trie for each MOST_BYTES of sources, and only
    (key, source) leaves them.
    """
    each = [found.select(key, F.explode("numbers").alias("n")).distinct().select(key, name(F.col("n")).alias("source")) for found, name in _numbered_hits(texts, pairs, key, value)]
    return reduce(DataFrame.unionByName, each).join(pairs.select("source", "target"), "source").select(key, "source", "target").distinct()


def term_counts(texts: DataFrame, pairs: DataFrame, key: str, value: str) -> DataFrame:
    """(source, n): in the texts of how many different keys, null aside, each
    source occurs as in ``term_pairs``; those that occur nowhere are left out.

    Hits are counted where they are found. Only those of keys that stand on
    several texts are brought together, to count a key once.
    """
    repeated = texts.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_n")).where("_n > 1").select("_key")
    some = bool(repeated.limit(1).count())

    def counts(found: DataFrame, name: Callable[[Column], Column]) -> DataFrame:
        found = found.join(repeated, F.col(key) == F.col("_key"), "left") if some else found.withColumn("_key", F.lit(None).cast(found.schema[key].dataType))
        each = found.select(F.explode("numbers").alias("number"), "_key", F.col(key).isNotNull().alias("_known")).groupBy("number", "_key").agg(F.count_if("_known").alias("n"))
        of = each.groupBy("number").agg(F.sum(F.when(F.col("_key").isNull(), F.col("n")).otherwise(1)).alias("n"))
        return of.select(name(F.col("number")).alias("source"), "n")

    return reduce(DataFrame.union, [counts(*h) for h in _numbered_hits(texts, pairs, key, value)])


def applies(value: Column, source: Column, contextual: Column, allow_ci: Column) -> Column:
    """One entry against one text: exact, or any case where allowed."""
    return ~contextual & (F.regexp_like(value, term_pattern(source, True)) | (allow_ci & F.regexp_like(value, term_pattern(source, False))))


# Further German forms of a target noun, and the endings that a
# French one-word definition in -é may take.
GERMAN_FORMS = {
    "kompanie": ["Kompanien", "Kompanieebene", "Kompaniechef", "Kompaniemörser"],
    "infanterie": ["Marineinfanterie", "Infanterieausbildung", "Infanterieausbildungsbataillon", "Infanterieschule", "Infanterieeinheit", "Infanterieeinheiten"],
    "pionier": ["Pioniere", "Pionieren", "Pioniers", "Pionierkommando", "Pionierkommandos"],
    "ultraviolett": ["Ultraviolettstrahlung"],
    "aufklärung": ["Aufklärungs-", "Aufklärungseinheit", "Aufklärungseinheiten", "Aufklärungsauftrag", "Aufklärungsmission"],
    "artillerie": ["Artillerieschießen"],
    "brigade": ["Brigaden", "Brigadestärke"],
    "gruppe": ["Gruppen", "Gruppenführer"],
    "zug": ["Zugführer", "Zugführers", "Zugführern"],
}
FRENCH_ENDINGS = ["e", "s", "es"]
GERMAN_ADJECTIVE = rf"(?iu)(?<![{WORD}])fortgeschritten(?:er)?(?:e|en|em|er|es)?(?![{WORD}])"


def contains_target(value: Column, target: Column, kind: Column, language: str) -> Column:
    """The target term is in ``value``, or one of its finite inflections."""
    value, found = text(value), F.regexp_like(text(value), term_pattern(target))
    if language.lower() == "german":
        forms = F.create_map(*(x for k, v in GERMAN_FORMS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))))
        own = F.when(kind == "definition", F.try_element_at(forms, F.lower(target)))
        open_end = lambda f: F.concat(F.lit(rf"(?iu)(?<![{WORD}])"), f, F.lit(r"(?=\s|\z)"))
        inflected = F.exists(F.coalesce(own, F.array().cast("array<string>")), lambda f: F.regexp_like(value, F.when(f.endswith("-"), open_end(f)).otherwise(term_pattern(f))))
        return found | F.when(F.lower(target) == "fortgeschritten", value.rlike(GERMAN_ADJECTIVE)).otherwise(inflected)
    if language.lower() == "french":
        agrees = F.exists(F.array(*map(F.lit, FRENCH_ENDINGS)), lambda e: F.regexp_like(value, term_pattern(F.concat(target, e))))
        return found | ((kind == "definition") & target.rlike(r"\A[\p{L}\p{M}]+é\z") & agrees)
    return found


# --- replacing --------------------------------------------------------------


def flexible_pattern(term: str):
    """Boundary pattern of a term whose quotes may be straight or curly."""
    plain = term.translate(str.maketrans("‘’‛′“”″‐‑‒–—―", "''''\"\"\"------"))
    body = "".join({"'": "['‘’‛′]", '"': '["“”″]'}.get(c, regex.escape(c)) for c in plain)
    return regex.compile(rf"(^|[^A-Za-z0-9_])({body})(?=$|[^A-Za-z0-9_])", regex.IGNORECASE)


def replace_terms(value: str, terms: Sequence[tuple[str, str, str]]) -> tuple[str, list[tuple[str, str, int]]]:
    """Sequential replacement by (source, target, kind) in the given order;
    returns the text and (source, target, count) of those that applied."""
    applied = []
    for source, target, _ in terms:
        value, n = flexible_pattern(source).subn(lambda m, target=target: m[1] + target, value)
        if n:
            applied.append((source, target, n))
    return value, applied


def replace_in(texts: DataFrame, terms: Sequence[tuple[str, str, str]], value: str = "content") -> DataFrame:
    """``texts`` with ``replaced`` and ``applied``; acronyms go first, then
    the longest source. ``terms`` is one document's list, at most MOST_BYTES."""
    if sum(len(s) + len(t) for s, t, _ in terms) > MOST_BYTES:
        raise ValueError("list of terms is too large to be sent to every task")
    ranked = sorted(((s.strip(), t.strip(), k) for s, t, k in terms if s.strip() and t.strip()), key=lambda e: (e[2] != "acronym", -len(e[0])))
    shared = texts.sparkSession.sparkContext.broadcast(ranked)

    @F.pandas_udf("replaced string, applied array<struct<source:string,target:string,n:int>>")
    def run(values: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([replace_terms(v or "", shared.value) for v in values], columns=["replaced", "applied"])

    return texts.withColumn("_r", run.asNondeterministic()(F.col(value))).select(*texts.columns, "_r.replaced", "_r.applied")


def local_answer(value: Column, replaced: Column, applied: Column) -> Column:
    """The target, if replacing turned the whole text into exactly one target
    once; else null: the text needs a translator."""
    core = trim(replaced)
    once = (F.size(applied) == 1) & (F.get(applied, F.lit(0))["n"] == 1) & (core == F.get(applied, F.lit(0))["target"])
    whole = F.lower(plain_punctuation(trim(value))) == F.lower(plain_punctuation(F.get(applied, F.lit(0))["source"]))
    return F.when(once & whole, replaced)


def lookup(rows: DataFrame, table: DataFrame, value: str = "text") -> DataFrame:
    """``rows`` with ``target``: by exact source, else the first source equal
    but for case, else the text itself."""
    exact = table.select(F.col("source").alias("_s"), F.col("target").alias("_exact"))
    folded = table.groupBy(F.lower("source").alias("_f")).agg(F.min_by("target", "ord").alias("_any"))
    out = rows.withColumn("_f", F.lower(value)).join(exact, F.col(value) == F.col("_s"), "left").join(folded, "_f", "left")
    return out.withColumn("target", F.coalesce("_exact", "_any", value)).drop("_s", "_exact", "_f", "_any")


def enrich(matches: DataFrame, table: DataFrame) -> DataFrame:
    """Matches (source, target) with context and kind of the same pair, else
    of the first entry of the source; each (source, target, kind) once."""
    s, t = F.lower(trim(F.col("source"))), F.lower(trim(F.col("target")))
    known = table.select(s.alias("_s"), t.alias("_t"), text(F.col("context")).alias("context"), F.coalesce(F.nullif(trim(F.col("kind")), F.lit("")), F.lit("word")).alias("kind"), "ord")
    pair = known.groupBy("_s", "_t").agg(F.max_by(F.struct("context", "kind"), "ord").alias("_p"))
    first = known.groupBy("_s").agg(F.min_by(F.struct("context", "kind"), "ord").alias("_b"))
    out = matches.withColumn("_s", s).withColumn("_t", t).join(pair, ["_s", "_t"], "left").join(first, "_s", "left")
    best = F.coalesce("_p", "_b")
    rest = [c for c in matches.columns if c not in ("source", "target")]
    return out.select(*rest, trim(F.col("source")).alias("source"), trim(F.col("target")).alias("target"), F.coalesce(best["context"], F.lit("")).alias("context"), F.coalesce(best["kind"], F.lit("word")).alias("kind")).distinct()


# --- table rows and deltas --------------------------------------------------


def table_map(glossary: DataFrame, term_field: str, definition_field: str) -> DataFrame:
    """(term, definition) -> (target_term, target_definition), the last wins."""
    field = lambda name: trim(F.max(F.when(F.col("field") == name, F.col("value"))))
    wide = glossary.groupBy("kind", "source").agg(F.max("ord").alias("ord"), field("English Definition").alias("definition"), field(term_field).alias("target_term"), field(definition_field).alias("target_definition"))
    kept = wide.where("definition <> '' and trim(source) <> '' and (target_term <> '' or target_definition <> '')")
    return kept.groupBy(F.col("source").alias("term"), "definition").agg(F.max_by(F.struct("target_term", "target_definition"), "ord").alias("x")).select("term", "definition", "x.target_term", "x.target_definition")


def render_cell(cell: Column, put: Column) -> Column:
    """``put`` between the outer white space of the cell; blank keeps it."""
    t = trim(put)
    return F.when(t == "", cell).otherwise(F.concat(F.regexp_extract(cell, r"(?U)\A\s*", 0), t, F.regexp_extract(cell, r"(?U)\s*\z", 0)))


def expected_table_rows(rows: DataFrame, table: DataFrame, value: str = "content") -> DataFrame:
    """``rows`` with ``expected``: cells of a two-cell row whose trimmed pair
    is known, rendered; null for all other rows."""
    cells = F.split(F.col(value), "\t", -1)
    two = F.size(cells) == 2
    keyed = rows.withColumn("term", F.when(two, trim(F.get(cells, F.lit(0))))).withColumn("definition", F.when(two, trim(F.get(cells, F.lit(1)))))
    out = keyed.join(table, ["term", "definition"], "left")
    made = F.concat(render_cell(F.get(cells, F.lit(0)), F.col("target_term")), F.lit("\t"), render_cell(F.get(cells, F.lit(1)), F.col("target_definition")))
    return out.withColumn("expected", F.when(F.col("target_term").isNotNull(), made)).select(*rows.columns, "expected")


def changed_entries(new: DataFrame, old: DataFrame) -> DataFrame:
    """Entries whose target differs from that of the same source before."""
    before = old.groupBy(F.lower("source").alias("_k")).agg(F.max_by("target", "ord").alias("_old"))
    return new.withColumn("_k", F.lower("source")).join(before, "_k", "left").where(~F.col("target").eqNullSafe(F.col("_old"))).drop("_k", "_old")


def select_for_delta(groups: DataFrame, changed: DataFrame, source: str = "source_text", target: str = "target_text") -> DataFrame:
    """Groups with ``queried``: some changed entry applies to the source text
    while its target is missing from the present translation. A group is read
    by one trie for each MOST_BYTES of entries."""
    def needs(shared) -> Column:
        @F.pandas_udf("array<string>")
        def run(values: pd.Series) -> pd.Series:
            find, targets = _built(shared, lambda terms: (Applying([t[:3] for t in terms], pattern_of), [t[3] for t in terms]))
            return pd.Series([[targets[k] for k in find(v)] if v else [] for v in values], dtype=object)

        missing = lambda t: ~F.regexp_like(text(F.col(target)), term_pattern(t))
        return F.coalesce(F.exists(run.asNondeterministic()(text(F.col(source))), missing), F.lit(False))

    lists = list(_shards(changed.select("source", "contextual", "allow_ci", "target"), "source", "target"))
    if len(lists) == 1:
        return groups.withColumn("queried", needs(lists[0]))
    hit = reduce(DataFrame.union, [groups.where(needs(shared)).select("group_id") for shared in lists]).distinct().withColumn("queried", F.lit(True))
    return groups.join(hit, "group_id", "left").withColumn("queried", F.coalesce("queried", F.lit(False)))


def preserved_counts(rows: DataFrame, rules: Sequence[tuple[str, str]], source: str = "source", target: str = "target") -> DataFrame:
    """For each rule (id, pattern) and distinct phrase it finds in the source:
    how often it stands there and, literally, in the target."""
    parts = [rows.select("*", F.lit(rule).alias("rule_id"), F.explode(F.regexp_extract_all(text(F.col(source)), F.lit(pattern), F.lit(0))).alias("phrase")) for rule, pattern in rules]
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    counted = found.groupBy(*rows.columns, "rule_id", "phrase").agg(F.count("*").alias("expected"))
    return counted.withColumn("actual", count_exact(F.col(target), F.col("phrase")).cast("long"))
