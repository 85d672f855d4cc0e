"""Text ledgers of diagrams, and caption sheets.

A ledger row is a diagram with an array of text units; files are matched to it
by content hash, units by position within their kind.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.sorted_folds import fold_sorted
from ..functions.text import file_name_key, is_blank, is_pending, ordinal, text, trim

KINDS = ["prose", "sourceCode"]
LANGUAGE_ALIASES = {"brazilian portuguese": "Portuguese"}


def language_key(c: Column) -> Column:
    """Canonical language name: alias resolved, else trimmed."""
    names = F.create_map(*(F.lit(x) for pair in LANGUAGE_ALIASES.items() for x in pair))
    return F.coalesce(F.try_element_at(names, F.lower(trim(c))), trim(c))


def ledger_faults(ledger: DataFrame) -> DataFrame:
    """(file, fault) of rows that break the ledger's contract."""
    units = ledger.select("file", F.explode_outer("units").alias("u"))
    row = ledger.where((text(F.col("file")) == "") | (F.length(text(F.col("sha256"))) != 64) | F.col("units").isNull()).select("file", F.lit("name, hash or units missing").alias("fault"))
    bare = units.where(F.col("u").isNotNull() & ((text(F.col("u.id")) == "") | (text(F.col("u.plain")) == ""))).select("file", F.lit("unit without id or text").alias("fault"))
    kind = units.where(F.col("u").isNotNull() & ~F.coalesce(F.col("u.kind").isin(*KINDS), F.lit(False))).select("file", F.concat(F.lit("unknown kind of unit "), text(F.col("u.id"))).alias("fault"))
    again = units.where("u.id is not null").groupBy("u.id").agg(F.min("file").alias("file"), F.count("*").alias("n")).where("n > 1").select("file", F.concat(F.lit("repeated unit "), F.col("id")).alias("fault"))
    return row.union(bare).union(kind).union(again)


def match_files(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """``files`` (file, sha256) with ``entry_file`` and ``matched_by``: the
    only ledger row of the hash, else the only one of these whose name agrees
    but for case, "_" and spaces; else null and "none" or "ambiguous"."""
    rows = ledger.select(F.col("sha256"), F.col("file").alias("_entry"), file_name_key(F.col("file")).alias("_name"))
    joined = files.withColumn("_own", file_name_key(F.col("file"))).join(rows, "sha256", "left")
    found = joined.groupBy(*files.columns).agg(
        F.count("_entry").alias("_n"),
        F.min("_entry").alias("_any"),
        F.count_if(F.col("_name") == F.col("_own")).alias("_named"),
        F.min(F.when(F.col("_name") == F.col("_own"), F.col("_entry"))).alias("_by_name"),
    )
    how = F.when(F.col("_n") == 0, "none").when(F.col("_n") == 1, "sha256").when(F.col("_named") == 1, "sha256+name").otherwise("ambiguous")
    entry = F.when(F.col("_n") == 1, F.col("_any")).when(F.col("_named") == 1, F.col("_by_name"))
    return found.select(*files.columns, entry.alias("entry_file"), how.alias("matched_by"))


def exploded_units(ledger: DataFrame) -> DataFrame:
    """(book, file, pos, id, kind, plain, translations), one row per unit."""
    each = ledger.select("book", "file", F.posexplode("units").alias("pos", "u"))
    return each.select("book", "file", "pos", "u.id", "u.kind", "u.plain", "u.translations")


def pending_units(units: DataFrame, language: str) -> DataFrame:
    """Prose units without a translation into ``language``."""
    return units.where((F.col("kind") == "prose") & is_blank(F.try_element_at("translations", language_key(F.lit(language)))))


def translations_for(units: DataFrame, language: str) -> DataFrame:
    """(file, id, target) of the units that have one."""
    return units.select("file", "id", F.try_element_at("translations", language_key(F.lit(language))).alias("target")).where(~is_blank(F.col("target")))


def pending_counts(units: DataFrame, languages: Sequence[str]) -> DataFrame:
    """(file, language, pending) for every file and language."""
    each = units.select("file", "kind", "translations", F.explode(F.array(*map(F.lit, languages))).alias("language"))
    open_ = (F.col("kind") == "prose") & is_blank(F.try_element_at("translations", language_key(F.col("language"))))
    return each.groupBy("file", "language").agg(F.count_if(open_).alias("pending"))


def record_translations(units: DataFrame, new: DataFrame, language: str) -> DataFrame:
    """``units`` with ``new`` (file, id, target) put in their maps, and
    ``changed``: whether the map differs from before."""
    key = language_key(F.lit(language))
    joined = units.join(new.select("file", "id", F.col("target").alias("_t")), ["file", "id"], "left")
    base = F.coalesce("translations", F.create_map().cast("map<string,string>"))
    put = F.map_concat(F.map_filter(base, lambda k, _: k != key), F.create_map(key, F.col("_t")))
    now = F.when(F.col("_t").isNotNull(), put).otherwise(base)
    differs = F.col("_t").isNotNull() & ~F.col("_t").eqNullSafe(F.try_element_at(base, key))
    return joined.withColumn("changed", differs).withColumn("translations", now).drop("_t")


def reuse_translations(units: DataFrame, previous: DataFrame) -> DataFrame:
    """``units`` with the translations of the same file and id before, where
    the text is still the same."""
    old = previous.select("file", "id", F.col("plain").alias("_plain"), F.col("translations").alias("_old"))
    out = units.drop("translations").join(old, ["file", "id"], "left")
    same = F.col("_plain").eqNullSafe(F.col("plain"))
    return out.withColumn("translations", F.when(same, F.col("_old"))).withColumn("reused", F.coalesce(same & F.col("_old").isNotNull(), F.lit(False))).drop("_plain", "_old")


def match_report(units: DataFrame, report: DataFrame) -> DataFrame:
    """Faults of a positional report (file, kind, id, text, pos): each kind's
    units must come in ledger order with equal id and trimmed text."""
    place = F.row_number().over(W.partitionBy("file", "kind").orderBy("pos")).alias("n")
    a = units.select("file", "kind", place, F.col("id").alias("a_id"), trim(F.col("plain")).alias("a_text"))
    b = report.select("file", "kind", place, F.col("id").alias("b_id"), trim(F.col("text")).alias("b_text"))
    both = a.join(b, ["file", "kind", "n"], "full_outer")
    fault = F.when(F.col("a_id").isNull(), "not in ledger").when(F.col("b_id").isNull(), "not in report").when(F.col("a_id") != F.col("b_id"), "other unit").when(F.col("a_text") != F.col("b_text"), "other text")
    return both.withColumn("fault", fault).where(F.col("fault").isNotNull()).select("file", "kind", "n", "fault")


def missing_units(units: DataFrame, pages: DataFrame) -> DataFrame:
    """Units whose text, white space aside, is not in its file's page text."""
    bare = lambda c: F.regexp_replace(text(c), r"(?U)\s+", "")
    seen = pages.select("file", bare(F.col("text")).alias("_page"))
    return units.join(seen, "file", "left").where(~F.coalesce(F.col("_page").contains(bare(F.col("plain"))), F.lit(False))).drop("_page")


def ledger_lines(units: DataFrame) -> DataFrame:
    """One JSON line per unit, for an ordered text write."""
    return units.select("file", "pos", F.to_json(F.struct("id", "kind", "plain", "translations")).alias("line")).orderBy("file", "pos")


def compact(items: DataFrame, key: str = "id", order: str = "pos") -> DataFrame:
    """``items`` with ``alias`` t1, t2, ... for those without a local answer,
    per ``file``; the others keep null and their answer."""
    open_ = F.col("local").isNull()
    n = F.sum(open_.cast("int")).over(W.partitionBy("file").orderBy(order).rowsBetween(W.unboundedPreceding, 0))
    return items.withColumn("alias", F.when(open_, F.concat(F.lit("t"), n)))


def expand(items: DataFrame, answers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(translations, faults): answers (file, alias, translated) mapped back
    to ids, with local answers; faults are unknown, repeated or missing."""
    counted = answers.groupBy("file", "alias").agg(F.count("*").alias("n"), F.min("translated").alias("translated"))
    asked = items.where("alias is not null").select("file", "alias", "id")
    both = asked.join(counted, ["file", "alias"], "full_outer")
    fault = F.when(F.col("id").isNull(), "unknown").when(F.col("n").isNull(), "missing").when(F.col("n") > 1, "repeated")
    good = both.where("id is not null and n = 1").select("file", "id", "translated")
    local = items.where("alias is null").select("file", "id", F.col("local").alias("translated"))
    return good.union(local), both.withColumn("fault", fault).where("fault is not null").select("file", "alias", "fault")


def cursor_match(frames: DataFrame, units: DataFrame) -> DataFrame:
    """(file, id, frame_index, start): each unit at its first place after the
    match before it, across the frames of its file in order; null if there is
    none. Texts are compared with white space collapsed; start is an offset in
    the collapsed frame. A file's units are one sequence, so one task has its
    frames; files spread."""
    plain = lambda c: trim(F.regexp_replace(text(c), r"(?U)\s+", " "))
    place = lambda c: F.col(c).cast("long")
    none = F.lit(None).cast("string")
    rows = frames.select("file", place("frame_index").alias("o"), none.alias("id"), plain(F.col("text")).alias("t"))
    # Frames come before units; both are in order.
    rows = rows.unionByName(units.select("file", (place("pos") + UNITS_FROM).alias("o"), "id", plain(F.col("plain")).alias("t")))
    schema = rows.select("file", "id", F.col("o").alias("frame_index"), F.col("o").alias("start")).schema
    return fold_sorted(rows, ["file"], "o", _Cursor, schema)


#: Sort numbers of units start here; those of frames stay below.
UNITS_FROM = 1 << 40


class _Cursor:
    """Frames of one file, and the place after the last match in them."""

    def __init__(self):
        self.frames: list[tuple[int, str]] = []
        self.frame = self.at = 0

    def _find(self, t: str) -> tuple[int | None, int | None]:
        for f in range(self.frame, len(self.frames)) if t else ():
            found = self.frames[f][1].find(t, self.at if f == self.frame else 0)
            if found >= 0:
                self.frame, self.at = f, found + len(t)
                return self.frames[f][0], found
        return None, None

    def add(self, rows: list[tuple]) -> list[tuple]:
        out = []
        for file, place, ident, t in rows:
            if place < UNITS_FROM:
                self.frames.append((place, t))
            else:
                out.append((file, ident, *self._find(t)))
        return out

    def end(self) -> list[tuple]:
        return []


# --- captions ---------------------------------------------------------------


def caption_pending(sheet: DataFrame, source: str = "english", target: str = "portuguese") -> DataFrame:
    """Rows to be translated, with row ids."""
    return sheet.where(is_pending(F.col(source), F.col(target))).withColumn("row_id", ordinal("row_", 6, F.col("row_no")))


def put_captions(sheet: DataFrame, new: DataFrame, target: str = "portuguese") -> DataFrame:
    """``sheet`` with ``new`` (row_no, translated) in the target column."""
    out = sheet.join(new.select("row_no", F.col("translated").alias("_t")), "row_no", "left")
    return out.withColumn(target, F.coalesce("_t", target)).select(*sheet.columns)


def caption_changes(before: DataFrame, after: DataFrame, new: DataFrame, target: str = "portuguese") -> DataFrame:
    """Cells that differ otherwise than ``new`` allows, in long form; empty
    for a faithful update."""
    want = put_captions(before, new, target)
    cols = [c for c in before.columns if c != "row_no"]
    long = lambda df, name: df.select("row_no", F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias(name)) for c in cols))).alias("x")).select("row_no", "x.column", f"x.{name}")
    both = long(want, "expected").join(long(after, "actual"), ["row_no", "column"], "full_outer")
    return both.where(~F.col("expected").eqNullSafe(F.col("actual")))
