"""Keyed reconciliation: full-outer checks, set equality, updates, rule sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import content_id, decode_style, style_leaf, text
from .orders import ranked
from .segments import first_of


def differences(left: DataFrame, right: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Full-outer comparison on keys: rows only left, only right, with another
    value, or whose key repeats; empty means both tables agree."""
    l, r = (df.groupBy(*keys).agg(F.count("*").alias(f"n_{s}"), F.min(value).alias(f"v_{s}")) for df, s in ((left, "l"), (right, "r")))
    both = l.join(r, list(keys), "full_outer")
    state = F.when(F.col("n_r").isNull(), "left only").when(F.col("n_l").isNull(), "right only").when((F.col("n_l") > 1) | (F.col("n_r") > 1), "repeated").when(~F.col("v_l").eqNullSafe(F.col("v_r")), "differs")
    return both.withColumn("state", state).where(F.col("state").isNotNull()).select(*keys, "state")


def duplicates(rows: DataFrame, key: str, most: int = 20) -> DataFrame:
    """The first keys that occur more than once, and how often."""
    return rows.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").orderBy(key).limit(most)


def same_set(left: DataFrame, right: DataFrame) -> bool:
    """Equal as multisets of rows."""
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def missing(wanted: DataFrame, present: DataFrame, key: str) -> DataFrame:
    return wanted.join(present.select(key).distinct(), key, "left_anti")


def update_values(rows: DataFrame, values: DataFrame, key: str, column: str, complete: bool = False) -> DataFrame:
    """``rows`` with ``column`` from ``values`` (key, value) where listed;
    ``complete``: every listed key must occur, else an error."""
    out = rows.join(values.select(key, F.col("value").alias("_v")), key, "left").withColumn(column, F.coalesce("_v", column)).select(*rows.columns)
    if complete:
        gone = missing(values, rows, key)
        if not gone.isEmpty():
            raise ValueError(f"keys without a row: {[r[key] for r in gone.limit(5).collect()]}")
    return out


def by_content_id(rows: DataFrame, column: str = "content_tag") -> DataFrame:
    return rows.withColumn("content_id", content_id(F.col(column)))


def exactly_one(rows: DataFrame, wanted: Column, key: str = "name") -> DataFrame:
    """Rows equal to a name but for case; an error if not exactly one."""
    found = rows.where(F.lower(key) == F.lower(wanted))
    n = found.count()
    if n != 1:
        raise ValueError(f"expected exactly one match, found {n}")
    return found


def select_styles(paragraphs: DataFrame, selectors: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(matches, faults): paragraphs whose style a selector names.

    A selector with ":" or "/" names a whole path, any other a last part;
    case does not count. Faults: selectors without a match, and last parts
    that several styles share.
    """
    spark = paragraphs.sparkSession
    rows = [(s, s.lower(), any(c in s for c in ":/")) for s in dict.fromkeys(x.strip() for x in selectors) if s]
    wanted = spark.createDataFrame(rows, "selector string, k string, is_path boolean")
    styled = paragraphs.withColumn("applied_style", decode_style(F.col("style"))).withColumn("_leaf", F.lower(style_leaf(F.col("style")))).withColumn("_path", F.lower("applied_style"))
    by_path = styled.join(wanted.where("is_path"), F.col("_path") == F.col("k"))
    by_leaf = styled.join(wanted.where("not is_path"), F.col("_leaf") == F.col("k"))
    found = by_path.union(by_leaf).drop("k", "is_path", "_leaf", "_path")
    used = found.groupBy("selector").agg(F.countDistinct("applied_style").alias("n"))
    faults = wanted.join(used, "selector", "left").withColumn("fault", F.when(F.col("n").isNull(), "not found").when(~F.col("is_path") & (F.col("n") > 1), "ambiguous"))
    return found, faults.where("fault is not null").select("selector", "fault")


def catalog_choice(catalog: DataFrame, wanted: DataFrame, key: str = "slug") -> DataFrame:
    """(key, state) of each wanted entry: "chosen" if the ``catalog`` (key,
    visibility, upgrade) lists it exactly once, visibly and without a successor;
    else "absent", "repeated", "hidden" or "superseded". No other entry takes
    the place of one that is not chosen."""
    listed = catalog.groupBy(key).agg(F.count("*").alias("n"), F.min("visibility").alias("visibility"), F.max(text(F.col("upgrade"))).alias("upgrade"))
    state = (
        F.when(F.col("n").isNull(), "absent")
        .when(F.col("n") > 1, "repeated")
        .when(~F.col("visibility").eqNullSafe(F.lit("list")), "hidden")
        .when(F.col("upgrade") != "", "superseded")
        .otherwise("chosen")
    )
    return wanted.select(key).distinct().join(listed, key, "left").select(key, state.alias("state"))


# --- rule sets --------------------------------------------------------------


def merge_strings(base: DataFrame, more: DataFrame, value: str = "value", order: str = "ord") -> DataFrame:
    """Ordered union, case-insensitive, the first spelling stays."""
    both = base.withColumn("_part", F.lit(0)).unionByName(more.withColumn("_part", F.lit(1))).withColumn("_k", F.lower(value)).withColumn("_place", F.struct("_part", order))
    return first_of(both, ["_k"], "_place").orderBy("_place").drop("_part", "_k", "_place")


def merge_rules(base: DataFrame, more: DataFrame, key: str = "id", order: str = "ord") -> DataFrame:
    """Upsert by id: ``more`` replaces, in the place that the base gives."""
    rest = [c for c in base.columns if c not in (key, order)]
    a = base.select(key, F.col(order).alias("_a"), *(F.col(c).alias(f"_a_{c}") for c in rest), F.lit(True).alias("_in_a"))
    b = more.select(key, F.col(order).alias("_b"), *(F.col(c).alias(f"_b_{c}") for c in rest), F.lit(True).alias("_in_b"))
    both = a.join(b, key, "full_outer")
    cols = [F.when(F.col("_in_b"), F.col(f"_b_{c}")).otherwise(F.col(f"_a_{c}")).alias(c) for c in rest]
    # Rules of the base first, in its order; then new ones in theirs.
    placed = both.select(key, F.coalesce(~F.col("_in_a"), F.lit(True)).alias("_new"), F.coalesce("_a", "_b").alias("_n"), *cols)
    return ranked(placed, ["_new", "_n", key], order).withColumn(order, F.col(order).cast("int")).select(*base.columns)


def rule_set(rules: DataFrame, book: str, language: str) -> DataFrame:
    """Rules of a book: the base, with the language's exceptions upserted
    within each rule type."""
    own = rules.where(F.col("book") == book)
    base, more = own.where("scope = 'base'"), own.where(F.lower("scope") == language.lower())
    keep = base.join(more.select("rule_type", "id").distinct(), ["rule_type", "id"], "left_anti")
    return keep.unionByName(more)


# The rule whose matches take a qualifier, and the qualifier.
QUALIFIED_RULE = "official_unit_type_abbreviation"
QUALIFIER = r"(?<![A-Za-z0-9_])Headquarters(?:\s+and\s+(?:Headquarters|Service|Support))?\s+"


def effective_pattern(rule_id: str, pattern: str) -> str:
    """Pattern as it is searched: an abbreviated unit type takes a preceding
    headquarters qualifier into the match."""
    return rf"(?:{QUALIFIER})?(?:{pattern})" if rule_id == QUALIFIED_RULE else pattern


def stage_rules(rules: DataFrame, language: str, stage: str) -> DataFrame:
    """Shared rules and those of a language that hold at a stage; ``rules``
    has language ("All" for shared ones) and stages."""
    return rules.where(F.lower("language").isin("all", language.strip().lower()) & F.array_contains("stages", stage))


def pattern_faults(rules: DataFrame) -> DataFrame:
    """Rules with a blank or repeated id, or a pattern that does not compile
    (tested by the engine that will run it)."""
    counted = rules.groupBy("rule_type", "id").agg(F.count("*").alias("n"))
    bad = counted.where("n > 1 or trim(id) = ''").select("rule_type", "id", F.lit("blank or repeated id").alias("fault"))
    # The engine itself tries each pattern, in the tasks.
    known = rules.select("rule_type", "id", "pattern").distinct()
    wrong = known.where(F.try_reflect(F.lit("java.util.regex.Pattern"), F.lit("compile"), F.col("pattern")).isNull()).select("rule_type", "id", F.lit("pattern does not compile").alias("fault"))
    return bad.union(wrong)


def inventory_faults(inventory: DataFrame, files: DataFrame) -> DataFrame:
    """Listed paths that are missing or whose hash differs, and files that are
    not listed; hashes compare without case."""
    a = inventory.select("path", F.upper("sha256").alias("_want"))
    b = files.select("path", F.upper("sha256").alias("_have"))
    both = a.join(b, "path", "full_outer")
    fault = F.when(F.col("_have").isNull(), "missing").when(F.col("_want").isNull(), "not listed").when(F.col("_want") != F.col("_have"), "changed")
    return both.withColumn("fault", fault).where("fault is not null").select("path", "fault")


def response_faults(asked: DataFrame, answered: DataFrame, locks: Column | None = None) -> DataFrame:
    """(id, fault) of translations (id, translated) against what was asked
    (id, source, skip): ids, blanks, skippables, break counts."""
    from ..functions.text import count_breaks, is_blank

    counted = answered.groupBy("id").agg(F.count("*").alias("n"), F.min("translated").alias("translated"))
    both = asked.join(counted, "id", "full_outer")
    fault = (
        F.when(F.col("source").isNull(), "unknown")
        .when(F.col("n").isNull(), "missing")
        .when(F.col("n") > 1, "repeated")
        .when(F.col("skip") & (F.col("translated") != F.col("source")), "changed a skipped text")
        .when(~is_blank(F.col("source")) & is_blank(F.col("translated")), "blank")
        .when(count_breaks(F.col("source")) != count_breaks(F.col("translated")), "line breaks differ")
    )
    if locks is not None:
        fault = F.coalesce(fault, F.when(F.exists(locks, lambda k: ~text(F.col("translated")).contains(k)), F.lit("lock missing")))
    return both.withColumn("fault", fault).where("fault is not null").select("id", "fault")
