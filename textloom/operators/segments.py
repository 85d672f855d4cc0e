"""Content groups: running boundaries, composites, orphans, runs, ordinals.

A document's rows are ordered by ``row_no``; a row whose ``psr_id`` is not
empty starts a group. ``keys`` name the columns of a document, so windows run
per document and never over a whole corpus.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.text import has_content, ordinal, text
from .orders import filled_down


def _upto(keys: Sequence[str], order: str = "row_no") -> W:
    return W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)


def number_groups(rows: DataFrame, keys: Sequence[str], boundary: Column | None = None) -> DataFrame:
    """``rows`` with ``group_no``: boundaries so far; 0 before the first."""
    starts = has_content(F.col("psr_id")) if boundary is None else boundary
    return rows.withColumn("group_no", F.sum(F.when(starts, 1).otherwise(0)).over(_upto(keys)))


def ordered_text(order: str, value: Column, separator: str = "") -> Column:
    """Aggregate: the values of a group, joined in order."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), value.alias("v"))))
    return F.array_join(F.transform(pairs, lambda x: x["v"]), separator)


def content_groups(rows: DataFrame, keys: Sequence[str], boundary: Column | None = None) -> DataFrame:
    """One row for each group: its rows, its segments (content that is not
    empty) and the composite stated at its head. Orphans are left out."""
    numbered = number_groups(rows, keys, boundary).where("group_no > 0")
    item = F.struct("row_no", text(F.col("content")).alias("content"), text(F.col("psr_content")).alias("head"))
    packed = numbered.groupBy(*keys, "group_no").agg(F.array_sort(F.collect_list(item)).alias("x"))
    full = F.filter("x", lambda i: i["content"] != "")
    return packed.select(
        *keys,
        F.col("group_no").cast("long").alias("group_no"),
        ordinal("group_", 6, F.col("group_no")).alias("group_id"),
        F.col("x")[0]["row_no"].alias("start_row"),
        F.col("x")[0]["head"].alias("composite"),
        F.transform("x", lambda i: i["row_no"]).alias("rows"),
        F.transform(full, lambda i: i["row_no"]).alias("segment_rows"),
        F.transform(full, lambda i: i["content"]).alias("segments"),
    )


def composites(rows: DataFrame, keys: Sequence[str], boundary: Column | None = None) -> DataFrame:
    """(keys, group_no, start_row, composite): contents of all rows joined."""
    numbered = number_groups(rows, keys, boundary).where("group_no > 0")
    return numbered.groupBy(*keys, "group_no").agg(F.min("row_no").alias("start_row"), ordered_text("row_no", text(F.col("content"))).alias("composite"))


def rebuild_composites(source: DataFrame, output: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``output`` with psr_content anew: the composite at each group head of
    ``source``, empty elsewhere."""
    bounds = source.select(*keys, "row_no", F.col("psr_id").alias("_id"))
    joined = output.join(bounds, [*keys, "row_no"], "left")
    heads = composites(joined.drop("psr_id").withColumnRenamed("_id", "psr_id"), keys).select(*keys, F.col("start_row").alias("row_no"), "composite")
    return output.join(heads, [*keys, "row_no"], "left").withColumn("psr_content", F.coalesce("composite", F.lit(""))).select(*output.columns)


def orphan_rows(rows: DataFrame, keys: Sequence[str], boundary: Column | None = None) -> DataFrame:
    """Rows before the first boundary that hold anything."""
    cells = ["psr_id", "psr_content", "content_tag", "content"]
    filled = F.exists(F.array(*(text(F.col(c)) for c in cells)), lambda c: c != "")
    return number_groups(rows, keys, boundary).where((F.col("group_no") == 0) & filled).drop("group_no")


def style_runs(rows: DataFrame, kind: str, value: str, keys: Sequence[str], order: str) -> DataFrame:
    """Maximal runs of rows with equal ``kind``, in order: gaps and islands.
    The values of a run are joined."""
    w = W.partitionBy(*keys).orderBy(order)
    changed = F.when(F.lag(kind).over(w).eqNullSafe(F.col(kind)), 0).otherwise(1)
    # The first row has no predecessor, also where its kind is null.
    first = F.row_number().over(w) == 1
    marked = rows.withColumn("_new", F.when(first, 1).otherwise(changed))
    marked = marked.withColumn("run_no", F.sum("_new").over(_upto(keys, order)))
    return marked.groupBy(*keys, "run_no", kind).agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count("*").alias("n"), ordered_text(order, text(F.col(value))).alias("text"))


def fill_down(rows: DataFrame, columns: Sequence[str], keys: Sequence[str], order: str = "row_no") -> DataFrame:
    """Blank cells take the last value above them, within ``keys`` or, without
    any, in the order of all rows (by ranges, not in one task)."""
    blank = lambda c: F.nullif(F.trim(c), F.lit(""))
    if not keys:
        held = filled_down(rows.withColumns({c: blank(c) for c in columns}), columns, order)
        return held.withColumns({c: F.coalesce(c, F.lit("")) for c in columns})
    w = _upto(keys, order)
    for c in columns:
        rows = rows.withColumn(c, F.coalesce(F.last(blank(c), ignorenulls=True).over(w), F.lit("")))
    return rows


def section_of(rows: DataFrame, is_heading: Column, keys: Sequence[str], order: str = "row_no") -> DataFrame:
    """``rows`` with ``in_section``: true from the heading row on. Without
    ``keys`` all rows are one document, and its first heading is looked up."""
    if not keys:
        first = rows.where(is_heading).agg(F.min(order)).first()[0]
        return rows.withColumn("in_section", F.lit(False) if first is None else F.coalesce(F.col(order) >= F.lit(first), F.lit(False)))
    w = _upto(keys, order)
    return rows.withColumn("in_section", F.max(F.when(is_heading, 1).otherwise(0)).over(w) == 1)


#: Ranges of the upper level of a prefix sum.
RANGES = 256


def prefix_sums(rows: DataFrame, order: str, values: Sequence[str]) -> DataFrame:
    """(order, one column ``before_<value>`` each): sums over all rows before,
    for rows with distinct numbers in ``order``.

    Two levels: rows are cut into ranges of about equal count, each summed by
    its own task, and only the totals of the ranges are summed in one place.
    """
    cuts = rows.agg(F.percentile_approx(order, [k / RANGES for k in range(1, RANGES)], F.lit(10_000))).first()[0] or []
    bounds = F.array(*(F.lit(c) for c in sorted(set(cuts)))) if cuts else F.array().cast("array<long>")
    placed = rows.select(order, *values, F.size(F.filter(bounds, lambda c: c < F.col(order))).alias("_range"))
    inside = W.partitionBy("_range").orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    lower = placed.select(order, "_range", *(F.coalesce(F.sum(v).over(inside), F.lit(0)).alias(f"_{v}") for v in values))
    totals = placed.groupBy("_range").agg(*(F.sum(v).alias(v) for v in values))
    earlier = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)  # at most RANGES rows
    upper = totals.select("_range", *(F.coalesce(F.sum(v).over(earlier), F.lit(0)).alias(f"_upto_{v}") for v in values))
    return lower.join(F.broadcast(upper), "_range").select(order, *((F.col(f"_{v}") + F.col(f"_upto_{v}")).alias(f"before_{v}") for v in values))


def global_ids(rows: DataFrame, file_no: str = "file_no", order: str = "pos", width: int = 5, name: str = "global_id") -> DataFrame:
    """Ids over all files, in the order of their numbers, from per-file counts
    and a prefix sum of these."""
    counts = rows.groupBy(file_no).agg(F.count("*").alias("n"))
    place = F.row_number().over(W.partitionBy(file_no).orderBy(order))
    return rows.withColumn("_place", place).join(prefix_sums(counts, file_no, ["n"]), file_no).withColumn(name, F.format_string(f"%0{width}d", F.col("before_n") + F.col("_place"))).drop("_place", "before_n")


def first_of(rows: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Stable distinct: the first row of each key, in order."""
    everything = F.struct(F.col(order).alias("_o"), *rows.columns)
    kept = rows.groupBy(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys))).agg(F.min_by(everything, F.col(order)).alias("_r"))
    return kept.select(*(F.col("_r")[c].alias(c) for c in rows.columns))
