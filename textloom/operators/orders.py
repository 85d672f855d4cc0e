"""Positions in an order of any columns, without one task for all rows.

Rows are cut into ranges of the order of about equal count; each range is
numbered by its own task, and only the totals of the ranges, at most RANGES
rows, are added up in one place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: Ranges that an order is cut into at most.
RANGES = 256


def range_of(rows: DataFrame, order: Sequence[str]) -> Column:
    """Number of the range that a row falls into, by the first rows of all
    ranges but one: these few are collected and stand in the expression."""
    n = min(RANGES, max(8, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    dealt = rows.select(*order).repartitionByRange(n, *order)
    firsts = dealt.groupBy(F.spark_partition_id().alias("p")).agg(F.min(F.struct(*order)).alias("x")).orderBy("p").collect()
    kinds = {f.name: f.dataType for f in rows.select(*order).schema}
    bounds = [F.struct(*(F.lit(r["x"][c]).cast(kinds[c]).alias(c) for c in order)) for r in firsts[1:]]
    own = F.struct(*order)
    return F.size(F.filter(F.array(*bounds), lambda b: b <= own)) if bounds else F.lit(0)


def _earlier(totals: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Totals of all ranges before; at most RANGES rows."""
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    return totals.select("_range", *(c.over(before).alias(name) for name, c in columns.items()))


def ranked(rows: DataFrame, order: Sequence[str], name: str = "rank", values: Sequence[str] = ()) -> DataFrame:
    """``rows`` with ``name``: 1, 2, ... in ``order`` (ascending, nulls first),
    and for each of ``values`` ``before_<value>``: its sum over all rows before."""
    placed = rows.withColumn("_range", range_of(rows, order))
    spec = W.partitionBy("_range").orderBy(*order)
    upto = spec.rowsBetween(W.unboundedPreceding, -1)
    lower = placed.withColumn("_n", F.row_number().over(spec))
    for v in values:
        lower = lower.withColumn(f"_sum_{v}", F.coalesce(F.sum(v).over(upto), F.lit(0)))
    totals = placed.groupBy("_range").agg(F.count("*").alias("_n"), *(F.sum(v).alias(f"_sum_{v}") for v in values))
    names = ["_n", *(f"_sum_{v}" for v in values)]
    upper = _earlier(totals, {f"_upto{c}": F.sum(c) for c in names})
    full = lower.join(F.broadcast(upper), "_range")
    add = lambda c: F.col(c) + F.coalesce(f"_upto{c}", F.lit(0))
    return full.select(*rows.columns, add("_n").cast("long").alias(name), *(add(f"_sum_{v}").alias(f"before_{v}") for v in values))


def filled_down(rows: DataFrame, columns: Sequence[str], order: str) -> DataFrame:
    """Null cells take the last value above them, in the order of all rows."""
    placed = rows.withColumn("_range", range_of(rows, [order]))
    upto = W.partitionBy("_range").orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
    last = placed.groupBy("_range").agg(*(F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in columns))
    upper = _earlier(last, {f"_above_{c}": F.last(c, ignorenulls=True) for c in columns})
    out = placed
    for c in columns:
        out = out.withColumn(c, F.last(c, ignorenulls=True).over(upto))
    out = out.join(F.broadcast(upper), "_range")
    return out.select(*(F.coalesce(c, f"_above_{c}").alias(c) if c in columns else F.col(c) for c in rows.columns))
