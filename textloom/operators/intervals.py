"""Joins of tables of intervals on overlap, by cells of fitting size.

An interval belongs to the level whose cells are as long as it, or up to twice
as long, so it touches at most two cells there, whatever its length. It also
enters the cells of all coarser levels that the other table has. Two intervals
meet in the cells of the coarser one's level, and are given in the one cell
that holds the later start: each pair once, by an equi-join on the cell.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _level(start: Column, end: Column) -> Column:
    """Bits of the smallest power of two that is as long as the interval."""
    long = F.greatest(end - start, F.lit(1).cast("long"))
    return F.when(long == 1, 0).otherwise(F.length(F.bin(long - 1)))


def _entries(rows: DataFrame, start: str, end: str, levels: list[int]) -> DataFrame:
    """(row, s, e, own, level, cell): the cells of a row at its own level and
    all coarser ones among ``levels``."""
    s, e = F.col(start).cast("long"), F.col(end).cast("long")
    own = _level(s, e)
    every = F.array_distinct(F.concat(F.array(own), F.filter(F.array(*map(F.lit, levels)).cast("array<int>"), lambda k: k > own)))
    rows = rows.select(F.struct(*rows.columns).alias("row"), s.alias("s"), e.alias("e"), own.alias("own"), F.explode(every).alias("level")).where("s is not null and e is not null and e >= s")
    last = F.expr("shiftright(greatest(e - 1, s), level)")
    return rows.withColumn("cell", F.explode(F.sequence(F.expr("shiftright(s, level)"), last)))


def overlapping(left: DataFrame, right: DataFrame, keys: Sequence[str], start: str = "start", end: str = "end") -> DataFrame:
    """(keys, left: struct, right: struct) of all pairs with equal ``keys``
    and left.start < right.end, right.start < left.end.

    Starts and ends are whole numbers; an empty interval inside another
    overlaps it. Rows with a null key or bound, or an end before the start,
    overlap nothing. Repeated rows give repeated pairs. The key of most rows
    is dealt out by its cells, so only intervals that are close to each other
    meet in a task, and long intervals do not multiply.
    """
    s, e = F.col(start).cast("long"), F.col(end).cast("long")
    seen = lambda df: [r[0] for r in df.where(e >= s).select(_level(s, e).alias("k")).distinct().collect()]  # noqa: E731  at most 64
    in_left, in_right = seen(left), seen(right)
    a = _entries(left, start, end, in_right).select(*(F.col("row")[k].alias(k) for k in keys), "level", "cell", F.col("row").alias("left"), F.col("s").alias("ls"), F.col("e").alias("le"), F.col("own").alias("lo"))
    b = _entries(right, start, end, in_left).select(*(F.col("row")[k].alias(k) for k in keys), "level", "cell", F.col("row").alias("right"), F.col("s").alias("rs"), F.col("e").alias("re"), F.col("own").alias("ro"))
    met = a.join(b, [*keys, "level", "cell"])
    exact = (F.col("ls") < F.col("re")) & (F.col("rs") < F.col("le"))
    once = (F.col("level") == F.greatest("lo", "ro")) & (F.col("cell") == F.expr("shiftright(greatest(ls, rs), level)"))
    return met.where(exact & once).select(*keys, "left", "right")


def overlap_counts(left: DataFrame, right: DataFrame, keys: Sequence[str], ids: Sequence[str], start: str = "start", end: str = "end") -> DataFrame:
    """(keys, ids, n): for each row of ``left`` that overlaps any, how many
    rows of ``right``. Counted in the cells first, so pairs are not moved."""
    pairs = overlapping(left.select(*dict.fromkeys([*keys, *ids, start, end])), right.select(*keys, start, end), keys, start, end)
    rest = [c for c in ids if c not in keys]
    return pairs.groupBy(*keys, *(F.col("left")[c].alias(c) for c in rest)).agg(F.count("*").alias("n"))


def protected_matches(matches: DataFrame, ranges: DataFrame, keys: Sequence[str], styles: Sequence[str], style: str = "style") -> DataFrame:
    """``matches`` (keys, start, end, style) with ``reason``: why a match may
    not change: its style is protected, it overlaps a row of ``ranges`` (keys,
    start, end), or null. Equal places of a key are looked up once."""
    place = [*keys, "start", "end"]
    pairs = overlapping(matches.select(*place).distinct(), ranges.select(*place).distinct(), keys)
    hit = pairs.select(*keys, "left.start", "left.end").distinct().withColumn("_hit", F.lit(True))
    styled = F.col(style).isin(*styles) if styles else F.lit(False)
    return matches.join(hit, place, "left").select(*matches.columns, F.when(styled, "style").when(F.col("_hit"), "reference").alias("reason"))
