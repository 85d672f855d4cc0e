"""Ordered greedy packing, resumption and selection of work."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.text import ordinal
from ..sources.files import written
from .orders import ranked

# Default limits (characters, groups, segments; diagrams, items,
# characters; rows, characters).
TEXT_LIMITS = (24_000, 100, 300)
DIAGRAM_LIMITS = (8, 160, 24_000)
CAPTION_LIMITS = (40, 12_000)


#: Rows of a chunk of the order that one task packs at once.
CHUNK = 1 << 15


class _Chunk:
    """Rows of one chunk in order, and the first ones of the next.

    ``rank`` counts all rows of all keys from 0; ``first`` marks the first row
    of a key. ``succ`` is, for each row, where the next batch begins if one
    begins there: found by searching the prefix sums of each size.
    """

    def __init__(self, pdf: pd.DataFrame, sizes: Sequence[str], limits: Sequence[int], most_rows: int, chunk: int):
        self.pdf = pdf = pdf.sort_values("rank", ignore_index=True)
        n = len(pdf)
        at = np.arange(n)
        self.base = int(pdf["chunk"].iloc[0]) * chunk
        self.own = int((pdf["rank"].to_numpy() < self.base + chunk).sum())
        self.first = pdf["first"].to_numpy(dtype=bool)
        succ = np.minimum(at + most_rows, n)
        for size, most in zip(sizes, limits):
            total = np.concatenate([[0], np.cumsum(pdf[size].to_numpy(dtype=np.int64))])
            succ = np.minimum(succ, np.searchsorted(total[1:], total[:-1] + most, side="right"))
        # A row beyond a limit stands alone; a batch ends with its key.
        succ = np.maximum(succ, at + 1)
        firsts = np.append(np.flatnonzero(self.first), n)
        self.succ = np.minimum(succ, firsts[np.searchsorted(firsts, at, side="right")])

    def walk(self, entry: int) -> list[int]:
        """Own rows at which a batch begins, if one begins at ``entry``."""
        out = []
        while entry < self.own:
            out.append(entry)
            entry = int(self.succ[entry])
        return out

    def exits(self, most_rows: int) -> list[tuple[int, int, bool]]:
        """For each entry (next entry, batches since a key began or else since
        the entry, whether a key began)."""
        n = self.own
        leave, many, began = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64), np.zeros(n, dtype=bool)
        for i in range(n - 1, -1, -1):
            j = int(self.succ[i])
            if j >= n:
                leave[i], many[i] = j - n, 1
            else:
                leave[i], began[i] = leave[j], began[j] or self.first[j]
                many[i] = many[j] + (0 if began[i] else 1)
        out = []
        for entry in range(most_rows):
            if entry >= n:  # a batch that jumps over a short last chunk
                out.append((entry - n, 0, False))
            else:
                out.append((int(leave[entry]), int(many[entry]), bool(began[entry] or self.first[entry])))
        return out


def next_fit(rows: DataFrame, order: str, sizes: Sequence[str], limits: Sequence[int], most_rows: int, keys: Sequence[str], oversize: str = "error", chunk: int | None = None) -> DataFrame:
    """``rows`` with ``batch_no``, packed in order within ``keys``.

    A row joins the open batch unless it would pass one of the ``limits`` of
    its ``sizes``, or the batch has ``most_rows``. A row beyond a limit by
    itself is an error, or stands alone (``oversize="alone"``). Sizes are not
    negative; ``keys`` are not null and may be none; (keys, order) is unique.

    No task sees a whole key. All rows are numbered in the order of (keys,
    order) and cut into chunks. A batch has at most ``most_rows`` rows, so the
    batches that reach a chunk begin the next ones at one of its first
    ``most_rows`` rows: a chunk is a map from such entries to those of the
    next. Maps of 1, 2, 4, ... chunks are composed until each chunk's entry is
    known; then all chunks are packed at the same time.
    """
    if len(sizes) != len(limits) or min([most_rows, *limits]) <= 0:
        raise ValueError("limits must be positive, one for each size")
    spark = rows.sparkSession
    chunk = max(chunk or CHUNK, most_rows)
    checked = rows
    if oversize == "error":
        for s, most in zip(sizes, limits):
            checked = checked.withColumn(s, F.when(F.col(s) <= most, F.col(s)).otherwise(F.raise_error(F.concat(F.lit(f"{s} over the limit of {most}: "), F.col(order)))))
    narrow = checked.select(*keys, order, *(F.col(s).cast("long").alias(s) for s in sizes))
    placed = ranked(narrow, [*keys, order]).withColumn("rank", F.col("rank") - 1)
    placed = written(placed, "packing")
    heads = placed.groupBy(*keys).agg(F.min("rank").alias("rank")) if keys else placed.agg(F.min("rank").alias("rank")).where("rank is not null")
    marked = placed.join(heads.select("rank", F.lit(True).alias("first")), "rank", "left").withColumn("first", F.coalesce("first", F.lit(False)))
    own = F.expr(f"rank div {chunk}")
    reach = F.when((F.col("rank") % chunk < most_rows) & (F.col("rank") >= chunk), F.array(own, own - 1)).otherwise(F.array(own))
    dealt = written(marked.select("rank", "first", *sizes, F.explode(reach).alias("chunk")), "packing")

    def maps(pdf: pd.DataFrame) -> pd.DataFrame:
        c = _Chunk(pdf, sizes, limits, most_rows, chunk)
        out = pd.DataFrame([(i, *x) for i, x in enumerate(c.exits(most_rows))], columns=["entry", "leave", "many", "began"])
        return out.assign(chunk=pdf["chunk"].iloc[0])

    step = written(dealt.groupBy("chunk").applyInPandas(maps, "entry long, leave long, many long, began boolean, chunk long"), "packing")
    last = placed.agg(F.coalesce(F.max("rank"), F.lit(-1))).first()[0] // chunk
    known = spark.createDataFrame([(0, 0, 0)], "chunk long, entry long, many long")
    span = 1
    while span <= last:
        reached = known.join(step, ["chunk", "entry"]).where(F.col("chunk") + span <= last)
        new = reached.select((F.col("chunk") + span).alias("chunk"), F.col("leave").alias("entry"), F.when(step["began"], step["many"]).otherwise(known["many"] + step["many"]).alias("many"))
        known = written(known.unionByName(new), "packing")
        span *= 2
        if span <= last:
            after = step.select((F.col("chunk") - span // 2).alias("chunk"), F.col("entry").alias("leave"), F.col("leave").alias("_leave"), F.col("many").alias("_many"), F.col("began").alias("_began"))
            many = F.when(F.col("_began"), F.col("_many")).otherwise(F.col("many") + F.col("_many"))
            step = written(step.join(after, ["chunk", "leave"]).select("chunk", "entry", F.col("_leave").alias("leave"), many.alias("many"), (F.col("began") | F.col("_began")).alias("began")), "packing")

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        c = _Chunk(pdf, sizes, limits, most_rows, chunk)
        begins = np.zeros(c.own, dtype=np.int64)
        begins[c.walk(int(pdf["entry"].iloc[0]))] = 1
        number = np.cumsum(begins) + int(pdf["many"].iloc[0])
        # The first row of a key begins batch 1.
        firsts = np.flatnonzero(c.first[: c.own])
        base = np.concatenate([[0], number[firsts] - 1])
        return pd.DataFrame({"rank": c.base + np.arange(c.own), "batch_no": number - base[np.searchsorted(firsts, np.arange(c.own), side="right")]})

    entries = known.select("chunk", "entry", "many")
    numbered = dealt.join(entries, "chunk").groupBy("chunk").applyInPandas(pack, "rank long, batch_no int")
    return rows.join(placed.select(*keys, order, "rank").join(numbered, "rank").drop("rank"), [*keys, order])


def text_batches(groups: DataFrame, keys: Sequence[str], limits: tuple[int, int, int] = TEXT_LIMITS, oversize: str = "error") -> DataFrame:
    """Groups (ord, chars, segments) with batch_no and batch_id; a group over
    the limits is an error, or stands alone (``oversize="alone"``)."""
    chars, most, segments = limits
    out = next_fit(groups, "ord", ["chars", "segments"], [chars, segments], most, keys, oversize)
    return out.withColumn("batch_id", ordinal("batch_", 4, F.col("batch_no")))


def diagram_batches(scans: DataFrame, keys: Sequence[str], limits: tuple[int, int, int] = DIAGRAM_LIMITS) -> DataFrame:
    """Scans (ord, items, chars) that have items; an oversize one stands alone."""
    most, items, chars = limits
    return next_fit(scans.where("items > 0"), "ord", ["items", "chars"], [items, chars], most, keys, oversize="alone")


def caption_batches(rows: DataFrame, keys: Sequence[str], limits: tuple[int, int] = CAPTION_LIMITS) -> DataFrame:
    """Captions (ord, chars) in batches; an oversize one stands alone."""
    most, chars = limits
    return next_fit(rows, "ord", ["chars"], [chars], most, keys, oversize="alone")


def remaining(batches: DataFrame, completed: DataFrame, key: str = "batch_id", limit: int | None = None, order: str = "batch_no") -> DataFrame:
    """Batches without a completed result; ``limit`` counts new work only."""
    left = batches.join(completed.select(key).distinct(), key, "left_anti")
    return left if limit is None else left.orderBy(order).limit(limit)


def recheck(answers: DataFrame, invalid: Callable[[DataFrame], DataFrame], ask: Callable[[DataFrame, int], DataFrame], key: str = "group_id", most: int = 2) -> DataFrame:
    """Ask again for the groups that ``invalid`` returns, and only these, up
    to ``most`` times; their new answers replace the old. What is invalid
    after that is an error."""
    now = answers
    for attempt in range(most + 1):
        failed = invalid(now).select(key).distinct()
        if failed.isEmpty():
            return now
        if attempt == most:
            raise ValueError(f"groups stay invalid after {most} rechecks: {[r[0] for r in failed.limit(5).collect()]}")
        new = ask(now.join(failed, key, "left_semi"), attempt + 1)
        now = now.join(failed, key, "left_anti").unionByName(new.join(failed, key, "left_semi"))
    return now


def partition_protected(groups: DataFrame, protected: DataFrame, rows: str = "rows", row: str = "row_no") -> DataFrame:
    """Groups with ``is_protected``; a partly protected group is an error."""
    each = groups.select("group_id", F.explode(rows).alias(row)).join(protected.select(row).distinct().withColumn("_p", F.lit(True)), row, "left")
    flags = each.groupBy("group_id").agg(F.bool_or(F.col("_p").isNotNull()).alias("any"), F.bool_and(F.col("_p").isNotNull()).alias("all"))
    known = groups.join(flags, "group_id", "left")
    mixed = F.raise_error(F.concat(F.lit("partly protected group: "), F.col("group_id"))).cast("boolean")
    return known.withColumn("is_protected", F.when(F.coalesce("any", F.lit(False)) & ~F.col("all"), mixed).otherwise(F.coalesce("all", F.lit(False)))).drop("any", "all")


def status_changes(log: DataFrame, allowed: Sequence[tuple[str, str]], keys: Sequence[str], order: str, status: str = "status") -> DataFrame:
    """Each change of status with ``valid``: whether it is an allowed one."""
    w = W.partitionBy(*keys).orderBy(order)
    moved = log.withColumn("previous", F.lag(status).over(w)).where(F.col("previous").isNotNull())
    pair = F.concat_ws(">", "previous", status)
    return moved.withColumn("valid", pair.isin(*[f"{a}>{b}" for a, b in allowed]))


# Status changes of a job.
TRANSITIONS = [
    ("exported", "translating"),
    ("translating", "translating"),
    ("translation_failed", "translating"),
    ("qa_failed", "translating"),
    ("ready_for_import", "translating"),
    ("translating", "translation_failed"),
    ("translating", "translated"),
    ("translated", "qa_failed"),
    ("ready_for_import", "qa_failed"),
    ("qa_failed", "qa_failed"),
    ("imported", "qa_failed"),
    ("translated", "ready_for_import"),
    ("ready_for_import", "ready_for_import"),
    ("qa_failed", "ready_for_import"),
    ("imported", "ready_for_import"),
    ("translated", "imported"),
    ("ready_for_import", "imported"),
    ("qa_failed", "imported"),
    ("imported", "imported"),
    ("complete", "exported"),
    ("imported", "exported"),
    ("translated", "exported"),
    ("ready_for_import", "exported"),
    ("qa_failed", "exported"),
    ("imported", "complete"),
    ("complete", "complete"),
    ("imported", "archived"),
]
