"""Exact duplicates through an extendible-hash index on shared files.

Normalised texts are logged to the shared folder with a 64-bit key. A
directory over the first bits of the keys is doubled while a bucket holds more
rows than its capacity and has more than one cell; only such buckets split. A
bucket that cannot split, because few keys hold its rows, gets a chain of
overflow pages instead. Owner tasks take ranges of (bucket, page), compare the
texts there byte by byte, and write one slot for each different text; texts
with one key stand behind each other in its chain.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ._shared import materialise

#: Rows of a bucket at least, and buckets at most: beyond these, buckets grow.
LEAST_CAPACITY, MOST_BUCKETS = 1024, 1 << 15
#: Cells that a bucket of average load can still be split into, as bits.
SPARE_BITS = 2


def normalised(text: Column) -> Column:
    """Each run of space, tab, line feed, vertical tab, form feed and carriage
    return as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def directory(cells: DataFrame, bits: int, capacity: int) -> DataFrame:
    """(cell, depth, bucket, pages) from (cell, n), cells being the first
    ``bits`` bits of a key.

    At depth d the directory has 2^d entries. A bucket splits at each doubling
    at which it is overfull, so it ends at the first depth where it is not, or
    at ``bits``; what it holds then is dealt to so many pages. ``bucket`` is
    its first cell. The loads of all depths are sums of the same few cells.
    """
    levels = cells.select("cell", "n", F.explode(F.sequence(F.lit(0), F.lit(bits))).alias("depth")).withColumn("prefix", F.expr(f"shiftright(cell, {bits} - depth)"))
    loads = levels.groupBy("depth", "prefix").agg(F.sum("n").alias("load"))
    rests = (F.col("load") <= capacity) | (F.col("depth") == bits)
    leaf = levels.join(loads, ["depth", "prefix"]).groupBy("cell").agg(F.min(F.when(rests, F.struct("depth", "load"))).alias("x"))
    leaf = leaf.select("cell", F.col("x.depth").alias("depth"), F.ceil(F.col("x.load") / F.lit(capacity)).cast("int").alias("pages"))
    return leaf.withColumn("bucket", F.expr(f"shiftleft(shiftright(cell, {bits} - depth), {bits} - depth)"))


def build(entries: DataFrame, capacity: int | None = None) -> DataFrame:
    """Slots of ``entries`` (rid, doc_id, key, text_sha256, text): (bucket,
    key, chain, text_sha256, keep, group_size), one for each different text, a
    table in the shared folder.

    ``keep`` is the row that stays: (unknown, doc_id, rid), null ids last.
    ``chain`` counts the texts of one key from 1. A bucket holds ``capacity``
    rows; by default 1024, or more where that would make over 32,768 buckets,
    so that the directory is small at any number of rows.
    """
    total = entries.count()
    capacity = capacity or max(LEAST_CAPACITY, math.ceil(total / MOST_BUCKETS))
    bits = math.ceil(math.log2(max(2, total / capacity))) + SPARE_BITS
    cell = F.shiftrightunsigned("key", 64 - bits)
    table = materialise(directory(entries.groupBy(cell.alias("cell")).agg(F.count("*").alias("n")), bits, capacity), "directory")

    # The directory has at most 2^bits rows of 24 bytes: 6 MiB by default.
    placed = entries.withColumn("cell", cell).join(F.broadcast(table) if bits <= 18 else table, "cell")
    placed = placed.withColumn("page", F.pmod(F.xxhash64("rid"), "pages"))
    head = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "rid")
    # Owner tasks: ranges of buckets, that is of keys, and of their pages. The
    # grouping needs no further exchange.
    owned = placed.repartitionByRange("bucket", "page").groupBy("bucket", "page", "pages", "key", "text_sha256", "text")
    slots = owned.agg(F.min(head).alias("keep"), F.count("*").alias("group_size"))
    # What is left of a chain of pages meets once more, by its bytes too.
    slots = slots.groupBy("bucket", "key", "text_sha256", F.when(F.col("pages") > 1, F.col("text")).alias("text")).agg(F.min("keep").alias("keep"), F.sum("group_size").alias("group_size"))
    order = W.partitionBy("bucket", "key").orderBy("text_sha256")
    same = F.lag("text_sha256").over(order) == F.col("text_sha256")
    chain = F.when(same, F.raise_error(F.lit("two texts have one SHA-256"))).otherwise(F.row_number().over(order))
    return materialise(slots.select("bucket", "key", chain.alias("chain"), "text_sha256", "keep", "group_size"), "index")


def exact_duplicates(documents: DataFrame, key=F.xxhash64, capacity: int | None = None) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256, chain) of every row.

    Texts are equal when their normalised forms have the same bytes. Of equal
    texts the row of the smallest doc_id stays; null ids come last, and of rows
    with that id the first of the table stays. ``text_sha256`` is that of the
    normalised text in UTF-8. ``key`` makes the 64-bit key of a text; equal
    keys of different texts are told apart in their chain.

    A null text counts as an empty one, a text of blanks as one space. Very
    long texts are compared whole. Repeated rows are copies of each other.
    Other columns are ignored, whatever their names. An empty table gives no
    rows.
    """
    rows = documents.select("doc_id", normalised(F.col("text")).alias("text"), F.monotonically_increasing_id().alias("rid"))
    log = materialise(rows.select("rid", "doc_id", key("text").alias("key"), F.sha2("text", 256).alias("text_sha256"), "text"), "log")
    index = build(log, capacity).select("key", "text_sha256", "chain", "keep", "group_size")
    # Both sides are exchanged, so a key of very many copies can be split.
    found = log.select("rid", "doc_id", "key", "text_sha256").join(index.hint("merge"), ["key", "text_sha256"])
    return found.select("doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size", (F.col("rid") == F.col("keep.rid")).alias("kept"), "text_sha256", "chain")
