"""Mixing sources to target weights by Poisson replication, natively.

Each document of source s is repeated k times, where k inverts the Poisson
distribution of mean rate_s at a uniform number seeded by a hash of the
document. rate_s is chosen so that the expected number of rows of s is its
share of the target. Then all copies are put in a global random order.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ._native import let
from ._shared import free_names, materialise, own, own_columns

#: Copies that one row of the first explosion stands for.
COPIES = 1 << 16


def digest(seed: str, *cols: Column) -> Column:
    """SHA-256, in hex, of the seed and the texts of the columns."""
    return F.sha2(F.concat_ws(":", F.lit(seed), *(F.coalesce(c.cast("string"), F.lit("null")) for c in cols)), 256)


def uniform(hashed: Column) -> Column:
    """A number of [0, 1) from the first 52 bits of a hash in hex."""
    return F.conv(F.substring(hashed, 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def _log_factorial(k: Column) -> Column:
    """ln k! by Stirling's series: exact to doubles from 170 on, 0 at 0."""
    x = k.cast("double")
    series = x * F.ln(x) - x + F.ln(x * F.lit(2 * math.pi)) / 2 + 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * x * x * x * x * x)
    return F.when(k > 0, series).otherwise(F.lit(0.0))


def rates(documents: DataFrame, weights: DataFrame | None, alpha: float, total: float | None, source: str) -> DataFrame:
    """(source, n, rate, first, cdf): the rate of each source and its Poisson
    distribution function at first, first + 1, ... .

    The list spans rate - 12 sqrt(rate) - 30 to rate + 12 sqrt(rate) + 30;
    outside, the function is 0 or 1 in doubles.
    """
    sizes = documents.groupBy(own(source).alias("source")).agg(F.count("*").alias("n"))
    if weights is None:
        sizes = sizes.withColumn("w", F.pow(F.col("n").cast("double"), F.lit(alpha)))
    else:
        given = weights.select(F.col("source").alias("s"), F.col("weight").cast("double").alias("w"))
        sizes = sizes.join(given, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
        sizes = sizes.withColumn("w", F.greatest(F.coalesce("w", F.lit(0.0)), F.lit(0.0)))
    sizes = materialise(sizes, "sizes")
    sum_w, sum_n = sizes.agg(F.sum("w"), F.sum("n")).first()
    goal = float(sum_n or 0) if total is None else float(total)
    out = sizes.select("source", "n", (F.col("w") * F.lit(goal / sum_w if sum_w else 0.0) / F.col("n")).alias("rate"))
    spread = 12 * F.sqrt("rate") + 30
    out = out.withColumn("first", F.greatest(F.floor(F.col("rate") - spread), F.lit(0)).cast("long"))
    steps = out.select("*", F.explode(F.sequence("first", F.ceil(F.col("rate") + spread).cast("long"))).alias("k"))
    upto = W.partitionBy("source").orderBy("k").rowsBetween(W.unboundedPreceding, 0)
    grown = F.sum(F.when((F.col("k") > 1) & (F.col("k") > F.col("first")), F.ln(F.col("k").cast("double"))).otherwise(0.0)).over(upto)
    steps = steps.withColumn("log_fact", _log_factorial(F.col("first")) + grown)
    mass = F.when(F.col("rate") > 0, F.exp(F.col("k") * F.ln("rate") - F.col("rate") - F.col("log_fact"))).otherwise((F.col("k") == 0).cast("double"))
    steps = steps.withColumn("cdf", F.sum(mass).over(upto))
    table = steps.groupBy("source").agg(F.first("n").alias("n"), F.first("rate").alias("rate"), F.first("first").alias("first"), F.sort_array(F.collect_list("cdf")).alias("cdf"))
    return materialise(table, "rates")


def _at_most(cdf: Column, u: Column) -> Column:
    """How many entries of the ascending list are <= u, by bisection."""
    bits = F.transform(F.sequence(F.length(F.bin(F.size(cdf))) - 1, F.lit(0)), lambda i: F.pow(F.lit(2.0), i).cast("int"))
    return F.aggregate(bits, F.lit(0), lambda at, step: F.when(F.coalesce(F.get(cdf, at + step - 1) <= u, F.lit(False)), at + step).otherwise(at))


def _numbered(documents: DataFrame, occurrence: str) -> DataFrame:
    """``documents`` with a number from 1 in ``occurrence`` that tells rows
    apart that are equal in all columns.

    Only rows whose doc_id repeats are looked at further: equal ones are
    counted, combined before the shuffle, and dealt out again by their number,
    so a row with very many copies is neither one group nor one task.
    """
    n, key, again, block = free_names(documents, "n", "key", "again", "block")
    ids = documents.groupBy(F.col("doc_id").alias(key)).agg(F.count("*").alias(n)).where(own(n) > 1)
    ids = materialise(ids.select(key, F.lit(True).alias(again)), "repeated")
    if ids.isEmpty():
        return documents.withColumn(occurrence, F.lit(1).cast("long"))
    marked = documents.join(ids, F.col("doc_id").eqNullSafe(own(key)), "left").drop(key)
    single = marked.where(own(again).isNull()).drop(again).withColumn(occurrence, F.lit(1).cast("long"))
    counted = marked.where(own(again)).groupBy(*own_columns(documents)).agg(F.count("*").alias(n))
    dealt = counted.withColumn(block, F.explode(_blocks(own(n)))).repartition(own(block), *own_columns(documents))
    return single.unionByName(dealt.withColumn(occurrence, F.explode(_within(own(block), own(n)))).drop(n, block))


def _blocks(n: Column) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / F.lit(COPIES)).cast("long"))


def _within(block: Column, n: Column) -> Column:
    """The numbers from 1 to n that belong to a block."""
    return F.sequence(block * COPIES + 1, F.least(n, (block + 1) * COPIES))


def mix(
    documents: DataFrame,
    weights: DataFrame | None = None,
    alpha: float = 0.5,
    total: float | None = None,
    seed: str = "mix-1",
    source: str = "source",
) -> DataFrame:
    """Replicate and shuffle ``documents`` to the target weights.

    ``weights`` has (source, weight); a source without a weight, or with one
    of zero or less, gets rate 0 and vanishes. Without ``weights`` the target
    share of a source is its row count to the power ``alpha``. ``total`` is
    the expected number of rows out, by default the number in.

    Adds ``n_copies`` (k of the document) and ``copy`` (1 to k); input columns
    with these names are replaced, all others keep their values, whatever
    their names. The draw hashes all columns of a row and, for rows that are
    equal in all of them, a running number: repeated rows, null ids and null
    texts draw independently of each other. A null doc_id or source is a value
    of its own. Very long texts are hashed whole and are moved once per copy.
    No two rows tie in the order but by a hash collision. An empty table gives
    an empty one.

    The rates are one row per source; the join is left to the optimiser,
    which broadcasts the table only if its written size is under the
    session's threshold and otherwise splits a hot source's partition.
    """
    docs = documents.drop("n_copies", "copy")
    hashed, key, first, cdf, occurrence, block, order = free_names(docs, "hashed", "source_key", "first", "cdf", "occurrence", "block", "order")
    table = rates(docs, weights, alpha, total, source).select(F.col("source").alias(key), F.col("first").alias(first), F.col("cdf").alias(cdf))
    drawn = _numbered(docs, occurrence)
    drawn = drawn.withColumn(hashed, digest(seed, *own_columns(docs), own(occurrence)))
    drawn = drawn.join(table, own(source).eqNullSafe(own(key)))
    drawn = drawn.withColumn("n_copies", let(uniform(own(hashed)), lambda x: own(first) + _at_most(own(cdf), x)).cast("long")).drop(key, first, cdf, occurrence)
    copies = drawn.where("n_copies > 0").withColumn(block, F.explode(_blocks(F.col("n_copies"))))
    copies = copies.withColumn("copy", F.explode(_within(own(block), F.col("n_copies"))))
    # Partition and place are both set by the key: a global random order.
    copies = copies.withColumn(order, F.xxhash64(own(hashed), F.col("copy"), F.lit("order")))
    return copies.repartition(own(order)).sortWithinPartitions(own(order)).select(*own_columns(docs), "n_copies", "copy")
