"""Ranked lexical search: a threshold-seeded join of items with documents.

Documents become postings of the terms that items ask for. Of each term the
k-th impact is stored, as the lower edge of the histogram cell that holds it:
k documents reach it, so the largest of an item's terms is a floor of the
item's k-th score before any document is scored. Terms are ordered by their
largest impact; those whose bounds together stay below the floor cannot bring
a document into the result, and do not generate candidates. A candidate whose
partial score, with the bound of the terms left out, reaches the floor is
scored exactly.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from ._shared import materialise, small_batches

#: A term in lower-cased UTF-8: letters and digits of ASCII, all above it.
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
#: Bytes of item texts that are searched in one pass over the documents.
BLOCK_BYTES = 1 << 20
#: Width of a histogram cell of saturations, which are below 1,000,000.
CELL = 1024
#: Elements of an intermediate array of a task.
MOST = 1 << 21


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text, only A-Z lower-cased; null has none."""
    return TERM.findall(text.encode("utf-8", "surrogatepass").lower()) if text else []


def _blocks(items: DataFrame):
    """Lists of (item_id, text) of at most BLOCK_BYTES; a longer one alone."""
    held, size = [], 0
    for row in items.select("item_id", F.col("text").cast("string")).toLocalIterator():
        long = len(row[1].encode("utf-8", "surrogatepass")) if row[1] else 0
        if held and size + long > BLOCK_BYTES:
            yield held
            held, size = [], 0
        held.append((row[0], row[1]))
        size += long
    if held:
        yield held


def _count_terms(vocabulary):
    def run(batches):
        numbers = vocabulary.value
        for batch in batches:
            docs, lengths, ids, tfs, ends = [], [], [], [], [0]
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                terms = terms_of(text)
                if not terms:
                    continue
                found = Counter(filter(numbers.__contains__, terms))
                docs.append(doc)
                lengths.append(len(terms))
                ids.extend(map(numbers.__getitem__, found))
                tfs.extend(found.values())
                ends.append(len(ids))
            ends = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs, pa.int64()), pa.array(lengths, pa.int64()), pa.ListArray.from_arrays(ends, pa.array(ids, pa.int32())), pa.ListArray.from_arrays(ends, pa.array(tfs, pa.int64()))],
                ["doc_id", "n", "terms", "tfs"],
            )

    return run


def postings(documents: DataFrame, numbers: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tfs) of every document with a term: the number of
    its terms, and those of the vocabulary with their occurrences."""
    vocabulary = documents.sparkSession.sparkContext.broadcast(numbers)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return materialise(rows.mapInArrow(_count_terms(vocabulary), "doc_id long, n long, terms array<int>, tfs array<long>"), "postings")


def stored_impacts(rows: DataFrame, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(term, df, high, kth): documents, the largest saturation and a floor of
    the k-th largest (0 with fewer than k documents).

    Each term's saturations are counted in cells of fixed width, so what a
    task sends on does not grow with the documents."""
    m = F.expr(f"75 + (25 * n * {n_docs}L) div {n_terms}L")
    each = rows.select(m.alias("m"), F.explode(F.arrays_zip("terms", "tfs")).alias("x"))
    each = each.select(F.col("x.terms").alias("term"), F.expr("(1000000000 * x.tfs) div (1000 * x.tfs + 12 * m)").alias("s"))
    cells = each.groupBy("term", F.expr(f"s div {CELL}").alias("cell")).agg(F.count("*").alias("c"), F.min("s").alias("low"), F.max("s").alias("high"))
    upto = F.sum("c").over(W.partitionBy("term").orderBy(F.desc("cell")))
    return cells.withColumn("upto", upto).groupBy("term").agg(F.sum("c").alias("df"), F.max("high").alias("high"), F.coalesce(F.max(F.when(F.col("upto") >= k, F.col("low"))), F.lit(0)).alias("kth"))


@dataclass
class Plan:
    """What a task needs: weights, a floor for each item, and the items of each
    term, apart for terms that generate candidates and terms left out."""

    n_docs: int
    n_terms: int
    weight: np.ndarray
    floor: np.ndarray
    rest: np.ndarray
    wanted: tuple[np.ndarray, np.ndarray, np.ndarray]
    left_out: tuple[np.ndarray, np.ndarray, np.ndarray]


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _by_term(entries: list[tuple[int, int, int]], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(term, item, repeats) as (offsets by term, items, repeats)."""
    t, i, q = np.array(sorted(entries), dtype=np.int64).reshape(-1, 3).T
    return np.searchsorted(t, np.arange(n + 1)), i, q


def plan_terms(asked: list[Counter], stats: list, n_docs: int, n_terms: int) -> Plan:
    """Floors of the items from stored impacts, and the terms that the bounds
    of the suffix in falling order allow to leave out."""
    n = 1 + max((t for c in asked for t in c), default=-1)
    w, high, kth = np.zeros((3, n), dtype=np.int64)
    for term, df, most, floor in stats:
        w[term], high[term], kth[term] = weight(n_docs, df), most, floor
    floor, rest = np.zeros((2, len(asked)), dtype=np.int64)
    wanted, left_out = [], []
    for i, terms in enumerate(asked):
        floor[i] = max((q * w[t] * kth[t] for t, q in terms.items()), default=0)
        for bound, t, q in sorted((int(q * w[t] * high[t]), t, q) for t, q in terms.items()):
            # No document of the left out terms alone reaches the floor.
            if rest[i] + bound < floor[i]:
                rest[i] += bound
                left_out.append((t, i, q))
            else:
                wanted.append((t, i, q))
    return Plan(n_docs, n_terms, w, floor, rest, _by_term(wanted, n), _by_term(left_out, n))


def _add(sums: np.ndarray, index, doc: np.ndarray, term: np.ndarray, impact: np.ndarray) -> None:
    """Add each posting's impact to all items of ``index`` that ask for it."""
    offsets, items, repeats = index
    many = offsets[term + 1] - offsets[term]
    doc, term, impact, many = (x[many > 0] for x in (doc, term, impact, many))
    ends = np.cumsum(many)
    first = 0
    while first < len(doc):
        base = ends[first] - many[first]
        last = max(first + 1, int(np.searchsorted(ends, base + MOST, side="right")))
        part = slice(first, last)
        at = np.repeat(offsets[term[part]] - (ends[part] - many[part] - base), many[part]) + np.arange(ends[last - 1] - base)
        np.add.at(sums, (np.repeat(doc[part], many[part]), items[at]), np.repeat(impact[part], many[part]) * repeats[at])
        first = last


def _best(found: list[np.ndarray], k: int, items: int) -> tuple[np.ndarray, np.ndarray]:
    """The k first rows (item, -score, null id, id) of each item, and the k-th
    score of items that have so many."""
    rows = np.concatenate(found, axis=1)
    rows = rows[:, np.lexsort(rows[::-1])]
    starts = np.searchsorted(rows[0], np.arange(items))
    place = np.arange(rows.shape[1]) - starts[rows[0]]
    kth = np.zeros(items, dtype=np.int64)
    full = place == k - 1
    kth[rows[0, full]] = -rows[1, full]
    return rows[:, place < k], kth


def _search(shared, k: int):
    def run(batches):
        p: Plan = shared.value
        items = len(p.floor)
        floor = p.floor.copy()
        best = np.zeros((4, 0), dtype=np.int64)
        step = max(1, 2 * MOST // max(items, 1))
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                ids, n = part.column("doc_id"), part.column("n").to_numpy()
                m = 75 + (25 * n * p.n_docs) // p.n_terms
                doc = np.repeat(np.arange(part.num_rows), part.column("terms").value_lengths().to_numpy())
                term, tf = part.column("terms").flatten().to_numpy(), part.column("tfs").flatten().to_numpy()
                impact = p.weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[doc]))
                sums = np.zeros((part.num_rows, items), dtype=np.int64)
                _add(sums, p.wanted, doc, term, impact)
                maybe = (sums > 0) & (sums + p.rest >= floor)
                again = maybe.any(axis=1)[doc]
                _add(sums, p.left_out, doc[again], term[again], impact[again])
                row, item = np.nonzero(maybe & (sums >= floor))
                unknown = np.asarray(ids.is_null())
                number = np.asarray(ids.fill_null(0))
                best, kth = _best([best, np.stack([item, -sums[row, item], unknown[row].astype(np.int64), number[row]])], k, items)
                # k documents of this task reach the k-th of them.
                floor = np.maximum(floor, kth)
        yield pa.RecordBatch.from_arrays([pa.array(best[0]), pa.array(-best[1]), pa.array(best[3], mask=best[2] == 1)], ["item", "score", "doc_id"])

    return run


def _of_block(documents: DataFrame, block: list, item_type: T.DataType, k: int) -> DataFrame:
    spark = documents.sparkSession
    counted = [Counter(terms_of(text)) for _, text in block]
    numbers = {t: i for i, t in enumerate(dict.fromkeys(t for c in counted for t in c))}
    asked = [Counter({numbers[t]: q for t, q in c.items()}) for c in counted]
    rows = postings(documents, numbers)
    n_docs, n_terms = rows.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    stats = stored_impacts(rows, n_docs, max(n_terms, 1), k).collect()  # one row for each term of the block
    shared = spark.sparkContext.broadcast(plan_terms(asked, stats, n_docs, max(n_terms, 1)))
    found = rows.mapInArrow(_search(shared, k), "item long, score long, doc_id long")
    order = W.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    top = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(block)], T.StructType([T.StructField("item", T.LongType()), T.StructField("item_id", item_type)]))
    return top.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def search(documents: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """(item_id, rank int, doc_id, score): the ``k`` documents of the highest
    scores above 0 for each row of ``items`` (item_id, text).

    Terms are runs of ASCII letters and digits and of all characters above
    ASCII, A-Z lower-cased. With N documents that have a term, L terms in all
    of them, n in one, df documents of a term and tf occurrences, a term
    weighs w = floor(1000 ln((2N + 2) / (2 df + 1))) and adds
    w ((10^9 tf) div (1000 tf + 12 m)) for each time that the item holds it,
    m = 75 + (25 n N) div L. Equal scores rank by doc_id, null ids last.

    Null and empty texts have no terms: such documents are not counted, such
    items have no rows. Very long texts count whole. Repeated rows are
    documents, and items, of their own. Other columns are ignored, whatever
    their names. Empty tables give no rows. Items are searched in blocks of
    ``BLOCK_BYTES`` of text, each in one pass over all documents, so the
    vocabulary that is sent to all tasks is bounded.
    """
    spark = documents.sparkSession
    small_batches(spark)
    kind = items.schema["item_id"].dataType
    parts = [_of_block(documents, block, kind, k) for block in _blocks(items)]
    if not parts:
        return spark.createDataFrame([], T.StructType([T.StructField("item_id", kind), T.StructField("rank", T.IntegerType()), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())]))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
