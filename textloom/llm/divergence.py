"""Divergence of sources from their language and from each other.

A first pass counts, for each term of a language, the documents that hold it,
in a count-min sketch: cells only ever take too much, so the smallest of a
term's cells never underestimates. Tasks send sketches, which are added cell
by cell. The second pass drops terms that the merged sketch proves to be too
rare before anything is shuffled; those that survive are counted exactly, and
exactly those with enough documents are kept. Sources are then compared over
the terms that both hold, by a join on the term; terms that one or both lack
enter through sums over equal counts.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ._shared import materialise, mix64, small_batches, word_hashes

#: Bytes of UTF-8 to those of terms: A-Z lower-cased, and all but letters of
#: ASCII and the bytes of characters above it as spaces.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Cells of the sketch in each of its rows, and cells that travel together.
CELLS, PART = 1 << 24, 1 << 16
#: Odd numbers that give each row of the sketch its own hash.
ROWS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
#: Terms that a task counts before it hands them on.
HELD = 400_000


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text, only A-Z lower-cased; null has none."""
    return text.encode("utf-8", "surrogatepass").translate(LETTERS).split() if text else []


def places(lang: str, terms: list[bytes], cells: int) -> np.ndarray:
    """Cell of each term of a language in each row of the sketch."""
    ends = np.cumsum(np.fromiter(map(len, terms), dtype=np.int64, count=len(terms)))
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    name = np.uint64(zlib.crc32(lang.encode("utf-8", "surrogatepass")) * ROWS[0] % 2**64)
    hashed = mix64(word_hashes(np.frombuffer(b"".join(terms), dtype=np.uint8), starts, ends) + name)
    return np.stack([(mix64(hashed * np.uint64(r)) & np.uint64(cells - 1)).astype(np.int64) for r in ROWS])


def _groups(batches, by_source: bool, held: int):
    """{(lang, source or None): (occurrences, documents)} of so many rows that
    about ``held`` terms are counted; occurrences only by source."""
    found: dict[tuple, tuple[Counter, Counter]] = {}
    size = 0
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("lang", "source", "text")]
        for lang, source, text in zip(*columns):
            terms = terms_of(text)
            if not terms:
                continue
            all_, docs = found.setdefault((lang, source if by_source else None), (Counter(), Counter()))
            size -= len(docs)
            docs.update(set(terms))
            size += len(docs)
            if by_source:
                all_.update(terms)
            if size >= held:
                yield found
                found, size = {}, 0
    if found:
        yield found


def _packed(cells: np.ndarray) -> bytes:
    """Four counters of 0 to 3 in each byte, compressed."""
    c = cells.reshape(-1, 4)
    return zlib.compress((c[:, 0] | c[:, 1] << 2 | c[:, 2] << 4 | c[:, 3] << 6).tobytes(), 1)


def _unpacked(raw: bytes) -> np.ndarray:
    b = np.frombuffer(zlib.decompress(raw), dtype=np.uint8)
    return np.stack([b & 3, b >> 2 & 3, b >> 4 & 3, b >> 6], axis=1).reshape(-1)


def _parts(sketch: np.ndarray):
    """The parts of a sketch that are not empty, as record batches."""
    flat = sketch.reshape(-1, PART)
    for i in np.flatnonzero(flat.any(axis=1)):
        yield pa.RecordBatch.from_arrays([pa.array([int(i)], pa.int32()), pa.array([_packed(flat[i])], pa.binary())], ["part", "cells"])


def _sketch(cells: int, least: int):
    def run(batches):
        sketch = np.zeros((len(ROWS), cells), dtype=np.uint8)
        for found in _groups(batches, False, HELD):
            for (lang, _), (_, docs) in found.items():
                n = np.minimum(np.fromiter(docs.values(), dtype=np.int64, count=len(docs)), least)
                for row, at in zip(sketch, places(lang, list(docs), cells)):
                    where, inverse = np.unique(at, return_inverse=True)
                    more = np.bincount(inverse, weights=n).astype(np.int64)
                    row[where] = np.minimum(row[where] + more, least)
        yield from _parts(sketch)

    return run


def _merge(least: int):
    """Add the sketches of a partition; it holds all rows of its parts."""

    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, raw in zip(batch.column("part").to_pylist(), batch.column("cells").to_pylist()):
                new = _unpacked(raw)
                sums[part] = np.minimum(sums[part] + new, least) if part in sums else new
        for part, cells in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([_packed(cells)], pa.binary())], ["part", "cells"])

    return run


def document_sketch(documents: DataFrame, least: int = 3, cells: int = CELLS) -> np.ndarray:
    """Counters (rows, cells) of the documents of each (lang, term), up to
    ``least`` (at most 3): a term's smallest counter is never below its number
    of documents, or is ``least``. Two bits a counter: 8 MiB by default,
    whatever the documents; a fuller sketch lets more rare terms pass."""
    kind = "part int, cells binary"
    parts = documents.mapInArrow(_sketch(cells, least), kind).repartition("part").mapInArrow(_merge(least), kind)
    flat = np.zeros((len(ROWS) * cells // PART, PART), dtype=np.uint8)
    for row in parts.toLocalIterator():
        flat[row[0]] = _unpacked(bytes(row[1]))
    return flat.reshape(len(ROWS), cells)


def _count(shared, least: int):
    def run(batches):
        sketch = shared.value
        for found in _groups(batches, True, HELD):
            for (lang, source), (all_, docs) in found.items():
                terms = list(docs)
                at = places(lang, terms, sketch.shape[1])
                may = np.flatnonzero(np.minimum.reduce([row[p] for row, p in zip(sketch, at)]) >= least)
                kept = [terms[i] for i in may]
                for i in range(0, len(kept), 1 << 16):
                    some = kept[i : i + (1 << 16)]
                    n = len(some)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * n, pa.string()), pa.array([source] * n, pa.string()), pa.array(some, pa.binary()).cast(pa.string()), pa.array([all_[t] for t in some], pa.int64()), pa.array([docs[t] for t in some], pa.int64())],
                        ["lang", "source", "term", "n", "docs"],
                    )

    return run


def kept_counts(documents: DataFrame, least: int = 3, cells: int = CELLS) -> DataFrame:
    """(lang, term, n, sources: array of (source, n)) of every term that at
    least ``least`` documents of its language hold, exactly counted."""
    shared = documents.sparkSession.sparkContext.broadcast(document_sketch(documents, least, cells))
    survivors = documents.mapInArrow(_count(shared, least), "lang string, source string, term string, n long, docs long")
    # Tasks have added up their rows already: dealt out first, they are not
    # grouped once more before the exchange.
    dealt = survivors.repartition("lang", "term", "source")
    exact = dealt.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    terms = exact.groupBy("lang", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("sources"))
    return materialise(terms.where(F.col("docs") >= least).drop("docs"), "terms")


def share(n: str, total: str) -> Column:
    """1 + floor(10^9 (n + 1) / total); decimals, since 10^9 n may pass 64 bits."""
    return F.expr(f"1 + (cast(1000000000 as decimal(10,0)) * cast({n} + 1 as decimal(19,0))) div cast({total} as decimal(20,0))")


def apart(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div {q}")


def divergence(documents: DataFrame, least: int = 3, ranks: int = 200, cells: int = CELLS) -> DataFrame:
    """(lang, source, part, item, value, rank) of every (lang, source).

    Terms are runs of ASCII letters and all characters above ASCII, A-Z
    lower-cased; a language keeps the V terms that at least ``least`` of its
    documents hold. A group with count of its N occurrences of kept terms gives
    a term p = 1 + floor(10^9 (count + 1) / (N + V)), the language q likewise,
    and f(p, q) = floor((p - q)^2 / q). Part ``pair``: item is each other
    source of the language with its p as q, value the sum of f over all kept
    terms. Part ``term``: items are the kept terms that the group holds with
    p > q, value is f, up to ``ranks`` of them. Ranks count from 1 by falling
    value, then item in UTF-8 order.

    Null texts, languages and sources are read as ''. A group without terms is
    compared like any other; without kept terms (V = 0) values are 0. Very long
    texts count whole, repeated rows are documents of their own. Other columns
    are ignored, whatever their names. An empty table gives no rows.
    """
    small_batches(documents.sparkSession)
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    rows = documents.select(blank("lang"), blank("source"), blank("text"))
    terms = kept_counts(rows, least, cells)

    # Written, so that joins know how small it is before terms are exchanged.
    languages = materialise(terms.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("n").alias("total")), "languages")
    each = terms.select("lang", "term", F.explode("sources").alias("x")).select("lang", "term", "x.source", "x.n")
    sizes = each.groupBy("lang", "source").agg(F.sum("n").alias("own"), F.count("*").alias("held"))
    every = rows.groupBy("lang", "source").agg(F.lit(1).alias("one")).drop("one")
    groups = every.join(sizes, ["lang", "source"], "left").join(languages.select("lang", "kept"), "lang", "left").na.fill(0, ["own", "held", "kept"])
    # Without kept terms there is nothing to share; 1 keeps the division defined.
    groups = groups.withColumn("all", F.greatest(F.col("own") + F.col("kept"), F.lit(1).cast("long"))).withColumn("nought", F.lit(0).cast("long"))
    groups = materialise(groups.select("lang", "source", "kept", "held", "all", share("nought", "all").alias("p0")), "groups")

    shares = each.join(groups, ["lang", "source"]).select("lang", "term", "source", share("n", "all").alias("p"), "p0")
    # Over the terms that both hold: what differs from the sums below.
    a, b = (shares.select("lang", "term", F.col("source").alias(f"s{i}"), F.col("p").alias(f"p{i}"), F.col("p0").alias(f"z{i}")) for i in "ab")
    met = a.join(b, ["lang", "term"]).where("sa < sb")
    differs = lambda x, y: F.sum(apart(f"p{x}", f"p{y}") - apart(f"p{x}", f"z{y}") - apart(f"z{x}", f"p{y}") + apart(f"z{x}", f"z{y}"))
    met = materialise(met.groupBy("lang", "sa", "sb").agg(differs("a", "b").alias("ab"), differs("b", "a").alias("ba")), "met")
    both = met.select("lang", F.col("sa").alias("source"), F.col("sb").alias("item"), F.col("ab").alias("v")).unionByName(met.select("lang", F.col("sb").alias("source"), F.col("sa").alias("item"), F.col("ba").alias("v")))
    # Each group's terms against a group that lacks them, by equal shares.
    like = shares.groupBy("lang", "source", "p").agg(F.count("*").alias("k"))
    other = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("z"))
    alone = like.join(other, "lang").where("source <> item").groupBy("lang", "source", "item").agg(F.sum(F.col("k") * apart("p", "z")).alias("own"), F.sum(F.col("k") * apart("z", "p")).alias("as_item"))
    alone = materialise(alone, "alone")
    parts = both.unionByName(alone.select("lang", "source", "item", F.col("own").alias("v"))).unionByName(alone.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), F.col("as_item").alias("v")))
    sums = parts.groupBy("lang", "source", "item").agg(F.sum("v").alias("v"))
    h = groups.select("lang", F.col("source").alias("item"), F.col("held").alias("held_h"), F.col("p0").alias("q0"))
    pairs = groups.join(h, "lang").where("source <> item").join(sums, ["lang", "source", "item"], "left")
    empty = (F.col("kept") - F.col("held") - F.col("held_h")) * apart("p0", "q0")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", F.when(F.col("kept") == 0, F.lit(0).cast("long")).otherwise(F.coalesce("v", F.lit(0).cast("long")) + empty).alias("value"))

    q = terms.select("lang", "term", "n", F.explode("sources").alias("x")).join(languages.select("lang", (F.col("total") + F.col("kept")).alias("total")), "lang").select("lang", "term", "x.source", F.col("x.n").alias("own"), share("n", "total").alias("q"))
    above = q.join(groups.select("lang", "source", "all"), ["lang", "source"]).select("lang", "source", "term", share("own", "all").alias("p"), "q").where("p > q")
    above = above.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), apart("p", "q").alias("value"))
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda df: df.withColumn("rank", F.row_number().over(order))
    return ranked(pairs).unionByName(ranked(above).where(F.col("rank") <= ranks))
