"""Near-duplicate documents: MinHash bands, verification, components.

1. Every text becomes its set of distinct five-word shingles (64-bit hashes),
   ``bands * rows`` universal-hash minima of it and one hash per band. Texts
   with equal sets form a class, which is a node of its own from here on.
2. Classes that share a band bucket are candidates. Per bucket each member is
   paired with the smallest and the largest member only, so a bucket of n
   gives under 2n pairs. Pairs are verified by signature, then confirmed on the
   full sets, and the confirmed links are closed by alternating stars.
3. Buckets of four or more whose members are still in different components
   are compared completely, in blocks of fixed size: the largest component of
   a bucket against all others, and these among themselves. Signatures come
   first and name the rows that have a likely partner in another component;
   these rows are compared again with their texts, where a union-find inside
   the task keeps only links that join something. Nothing emits all pairs of
   a bucket, and no bucket is capped.
4. Links from 3 are closed over the components of 2.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bloom
from ._shared import ASCII_LOWER, PLACES, discard, free_names, materialise, mix64, own, own_columns, small_batches, text_batches, window_hashes, word_bounds, word_hashes
from .components import connected_components

WIDTH, BANDS, ROWS = 5, 54, 6
#: Rows of one side of a block comparison.
BLOCK = 512
#: Numbers below this name classes of which no id is free.
LOWEST = -(2**62)


@lru_cache(maxsize=4)
def _family(count: int) -> tuple[np.ndarray, np.ndarray]:
    """``count`` functions x -> a x + b mod 2^32 with odd a."""
    rng = np.random.Generator(np.random.PCG64(7))
    a = rng.integers(0, 2**31, count, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    return a[:, None], rng.integers(0, 2**32, count, dtype=np.uint32)[:, None]


def minima(shingles: np.ndarray, count: int) -> np.ndarray:
    """Least values of the functions over the upper halves of the hashes.

    Two shingles agree in these 32 bits with p = 2.3e-10 a pair: a set of a
    million shingles has about a hundred such pairs, which shifts the share
    of equal minima by 1e-4 at most. Links are confirmed on all 64 bits.
    """
    a, b = _family(count)
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(count, 2**32 - 1, dtype=np.uint32)
    for i in range(0, len(x), 512):
        np.minimum(least, (x[None, i : i + 512] * a + b).min(axis=1), out=least)
    return least


def shingle_sets(raws: list[bytes], width: int = WIDTH):
    """The sorted distinct shingle hashes of each text, in order.

    A-Z are lower-cased; words are runs of bytes other than space and \\t-\\r.
    A text of fewer words is one shingle, its whole sequence; one without
    words has the empty set.
    """
    data = np.frombuffer(b"\n".join(raws).translate(ASCII_LOWER), dtype=np.uint8)
    ends_at = np.cumsum([len(r) + 1 for r in raws])
    starts, ends = word_bounds(data)
    words = word_hashes(data, starts, ends)
    upto = np.searchsorted(starts, ends_at, "left")
    windows = window_hashes(words, width)
    first = 0
    for last in upto:
        n = int(last) - first
        if n >= width:
            yield np.unique(windows[first : last - width + 1])
        elif n:
            terms = np.append(words[first:last], np.uint64(n)) * np.append(PLACES[:n], PLACES[15])
            yield mix64(terms.sum(keepdims=True, dtype=np.uint64))
        else:
            yield np.zeros(0, dtype=np.uint64)
        first = int(last)


def _features(bands: int, rows: int, width: int):
    places = PLACES[:rows]
    names = np.arange(bands, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)

    def run(batches):
        for pdf in batches:
            for first, raws in text_batches(pdf["text"].array):
                n, digest, keys, sigs = [], [], [], []
                for s in shingle_sets(raws, width):
                    n.append(len(s))
                    if len(s):
                        sig = minima(s, bands * rows)
                        band = (sig.reshape(bands, rows).astype(np.uint64) * places[None, :]).sum(axis=1, dtype=np.uint64)
                        digest.append(_set_digest(s))
                        keys.append(mix64(band + names).view(np.int64))
                        sigs.append(sig.astype(np.uint8).tobytes())
                    else:
                        digest.append(None)
                        keys.append(None)
                        sigs.append(None)
                yield pd.DataFrame({"doc_id": pdf["doc_id"].iloc[first : first + len(raws)].to_numpy(), "n_shingles": n, "digest": digest, "bands": keys, "sig": sigs})

    return run


def _signatures_agree(least: float):
    def run(batches):
        for pdf in batches:
            if len(pdf):
                a = np.frombuffer(b"".join(pdf["sig_a"]), dtype=np.uint8).reshape(len(pdf), -1)
                b = np.frombuffer(b"".join(pdf["sig_b"]), dtype=np.uint8).reshape(len(pdf), -1)
                yield pdf.loc[(a == b).mean(axis=1) >= least, ["u", "v"]]

    return run


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if not len(a) or not len(b) or 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _confirmed(percent: int, width: int):
    """Keep the pairs (u, v) whose full sets are similar enough."""

    def run(batches):
        last: tuple = (None, None)
        for pdf in batches:
            keep = []
            for v, ta, tb in zip(pdf["v"], pdf["text_a"], pdf["text_b"]):
                if last[0] != v:
                    last = (v, next(shingle_sets([tb.encode("utf-8", "surrogatepass")], width)))
                a = next(shingle_sets([ta.encode("utf-8", "surrogatepass")], width))
                keep.append(_similar(a, last[1], percent))
            yield pdf.loc[np.array(keep, dtype=bool), ["u", "v"]]

    return run


def _grouped(work):
    """mapInPandas body that hands each run of equal (bucket, lo, hi) to
    ``work``; its input is partitioned and sorted by these columns."""
    keys = ["bucket", "lo", "hi"]

    def run(batches):
        held = None
        for pdf in batches:
            pdf = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            k = pdf[keys].to_numpy()
            cuts = np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1
            edges = [0, *cuts.tolist()]
            for a, b in zip(edges, edges[1:]):
                yield from work(pdf.iloc[a:b])
            held = pdf.iloc[edges[-1] :]
        if held is not None and len(held):
            yield from work(held)

    return run


def _likely(group: pd.DataFrame, least: float, percent: int):
    """Row pairs of a block comparison that are in different components and
    whose signatures and sizes allow a link, 64 left rows at a time."""
    lo, hi = group["lo"].iat[0], group["hi"].iat[0]
    blk = group["blk"].to_numpy()
    left, right = np.flatnonzero(blk == lo), np.flatnonzero(blk == hi)
    sig = np.frombuffer(b"".join(group["sig"]), dtype=np.uint8).reshape(len(group), -1)
    comp, size = group["comp"].to_numpy(), group["n"].to_numpy()
    for i in range(0, len(left), 64):
        rows = left[i : i + 64]
        ok = comp[rows][:, None] != comp[right][None, :]
        small, large = np.minimum(size[rows][:, None], size[right][None, :]), np.maximum(size[rows][:, None], size[right][None, :])
        ok &= 100 * small >= percent * large
        x, y = np.nonzero(ok)
        for j in range(0, len(x), 8192):
            a, b = rows[x[j : j + 8192]], right[y[j : j + 8192]]
            same = (sig[a] == sig[b]).mean(axis=1) >= least
            yield a[same], b[same]


def _flag(least: float, percent: int):
    def work(group):
        hit = np.zeros(len(group), dtype=bool)
        for a, b in _likely(group, least, percent):
            hit[a] = hit[b] = True
        if hit.any():
            yield group.loc[hit, ["bucket", "rep", "comp"]]

    return work


def _join_up(least: float, percent: int, width: int):
    def work(group):
        root = {c: c for c in group["comp"]}

        def find(c):
            while root[c] != c:
                root[c] = root[root[c]]
                c = root[c]
            return c

        comp, texts, sets, found = group["comp"].to_numpy(), group["text"].array, {}, []
        for a, b in _likely(group, least, percent):
            for i, j in zip(a.tolist(), b.tolist()):
                x, y = find(comp[i]), find(comp[j])
                if x == y:
                    continue
                for k in (i, j):
                    if k not in sets:
                        sets[k] = next(shingle_sets([texts[k].encode("utf-8", "surrogatepass")], width))
                if _similar(sets[i], sets[j], percent):
                    root[max(x, y)] = min(x, y)
                    found.append((max(comp[i], comp[j]), min(comp[i], comp[j])))
        if found:
            yield pd.DataFrame(found, columns=["u", "v"])

    return work


def _apart(column: str):
    """Join key from a bucket that no partitioning is known for, so that both
    sides of the join are exchanged and a hot bucket can be split."""
    return (-F.col(column).cast("decimal(20,0)")).alias("k")


def _mixed(members: DataFrame, comps: DataFrame) -> DataFrame:
    """(bucket, rep, comp) of the buckets of four or more members that are not
    all in one component; smaller buckets were compared completely."""
    known = members.where("size > 3").select("bucket", "rep")
    known = known.join(comps.toDF("rep", "comp"), "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))
    known = materialise(known, "known")
    ends = known.groupBy("bucket").agg(F.min("comp").alias("a"), F.max("comp").alias("b")).where("a <> b").select(_apart("bucket"))
    out = materialise(known.withColumn("k", _apart("bucket")).join(ends, "k", "left_semi").drop("k"), "mixed")
    discard(known)
    return out


def _with_top(rows: DataFrame) -> DataFrame:
    """``rows`` (bucket, rep, comp) with the largest component ``top`` of the
    bucket, its rows ``inner`` and all others ``outer``."""
    sizes = rows.groupBy("bucket", "comp").agg(F.count("*").alias("n"))
    shape = sizes.groupBy("bucket").agg(F.max(F.struct("n", "comp")).alias("top"), F.sum("n").alias("all"))
    shape = shape.select(_apart("bucket"), F.col("top.comp").alias("top"), F.col("top.n").alias("inner"), (F.col("all") - F.col("top.n")).alias("outer"))
    return rows.withColumn("k", _apart("bucket")).join(shape, "k").drop("k")


def _blocks(rows: DataFrame, block: int) -> DataFrame:
    """Deal the rows (bucket, rep, comp) of each bucket to pairs of blocks.

    The largest component of a bucket is dealt against all others only, the
    others also among themselves: rows of one component need no comparison.
    A task (bucket, lo, hi) gets about ``block`` rows of either block.
    """
    most = lambda c: F.ceil(F.col(c) / F.lit(block)).cast("int")
    dealt = _with_top(rows).withColumns({"inner": most("inner"), "outer": most("outer")})
    main = F.col("comp") == F.col("top")
    spread = F.xxhash64("rep", F.lit(3))
    blk = F.when(main, F.col("outer") + F.pmod(spread, F.col("inner"))).otherwise(F.pmod(spread, F.col("outer"))).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.when(main, F.col("outer")).otherwise(F.col("outer") + F.col("inner")) - 1)).alias("other")
    return dealt.select("bucket", "rep", blk.alias("blk"), other).select("bucket", "rep", "blk", F.least("blk", "other").alias("lo"), F.greatest("blk", "other").alias("hi"))


def _compare(dealt: DataFrame, payload: DataFrame, work, schema: str) -> DataFrame:
    parts = int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = dealt.join(payload, "rep").repartition(parts, "bucket", "lo", "hi").sortWithinPartitions("bucket", "lo", "hi")
    return rows.mapInPandas(_grouped(work), schema)


def _set_digest(s: np.ndarray) -> str | None:
    return hashlib.blake2b(s.tobytes(), digest_size=16).hexdigest() if len(s) else None


def _digester(width: int):
    """Column function: name of the set of shingles of a text, as _features."""

    @F.pandas_udf("string")
    def digest(texts: pd.Series) -> pd.Series:
        return pd.Series([_set_digest(s) for _, raws in text_batches(texts.array) for s in shingle_sets(raws, width)], dtype=object)

    return digest.asNondeterministic()


def _classes(linked: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(digest, node, least) of every different set, and the ids that have
    several sets (None if there are none).

    ``least`` is the smallest doc_id that has the set. The node is that too,
    unless an id with several sets is among its ids: then it is the smallest
    of the others or, without others, a number below LOWEST of its own.
    """
    several = linked.groupBy("doc_id").agg(F.min("digest").alias("a"), F.max("digest").alias("b")).where("a <> b")
    several = materialise(several.select(F.col("doc_id").alias("id")), "several")
    if several.isEmpty():
        discard(several)
        one = linked.groupBy("digest").agg(F.min("doc_id").alias("node"))
        return materialise(one.withColumn("least", F.col("node")), "classes"), None
    small = materialise(several.union(linked.where(F.col("doc_id") < LOWEST).select("doc_id")).distinct(), "several")
    discard(several)
    several = small
    marked = linked.select("doc_id", "digest").join(several.withColumn("shared", F.lit(True)), F.col("doc_id") == F.col("id"), "left")
    plain = F.when(F.col("shared").isNull(), F.col("doc_id"))
    found = marked.groupBy("digest").agg(F.min(plain).alias("node"), F.min("doc_id").alias("least"))
    # The number lasts because the table is written at once.
    return materialise(found.withColumn("node", F.coalesce("node", F.monotonically_increasing_id() + F.lit(1 - 2**63))), "classes"), several


def assign(
    documents: DataFrame,
    percent: int = 75,
    width: int = WIDTH,
    bands: int = BANDS,
    rows: int = ROWS,
    block: int = BLOCK,
) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n_shingles, digest) of every row, and (digest, component,
    component_id) of every set that has a doc_id: two scratch tables."""
    small_batches(documents.sparkSession)
    count = bands * rows
    # Five standard errors below the threshold: a true link fails with p < 1e-6.
    s = percent / 100
    least = s - 5 * (s * (1 - s) / count) ** 0.5
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    feats = materialise(
        docs.mapInPandas(_features(bands, rows, width), "doc_id long, n_shingles long, digest string, bands array<long>, sig binary"),
        "minhash",
    )
    linked = feats.where("digest is not null and doc_id is not null")
    classes, several = _classes(linked)
    if several is None:
        reps = linked.join(classes.select(F.col("node").alias("doc_id"), "node"), "doc_id")
    else:
        # Any row of a class has its signature; the first one seen stands.
        once = linked.groupBy("digest").agg(F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"), F.first("sig").alias("sig"))
        reps = once.join(classes.select("digest", "node"), "digest")
    reps = materialise(reps.select(F.col("node").alias("rep"), F.col("n_shingles").alias("n"), "bands", "sig").dropDuplicates(["rep"]), "reps")
    stored = _Texts(docs, classes, several, width)

    rows_of = reps.select("rep", F.explode("bands").alias("bucket"))
    ends = rows_of.groupBy("bucket").agg(F.min("rep").alias("low"), F.max("rep").alias("high"), F.count("*").alias("size"))
    ends = ends.where("size > 1").select(_apart("bucket"), "low", "high", "size")
    members = materialise(rows_of.withColumn("k", _apart("bucket")).join(ends, "k").select("bucket", "rep", "low", "high", "size"), "members")

    side = reps.select("rep", "n", "sig")

    def linked_pairs(pairs: DataFrame) -> DataFrame:
        """Of the candidates (u, v): those that are links, as a table."""
        pairs = pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        both = pairs.join(side.toDF("u", "n_a", "sig_a"), "u").join(side.toDF("v", "n_b", "sig_b"), "v")
        both = both.where(percent * F.greatest("n_a", "n_b") <= 100 * F.least("n_a", "n_b"))
        likely = materialise(both.mapInPandas(_signatures_agree(least), "u long, v long"), "likely")
        texts = stored.of(likely.select("u").union(likely.select("v")))
        joined = likely.join(texts.toDF("u", "text_a"), "u").join(texts.toDF("v", "text_b"), "v").select("u", "v", "text_a", "text_b")
        links = materialise(joined.mapInPandas(_confirmed(percent, width), "u long, v long"), "links")
        discard(texts, likely)
        return links

    def merged(comps: DataFrame, links: DataFrame) -> DataFrame:
        """``comps`` after ``links`` between their classes."""
        moved = links.join(comps.toDF("u", "cu"), "u", "left").join(comps.toDF("v", "cv"), "v", "left")
        moved = connected_components(moved.select(F.coalesce("cu", "u").alias("u"), F.coalesce("cv", "v").alias("v")))
        old = comps.join(moved.toDF("component", "to"), "component", "left").select("node", F.coalesce("to", "component").alias("component"))
        out = materialise(old.union(moved.join(comps.select("node"), "node", "left_anti").select("node", "component")), "components")
        discard(comps, links, moved)
        return out

    links = linked_pairs(members.select(F.col("rep").alias("u"), F.explode(F.array("low", "high")).alias("v")).where("u <> v"))
    comps = connected_components(links)
    discard(links)
    left = _mixed(members, comps)
    # Mixed buckets are compared completely.
    if not left.isEmpty():
        facts = left.select("rep", "comp").distinct().join(side, "rep")
        flagged = materialise(_compare(_blocks(left, block), facts, _flag(least, percent), "bucket long, rep long, comp long").distinct(), "flagged")
        if not flagged.isEmpty():
            texts = stored.of(flagged.select("rep"))
            found = _compare(_blocks(flagged, max(64, block // 4)), facts.join(texts.toDF("rep", "text"), "rep"), _join_up(least, percent, width), "u long, v long")
            comps = merged(comps, materialise(found.distinct(), "links"))
            discard(texts)
        discard(flagged)
    discard(left, members, reps)

    where = classes.join(comps.toDF("node", "component"), "node", "left").select("digest", F.coalesce("component", "node").alias("component"), "least")
    if several is None:  # then a component is its smallest doc_id
        where = where.select("digest", "component", F.col("component").alias("component_id"))
    else:
        where = materialise(where, "where")
        lowest = where.groupBy((-F.col("component").cast("decimal(20,0)")).alias("k")).agg(F.min("least").alias("component_id"))
        where = where.withColumn("k", _apart("component")).join(lowest, "k").select("digest", "component", "component_id")
    stored.close()
    return feats.select("doc_id", "n_shingles", "digest"), materialise(where, "where")


def _components_of(feats: DataFrame, where: DataFrame) -> DataFrame:
    """``feats`` (doc_id, n_shingles, digest) with component and component_id."""
    keyed = where.select(F.concat(F.lit("="), "digest").alias("k"), "component", "component_id")
    out = feats.withColumn("k", F.concat(F.lit("="), "digest")).join(keyed, "k", "left").drop("k")
    return out.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")))


def near_duplicates(documents: DataFrame, **settings) -> DataFrame:
    """Component of every document under shingle similarity.

    Input: columns ``doc_id`` long and ``text``; others are ignored. Output:
    ``doc_id, n_shingles, component_id, kept``, one row for each input row.
    Two documents are linked if 100 * |A & B| >= percent * |A | B|. Settings
    (``percent, width, bands, rows, block``) are those of ``assign``.

    Null, empty and word-less texts have no shingles: they are linked with
    nothing, are their own component and are kept. Very long texts are hashed
    whole. Rows that repeat a doc_id with one text are one document; rows that
    repeat it with different texts are compared as different documents, so
    their components may differ; the order of rows decides nothing, and ties
    go to the smallest doc_id. A null doc_id takes no part in linking: its
    component is null and it is kept. Empty tables give no rows.

    At similarity s a pair shares no band with probability
    (1 - s^rows)^bands: 2.5e-5 at 0.75, 1e-9 at 0.85; chains make a lost
    component rarer still.
    """
    out = _components_of(*assign(documents, **settings)).select("doc_id", "n_shingles", "component_id")
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def deduplicate(documents: DataFrame, width: int = WIDTH, **settings) -> DataFrame:
    """``documents`` with one row of each component: one of its smallest id.

    Columns of any name pass unchanged. Of several rows of that id in one
    component, the least by content stands, so the order of rows decides
    nothing; rows of an id that are in different components all stay, being
    no copies. Rows without shingles stay once per id. Null ids stay.

    Only rows that may have to go are shuffled: a Bloom filter of bounded
    size, followed by an exact join, tells them from the rest.
    """
    spark = documents.sparkSession
    small_batches(spark)
    feats, where = assign(documents.select(own("doc_id"), own("text")), width=width, **settings)
    verdict = _components_of(feats, where).select("doc_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
    ids = verdict.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n"), F.bool_or("kept").alias("kept"))
    listed = materialise(ids.where("n > 1 or not kept").select("doc_id", (F.col("kept") & (F.col("n") > 1)).alias("again")), "listed")
    if listed.isEmpty():
        return documents
    words = bloom.build(listed, F.xxhash64("doc_id"), bloom.blocks_for(listed.count()))
    maybe, key, again, digest, component, first = free_names(documents, "maybe", "key", "again", "digest", "component", "first")
    doc_id = F.col("doc_id").cast("long")
    marked = documents.withColumn(maybe, F.coalesce(bloom.prober(spark, words)(F.xxhash64(doc_id)), F.lit(False)) & doc_id.isNotNull())
    sure = marked.where(~own(maybe)).drop(maybe)
    checked = marked.where(own(maybe)).drop(maybe).join(listed.toDF(key, again), doc_id == own(key), "left")
    out = sure.unionByName(checked.where(own(again).isNull()).drop(key, again))
    if listed.where("again").isEmpty():
        return out
    # Rows of repeated ids: one of each component whose smallest id they have.
    several = checked.where(own(again)).drop(key, again).withColumn(digest, _digester(width)(F.col("text").cast("string")))
    known = where.select(F.col("digest").alias(key), F.col("component").alias(component), F.col("component_id").alias(again))
    several = several.join(known, own(digest) == own(key), "left").where(own(again).isNull() | (own(again) == doc_id))
    row = F.struct(*own_columns(documents))
    content = F.struct(own(digest), F.sha2(F.concat_ws("\x1f", *(F.coalesce(c.cast("string"), F.lit("\x00")) for c in own_columns(documents))), 256))
    once = several.groupBy(doc_id.alias(key), own(component).alias(component)).agg(F.min_by(row, content).alias(first))
    return out.unionByName(once.select(own(first)).select(f"`{first}`.*"))


class _Texts:
    """Texts of classes by node, each read from one of its rows.

    A node from LOWEST on is a doc_id with a single set, so any
    row of that id will do. The other classes' texts, those of ids with
    several sets only, are found by digest once and kept as a table.
    """

    def __init__(self, docs: DataFrame, classes: DataFrame, several: DataFrame | None, width: int):
        self.docs = docs.where(F.col("doc_id").isNotNull())
        self.shared = None
        if several is not None:
            rows = self.docs.join(several, F.col("doc_id") == F.col("id"), "left_semi").withColumn("digest", _digester(width)("text"))
            own_classes = classes.where(F.col("node") < LOWEST).select("digest", F.col("node").alias("id"))
            found = rows.select("digest", "text").join(own_classes, "digest").groupBy("id").agg(F.min("text").alias("text"))
            self.shared = materialise(found, "shared")
            self.single = several

    def of(self, nodes: DataFrame) -> DataFrame:
        """(id, text) of the given nodes, one row each, as a scratch table.

        A Bloom filter of bounded size thins the documents before they are
        shuffled; the semi-join that follows is exact.
        """
        ids = materialise(nodes.toDF("id").distinct(), "ids")
        words = bloom.build(ids, F.xxhash64("id"), bloom.blocks_for(ids.count()))
        maybe = bloom.prober(self.docs.sparkSession, words)
        found = self.docs.where(maybe(F.xxhash64("doc_id"))).join(ids.withColumnRenamed("id", "doc_id"), "doc_id", "left_semi")
        found = found.select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text")).dropDuplicates(["id"])
        if self.shared is not None:
            found = found.unionByName(self.shared.join(ids, "id", "left_semi"))
        out = materialise(found, "texts")
        discard(ids)
        return out

    def close(self) -> None:
        if self.shared is not None:
            discard(self.shared, self.single)
