"""Operators 11 to 13 against plain Python, and their defined cases."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.llm import divergence as dv
from textloom.llm import exact_index, queries, search
from textloom.llm.divergence import divergence
from textloom.llm.exact_index import exact_duplicates

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string"


def lowered(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


@pytest.mark.parametrize("name", ["op11_lexical_search", "op12_source_divergence", "op13_exact_dedup"])
def test_query_equals_sql(name, against_sql):
    assert against_sql(queries.QUERIES[name], queries.ORACLE_SQL[name], SF)


# --- search -----------------------------------------------------------------


def ranked(docs, items, k):
    term = lambda t: re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", lowered(t))
    found = [(d, term(t)) for d, t in docs]
    found = [(d, Counter(w), len(w)) for d, w in found if w]
    n, total = len(found), sum(x[2] for x in found)
    df = Counter(t for _, c, _ in found for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * x + 1))) for t, x in df.items()}
    out = []
    for item, text in items:
        asked, scores = Counter(term(text)), []
        for d, c, long in found:
            m = 75 + 25 * long * n // total
            score = sum(q * weight[t] * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t, q in asked.items() if c[t])
            if score > 0:
                scores.append((-score, d is None, d or 0, d))
        out += [(item, i + 1, x[3], -x[0]) for i, x in enumerate(sorted(scores, key=lambda x: x[:3])[:k])]
    return out


def searched(spark, docs, items, k=20):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id string, text string")
    return [tuple(r) for r in search.search(d, i, k).collect()]


HARD_DOCS = [(1, "Alpha beta"), (2, "ALPHA beta beta"), (3, None), (4, ""), (5, "gamma " * 5000 + "alpha"), (6, "!!"), (7, "Ünï alpha9 straße"), (2, "ALPHA beta beta"), (None, "alpha beta"), (8, "delta"), (9, "delta"), (10, "ÜNÏ")]
HARD_ITEMS = [("a", "alpha beta beta zeta"), ("b", None), ("c", ""), ("d", "delta delta"), ("a", "GAMMA"), (None, "ünï Ünï"), ("e", "nowhere")]


@pytest.mark.parametrize("k", [1, 2, 3, 20])
def test_search_hard_cases(spark, k):
    key = lambda r: tuple(map(repr, r))
    assert sorted(searched(spark, HARD_DOCS, HARD_ITEMS, k), key=key) == sorted(ranked(HARD_DOCS, HARD_ITEMS, k), key=key)


def test_search_empty_tables(spark):
    assert searched(spark, [], HARD_ITEMS) == [] and searched(spark, HARD_DOCS, []) == []


def test_search_blocks_and_small_steps(spark, monkeypatch):
    docs = [(r.doc_id, r.text) for r in queries._read(spark, SF, "documents").collect()]
    items = [(str(r.item_id), r.text) for r in queries._read(spark, SF, "benchmark").collect()]
    monkeypatch.setattr(search, "BLOCK_BYTES", 1500)
    assert len(list(search._blocks(spark.createDataFrame(items, "item_id string, text string")))) > 3
    assert sorted(searched(spark, docs, items)) == sorted(ranked(docs, items, 20))


def test_search_ignores_other_columns(spark):
    d = spark.createDataFrame([(1, "alpha", "x", 3)], "doc_id long, text string, `n` string, `Terms` int")
    i = spark.createDataFrame([(1, "alpha", 9)], "item_id long, text string, score int")
    assert [tuple(r)[:3] for r in search.search(d, i).collect()] == [(1, 1, 1)]


def test_terms_left_out_change_nothing():
    """Terms are left out only below the floor, and some are."""
    asked = [Counter({0: 1, 1: 1, 2: 1})]
    stats = [(0, 10, 500, 400), (1, 900, 900, 800), (2, 5, 900, 0)]
    p = search.plan_terms(asked, stats, 1000, 100_000)
    best = search.weight(1000, 10) * 400
    assert p.floor[0] == best and list(p.left_out[1]) == [0] and p.rest[0] == search.weight(1000, 900) * 900 < best
    assert p.left_out[0].tolist() == [0, 0, 1, 1]


def test_stored_impacts(spark):
    rows = spark.createDataFrame([(i, 10, [0], [i % 5 + 1]) for i in range(100)] + [(200, 10, [1], [3])], "doc_id long, n long, terms array<int>, tfs array<long>")
    s = sorted((10**9 * tf // (1000 * tf + 12 * 100) for tf in (i % 5 + 1 for i in range(100))), reverse=True)
    got = {r.term: r for r in search.stored_impacts(rows, 101, 1010, 20).collect()}
    assert (got[0].df, got[0].high) == (100, s[0]) and s[19] - search.CELL < got[0].kth <= s[19]
    assert (got[1].df, got[1].kth) == (1, 0)


# --- divergence -------------------------------------------------------------


def diverging(docs, ranks=200):
    blank = lambda x: x or ""
    per = [(blank(la), blank(so), Counter(re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", lowered(t)))) for _, t, la, so in docs]
    df = Counter((la, t) for la, _, c in per for t in c)
    groups, n = defaultdict(Counter), defaultdict(Counter)
    for la, so, c in per:
        groups[la, so], n[la]
        for t, x in c.items():
            if df[la, t] >= 3:
                groups[la, so][t] += x
                n[la][t] += x
    out = []
    for (la, so), g in groups.items():
        v = len(n[la])
        share = lambda c, t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + v)
        f = lambda p, q: (p - q) ** 2 // q
        pair = [(-sum(f(share(g, t), share(h, t)) for t in n[la]), other.encode(), other) for (lb, other), h in groups.items() if lb == la and other != so]
        term = [(-f(share(g, t), share(n[la], t)), t.encode(), t) for t in n[la] if g[t] and share(g, t) > share(n[la], t)]
        for part, rows in (("pair", sorted(pair)), ("term", sorted(term)[:ranks])):
            out += [(la, so, part, x[2], -x[0], i + 1) for i, x in enumerate(rows)]
    return sorted(out)


def test_divergence_whole_table(spark):
    rows = [tuple(r) for r in queries._read(spark, SF, "documents").select("doc_id", "text", "lang", "source").collect()]
    got = queries.op12_source_divergence(spark, SF)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == diverging(rows)


def test_divergence_hard_cases(spark):
    rows = [(1, "Aa bb cc", "en", "x"), (2, "aA bb", "en", "y"), (3, "aa bb cc dd", "en", None), (3, "aa bb cc dd", "en", None), (4, None, "en", "empty"), (5, "", "xx", "p"), (6, "once", "xx", "q"),
            (7, "tie tee tie tee", None, "a"), (8, "tee tie", "", "a"), (9, "tie tee more", None, "b"), (10, "élan Élan 9", "fr", "a"), (11, "élan", "fr", "b"), (12, "élan " * 30_000, "fr", "b"), (13, "x", "only", "one")]
    df = spark.createDataFrame([(*r, 1, "n") for r in rows], DOCS + ", Kept int, Term string")
    assert sorted(map(tuple, divergence(df).collect())) == diverging(rows)
    assert sorted(map(tuple, divergence(df, ranks=1).collect())) == diverging(rows, 1)
    assert divergence(df.limit(0)).count() == 0


def test_sketch_never_underestimates(spark):
    rows = spark.createDataFrame([(f"w{i % 300:03d}".translate(str.maketrans("0123456789", "abcdefghij")), "en") for i in range(0, 900, 2)], "text string, lang string").withColumn("source", F.lit(""))
    df = Counter(r.text for r in rows.collect())
    for cells in (1 << 16, 1 << 18):
        sketch = dv.document_sketch(rows.repartition(5), 3, cells)
        terms = sorted(df)
        at = dv.places("en", [t.encode() for t in terms], cells)
        least = [min(int(row[p]) for row, p in zip(sketch, places)) for places in at.T]
        assert all(x >= min(df[t], 3) for t, x in zip(terms, least)) and sketch.max() <= 3


def test_tasks_hand_on_in_pieces(spark, monkeypatch):
    rows = [tuple(r) for r in queries._read(spark, SF, "documents").select("doc_id", "text", "lang", "source").collect()]
    monkeypatch.setattr(dv, "HELD", 500)
    df = spark.createDataFrame(rows, DOCS)
    assert sorted(map(tuple, divergence(df, cells=1 << 17).collect())) == diverging(rows)


# --- exact duplicates -------------------------------------------------------


def copies(rows):
    groups = defaultdict(list)
    for i, (d, t) in enumerate(rows):
        groups[re.sub("[\x20\x09-\x0d]+", " ", t or "")].append((d is None, d or 0, i, d))
    out = []
    for t, g in groups.items():
        keep = min(g)
        out += [(x[3], keep[3], len(g), x[2] == keep[2], hashlib.sha256(t.encode()).hexdigest()) for x in g]
    return sorted(out, key=repr)


INDEX_ROWS = [(5, "a b"), (3, "a\t\n b"), (3, "a  b"), (None, "a b"), (9, None), (8, ""), (7, " "), (6, "\n\n"), (None, "x"), (None, "x"), (1, "y " * 200_000), (2, "y\v" * 200_000), (4, "Ünï x"), (10, "A b")]


@pytest.mark.parametrize("key", [F.xxhash64, lambda t: F.pmod(F.length(t), F.lit(5)).cast("long") * F.lit(1 << 59), lambda t: F.lit(7).cast("long") + F.length(t) * 0], ids=["hash", "few keys", "one key"])
@pytest.mark.parametrize("capacity", [None, 1, 2, 3])
def test_exact_hard_cases(spark, key, capacity):
    df = spark.createDataFrame([(*r, 1, "k") for r in INDEX_ROWS], "doc_id long, text string, bucket int, Key string").coalesce(1)
    got = exact_duplicates(df, key, capacity).collect()
    assert sorted((tuple(r)[:5] for r in got), key=repr) == copies(INDEX_ROWS)
    chains = {(r.text_sha256, r.chain) for r in got}
    assert len(chains) == len({r.text_sha256 for r in got})


def test_exact_empty(spark):
    assert exact_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_directory_doubles_where_overfull(spark):
    """Cells 0-7 of three bits; 30 rows in cell 5, few elsewhere."""
    cells = spark.createDataFrame([(0, 1), (1, 2), (2, 1), (4, 3), (5, 30), (7, 1)], "cell long, n long")
    got = {r.cell: (r.bucket, r.depth, r.pages) for r in exact_index.directory(cells, 3, 4).collect()}
    assert got == {0: (0, 1, 1), 1: (0, 1, 1), 2: (0, 1, 1), 4: (4, 3, 1), 5: (5, 3, 8), 7: (6, 2, 1)}


def test_hot_text_is_dealt_to_pages(spark):
    """A third of all rows are copies: their pages go to several tasks, and
    the index compares bytes without a second exchange of single pages."""
    rows = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("same text")).otherwise(F.concat(F.lit("text "), F.col("id"))).alias("text"))
    got = exact_duplicates(rows, capacity=100)
    assert got.schema["group_size"].dataType == T.LongType()
    first = got.where("text_sha256 = sha2('same text', 256)").agg(F.count("*").alias("n"), F.min("keep_id").alias("a"), F.max("keep_id").alias("b"), F.sum(F.col("kept").cast("int")).alias("k"), F.max("group_size").alias("g")).first()
    assert tuple(first) == (2000, 0, 0, 1, 2000) and got.where("kept").count() == 4001
