"""Operators for large glossaries, groups and orders, against plain Python."""

import random
from collections import Counter

import pytest
import regex
from pyspark.sql import functions as F

from textloom import queries, scale_queries
from textloom.operators import glossary, intervals, packing, segments
from textloom.operators.glossary import claims, pattern_of
from textloom.operators.orders import filled_down, ranked
from textloom.operators.term_automaton import Applying, AsciiPairs, Claims

SF = "/root/testdata/sf0.001"

# --- terms ------------------------------------------------------------------

PIECES = ["fire", "team", "Fire", "TEAM", "C.O.", "C", ".", "O", "é", "É", "x-ray", "x", "-", "_", "IR", "ir", "ſide", "SIDE", "数据", "a b", "  ", "́", "İ", "i", "ς", "Σ", "σ", "K", "k", "ß", "ẞ", "\xa0", "\n"]


def test_automaton_equals_direct_patterns():
    """Claims (blanked places included), applying terms and ASCII pairs."""
    rng = random.Random(3)
    low = lambda t: t.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    some = Counter()
    for _ in range(2500):
        terms = {}
        for _ in range(rng.randint(1, 9)):
            term = rng.choice(["", " ", " "]).join(rng.choice(PIECES) for _ in range(rng.randint(1, 3)))
            term = term.strip() if rng.random() < 0.9 else term
            if term:
                terms[term] = (term, rng.random() < 0.1, rng.random() < 0.6)
        terms = sorted(terms.values(), key=lambda t: -len(t[0]))
        text = rng.choice(["", "", " "]).join(rng.choice([*PIECES, " ", " ", "_"]) for _ in range(rng.randint(0, 14)))
        want = claims(text, terms)
        assert Claims(terms, pattern_of)(text) == want, (text, terms)
        applying = [k for k, (s, c, ci) in enumerate(terms) if not c and (pattern_of(s, True).search(text) or ci and pattern_of(s, False).search(text))]
        assert Applying(terms, pattern_of)(text) == applying, (text, terms)
        pairs = [k for k, t in enumerate(terms) if regex.search(r"(?:\A|(?<=[^A-Za-z0-9_]))" + regex.escape(low(t[0])) + r"(?=\Z|[^A-Za-z0-9_])", low(text))]
        assert AsciiPairs([t[0] for t in terms])(text) == pairs, (text, terms)
        some.update(claims=len(want), applying=len(applying), pairs=len(pairs))
    assert min(some.values()) > 400


def test_terms_made_by_blanking():
    """A claimed place is blank: the words around it then make a term."""
    terms = [("b-b", False, True), ("X   Y", False, True)]
    assert Claims(terms, pattern_of)("xb-by") == claims("xb-by", terms) == []
    terms = [("-+-", False, True), ("X   Y", False, True)]
    assert Claims(terms, pattern_of)("x-+-y") == claims("x-+-y", terms) == [("-+-", "exact"), ("X   Y", "case-insensitive-unique")]


def test_claims_of_many_texts_without_patterns():
    """Texts go through the terms together, and plain hits need no pattern."""
    def refused(*_):
        raise AssertionError("a pattern was made")

    terms = [("red  bolt", False, True), ("red bolt", False, True), ("bolt", False, True), ("Red", True, False), ("Customer#7", False, True), ("a", False, True)]
    texts = ["a RED bolt, red bolt", "", "bolt_ bolt-bolt", "(a)b customer#7 Customer#77", "red x bolt", None]
    got = list(Claims(terms, refused).many(texts))
    assert got == [claims(t or "", terms) for t in texts] and sum(map(len, got)) == 7
    long = " ".join(["bolt", "red  bolt", "x"] * 200_000)  # more than a block
    assert list(Claims(terms, refused).many([long, "a", long]))[1] == [("a", "exact")]


def test_counts_of_terms_by_keys(spark):
    """A key counts once, on however many texts; null keys do not count."""
    rows = [(1, "red bolt, Red"), (1, "bolt"), (2, "red"), (None, "red hat"), (None, "hat"), (3, None), (4, "bolt_ red")]
    texts = spark.createDataFrame(rows, "k int, t string")
    pairs = spark.createDataFrame([("red", "x"), ("red", "y"), ("red bolt", "x"), ("bolt", "x"), ("hat", "x"), ("", "x"), ("no", "x")], "source string, target string")
    want = {"red": 3, "red bolt": 1, "bolt": 1, "hat": 0}
    assert {r.source: r.n for r in glossary.term_counts(texts, pairs, "k", "t").collect()} == want
    alone = texts.where("k > 1")
    assert {r.source: r.n for r in glossary.term_counts(alone, pairs, "k", "t").collect()} == {"red": 2}
    # Hits are counted where they are found: neither texts nor keys move.
    plan = glossary.term_counts(alone, pairs, "k", "t")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "hashpartitioning(k" not in plan


def test_a_large_glossary_on_whole_texts(spark):
    found, compiled = scale_queries.corpus_claims(spark, SF)
    terms = [(r.source, r.contextual, r.allow_ci) for r in glossary.by_length(compiled).collect()]
    assert len(terms) > 1500
    want = Counter()
    for r in found.collect():
        text = r.text or ""
        may = [t for t in terms if t[0].lower() in text.lower()]  # only skips terms that cannot match
        assert [tuple(m) for m in r.matches] == claims(text, may)
        want.update(tuple(m) for m in r.matches)
    got = queries.QUERIES["corpus_term_claims"](spark, SF).collect()
    assert {(r.source, r.mode): r.n_documents for r in got} == want


def test_glossary_in_several_lists(spark, monkeypatch):
    """Over the byte bound: lists one after the other, tokens joined."""
    names = ["glossary_match_pairs", "profile_delta", "corpus_profile_delta", "corpus_term_pairs", "glossary_match_claims"]
    rows = lambda: [sorted(map(tuple, queries.QUERIES[n](spark, SF).collect()), key=repr) for n in names]
    want = rows()
    monkeypatch.setattr(glossary, "MOST_BYTES", 20)
    few = [r for r in names if r != "corpus_term_pairs" and r != "corpus_profile_delta"]
    for n in few:
        assert sorted(map(tuple, queries.QUERIES[n](spark, SF).collect()), key=repr) == want[names.index(n)]
    monkeypatch.setattr(glossary, "MOST_BYTES", 4000)
    for n in ("corpus_term_pairs", "corpus_profile_delta"):
        assert sorted(map(tuple, queries.QUERIES[n](spark, SF).collect()), key=repr) == want[names.index(n)]


def test_texts_are_not_moved(spark):
    """Neither claims nor deltas exchange texts; pairs exchange keys only."""
    docs = queries.table(spark, SF, "documents").select("doc_id", "text")
    c = glossary.compile_entries(spark.createDataFrame([("the", "x", "word", "", 0)], "source string, target string, kind string, source_term string, ord long"))
    assert "Exchange" not in glossary.match_terms(docs, c, "doc_id", "text")._jdf.queryExecution().executedPlan().toString()
    groups = docs.select(F.col("doc_id").alias("group_id"), F.col("text").alias("source_text"), F.lit("").alias("target_text"))
    assert "Exchange" not in glossary.select_for_delta(groups, c)._jdf.queryExecution().executedPlan().toString()


# --- intervals --------------------------------------------------------------


def test_overlaps_equal_all_pairs(spark):
    """Lengths from 0 to a million, negative starts, repeats, nulls."""
    rng = random.Random(7)

    def made(n):
        out = []
        for i in range(n):
            start = rng.randint(-50, 2000) if rng.random() < 0.7 else rng.randint(-10**6, 10**6)
            long = rng.choice([0, 0, 1, 1, 2, 3, 5, 8, 64, 65, 1000, 10**6])
            out.append((rng.choice(["a", "a", "b", None]), i, start, None if i % 50 == 49 else start + long - (2 if i % 40 == 39 else 0)))
        return out + out[:5]

    a, b = made(250), made(150)
    schema = "k string, id int, start long, end long"
    got = intervals.overlapping(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), ["k"])
    pairs = Counter((r.k, tuple(r.left), tuple(r.right)) for r in got.collect())
    good = lambda r: r[0] is not None and r[3] is not None and r[3] >= r[2]
    want = Counter((x[0], x, y) for x in filter(good, a) for y in filter(good, b) if x[0] == y[0] and x[2] < y[3] and y[2] < x[3])
    assert pairs == want and len(want) > 1000


def test_a_hot_key_is_dealt_out(spark):
    """20,000 short intervals of one key, and one as long as all of them: rows
    that meet grow with the pairs, not with their square."""
    n = 20_000
    rows = spark.range(n).select(F.lit("hot").alias("k"), "id", (F.col("id") * 10).alias("start"), (F.col("id") * 10 + 12).alias("end"))
    rows = rows.union(spark.createDataFrame([("hot", n, 0, 10 * n)], "k string, id long, start long, end long"))
    got = intervals.overlap_counts(rows, rows, ["k"], ["id"])
    assert got.agg(F.sum("n")).first()[0] == n + 2 * (n - 1) + 2 * n + 1
    entries = intervals._entries(rows, "start", "end", [4, 18])
    assert entries.count() <= 4 * (n + 1) and entries.groupBy("level", "cell").count().where("level < 18").agg(F.max("count")).first()[0] <= 4
    assert got.where(f"id = {n}").first().n == n + 1
    assert intervals.overlap_counts(rows.limit(0), rows, ["k"], ["id"]).count() == 0


# --- orders and packing -----------------------------------------------------


def test_ranks_of_any_columns(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["x", "y", None, "é"]), rng.choice([None, 1.5, -2.0, 7.0]), i, rng.randint(0, 9)) for i in range(500)]
    df = spark.createDataFrame(rows, "s string, d double, i int, v int").repartition(7)
    key = lambda r: (r[0] is not None, (r[0] or "").encode(), r[1] is not None, r[1] or 0, r[2])
    want, before = {}, 0
    for n, r in enumerate(sorted(rows, key=key)):
        want[r[2]] = (n + 1, before)
        before += r[3]
    assert {r.i: (r.rank, r.before_v) for r in ranked(df, ["s", "d", "i"], values=["v"]).collect()} == want
    assert ranked(df.limit(0), ["s", "i"]).count() == 0


def test_filled_down_over_ranges(spark):
    rng = random.Random(4)
    rows = [(i, str(i) if rng.random() < 0.02 else None, " " if rng.random() < 0.9 else f"v{i}") for i in range(1, 800)]
    df = spark.createDataFrame(rows, "row_no long, a string, b string").repartition(5)
    a, b, want = None, "", {}
    for i, x, y in rows:
        a, b = x or a, y if y.strip() else b
        want[i] = (a, b)
    assert {r.row_no: r.a for r in filled_down(df.drop("b"), ["a"], "row_no").collect()} == {i: w[0] for i, w in want.items()}
    got = segments.fill_down(df, ["a", "b"], ()).collect()
    assert {r.row_no: (r.a, r.b) for r in got} == {i: (w[0] or "", w[1]) for i, w in want.items()}


def greedy(rows, limits, most):
    """Batch numbers of one key's sizes, in order."""
    out, batch, held, n = [], 0, [0] * len(limits), 0
    for row in rows:
        grown = [a + b for a, b in zip(held, row)]
        if not n or n >= most or any(a > b for a, b in zip(grown, limits)):
            batch, n, grown = batch + 1, 0, list(row)
        held, n = grown, n + 1
        out.append(batch)
    return out


@pytest.mark.parametrize("seed", range(6))
def test_packing_in_chunks_equals_greedy(spark, seed):
    """Chunks smaller and larger than keys; sizes of 0 and beyond the limit."""
    rng = random.Random(seed)
    rows = []
    for k in ["a", "b", "c", "d"][: rng.randint(1, 4)]:
        rows += [(k, 3 * i + rng.randint(0, 2), rng.choice([0, 0, 1, 5, 9, 30]), rng.randint(0, 6)) for i in range(rng.choice([1, 2, 7, 40, 180]))]
    limits, most = [rng.choice([10, 29, 100]), rng.choice([6, 15])], rng.choice([1, 3, 8])
    want = {}
    for k in {r[0] for r in rows}:
        own = sorted(r for r in rows if r[0] == k)
        want |= {(k, r[1]): b for r, b in zip(own, greedy([r[2:] for r in own], limits, most))}
    df = spark.createDataFrame(rows, "k string, ord int, x int, y int")
    got = packing.next_fit(df, "ord", ["x", "y"], limits, most, ["k"], "alone", chunk=rng.choice([1, 5, 8, 1000])).collect()
    assert {(r.k, r.ord): r.batch_no for r in got} == want


def test_packing_edges(spark):
    df = spark.createDataFrame([("a", i, 5) for i in range(50)], "k string, ord int, x int")
    one = packing.next_fit(df, "ord", ["x"], [12], 9, [], chunk=9).collect()
    assert {r.ord: r.batch_no for r in one} == {i: i // 2 + 1 for i in range(50)}
    assert packing.next_fit(df.limit(0), "ord", ["x"], [12], 9, ["k"]).count() == 0
    with pytest.raises(Exception, match="over the limit"):
        packing.next_fit(df, "ord", ["x"], [4], 9, ["k"]).collect()


NO_PARTITION = regex.compile(r"windowspecdefinition\(([^,()]*?(?:ASC|DESC)[^,()]*)")


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_no_window_over_all_rows(name, spark):
    """A window without partition runs over the totals of ranges only."""
    text = queries.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert all(regex.match(r"_range#", m) for m in NO_PARTITION.findall(text)), NO_PARTITION.findall(text)
