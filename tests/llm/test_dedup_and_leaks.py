"""Near-duplicates, decontamination and quality rules against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.llm import bloom, components, decontam, minhash, quality_rules, queries

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def shingles(text, width=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()


def brute_components(docs, percent=75):
    sets = {i: shingles(t) for i, t in docs}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i)) for i in sets}


def varied(rng, words, edits):
    out = list(words)
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"w{rng.randrange(10**6)}"
    return " ".join(out)


def corpus(seed, groups, sizes=(1, 3, 30), length=120):
    """Bases with copies of few and many edits, and a shared passage."""
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(60)]
    docs = []
    for g in range(groups):
        base = [f"g{g}v{rng.randrange(400)}" for _ in range(length)] + (passage if g % 2 else [])
        for _ in range(sizes[g % len(sizes)]):
            docs.append(varied(rng, base, rng.choice([0, 1, 2, 5, 8])))
    rng.shuffle(docs)
    return list(enumerate(docs))


def test_dedup_query(against_sql):
    against_sql(queries.op2_minhash_dedup, queries.ORACLE_SQL["op2_minhash_dedup"], SF)


def as_result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


@pytest.mark.parametrize("seed,block", [(1, 512), (2, 4)])
def test_components_equal_brute_force(spark, seed, block):
    docs = corpus(seed, 9)
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in docs], DOCS)
    assert as_result(minhash.near_duplicates(df, block=block)) == brute_components(docs)


def test_exhaustive_comparison_finds_what_pivots_miss(spark):
    """A chain whose ends are far apart: bucket ends are not its neighbours."""
    rng = random.Random(4)
    words = [f"c{i}" for i in range(200)]
    docs, now = [], list(words)
    for i in range(40):
        docs.append((i * 7 % 41, " ".join(now)))
        for k in rng.sample(range(200), 2):
            now[k] = f"n{i}x{k}"
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in docs], DOCS)
    assert as_result(minhash.near_duplicates(df, block=4)) == brute_components(docs)


def test_dedup_edges(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, " \n", "x"), (4, "One two", "x"), (5, "one  TWO", "x"), (6, "ÉÉ é", "x"), (7, "éé é", "x"), (4, "One two", "x"), (None, "one two", "x"), (8, "a " * 30_000, "x"), (9, "a " * 29_999, "x"), (10, "q w e r t y", "x"), (10, "other words stand here now", "x")]
    df = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, digest string, bands int")
    out = minhash.near_duplicates(df).collect()
    assert len(out) == len(rows) and set(df.columns) & {"digest", "bands"}
    got = defaultdict(set)
    for r in out:
        got[r.doc_id].add((r.component_id, r.kept))
    assert got[4] == {(4, True)} and got[5] == {(4, False)} and got[None] == {(None, True)} and got[9] == {(8, False)}
    assert all(got[i] == {(i, True)} for i in (1, 2, 3, 6, 7, 10))
    kept = [r.doc_id for r in minhash.deduplicate(df).collect()]
    assert sorted(kept, key=str) == sorted([1, 2, 3, 4, 6, 7, None, 8, 10, 10], key=str)  # the texts of 10 are no copies
    empty = df.where("false")
    assert minhash.near_duplicates(empty).count() == 0 and minhash.deduplicate(empty).columns == df.columns


def test_shingle_hash_agrees_with_words():
    texts = ["a b c d e f", "A  b\tc d e f ", "b c d e f", "a b", "", "x" * 100_000, "é ü"]
    sets = list(minhash.shingle_sets([t.encode() for t in texts]))
    assert [len(s) for s in sets] == [len(shingles(t)) for t in texts]
    assert (sets[0] == sets[1]).all() and len(np.intersect1d(sets[0], sets[2])) == 1


def test_stars(spark):
    rng = random.Random(9)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] + [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 560)]
    df = spark.createDataFrame([*edges, (7, 7), (None, 3)], "u long, v long")
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        p, q = find(a), find(b)
        root[max(p, q)] = min(p, q)
    want = {x: find(x) for a, b in edges if a != b for x in (a, b)}
    got = {r.node: r.component for r in components.connected_components(df).collect()}
    assert got == want
    assert components.connected_components(df.where("false")).count() == 0


def test_bloom_never_loses(spark):
    df = spark.range(2000).select(F.xxhash64("id").alias("h"))
    words = bloom.build(df, F.col("h"), bloom.blocks_for(2000))
    assert bloom.probe(words, np.array([r.h for r in df.collect()])).all()
    other = np.array([r[0] for r in spark.range(5000, 15_000).select(F.xxhash64("id")).collect()])
    assert bloom.probe(words, other).mean() < 0.02
    tiny = bloom.build(df, F.col("h"), 1)
    assert bloom.probe(tiny, np.array([r.h for r in df.collect()])).all()
    assert not bloom.build(df.where("false"), F.col("h"), 4).any()


# --- decontamination --------------------------------------------------------


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))


def brute_leaks(docs, items):
    own = defaultdict(set)
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - 9) if w else 0):
            own[tuple(w[k : k + 10])].add(i)
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(k) for k in own}:
            for k in range(len(w) - n + 1):
                if ids := own.get(tuple(w[k : k + n])):
                    hit |= set(range(k, k + n))
                    found |= ids
        digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(found), digest, bool(hit)))
    return out


def leak_rows(df):
    c = F.col("contamination")
    cols = df.select("doc_id", c["n_words"], c["n_hit"], F.size(c["items"]), F.sha2(F.array_join(F.array_sort(F.transform(c["items"], lambda x: x.cast("string"))), ","), 256), c["n_hit"] > 0)
    return [tuple(r) for r in cols.collect()]


def test_leak_query_on_whole_tables(spark, against_sql):
    against_sql(queries.op8_decontamination, queries.ORACLE_SQL["op8_decontamination"], SF)
    docs = queries._read(spark, SF, "documents").select("doc_id", "text").collect()
    items = queries._read(spark, SF, "benchmark").select("item_id", "text").collect()
    got = [tuple(r) for r in queries.op8_decontamination(spark, SF).collect()]
    assert sorted(got) == sorted(brute_leaks(docs, items))


@pytest.mark.parametrize("most_bytes", [1 << 20, 40])
def test_leak_edges(spark, most_bytes):
    ten = "One two, three four five six seven eight nine ten"
    items = [(1, ten + " eleven"), (10, "short Item!"), (2, None), (3, " .,"), (4, "été ü"), (10, "short Item!"), (None, "nothing here"), (5, "one two three")]
    docs = [(1, "x " + ten.upper() + " eleven y"), (2, None), (3, ""), (4, "short...item short"), (5, "ÉTÉ ü été-ü"), (6, "shorter item"), (6, "shorter item"), (7, ten.replace("five", "5") + "\x00one-two.THREE"), (8, "short item " * 3000)]
    d = spark.createDataFrame([(i, t, "c") for i, t in docs], "doc_id long, text string, contamination string")
    b = spark.createDataFrame([(*i, 0) for i in items], "item_id long, text string, doc_id int")
    out = decontam.contamination(d, b, most_bytes=most_bytes)
    assert sorted(leak_rows(out), key=str) == sorted(brute_leaks(docs, [i for i in items if i[0] is not None]), key=str)
    r = next(r for r in out.collect() if r.doc_id == 4)
    spans = list(zip(r.contamination.start, r.contamination.end))
    assert spans == [(0, 12)] and r.text[:12] == "short...item"


def test_leak_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    b = spark.createDataFrame([], "item_id long, text string")
    assert leak_rows(decontam.contamination(d, b))[0][1:4] == (2, 0, 0)
    assert decontam.contamination(d.where("false"), b).count() == 0


# --- quality rules ----------------------------------------------------------


def brute_base(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    seen = defaultdict(list)
    for i in range(len(w) - 4):
        seen[tuple(w[i : i + 5])].append(i)
    hit = {p + k for ps in seen.values() if len(ps) > 1 for p in ps for k in range(5)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(w) < 10 or 100 * len(hit) > 20 * len(w)
    return len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit), failed


def base_of(r):
    return r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed


def test_base_counts_on_the_whole_table(spark):
    texts = dict(queries._read(spark, SF, "documents").select("doc_id", "text").collect())
    rows = queries.op9_quality_rules(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert base_of(r) == brute_base(texts[r.doc_id])
        assert not (r.base_failed and r.kept)


def test_quality_edges(spark):
    line = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    texts = [None, "", "\n\n", line, f"{line}\n{line}", "é" * 10, " a\n a\na \n", "x y z w v x y z w v q", "# $ % & | < > *", "𝒳 " * 30, line * 5000]
    df = spark.createDataFrame([(i, t, None, "k") for i, t in enumerate(texts)], "doc_id long, text string, lang string, quality string")
    rows = quality_rules.quality(df).collect()
    for r in rows:
        assert base_of(r.quality) == brute_base(r.text), r.doc_id
    assert quality_rules.quality(df.drop("lang", "quality")).count() == len(texts)
    assert quality_rules.quality(df.where("false")).count() == 0


def test_distance():
    d = quality_rules.distances
    assert d(np.array([1.0, 0]), np.array([0, 3.0])) == pytest.approx(1) and d(np.array([1.0, 1]), np.array([5.0, 5])) == 0
    p, q = np.array([0.2, 0.8]), np.array([0.5, 0.5])
    m = (p + q) / 2
    want = (sum(p * np.log2(p / m)) / 2 + sum(q * np.log2(q / m)) / 2) ** 0.5
    assert d(p, q) == pytest.approx(want) and d(q, p) == pytest.approx(want)


def test_clean_documents_stay_and_junk_goes(spark):
    sf = "/root/testdata/sf0.01"
    rows = queries.op9_quality_rules(spark, sf).join(queries._read(spark, sf, "labels").select("doc_id", F.col("quality").alias("label")), "doc_id").where("not base_failed").collect()
    clean, junk = [r.kept for r in rows if r.label == 1], [r.kept for r in rows if r.label == 0]
    assert sum(clean) >= 0.99 * len(clean) and sum(junk) <= 0.35 * len(junk)


def test_languages_without_a_reference_are_not_judged_by_distance(spark):
    english = "the house of the man and the dog is in a garden that was made for it with care"
    russian = "каждое утро старый рыбак выходит на берег моря где ветер качает лодки среди серых камней"

    def shuffled(words, seed, times=14):
        rng = random.Random(seed)
        return " ".join(" ".join(rng.sample(words.split(), len(words.split()))) for _ in range(times))

    rows = [(i, "en", shuffled(english, i)) for i in range(20)] + [(90, "ru", shuffled(russian, 90, 18)), (91, None, shuffled(russian, 90, 18)), (92, "en", shuffled(russian, 90, 18))]
    got = {r.doc_id: r.quality for r in quality_rules.quality(spark.createDataFrame(rows, "doc_id long, lang string, text string")).collect()}
    assert all(got[i].kept for i in range(20)) and got[0].nearest == "en"
    assert got[90].n_words > 150 and not got[90].base_failed and got[90].kept and got[90].word_distance is None and got[90].nearest is None
    assert not got[91].kept and not got[92].kept  # claimed for a known language, or for none
