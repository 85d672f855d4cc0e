"""Very long runs, keys, lists of hashes and hosts: exact, within seconds."""

import hashlib
import random
import time

import pytest
from pyspark.sql import functions as F

from textloom.llm import queries, secrets, token_counts, urlfilter

VOCABULARY, EOD = queries.VOCABULARY, queries.END_OF_DOCUMENT


@pytest.mark.parametrize("blank", [" ", "\n", " \n", "\t ", "\xa0 ", " "])
@pytest.mark.parametrize("around", [("", ""), ("a", ""), ("", "b"), ("word", "word"), ("x.", "'s"), ("1", "2"), ("a", "\x1cb"), ("é", "…")])
def test_cut_runs_give_the_same_tokens(blank, around):
    """4096 to 20,000 blanks, which the pattern can still look back over."""
    bpe = token_counts.encoder(VOCABULARY)
    for n in (4095, 4096, 4097, 20_000):
        run = (blank * n)[:n]
        text = around[0] + run + around[1] + " end" + run + around[1]
        assert token_counts.encode(VOCABULARY, text) == bpe.encode_ordinary(text)


def test_two_million_blanks(spark):
    n = 2_000_000
    df = spark.createDataFrame([(1, " " * n), (2, "a" + "\n" * n + "b"), (3, "a b")], "doc_id long, text string")
    began = time.time()
    got = dict(map(tuple, token_counts.token_counts(df, VOCABULARY, EOD).collect()))
    bpe = token_counts.encoder(VOCABULARY)
    assert got == {1: len(bpe._encode_single_piece(" " * n)), 2: 3 + len(bpe._encode_single_piece("\n" * (n - 1))), 3: 2} and time.time() - began < 60


def test_keys_of_any_length(spark):
    rng = random.Random(5)
    keys = ["".join(rng.choice("ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz0123456789") for _ in range(n)) for n in (200, 201, 300, 5000)]
    df = spark.createDataFrame([(i, f"see {k} here", "s") for i, k in enumerate(keys)], "doc_id long, text string, source string")
    got = {r.doc_id: r.spans for r in secrets.secret_spans(df).collect()}
    assert got == {i: f"owned:4:{4 + len(k)}" for i, k in enumerate(keys)}


def test_a_hundred_thousand_hashes(spark):
    n = 100_000
    lines = [hashlib.sha256(str(i).encode()).hexdigest() for i in range(n)]
    df = spark.createDataFrame([(1, "\n".join(lines), "s"), (2, "no hash", "s")], "doc_id long, text string, source string")
    began = time.time()
    got = {r.doc_id: r for r in secrets.secret_spans(df).collect()}
    want = ",".join(f"hex:{65 * i}:{65 * i + 64}" for i in range(n))
    assert got[1].n_hex == n and got[1].spans == want and got[1].base_sha256 == hashlib.sha256(want.encode()).hexdigest()
    assert got[2].spans == "" and time.time() - began < 90


def test_generic_spans_meet_base_spans(spark):
    """Overlap from before, from inside, at the same start, and next to it."""
    key = "Zx9Kq2Lm7Pw4Rt6Yb3Nz"
    texts = [
        f"{key}0123456789abcdef01234567",  # hex inside the run
        f"token={key} {key}",  # value of an assignment, then free
        f"{key}.password=abcdef",  # "password" starts behind a full stop
        f"{key}password=abcdef",  # the run reaches into the assignment
        f"AKIA{'A1' * 10}{key.lower()}",
    ]
    df = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    got = {r.doc_id: r.spans for r in secrets.secret_spans(df, live_repositories=9).collect()}
    assert got[0] == "hex:20:44" and got[1] == "assign:0:26,owned:27:47" and got[2] == "owned:0:20,assign:21:36"
    assert got[3] == "assign:20:35" and got[4].startswith("access:0:") and "owned" not in got[4]


def test_hosts_of_many_labels(spark):
    deep = "a." * 50_000 + "example.com"
    pages = spark.createDataFrame([(1, f"http://{deep}/de/x"), (2, f"http://{deep}/fr/x"), (3, "http://example.com/de/"), (4, "http://com/de/"), (5, "http://.net/"), (6, "http://net/")], "page_id long, url string")
    rules = spark.createDataFrame(queries.URL_RULES, "host string, path string, verdict string")
    began = time.time()
    got = {r.page_id: (r.rule, r.verdict) for r in urlfilter.judge_urls(pages, rules).collect()}
    assert got == {1: ("example.com/de/", "block"), 2: (None, "allow"), 3: ("example.com/de/", "block"), 4: (None, "allow"), 5: ("net/", "block"), 6: ("net/", "block")}
    assert time.time() - began < 60


def test_hash_join_above_the_broadcast_bound(spark, monkeypatch):
    pages = queries._read(spark, "/root/testdata/sf0.001", "pages")
    rules = spark.createDataFrame(queries.URL_RULES, "host string, path string, verdict string")
    want = sorted(map(tuple, urlfilter.judge_urls(pages, rules).collect()), key=repr)
    monkeypatch.setattr(urlfilter, "BROADCAST_KEYS", 0)
    assert sorted(map(tuple, urlfilter.judge_urls(pages, rules).collect()), key=repr) == want


def test_repositories_decide(spark):
    """A value in three of an owner's repositories is not live."""
    key = "Zx9Kq2Lm7Pw4Rt6Yb3Nd"
    df = spark.createDataFrame([(1, key, "o", "o/a"), (2, key, "o", "o/b"), (3, "Bq8Rt5Yk1Mv7Xz3Cw9Hd", "o", "o/a")], "doc_id long, text string, source string, repository string")
    spans = lambda d: {r.doc_id: r.spans for r in secrets.secret_spans(d, "repository", "source", live_repositories=2).collect()}
    assert spans(df) == {1: "owned:0:20", 2: "owned:0:20", 3: "owned:0:20"}
    more = df.unionByName(df.where("doc_id = 1").withColumn("repository", F.lit("o/c")).withColumn("doc_id", F.lit(4).cast("long")))
    assert spans(more) == {1: "", 2: "", 3: "owned:0:20", 4: ""}
