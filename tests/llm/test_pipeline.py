"""The corpus pipeline against its stages by brute force."""

import random
import re
from collections import Counter

import pytest

import corpus_pipeline
from textloom.llm import queries

from .test_dedup_and_leaks import brute_base, brute_components, brute_leaks
from .test_text_and_archives import brute_counts

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_stages(spark, tmp_path, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    items = spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()
    kept = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r for r in docs.collect()}
        stage(spark, docs, sf).write.parquet(out := str(tmp_path / f"{k}"))
        docs = spark.read.parquet(out)
        rows = docs.collect()
        after = {r.doc_id: r for r in rows}
        assert len(before) > len(after) or name in ("pii", "mixing", "decontamination")
        if name != "mixing":
            assert docs.columns == COLUMNS and len(rows) == len(after)
        if name == "quality_rules":
            failed = {i for i, r in before.items() if brute_base(r.text)[5]}
            assert not failed & set(after)
            labels = {r.doc_id: r.quality for r in queries._read(spark, sf, "labels").collect()}
            clean = [i in after for i in before if labels.get(i) == 1 and i not in failed]
            assert sum(clean) >= 0.98 * len(clean)
        elif name == "near_dedup":
            comps = brute_components([(i, r.text) for i, r in before.items()])
            assert set(after) == {i for i, (_, c) in comps.items() if c == i}
        elif name == "decontamination":
            hit = {r[0] for r in brute_leaks([(i, r.text) for i, r in before.items()], items) if r[5]}
            assert set(after) == set(before) - hit
        elif name == "pii":
            assert set(after) == set(before)
            private = r"[\w.]+@[\w.]+\.com|\+1 \(\d{3}\) \d{3}-\d{4}|(?<!\w)\d{16}(?!\w)"
            for i, r in after.items():
                old = re.findall(private, before[i].text)
                assert not [m for m in old if m in r.text] and r.n_chars == len(r.text)
                assert old or re.search(r"\d+\.\d+\.\d+\.\d+", before[i].text) or r.text == before[i].text
        else:
            n = {}
            for r in before.values():
                n[r.source] = n.get(r.source, 0) + 1
            total = sum(x**0.5 for x in n.values())
            rate = {s: x**0.5 / total * len(before) / x for s, x in n.items()}
            want = {i: c for (i, _), c in brute_counts([tuple(r[c] for c in COLUMNS) for r in before.values()], rate).items() if c}
            got = {}
            for r in rows:
                got[r.doc_id] = got.get(r.doc_id, 0) + 1
            assert got == want
        kept = rows
    last = sorted((r.doc_id, r.text) for r in corpus_pipeline.run(spark, sf).collect())
    assert last == sorted((r.doc_id, r.text) for r in kept)


INTERNAL = ["verdict", "leak", "found", "rid", "moved", "hit", "maybe", "key", "again", "digest", "component", "first", "hashed", "source_key", "cdf", "occurrence", "block", "order", "n", "id", "_quality", "_leak", "_pii", "_order", "_text", "a.b"]


def test_internal_names_as_input_columns(spark, tmp_path):
    """Columns named like the operators' own come through with their values."""
    sf = str(tmp_path)
    names = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in INTERNAL)
    rng = random.Random(4)
    texts = [" ".join(f"w{rng.randrange(900)}" for _ in range(40)) for _ in range(30)]
    texts += texts[:3] + [None, "", "mail a.b@c.de " + texts[4], texts[5] + " one two three four five six seven eight nine ten"]
    rows = [(i, t, "en", f"s{i % 2}", len(t or ""), *(f"{c}-{i}" for c in INTERNAL)) for i, t in enumerate(texts)]
    rows += [(7, texts[8], "en", "s1", 3, *(f"{c}-x" for c in INTERNAL)), (None, texts[9], None, None, None, *(None for _ in INTERNAL))]
    spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    for n, data in enumerate((rows, [])):
        docs = spark.createDataFrame(data, names)
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            before = Counter(docs.select(*[f"`{c}`" for c in ["doc_id", *INTERNAL]]).collect())
            stage(spark, docs, sf).write.parquet(f"{sf}/{n}-{k}")
            docs = spark.read.parquet(f"{sf}/{n}-{k}")
            after = Counter(docs.select(*[f"`{c}`" for c in ["doc_id", *INTERNAL]]).collect())
            assert set(after) <= set(before) and (name == "mixing" or not after - before)
            if data:
                assert len(after) >= 12
            if name != "mixing":
                assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", *INTERNAL]
        assert bool(data) == (docs.count() > 0)


def test_scratch_goes_with_each_stage(spark, monkeypatch):
    from pathlib import Path

    from textloom.llm import _shared

    root = Path(_shared.shared_dir(spark).removeprefix("file://"))
    before = set(root.iterdir())
    corpus_pipeline.run(spark, "/root/testdata/sf0.001").count()
    left = {p.name.rsplit("-", 1)[0] for p in set(root.iterdir()) - before}
    assert "stage-pii" in left and not left & {"stage-quality_rules", "minhash", "classes", "found", "texts"}
