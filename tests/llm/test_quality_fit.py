"""Operator 6 as a whole: features, ratios, descent, curve and scores anew in
plain Python, over the whole table."""

import math
import zlib

import numpy as np

from textloom.llm import nbsvm, queries
from textloom.llm._shared import PLACES, _BASE, _TABLE

SF = "/root/testdata/sf0.001"
MASK = 2**64 - 1
SEPARATORS = b" \t\n\x0b\x0c\r"


def mixed(x):
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & MASK
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & MASK
    return x ^ x >> 31


def word_hash(word):
    """Polynomial over the bytes, from the first."""
    total, power = 0, 1
    for b in word:
        total = (total + int(_TABLE[b]) * power) & MASK
        power = power * int(_BASE) & MASK
    return mixed((total + len(word)) & MASK)


def grams(hashes, width):
    return [mixed(sum(h * int(p) for h, p in zip(hashes[i : i + width], PLACES)) & MASK) for i in range(len(hashes) - width + 1)]


def shape_of(word):
    kinds = [chr(int(nbsvm._SHAPE[b])) for b in word]
    return bytes(ord(k) for i, k in enumerate(kinds) if i == 0 or kinds[i - 1] != k)


def features(raw):
    words, word = [], bytearray()
    for b in raw + b" ":
        if b in SEPARATORS:
            if word:
                words.append(bytes(word))
            word = bytearray()
        else:
            word.append(b)
    lows = [word_hash(w.lower()) for w in words]
    shapes = [word_hash(shape_of(w)) for w in words]
    shapes = [mixed((s + int(nbsvm._SAME)) & MASK) if i and lows[i] == lows[i - 1] else s for i, s in enumerate(shapes)]
    out = set()
    for k, found in enumerate((lows, grams(lows, 2), shapes, grams(shapes, 2), grams(shapes, 3)), 1):
        tag = k * 0x632BE59BD9B4E019 & MASK
        out |= {mixed((g + tag) & MASK) & (nbsvm.DIM - 1) for g in found}
    return sorted(out)


def descent(rows, ratio, y, cost=0.1):
    """Dual coordinate descent of the hinge loss, one multiplier a row."""
    w, bias, alpha = {}, 0.0, [0.0] * len(rows)
    order = np.random.Generator(np.random.PCG64(5))
    for _ in range(12):
        moved = 0.0
        for i in order.permutation(len(rows)).tolist():
            margin = bias + math.fsum(w.get(f, 0.0) * ratio(f) for f in rows[i])
            norm = 1 + math.fsum(ratio(f) ** 2 for f in rows[i])
            new = min(max(alpha[i] - (y[i] * margin - 1) / norm, 0.0), cost)
            step = (new - alpha[i]) * y[i]
            if step:
                for f in rows[i]:
                    w[f] = w.get(f, 0.0) + step * ratio(f)
                bias += step
                moved, alpha[i] = max(moved, abs(step)), new
        if moved < 1e-4 * cost:
            break
    return w, bias


def curve(margins, y):
    """Slope and shift of the likeliest logistic curve, by Newton's method."""
    up, down = sum(t > 0 for t in y), sum(t <= 0 for t in y)
    wanted = [(up + 1) / (up + 2) if t > 0 else 1 / (down + 2) for t in y]
    a, b = 1.0, 0.0
    for _ in range(50):
        p = [1 / (1 + math.exp(-min(max(a * m + b, -30), 30))) for m in margins]
        ga, gb = sum((x - t) * m for x, t, m in zip(p, wanted, margins)), sum(x - t for x, t in zip(p, wanted))
        q = [x * (1 - x) for x in p]
        haa, hab, hbb = sum(v * m * m for v, m in zip(q, margins)) + 1e-6, sum(v * m for v, m in zip(q, margins)), sum(q) + 1e-6
        det = haa * hbb - hab * hab
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        a, b = a - da, b - db
        if max(abs(da), abs(db)) < 1e-6:
            break
    return max(a, 1e-3), b


def test_whole_query_by_brute_force(spark):
    docs = {r.doc_id: (r.text or "") for r in queries._read(spark, SF, "documents").collect()}
    rest = lambda d: zlib.crc32(str(d).encode()) % 3
    labels = {r.doc_id: r.quality for r in queries._read(spark, SF, "labels").collect() if r.quality is not None and rest(r.doc_id) != 1}
    found = {d: features(t.encode()) for d, t in docs.items()}
    train = sorted((d for d in labels if d in docs), key=lambda d: mixed(d))
    assert 20 < len(train) < nbsvm.SAMPLE
    y = [1 if labels[d] else -1 for d in train]
    late = [i for i in range(len(train)) if i % 5 == 4]
    early = [i for i in range(len(train)) if i % 5 != 4]
    counts = {1: {}, -1: {}}
    for i in early:
        for f in found[train[i]]:
            counts[y[i]][f] = counts[y[i]].get(f, 0) + 1
    size = {t: sum(y[i] == t for i in early) for t in (1, -1)}
    share = lambda f, t: (counts[t].get(f, 0) + 1) / (size[t] + 2)
    ratio = lambda f: math.log(share(f, 1) / share(f, -1))
    w, bias = descent([found[train[i]] for i in early], ratio, [y[i] for i in early])
    margin = lambda d: bias + math.fsum(w[f] * ratio(f) for f in found[d] if f in w)
    slope, shift = curve([margin(train[i]) for i in late], [y[i] for i in late])

    got = queries.op6_quality_classifier(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        want = 1 / (1 + math.exp(-min(max(slope * margin(r.doc_id) + shift, -30), 30)))
        assert abs(r.score - want) < 1e-6, r.doc_id
        assert r.held_out == (rest(r.doc_id) == 1) and r.predicted == (r.score >= 0.5)
    held = [r for r in got if r.held_out]
    assert held and len({r.predicted for r in got}) == 2
