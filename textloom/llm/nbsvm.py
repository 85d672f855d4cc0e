"""Quality classifier: naive Bayes features under a linear support vector machine.

Indicators of word and shape n-grams are scaled by the log ratio of their
smoothed class counts; a hinge-loss model on them is fitted by dual coordinate
descent on the driver, from a bounded sample of labelled rows. All rows are
scored on the executors.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import ASCII_LOWER, discard, materialise, mix64, small_batches, text_batches, window_hashes, word_bounds, word_hashes

#: Hashed n-grams; the last weight is the bias.
DIM = 1 << 18
#: Labelled rows that a fit uses at most, those of the smallest hashes, and
#: feature numbers that they may have in all.
SAMPLE = 6000
SAMPLE_FEATURES = 64 << 20

_LOWER = np.frombuffer(ASCII_LOWER, dtype=np.uint8)


def _shapes() -> np.ndarray:
    """Class of each byte, for word shapes; continuation bytes repeat the
    class of letters, so a letter of two bytes is one run."""
    t = np.full(256, ord("a"), dtype=np.uint8)
    t[:128] = ord("?")
    t[ord("a") : ord("z") + 1] = ord("a")
    t[ord("A") : ord("Z") + 1] = ord("A")
    t[ord("0") : ord("9") + 1] = ord("0")
    for c in "#*$%&|<>~^=+_\\/{}[]@":
        t[ord(c)] = ord("#")
    for c in ".,;:'\"()-":
        t[ord(c)] = ord(".")
    t[ord("!")] = ord("!")
    return t


_SHAPE = _shapes()
_SAME = np.uint64(0x51ED270B9F1C8D2B)


def features(raws: list[bytes]):
    """Sorted distinct feature numbers of each text.

    Words and pairs of words, lower-cased; shapes of words (runs of equal
    character classes), marked where a word repeats the one before, and their
    pairs and triples.
    """
    data = np.frombuffer(b"\n".join(raws) + b"\n", dtype=np.uint8)
    starts, ends = word_bounds(data)
    words = word_hashes(_LOWER[data], starts, ends)
    shape = _SHAPE[data]
    fresh = np.ones(len(data), dtype=bool)
    fresh[1:] = shape[1:] != shape[:-1]
    fresh[starts] = True
    upto = np.concatenate([[0], np.cumsum(fresh)])
    # Runs inside words only: bytes between words are dropped by the bounds.
    shapes = word_hashes(shape[fresh], upto[starts], upto[ends])
    same = np.zeros(len(words), dtype=bool)
    same[1:] = words[1:] == words[:-1]
    shapes = np.where(same, mix64(shapes + _SAME), shapes)
    stops = np.searchsorted(starts, np.cumsum([len(r) + 1 for r in raws]), "left")
    grams = [words, window_hashes(words, 2), shapes, window_hashes(shapes, 2), window_hashes(shapes, 3)]
    tags = np.arange(1, 6, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019)
    grams = [(mix64(g + t) & np.uint64(DIM - 1)).astype(np.int32) for g, t in zip(grams, tags)]
    first = 0
    for last in stops.tolist():
        n = last - first
        own = [g[first : first + max(0, n - w + 1)] for g, w in zip(grams, (1, 2, 1, 2, 3))]
        yield np.unique(np.concatenate(own))
        first = last


@dataclass
class Model:
    """score = 1 / (1 + exp(-(slope * margin + shift)))."""

    weights: np.ndarray
    slope: float
    shift: float

    def margin(self, index: np.ndarray) -> float:
        return float(self.weights[index].sum() + self.weights[DIM])

    def score(self, index: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(index) + self.shift, -30, 30))))


def log_ratios(rows: list[np.ndarray], y: np.ndarray, smooth: float = 1.0) -> np.ndarray:
    """Log ratio of the smoothed shares of each feature in both classes."""
    counts = []
    for label in (1, -1):
        mine = [r for r, t in zip(rows, y) if t == label]
        c = np.bincount(np.concatenate(mine), minlength=DIM).astype(float) if mine else np.zeros(DIM)
        counts.append((c + smooth) / (len(mine) + 2 * smooth))
    return np.log(counts[0] / counts[1])


def dual_descent(rows: list[np.ndarray], scale: np.ndarray, y: np.ndarray, cost: float = 0.1, rounds: int = 12, seed: int = 5) -> np.ndarray:
    """Weights of the L2-regularised hinge-loss model, by coordinate descent
    in the dual: one multiplier in [0, cost] for each row."""
    w, alpha = np.zeros(DIM + 1), np.zeros(len(rows))
    values = [scale[r] for r in rows]
    norm = np.array([float(v @ v) + 1 for v in values])
    order = np.random.Generator(np.random.PCG64(seed))
    for _ in range(rounds):
        moved = 0.0
        for i in order.permutation(len(rows)):
            r, v = rows[i], values[i]
            slope = y[i] * (float(w[r] @ v) + w[DIM]) - 1
            new = min(max(alpha[i] - slope / norm[i], 0.0), cost)
            step = (new - alpha[i]) * y[i]
            if step:
                w[r] += step * v
                w[DIM] += step
                moved = max(moved, abs(step))
                alpha[i] = new
        if moved < 1e-4 * cost:
            break
    return w


def _platt(margins: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and shift of the logistic curve through the margins."""
    up, down = (y > 0).sum(), (y <= 0).sum()
    target = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
    a, b = 1.0, 0.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        g = np.array([((p - target) * margins).sum(), (p - target).sum()])
        q = p * (1 - p)
        h = np.array([[(q * margins**2).sum(), (q * margins).sum()], [(q * margins).sum(), q.sum()]]) + 1e-6 * np.eye(2)
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return max(float(a), 1e-3), float(b)


def fit_rows(rows: list[np.ndarray], labels: np.ndarray) -> Model:
    """Model of feature rows with labels 0 and 1. Every fifth row is kept for
    the curve; with one class only, the score is its smoothed share."""
    y = np.where(labels > 0, 1, -1)
    share = (float((y > 0).sum()) + 1) / (len(y) + 2)
    if len(set(y.tolist())) < 2:
        return Model(np.zeros(DIM + 1), 1.0, float(np.log(share / (1 - share))))
    late = np.arange(len(y)) % 5 == 4
    if len(set(y[late].tolist())) < 2 or len(set(y[~late].tolist())) < 2:
        late[:] = False
    early = [r for r, x in zip(rows, late) if not x]
    ratio = log_ratios(early, y[~late])
    w = dual_descent(early, ratio, y[~late])
    weights = np.append(w[:DIM] * ratio, w[DIM])
    held = [i for i in range(len(y)) if late[i]] or list(range(len(y)))
    margins = np.array([weights[rows[i]].sum() + weights[DIM] for i in held])
    return Model(weights, *_platt(margins, y[held]))


def training_rows(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE, sample_features: int = SAMPLE_FEATURES) -> tuple[list[np.ndarray], np.ndarray]:
    """Features and labels of at most ``sample`` labelled documents that have
    at most ``sample_features`` feature numbers (of four bytes) in all; the
    rows of the smallest hashes are taken. Of an id with several texts, the
    one of the smallest digest is taken."""
    known = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").alias("quality"))
    known = known.where(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) != 1)
    # At most ``sample`` rows of two numbers, so the broadcast is bounded.
    chosen = F.broadcast(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))

    def run(batches):
        for pdf in batches:
            for first, raws in text_batches(pdf["text"].array):
                part = pdf.iloc[first : first + len(raws)]
                found = list(features(raws))
                digests = [hashlib.blake2b(raw, digest_size=16).hexdigest() for raw in raws]
                yield pd.DataFrame({"doc_id": part["doc_id"], "quality": part["quality"], "digest": digests, "n": [len(r) for r in found], "f": [r.tobytes() for r in found]})

    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(chosen, "doc_id")
    rows = materialise(docs.mapInPandas(run, "doc_id long, quality int, digest string, n long, f binary"), "features")
    # In an order of no meaning that is the same each time.
    sizes = rows.groupBy("doc_id").agg(F.min_by("n", "digest").alias("n"), F.min("digest").alias("digest")).toPandas()
    sizes = sizes.iloc[np.argsort(mix64(sizes["doc_id"].to_numpy(dtype=np.int64).view(np.uint64)), kind="stable")].reset_index(drop=True)
    sizes = sizes[sizes["n"].cumsum() <= sample_features]
    spark = documents.sparkSession
    taken = F.broadcast(spark.createDataFrame(sizes[["doc_id", "digest"]], "doc_id long, digest string"))
    out: dict[int, tuple[bytes, int]] = {}
    for doc, quality, f in rows.join(taken, ["doc_id", "digest"]).select("doc_id", "quality", "f").toLocalIterator():
        out[doc] = (bytes(f), quality)
    discard(rows)
    held = [out[doc] for doc in sizes["doc_id"].tolist()]
    return [np.frombuffer(f, dtype=np.int32) for f, _ in held], np.array([q for _, q in held], dtype=int)


def fit(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Model from ``labels`` (doc_id, quality) whose crc32(doc_id) mod 3 is
    not 1. ``sample`` bounds the rows used and SAMPLE_FEATURES their bytes,
    hence the driver's memory."""
    small_batches(documents.sparkSession)
    return fit_rows(*training_rows(documents, labels, sample))


def score(documents: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; only the text is
    read for the score. Null and empty texts have the score of no features,
    very long texts that of all their distinct features. Repeated rows are
    scored alike, each by its own text. A null doc_id is not held out. A score
    of just 0.5 predicts 1. Other columns are ignored, whatever their names.
    An empty table gives no rows."""
    small_batches(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def rate(texts: pd.Series) -> pd.Series:
        m = shared.value
        return pd.Series([m.score(r) for _, raws in text_batches(texts.array) for r in features(raws)], dtype=float)

    rest = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3))
    out = documents.select("doc_id", F.coalesce(rest == 1, F.lit(False)).alias("held_out"), rate.asNondeterministic()(F.col("text").cast("string")).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
