"""Quality rules: repetition and length, then divergence from a language.

The base rules count words, symbols, repeated lines and repeated five-word
windows of a text. The method compares the text's histogram of character
classes, and that of its common words, to references of each language by
Jensen-Shannon distance. How far a text may be depends on its length: the
limit of each octave of word counts is the outer fence of the distances that
the reference documents of that octave have. Texts under a minimum length are
not judged by distance.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import own, small_batches, text_batches, window_hashes, word_bounds, word_hashes

# Characters counted as symbols.
SYMBOLS = "#*$%&|<>"
# Function words of each language that has a reference.
COMMON = {
    "de": "auch auf aus das dem den der des die ein eine für ich im in ist mit nicht sich sie und von zu",
    "en": "a and as at be by for from in is it not of on or that the this to was with",
    "es": "a al como con de del el en es la las lo los no para por que se su un una y",
    "fr": "au avec ce dans de des du elle en est et il la le les pas pour que qui sur un une",
}
#: Classes of code points, by Unicode's general category.
CLASSES = 10
LOWER, UPPER, LETTER, MARK, DIGIT, BLANK, LINE, STOP, SYMBOL, OTHER = range(CLASSES)
_BY_CATEGORY = {"Ll": LOWER, "Lu": UPPER, "Lt": UPPER, "L": LETTER, "M": MARK, "N": DIGIT, "Z": BLANK, "P": STOP, "S": SYMBOL, "C": OTHER}
_BLANKS = b" \t\n\x0b\x0c\r"


def class_of(char: str) -> int:
    if char in "\n\u2028\u2029":
        return LINE
    if char in "\t\x0b\x0c\r":
        return BLANK
    if char in SYMBOLS:
        return SYMBOL
    category = unicodedata.category(char)
    return _BY_CATEGORY.get(category, _BY_CATEGORY[category[0]])


@lru_cache(maxsize=1)
def _class_table() -> np.ndarray:
    """Class of every code point."""
    return np.fromiter(map(class_of, map(chr, range(0x110000))), dtype=np.uint8, count=0x110000)


class Lexicon:
    """Hashes of the common words of all languages, and each one's columns."""

    def __init__(self, common: dict[str, str]):
        self.langs = sorted(common)
        self.words = sorted({w for ws in common.values() for w in ws.split()})
        data = np.frombuffer(" ".join(self.words).encode(), dtype=np.uint8)
        hashes = word_hashes(data, *word_bounds(data))
        self.order = np.argsort(hashes)
        self.sorted = hashes[self.order]
        self.columns = {lang: np.array([self.words.index(w) for w in common[lang].split()]) for lang in self.langs}

    def place(self, words: np.ndarray) -> np.ndarray:
        """Column of each hashed word; the one after the last for others."""
        if not self.words:
            return np.zeros(len(words), dtype=int)
        at = np.minimum(np.searchsorted(self.sorted, words), len(self.sorted) - 1)
        return np.where(self.sorted[at] == words, self.order[at], len(self.words))

    def histogram(self, seen: np.ndarray, lang: str) -> np.ndarray:
        """Counts of the language's words, and of all other words."""
        mine = seen[..., self.columns[lang]]
        return np.concatenate([mine, (seen.sum(axis=-1) - mine.sum(axis=-1))[..., None]], axis=-1)


def _counts(raws: list[bytes], lexicon: Lexicon):
    """(words, word characters, symbols, duplicate lines, repeated words,
    class counts, common-word counts) of each text."""
    flat = b"\n".join(raws) + b"\n"
    data = np.frombuffer(flat, dtype=np.uint8)
    sizes = np.array([len(r) + 1 for r in raws])
    stops = np.cumsum(sizes)
    starts, ends = word_bounds(data)
    words = word_hashes(data, starts, ends)
    windows = window_hashes(words, 5)
    upto = np.searchsorted(starts, stops, "left")
    lead = (data & 0xC0) != 0x80
    doc = np.repeat(np.arange(len(raws)), sizes)
    points = np.frombuffer(flat.decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    classes = np.bincount(doc[lead] * CLASSES + _class_table()[points], minlength=len(raws) * CLASSES).reshape(len(raws), CLASSES)
    classes[:, LINE] -= 1  # the break put after each text
    width = len(lexicon.words) + 1
    owner = np.repeat(np.arange(len(raws)), np.diff(np.concatenate([[0], upto])))
    seen = np.bincount(owner * width + lexicon.place(words), minlength=len(raws) * width).reshape(len(raws), -1)
    inner = np.add.reduceat(~lead, np.concatenate([[0], stops[:-1]])) if len(raws) else []
    first = 0
    for i, (raw, last) in enumerate(zip(raws, upto.tolist())):
        n = last - first
        repeated = 0
        if n > 5:
            mine = windows[first : last - 4]
            order = np.argsort(mine, kind="stable")
            same = mine[order][1:] == mine[order][:-1]
            if same.any():
                twice = np.zeros(len(mine) + 1, dtype=bool)
                twice[order[1:][same]] = True
                twice[order[:-1][same]] = True
                at = np.flatnonzero(twice)
                mark = np.zeros(n + 1, dtype=np.int32)
                np.add.at(mark, at, 1)
                np.add.at(mark, at + 5, -1)
                repeated = int((np.cumsum(mark[:n]) > 0).sum())
        lines = [x for x in raw.split(b"\n") if x.strip(_BLANKS)]
        chars = int((ends[first:last] - starts[first:last]).sum()) - int(inner[i])
        yield n, chars, len(raw) - len(raw.translate(None, SYMBOLS.encode())), len(lines) - len(set(lines)), repeated, classes[i], seen[i]
        first = last


def distances(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (base 2, 0 to 1) of histograms p and q."""
    p = p / np.maximum(p.sum(axis=-1, keepdims=True), 1e-300)
    q = q / np.maximum(q.sum(axis=-1, keepdims=True), 1e-300)
    m = (p + q) / 2

    def part(a):
        return np.where(a > 0, a * np.log2(np.where(a > 0, a, 1) / np.where(m > 0, m, 1)), 0).sum(axis=-1)

    return np.sqrt(np.maximum((part(p) + part(q)) / 2, 0))


def _failed(n: np.ndarray, repeated: np.ndarray) -> np.ndarray:
    return (n < 10) | (100 * repeated > 20 * n)


def _texts(documents: DataFrame) -> DataFrame:
    lang = own("lang").cast("string") if "lang" in documents.columns else F.lit(None).cast("string")
    return documents.select(own("text").cast("string").alias("text"), lang.alias("lang"))


def _model_rows(pdf: pd.DataFrame, lexicon: Lexicon):
    """(lang, counts) of the rows that references are made of: those of a
    known language that pass the base rules and have at most one symbol in ten
    words."""
    for first, raws in text_batches(pdf["text"].array):
        for lang, row in zip(pdf["lang"].iloc[first : first + len(raws)], _counts(raws, lexicon)):
            if lang in lexicon.columns and not _failed(np.array(row[0]), np.array(row[4])) and 10 * row[2] <= row[0]:
                yield lang, row


@dataclass
class References:
    """Histograms (classes, common words) by language, and the largest
    distance that is allowed in each octave of word counts."""

    histograms: dict[str, tuple[np.ndarray, np.ndarray]]
    fences: dict[int, float]

    def distances(self, classes: np.ndarray, seen: np.ndarray, lexicon: Lexicon) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Class distance, word distance (each to the nearest language) and
        the language of the latter, for rows of counts."""
        langs = sorted(self.histograms)
        by_class = np.stack([distances(classes.astype(float), self.histograms[k][0]) for k in langs], axis=1)
        by_word = np.stack([distances(lexicon.histogram(seen.astype(float), k), self.histograms[k][1]) for k in langs], axis=1)
        return by_class.min(axis=1), by_word.min(axis=1), np.array(langs, dtype=object)[by_word.argmin(axis=1)]

    def fence(self, octave: int) -> float:
        """Limit of an octave, or of the next shorter one that has a limit."""
        known = [k for k in self.fences if k <= octave]
        return self.fences[max(known)] if known else np.inf


def octave(words) -> np.ndarray:
    """How many times a word count can be halved."""
    return np.frexp(np.asarray(words, dtype=float))[1] - 1


#: Guards of the method. ``reach`` is that of an outer fence: quartile plus
#: three times the distance between the quartiles. An octave of fewer than
#: ``least_references`` documents takes the limit of the next shorter one.
LIMITS = {"least_chars": 200, "least_words": 32, "reach": 3.0, "least_references": 20}
#: Distances are counted in bins of this width.
BIN = 1 / 1024


def references(documents: DataFrame, lexicon: Lexicon | None = None, limits: dict | None = None) -> References:
    """References of all documents: sums of counts in one pass, the fences of
    the distances to these in a second one, both combined per task before the
    shuffle. The driver gets one row per language and bin, and one per octave
    and bin of distance."""
    lexicon, bound = lexicon or Lexicon(COMMON), LIMITS | (limits or {})
    texts = _texts(documents)

    def add_up(batches):
        total: dict[str, np.ndarray] = {}
        for pdf in batches:
            for lang, row in _model_rows(pdf, lexicon):
                add = np.concatenate([row[5], row[6]])
                total[lang] = total[lang] + add if lang in total else add
        yield pd.DataFrame([(k, i, int(x)) for k, v in total.items() for i, x in enumerate(v)], columns=["lang", "i", "x"])

    sums: dict[str, np.ndarray] = {}
    for name, i, x in texts.mapInPandas(add_up, "lang string, i int, x long").groupBy("lang", "i").agg(F.sum("x").alias("x")).collect():
        sums.setdefault(name, np.zeros(CLASSES + len(lexicon.words) + 1))[i] = x
    out = References({k: (v[:CLASSES], lexicon.histogram(v[CLASSES:], k)) for k, v in sums.items()}, {})
    if not sums:
        return out

    def count(batches):
        total: dict[tuple[int, int], int] = {}
        for pdf in batches:
            rows = [r for _, r in _model_rows(pdf, lexicon) if r[0] >= bound["least_words"] and r[1] >= bound["least_chars"]]
            if rows:
                a, b, _ = out.distances(np.array([r[5] for r in rows]), np.array([r[6] for r in rows]), lexicon)
                bins = np.ceil(np.hypot(a, b) / BIN).astype(int)
                for key in zip(octave([r[0] for r in rows]).tolist(), bins.tolist()):
                    total[key] = total.get(key, 0) + 1
        yield pd.DataFrame([(*k, n) for k, n in total.items()], columns=["octave", "bin", "n"])

    bins = texts.mapInPandas(count, "octave int, bin int, n long").groupBy("octave", "bin").agg(F.sum("n").alias("n")).toPandas()
    for o, part in bins.groupby("octave"):
        part = part.sort_values("bin")
        upto, at = part["n"].cumsum().to_numpy(), part["bin"].to_numpy() * BIN
        if upto[-1] >= bound["least_references"]:
            low, high = (float(at[np.searchsorted(upto, q * upto[-1])]) for q in (0.25, 0.75))
            out.fences[int(o)] = high + bound["reach"] * (high - low)
    return out


RESULT = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "class_distance double, word_distance double, nearest string, kept boolean"
)
_NAMES = [x.split()[0] for x in RESULT.split(", ")]


def quality(documents: DataFrame, limits: dict | None = None, into: str = "quality", refs: References | None = None, common: dict[str, str] | None = None) -> DataFrame:
    """``documents`` with a struct column ``into``: counts and verdict.

    Reads ``text`` and ``lang`` (may be absent). A text passes if no base rule
    fails and, where it has ``least_chars`` word characters and
    ``least_words`` words, its distance - the root of the summed squares of
    its class and its word distance, each to the nearest reference - is not
    above the fence of its octave of word counts. The nearest of all
    references counts, so a null or confused lang does no harm. ``common``
    lists the common words by language; texts of a lang without a reference
    get no distances, since nothing is known about their language.

    Null and empty texts have no words, so the base rules fail them. Very long
    texts are processed whole. Repeated rows are judged alike and count each
    in the references; of languages that tie, the first by name is nearest;
    a distance at the fence passes. An input column named ``into`` is
    replaced, others keep their values. Without a reference (an empty table,
    unknown languages) only the base rules judge.
    """
    small_batches(documents.sparkSession)
    bound, lexicon = LIMITS | (limits or {}), Lexicon(COMMON if common is None else common)
    refs = references(documents, lexicon, limits) if refs is None else refs
    langs = sorted(refs.histograms)

    @F.pandas_udf(RESULT)
    def judge(texts: pd.Series, known: pd.Series) -> pd.DataFrame:
        parts = []
        for first, raws in text_batches(texts.array):
            rows = list(_counts(raws, lexicon))
            base = np.array([r[:5] for r in rows], dtype=np.int64)
            failed = _failed(base[:, 0], base[:, 4])
            near_class = np.full(len(rows), np.nan)
            near_word, nearest, bad = near_class.copy(), np.full(len(rows), None, dtype=object), np.zeros(len(rows), dtype=bool)
            long = np.flatnonzero((base[:, 1] >= bound["least_chars"]) & (base[:, 0] >= bound["least_words"]) & known.iloc[first : first + len(raws)].to_numpy(dtype=bool))
            if len(langs) and len(long):
                near_class[long], near_word[long], nearest[long] = refs.distances(np.array([rows[i][5] for i in long]), np.array([rows[i][6] for i in long]), lexicon)
                fence = np.array([refs.fence(o) for o in octave(base[long, 0]).tolist()])
                bad[long] = np.hypot(near_class[long], near_word[long]) > fence
            parts.append(pd.DataFrame({**{k: base[:, i] for i, k in enumerate(_NAMES[:5])}, "base_failed": failed, "class_distance": near_class, "word_distance": near_word, "nearest": nearest, "kept": ~failed & ~bad}))
        return pd.concat(parts, ignore_index=True) if parts else pd.DataFrame(columns=_NAMES)

    return documents.withColumn(into, judge.asNondeterministic()(own("text").cast("string"), _known(documents, langs)))


def _known(documents: DataFrame, langs: list[str]) -> Column:
    lang = own("lang").cast("string") if "lang" in documents.columns else F.lit(None).cast("string")
    return F.coalesce(lang.isin(langs), F.lit(True))
