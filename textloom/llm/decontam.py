"""Benchmark decontamination with one Aho-Corasick automaton.

Every window of ten consecutive words of a normalised test item (or the whole
item, if it is shorter) is a pattern. A document is normalised the same way,
scanned once, and the hits are mapped back to word numbers and to code-point
offsets of the original text.

A benchmark too large for one automaton is dealt to shards of bounded size.
Then the windows of a document first probe a Bloom filter of all windows, an
exact join on their hashes names the shards that can hit it, and only these
shards' automata scan it, one automaton in memory at a time.
"""

from __future__ import annotations

import re
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bloom
from ._shared import discard, free_names, materialise, open_shared, own, scratch_folder, small_batches, text_batches, window_hashes, word_bounds, word_hashes

WINDOW = 10
#: Bytes of benchmark text that one automaton may hold: some 400 MB at worst,
#: since each word starts a pattern of ten words.
MOST_BYTES = 1 << 20

#: Bytes that stay as word characters; A-Z are lower-cased, the rest separate.
_TO = bytearray(b" " * 256)
for _c in [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]:
    _TO[_c] = _c
for _c in range(0x41, 0x5B):
    _TO[_c] = _c + 32
_TO = bytes(_TO)
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

RESULT = "n_words long, n_hit long, items array<string>, first array<long>, last array<long>, start array<long>, end array<long>"


def normal_words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TO).split()


def _padded(words: list[bytes]) -> str:
    return (b" " + b" ".join(words) + b" ").decode("utf-8", "surrogatepass")


def automaton(items, window: int):
    """Aho-Corasick automaton over the windows of (item_id, text) rows, or
    None if no item has a word. A value is (words in it, item ids)."""
    import ahocorasick

    owners: dict[str, tuple[int, set[str]]] = {}
    for item, text in items:
        words = normal_words(text)
        width = min(window, len(words))
        for i in range(len(words) - width + 1 if words else 0):
            owners.setdefault(_padded(words[i : i + width]), (width, set()))[1].add(item)
    if not owners:
        return None
    machine = ahocorasick.Automaton()
    for pattern, (width, ids) in owners.items():
        machine.add_word(pattern, (width, frozenset(ids)))
    machine.make_automaton()
    return machine


#: The one automaton that a worker holds, by name.
_HELD: dict[str, object] = {}


def _held(name: str, items, window: int):
    if name not in _HELD:
        _HELD.clear()
        _HELD[name] = automaton(items(), window)
    return _HELD[name]


def _runs(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1


def _described(text: str, n: int, hit: np.ndarray, items: set[int]) -> tuple:
    first, last = _runs(hit)
    spans = [m.span() for m in _WORD.finditer(text)]
    ids = sorted(items)
    return n, int(hit.sum()), ids, first.tolist(), last.tolist(), [spans[i][0] for i in first], [spans[i][1] for i in last]


def scan_text(text: str | None, machine) -> tuple:
    """One row of RESULT for a text; null counts as empty."""
    words = normal_words(text) if text else []
    n = len(words)
    if not n or machine is None:
        return n, 0, [], [], [], [], []
    flat = _padded(words)
    hit, items, gaps = None, set(), None
    for at, (width, ids) in machine.iter(flat):
        if hit is None:
            hit = np.zeros(n, dtype=bool)
            gaps = np.flatnonzero(np.frombuffer(flat.encode("utf-32-le", "surrogatepass"), dtype=np.uint32) == 32)
        end = int(np.searchsorted(gaps, at))
        hit[end - width : end] = True
        items |= ids
    if hit is None:
        return n, 0, [], [], [], [], []
    return _described(text, n, hit, items)


_NAMES = [x.split()[0] for x in RESULT.split(", ")]


def _scanner(shared, window: int):
    name = uuid.uuid4().hex

    @F.pandas_udf(RESULT)
    def scan(texts: pd.Series) -> pd.DataFrame:
        machine = _held(name, lambda: shared.value, window)
        return pd.DataFrame([scan_text(t, machine) for t in texts], columns=_NAMES)

    return scan.asNondeterministic()


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, into: str = "contamination", most_bytes: int = MOST_BYTES) -> DataFrame:
    """``documents`` with a struct column ``into`` of what was found.

    Reads ``documents.text`` and ``benchmark.item_id, text``. The struct has
    n_words, n_hit, items (ids as strings, sorted), the maximal runs of hit
    words (first, last: word numbers from 0) and their code-point offsets in
    the original text (start, end exclusive). An input column named ``into``
    is replaced; all others keep their values, whatever their names.

    A benchmark of at most ``most_bytes`` is broadcast. A larger one is cut
    into pieces that overlap by a window less one word, and these are dealt to
    shards; the hits of all shards are merged, so the result is the same.

    Null and empty texts and items have no words, an item without words has no
    window, items whose item_id is null are ignored, repeated items count
    once, and items of one id are one item. Very long texts and items are used
    whole. Repeated rows are judged alike. Where windows of several items tie
    on the same words, all these items are listed. An empty benchmark hits
    nothing; empty documents give no rows.
    """
    spark = documents.sparkSession
    small_batches(spark)
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text")).where("item_id is not null and text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    text = own("text").cast("string")
    if size <= most_bytes:
        shared = spark.sparkContext.broadcast(tuple((r[0], r[1]) for r in items.collect()))
        return documents.withColumn(into, _scanner(shared, window)(text))
    rid, hit_ = free_names(documents, "rid", "hit")
    docs = materialise(documents.withColumn(rid, F.monotonically_increasing_id()), "numbered")
    texts = docs.select(own(rid).alias("rid"), text.alias("text"))
    found = _by_shards(texts, items, window, most_bytes, -(-size // most_bytes))
    none = _scanner(spark.sparkContext.broadcast(()), window)
    # Texts that no window hits are not moved; only their words are counted.
    hit = found.select(own("rid").alias(rid), F.col("found").alias(hit_))
    parted = docs.drop(into).join(hit, rid, "left")
    return parted.withColumn(into, F.coalesce(own(hit_), none(text))).drop(hit_, rid)


def _pieces(window: int, most_bytes: int, shards: int):
    """Items cut at words into pieces of at most an eighth of a shard."""

    def run(batches):
        for pdf in batches:
            for item, text in zip(pdf["item_id"], pdf["text"]):
                words, first, out = normal_words(text), 0, []
                while first == 0 or first + window - 1 < len(words):
                    last, held = first, 0
                    while last < len(words) and (held < most_bytes // 8 or last - first < window):
                        held += len(words[last]) + 1
                        last += 1
                    out.append(b" ".join(words[first:last]).decode("utf-8", "surrogatepass"))
                    if last >= len(words):
                        break
                    first = last - window + 1
                yield pd.DataFrame({"item_id": item, "text": out})

    return run


def _hashed(raws: list[bytes], widths):
    """(text number, hash) arrays of the windows of the given widths."""
    flat = np.frombuffer(b"\n".join(r.translate(_TO) for r in raws), dtype=np.uint8)
    starts, ends = word_bounds(flat)
    words = word_hashes(flat, starts, ends)
    stops = np.searchsorted(starts, np.cumsum([len(r) + 1 for r in raws]), "left")
    owner = np.repeat(np.arange(len(raws)), np.diff(np.concatenate([[0], stops])))
    for width in widths:
        n = len(words) - width + 1
        if n > 0:
            inside = owner[:n] == owner[width - 1 :]
            yield width, owner[:n][inside], window_hashes(words, width)[inside].view(np.int64)


def _windows_of(window: int):
    """(hash, width, shard) of the windows of pieces: those of ``window``
    words, or the whole of a shorter piece."""

    def run(batches):
        for pdf in batches:
            for first, raws in text_batches(pdf["text"].array):
                n = np.array([len(r.split()) for r in raws])
                shard = pdf["shard"].iloc[first : first + len(raws)].to_numpy()
                for width, row, h in _hashed(raws, range(1, window + 1)):
                    whole = (n[row] == width) | (width == window)
                    yield pd.DataFrame({"hash": h[whole], "width": width, "shard": shard[row[whole]]})

    return run


def _maybe_hit(words, widths):
    def run(batches):
        for pdf in batches:
            for first, raws in text_batches(pdf["text"].array):
                rid = pdf["rid"].iloc[first : first + len(raws)].to_numpy()
                for _, row, h in _hashed(raws, widths):
                    may = bloom.probe(words.value, h)
                    if may.any():
                        yield pd.DataFrame({"rid": rid[row[may]], "hash": h[may]}).drop_duplicates()

    return run


def _scan_shards(folder: str, window: int):
    """Scan rows (shard, rid, text), sorted by shard, by their shard."""

    def items(shard):
        import pyarrow.parquet as pq

        with open_shared(f"{folder}/{shard}.parquet", "rb") as stream:
            table = pq.read_table(stream).to_pydict()
        return list(zip(table["item_id"], table["text"]))

    def run(batches):
        for pdf in batches:
            for shard, part in pdf.groupby("shard", sort=True):
                machine = _held(f"{folder}/{shard}", lambda s=shard: items(s), window)
                rows = pd.DataFrame([scan_text(t, machine) for t in part["text"]], columns=_NAMES)
                rows["rid"] = part["rid"].to_numpy()
                yield rows.loc[rows["n_hit"] > 0, ["rid", "n_words", "items", "first", "last"]]

    return run


def _save_shards(folder: str):
    """Write each shard's pieces as one file; a file is complete or absent."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        import io

        held = io.BytesIO()
        pdf[["item_id", "text"]].to_parquet(held, index=False)
        with open_shared(f"{folder}/{int(pdf['shard'].iat[0])}.parquet", "wb") as out:
            out.write(held.getvalue())
        return pd.DataFrame({"shard": [int(pdf["shard"].iat[0])]})

    return run


def _by_shards(texts: DataFrame, items: DataFrame, window: int, most_bytes: int, shards: int) -> DataFrame:
    """(rid, found) of the texts (rid, text) that a window hits."""
    spark = texts.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pieces = items.mapInPandas(_pieces(window, most_bytes, shards), "item_id string, text string").where("text <> ''")
    pieces = materialise(pieces.withColumn("shard", F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)).cast("int")), "pieces")
    folder = scratch_folder(spark, "shards")
    pieces.groupBy("shard").applyInPandas(_save_shards(folder), "shard int").count()
    windows = materialise(pieces.mapInPandas(_windows_of(window), "hash long, width int, shard int").distinct(), "windows")
    widths = sorted(r[0] for r in windows.select("width").distinct().collect())
    words = spark.sparkContext.broadcast(bloom.build(windows, F.col("hash"), bloom.blocks_for(windows.count())))
    asked = texts.mapInPandas(_maybe_hit(words, widths), "rid long, hash long")
    pairs = materialise(asked.join(windows.select("hash", "shard").hint("merge"), "hash").select("rid", "shard").distinct(), "pairs")
    # A row goes once to each shard that may hit it; a popular shard is dealt
    # over many tasks by the row number.
    dealt = texts.join(pairs.hint("merge"), "rid").repartition(parts, "shard", F.pmod(F.xxhash64("rid"), F.lit(parts))).sortWithinPartitions("shard")
    partial = materialise(dealt.mapInPandas(_scan_shards(folder, window), "rid long, n_words long, items array<string>, first array<long>, last array<long>"), "partial")
    several = partial.groupBy("rid").agg(F.collect_list(F.struct("n_words", "items", "first", "last")).alias("parts"))

    @F.pandas_udf(RESULT)
    def merge(rows: pd.Series, found: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_merged(t, p) for t, p in zip(rows, found)], columns=_NAMES)

    out = texts.join(several.hint("merge"), "rid").select("rid", merge.asNondeterministic()("text", "parts").alias("found"))
    out = materialise(out, "found")
    discard(pieces, windows, pairs, partial)
    return out


def _merged(text: str, parts) -> tuple:
    n = int(parts[0]["n_words"])
    hit, items = np.zeros(n, dtype=bool), set()
    for p in parts:
        for a, b in zip(p["first"], p["last"]):
            hit[a : b + 1] = True
        items |= set(p["items"])
    return _described(text, n, hit, items)
