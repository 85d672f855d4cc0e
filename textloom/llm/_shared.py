"""Shared-folder scratch tables and the byte-level word hashing kernel."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import ensure_on_executors

_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder that the driver and all executors see.

    It is ``spark.checkpoint.dir`` of the session. Where that is unset, a
    local master gets a temporary folder of its own (tests); any other master
    is refused, since no folder is known that all its machines share.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not (spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="textloom-")
        atexit.register(shutil.rmtree, _LOCAL[app], ignore_errors=True)
    return "file://" + _LOCAL[app]


#: Scratch paths written since each open ``scratch_scope`` began.
_SCOPES: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder. What is written there goes with the
    enclosing ``scratch_scope``, else at the end of the application."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    for scope in _SCOPES:
        scope.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession):
    """Delete, on leaving, all scratch tables written inside but the paths
    that the body puts in the set it is given."""
    written: list[str] = []
    keep: set[str] = set()
    _SCOPES.append(written)
    try:
        yield keep
    finally:
        _SCOPES.remove(written)
        for path in written:
            if path not in keep:
                remove_path(spark, path)


def _until_exit(spark: SparkSession, path: str) -> None:
    """Let the driver's file system delete an existing path when it closes."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """An empty folder that lives as long as a scratch table."""
    path = scratch_path(spark, name)
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(where)
    _until_exit(spark, path)
    return path


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder and read it again.

    Unlike a cached block, the table survives the loss of an executor.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    _until_exit(spark, path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def remove_path(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def discard(*tables: DataFrame) -> None:
    """Delete scratch tables that no lazy result reads any more."""
    for t in tables:
        path = getattr(t, "_scratch", None)
        if path:
            remove_path(t.sparkSession, path)


def free_names(df: DataFrame, *stems: str) -> list[str]:
    """For each stem a column name that ``df`` does not have in any case."""
    used, out = {c.lower() for c in df.columns}, []
    for stem in stems:
        name, n = stem, 0
        while name.lower() in used:
            n += 1
            name = f"{stem}_{n}"
        used.add(name.lower())
        out.append(name)
    return out


def own(name: str) -> Column:
    """The top-level column of this name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def own_columns(df: DataFrame) -> list[Column]:
    return [own(c) for c in df.columns]


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Hand Python workers at most ``rows`` rows at once from now on.

    Rows hold whole texts here, so the default of 10,000 rows would size a
    worker's memory by the longest texts. A smaller setting is kept. The
    package itself is sent along, in case executors do not have it.
    """
    ensure_on_executors(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def open_shared(url: str, mode: str):
    """Binary stream of a file in a shared folder, local or not."""
    if url.startswith("file:"):
        path = "/" + url.split(":", 1)[1].lstrip("/")
        if "w" in mode:
            os.makedirs(os.path.dirname(path), exist_ok=True)
        return open(path, mode)
    if "://" not in url:
        if "w" in mode:
            os.makedirs(os.path.dirname(url), exist_ok=True)
        return open(url, mode)
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(url)
    if "w" in mode:
        store.create_dir(path.rsplit("/", 1)[0], recursive=True)
        return store.open_output_stream(path)
    return store.open_input_stream(path)


# --- word hashing -----------------------------------------------------------

#: Bytes that separate words: space and \t \n \v \f \r.
SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True

_RNG = np.random.Generator(np.random.PCG64(20240917))
_TABLE = _RNG.integers(0, 2**64, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_POWERS = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]
#: Odd multipliers that give each place in a window its own weight.
PLACES = _RNG.integers(0, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads each input bit over all 64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        for i, base in enumerate((_BASE, _BASE_INV)):
            steps = np.full(max(n, 1 << 19), base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[i] = np.multiply.accumulate(steps)
    return _POWERS[0], _POWERS[1]


def word_bounds(data: np.ndarray, separators: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray]:
    """Start and end (exclusive) of every maximal run of non-separators."""
    inside = np.empty(len(data) + 2, dtype=np.int8)
    inside[0] = inside[-1] = 0
    np.logical_not(separators[data], out=inside[1:-1].view(bool))
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word, from one prefix sum of a polynomial hash.

    A word's hash depends on its bytes only: the prefix difference is divided
    by the power at its start (the base is odd, so it has an inverse).
    """
    power, inverse = _powers(len(data) + 1)
    prefix = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_TABLE[data] * power[: len(data)], out=prefix[1:])
    return mix64((prefix[ends] - prefix[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every window of ``width`` consecutive words (fewer: none)."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = words[:n] * PLACES[0]
    for k in range(1, width):
        total = total + words[k : k + n] * PLACES[k]
    return mix64(total)


def text_batches(texts, most: int = 1 << 19):
    """Slices of a column of texts that hold about ``most`` bytes each, as
    (first row, list of UTF-8 bytes); one longer text stands alone."""
    first, held, size = 0, [], 0
    for i, text in enumerate(texts):
        raw = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""
        if held and size + len(raw) > most:
            yield first, held
            first, held, size = i, [], 0
        held.append(raw)
        size += len(raw) + 1
    if held:
        yield first, held


ASCII_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
