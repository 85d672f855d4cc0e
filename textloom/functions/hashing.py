"""Fingerprints of texts, rows and file sets."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sorted_folds import fold_sorted
from .text import text


def fnv1a32(c: Column) -> Column:
    """FNV-1a over UTF-16 code units, eight upper-case hex digits."""
    digits = F.hex(F.encode(text(c), "UTF-16BE"))
    units = F.transform(F.sequence(F.lit(0), F.greatest((F.length(digits) / 4).cast("int"), F.lit(1)) - 1), lambda i: F.conv(F.substring(digits, i * 4 + 1, F.lit(4)), 16, 10).cast("long"))
    start = F.lit(2166136261).cast("long")
    step = lambda h, u: (h.bitwiseXOR(u) * F.lit(16777619).cast("long")).bitwiseAND(F.lit(4294967295).cast("long"))
    folded = F.when(F.length(digits) == 0, start).otherwise(F.aggregate(units, start, step))
    return F.lpad(F.hex(folded), 8, "0")


def sha256_upper(c: Column) -> Column:
    return F.upper(F.sha2(text(c), 256))


def payload_text(rows: DataFrame, order: str = "row_no", tag: str = "content_tag", content: str = "content", *, keys: Sequence[str]) -> DataFrame:
    """One text of all rows in order: id, U+001F, text, U+001E. One row per
    ``keys``: the payload of a key is one value, so it has to fit a task."""
    item = F.struct(F.col(order).alias("o"), F.concat(text(F.col(tag)), F.lit("\x1f"), text(F.col(content)), F.lit("\x1e")).alias("t"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["t"]), "")
    return rows.groupBy(*keys).agg(joined.alias("payload"))


class _SetHash:
    """Hash of one set's lines, which arrive in order in pieces: the last
    column of a row, after the keys and the path."""

    def __init__(self):
        self.count, self.state, self.key = 0, hashlib.sha256(), ()

    def add(self, rows: list[tuple]) -> list[tuple]:
        self.key = rows[0][:-2]
        self.count += len(rows)
        for row in rows:
            self.state.update(row[-1].encode("utf-8", "surrogatepass"))
        return []

    def end(self) -> list[tuple]:
        return [(*self.key, self.count, self.state.hexdigest().upper())]


def set_hash(files: DataFrame, path: str = "path", digest: str = "sha256", *, keys: Sequence[str]) -> DataFrame:
    """SHA-256 of the sorted lines path, NUL, hash, LF of each file set. The
    lines of a set pass one task in order and are not held."""
    line = F.concat(F.col(path), F.lit("\x00"), F.col(digest), F.lit("\n"))
    narrow = files.select(*keys, F.col(path).alias("path"), line.alias("line")).where(F.col("line").isNotNull())
    schema = narrow.select(*keys, F.lit(0).cast("long").alias("n_files"), F.lit("").alias("set_sha256")).schema
    return fold_sorted(narrow, keys, "path", _SetHash, schema)


def set_tree(files: DataFrame, path: str = "path", digest: str = "sha256", leaf_bits: int = 12, *, keys: Sequence[str]) -> DataFrame:
    """(keys, leaf, n_files, sha256): file sets as trees of two levels, beside
    the flat hash. A file's leaf is given by the first ``leaf_bits`` bits (up
    to 16) of its path's SHA-256, so a file that comes or goes changes one
    leaf. A leaf's hash is that of its sorted lines path, NUL, hash, LF; many
    tasks make the leaves of one set. Rows without a path or hash are left out.
    """
    line = F.concat(F.col(path), F.lit("\x00"), F.col(digest), F.lit("\n"))
    leaf = F.shiftright(F.conv(F.substring(F.sha2(F.col(path), 256), 1, 4), 16, 10).cast("int"), 16 - leaf_bits)
    narrow = files.select(*keys, leaf.alias("leaf"), line.alias("line")).where(F.col("line").isNotNull())
    lines = F.array_join(F.array_sort(F.collect_list("line")), "")
    return narrow.groupBy(*keys, "leaf").agg(F.count("*").alias("n_files"), F.upper(F.sha2(lines, 256)).alias("sha256"))


def tree_roots(tree: DataFrame, *, keys: Sequence[str]) -> DataFrame:
    """(keys, n_files, set_sha256): the hash of each set's sorted lines leaf,
    NUL, hash, LF; at most one line for each leaf."""
    item = F.struct("leaf", F.concat(F.col("leaf").cast("string"), F.lit("\x00"), F.col("sha256"), F.lit("\n")).alias("line"))
    lines = F.array_join(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["line"]), "")
    return tree.groupBy(*keys).agg(F.sum("n_files").alias("n_files"), F.upper(F.sha2(lines, 256)).alias("set_sha256"))


def changed_leaves(old: DataFrame, new: DataFrame, *, keys: Sequence[str]) -> DataFrame:
    """(keys, leaf, state): leaves that only one of two trees has (added,
    removed) or whose hashes differ (changed); only their files need be read
    again."""
    a, b = (t.select(*keys, "leaf", F.col("sha256").alias(n)) for t, n in ((old, "_old"), (new, "_new")))
    state = F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "removed").when(F.col("_old") != F.col("_new"), "changed")
    return a.join(b, [*keys, "leaf"], "full_outer").select(*keys, "leaf", state.alias("state")).where("state is not null")
