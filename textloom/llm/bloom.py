"""Blocked Bloom filter: built by native aggregation, probed with numpy.

A filter is ``blocks x 8`` words of 64 bits. A key's 64-bit hash picks one
block (one cache line), and eight bits inside it, one per word, so a probe
touches a single line. Building is a ``groupBy(block).agg(bit_or ...)``, which
combines before the shuffle; only the finished words reach the driver, at most
``max_bytes`` of them whatever the number of keys. A fuller filter lets more
keys pass and never loses one, so an exact join must follow.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LANES = 8
#: Odd 31-bit multipliers, one per lane: products stay below 2^62.
SALTS = [0x47B6137B, 0x44974D91, 0x7054A5C7, 0x2DF1424B, 0x5C6BFB31, 0x1EFC4947, 0x22B7289D, 0x6824AD5B]
LOW = (1 << 31) - 1


def blocks_for(keys: int, bits_per_key: int = 12, max_bytes: int = 16 << 20) -> int:
    """Power of two number of 64-byte blocks, within the byte bound."""
    wanted = max(1, keys * bits_per_key // 512)
    return 1 << min((max_bytes // 64).bit_length() - 1, (wanted - 1).bit_length())


def build(df: DataFrame, hashed: Column, blocks: int) -> np.ndarray:
    """Words of the filter of all hashes in ``df``, shape (blocks, 8)."""
    wide = df.select(hashed.alias("h")).where(F.col("h").isNotNull())
    block = F.shiftrightunsigned("h", 40).bitwiseAND(F.lit(blocks - 1)).cast("int")
    low = F.col("h").bitwiseAND(F.lit(LOW))
    bits = [
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col(f"b{i}"))).alias(f"w{i}")
        for i in range(LANES)
    ]
    lanes = [F.shiftright(low * F.lit(salt), 25).bitwiseAND(F.lit(63)).cast("int").alias(f"b{i}") for i, salt in enumerate(SALTS)]
    rows = wide.select(block.alias("block"), *lanes).groupBy("block").agg(*bits)
    words = np.zeros((blocks, LANES), dtype=np.uint64)
    for chunk in rows.toLocalIterator(prefetchPartitions=True):
        words[chunk[0]] = np.array(chunk[1:], dtype=np.int64).view(np.uint64)
    return words


def probe(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each 64-bit hash may be in the filter."""
    h = hashes.astype(np.int64).view(np.uint64)
    line = words[((h >> np.uint64(40)) & np.uint64(len(words) - 1)).astype(np.int64)]
    low = h & np.uint64(LOW)
    hit = np.ones(len(h), dtype=bool)
    for i, salt in enumerate(SALTS):
        bit = ((low * np.uint64(salt)) >> np.uint64(25)) & np.uint64(63)
        hit &= (line[:, i] >> bit) & np.uint64(1) == 1
    return hit


def prober(spark, words: np.ndarray):
    """Column function ``long -> boolean`` over a broadcast filter."""
    shared = spark.sparkContext.broadcast(words)

    @F.pandas_udf("boolean")
    def may_contain(hashes: pd.Series) -> pd.Series:
        return pd.Series(probe(shared.value, hashes.to_numpy()))

    return may_contain
