"""Folds over the rows of a key in order, one Arrow batch at a time."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T


def fold_sorted(rows: DataFrame, keys: Sequence[str], order: str, make: Callable[[], object], schema: T.StructType) -> DataFrame:
    """Hand each key's rows, by ``order``, to a fold of its own.

    ``make()`` gives a fold with ``add(rows)`` and ``end()``: rows are tuples
    in the order of the columns, and both return a list of tuples of
    ``schema``. A task sorts its rows outside Python and holds one batch of
    them, so the size of a key sets its time and not its memory. Key columns
    are text or whole numbers; null is a key.
    """
    dealt = rows.repartition(*keys) if keys else rows.repartition(1)
    places = [rows.columns.index(k) for k in keys]
    names = schema.names

    def framed(out: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(out, columns=names, dtype=object)

    def run(batches):
        fold, key = None, None
        for pdf in batches:
            # Missing numbers come as NaN, which equals nothing; None does.
            held = list(zip(*(pdf[c].astype(object).where(pdf[c].notna(), None).tolist() for c in pdf.columns)))
            out: list[tuple] = []
            first = 0
            while first < len(held):
                now = tuple(held[first][p] for p in places)
                last = first + 1
                while last < len(held) and all(held[last][p] == v for p, v in zip(places, now)):
                    last += 1
                if fold is None or now != key:
                    if fold is not None:
                        out += fold.end()
                    fold, key = make(), now
                out += fold.add(held[first:last])
                first = last
            if out:
                yield framed(out)
        if fold is not None and (out := fold.end()):
            yield framed(out)

    return dealt.sortWithinPartitions(*keys, order).mapInPandas(run, schema)
