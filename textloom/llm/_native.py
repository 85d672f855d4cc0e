"""Column helpers for match positions, without Python on the executors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_CHUNK = 64


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once.

    Lambdas of higher-order functions share no common subexpressions; binding
    the value as the only element of an array gives them a variable.
    """
    return F.element_at(F.transform(F.array(value), lambda x: body(x)), 1)


def running_sum(lengths: Column) -> Column:
    """Exclusive prefix sums of an array<int>, as array<long>.

    Summed in two levels, chunk totals first: an element costs at most one
    chunk and the chunk list grows with 1/64 of the array.
    """
    chunk = lambda i: F.floor(i / F.lit(_CHUNK)).cast("int")
    last = lambda n: F.greatest(n - 1, F.lit(0))

    def sums(own: Column) -> Column:
        total = F.aggregate(
            F.sequence(F.lit(0), chunk(last(F.size(own)))),
            F.array(F.lit(0).cast("long")),
            lambda acc, c: F.concat(acc, F.array(F.element_at(acc, -1) + _sum(F.slice(own, c * _CHUNK + 1, F.lit(_CHUNK))))),
        )
        places = F.sequence(F.lit(0), last(F.size(own)))
        return let(total, lambda t: F.transform(places, lambda i: F.element_at(t, chunk(i) + 1) + _sum(F.slice(own, chunk(i) * _CHUNK + 1, i % _CHUNK))))

    return let(lengths, lambda own: F.when(F.size(own) <= 0, F.array().cast("array<long>")).otherwise(sums(own)))


def _sum(part: Column) -> Column:
    return F.aggregate(part, F.lit(0).cast("long"), lambda a, x: a + x)


def match_spans(text: Column, pattern: str, group: int = 0) -> Column:
    """array<struct<start long, end long, value string>> of the leftmost
    non-overlapping matches of ``pattern`` (never empty), in code points.

    ``value`` is the given group. The pieces between the matches and the
    matches alternate, so their lengths give the positions.
    """

    def spans(found: Column, values: Column) -> Column:
        pieces = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
        return let(
            F.zip_with(pieces, found, lambda p, m: F.struct(F.length(p).alias("gap"), F.length(m).alias("long"))),
            lambda steps: F.transform(
                F.arrays_zip(running_sum(F.transform(steps, lambda s: s["gap"] + s["long"])).alias("at"), steps.alias("step"), values.alias("value")),
                lambda x: F.struct((x["at"] + x["step"]["gap"]).alias("start"), (x["at"] + x["step"]["gap"] + x["step"]["long"]).alias("end"), x["value"].alias("value")),
            ),
        )

    every = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    if group == 0:
        return let(every, lambda found: spans(found, found))
    return let(every, lambda found: spans(found, F.regexp_extract_all(text, F.lit(pattern), F.lit(group))))
