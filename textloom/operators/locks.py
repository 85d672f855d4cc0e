"""Placeholders: lock parts of a text before it leaves, restore them after.

Token kinds: S marks a segment, B a protected phrase, G a glossary term, L a
line break. Tokens carry the group id and a running number.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import BREAK, let, line_breaks, text
from .glossary import MOST_BYTES, _built, _shards, by_length, candidates, claims, pattern_of
from .term_automaton import Claims

TOKEN = "⟦[A-Z]_[^⟧]+⟧"


def _interleave(between: Column, marks: Column) -> Column:
    return F.array_join(F.zip_with(between, marks, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")


def lock_breaks(value: Column, group_id: Column, segment: Column) -> Column:
    """struct(text, locks): each separator becomes a numbered token; locks are
    (token, source). ``segment`` counts from 0."""
    return let(text(value), lambda v: _locked(v, group_id, segment))


def _locked(value: Column, group_id: Column, segment: Column) -> Column:
    found = line_breaks(value)
    token = lambda i: F.concat(F.lit("⟦L_"), group_id, F.lit("_"), (segment + 1).cast("string"), F.lit("_"), (i + 1).cast("string"), F.lit("⟧"))
    tokens = F.transform(found, lambda _, i: token(i))
    locks = F.zip_with(tokens, found, lambda t, s: F.struct(t.alias("token"), s.alias("source")))
    return F.struct(_interleave(F.split(text(value), BREAK, -1), tokens).alias("text"), locks.alias("locks"))


def restore_breaks(value: Column, locks: Column, required: bool = True) -> Column:
    """Text with its separators back; an error unless the tokens are exactly
    those of the locks, in order (not required: or none at all)."""
    pattern = "⟦L_[^⟧]+⟧"
    tokens = F.regexp_extract_all(text(value), F.lit(pattern), F.lit(0))
    same = tokens == F.transform(locks, lambda k: k["token"])
    restored = _interleave(F.split(text(value), pattern, -1), F.transform(locks, lambda k: k["source"]))
    wrong = F.raise_error(F.lit("missing, reordered, repeated or invented line-break token"))
    out = F.when(same, restored).otherwise(wrong)
    return out if required else F.when(F.size(tokens) == 0, text(value)).otherwise(out)


def restore_break_kinds(source: Column, target: Column) -> Column:
    """Target with the source's separators, if it has as many (a vertical tab
    counts as one); else unchanged."""
    wide = r"\r\n|[\r\n\x0B\x{2028}\x{2029}]"
    between = F.split(text(target), wide, -1)
    return F.when(F.size(between) - 1 == F.size(line_breaks(source)), _interleave(between, line_breaks(source))).otherwise(text(target))


def acronym_locks(value: Column, targets: Column) -> Column:
    """(placeholder, target) of the distinct acronym targets in the text."""
    whole = lambda t: F.concat(F.lit(r"(?i)(?:\A|(?<=[^A-Za-z0-9_]))\Q"), t, F.lit(r"\E(?=\z|[^A-Za-z0-9_])"))
    held = F.filter(F.array_distinct(targets), lambda t: (t != "") & F.regexp_like(text(value), whole(t)))
    return F.transform(held, lambda t, i: F.struct(F.concat(F.lit("__lock_acronym_"), (i + 1).cast("string"), F.lit("__")).alias("placeholder"), t.alias("target")))


def apply_acronyms(value: Column, locks: Column) -> Column:
    def put(acc, k):
        whole = F.concat(F.lit(r"(?i)(\A|[^A-Za-z0-9_])\Q"), k["target"], F.lit(r"\E(?=\z|[^A-Za-z0-9_])"))
        return F.regexp_replace(acc, whole, F.concat(F.lit("$1"), k["placeholder"]))

    return F.aggregate(locks, text(value), put)


def restore_acronyms(value: Column, locks: Column) -> Column:
    return F.aggregate(locks, text(value), lambda acc, k: F.replace(acc, k["placeholder"], k["target"]))


# --- groups -----------------------------------------------------------------


def prepare_segments(group_id: str, segments: Sequence[str], claim: Callable[[str], list[tuple[str, str]]], targets: dict[str, str], phrases: Sequence[tuple[str, str]]) -> tuple[list[str], list[tuple]]:
    """Anchored, locked segments and the locks (token, source, target,
    segment, kind) of a group: phrases first, terms next, breaks last.
    ``claim`` gives the (source, mode) of the terms that claim a place."""
    out, locks, count = [], [], {"B": 0, "G": 0}
    breaks = regex.compile("\r\n|[\r\n  ]")
    for i, value in enumerate(segments):

        def token(kind: str, source: str, target: str, i=i) -> str:
            count[kind] += 1
            name = f"⟦{kind}_{group_id}_{count[kind]:04d}⟧"
            locks.append((name, source, target, i, kind))
            return name

        for _, pattern in phrases:
            value = regex.sub(pattern, lambda m: token("B", m[0], m[0]), value)
        for source, mode in claim(value):
            value = pattern_of(source, mode == "exact").sub(lambda m, s=source: token("G", s, targets[s]), value)
        own = []
        value = breaks.sub(lambda m: own.append(m[0]) or f"⟦L_{group_id}_{i + 1}_{len(own)}⟧", value)
        locks += [(f"⟦L_{group_id}_{i + 1}_{k + 1}⟧", s, s, i, "L") for k, s in enumerate(own)]
        out.append(f"⟦S_{group_id}_{i + 1:03d}⟧{value}")
    return out, locks


_LOCKS = "array<struct<token:string,source:string,target:string,segment_index:int,kind:string>>"


def prepare_groups(groups: DataFrame, compiled: DataFrame, phrases: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """``groups`` (group_id, segments) with ``prepared`` and ``locks``. One
    automaton over all terms reads each segment once; with a glossary of over
    MOST_BYTES a group meets the terms whose token its segments have.
    ``phrases`` are a book's rules."""
    kind = f"prepared array<string>, locks {_LOCKS}"
    if compiled.agg(F.coalesce(F.sum(F.octet_length("source") + F.octet_length("target")), F.lit(0))).first()[0] <= MOST_BYTES:
        (shared,) = _shards(by_length(compiled).select("source", "contextual", "allow_ci", "target"), "source", "target")

        @F.pandas_udf(kind)
        def claimed(ids: pd.Series, segments: pd.Series) -> pd.DataFrame:
            claim, targets = _built(shared, lambda terms: (Claims([t[:3] for t in terms], pattern_of), {t[0]: t[3] for t in terms}))
            return pd.DataFrame([prepare_segments(g, list(s), claim, targets, phrases) for g, s in zip(ids, segments)], columns=["prepared", "locks"])

        return groups.withColumn("_p", claimed.asNondeterministic()("group_id", "segments")).select(*groups.columns, "_p.prepared", "_p.locks")

    @F.pandas_udf(kind)
    def run(ids: pd.Series, segments: pd.Series, own: pd.Series) -> pd.DataFrame:
        rows = []
        for g, s, terms in zip(ids, segments, own):
            ranked = sorted(terms if terms is not None else [], key=lambda e: (-e["n"], e["ord"]))
            ordered = [(e["source"], e["contextual"], e["allow_ci"]) for e in ranked]
            rows.append(prepare_segments(g, list(s), lambda v, t=ordered: claims(v, t), {e["source"]: e["target"] for e in ranked}, phrases))
        return pd.DataFrame(rows, columns=["prepared", "locks"])

    words = groups.select("group_id", F.array_join("segments", "\n").alias("_text"))
    found = candidates(words, compiled, "group_id", "_text", ("contextual", "allow_ci", "target")).withColumnRenamed("terms", "_terms")
    joined = groups.join(found, "group_id", "left")
    return joined.withColumn("_p", run.asNondeterministic()("group_id", "segments", "_terms")).select(*groups.columns, "_p.prepared", "_p.locks")


def token_faults(answer: Column, group_id: Column, locks: Column) -> Column:
    """Faults of an answered group: a segment without its anchor, a token that
    is missing, repeated, in another segment, or invented."""
    anchor = lambda i: F.format_string("⟦S_%s_%03d⟧", group_id, i + 1)
    body = F.transform(answer, lambda s, i: F.when(s.startswith(anchor(i)), F.substring(s, F.length(anchor(i)) + 1, F.length(s))))
    found = F.flatten(F.transform(body, lambda s, i: F.transform(F.regexp_extract_all(F.coalesce(s, F.lit("")), F.lit(TOKEN), F.lit(0)), lambda t: F.struct(t.alias("token"), i.alias("segment_index")))))
    want = F.transform(locks, lambda k: F.struct(k["token"].alias("token"), k["segment_index"].alias("segment_index")))
    say = lambda bad, word: F.when(bad, F.lit(word))
    faults = F.array(
        say(F.exists(body, lambda s: s.isNull()), "anchor"),
        say(F.size(F.array_except(want, found)) > 0, "missing"),
        say(F.size(F.array_except(found, want)) > 0, "invented"),
        say(F.size(found) != F.size(F.array_distinct(found)), "repeated"),
    )
    return F.filter(faults, lambda f: f.isNotNull())


def restore_segments(answer: Column, group_id: Column, locks: Column) -> Column:
    """Segments with anchors removed and tokens replaced by their targets; an
    error if the answer has faults."""
    anchor = lambda i: F.length(F.format_string("⟦S_%s_%03d⟧", group_id, i + 1))
    body = F.transform(answer, lambda s, i: F.substring(s, anchor(i) + 1, F.length(s)))
    back = F.transform(body, lambda s: F.aggregate(locks, s, lambda acc, k: F.replace(acc, k["token"], k["target"])))
    faults = token_faults(answer, group_id, locks)
    return F.when(F.size(faults) == 0, back).otherwise(F.raise_error(F.concat(F.lit("invalid answer: "), F.array_join(faults, ", "))).cast("array<string>"))
