"""Locale typography: dates, French punctuation, percent, units, operators.

A language's rules are one ordered list of (id, pattern, replacement), written
once. ``normalise`` compiles it to a chain of built-in column expressions;
``normalise_text`` runs the same list in Python where a row brings protected
strings of its own, and is what the column form is tested against.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import NARROW, NBSP, SPACE, let, text

# Locale facts (code, decimal, grouping, gap before a percent
# sign or None where it precedes the number, quotes, unit system).
LOCALES = {
    "English": ("en", ".", ",", "", "“text”", "metric_then_imperial"),
    "French": ("fr", ",", NARROW, NARROW, f"«{NARROW}texte{NARROW}»", "metric_only"),
    "German": ("de", ",", ".", NBSP, "„Text“", "metric_only"),
    "Spanish": ("es", ",", NBSP, NBSP, "«texto»", "metric_then_imperial"),
    "Portuguese": ("pt", ",", ".", NBSP, "«texto»", "metric_only"),
    "Dutch": ("nl", ",", ".", "", "‘tekst’", "metric_only"),
    "Italian": ("it", ",", ".", NBSP, "«testo»", "metric_only"),
    "Turkish": ("tr", ",", ".", None, "“metin”", "metric_only"),
    "Polish": ("pl", ",", NBSP, "", "„tekst”", "metric_only"),
    "Swedish": ("sv", ",", NBSP, NBSP, "”text”", "metric_only"),
}
# Another name of a language, with its own quotes.
ALIASES = {"brazilian portuguese": ("Portuguese", "“texto”")}
# Forms of each month, as patterns; the first one is written.
MONTHS = {
    "English": [
        ["Jan", "January"], ["Feb", "February"], ["Mar", "March"], ["Apr", "April"], ["May"], ["Jun", "June"], ["Jul", "July"],
        ["Aug", "August"], ["Sep", "Sept", "September"], ["Oct", "October"], ["Nov", "November"], ["Dec", "December"],
    ],
    "German": [
        ["Jan", "Januar"], ["Feb", "Februar"], ["Mär", "März"], ["Apr", "April"], ["Mai"], ["Jun", "Juni"], ["Jul", "Juli"],
        ["Aug", "August"], ["Sep", "Sept", "September"], ["Okt", "Oktober"], ["Nov", "November"], ["Dez", "Dezember"],
    ],
    "Spanish": [
        ["enero", "ene"], ["febrero", "feb"], ["marzo", "mar"], ["abril", "abr"], ["mayo", "may"], ["junio", "jun"], ["julio", "jul"],
        ["agosto", "ago"], ["septiembre", "sep", "sept"], ["octubre", "oct"], ["noviembre", "nov"], ["diciembre", "dic"],
    ],
    "Portuguese": [
        ["janeiro", "jan"], ["fevereiro", "fev"], ["março", "mar"], ["abril", "abr"], ["maio", "mai"], ["junho", "jun"], ["julho", "jul"],
        ["agosto", "ago"], ["setembro", "set"], ["outubro", "out"], ["novembro", "nov"], ["dezembro", "dez"],
    ],
    "Dutch": [
        ["jan", "januari"], ["feb", "februari"], ["mrt", "maart"], ["apr", "april"], ["mei"], ["jun", "juni"], ["jul", "juli"],
        ["aug", "augustus"], ["sep", "september"], ["okt", "oktober"], ["nov", "november"], ["dec", "december"],
    ],
    "Italian": [
        ["gen", "gennaio"], ["feb", "febbraio"], ["mar", "marzo"], ["apr", "aprile"], ["mag", "maggio"], ["giu", "giugno"],
        ["lug", "luglio"], ["ago", "agosto"], ["set", "settembre"], ["ott", "ottobre"], ["nov", "novembre"], ["dic", "dicembre"],
    ],
    "Turkish": [
        ["Oca", "Ocak"], ["Şub", "Şubat"], ["Mar", "Mart"], ["Nis", "Nisan"], ["May", "Mayıs"], ["Haz", "Haziran"], ["Tem", "Temmuz"],
        ["Ağu", "Ağustos"], ["Eyl", "Eylül"], ["Eki", "Ekim"], ["Kas", "Kasım"], ["Ara", "Aralık"],
    ],
    "Polish": [
        ["sty", "stycznia"], ["lut", "lutego"], ["mar", "marca"], ["kwi", "kwietnia"], ["maj", "maja"], ["cze", "czerwca"],
        ["lip", "lipca"], ["sie", "sierpnia"], ["wrz", "września"], ["paź", "października"], ["lis", "listopada"], ["gru", "grudnia"],
    ],
    "Swedish": [
        ["jan", "januari"], ["feb", "februari"], ["mar", "mars"], ["apr", "april"], ["maj"], ["jun", "juni"], ["jul", "juli"],
        ["aug", "augusti"], ["sep", "september"], ["okt", "oktober"], ["nov", "november"], ["dec", "december"],
    ],
    "French": [
        ["janvier", "Jan", r"Janv\.?"], ["février", "Feb", r"Fév\.?", r"Févr\.?"], ["mars", r"Mar\.?"], ["avril", "Apr", r"Avr\.?"],
        ["mai", "May"], ["juin", "Jun"], ["juillet", "Jul", r"Juil\.?"], ["août", "Aug"], ["septembre", r"Sep\.?", r"Sept\.?"],
        ["octobre", r"Oct\.?"], ["novembre", r"Nov\.?"], ["décembre", r"Dec\.?", r"Déc\.?"],
    ],
}
# Unit symbols that a number is joined to.
UNITS = "mm cm km mg kg in ft yd mi min MOA mil m g s °C".split()
MATRIX_UNITS = "mm cm m km mg g kg in ft yd mi s min MOA mil".split()
OPERATORS = "+−×÷=≠≈<>≤≥±"
FRACTIONS = "½⅓⅔¼¾⅕⅖⅗⅘⅙⅚⁄"
#: Literal syntax that no rule may touch.
LITERAL = r"(?s:<\?.*?\?>)|</?[A-Za-z][^>]*>|&(?:#[0-9]+|#x[0-9A-Fa-f]+|[A-Za-z]+);" rf"|(?:https?://|www\.)[^{SPACE}<>]+|(?<![A-Za-z0-9_.+-])[A-Za-z0-9_.+-]++@[A-Za-z0-9_.-]+\.[A-Za-z]+|⟦[^⟧]+⟧|__lock_[A-Za-z0-9_]+__"
MASK = "\ue100"

_GAP, _WIDE = r"[ \x{A0}\x{202F}]", r"[ \x{A0}\x{2009}\x{202F}]"
_DAY, _FROM, _TO = "(0?[1-9]|[12][0-9]|3[01])", "(?<![A-Za-z0-9_])", "(?![A-Za-z0-9_])"


def language_of(name: str) -> str:
    """Supported language of a name or alias; ValueError otherwise."""
    wanted = name.strip().lower()
    if wanted in ALIASES:
        return ALIASES[wanted][0]
    for language in LOCALES:
        if language.lower() == wanted:
            return language
    raise ValueError(f"no typography for language: {name}")


def matrix(language: str) -> list[tuple[str, str, str]]:
    """The seventeen-rule matrix as it applies to a language: three rules for
    all, four for French, one date rule; (id, pattern, replacement)."""
    sign = rf"(?=[ \p{{P}}]|\z)"
    out = []
    if language == "French":
        run = r"[ \x{A0}\x{2009}]"
        alone = r"(?<![ \t\x{A0}\x{2009}])"
        out += [
            ("fr_punctuation", rf"{alone}{run}+(?=[;:!?%])", NARROW),
            ("fr_em_dash", rf"([^{SPACE}]){_WIDE}*—{_WIDE}*+(?!\t)", f"$1 —{NARROW}"),
            ("fr_open_quote", rf"(?<=«){run}++(?!\t)", NARROW),
            ("fr_close_quote", rf"{alone}{run}+(?=»)", NARROW),
        ]
    out += [
        ("unit_nbsp", rf"(?<=[0-9]) ({'|'.join(MATRIX_UNITS)})(?=[{SPACE}\p{{P}}]|\z)", f"{NBSP}$1"),
        ("math_before", rf"(?<=[0-9]) ([{OPERATORS}{FRACTIONS}]){sign}", f"{NBSP}$1"),
        ("math_after", rf"(?<=[{OPERATORS}]) (?=[+−-]?[0-9])", NBSP),
    ]
    months = "|".join(forms[0] for forms in MONTHS[language])
    de = rf"de{_WIDE}+" if language in ("Spanish", "Portuguese") else ""
    day = "([0-9]{1,2}(?:er)?)" if language == "French" else "([0-9]{1,2})"
    joined = NBSP + (f"de{NBSP}" if de else "")
    out.append((f"date_{language.lower()}", rf"{_FROM}{day}{_WIDE}+{de}({months}){_WIDE}+{de}([0-9]{{4}}){_TO}", f"$1{joined}$2{joined}$3"))
    return out


@lru_cache(maxsize=None)
def steps(language: str) -> tuple[tuple[str, str, str], ...]:
    """All rules of a language in order; the matrix comes last."""
    out: list[tuple[str, str, str]] = []
    for forms in MONTHS[language]:
        spelled = forms[0]
        any_form = f"(?:{'|'.join(forms)})"
        if language == "French":
            end = rf"{_GAP}+{any_form}{_GAP}+([0-9]{{4}}){_TO}"
            out.append(("dates", rf"(?iu){_FROM}0?1(?:er)?{end}", f"1er{NBSP}{spelled}{NBSP}$1"))
            out.append(("dates", rf"(?iu){_FROM}(?!0?1(?:er)?{_GAP}){_DAY}(?:er)?{end}", f"$1{NBSP}{spelled}{NBSP}$2"))
        elif language == "Spanish":
            de = rf"{_GAP}+(?:de{_GAP}+)?"
            out.append(("dates", rf"(?iu){_FROM}{_DAY}{de}{any_form}\.?{de}([0-9]{{4}}){_TO}", f"$1{NBSP}de{NBSP}{spelled}{NBSP}de{NBSP}$2"))
        elif language == "Portuguese":
            de = rf"{_GAP}+de{_GAP}+"
            out.append(("dates", rf"(?iu){_FROM}{_DAY}{de}{any_form}\.?{de}([0-9]{{4}}){_TO}", f"$1{NBSP}de{NBSP}{spelled}{NBSP}de{NBSP}$2"))
        else:
            out.append(("dates", rf"(?iu){_FROM}{_DAY}{_GAP}+{any_form}\.?{_GAP}+([0-9]{{4}}){_TO}", f"$1{NBSP}{spelled}{NBSP}$2"))
    if language == "French":
        out += [
            ("french", rf"([^{SPACE}]){_WIDE}*([;!?])", f"$1{NARROW}$2"),
            ("french", rf"([^{SPACE}0-9]){_WIDE}*:(?![0-9])", f"$1{NARROW}:"),
            ("french", rf"«{_WIDE}*(?=[^{SPACE}])", f"«{NARROW}"),
            ("french", rf"([^{SPACE}]){_WIDE}*»", f"$1{NARROW}»"),
            ("french", rf"([^{SPACE}]){_WIDE}+—{_WIDE}+(?=[^{SPACE}])", f"$1 —{NARROW}"),
        ]
    gap = LOCALES[language][3]
    if gap is not None:
        out.append(("percent", rf"([0-9]){_WIDE}*%", f"$1{gap}%"))
    out.append(("units", rf"([0-9]){_WIDE}+({'|'.join(UNITS)})(?![\p{{L}}\p{{N}}_])", f"$1{NBSP}$2"))
    out.append(("operators", rf"([0-9]){_GAP}+([{OPERATORS}]){_GAP}+(?=[+−-]?[0-9])", f"$1{NBSP}$2{NBSP}"))
    return (*out, *matrix(language))


# --- column form ------------------------------------------------------------


def mask(c: Column, pattern: str = LITERAL) -> Column:
    """struct(masked, kept): literal syntax is one mask character each."""
    checked = F.when(c.contains(MASK), F.raise_error(F.lit("reserved mask character in input"))).otherwise(c)
    return F.struct(F.regexp_replace(checked, pattern, MASK).alias("masked"), F.regexp_extract_all(c, F.lit(pattern), F.lit(0)).alias("kept"))


def unmask(masked: Column, kept: Column) -> Column:
    between = F.split(masked, MASK, -1)
    return F.array_join(F.zip_with(between, kept, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")


def _marks(pattern: str) -> str:
    """Characters of which a text must have one for a punctuation rule to
    match; none where the rule asks for no such character."""
    for held, marks in (("[;:!?%]", ";:!?%"), ("[;!?]", ";!?"), (":(?!", ":"), ("«", "«"), ("»", "»"), ("—", "—")):
        if held in pattern:
            return marks
    return "%" if pattern.endswith("%") else ""


def apply_rules(c: Column, rules) -> Column:
    """The rules in order; those about a mark are tried only on texts that
    have it, by a plain search."""
    for _, pattern, put in rules:
        marks = _marks(pattern)
        if marks:
            c = _guarded_rule(c, pattern, put, marks)
        else:
            c = F.regexp_replace(c, pattern, put)
    return c


def _guarded_rule(c: Column, pattern: str, put: str, marks: str) -> Column:
    def one(x: Column) -> Column:
        there = x.contains(marks[0])
        for mark in marks[1:]:
            there = there | x.contains(mark)
        return F.when(there, F.regexp_replace(x, pattern, put)).otherwise(x)

    return let(c, one)


def normalise(c: Column, language: str) -> Column:
    """Typography of one language. Null becomes empty. Texts without a digit
    or one of the marks that rules look for are passed through untested."""
    name = language_of(language)
    return let(text(c), lambda t: _normalised(t, name))


def _normalised(t: Column, language: str) -> Column:
    dates = [s for s in steps(language) if s[0] in ("dates", f"date_{language.lower()}")]
    rest = [s for s in steps(language) if s[0] not in ("dates", f"date_{language.lower()}")]

    def ruled(x: Column) -> Column:
        # Month rules see a text only if it has a year: each needs one.
        return let(x, lambda y: apply_rules(F.when(y.rlike(r"[0-9]{4}"), apply_rules(y, dates)).otherwise(y), rest))

    if language == "French":
        # The order of the list counts here: matrix punctuation precedes its
        # date rule, which cannot change what punctuation rules match.
        relevant = t.rlike("[0-9;:!?%«»—]")
    else:
        relevant = t.rlike("[0-9]|[" + OPERATORS + "] ")
    literal = t.rlike(r"[<&⟦@_]|https?://|www\.")
    with_mask = let(mask(t), lambda m: unmask(ruled(m["masked"]), m["kept"]))
    return F.when(~relevant, t).when(literal, with_mask).otherwise(ruled(t))


def normalise_by(c: Column, language: Column, languages: Sequence[str] | None = None) -> Column:
    """Typography by a language column; unknown languages keep the text.
    ``languages`` may name those that occur: the others' rules then are no
    part of the expression."""
    out = text(c)
    for name in LOCALES if languages is None else map(language_of, languages):
        out = F.when(F.lower(F.trim(language)) == name.lower(), normalise(c, name)).otherwise(out)
    return out


_MATCH, _PUT, _DONE = "\ue101", "\ue102", "\ue103"


def matrix_run(c: Column, language: str) -> Column:
    """struct(typeset, counts): the text after the matrix, and (rule, matches,
    changes) of each of its rules, which run one after the other.

    Each match is put beside its replacement between marks, so that matches
    and those that their replacement differs from are counted where they are.
    """
    name = language_of(language)

    def step(t: Column, rules: list, counts: list) -> Column:
        if not rules:
            return F.struct(t.alias("t"), F.array(*counts).alias("counts"))
        (rule, pattern, put), *rest = rules

        def counted(marked: Column) -> Column:
            pair = f"{_MATCH}([^{_PUT}]*){_PUT}([^{_DONE}]*){_DONE}"
            both = [F.regexp_extract_all(marked, F.lit(pair), F.lit(g)) for g in (1, 2)]
            differ = F.filter(F.zip_with(*both, lambda a, b: a != b), lambda x: x)
            count = F.struct(F.lit(rule).alias("rule"), F.size(both[0]).cast("long").alias("matches"), F.size(differ).cast("long").alias("changes"))
            return step(F.regexp_replace(marked, pair, "$2"), rest, [*counts, count])

        return let(F.regexp_replace(t, pattern, f"{_MATCH}$0{_PUT}{put}{_DONE}"), counted)

    run = lambda m: let(step(m["masked"], matrix(name), []), lambda r: F.struct(unmask(r["t"], m["kept"]).alias("typeset"), r["counts"].alias("counts")))
    reserved = F.raise_error(F.lit("reserved mark in input"))
    return let(F.when(text(c).rlike(f"[{_MATCH}-{_DONE}]"), reserved).otherwise(text(c)), lambda t: let(mask(t), run))


def is_untidy(c: Column, language: str) -> Column:
    """The audit: normalising would change the text."""
    return normalise(c, language) != text(c)


# --- Python form ------------------------------------------------------------


def _python(pattern: str) -> str:
    return regex.sub(r"\\x\{([0-9A-Fa-f]+)\}", lambda m: f"\\U{int(m[1], 16):08x}", pattern).replace("(?iu)", "(?i)").replace(r"\z", r"\Z")


@lru_cache(maxsize=None)
def _compiled(language: str):
    return [(k, regex.compile(_python(p)), regex.sub(r"\$(\d)", r"\\g<\1>", r)) for k, p, r in steps(language)]


@lru_cache(maxsize=10_000)
def _guarded(term: str):
    return regex.compile(rf"(?<![\p{{L}}\p{{N}}_]){regex.escape(term)}(?![\p{{L}}\p{{N}}_])")


_LITERAL = regex.compile(_python(LITERAL))


def _hide(value: str, protected) -> tuple[str, list[str]]:
    """Protected strings, the longest first, then literal syntax, each as a
    mask character and its number from a private plane."""
    if MASK in value:
        raise ValueError("reserved mask character in input")
    kept: list[str] = []

    def put(found: str) -> str:
        kept.append(found)
        return MASK + chr(0xF0000 + len(kept) - 1)

    for term in sorted({p for p in (() if protected is None else protected) if p}, key=lambda p: (-len(p), p)):
        if term in value:
            value = _guarded(term).sub(lambda m: put(m[0]), value)
    return _LITERAL.sub(lambda m: put(m[0]), value), kept


def _show(value: str, kept: list[str]) -> str:
    while MASK in value:
        head, _, rest = value.partition(MASK)
        value = head + kept[ord(rest[0]) - 0xF0000] + rest[1:]
    return value


def normalise_text(value: str | None, language: str, protected=()) -> str:
    """Typography of one text, leaving the protected strings as they are."""
    hidden, kept = _hide(value or "", protected)
    for _, pattern, put in _compiled(language_of(language)):
        hidden = pattern.sub(put, hidden)
    return _show(hidden, kept)


def matrix_report(value: str | None, language: str, protected=()) -> tuple[str, list[tuple[str, int, int]]]:
    """Text after the matrix, and (rule, matches, changes) of each rule."""
    hidden, kept = _hide(value or "", protected)
    counts = []
    for rule, pattern, put in _matrix_compiled(language_of(language)):
        matches = changes = 0

        def swap(m, pattern=pattern, put=put):
            nonlocal matches, changes
            new = m.expand(put)
            matches += 1
            changes += new != m[0]
            return new

        hidden = pattern.sub(swap, hidden)
        counts.append((rule, matches, changes))
    return _show(hidden, kept), counts


@lru_cache(maxsize=None)
def _matrix_compiled(language: str):
    return [(k, regex.compile(_python(p)), regex.sub(r"\$(\d)", r"\\g<\1>", r)) for k, p, r in matrix(language)]


def normalise_protected(language: str):
    """Column function (text, array of protected strings) -> text."""
    name = language_of(language)

    @F.pandas_udf("string")
    def run(values: pd.Series, protected: pd.Series) -> pd.Series:
        return pd.Series([normalise_text(v, name, p if p is not None else ()) for v, p in zip(values, protected)], dtype=object)

    return run


# --- dimension tables -------------------------------------------------------


def locale_table(spark: SparkSession) -> DataFrame:
    rows = [(k, *v) for k, v in LOCALES.items()]
    return spark.createDataFrame(rows, "language string, code string, decimal string, grouping string, percent_gap string, quotes string, units string")


def rule_table(spark: SparkSession) -> DataFrame:
    """All seventeen matrix rules: language ("All" for shared ones), place."""
    french = matrix("French")
    shared = [("All" if k.startswith(("unit", "math")) else "French", k, p, r) for k, p, r in french[:-1]]
    dated = [(lang, *matrix(lang)[-1]) for lang in LOCALES]
    return spark.createDataFrame([(i + 1, lang, k, p, r) for i, (lang, k, p, r) in enumerate(shared + dated)], "place int, language string, rule string, pattern string, replacement string")


def rules_for(rules: DataFrame, language: str) -> DataFrame:
    """Rules with ``applies`` and, for the others, the reason."""
    name = language_of(language)
    applies = F.col("language").isin("All", name)
    return rules.withColumn("applies", applies).withColumn("reason", F.when(~applies, F.concat(F.lit("specific to "), F.col("language"))))
