"""Column scalars: whitespace, line breaks, identifiers, names, boundaries.

All are built-in expressions, so they stay inside generated code. Lengths and
offsets count code points unless a name says UTF-16.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# White space as the text contracts define it (Unicode space
# separators, line and paragraph separators, no-break space, byte-order mark).
SPACE = r"\t\n\x0B\f\r \x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}"
#: The same as characters, for built-in trimming, which looks at the ends only.
SPACES = "\t\n\x0b\f\r \xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000\ufeff"
WORD = r"\p{L}\p{M}\p{N}_"
BREAK = r"\r\n|[\r\n\x{2028}\x{2029}]"
ERROR_LITERALS = ["#NULL!", "#DIV/0!", "#VALUE!", "#REF!", "#NAME?", "#NUM!", "#N/A"]
NBSP, NARROW, THIN = " ", " ", " "


def text(c: Column) -> Column:
    """Null becomes the empty string: emptiness means absent here."""
    return F.coalesce(c.cast("string"), F.lit(""))


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), lambda x: body(x)), 1)


def cell(c: Column) -> Column:
    """Workbook cell: null to empty, CRLF to LF."""
    return F.replace(text(c), F.lit("\r\n"), F.lit("\n"))


clean_text = cell


def has_content(c: Column) -> Column:
    """Not empty; a single space is content."""
    return F.length(text(c)) > 0


def trim(c: Column) -> Column:
    """Trim all of SPACE, not only U+0020."""
    return F.btrim(text(c), F.lit(SPACES))


def trimmed_cell(c: Column) -> Column:
    return trim(cell(c))


def is_blank(c: Column) -> Column:
    return trim(c) == ""


def lookup_key(c: Column) -> Column:
    return F.lower(trimmed_cell(c))


def fold(c: Column) -> Column:
    """Case fold for keys. Text must already be in NFC (see ``nfc``)."""
    return F.lower(text(c))


def nfc(c: Column) -> Column:
    """Composed form. Spark has no normalisation of its own, so this is an
    Arrow function; call it once, when text comes in."""

    @F.pandas_udf("string")
    def run(values: pd.Series) -> pd.Series:
        return pd.Series([None if v is None else unicodedata.normalize("NFC", v) for v in values], dtype=object)

    return run(c.cast("string"))


def content_id(c: Column) -> Column:
    """Trimmed id; of digits only, without leading zeros."""
    t = trim(c)
    return F.when(t.rlike(r"\A[0-9]+\z"), F.regexp_replace(t, r"\A0+(?=[0-9])", "")).otherwise(t)


def is_error_literal(c: Column) -> Column:
    """Spreadsheet error value, in any case and padding."""
    return F.upper(trim(c)).isin(*ERROR_LITERALS)


def should_skip(c: Column) -> Column:
    """Nothing to translate: blank, or digits, spaces and plain marks only."""
    t = trimmed_cell(c)
    return (t == "") | t.rlike(rf"\A[0-9{SPACE}.,:/\\()\[\]{{}}+_\-\x{{2013}}\x{{2014}}]+\z")


def is_pending(source: Column, target: Column) -> Column:
    """Source is there, target is blank."""
    return ~is_blank(source) & is_blank(target)


def outer_whitespace(c: Column) -> Column:
    """struct(leading, core, trailing) that concatenates to the text."""
    t = text(c)
    lead, tail = _ends(t, SPACES)
    return F.struct(lead.alias("leading"), trim(t).alias("core"), F.when(trim(t) == "", F.lit("")).otherwise(tail).alias("trailing"))


def _ends(t: Column, chars: str) -> tuple[Column, Column]:
    """What ``t`` begins and ends with of these characters."""
    lead = F.length(t) - F.length(F.ltrim(t, F.lit(chars)))
    tail = F.length(t) - F.length(F.rtrim(t, F.lit(chars)))
    return F.substring(t, F.lit(1), lead), F.substring(t, F.length(t) - tail + 1, tail)


def boundary_whitespace(c: Column) -> Column:
    """struct(leading, trailing) of ASCII blanks and breaks only."""
    lead, tail = _ends(text(c), " \t\r\n")
    return F.struct(lead.alias("leading"), tail.alias("trailing"))


# --- line breaks ------------------------------------------------------------


def line_breaks(c: Column) -> Column:
    """All separators in order: CRLF, CR, LF, U+2028 and U+2029."""
    return F.regexp_extract_all(text(c), F.lit(BREAK), F.lit(0))


def same_breaks(a: Column, b: Column) -> Column:
    """Whether the separators of two texts are equal. Where both have line
    feeds only, their numbers tell."""
    a, b = text(a), text(b)
    other = lambda t: t.contains("\r") | t.contains("\u2028") | t.contains("\u2029")
    feeds = lambda t: F.length(t) - F.length(F.replace(t, F.lit("\n"), F.lit("")))
    return F.when(a == b, True).when(other(a) | other(b), line_breaks(a) == line_breaks(b)).otherwise(feeds(a) == feeds(b))


def to_lf(c: Column) -> Column:
    return F.regexp_replace(text(c), r"\r\n?", "\n")


def break_style(c: Column) -> Column:
    """CRLF if there is one, else CR, else LF, else null."""
    t = text(c)
    return F.when(t.contains("\r\n"), F.lit("\r\n")).when(t.contains("\r"), F.lit("\r")).when(t.contains("\n"), F.lit("\n"))


def count_breaks(c: Column) -> Column:
    return F.regexp_count(text(c), F.lit(r"\r\n|\r|\n"))


def convert_breaks(c: Column, style: Column) -> Column:
    return F.replace(to_lf(c), F.lit("\n"), F.coalesce(style, F.lit("\n")))


# --- names and paths --------------------------------------------------------


def file_part(c: Column) -> Column:
    """File-name part: reserved characters and space runs to "_", 120 at most."""
    return F.substring(F.regexp_replace(F.regexp_replace(text(c), r'[<>:"/\\|?*\x00-\x1F]', "_"), rf"[{SPACE}]+", "_"), 1, 120)


def path_part(c: Column) -> Column:
    """Path component of safe ASCII; an error if nothing is left."""
    t = F.regexp_replace(F.regexp_replace(trim(c), r"[^A-Za-z0-9._-]+", "_"), r"\A_+|_+\z", "")
    return F.when(t != "", t).otherwise(F.raise_error(F.concat(F.lit("no safe path component in: "), text(c))))


def file_stem(path: Column) -> Column:
    """Stem and the first twelve digits of the path's SHA-1."""
    base = F.regexp_replace(F.regexp_extract(path, r"([^/\\]*)\z", 1), r"(?<=.)\.[^.]*\z", "")
    stem = F.regexp_replace(F.regexp_replace(base, r"[^\w.-]+", "_"), r"\A_+|_+\z", "")
    return F.concat_ws(".", F.when(stem == "", F.lit("diagram")).otherwise(stem), F.substring(F.sha1(path), 1, 12))


def file_name_key(c: Column) -> Column:
    """Lower case; runs of "_" and spaces are one space."""
    return trim(F.regexp_replace(F.lower(text(c)), rf"[_{SPACE}]+", " "))


def page_of(name: Column) -> Column:
    """Number after "Page_", in any case; null without one."""
    found = F.regexp_extract(name, r"(?i)Page_([0-9]+)", 1)
    return F.when(found != "", found.cast("int"))


def decode_style(c: Column) -> Column:
    """Percent-decoded paragraph style without its kind; malformed escapes
    are kept, and "+" stays itself."""
    t = text(c)
    plain = F.coalesce(F.try_url_decode(F.replace(t, F.lit("+"), F.lit("%2B"))), t)
    return F.regexp_replace(plain, r"\A(?i)ParagraphStyle/", "")


def style_leaf(c: Column) -> Column:
    return F.element_at(F.split(decode_style(c), "[:/]", -1), -1)


def base_font(c: Column) -> Column:
    """Font name without slash and subset prefix."""
    return F.regexp_replace(F.regexp_replace(text(c), r"\A/+", ""), r"\A[A-Z]{6}\+", "")


# Fonts of prose and of source code.
PROSE_FONTS = ["open sans", "opensans", "chakrapetch", "league gothic", "leaguegothic"]
CODE_FONTS = ["source code", "sourcecodepro"]


def font_class(c: Column) -> Column:
    """prose, sourceCode or unknown."""
    name = F.lower(base_font(c))
    hit = lambda names: F.exists(F.array(*map(F.lit, names)), lambda n: name.contains(n))
    return F.when(hit(PROSE_FONTS), F.lit("prose")).when(hit(CODE_FONTS), F.lit("sourceCode")).otherwise(F.lit("unknown"))


def font_matches(font: Column, terms: Column) -> Column:
    """Any term within the font name, separators ignored."""
    plain = lambda c: F.regexp_replace(F.lower(c), rf"[{SPACE}_-]+", "")
    return F.exists(terms, lambda t: (plain(t) != "") & plain(font).contains(plain(t)))


# --- repairs ----------------------------------------------------------------


def strip_control(c: Column) -> Column:
    """Without control characters that JSON and XML forbid."""
    return F.regexp_replace(text(c), r"[\x00-\x08\x0B\x0C\x0E-\x1F]", "")


def repair_mojibake(c: Column) -> Column:
    """UTF-8 read as Latin-1 is read anew, where all characters allow it."""
    t = text(c)
    broken = t.rlike("[ÃÂ]") & ~t.rlike(r"[^\x{0}-\x{FF}]")
    return F.when(broken, F.decode(F.encode(F.when(broken, t), "ISO-8859-1"), "UTF-8")).otherwise(t)


def request_text(c: Column, repair: bool = False) -> Column:
    """Text as it may leave the system."""
    return strip_control(clean_text(repair_mojibake(c) if repair else c))


# Ligatures and their letters.
LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st"}


def plain_line(c: Column) -> Column:
    """Ligatures spelled out, white space collapsed."""
    out = text(c)
    for mark, letters in LIGATURES.items():
        out = F.replace(out, F.lit(mark), F.lit(letters))
    return trim(F.regexp_replace(out, rf"[{SPACE}]+", " "))


def plain_punctuation(c: Column) -> Column:
    """Curly quotes, primes and dashes to ASCII."""
    return F.translate(text(c), "‘’‛′“”″‐‑‒–—―", "''''\"\"\"------")


# --- patterns ---------------------------------------------------------------


def escape_regex(c: Column) -> Column:
    return F.regexp_replace(text(c), r"([.*+?^${}()|\[\]\\])", r"\\$1")


def term_pattern(term: Column, case_sensitive: Column | bool | None = None) -> Column:
    """Java pattern of a literal term between Unicode word boundaries.

    A guard stands only at an end that is a word character. By default the
    case counts for terms of up to four characters without lower case.
    """
    t = text(term)
    if case_sensitive is None:
        exact = (F.length(t) <= 4) & (t == F.upper(t))
    else:
        exact = F.lit(case_sensitive) if isinstance(case_sensitive, bool) else case_sensitive
    left = F.when(t.rlike(rf"\A[{WORD}]"), F.lit(rf"(?<![{WORD}])")).otherwise(F.lit(""))
    right = F.when(t.rlike(rf"[{WORD}]\z"), F.lit(rf"(?![{WORD}])")).otherwise(F.lit(""))
    return F.concat(F.when(exact, F.lit("")).otherwise(F.lit("(?iu)")), left, escape_regex(t), right)


def ascii_term_pattern(term: Column) -> Column:
    """Java pattern of a literal term between ASCII boundaries, any ASCII case."""
    return F.concat(F.lit("(?i)(?:\\A|(?<=[^A-Za-z0-9_]))"), escape_regex(term), F.lit("(?=\\z|[^A-Za-z0-9_])"))


def contains_term(c: Column, term: Column) -> Column:
    """ASCII-boundary containment with a literal prefilter."""
    return F.lower(text(c)).contains(F.lower(text(term))) & F.regexp_like(text(c), ascii_term_pattern(term))


def may_fold_to_ascii(c: Column) -> Column:
    """Has a non-ASCII character whose case fold is ASCII."""
    return text(c).rlike(r"[\x{17F}\x{212A}]")


def count_exact(c: Column, value: Column) -> Column:
    """Non-overlapping occurrences of a literal; none for an empty one."""
    t, v = text(c), text(value)
    return F.when(F.length(v) == 0, F.lit(0)).otherwise(((F.length(t) - F.length(F.replace(t, v, F.lit("")))) / F.greatest(F.length(v), F.lit(1))).cast("int"))


def blank_out(c: Column, pattern: str) -> Column:
    """Matches replaced by as many spaces, so that offsets stay."""
    between = F.split(text(c), pattern, -1)
    blanks = F.transform(F.regexp_extract_all(text(c), F.lit(pattern), F.lit(0)), lambda m: F.repeat(F.lit(" "), F.length(m)))
    return F.array_join(F.zip_with(between, blanks, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")


def utf16_length(c: Column) -> Column:
    return (F.octet_length(F.encode(text(c), "UTF-16BE")) / 2).cast("long")


# --- small numbers ----------------------------------------------------------


def version_parts(c: Column) -> Column:
    """Dotted version as numbers, comparable with < and >."""
    return F.transform(F.split(text(c), r"\."), lambda p: p.cast("long"))


def column_index(address: Column) -> Column:
    """Zero-based column of a cell address such as "AB12"."""
    letters = F.split(F.regexp_extract(F.upper(address), r"\A([A-Z]+)", 1), "")
    value = F.aggregate(F.filter(letters, lambda x: x != ""), F.lit(0), lambda acc, x: acc * 26 + (F.ascii(x) - 64))
    return value - 1


def ordinal(prefix: str, width: int, n: Column) -> Column:
    """prefix and n padded to width; longer numbers are not cut."""
    return F.format_string(f"{prefix}%0{width}d", n)


def size_pair(c: Column) -> Column:
    """"10 pt / 12 pt or 13 pt" as struct(size, leading, alternatives); null
    if it has another form."""
    t = trim(c)
    form = r"(?i)\A([0-9]+(?:\.[0-9]+)?)\s*pt\s*/\s*([0-9]+(?:\.[0-9]+)?)\s*(?:pt)?(.*)\z"
    more = F.regexp_extract_all(F.regexp_extract(t, form, 3), F.lit(r"(?i)(?:or|,)\s*([0-9]+(?:\.[0-9]+)?)\s*pt"), F.lit(1))
    pair = F.struct(
        F.regexp_extract(t, form, 1).try_cast("double").alias("size"),
        F.regexp_extract(t, form, 2).try_cast("double").alias("leading"),
        F.transform(more, lambda x: x.cast("double")).alias("alternatives"),
    )
    return F.when(t.rlike(form), pair)
