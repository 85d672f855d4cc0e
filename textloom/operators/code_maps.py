"""Bytes of embedded fonts as text: a font's code map is a table of ranges,
and the codes that texts use are looked up in it by a join.

Only built-in expressions are used. What a drawing program does with the text
is not read here; bytes and maps are columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import let
from .intervals import overlapping

# What the code page has at 0x80 to 0x9F; five places are void.
CP1252 = "€\x81‚ƒ„…†‡ˆ‰Š‹Œ\x8dŽ\x8f\x90‘’“”•–—˜™š›œ\x9džŸ"
VOID = "\x81\x8d\x8f\x90\x9d"
_HEX = "<([0-9A-Fa-f]+)>"
_SPACE = "[\\t-\\r\\x1c-\\x20\\x85\\xa0]*"
_LOST = 0xFFFD


def character(point: Column) -> Column:
    """The character of a code point; of a surrogate, or a number that is no
    code point, U+FFFD."""
    p = F.when(point.between(0xD800, 0xDFFF) | (point > 0x10FFFF) | (point < 0), F.lit(_LOST)).otherwise(point).cast("long")
    tail = lambda bits: F.shiftright(p, bits).bitwiseAND(F.lit(0x3F)) + 0x80
    lead = lambda bits, mark: F.shiftright(p, bits) + mark
    two = lambda *parts: F.concat(*(F.lpad(F.hex(x), 2, "0") for x in parts))
    utf8 = F.when(p < 0x80, two(p)).when(p < 0x800, two(lead(6, 0xC0), tail(0))).when(p < 0x10000, two(lead(12, 0xE0), tail(6), tail(0))).otherwise(two(lead(18, 0xF0), tail(12), tail(6), tail(0)))
    return F.decode(F.unhex(utf8), "UTF-8")


def _fours(digits: Column) -> Column:
    """Numbers of four hexadecimal digits each; what is left is left out."""
    return F.transform(F.regexp_extract_all(digits, F.lit("[0-9A-Fa-f]{4}"), F.lit(0)), lambda x: F.conv(x, 16, 10).cast("int"))


def points(digits: Column) -> Column:
    """Code points of UTF-16 given as hexadecimal digits: a surrogate without
    its partner, or a byte alone at the end, is U+FFFD. Fewer than two bytes,
    or half a byte, are nothing."""
    n = F.length(digits)
    high, low = (lambda u: u.between(0xD800, 0xDBFF)), (lambda u: u.between(0xDC00, 0xDFFF))

    def point(units, u, i):
        after, before = F.get(units, i + 1), F.get(units, i - 1)
        joined = (u - 0xD800) * 0x400 + (after - 0xDC00) + 0x10000
        eaten = low(u) & F.coalesce(high(before), F.lit(False))
        return F.when(high(u) & F.coalesce(low(after), F.lit(False)), joined).when(eaten, F.lit(-1)).when(high(u) | low(u), F.lit(_LOST)).otherwise(u)

    bound = let(_fours(digits), lambda units: F.transform(units, lambda u, i: point(units, u, i)))
    known = F.filter(bound, lambda p: p >= 0)
    whole = F.concat(known, F.when(n % 4 == 2, F.array(F.lit(_LOST))).otherwise(F.array().cast("array<int>")))
    return F.when((n >= 4) & (n % 2 == 0), whole).otherwise(F.array().cast("array<int>"))


def code_ranges(fonts: DataFrame, font: str = "font", cmap: str = "cmap") -> DataFrame:
    """(font, first, last, rank, base, target) of the code maps of fonts.

    Single codes have ``target``, their text. Ranges have ``base``, the code
    point of their first code; a range onto more or less than one character
    is left out. Of entries for one code the one with the highest rank holds:
    ranges before single codes, later before earlier. Null maps, and what is
    no entry, give no rows; codes of over eight digits are left out.
    """
    text = F.decode(F.col(cmap).cast("binary"), "ISO-8859-1")

    def entries(kind: str, width: int, order: int) -> DataFrame:
        pattern = _SPACE.join([_HEX] * width)
        blocks = fonts.select(font, F.posexplode(F.regexp_extract_all(text, F.lit(f"(?s)beginbf{kind}(.*?)endbf{kind}"), F.lit(1))).alias("block", "body"))
        found = blocks.select(font, "block", F.posexplode(F.arrays_zip(*(F.regexp_extract_all("body", F.lit(pattern), F.lit(i + 1)).alias(f"x{i}") for i in range(width)))).alias("at", "x"))
        code = lambda i: F.when(F.length(F.regexp_replace(F.col(f"x.x{i}"), "^0+", "")) <= 8, F.conv(F.col(f"x.x{i}"), 16, 10).cast("long"))
        rank = F.struct(F.lit(order).alias("kind"), "block", "at")
        return found.select(font, code(0).alias("first"), code(width - 2).alias("last"), rank.alias("rank"), points(F.col(f"x.x{width - 1}")).alias("p"))

    chars = entries("char", 2, 0).select(font, "first", F.col("first").alias("last"), "rank", F.lit(None).cast("int").alias("base"), F.array_join(F.transform("p", character), "").alias("target"))
    ranges = entries("range", 3, 1).where("size(p) = 1 and last >= first").select(font, "first", "last", "rank", F.col("p")[0].alias("base"), F.lit(None).cast("string").alias("target"))
    return chars.unionByName(ranges).where("first is not null and last is not null")


def _single(data: Column) -> Column:
    """Bytes in the code page, or as they are where one of them is void in it."""
    plain = F.decode(data, "ISO-8859-1")
    return F.when(plain.rlike(f"[{VOID}]"), plain).otherwise(F.translate(plain, "".join(map(chr, range(0x80, 0xA0))), CP1252))


def _dense(entries: Column) -> Column:
    """Glyphs by code, from entries in the order of their codes: a place in an
    array is found at once, however many codes there are."""
    gap = lambda e, i: e["code"] - F.coalesce(F.get(entries, i - 1)["code"], F.lit(-1)) - 1
    return F.flatten(F.transform(entries, lambda e, i: F.concat(F.array_repeat(F.lit(""), gap(e, i)), F.array(e["glyph"]))))


def decoded(texts: DataFrame, fonts: DataFrame, data: str = "data", font: str = "font", name: str = "text") -> DataFrame:
    """``texts`` (font, data: binary) with their text under ``name``.

    ``fonts`` has (font, bytes_per_code, cmap), a row a font. Two-byte codes
    are looked up in the font's map, unknown ones are dropped; other bytes are
    in a code page, also those of unknown fonts. Null data stay null.

    Equal data of a font are decoded once. Each distinct code of a text is a
    row of the lookup, so a text is not repeated by its codes; a code of most
    texts is a hot key of a sort-merge join with one row a key on the other
    side, which adaptive execution splits.
    """
    wide = fonts.where("bytes_per_code = 2").select(F.col(font).alias("_font"), "cmap")
    keyed = texts.join(wide.select("_font", F.lit(True).alias("_wide")), F.col(font) == F.col("_font"), "left").drop("_font")
    keyed = keyed.withColumn("_key", F.when(F.col("_wide"), F.sha2(F.concat(F.encode(F.col(font).cast("string"), "UTF-8"), F.lit(b"\x00"), F.col(data)), 256)))
    used = keyed.where("_key is not null").select("_key", F.col(font).alias("_font"), F.explode(F.array_distinct(_fours(F.hex(data)))).alias("code")).distinct()
    ranges = code_ranges(wide, "_font").withColumn("start", F.col("first")).withColumn("end", F.col("last") + 1)
    asked = used.select("_font", "code").distinct().withColumn("start", F.col("code").cast("long")).withColumn("end", F.col("start") + 1)
    pairs = overlapping(asked, ranges, ["_font"])
    held = pairs.select("_font", "left.code", *(f"right.{c}" for c in ("first", "base", "target", "rank"))).groupBy("_font", "code").agg(F.max_by(F.struct("first", "base", "target"), "rank").alias("r"))
    glyphs = held.select("_font", "code", F.coalesce("r.target", character(F.col("r.base") + F.col("code") - F.col("r.first"))).alias("glyph"))
    maps = used.join(glyphs.hint("merge"), ["_font", "code"]).groupBy("_key").agg(F.sort_array(F.collect_list(F.struct("code", "glyph"))).alias("_list"))
    # At most 65,536 entries. Short lists, of short texts, stay maps.
    few = F.size("_list") <= 64
    maps = maps.select("_key", F.when(few, F.map_from_entries("_list")).alias("_map"), F.when(~few, _dense(F.col("_list"))).alias("_array"))
    joined = keyed.join(maps.hint("merge"), "_key", "left")
    codes = _fours(F.hex(data))
    by_map = F.transform(codes, lambda c: F.coalesce(F.try_element_at("_map", c), F.lit("")))
    by_place = F.transform(codes, lambda c: F.coalesce(F.get("_array", c), F.lit("")))
    double = F.coalesce(F.array_join(F.when(F.col("_array").isNotNull(), by_place).otherwise(by_map), ""), F.lit(""))
    out = F.when(F.col(data).isNull(), F.lit(None).cast("string")).when(F.col("_wide"), double).otherwise(_single(F.col(data)))
    return joined.withColumn("_text", out).select(*(F.col(c) for c in texts.columns if c != name), F.col("_text").alias(name))
