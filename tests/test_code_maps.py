"""Code maps of fonts against a plain reading of them."""

import re

from pyspark.sql import functions as F

from textloom.operators import code_maps

MAP = b"""/CIDInit begincmap 3 beginbfchar
<0041> <0058>
<0042><00660069>
<0043> <D83DDE00>
<0044>\x85<D83D0041>
<0045> <41>
<0046> <004100>
<0047> <00>
<0020> <0020>
endbfchar
2 beginbfrange
<0061> <007A> <0041>
<0062> <0062> <00e9>
<0100> <FFFF> <D83DDE00>
<0200> <01FF> <0041>
<0300> <0310> <00410042>
endbfrange 1 beginbfchar <0063> <0021> <0041> <0059> endbfchar
beginbfrange <0064><0066>[<0031> <0032> <0033>] endbfrange
endcmap"""


def plain_map(raw):
    text, table = raw.decode("latin1"), {}
    u16 = lambda h: bytes.fromhex(h).decode("utf-16-be", errors="replace") if len(h) >= 4 else ""
    for block in re.findall("beginbfchar(.*?)endbfchar", text, re.S):
        table.update((int(a, 16), u16(b)) for a, b in re.findall(r"<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]+)>", block))
    for block in re.findall("beginbfrange(.*?)endbfrange", text, re.S):
        for a, b, c in re.findall(r"<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]+)>", block):
            if len(u16(c)) == 1:
                table.update((k, chr(ord(u16(c)) + k - int(a, 16))) for k in range(int(a, 16), int(b, 16) + 1))
    return table


def test_decoded_like_plain_python(spark):
    table = plain_map(MAP)
    every = b"".join(k.to_bytes(2, "big") for k in (*range(0x500), 0xD7FF, 0xD800, 0xFFFE, 0xFFFF))
    rows = [(1, "wide", every), (2, "wide", b"\x00\x41\x00"), (3, "wide", b""), (4, "wide", None), (5, "bare", b"\x00\x41"), (6, "narrow", b"caf\xe9 \x80\x93"), (7, "narrow", b"\x81\x80"), (8, "unknown", b"ab"), (9, None, b"ab"), (10, "wide", b"\x00\x41\x00"), (10, "wide", b"\x00\x41\x00"), (11, "wide", b"\x00\x61" * 300_000)]
    texts = spark.createDataFrame(rows, "id int, font string, data binary").withColumn("code", F.lit("kept"))
    fonts = spark.createDataFrame([("wide", 2, MAP), ("bare", 2, None), ("narrow", 1, MAP)], "font string, bytes_per_code int, cmap binary")
    out = code_maps.decoded(texts, fonts)
    assert out.columns == ["id", "font", "data", "code", "text"]
    got = sorted(((r.id, r.text) for r in out.collect()))
    two = lambda b: "".join(table.get(int.from_bytes(b[i : i + 2], "big"), "") for i in range(0, len(b) - 1, 2))
    want = [(1, two(every)), (2, "Y"), (3, ""), (4, None), (5, ""), (6, "café €“"), (7, "\x81\x80"), (8, "ab"), (9, "ab"), (10, "Y"), (10, "Y"), (11, "A" * 300_000)]
    assert got == want
    assert table[0x42] == "fi" and table[0x43] == "\U0001f600" and table[0x44] == "�A" and table[0x46] == "A�" and table[0x62] == "\xe9"


def test_no_rows(spark):
    fonts = spark.createDataFrame([], "font string, bytes_per_code int, cmap binary")
    texts = spark.createDataFrame([], "font string, data binary")
    assert code_maps.decoded(texts, fonts).collect() == []


def test_points_of_characters(spark):
    at = [0, 0x7F, 0x80, 0x7FF, 0x800, 0xFFFF, 0x10000, 0x10FFFF]
    rows = spark.createDataFrame([(p,) for p in (*at, 0xD800, 0xDFFF, 0x110000)], "p int").select("p", code_maps.character(F.col("p")).alias("c")).collect()
    assert {r.p: r.c for r in rows} == {**{p: chr(p) for p in at}, 0xD800: "�", 0xDFFF: "�", 0x110000: "�"}
