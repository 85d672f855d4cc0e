"""Markup stories: indexing, spacing edits in place, reconciliation.

Byte-exact work on one story at a time, in Arrow batches: a story is read by
the standard streaming parser, which also refuses what is not well formed, and
is never serialised again - edits are spliced into the original bytes.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from xml.parsers import expat

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import content_id, text
from ..functions.typography import language_of, matrix_report
from ..sources.files import written
from .segments import ordered_text, prefix_sums

MOST_BYTES, MOST_DEPTH = 8 << 20, 256
SPACES = "    "
BREAKS = "\t\r\n  "
#: Elements that do not end a run of text.
INLINE = {"Content", "CharacterStyleRange", "Properties"}
#: Elements whose text belongs to the layout program.
GENERATED = {"CrossReferenceSource", "TextVariableInstance"}


def id_key(value: str) -> str:
    value = value.strip()
    return (value.lstrip("0") or "0") if value.isascii() and value.isdigit() else value


@dataclass
class Story:
    """Runs of text as (character, first byte, byte after), and counts."""

    runs: list[list[tuple[str, int, int]]] = field(default_factory=list)
    contents: int = 0
    protected: int = 0
    ids: set[str] = field(default_factory=set)


def parse_story(raw: bytes, protected_ids: Sequence[str] = (), protected_styles: Sequence[str] = ()) -> Story:
    """Runs of editable text of a story.

    ValueError for what is not well formed, a document type, an element inside
    Content, Content outside a paragraph, repeated ids, or over the bounds.
    """
    if len(raw) > MOST_BYTES:
        raise ValueError("story is over the byte bound")
    story, run, stack = Story(), [], []
    guarded, styles = {id_key(i) for i in protected_ids}, {"Credits", *protected_styles}
    parser = expat.ParserCreate(encoding="UTF-8")
    parser.buffer_text = False

    def end_run():
        nonlocal run
        if run:
            story.runs.append(run)
            run = []

    def blocked_above() -> bool:
        return any(b for _, b in stack)

    def in_properties() -> bool:
        return any(n == "Properties" for n, _ in stack)

    def opened(name, attributes):
        if stack and stack[-1][0] == "Content":
            raise ValueError("element inside Content")
        style = attributes.get("AppliedParagraphStyle", "").rsplit("/", 1)[-1]
        ident = attributes.get("id", "")
        blocked = name in GENERATED or (name == "ParagraphStyleRange" and style in styles) or (name == "Content" and bool(ident) and id_key(ident) in guarded)
        if blocked or (name not in INLINE and not in_properties()):
            end_run()
        if name == "Content":
            story.contents += 1
            if ident:
                if id_key(ident) in story.ids:
                    raise ValueError(f"repeated content id {ident}")
                story.ids.add(id_key(ident))
            if not any(n == "ParagraphStyleRange" for n, _ in stack):
                raise ValueError("Content outside a paragraph")
            story.protected += blocked or blocked_above()
        stack.append((name, blocked))
        if len(stack) > MOST_DEPTH:
            raise ValueError("story is nested too deeply")

    def closed(name):
        stack.pop()
        if name not in INLINE and not in_properties():
            end_run()

    def characters(data):
        if not stack or stack[-1][0] != "Content" or blocked_above():
            return
        at = parser.CurrentByteIndex
        if raw[at : at + 1] == b"&":
            put(data, at, raw.index(b";", at) + 1)
            return
        for c in data:
            size = 2 if c == "\n" and raw[at : at + 2] == b"\r\n" else len(c.encode())
            put(c, at, at + size)
            at += size

    def put(c, start, end):
        if c in BREAKS:
            end_run()
        else:
            run.append((c, start, end))

    def refuse(*_):
        raise ValueError("document types are not accepted")

    def opaque(*_):
        end_run()

    def cdata():
        if stack and stack[-1][0] == "Content":
            raise ValueError("CDATA inside Content")
        end_run()

    parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = opened, closed, characters
    parser.StartDoctypeDeclHandler = refuse
    parser.ProcessingInstructionHandler = parser.CommentHandler = opaque
    parser.StartCdataSectionHandler = cdata
    try:
        parser.Parse(raw, True)
    except expat.ExpatError as e:
        raise ValueError(f"story is not well formed: {e}") from e
    end_run()
    if not story.contents:
        raise ValueError("story has no Content")
    return story


def spacing_edits(run: list[tuple[str, int, int]], revised: str) -> list[tuple[int, int, str]]:
    """(start, end, text) that turn a run into ``revised``, which may differ
    in spaces only; a run of spaces keeps the place of its first one."""

    def gaps(chars):
        held, out = [], []
        for i, c in enumerate(chars):
            if c in SPACES:
                held.append(i)
            else:
                out.append((held, i))
                held = []
        return [*out, (held, None)]

    old = [c for c, _, _ in run]
    a, b = gaps(old), gaps(revised)
    if [old[i] for _, i in a[:-1]] != [revised[i] for _, i in b[:-1]]:
        raise ValueError("revision changes more than spaces")
    edits = []
    for (mine, at), (new, _) in zip(a, b):
        put = "".join(revised[i] for i in new)
        if put == "".join(old[i] for i in mine):
            continue
        if mine:
            edits += [(run[i][1], run[i][2], put if i == mine[0] else "") for i in mine]
        else:
            place = run[at][1] if at is not None else run[-1][2]
            edits.append((place, place, put))
    return edits


def splice(raw: bytes, edits: Sequence[tuple[int, int, str]]) -> bytes:
    """Apply edits (start, end, text); ValueError if any overlap."""
    out, last = [], 0
    for start, end, put in sorted(edits, key=lambda e: e[:2]):
        if start < last:
            raise ValueError("overlapping edits")
        out += [raw[last:start], put.encode()]
        last = end
    return b"".join([*out, raw[last:]])


def typeset(xml: str, language: str, protected_ids: Sequence[str] = (), protected_styles: Sequence[str] = (), protected_strings: Sequence[str] = ()) -> tuple[str, list[tuple[str, int, int]]]:
    """Story with the typography matrix applied to each run of text, and
    (rule, matches, changes). The result is parsed again before it is used."""
    raw = xml.encode()
    story = parse_story(raw, protected_ids, protected_styles)
    totals: dict[str, list[int]] = {}
    edits = []
    for run in story.runs:
        revised, counts = matrix_report("".join(c for c, _, _ in run), language, protected_strings)
        for rule, matches, changes in counts:
            sums = totals.setdefault(rule, [0, 0])
            sums[0] += matches
            sums[1] += changes
        edits += spacing_edits(run, revised)
    out = splice(raw, edits)
    if edits:
        parse_story(out, protected_ids, protected_styles)
    return out.decode(), [(k, *v) for k, v in totals.items()]


def typeset_stories(stories: DataFrame, language: str, protected_ids: Sequence[str] = (), protected_styles: Sequence[str] = (), protected_strings: Sequence[str] = ()) -> DataFrame:
    """``stories`` with ``typeset``, ``changed``, ``report`` and ``error``."""
    name = language_of(language)

    @F.pandas_udf("typeset string, changed boolean, report array<struct<rule:string,matches:int,changes:int>>, error string")
    def run(xmls: pd.Series) -> pd.DataFrame:
        rows = []
        for xml in xmls:
            try:
                new, report = typeset(xml or "", name, protected_ids, protected_styles, protected_strings)
                rows.append((new, new != xml, report, None))
            except ValueError as e:
                rows.append((xml, False, [], str(e)))
        return pd.DataFrame(rows, columns=["typeset", "changed", "report", "error"])

    return stories.withColumn("_t", run.asNondeterministic()("xml")).select(*stories.columns, "_t.*")


# --- indexing ---------------------------------------------------------------

_TOKENS = regex.compile(r"<(/?)(ParagraphStyleRange|Content)\b([^>]*?)(/?)>")


def _marks(xml: str):
    """(tag, text) of each outer paragraph (text None) and each Content, in
    order; what lies in a Content is its text."""
    depth = skip = 0
    for m in _TOKENS.finditer(xml):
        if m.start() < skip:
            continue
        close, name, _, empty = m.groups()
        if name == "ParagraphStyleRange":
            if close:
                depth -= 1
                if depth < 0:
                    raise ValueError("paragraph closes twice")
            elif not empty:
                depth += 1
                if depth == 1:
                    yield m, None
        elif not close:
            if not depth:
                raise ValueError("Content outside a paragraph")
            end = m.end() if empty else xml.find("</Content>", m.end())
            if end < 0:
                raise ValueError("Content does not end")
            skip = end
            yield m, xml[m.end() : end].replace("\r\n", "\n")
    if depth:
        raise ValueError("paragraph does not end")


def index_story(xml: str) -> tuple[int, list[tuple[int, int, str]]]:
    """Number of outer paragraphs, and (paragraph, content, text) of each
    Content, both numbered in the file; paragraphs within a table stay in the
    outer one, empty texts are kept."""
    rows, paragraphs = [], 0
    for _, value in _marks(xml):
        if value is None:
            paragraphs += 1
        else:
            rows.append((paragraphs - 1, len(rows), value))
    return paragraphs, rows


def number_story(xml: str, first_paragraph: int, first_content: int) -> str:
    """Story with ids on its outer paragraphs and contents, line ends of
    contents as line feeds."""
    out, last, p, c = [], 0, first_paragraph, first_content
    for m, value in _marks(xml):
        _, name, rest, empty = m.groups()
        ident = f' id="{p if value is None else c:05d}"'
        p, c = (p + 1, c) if value is None else (p, c + 1)
        new, n = regex.subn(r'\sid\s*=\s*"[^"]*"', ident, rest, count=1)
        out += [xml[last : m.start()], f"<{name}{new if n else ident + rest}{empty}>", value or ""]
        last = m.end() if value is None or empty else xml.find("</Content>", m.end())
    return "".join([*out, xml[last:]])


def index_stories(stories: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(content rows, numbered stories) of stories (file_no, file_name, xml).

    Ids run over all files: each file is counted once, a prefix sum over the
    counts gives its first numbers.
    """
    @F.pandas_udf("paragraphs int, rows array<struct<paragraph:int,content:int,text:string>>")
    def rows_of(xmls: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([index_story(x) for x in xmls], columns=["paragraphs", "rows"])

    @F.pandas_udf("string")
    def numbered(xmls: pd.Series, p: pd.Series, c: pd.Series) -> pd.Series:
        return pd.Series([number_story(x, int(a), int(b)) for x, a, b in zip(xmls, p, c)], dtype=object)

    found = stories.withColumn("_r", rows_of.asNondeterministic()("xml"))
    sizes = found.select("file_no", F.size("_r.rows").alias("c"), F.col("_r.paragraphs").alias("p"))
    # Written, because a prefix sum reads its rows several times.
    firsts = prefix_sums(written(sizes, "sizes"), "file_no", ["p", "c"]).select("file_no", F.col("before_p").alias("_p"), F.col("before_c").alias("_c"))
    joined = found.join(firsts, "file_no")
    each = joined.select("file_no", "file_name", "_p", "_c", F.explode("_r.rows").alias("r"))
    key = F.col("_p") + F.col("r.paragraph")
    flat = each.select("file_no", "file_name", key.alias("paragraph"), (F.col("_c") + F.col("r.content")).alias("pos"), F.col("r.text").alias("content"))
    heads = flat.groupBy("paragraph").agg(F.min("pos").alias("pos"), ordered_text("pos", F.col("content")).alias("psr_content"))
    rows = flat.join(heads, ["paragraph", "pos"], "left")
    pad = lambda c: F.format_string("%05d", c)
    rows = rows.select("file_no", "file_name", (F.col("pos") + 1).alias("row_no"), F.when(F.col("psr_content").isNotNull(), pad(F.col("paragraph"))).otherwise("").alias("psr_id"), text(F.col("psr_content")).alias("psr_content"), pad(F.col("pos")).alias("content_tag"), "content")
    return rows, joined.select("file_no", "file_name", numbered.asNondeterministic()("xml", "_p", "_c").alias("xml"))


def content_units(stories: DataFrame) -> DataFrame:
    """(file_name, pos, content_id, content) by a plain scan of elements."""
    pattern = r'(?s)<Content\b([^>]*?)(?:/>|>(.*?)</Content>)'
    both = F.arrays_zip(F.regexp_extract_all("xml", F.lit(pattern), F.lit(1)).alias("tag"), F.regexp_extract_all("xml", F.lit(pattern), F.lit(2)).alias("body"))
    each = stories.select("file_name", F.posexplode(both).alias("pos", "x"))
    ident = content_id(F.regexp_extract("x.tag", r'\bid\s*=\s*"([^"]*)"', 1))
    return each.select("file_name", "pos", ident.alias("content_id"), F.replace("x.body", F.lit("\r\n"), F.lit("\n")).alias("content"))


def panel_content(stories: DataFrame) -> DataFrame:
    """Content units inside generated cross references."""
    inner = F.regexp_extract_all("xml", F.lit(r"(?s)<CrossReferenceSource\b[^>]*>(.*?)</CrossReferenceSource>"), F.lit(1))
    return content_units(stories.select("file_name", F.explode(inner).alias("xml"))).select("file_name", "content_id", F.col("content").alias("text"))


def styled_paragraphs(stories: DataFrame) -> DataFrame:
    """(file_name, pos, style, xml) of the paragraphs without nesting."""
    pattern = r'(?s)<ParagraphStyleRange\b([^>]*)>(.*?)</ParagraphStyleRange>'
    both = F.arrays_zip(F.regexp_extract_all("xml", F.lit(pattern), F.lit(1)).alias("tag"), F.regexp_extract_all("xml", F.lit(pattern), F.lit(2)).alias("body"))
    each = stories.select("file_name", F.posexplode(both).alias("pos", "x"))
    return each.select("file_name", "pos", F.regexp_extract("x.tag", r'AppliedParagraphStyle\s*=\s*"([^"]*)"', 1).alias("style"), F.col("x.body").alias("xml"))


def replace_contents(stories: DataFrame, values: DataFrame) -> DataFrame:
    """``stories`` with the texts of ``values`` (file_name, content_id, text)
    put in their Content elements; texts must be escaped. Values reach their
    file by a join on the file, so nothing is broadcast."""
    packed = values.groupBy("file_name").agg(F.map_from_entries(F.collect_list(F.struct("content_id", "text"))).alias("_v"))
    pattern = regex.compile(r"(?s)<Content\b([^>]*?)(?:/>|>(.*?)</Content>)")

    @F.pandas_udf("string")
    def run(xmls: pd.Series, maps: pd.Series) -> pd.Series:
        def one(xml, new):
            new = dict(new) if new is not None else {}

            def put(m):
                ident = regex.search(r'\bid\s*=\s*"([^"]*)"', m[1])
                key = id_key(ident[1]) if ident else ""
                return f"<Content{m[1]}>{new[key]}</Content>" if key in new else m[0]

            return pattern.sub(put, xml) if new else xml

        return pd.Series([one(x, v) for x, v in zip(xmls, maps)], dtype=object)

    return stories.join(packed, "file_name", "left").withColumn("xml", run.asNondeterministic()("xml", "_v")).drop("_v")


# --- reconciliation ---------------------------------------------------------

#: Elements whose ids the layout program may deal anew.
RENUMBERED = {"Table", "Row", "Column", "Cell", "CrossReferenceSource", "TextVariableInstance", "Hyperlink"}
#: Parts of the metadata that it draws anew.
PREVIEWS = {"xmp:Thumbnails", "xmp:PageInfo"}
_TAG = regex.compile(rb"""<(?:[^<>"']|"[^"]*"|'[^']*')*>""")
_LOCAL_ID = regex.compile(r"u\w+")
_PAGE = regex.compile("[0-9A-Za-z–-]+")


@dataclass
class Node:
    """Element with its byte offsets: opening tag, content, closing tag.
    Texts, comments and processing instructions are children as strings."""

    name: str
    attributes: dict[str, str]
    start: int
    inner: int
    close: int = 0
    end: int = 0
    children: list = field(default_factory=list)

    def walk(self):
        """The elements below, in document order."""
        for child in self.children:
            if isinstance(child, Node):
                yield child
                yield from child.walk()

    def all(self, name: str) -> list[Node]:
        return [n for n in self.walk() if n.name == name]


def parse_tree(raw: bytes) -> Node:
    """Tree of a story; ValueError if it is not well formed, too large, too
    deep, or has a document type."""
    if len(raw) > MOST_BYTES:
        raise ValueError("story is over the byte bound")
    root = Node("", {}, 0, 0, len(raw), len(raw))
    stack = [root]
    parser = expat.ParserCreate(encoding="UTF-8")

    def opened(name, attributes):
        at = parser.CurrentByteIndex
        node = Node(name, attributes, at, _TAG.match(raw, at).end())
        stack[-1].children.append(node)
        stack.append(node)
        if len(stack) > MOST_DEPTH:
            raise ValueError("story is nested too deeply")

    def closed(name):
        node = stack.pop()
        if raw[node.inner - 2 : node.inner] == b"/>":
            node.close = node.end = node.inner
        else:
            node.close = parser.CurrentByteIndex
            node.end = raw.index(b">", node.close) + 1

    def refuse(*_):
        raise ValueError("document types are not accepted")

    def put(piece):
        stack[-1].children.append(piece)

    parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = opened, closed, put
    parser.StartDoctypeDeclHandler = refuse
    parser.ProcessingInstructionHandler = lambda target, data: put(f"<?{target} {data}?>")
    parser.CommentHandler = lambda data: put(f"<!--{data}-->")
    try:
        parser.Parse(raw, True)
    except expat.ExpatError as e:
        raise ValueError(f"story is not well formed: {e}") from e
    return root


def _renumbering(before: Node, after: Node) -> dict[str, str]:
    """Ids of ``after`` as they are in ``before``: the elements with an id
    pair off in order, names agree, and only local ids of renumbered kinds
    may differ."""
    mine, theirs = ([n for n in t.walk() if "Self" in n.attributes] for t in (before, after))
    if [n.name for n in mine] != [n.name for n in theirs]:
        raise ValueError("objects or their order differ")
    pairs = [(a.name, a.attributes["Self"], b.attributes["Self"]) for a, b in zip(mine, theirs)]
    fixed = [a for name, a, b in pairs if a != b and not (name in RENUMBERED and _LOCAL_ID.fullmatch(a) and _LOCAL_ID.fullmatch(b))]
    if fixed:
        raise ValueError(f"identity of a shared object differs: {fixed[0]}")
    forth = {b: a for _, a, b in pairs}
    if len({a for _, a, _ in pairs}) != len(pairs) or len(forth) != len(pairs):
        raise ValueError("repeated object identity")
    return forth


def _by_name(tree: Node) -> dict[str, Node]:
    """References by name; unnamed, repeated or nested ones are refused."""
    found = tree.all("CrossReferenceSource")
    names = [n.attributes.get("Name") for n in found]
    if not all(names) or len(set(names)) != len(names) or any(n.all("CrossReferenceSource") for n in found):
        raise ValueError("reference without a name, repeated, or nested")
    return dict(zip(names, found))


def _metadata(tree: Node) -> list:
    """The metadata packets without previews; attribute order is free."""

    def shape(node):
        return (node.name, node.attributes, [c.strip() if isinstance(c, str) else shape(c) for c in node.children if not (isinstance(c, str) and not c.strip()) and getattr(c, "name", "") not in PREVIEWS])

    return [shape(n) for n in tree.all("x:xmpmeta")]


def _heights_agree(before: Node, after: Node) -> None:
    """Row heights may be computed anew, within what the row allows."""
    for a, b in zip(before.all("Row"), after.all("Row")):
        old, new = (n.attributes.get("SingleRowHeight") for n in (a, b))
        if old != new:
            try:
                height, least = float(new), float(b.attributes.get("MinimumHeight", 0))
            except (TypeError, ValueError):
                height, least = 0.0, 0.0
            if not (0 < height < float("inf")) or height < least:
                raise ValueError("computed row height is not valid")


def _skeleton(tree: Node, ids: dict[str, str]) -> list:
    """Everything that both versions must share, as a flat list: no metadata,
    no reference texts and formats, no index ids and row heights, no blanks
    between elements, neighbouring contents as one, no empty unindexed content
    that follows a table."""
    out: list = []

    def follows_table(siblings: list, i: int) -> bool:
        node = siblings[i]
        if node.name != "Content" or node.attributes or node.children:
            return False
        solid = [c for c in siblings if not (isinstance(c, str) and not c.strip())]
        at = next(k for k, c in enumerate(solid) if c is node)
        after = solid[at + 1] if at + 1 < len(solid) else None
        return at > 0 and getattr(solid[at - 1], "name", "") == "Table" and (after is None or getattr(after, "name", "") == "Br")

    def put(node: Node) -> None:
        if node.name in ("CrossReferenceFormat", "x:xmpmeta"):
            return
        dropped = {"ParagraphStyleRange": {"id"}, "Content": {"id"}, "Row": {"SingleRowHeight"}}.get(node.name, set())
        kept = {k: ids.get(v, v) if k in ("Self", "Source") else v for k, v in node.attributes.items() if k not in dropped}
        joins = node.name == "Content" and not kept and out and out[-1] == ("end", "Content")
        if joins:
            out.pop()
        else:
            out.append(("start", node.name, kept))
        for i, child in enumerate(node.children if node.name != "CrossReferenceSource" else []):
            if isinstance(child, Node):
                if not follows_table(node.children, i):
                    put(child)
            elif node.name == "Content":
                if out[-1][0] == "text":
                    child = out.pop()[1] + child
                out.append(("text", child))
            elif child.strip():
                out.append(("other", child.strip()))
        out.append(("end", node.name))

    put(tree)
    return out


def reconcile(before: str, after: str, allowed: Sequence[str]) -> str:
    """``before`` with the texts and page numbers that ``after`` gives the
    allowed references. ValueError if anything else differs."""
    raws = [before.encode(), after.encode()]
    old, new = map(parse_tree, raws)
    if len(old.all("x:xmpmeta")) > 1 or _metadata(old) != _metadata(new):
        raise ValueError("metadata differs")
    ids = _renumbering(old, new)
    _heights_agree(old, new)
    if _skeleton(old, {}) != _skeleton(new, ids):
        raise ValueError("text or structure outside references differs")
    mine, theirs = _by_name(old), _by_name(new)
    if set(mine) != set(theirs):
        raise ValueError("set of references differs")
    if not set(allowed) <= set(mine):
        raise ValueError("allowed reference is not in the story")
    edits = []
    for name in dict.fromkeys(allowed):
        edits += _reference_edits(name, mine[name], theirs[name], *raws)
    return splice(raws[0], sorted(edits)).decode()


def _reference_edits(name: str, mine: Node, theirs: Node, raw: bytes, other: bytes) -> list[tuple[int, int, str]]:
    """Edits of ``raw`` that give a reference the results of its other version."""
    texts, numbers = ([n.all(kind) for n in (mine, theirs)] for kind in ("Content", "TextVariableInstance"))
    if len(texts[0]) != len(texts[1]) or [len(n) for n in numbers] != [1, 1]:
        raise ValueError(f"shape of reference {name} differs")
    page = numbers[1][0].attributes.get("ResultText", "")
    if not _PAGE.fullmatch(page) or any(isinstance(c, Node) for t in texts[1] for c in t.children):
        raise ValueError(f"unresolved result in reference {name}")
    edits = []
    for a, b in zip(*texts):
        put = other[b.inner : b.close].decode()
        if a.inner == a.end and put:
            raise ValueError(f"empty segment of reference {name} gained text")
        edits.append((a.inner, a.close, put))
    tag = numbers[0][0]
    at = regex.search(rb'\bResultText="([^"]*)"', raw[tag.start : tag.inner])
    edits.append((tag.start + at.start(1), tag.start + at.end(1), page))
    return edits


def reconcile_stories(pairs: DataFrame, allowed: Sequence[str]) -> DataFrame:
    """``pairs`` (before, after) with ``xml`` or ``error``."""

    @F.pandas_udf("xml string, error string")
    def run(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        rows = []
        for x, y in zip(a, b):
            try:
                rows.append((reconcile(x, y, allowed), None))
            except ValueError as e:
                rows.append((None, str(e)))
        return pd.DataFrame(rows, columns=["xml", "error"])

    return pairs.withColumn("_r", run.asNondeterministic()("before", "after")).select(*pairs.columns, "_r.*")


# --- repair -----------------------------------------------------------------


def realign(composite: str, segments: Sequence[str], is_error) -> list[str]:
    """Segments that join to the composite again, where a spreadsheet ate an
    equation: an error literal becomes the gap it left, a lost "=" prefix
    comes back. ValueError where the gap is ambiguous or no equation."""
    out, at, hole = list(segments), 0, None
    for i, s in enumerate([*segments, None]):
        if s is not None and is_error(s):
            if hole is not None:
                raise ValueError("two error cells in a row")
            hole = i
            continue
        place = len(composite) if s is None else composite.find(s, at)
        if place < 0:
            raise ValueError("segment is not in the composite")
        gap = composite[at:place]
        if hole is not None:
            if not gap.lstrip().startswith("="):
                raise ValueError("recovered text is no equation")
            out[hole], hole = gap, None
        elif gap:
            if s is None or not regex.fullmatch(r"=\s*", gap):
                raise ValueError("unexpected text between segments")
            out[i] = gap + s
        at = place + len(s or "")
    return out


def recover_groups(groups: DataFrame) -> DataFrame:
    """``groups`` (composite, segments) with ``recovered`` or ``error``."""
    from ..functions.text import ERROR_LITERALS

    @F.pandas_udf("recovered array<string>, error string")
    def run(composites: pd.Series, segments: pd.Series) -> pd.DataFrame:
        rows = []
        for c, s in zip(composites, segments):
            try:
                rows.append((realign(c, list(s), lambda x: x.strip().upper() in ERROR_LITERALS), None))
            except ValueError as e:
                rows.append((None, str(e)))
        return pd.DataFrame(rows, columns=["recovered", "error"])

    return groups.withColumn("_r", run.asNondeterministic()("composite", "segments")).select(*groups.columns, "_r.*")
