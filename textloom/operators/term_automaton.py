"""All terms of a glossary found in texts by one pass over their words.

The terms' words form a trie, kept as sorted arrays. Texts are cut into words
once, whatever the number of terms, and the words of many texts go down the
trie together, a level at a time; each hit has an offset, and only hits are
compared with the text's characters. A word is visited once for each level
that it gets down, so terms that begin like the text, word for word, cost the
length of what they share.
"""

from __future__ import annotations

import heapq
import re
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import lru_cache
from itertools import accumulate, repeat

import numpy as np
import regex

#: Simple case folds that lower case leaves apart, letter by letter.
FOLD_FROM, FOLD_TO = "ſςµϐϑϕϖϰϱϵẛι", "sσμβθφπκρεṡι"

#: Runs of letters and digits, and every other character but white space;
#: white space stands before the word that it precedes.
_WORDS = regex.compile(r"\s*(?:[\p{L}\p{N}]+|[^\p{L}\p{N}\s])").findall
_PLAIN_WORDS = re.compile(r"[ \t-\r]*(?:[A-Za-z0-9]+|[^ \t-\r])").findall
_WHITE = "".join(regex.findall(r"\s", "".join(map(chr, range(0xD800)))))
#: Runs of ASCII letters and digits, and every other character.
_ASCII_WORDS = re.compile(r"(?s)[a-z0-9]+|[^a-z0-9]").findall
_ASCII_SIDE = re.compile(r"[A-Za-z0-9_]").match
#: Characters of texts whose words go down the trie together, and pieces of
#: texts whose numbers a worker remembers.
BLOCK, REMEMBERED = 1 << 20, 1 << 18


def folded(text: str) -> str:
    """Lower case, and one letter for all that match each other in any case;
    as many characters as before."""
    if text.isascii():
        return text.lower()
    text = text.replace("İ", "i").lower()
    for a, b in zip(FOLD_FROM, FOLD_TO):
        text = text.replace(a, b)  # a search where there is none
    return text


def ascii_folded(text: str) -> str:
    # Bytes have lower case for ASCII letters only.
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def words(text: str) -> list[str]:
    return _PLAIN_WORDS(text) if text.isascii() else _WORDS(text)


def ascii_words(text: str) -> list[str]:
    return _ASCII_WORDS(text)


class _Numbers(dict):
    """Number of a piece: that of its word, if a term has it."""

    def __init__(self, known: dict[str, int], white: str, unknown: Callable[[str], int]):
        self.known, self.white, self.unknown = known, white, unknown

    def __missing__(self, piece: str) -> int:
        word = piece.lstrip(self.white) if self.white else piece
        number = self.known.get(word) or self.unknown(word)
        if len(self) < REMEMBERED:
            self[piece] = number
        return number


class TermAutomaton:
    """Trie of the words of ``terms``.

    ``fold`` must keep offsets and make equal whatever may match; ``cut`` must
    cut every match of a term at its ends, and its pieces, which may begin
    with ``white`` space, follow each other without a gap. Words that no term
    has get the number ``unknown`` gives, 0 or less.
    """

    def __init__(self, terms: Sequence[str], fold: Callable[[str], str] = folded, cut: Callable[[str], list[str]] = words, white: str = _WHITE, unknown: Callable[[str], int] = lambda word: 0):
        self.fold, self.pieces, self.white = fold, cut, white
        pieces: list[str] = []
        n_words = np.zeros(len(terms), np.int64)
        for k, term in enumerate(terms):
            found = cut(fold(term))
            n_words[k] = len(found)
            pieces += found
        bare = list(map(str.lstrip, pieces, repeat(white))) if white else pieces
        known = {word: k for k, word in enumerate(dict.fromkeys(bare), 1)}
        flat, begin = np.fromiter(map(known.__getitem__, bare), np.int64, len(bare)), np.cumsum(n_words) - n_words
        #: White space before the first word.
        lead, some = np.zeros(len(terms), np.int64), np.flatnonzero(n_words)
        lead[some] = [len(pieces[i]) - len(bare[i]) for i in begin[some].tolist()]
        #: Terms without a word: white space only.
        self.wordless: list[int] = np.flatnonzero(n_words == 0).tolist()
        self.longest = int(n_words.max(initial=0))
        self.n_words, self.lead = n_words, lead
        self.long = np.array([0, *map(len, known)], np.int64)
        self.known, self.numbers = known, _Numbers(known, white, unknown)
        self._grow(flat, begin, n_words)

    def _grow(self, flat, begin, n_words) -> None:
        """Edges (node, word) of all levels, one after the other and sorted;
        the edge at place i leads to the node i + 1, the root is 0."""
        self.base = len(self.known) + 1
        levels, made, depth = [np.zeros(0, np.int64)], 0, 0
        terms = np.flatnonzero(n_words > 0)
        node, last = np.zeros(len(terms), np.int64), np.zeros(len(n_words), np.int64)
        self.bounds = [0]
        while len(terms):
            edges, to = np.unique(node * self.base + flat[begin[terms] + depth], return_inverse=True)
            node = to.reshape(-1) + made + 1
            levels.append(edges)
            made, depth = made + len(edges), depth + 1
            self.bounds.append(made)
            ends = n_words[terms] == depth
            last[terms[ends]] = node[ends]
            terms, node = terms[~ends], node[~ends]
        self.edges = np.concatenate(levels)
        held = np.flatnonzero(n_words > 0)
        self.ending = held[np.argsort(last[held], kind="stable")]
        count = np.bincount(last[held], minlength=made + 1)
        self.n_ending, self.first_ending = count, np.cumsum(count) - count
        self.inner = np.zeros(made + 1, bool)
        self.inner[self.edges // self.base] = True

    def hits(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(terms, places of their first words) of all runs of words that are
        those of a term; overlaps are all given."""
        at, node = np.flatnonzero(numbers > 0), None
        none = np.zeros(0, np.int64)
        terms, places = [none], [none]
        for depth in range(self.longest):
            if not len(at):
                break
            word = numbers[at + depth]
            key = word.astype(np.int64) if node is None else node * self.base + word
            lo, hi = self.bounds[depth], self.bounds[depth + 1]
            edge = np.minimum(np.searchsorted(self.edges[lo:hi], key), hi - lo - 1) + lo
            found = (self.edges[edge] == key) & (word > 0)
            at, node = at[found], edge[found] + 1
            n = self.n_ending[node]
            some = np.flatnonzero(n)
            if len(some):
                n, from_ = n[some], self.first_ending[node[some]]
                step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                terms.append(self.ending[np.repeat(from_, n) + step])
                places.append(np.repeat(at[some], n))
            on = self.inner[node] & (at + depth + 1 < len(numbers))
            at, node = at[on], node[on]
        return np.concatenate(terms), np.concatenate(places)

    def cut(self, text: str) -> tuple[list[int], list[int]]:
        """Numbers of the text's words, and where they begin."""
        pieces = self.pieces(self.fold(text))
        ends = accumulate(map(len, pieces))
        return [self.numbers[p] for p in pieces], [end - len(p.lstrip(self.white)) if self.white else end - len(p) for p, end in zip(pieces, ends)]

    def blocks(self, texts: Iterable[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(number of texts, numbers of their words with a 0 on both sides of
        each text, places of their first words, ends of the words in
        characters of the block)."""
        made = lambda n, b, e: (len(b), np.array(n, np.int64), np.array(b, np.int64), np.cumsum(np.array(e, np.int64)))
        numbers, begins, sizes, size = [0], [], [0], 0
        for text in texts:
            pieces = self.pieces(self.fold(text))
            begins.append(len(numbers))
            numbers += map(self.numbers.__getitem__, pieces)
            sizes += map(len, pieces)
            numbers.append(0)
            sizes.append(0)
            size += len(text)
            if size >= BLOCK:
                yield made(numbers, begins, sizes)
                numbers, begins, sizes, size = [0], [], [0], 0
        if begins:
            yield made(numbers, begins, sizes)

    def found(self, texts: Iterable[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(terms, offsets at which they would begin) of each text, by term
        and offset."""
        for n, numbers, begins, ends in self.blocks(texts):
            terms, places = self.hits(numbers)
            nth = np.searchsorted(begins, places, "right") - 1
            at = ends[places] - self.long[numbers[places]] - ends[begins[nth] - 1] - self.lead[terms]
            order = np.lexsort((at, terms, nth))
            terms, at = terms[order], np.maximum(at[order], 0)
            cuts = np.cumsum(np.bincount(nth, minlength=n)).tolist()
            for lo, hi in zip([0, *cuts], cuts):
                yield terms[lo:hi], at[lo:hi]


def _places(pattern, text: str, offsets: Sequence[int]) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches that begin at one of the offsets."""
    out, free = [], 0
    for at in sorted(offsets):
        if at >= free and (m := pattern.match(text, at)):
            out.append(m.span())
            free = m.end()
    return out


@lru_cache(maxsize=4096)
def _sided(character: str) -> bool:
    """Whether no boundary stands between it and a character of its kind."""
    return bool(regex.match(r"[\p{L}\p{M}\p{N}_]", character))


class Claims:
    """Terms that claim places of a text, for (source, contextual, allow_ci)
    in the order in which they claim."""

    def __init__(self, terms: Sequence[tuple[str, bool, bool]], pattern_of):
        self.sources, self.pattern_of = [t[0] for t in terms], pattern_of
        self.asks, self.allow_ci = np.array([not t[1] for t in terms], bool), bytes(bool(t[2]) for t in terms)
        self.automaton = TermAutomaton(self.sources)
        spaced = [s for s in self.sources if " " in s]
        #: Runs of blanks inside terms, with the characters beside them: no
        #: term appears unless blanking makes such a run.
        self.gaps = {(m[1], len(m[2]), m[3]) for s in spaced for m in regex.finditer("([^ ])( +)([^ ])", folded(s), overlapped=True)}
        self.widest = max((g[1] for g in self.gaps), default=0)
        self.blank_ends = bool(self.automaton.wordless) or any(" " in (s[0], s[-1]) for s in spaced)

    def __call__(self, text: str) -> list[tuple[str, str]]:
        """(source, mode), exact claims first."""
        return next(self.many([text]))

    def many(self, texts: Iterable[str]) -> Iterator[list[tuple[str, str]]]:
        """The claims of each text."""
        texts = [t or "" for t in texts]
        if self.blank_ends:
            yield from map(self._blanking, texts)
            return
        for text, (terms, at) in zip(texts, self.automaton.found(texts)):
            asks = self.asks[terms]
            out = self._claimed(text, list(zip(terms[asks].tolist(), at[asks].tolist())))
            yield self._blanking(text) if out is None else out

    def _claimed(self, text: str, hits: list[tuple[int, int]]) -> list[tuple[str, str]] | None:
        """The claims where no term begins or ends with a blank. None if what
        is claimed leaves blanks as a term has them inside.

        Two places that overlap then share a character that is no blank, so a
        term has a place if nothing of it is claimed.
        """
        claimed, taken, out = bytearray(len(text)), set(), []
        for mode in ("exact", "case-insensitive-unique"):
            exact, now = mode == "exact", -1
            for k, at in hits:
                source = self.sources[k]
                if not (text.startswith(source, at) if exact else self.allow_ci[k]):
                    continue
                if k != now and source in taken:
                    continue
                end = at + len(source)
                if claimed.find(1, at, end) >= 0 or not (exact or self._alike(source, text[at:end])):
                    continue
                if at and not claimed[at - 1] and _sided(text[at - 1]) and _sided(source[0]):
                    continue
                if end < len(text) and not claimed[end] and _sided(text[end]) and _sided(source[-1]):
                    continue
                claimed[at:end] = b"\1" * (end - at)
                if k != now:
                    now = k
                    taken.add(source)
                    out.append((source, mode))
                if end - at <= self.widest and self._gap(text, claimed, at, end):
                    return None
        return out

    def _alike(self, source: str, piece: str) -> bool:
        if source.isascii() and piece.isascii():
            return source.lower() == piece.lower()
        return piece == source or bool(self.pattern_of(source, False).fullmatch(piece))

    def _gap(self, text: str, claimed: bytearray, begin: int, end: int) -> bool:
        """Whether the blanks around a claimed place are as inside a term."""
        while begin and (claimed[begin - 1] or text[begin - 1] == " "):
            begin -= 1
        while end < len(text) and (claimed[end] or text[end] == " "):
            end += 1
        return bool(begin) and end < len(text) and (folded(text[begin - 1]), end - begin, folded(text[end])) in self.gaps

    def _runs(self, numbers: list[int], starts: list[int]) -> list[tuple[int, int]]:
        a = self.automaton
        terms, places = a.hits(np.array(numbers, np.int64))
        return [(k, starts[i] - lead) for k, i, lead in zip(terms.tolist(), places.tolist(), a.lead[terms].tolist())]

    def _blanking(self, text: str) -> list[tuple[str, str]]:
        """The claims of any terms. A claimed place is blanked; words on both
        sides of it then stand together, and only there can a term appear that
        was not in the text before."""
        if not text:
            return []
        a = self.automaton
        numbers, starts = a.cut(text)
        places: dict[int, set[int]] = {}
        for term, at in self._runs(numbers, starts):
            places.setdefault(term, set()).add(max(at, 0))
        for term in a.wordless:
            places[term] = set()
        out, left, taken = [], text, set()
        for exact in (True, False):
            queue = sorted(places)
            while queue:
                k = heapq.heappop(queue)
                source = self.sources[k]
                if not self.asks[k] or source in taken or not (exact or self.allow_ci[k]):
                    continue
                pattern = self.pattern_of(source, exact)
                spans = _places(pattern, left, places[k]) if places[k] else [m.span() for m in pattern.finditer(left)]
                if not spans:
                    continue
                out.append((source, "exact" if exact else "case-insensitive-unique"))
                taken.add(source)
                pieces, end = [], 0
                for b, e in spans:
                    pieces += [left[end:b], " " * (e - b)]
                    end = e
                left = "".join(pieces) + left[end:]
                for term in self._joined(spans, numbers, starts, places):
                    if term > k:
                        heapq.heappush(queue, term)
        return out

    def _joined(self, spans, numbers, starts, places) -> list[int]:
        """Blank the words of claimed places; terms that the words around them
        make, now that they follow each other, get their offsets."""
        a, new = self.automaton, []
        for b, e in spans:
            i, j = bisect_left(starts, b), bisect_left(starts, e)
            del numbers[i:j], starts[i:j]
            lo, hi = max(0, i - a.longest + 1), i + a.longest - 1
            for term, at in self._runs(numbers[lo:hi], starts[lo:hi]):
                known = places.setdefault(term, set())
                if max(at, 0) not in known:
                    known.add(max(at, 0))
                    new.append(term)
        return new


class Applying:
    """Terms that a text holds anywhere, exactly or, where allowed, in any case."""

    def __init__(self, terms: Sequence[tuple[str, bool, bool]], pattern_of):
        self.terms, self.pattern_of = list(terms), pattern_of
        self.automaton = TermAutomaton([t[0] for t in self.terms])

    def __call__(self, text: str) -> list[int]:
        out: set[int] = set()
        ((terms, at),) = self.automaton.found([text])
        hits = [*zip(terms.tolist(), at.tolist()), *((k, -1) for k in self.automaton.wordless)]
        for k, at in hits:
            source, contextual, allow_ci = self.terms[k]
            if k in out or contextual:
                continue
            match = (lambda p: p.search(text)) if at < 0 else (lambda p, at=at: p.match(text, at))
            if match(self.pattern_of(source, True)) or (allow_ci and match(self.pattern_of(source, False))):
                out.add(k)
        return sorted(out)


class AsciiPairs:
    """Terms that stand between ASCII boundaries, in any ASCII case; overlaps
    are allowed. White space is a word here, so a hit is an equal string."""

    def __init__(self, terms: Sequence[str]):
        side = lambda word: bool(_ASCII_SIDE(word))
        self.n_terms = max(len(terms), 1)
        self.automaton = TermAutomaton(terms, ascii_folded, ascii_words, "", lambda word: -side(word))
        # By the number of a word; the last is that of other words, -1.
        self.side = np.array([False, *map(side, self.automaton.known), True])

    def __call__(self, text: str) -> list[int]:
        return next(self.many([text]))[1].tolist()

    def many(self, texts: Iterable[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(how many terms each text has, the terms one text after the other)
        of blocks of texts."""
        a = self.automaton
        for n, numbers, begins, _ in a.blocks(texts):
            terms, places = a.hits(numbers)
            free = ~(self.side[numbers[places - 1]] | self.side[numbers[places + a.n_words[terms]]])
            nth = np.searchsorted(begins, places[free], "right") - 1
            nth, terms = np.divmod(np.unique(nth * self.n_terms + terms[free]), self.n_terms)
            yield np.bincount(nth, minlength=n), terms
