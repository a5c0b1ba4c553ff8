"""Licence notices by conditional compression (operator 6).

Candidate blocks: a notice may differ from its template in a tenth of the template's words.  A template
is cut into one piece more than the words that may differ, so at least one piece stands unchanged in
every notice.  The stretches of text around such pieces, whichever template they come from, are the blocks.

Ranking: a block is cut into overlapping windows twice as long as a notice, and each window is compressed
plainly and with every template as a raw zstandard dictionary.  The bytes that a dictionary saves, as a
share of what it saves on its own template, rank the templates.  Blocks and templates are compressed as
lower-case words with single spaces, so line breaks, case and marks don't count, and with literals as they
are (negative level), so the bytes saved are the bytes that stand in the template.

Confirmation: the templates above ``LEAST_SAVED`` are compared word by word, best first.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Callable, Iterator
from typing import NamedTuple

import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import append, id_and_text
from ledgerloom.llm.license_templates import TEMPLATES

MAX_CHANGED = 0.1  # share of the template's words that may differ
# Notices with as many changed words as may be, anywhere, save 0.6 at least (a test holds random ones above
# 0.5); prose mostly stays below 0.4, and what passes is refused by its wording.
LEAST_SAVED = 0.4
_LEVEL = -1  # negative levels leave literals uncompressed
_WORD = re.compile(r"[^\W_]+(?:\.\d+)*")

FOUND = "array<struct<first_line:int,last_line:int,license:string,saved:double,n_differences:int,differences:string,first_word:int,last_word:int>>"


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def places_of(text: str) -> tuple[list[str], list[tuple[int, int]]]:
    """The words of a text as ``words_of`` gives them, and where each stands in it."""
    lowered = text.lower()
    found = list(_WORD.finditer(lowered))
    spans = [m.span() for m in found]
    if len(lowered) != len(text):  # a letter whose lower case is longer moves what follows
        origin = [i for i, c in enumerate(text) for _ in c.lower()]
        spans = [(origin[a], origin[b - 1] + 1) for a, b in spans]
    return [m.group() for m in found], spans


def exact(words: list[str], text: list[str]) -> tuple[int, int, int, str] | None:
    """What ``align`` gives for the first place where the words stand unchanged; None without such a place."""
    for at in range(len(text) - len(words) + 1):
        if text[at] == words[0] and text[at : at + len(words)] == words:
            return at, at + len(words), 0, ""
    return None


def align(words: list[str], text: list[str], most: int) -> tuple[int, int, int, str] | None:
    """(first, behind the last, differences, both in writing) of the part of ``text`` nearest to ``words``.

    Differences are words replaced, missing or too many; words around the part don't count.  None where
    there are more than ``most`` of them everywhere.
    """
    n = len(words)
    rows = [[0] * (len(text) + 1)]
    for i, word in enumerate(words, 1):
        above, row = rows[-1], [i]
        for j, other in enumerate(text):
            row.append(min(above[j] + (word != other), above[j + 1] + 1, row[j] + 1))
        if min(row) > most:
            return None
        rows.append(row)
    cost = min(rows[-1])
    if cost > most:
        return None
    i, j = n, rows[-1].index(cost)
    steps = []  # from the end: (template word or None, text word or None, place in the text)
    while i:
        if j and words[i - 1] == text[j - 1] and rows[i][j] == rows[i - 1][j - 1]:
            i, j = i - 1, j - 1
            steps.append((words[i], words[i], j))
        elif j and rows[i][j] == rows[i - 1][j - 1] + 1:
            i, j = i - 1, j - 1
            steps.append((words[i], text[j], j))
        elif rows[i][j] == rows[i - 1][j] + 1:
            i -= 1
            steps.append((words[i], None, j))
        else:
            j -= 1
            steps.append((None, text[j], j))
    steps.reverse()
    equal = [j for x, y, j in steps if x == y]
    changes, open_change = [], False
    for x, y, _ in steps:
        if x != y:
            if not open_change:
                changes.append(([], []))
            changes[-1][0].extend([x] if x is not None else [])
            changes[-1][1].extend([y] if y is not None else [])
        open_change = x != y
    return equal[0], equal[-1] + 1, cost, "; ".join(f"-{' '.join(x)} +{' '.join(y)}" for x, y in changes)


class Match(NamedTuple):
    """A template confirmed at the words ``start`` to ``end`` (behind the last); ``fit`` of its words stand there,
    ``saved`` is what it saved on the window they were found in."""

    start: int
    end: int
    fit: int
    saved: float
    license: str
    n: int
    differences: str

    def rank(self) -> tuple:
        return -self.fit, self.n, -self.saved, self.license, self.start


class Template(NamedTuple):
    license: str
    words: list[str]
    most: int  # words that may differ
    compressor: zstandard.ZstdCompressor  # with the template as dictionary
    own: int  # bytes that the dictionary saves on the template itself


def block_of(words: list[str]) -> bytes:
    """Words as they are compressed."""
    return " ".join(words).encode("utf-8", "surrogatepass")


class Templates:
    """Compressors with each template as dictionary, the templates' words and the pieces of them."""

    def __init__(self, templates: dict[str, list[str]] = TEMPLATES):
        self.plain = zstandard.ZstdCompressor(level=_LEVEL, write_content_size=False)
        self.known: list[Template] = []
        self.pieces: dict[str, list[tuple[list[str], int, int]]] = defaultdict(list)  # by first word: words, template, place in it
        for name, texts in templates.items():
            for text in texts:
                words = words_of(text)
                content = block_of(words)
                dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                compressor = zstandard.ZstdCompressor(level=_LEVEL, dict_data=dictionary, write_content_size=False)
                most = int(MAX_CHANGED * len(words))
                cuts = [len(words) * k // (most + 1) for k in range(most + 2)]
                for a, b in zip(cuts, cuts[1:]):
                    self.pieces[words[a]].append((words[a:b], len(self.known), a))
                own = len(self.plain.compress(content)) - len(compressor.compress(content))
                self.known.append(Template(name, words, most, compressor, own))

    def blocks(self, words: list[str]) -> list[tuple[int, int]]:
        """Stretches of the text, apart from each other, that hold all its notices whole."""
        reach = []
        for at, word in enumerate(words):
            for piece, which, a in self.pieces.get(word, ()):
                if words[at : at + len(piece)] == piece:
                    t = self.known[which]
                    reach.append((max(at - a - t.most, 0), min(at - a + len(t.words) + t.most, len(words))))
        joined: list[tuple[int, int]] = []
        for low, high in sorted(reach):
            if joined and low <= joined[-1][1]:
                joined[-1] = joined[-1][0], max(joined[-1][1], high)
            else:
                joined.append((low, high))
        return joined

    def saved(self, words: list[str], low: int, high: int, sizes: dict[tuple[int, int], int]) -> Callable[[Template], float]:
        """What a template saves on these words, as a share of what it saves on itself; ``sizes`` keeps plain sizes."""
        content = block_of(words[low:high])
        if (low, high) not in sizes:
            sizes[low, high] = len(self.plain.compress(content))
        return lambda t: (sizes[low, high] - len(t.compressor.compress(content))) / t.own

    def ranked(self, words: list[str], low: int, high: int, sizes: dict[tuple[int, int], int]) -> list[tuple[float, int, int, int]]:
        """(saved, template, first word, behind the last) of a block's windows, the best first, down to ``LEAST_SAVED``."""
        found = []
        for which, t in enumerate(self.known):
            if high - low < len(t.words) - t.most:
                continue
            step = len(t.words) + t.most  # of two windows' overlap, so that each notice lies whole in one
            for start in range(low, max(high - step, low + 1), step):
                end = min(start + 2 * step, high)
                share = self.saved(words, start, end, sizes)(t)
                if share >= LEAST_SAVED:
                    found.append((share, which, start, end))
        return sorted(found, key=lambda f: (-f[0], *f[1:]))

    def confirmed(self, words: list[str], which: int, share: float, low: int, high: int, sizes: dict[tuple[int, int], int]) -> Iterator[Match]:
        """The places within a window where the template's wording stands, apart from each other."""
        t = self.known[which]
        open_parts = [(share, low, high)]
        while open_parts:
            share, low, high = open_parts.pop()
            found = exact(t.words, words[low:high]) or align(t.words, words[low:high], t.most)
            if not found:
                continue
            start, end, n, written = low + found[0], low + found[1], *found[2:]
            yield Match(start, end, len(t.words) - n, share, t.license, n, written)
            for a, b in ((low, start), (end, high)):
                if b - a >= len(t.words) - t.most:
                    rest = self.saved(words, a, b, sizes)(t)
                    if rest >= LEAST_SAVED:
                        open_parts.append((rest, a, b))

    def matches(self, words: list[str]) -> list[tuple[int, Match]]:
        """Each template at the places where its wording is confirmed."""
        if self.pieces.keys().isdisjoint(words):
            return []
        found = {}
        for low, high in self.blocks(words):
            sizes: dict[tuple[int, int], int] = {}
            for share, which, start, end in self.ranked(words, low, high, sizes):
                for m in self.confirmed(words, which, share, start, end, sizes):
                    found.setdefault((which, m.start, m.end), m)  # overlapping windows give a place twice
        return [(which, m) for (which, _, _), m in found.items()]

    def find(self, text: str | None) -> list[dict]:
        """Confirmed notices of a text, in order.

        A match goes if another that fits more of its template's words covers it, or if it shares words with
        a better match of the same licence; all others are given, on shared lines too.
        """
        text = text or ""
        found = [m for _, m in self.matches(words_of(text))]
        if not found:
            return []
        breaks = [m.start() for m in re.finditer("\n", text)]
        line = lambda place: bisect_right(breaks, place)
        given: dict[int, list[Match]] = defaultdict(list)  # by word
        for match in sorted(found, key=Match.rank):
            if any(g.end >= match.end for g in given[match.start]) or any(g.license == match.license for i in range(match.start, match.end) for g in given[i]):
                continue
            for i in range(match.start, match.end):
                given[i].append(match)
        _, spans = places_of(text)
        kept = sorted({g for here in given.values() for g in here})
        return [
            {
                "first_line": line(spans[m.start][0]),
                "last_line": line(spans[m.end - 1][1] - 1),
                "license": m.license,
                "saved": m.saved,
                "n_differences": m.n,
                "differences": m.differences,
                "first_word": m.start,
                "last_word": m.end - 1,
            }
            for m in kept
        ]


def _finder() -> Callable[[list], list]:
    templates = Templates()
    return lambda texts: [[templates.find(t) for t in texts]]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per notice: (doc_id, first_line, last_line, license, saved, n_differences, differences, first_word, last_word).

    Lines and words of the text count from 0; ``saved`` is the share of its own saving that the template reached
    on the window (above 1 where the notice stands twice).  A text has as many rows as notices stand in it.  Null and
    empty texts have none; repeated rows give repeated notices.
    """
    found = append(id_and_text(docs, id_col, text_col), "text", f"found {FOUND}", _finder)
    return found.select("doc_id", F.inline("found"))
