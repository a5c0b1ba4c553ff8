"""Plain versions of the operators, one text at a time, and rows that are hard to handle."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash

SMALL = "/root/testdata/sf0.001"

ODD_TEXTS = [
    None, "", " ", "\n\n", "a", "?!", "\x00\x01", "  two   spaces ", "\t\r\n x", "ein Wort", "ein Wort", "Ünïcödé ﬁ x́ 日本語 😀😀", "▁ ▁▁x ▁",
    "<s> </s> <unk> <0x41> <|endoftext|>", "a" * 5000, "word " * 3000, "one two three four five six seven eight nine ten",
    "1.5,2/3 (x)==> 'quoted' don't _y_", "line\nline\nLine \n\nline", " nbsp em \u0085next",
]


def odd_rows(spark):
    """Every odd text, null and repeated ids, and further columns with names that operators use themselves."""
    rows = [(i, t, "en" if i % 3 else None, f"s{i % 4}" if i % 5 else None, i) for i, t in enumerate(ODD_TEXTS)]
    rows += [(None, "no id here", "en", "s1", 1), (None, None, None, None, None), rows[9], rows[9], (3, "other text, same id", "de", "s2", 7)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    return spark.createDataFrame(rows, schema).selectExpr("*", "1 AS shard", "'x' AS ids", "2 AS part", "0.5D AS score", "3 AS tie", "4 AS k1", "5 AS n_words", "'q' AS `a.b`")


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def crc(text: str | None) -> int:
    return zlib.crc32((text or "").encode())


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def fingerprint(text: str | None) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def component_ids(prints: dict[int, list]) -> dict[int, object]:
    """Smallest id of each fingerprint's component; ``prints`` lists the ids of each fingerprint."""
    known = list(prints)
    root = {f: f for f in known}

    def top(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(known):
        for b in known[:i]:
            if (a ^ b).bit_count() <= 3:
                root[top(a)] = top(b)
    least: dict[int, list] = defaultdict(list)
    for f in known:
        least[top(f)] += [i for i in prints[f] if i is not None]
    return {f: min(least[top(f)], default=None) for f in known}


def contamination(texts: list[tuple], items: list[tuple]) -> list[tuple]:
    """The contract's columns of benchmark decontamination, window by window."""
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t or ""))
    windows = defaultdict(set)
    for item_id, text in items:
        words = cut(text)
        for i in range(max(1, len(words) - 9) if words else 0):
            windows[tuple(words[i : i + 10])].add(item_id)
    sizes = sorted({len(w) for w in windows})
    out = []
    for doc_id, text in texts:
        words = cut(text)
        hit, ids = set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                found = windows.get(tuple(words[i : i + size]))
                if found is not None:
                    hit |= set(range(i, i + size))
                    ids |= {x for x in found if x is not None}
        out.append((doc_id, len(words), len(hit), len(ids), sha(",".join(sorted(map(str, ids)))), bool(hit)))
    return out


def base_counts(text: str | None) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    runs = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(runs)
    covered = {j for i, r in enumerate(runs) if times[r] > 1 for j in range(i, i + 3)}
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
        len(words) < 50 or 100 * len(covered) > 50 * len(words),
    )


def boilerplate_removed(rows: list[tuple], min_sites: int) -> list[tuple]:
    """(doc_id, text, n_removed) of (doc_id, text, site) rows."""
    sites, first = defaultdict(set), {}
    order = lambda i: (i is not None, i or 0)  # noqa: E731  null ids first
    for doc_id, text, site in rows:
        for pos, raw in enumerate((text or "").split("\n")):
            line = raw.strip(" \t\r")
            if text is not None and line:
                sites[line] |= {site} - {None}
                here = (order(doc_id), xxhash_free(text), pos)
                first[line] = min(first.get(line, here), here, key=lambda h: (h[0], h[2]))
    out = []
    for doc_id, text, _ in rows:
        if text is None:
            out.append((doc_id, None, 0))
            continue
        kept, gone = [], 0
        for pos, raw in enumerate(text.split("\n")):
            line = raw.strip(" \t\r")
            if line and len(sites[line]) >= min_sites and (order(doc_id), pos) != (first[line][0], first[line][2]):
                gone += 1
            else:
                kept.append(raw)
        out.append((doc_id, "\n".join(kept), gone))
    return out


def xxhash_free(text: str) -> str:
    return text


def nearest(words: list[str], text: np.ndarray, codes: dict[str, int]) -> np.ndarray:
    """Edit distance in words from ``words`` to the best part of the text that ends at each place."""
    place = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, dtype=np.int64)
    for i, word in enumerate(words, 1):
        step = np.minimum(row[:-1] + (text != codes.get(word, -1)), row[1:] + 1)
        row = np.minimum.accumulate(np.concatenate(([i], step)) - place) + place
    return row[1:]
