"""Benchmark decontamination by a prefix-filtered set join (operator 7).

A window (ten consecutive words of an item; a shorter item is one window) is a set of five-word
shingles, and a text that contains the window contains all of them.  So one shingle of each window
is enough to find every candidate: the rarest one over all documents.  A document position with that
shingle gives one possible start (positional bound), the whole window must lie in the document
(length bound), and then all its words are compared.

Documents are scanned twice per block of items: once to count the shingles, once to join.  An item
block is bounded in words, so what a task holds doesn't grow with the benchmark; further blocks are
further passes over the documents, and spans and items add up.

Words are compared by their number in the block's vocabulary, which is exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.common import append, fresh, quoted, slices

WINDOW = 10
SHINGLE = 5
BLOCK_WORDS = 500_000  # words of the items that one pass looks for, about
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
# Words are made of digits, letters and everything beyond ASCII; A-Z counts as a-z.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split() if text else []


def _hashes(ids: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    found = np.full(len(starts), width, dtype=np.uint64)
    for i in range(width):
        found = (found ^ ids[starts + i].astype(np.uint64)) * _FACTOR
        found ^= found >> np.uint64(29)
    return found


class Items:
    """Windows of one block of items, with their shingles."""

    def __init__(self, items: list[tuple[int | None, str | None]], window: int = WINDOW, shingle: int = SHINGLE):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[int]] = {}
        for item_id, text in items:
            words = words_of(text)
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
            for start in range(max(1, len(ids) - window + 1) if ids else 0):
                owners = found.setdefault(tuple(ids[start : start + window]), set())
                if item_id is not None:
                    owners.add(item_id)
        ordered = sorted(found.items())
        self.lengths = np.array([len(w) for w, _ in ordered], dtype=np.int64)
        self.matrix = np.zeros((len(ordered), window), dtype=np.int32)
        for row, (ids, _) in zip(self.matrix, ordered):
            row[: len(ids)] = ids
        self.owners = [sorted(o) for _, o in ordered]
        self.widths = np.minimum(self.lengths, shingle)
        # Every shingle: its hash, window, and offset in the window; the width is part of the hash.
        hashes, windows, offsets = [], [], []
        for width in np.unique(self.widths):
            rows = np.flatnonzero(self.widths == width)
            for offset in range(window - width + 1):
                here = rows[self.lengths[rows] >= offset + width]
                if len(here):
                    flat = self.matrix[here, offset : offset + width].ravel()
                    hashes.append(_hashes(flat, np.arange(len(here)) * width, int(width)))
                    windows.append(here)
                    offsets.append(np.full(len(here), offset))
        self.hashes = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        self.shingle_windows = np.concatenate(windows) if windows else np.zeros(0, np.int64)
        self.offsets = np.concatenate(offsets) if offsets else np.zeros(0, np.int64)
        self.known = np.unique(self.hashes)
        self.prefix = self.known

    def choose_prefix(self, counts: dict[int, int]) -> None:
        """Keep the rarest shingle of each window; windows with a shingle that no document has can't occur."""
        times = np.array([counts.get(int(h.astype(np.int64)), 0) for h in self.known], dtype=np.int64)
        rarity = times[np.searchsorted(self.known, self.hashes)]
        order = np.lexsort((self.offsets, self.hashes, rarity, self.shingle_windows))
        first = np.ones(len(order), dtype=bool)
        first[1:] = self.shingle_windows[order][1:] != self.shingle_windows[order][:-1]
        chosen = order[first]
        chosen = chosen[rarity[chosen] > 0]
        chosen = chosen[np.argsort(self.hashes[chosen], kind="stable")]
        self.hashes, self.shingle_windows, self.offsets = self.hashes[chosen], self.shingle_windows[chosen], self.offsets[chosen]
        self.prefix = np.unique(self.hashes)

    def numbered(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word numbers of all texts (0: not in the block), where each text begins, and its word count.  A 0 ends each text."""
        flat: list[bytes] = []
        counts = []
        for text in texts:
            words = words_of(text)
            counts.append(len(words))
            flat += words
            flat.append(b"")
        ids = np.fromiter(map(self.vocabulary.get, flat, repeat(0)), dtype=np.int32, count=len(flat))
        n = np.array(counts, dtype=np.int64)
        return ids, np.cumsum(n + 1) - (n + 1), n

    def occurrences(self, ids: np.ndarray, sought: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, place in ``sought``) of the shingles of ``ids`` whose hash is in ``sought`` (ascending)."""
        places, found = [], []
        known = ids > 0
        for width in np.unique(self.widths):
            full = known[: max(len(ids) - width + 1, 0)].copy()
            for i in range(1, width):
                full &= known[i : i + len(full)]
            starts = np.flatnonzero(full)
            hashes = _hashes(ids, starts, int(width))
            at = np.searchsorted(sought, hashes)
            hit = at < len(sought)
            hit[hit] = sought[at[hit]] == hashes[hit]
            places.append(starts[hit])
            found.append(at[hit])
        if not places:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(places), np.concatenate(found)

    def matches(self, texts: list[str | None]) -> tuple[list[int], list[list[int]], list[list[int]]]:
        """Per text: word count, spans [start, end, start, end, ...] of the words that windows cover, item ids."""
        ids, begins, n = self.numbered(texts)
        position, at = self.occurrences(ids, self.prefix)
        low = np.searchsorted(self.hashes, self.prefix, side="left")
        high = np.searchsorted(self.hashes, self.prefix, side="right")
        many = (high - low)[at]
        entry = np.repeat(low[at], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        start = np.repeat(position, many) - self.offsets[entry]
        window = self.shingle_windows[entry]
        text = np.searchsorted(begins, np.repeat(position, many), side="right") - 1
        bounded = (start >= begins[text]) & (start + self.lengths[window] <= begins[text] + n[text])
        start, window, text = start[bounded], window[bounded], text[bounded]
        for i in range(self.window):  # exact: all words of the window
            same = (i >= self.lengths[window]) | (ids[np.minimum(start + i, len(ids) - 1)] == self.matrix[window, i])
            start, window, text = start[same], window[same], text[same]
        spans: list[list[int]] = [[] for _ in texts]
        items: list[list[int]] = [[] for _ in texts]
        if len(start):
            edges = np.zeros(len(ids) + 1, dtype=np.int64)
            np.add.at(edges, start, 1)
            np.add.at(edges, start + self.lengths[window], -1)
            covered = np.concatenate([[0], (np.cumsum(edges) > 0).astype(np.int8)])
            turns = np.flatnonzero(np.diff(covered))
            for a, b in zip(turns[::2], turns[1::2]):
                t = int(np.searchsorted(begins, a, side="right") - 1)
                spans[t] += [int(a - begins[t]), int(b - begins[t])]
            for key in np.unique(text * len(self.lengths) + window):
                items[int(key // len(self.lengths))] += self.owners[int(key % len(self.lengths))]
        return n.tolist(), spans, [sorted(set(i)) for i in items]


def blocks(bench: DataFrame, id_col: str = "item_id", text_col: str = "text", block_words: int = BLOCK_WORDS) -> Iterator[list[tuple[int | None, str | None]]]:
    """The items in blocks of about ``block_words`` words, by a hash of id and text; the driver holds one block at a time."""
    rows = bench.select(quoted(id_col).cast("long").alias("item_id"), quoted(text_col).alias("text")).where(F.col("text").isNotNull())
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // (block_words * 6)))
    for i in range(n):
        part = rows if n == 1 else rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i)
        yield [(r["item_id"], r["text"]) for r in part.collect()]


def _frequencies(spark: SparkSession, docs: DataFrame, text_col: str, items: Items) -> dict[int, int]:
    """How often each shingle of the block stands in all documents; absent ones have no entry."""
    shared = spark.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        counts = np.zeros(len(block.known), dtype=np.int64)
        for batch in slices(batches, 0):
            _, at = block.occurrences(block.numbered(batch.column(0).to_pylist())[0], block.known)
            counts += np.bincount(at, minlength=len(counts))
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(block.known[used].view(np.int64)), pa.array(counts[used])], ["shingle", "n"])

    rows = docs.select(quoted(text_col).alias("text")).mapInArrow(run, "shingle long, n long")
    return {r["shingle"]: r["n"] for r in rows.groupBy("shingle").agg(F.sum("n").alias("n")).collect()}


def _union(spans: list[int]) -> list[int]:
    """Overlapping or touching spans made one, ascending."""
    out: list[int] = []
    for a, b in sorted(zip(spans[::2], spans[1::2])):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def find(docs: DataFrame, bench: DataFrame, text_col: str = "text", block_words: int = BLOCK_WORDS, prefix: str = "") -> DataFrame:
    """``docs`` with ``n_words``, ``spans`` (word positions that windows cover, as start, end, start, end) and ``items`` (item ids).

    Null text has no words; null item text no windows; windows of an item without an id cover words but
    name no item.  Several rows with one item id are one item.  The new names get ``prefix``.
    """
    names = [f"{prefix}{c}" for c in ("n_words", "spans", "items")]
    fields = f"`{names[0]}` long, `{names[1]}` array<int>, `{names[2]}` array<long>"
    spark, found, gathered = docs.sparkSession, docs, []
    for number, block in enumerate(blocks(bench, block_words=block_words)):
        items = Items(block)
        items.choose_prefix(_frequencies(spark, docs, text_col, items))
        shared = spark.sparkContext.broadcast(items)
        if number == 0:
            found = append(found, text_col, fields, lambda shared=shared: shared.value.matches)
            continue
        s, i = fresh(found, f"spans_{number}"), fresh(found, f"items_{number}")
        found = append(found, text_col, f"`{s}` array<int>, `{i}` array<long>", lambda shared=shared: lambda texts: shared.value.matches(texts)[1:])
        gathered.append((s, i))
    if gathered:
        union = F.udf(_union, T.ArrayType(T.IntegerType()))
        spans = union(F.concat(*map(quoted, [names[1], *(s for s, _ in gathered)])))
        ids = F.array_sort(F.array_distinct(F.concat(*map(quoted, [names[2], *(i for _, i in gathered)]))))
        found = found.withColumns({names[1]: spans, names[2]: ids}).drop(*(c for pair in gathered for c in pair))
    return found


def digest(docs: DataFrame, bench: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The contract's columns from :func:`find`."""
    found = find(docs.select("doc_id", "text"), bench, block_words=block_words)
    spans = F.col("spans")
    sides = F.transform(spans, lambda edge, i: F.when(i % 2 == 1, edge).otherwise(-edge))
    n_hit = F.aggregate(sides, F.lit(0).cast("long"), lambda acc, x: acc + x)
    names = F.array_join(F.array_sort(F.col("items").cast("array<string>")), ",")
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), "items").select(
        "doc_id", "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(names, 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, bench: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with no word inside any window."""
    prefix = "_bench_"
    while any(c.startswith(prefix) for c in docs.columns):
        prefix = f"_{prefix}"
    return find(docs, bench, text_col, prefix=prefix).where(F.size(quoted(f"{prefix}spans")) == 0).select(*map(quoted, docs.columns))


def sql() -> str:
    """:func:`digest` of tables ``documents`` and ``benchmark`` in DuckDB SQL."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    words = f"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""
WITH docs AS (SELECT doc_id, {words} AS w FROM documents),
items AS (SELECT item_id, {words} AS w FROM benchmark),
starts AS (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - {WINDOW - 2}))) AS s FROM items WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, len(w[s : s + {WINDOW - 1}]) AS n, array_to_string(w[s : s + {WINDOW - 1}], ' ') AS run FROM starts),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM docs, sizes WHERE len(w) >= n),
hits AS (
  SELECT doc_id, s, p.n, item_id FROM places p JOIN windows v ON p.n = v.n AND array_to_string(p.w[p.s : p.s + p.n - 1], ' ') = v.run
),
covered AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS place FROM (SELECT DISTINCT doc_id, s, n FROM hits)) GROUP BY doc_id
),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)"""
