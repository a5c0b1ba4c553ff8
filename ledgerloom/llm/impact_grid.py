"""Ranked lexical search over a K2-treap (operator 13).

The documents of a block, in ascending order of their ids, are the columns of a grid whose rows are the
terms; a cell holds the impact of the term in the document.  The grid is a quadtree without its empty
cells: each cell keeps which of its four quarters there are, and the greatest impact inside.  A search goes
down the rows of all terms of an item at once: a range of documents has one cell a term, and the weighted
sum of their maxima bounds the score of every document in it.  The ranges of greatest bound are halved
first, until a range is one document and its bound is its score; ranges whose bound lies below the score of
the last of the best ``k`` go.

Texts are read once for each block of items (bounded in words, so what a task holds doesn't grow with the
benchmark) and leave their counts of the items' terms in a stored table, all documents included.  Collection
counts come from that table by aggregation.  Then each task builds grids over bounded runs of documents,
searches them one after the other with the scores that it has so far, and gives its best ``k`` of each item.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import id_and_text, quoted, slices
from ledgerloom.llm.window_join import BLOCK_WORDS, blocks, words_of
from ledgerloom.storage import stored

BEST = 50
BLOCK_DOCS = 1 << 14
BLOCK_POINTS = 2_000_000
_AT_ONCE = 2048  # ranges that are halved in one step
_FOUND = "item_id long, doc_id long, score long"
_SET = np.array([bin(i).count("1") for i in range(16)], dtype=np.int32)  # quarters in a mask


def _spread(x: np.ndarray) -> np.ndarray:
    """The bits of ``x`` with a zero in front of each."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


class ImpactGrid:
    """Quadtree over (row, column, impact) points without empty cells; cell 0 is the empty one, cell 1 the whole grid.

    ``quarters`` are four bits a cell (2 * lower half of the rows + right half of the columns), ``first`` the cell of
    its first quarter that there is, ``most`` its greatest impact.
    """

    def __init__(self, rows: np.ndarray, columns: np.ndarray, impacts: np.ndarray):
        side = int(max(rows.max(initial=0), columns.max(initial=0))) + 1
        self.height = (side - 1).bit_length()
        codes = (_spread(rows) << np.uint64(1)) | _spread(columns)
        order = np.argsort(codes, kind="stable")
        codes, most = codes[order], impacts[order].astype(np.int32)
        levels = [(np.zeros(len(codes), np.uint8), np.zeros(len(codes), np.int64), most)]
        for _ in range(self.height):
            above = codes >> np.uint64(2)
            starts = np.flatnonzero(np.concatenate([[True], above[1:] != above[:-1]])) if len(codes) else np.zeros(0, np.int64)
            bits = np.uint8(1) << (codes & np.uint64(3)).astype(np.uint8)
            levels.append((np.bitwise_or.reduceat(bits, starts), starts, np.maximum.reduceat(levels[-1][2], starts)) if len(codes) else levels[-1])
            codes = above[starts]
        levels.reverse()
        begins = np.cumsum([1, *[len(level[0]) for level in levels]])
        self.quarters = np.concatenate([np.zeros(1, np.uint8), *[level[0] for level in levels]])
        self.first = np.concatenate([np.zeros(1, np.int64), *[level[1] + below for level, below in zip(levels, begins[1:])]]).astype(np.int32)
        self.most = np.concatenate([np.zeros(1, np.int32), *[level[2] for level in levels]])

    def child(self, cells: np.ndarray, quarter: np.ndarray) -> np.ndarray:
        """The given quarter of each cell, 0 where it is empty."""
        known = self.quarters[cells]
        found = self.first[cells] + _SET[known & ((np.uint8(1) << quarter) - np.uint8(1))]
        return np.where((known >> quarter) & np.uint8(1), found, 0)

    def best(self, rows: np.ndarray, weights: np.ndarray, least: float, keep: int) -> tuple[np.ndarray, np.ndarray]:
        """(columns, scores) that hold the ``keep`` best columns with a score of ``least`` or more, and above 0.

        Equal scores of the last place are all among them.  Scores are whole numbers below 2**53, so doubles are exact.
        """
        inside = rows < 1 << self.height
        rows, weights = rows[inside], weights[inside]
        cells = np.full((1, len(rows)), min(1, len(self.most) - 1), dtype=np.int32)
        level, start, bound = np.zeros(1, np.int64), np.zeros(1, np.int64), self.most[cells] @ weights
        columns, scores = np.zeros(0, np.int64), np.zeros(0)
        while len(bound):
            done = level == self.height
            if done.any():
                columns, scores = np.concatenate([columns, start[done]]), np.concatenate([scores, bound[done]])
                if len(scores) > keep:
                    least = max(least, float(np.partition(scores, -keep)[-keep]))
                    columns, scores = columns[scores >= least], scores[scores >= least]
            open_ = ~done & (bound >= least) & (bound > 0)
            cells, level, start, bound = cells[open_], level[open_], start[open_], bound[open_]
            if not len(bound):
                break
            if len(bound) > _AT_ONCE:  # the ranges of greatest bound first
                order = np.argpartition(-bound, _AT_ONCE)
                now, later = order[:_AT_ONCE], order[_AT_ONCE:]
            else:
                now, later = slice(None), slice(0)
            row_bit = ((rows[None, :] >> (self.height - 1 - level[now])[:, None]) & 1).astype(np.uint8) << np.uint8(1)
            halves = [self.child(cells[now], row_bit | np.uint8(side)) for side in (0, 1)]
            cells = np.concatenate([cells[later], *halves])
            bound = np.concatenate([bound[later], *[self.most[h] @ weights for h in halves]])
            start = np.concatenate([start[later], *[2 * start[now] + side for side in (0, 1)]])
            level = np.concatenate([level[later], level[now] + 1, level[now] + 1])
        fits = (scores >= least) & (scores > 0)
        return columns[fits], scores[fits]


class _Leaders:
    """The best documents of one item so far: highest score first, then the least id, null before all."""

    def __init__(self, keep: int):
        self.keep = keep
        self.scores, self.ids, self.known = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def least(self) -> float:
        return float(self.scores[-1]) if len(self.scores) == self.keep else 0.0

    def add(self, scores: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        scores, ids, known = np.concatenate([self.scores, scores.astype(np.int64)]), np.concatenate([self.ids, ids]), np.concatenate([self.known, known])
        order = np.lexsort((ids, known, -scores))[: self.keep]
        self.scores, self.ids, self.known = scores[order], ids[order], known[order]


def impact(tf: np.ndarray, n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """Share of a term's weight, in millionths, for ``tf`` occurrences in a document of ``n`` terms; 64-bit integers."""
    m = 100 - 50 + (50 * n * documents) // terms
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def _counted(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, times) of every document with a term: its length, and how often it has terms of the vocabulary."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value
        known = number.__contains__
        for batch in slices(batches, 1):
            kept, lengths, ends, terms, times = [], [], [0], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                words = words_of(text)
                if words:
                    counts = Counter(filter(known, words))
                    kept.append(i)
                    lengths.append(len(words))
                    terms += [number[w] for w in counts]
                    times += counts.values()
                    ends.append(len(terms))
            offsets = pa.array(ends, pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(v, pa.int32())) for v in (terms, times)]
            ids = batch.column(0).take(pa.array(kept, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(lengths, pa.int64()), *lists], ["doc_id", "n", "terms", "times"])

    return docs.mapInArrow(run, "doc_id long, n long, terms array<int>, times array<int>")


def _runs(batches: Iterator[pa.RecordBatch], most_docs: int, most_points: int) -> Iterator[pa.RecordBatch]:
    """The rows of a task in runs of bounded size (one row at least)."""
    held: list[pa.RecordBatch] = []
    docs = points = 0
    for batch in batches:
        sizes = np.diff(batch.column(2).offsets.to_numpy())
        start = 0
        for i, size in enumerate(sizes.tolist()):
            if docs and (docs == most_docs or points + size > most_points):
                yield pa.concat_batches([*held, batch.slice(start, i - start)])
                held, docs, points, start = [], 0, 0, i
            docs, points = docs + 1, points + size
        held.append(batch.slice(start))
    if docs:
        yield pa.concat_batches(held)


def grid_of(batch: pa.RecordBatch, rows: np.ndarray, documents: int, terms: int) -> tuple[ImpactGrid, np.ndarray, np.ndarray]:
    """The grid of a run of documents with (ids, known) of its columns; ``rows`` is the row of each term."""
    known = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
    ids = batch.column(0).fill_null(0).to_numpy()
    order = np.lexsort((ids, known))
    column = np.empty(len(order), np.int64)
    column[order] = np.arange(len(order))
    lists = batch.column(2)
    at = np.repeat(np.arange(len(ids)), np.diff(lists.offsets.to_numpy()))
    tf, n = batch.column(3).flatten().to_numpy().astype(np.int64), batch.column(1).to_numpy()
    return ImpactGrid(rows[lists.flatten().to_numpy()], column[at], impact(tf, n[at], documents, terms)), ids[order], known[order]


def search(docs: DataFrame, items: DataFrame, keep: int = BEST, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_words: int = BLOCK_WORDS, block_docs: int = BLOCK_DOCS, block_points: int = BLOCK_POINTS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``keep`` best documents of each item with a score above 0.

    Equal scores by ascending doc_id, null first.  Every row of ``docs`` is a document of its own, so repeated rows
    are found as often as they stand there; null text has no terms.  Rows of ``items`` with one id (null too) are one
    item with the terms of all; an item without known terms finds nothing.
    """
    spark, rows = docs.sparkSession, id_and_text(docs, id_col, text_col)
    whole = items.groupBy(quoted(item_col).alias("item_id")).agg(F.array_join(F.collect_list(quoted(item_text_col)), " ").alias("text"))
    found = None
    for block in blocks(whole, block_words=block_words):
        wanted = [(item_id, set(words_of(text))) for item_id, text in block]
        vocabulary = {w: i for i, w in enumerate(sorted(set(chain.from_iterable(words for _, words in wanted))))}
        counted = stored(_counted(rows, vocabulary), "term-counts")
        documents, terms = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        held = counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect()  # at most the vocabulary
        df = {r["term"]: r["count"] for r in held}
        # Frequent terms have neighbouring rows, so that a cell's maximum is near to that of each of its rows.
        row_of = np.zeros(len(vocabulary) + 1, np.int64)
        row_of[sorted(df, key=lambda t: (-df[t], t))] = np.arange(len(df))
        queries = []
        for item_id, words in wanted:
            its = [vocabulary[w] for w in sorted(words) if vocabulary[w] in df]
            if its:
                queries.append((item_id, row_of[its], np.array([weight(documents, df[t]) for t in its], dtype=np.float64)))
        best = _search_block(counted, spark.sparkContext.broadcast((row_of, documents, terms, queries)), keep, block_docs, block_points)
        found = best if found is None else found.union(best)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep).select("item_id", "rank", "doc_id", "score")


def _search_block(counted: DataFrame, shared, keep: int, block_docs: int, block_points: int) -> DataFrame:
    """(item_id, doc_id, score) of each task's best documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row_of, documents, terms, queries = shared.value
        leaders = [_Leaders(keep) for _ in queries]
        for part in _runs(batches, block_docs, block_points):
            grid, ids, known = grid_of(part, row_of, documents, terms)
            for (_, rows, weights), best in zip(queries, leaders):
                columns, scores = grid.best(rows, weights, best.least(), keep)
                best.add(scores, ids[columns], known[columns])
        for (item_id, _, _), best in zip(queries, leaders):
            if len(best.ids):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item_id] * len(best.ids), pa.int64()), pa.array(best.ids, pa.int64(), mask=~best.known), pa.array(best.scores, pa.int64())],
                    ["item_id", "doc_id", "score"],
                )

    return counted.mapInArrow(run, _FOUND)


def sql(keep: int = BEST) -> str:
    """:func:`search` of table ``benchmark`` in table ``documents`` in DuckDB SQL."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    words = f"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
    return f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {words} AS w FROM documents),
lengths AS (SELECT r, doc_id, len(w) AS n FROM docs WHERE len(w) > 0),
whole AS (SELECT count(*) AS documents, sum(n) AS terms FROM lengths),
items AS (SELECT DISTINCT item_id, unnest({words}) AS term FROM benchmark),
counts AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM docs) WHERE term IN (SELECT term FROM items) GROUP BY r, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * documents + 2) / (2 * df + 1))) AS BIGINT) AS weight
  FROM (SELECT term, count(*) AS df FROM counts GROUP BY term), whole
),
impacts AS (
  SELECT r, doc_id, term, (1000000000 * tf) // (1000 * tf + 20 * (50 + CAST((50 * n * documents) // terms AS BIGINT))) AS impact
  FROM counts JOIN lengths USING (r), whole
),
scores AS (
  SELECT item_id, r, any_value(doc_id) AS doc_id, CAST(sum(weight * impact) AS BIGINT) AS score
  FROM items JOIN weights USING (term) JOIN impacts USING (term) GROUP BY item_id, r
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM scores WHERE score > 0
) WHERE rank <= {keep}"""
