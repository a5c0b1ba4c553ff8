"""Operator 13 against scores of all documents."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from ledgerloom.llm import impact_grid
from ledgerloom.llm.common import table
from tests.llm.plain import SMALL, empty, lower, odd_rows

WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def plain(docs, items, keep=50):
    cut = lambda t: re.findall(WORD, lower(t or ""))
    held = [(i, Counter(cut(t))) for i, t in docs if cut(t)]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(w for _, c in held for w in c)
    wanted = defaultdict(set)
    for i, t in items:
        wanted[i] |= set(cut(t))
    out = []
    for item, words in wanted.items():
        found = []
        for doc_id, c in held:
            m = 100 - 50 + (50 * sum(c.values()) * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((1000000000 * c[w]) // (1000 * c[w] + 20 * m)) for w in words if w in c)
            if score > 0:
                found.append((-score, doc_id is not None, doc_id or 0, doc_id))
        found.sort(key=lambda f: f[:3])
        out += [(item, rank, f[3], -f[0]) for rank, f in enumerate(found[:keep], 1)]
    return Counter(out)


def pairs(df, name):
    return [(r[name], r["text"]) for r in df.collect()]


@pytest.mark.parametrize("sizes", [{}, {"block_docs": 7, "block_points": 100}, {"block_words": 300, "keep": 5}])
def test_search(spark, sizes):
    docs, items = table(spark, SMALL, "documents"), table(spark, SMALL, "benchmark")
    found = Counter(tuple(r) for r in impact_grid.search(docs, items, **sizes).collect())
    assert found == plain(pairs(docs, "doc_id"), pairs(items, "item_id"), sizes.get("keep", 50))


def test_odd_rows(spark):
    docs = odd_rows(spark)
    items = spark.createDataFrame(
        [(1, "one TWO three"), (1, "word"), (2, None), (3, ""), (4, "?!"), (5, "nirgends"), (None, "ein"), (None, "日本語"), (6, "Ünïcödé two a"), (7, "word word word")],
        "item_id long, text string").selectExpr("*", "1 AS doc_id", "2 AS score", "3 AS n")
    found = Counter(tuple(r) for r in impact_grid.search(docs, items).collect())
    assert found == plain(pairs(docs, "doc_id"), pairs(items, "item_id")) and len(found) > 10
    assert impact_grid.search(empty(spark), items).count() == 0
    assert impact_grid.search(docs.where("false"), items).count() == 0
    assert impact_grid.search(docs, items.where("false")).count() == 0


def test_many_equal_scores(spark):
    """All documents alike: the least ids stand in front, whatever block they lie in."""
    docs = spark.createDataFrame([(i * 7919 % 1009, "same words here") for i in range(1009)], "doc_id long, text string").repartition(5)
    items = spark.createDataFrame([(1, "same"), (2, "words here other")], "item_id long, text string")
    assert impact_grid.search(docs, items, block_docs=50).count() == 0  # a term of every document weighs nothing
    docs = docs.unionAll(spark.createDataFrame([(2000 + i, "something else") for i in range(5000)], "doc_id long, text string"))
    found = impact_grid.search(docs, items, block_docs=50).where("item_id = 1").orderBy("rank").collect()
    assert [r["doc_id"] for r in found] == list(range(50))


@pytest.mark.parametrize("n,rows,columns", [(0, 1, 1), (1, 1, 1), (1, 40, 3), (500, 3, 400), (500, 400, 3), (4000, 100, 100)])
def test_grid(n, rows, columns):
    draw = np.random.default_rng(n)
    points = np.unique(draw.integers(0, rows * columns, n))
    r, c, v = points // columns, points % columns, draw.integers(1, 1_000_000, len(points))
    grid = impact_grid.ImpactGrid(r, c, v)
    assert len(grid.most) == len(grid.first) == len(grid.quarters) and (n == 0 or grid.most[1] == v.max())
    full = np.zeros((rows, columns))
    full[r, c] = v
    for keep in (1, 5, 1000):
        terms = np.unique(draw.integers(0, rows, 6))
        weights = draw.integers(0, 30_000, len(terms)).astype(float)
        score = weights @ full[terms]
        terms, weights = np.append(terms, 5000), np.append(weights, 7.0)  # a row beyond the grid
        found, scores = grid.best(terms, weights, 0.0, keep)
        assert (score[found] == scores).all()
        want = sorted(score[score > 0], reverse=True)[:keep]
        assert sorted(scores, reverse=True)[:keep] == want
        if want:  # nothing below a bound that is given, and all of the last place
            at = random.Random(n).choice(want)
            found, scores = grid.best(terms, weights, float(at), len(score))
            assert set(found) == set(np.flatnonzero(score >= at))
