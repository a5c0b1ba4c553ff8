"""Operator 7."""

from collections import Counter

import pytest

from ledgerloom.llm import window_join
from ledgerloom.llm.common import table
from tests.llm.plain import SMALL, contamination, empty, odd_rows

COLUMNS = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def _check(docs, bench, **options):
    found = window_join.digest(docs, bench, **options)
    want = contamination([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in bench.collect()])
    assert found.columns == list(COLUMNS)
    assert Counter(map(tuple, found.collect())) == Counter(want)
    return want


@pytest.mark.parametrize("block_words", [500_000, 600])
def test_documents(spark, block_words):
    want = _check(table(spark, SMALL, "documents"), table(spark, SMALL, "benchmark"), block_words=block_words)
    assert any(r[5] for r in want) and not all(r[5] for r in want)


def test_short_repeated_and_missing_items(spark):
    items = [
        (1, "one two three four five six seven eight nine ten eleven"), (2, "Ein Wort"), (2, "other words"), (3, None), (4, ""), (5, "a"),
        (6, "word word word word word word word word word word word"), (None, "line line"), (7, "1.5,2"), (8, "one two three four"),
        (9, "one two three four five six seven eight nine ten eleven"),
    ]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for block_words in (500_000, 3):
        _check(odd_rows(spark), bench, block_words=block_words)
    texts = [(i, " ".join(f"w{(i * j) % 7}" for j in range(40))) for i in range(60)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    _check(docs, docs.selectExpr("doc_id % 9 AS item_id", "substring(text, 1, doc_id * 2) AS text"))


def test_empty_tables(spark):
    docs, bench = table(spark, SMALL, "documents"), table(spark, SMALL, "benchmark")
    nothing = empty(spark)
    assert window_join.digest(nothing, bench).count() == 0
    assert window_join.digest(docs, bench.where("false")).where("contaminated OR n_items > 0 OR n_hit > 0").count() == 0


def test_clean_keeps_all_other_rows_and_columns(spark):
    docs, bench = odd_rows(spark), spark.createDataFrame([(2, "ein wort")], "item_id long, text string")
    kept = window_join.clean(docs, bench)
    assert kept.columns == docs.columns
    assert Counter(map(tuple, kept.collect())) == Counter(tuple(r) for r in docs.collect() if (r["text"] or "") != "ein Wort")
