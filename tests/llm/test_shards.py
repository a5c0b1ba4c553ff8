"""Operator 2."""

import math
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import feistel_shards
from ledgerloom.llm.common import table
from tests.llm.plain import SMALL, crc, empty, odd_rows


@pytest.mark.parametrize("n", [1, 2, 3, 7, 40, 41, 1000, 4097])
def test_the_network_permutes(spark, n):
    places = [r[0] for r in spark.range(n).select(feistel_shards.permuted(F.col("id"), n)).collect()]
    assert sorted(places) == list(range(n))


def test_the_order_is_shuffled_and_repeatable(spark):
    place = lambda seed: [r[0] for r in spark.range(2000).select(feistel_shards.permuted(F.col("id"), 2000, seed)).collect()]
    first = place(0)
    assert first == place(0) != place(1)
    assert sum(b == a + 1 for a, b in zip(first, first[1:])) < 20
    # Neighbours spread over all shards evenly: each tenth of the rows fills each of ten shards with about a tenth.
    for at in range(0, 2000, 200):
        assert max(Counter(p % 10 for p in first[at : at + 200]).values()) < 45


@pytest.mark.parametrize("which", ["documents", "odd", "empty"])
def test_placement(spark, which):
    rows = {"documents": lambda: table(spark, SMALL, "documents"), "odd": lambda: odd_rows(spark), "empty": lambda: empty(spark)}[which]()
    found = feistel_shards.placement(rows).collect()
    want = [(r["doc_id"], len((r["text"] or "").encode()) + 16, crc(r["text"])) for r in rows.collect()]
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == Counter(want)
    if not want:
        return
    per_shard = Counter(r["shard"] for r in found)
    counts = [per_shard[s] for s in range(40)]
    assert max(counts) - min(counts) <= 1 and set(per_shard) <= set(range(40))
    for shard in per_shard:
        assert sorted(r["slot"] for r in found if r["shard"] == shard) == list(range(per_shard[shard]))
    assert {r["law"] for r in found} == {"rows"} and {r["grown_shard"] for r in found} == {None}


def test_few_rows_walk():
    for n in (10**6, 10**8, 10**9, 10**10, 10**12):
        a, b = feistel_shards.domain(n)
        assert 0 <= a * b - n < 10 * math.isqrt(n) ** 0.5 and a < 3 * b * 2


def test_work_per_row_does_not_grow(spark):
    def seconds(n):
        start = time.perf_counter()
        spark.range(500_000).select(F.max(feistel_shards.permuted(F.col("id"), n))).collect()
        return time.perf_counter() - start

    seconds(10**6)
    assert seconds(10**9) < 2 * max(seconds(10**6) for _ in range(2)) + 0.5


def test_no_python_in_the_plan(spark):
    plan = feistel_shards.placement(table(spark, SMALL, "documents"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
