"""Operator 8 and its connected components."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import line_spread, multi_index, simhash
from ledgerloom.llm.common import table
from ledgerloom.llm.components import components
from ledgerloom.llm.simhash import fingerprints_of
from tests.llm.plain import ODD_TEXTS, SMALL, component_ids, empty, fingerprint, odd_rows


def test_fingerprints(monkeypatch):
    texts = [t or "" for t in ODD_TEXTS]
    want = [fingerprint(t) for t in texts]
    assert [int(f) for f in fingerprints_of(texts)] == want
    monkeypatch.setattr(simhash, "_LONG_TEXT", 0)
    monkeypatch.setattr(simhash, "_WORDS_AT_ONCE", 7)
    assert [int(f) for f in fingerprints_of(texts)] == want


@pytest.mark.parametrize("which", ["documents", "odd"])
def test_groups(spark, which):
    docs = table(spark, SMALL, "documents") if which == "documents" else odd_rows(spark)
    rows = docs.collect()
    prints = defaultdict(list)
    for r in rows:
        prints[fingerprint(r["text"])].append(r["doc_id"])
    named = component_ids(prints)
    want = Counter((r["doc_id"], f"{fingerprint(r['text']):016x}", named[fingerprint(r["text"])]) for r in rows)
    found = multi_index.groups(docs)
    got = found.select("doc_id", multi_index.hexed(found["fp"]), "component_id").collect()
    assert Counter(map(tuple, got)) == want
    kept = multi_index.keep_one(docs)
    assert kept.columns == docs.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(set(named.values()))


def test_empty_table(spark):
    assert multi_index.groups(empty(spark)).count() == 0
    assert multi_index.keep_one(empty(spark)).count() == 0


def _signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("limit", [2, 5, 256])
def test_no_link_is_lost(spark, limit):
    # Clouds of fingerprints around few centres, so that keys fill up and the index goes down its levels.
    chance = random.Random(limit)
    points = set()
    for _ in range(6):
        centre = chance.getrandbits(64)
        for _ in range(60):
            x = centre
            for _ in range(chance.randrange(5)):
                x ^= 1 << chance.randrange(64)
            points.add(x)
    points |= {0, 1, 7, 15, (1 << 64) - 1, 1 << 63, (1 << 63) | 3}
    prints = spark.createDataFrame([(_signed(p),) for p in points], "fp long")
    want = {tuple(sorted((_signed(a), _signed(b)), reverse=True)) for a in points for b in points if a < b and (a ^ b).bit_count() <= 3}
    got = [tuple(r) for r in multi_index.links(prints, bucket_limit=limit).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(200, 201), (201, 200), (300, 300)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 130)} | {201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
    stars = spark.range(2000).select((F.col("id") + 1).alias("a"), F.floor("id").alias("b"))
    assert components(stars).where("root <> 0").count() == 0


def test_no_side_with_a_row_a_document_is_broadcast(spark):
    """However small Spark takes it to be: the entries under both halves come from an explode, which its sizes leave out."""
    docs = table(spark, SMALL, "documents")
    found = [
        multi_index.links(spark.range(4).toDF("fp")), multi_index.keep_one(docs), multi_index.groups(docs),
        line_spread.dedup(docs),
    ]
    joins = [re.findall(r"(\w*Join) \[(\w*)", df._jdf.queryExecution().executedPlan().toString()) for df in found]
    assert all(joins) and {how for each in joins for how, key in each if key not in ("h1", "root")} == {"SortMergeJoin"}
