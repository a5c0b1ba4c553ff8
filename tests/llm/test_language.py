"""Operator 9: accuracy on rows that are held out, and rows that have no language."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from ledgerloom.llm import hyper_profiles
from ledgerloom.llm.common import table
from tests.llm.plain import ODD_TEXTS, empty, odd_rows


def test_held_out_accuracy(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    found = hyper_profiles.identify(docs).join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in found)
    assert all(0 <= r["score"] <= 1 for r in found)
    judged = [r["lang_pred"] == r["lang"] for r in found if r["held_out"] and r["lang_pred"] != "und"]
    assert len(judged) > 200 and sum(judged) / len(judged) > 0.98


def test_labels_of_held_out_rows_do_not_matter(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    spoilt = docs.withColumn("lang", F.when(hyper_profiles.held_out(), F.lit("xx")).otherwise(F.col("lang")))
    assert {k: v.tolist() for k, v in hyper_profiles.learn(docs).items()} == {k: v.tolist() for k, v in hyper_profiles.learn(spoilt).items()}


def test_odd_rows(spark):
    rows = odd_rows(spark).drop("score")
    found = hyper_profiles.identify(rows).collect()
    assert len(found) == rows.count()
    texts = {r["doc_id"]: r["text"] for r in rows.collect()}
    for r in found:
        if r["doc_id"] is not None and r["doc_id"] != 3 and r["doc_id"] < len(ODD_TEXTS):
            lettered = any(map(str.isalpha, (texts[r["doc_id"]] or "").lower()))
            assert (r["lang_pred"] == "und") == (not lettered)
        if r["doc_id"] is None:
            assert r["held_out"]
    assert hyper_profiles.identify(empty(spark)).count() == 0
    unlearned = hyper_profiles.identify(rows.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r["lang_pred"], r["score"]) for r in unlearned} == {("und", 0.0)}


def test_trigrams_and_their_vectors():
    spelled, counts, lettered = hyper_profiles.trigrams(["Ab  a!!b ab", "", "..", "ab"])
    names = ["".join(map(chr, s)) for s in spelled]
    assert {n: c for n, c in zip(names, counts[0]) if c} == {" ab": 2, "ab ": 2, "b a": 2, " a ": 1, "a b": 1, " b ": 1}
    assert sum(counts[0]) == 9 and sum(counts[3]) == 2 and sum(counts[1]) == 0
    assert lettered.tolist() == [True, False, False, True]
    a, b, gap = (hyper_profiles._letter_vector(c) for c in (97, 98, hyper_profiles.GAP))
    vectors = dict(zip(names, hyper_profiles.trigram_vectors(spelled)))
    assert np.array_equal(vectors[" ab"], np.roll(gap, 2) * np.roll(a, 1) * b)


def test_learning_from_a_bounded_sample(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    profiles = hyper_profiles.learn(docs, most=100)
    assert set(profiles) == {"de", "en", "es", "fr"}
