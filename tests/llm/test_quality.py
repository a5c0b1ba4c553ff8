"""Operator 10: counts against the plain version, verdicts against the labels."""

from collections import Counter

import numpy as np

from ledgerloom.llm import isolation_rules
from ledgerloom.llm.common import table
from tests.llm.plain import SMALL, base_counts, empty, odd_rows

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_base_counts(spark):
    for docs in (table(spark, SMALL, "documents"), odd_rows(spark)):
        found = isolation_rules.judge(docs, table(spark, SMALL, "labels")).collect()
        want = Counter((r["doc_id"], *base_counts(r["text"])) for r in docs.collect())
        assert Counter((r["doc_id"], *(r[c] for c in BASE)) for r in found) == want
        assert not any(r["base_failed"] and r["kept"] for r in found)


def test_verdicts_follow_the_labels(spark):
    folder = "/root/testdata/sf0.1"
    found = isolation_rules.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))
    rows = found.join(table(spark, folder, "labels"), "doc_id").where("NOT base_failed").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1]
    bad = [r["kept"] for r in rows if r["quality"] == 0]
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.05


def test_without_labels_the_base_rule_decides(spark):
    docs = table(spark, SMALL, "documents")
    for labels in (table(spark, SMALL, "labels").where("false"), table(spark, SMALL, "labels").where("quality = 1")):
        assert isolation_rules.judge(docs, labels).where("kept = base_failed").count() == 0
    assert isolation_rules.judge(empty(spark), table(spark, SMALL, "labels")).count() == 0


def test_odd_labels(spark):
    labels = spark.createDataFrame([(1, None), (None, 1), (2, 1), (2, 0), (2, 0), (3, 1)], "doc_id long, quality int")
    assert isolation_rules.judge(odd_rows(spark), labels).count() == odd_rows(spark).count()


def test_the_forest_isolates_what_is_odd():
    random = np.random.default_rng(5)
    rows = np.concatenate([random.normal(size=(2000, 3)), [[9, 9, 9], [-8, 8, 8]]])
    scores = isolation_rules.IsolationForest(rows).score(rows)
    assert set(np.argsort(scores)[-2:]) == {2000, 2001}
    assert isolation_rules.IsolationForest(rows[:1]).score(rows[:3]).shape == (3,)


def test_threshold():
    assert isolation_rules.threshold({(1, 300): 1000, (0, 600): 10, (0, 310): 1, (1, 310): 1}) == 0.31
    assert isolation_rules.threshold({(1, 300): 1000}) > 1


def plain_score(forest, row):
    """Path by path: the row goes down each tree by its splits."""
    total = 0.0
    for feature, cut, left, right, length in forest.trees:
        at = 0
        while feature[at] >= 0:
            at = left[at] if row[feature[at]] <= cut[at] else right[at]
        total += length[at]
    n = forest.size
    usual = 0.0 if n < 2 else 1.0 if n == 2 else 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n
    return 2 ** (-(total / len(forest.trees)) / max(usual, 1e-9))


def test_verdicts_equal_a_plain_forest(spark):
    """Features, learning rows, threshold and verdict of each document, without Spark."""
    folder = "/root/testdata/sf0.01"
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    quality = {}
    for r in labels.where("quality IS NOT NULL").collect():
        quality[r["doc_id"]] = min(r["quality"], quality.get(r["doc_id"], 1))
    rows = {}
    for r in docs.collect():
        text = r["text"] or ""
        n_words, chars, symbols, _, repeated, failed = base_counts(text)
        upper, marks = sum("A" <= c <= "Z" for c in text), sum(c in "!?" for c in text)
        words, chars = float(max(n_words, 1)), float(max(chars, 1))
        rows[r["doc_id"]] = failed, (
            symbols / chars, np.log1p(100 * symbols / words), np.log1p(100 * marks / words), max(upper / chars - 0.1, 0), max(repeated / words - 0.3, 0))
    learned = sorted((i, *x) for i, (failed, x) in rows.items() if not failed and i in quality)
    forest = isolation_rules.IsolationForest(np.array([x[1:] for x in learned]))
    steps = {i: round(plain_score(forest, x) * 1000) for i, (_, x) in rows.items()}
    limit = isolation_rules.threshold(Counter((quality[x[0]], steps[x[0]]) for x in learned))
    want = {i: not failed and steps[i] / 1000 < limit for i, (failed, _) in rows.items()}
    found = {r["doc_id"]: r["kept"] for r in isolation_rules.judge(docs, labels).collect()}
    assert found == want and 0 < sum(want.values()) < sum(not failed for failed, _ in rows.values())


def test_labels_on_failed_rows_only(spark):
    docs, labels = table(spark, SMALL, "documents"), table(spark, SMALL, "labels")
    failed = isolation_rules.judge(docs, labels).where("base_failed").select("doc_id")
    found = isolation_rules.judge(docs, labels.join(failed, "doc_id"))
    assert found.where("kept = base_failed").count() == 0
