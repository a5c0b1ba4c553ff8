"""Operator 4."""

from collections import Counter

import pytest

from ledgerloom.llm import line_spread
from ledgerloom.llm.common import table
from tests.compare import connect
from tests.llm.plain import SMALL, boilerplate_removed, empty, odd_rows


@pytest.mark.parametrize("min_sites", [2, 5])
def test_lines_equal_the_plain_version(spark, min_sites):
    docs = table(spark, SMALL, "documents")
    found = line_spread.dedup(docs, min_sites=min_sites)
    want = boilerplate_removed([(r["doc_id"], r["text"], r["source"]) for r in docs.collect()], min_sites)
    assert Counter((r["doc_id"], r["text"], r["n_removed"]) for r in found.collect()) == Counter(want)
    assert sum(r[2] for r in want)


def test_lines_equal_the_sql(spark):
    docs = table(spark, SMALL, "documents")
    rows = connect(SMALL).execute(line_spread.sql(2)).fetchall()
    found = line_spread.dedup(docs, min_sites=2).select("doc_id", "text", "n_removed").collect()
    assert Counter(map(tuple, found)) == Counter(rows)


def test_odd_rows(spark):
    rows = odd_rows(spark)
    found = line_spread.dedup(rows, min_sites=2)
    assert found.columns == [*rows.columns, "n_removed"]
    want = boilerplate_removed([(r["doc_id"], r["text"], r["source"]) for r in rows.collect()], 2)
    assert Counter((r["doc_id"], r["text"], r["n_removed"]) for r in found.collect()) == Counter(want)
    assert line_spread.dedup(empty(spark)).count() == 0


@pytest.mark.parametrize("lg_k", [4, 12])
def test_a_line_stays_once_and_near_counts_are_exact(spark, lg_k):
    # "near i" stands on i sites; with coarse sketches the estimate alone would misjudge some.
    rows = [(100 * i + s, f"own {i} {s}\nnear {i}\n  near {i}\t\nend", f"site{s}") for i in range(1, 60) for s in range(i)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = line_spread.dedup(docs, min_sites=30, lg_k=lg_k)
    want = boilerplate_removed(rows, 30)
    assert Counter((r["doc_id"], r["text"], r["n_removed"]) for r in found.collect()) == Counter(want)
    assert sum(r["text"].count("near 45") for r in found.collect()) == 1


def test_no_python_in_the_plan(spark):
    plan = line_spread.dedup(table(spark, SMALL, "documents"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
