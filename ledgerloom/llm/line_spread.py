"""Cross-site boilerplate lines (operator 4).

A line that stands on many sites is boilerplate.  One aggregation per line hash merges HyperLogLog
sketches of the sites and finds the line's first place.  Lines whose estimate lies clearly above the
threshold are boilerplate, those clearly below are not, and only those near it (within four standard
errors) are counted exactly.  Boilerplate is removed everywhere but at its first place, so no text
is lost from the corpus as a whole.

Only DataFrame functions.  Repeats of a line collapse in the map-side aggregation; the join that finds
its occurrences sits directly on its shuffles, so adaptive execution splits a line that very many
documents share.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import fresh, quoted, unsent
from ledgerloom.storage import stored

MIN_SITES = 5
LG_K = 12  # sketches of 4096 registers: standard error 1.6 %


def _row_key(docs: DataFrame, id_col: str, text_col: str) -> list[Column]:
    """Two numbers for a row; rows with equal id and text share them and are treated alike."""
    doc_id = quoted(id_col)
    return [
        F.coalesce(doc_id.cast("long"), F.lit(0)).alias("k1"),
        F.xxhash64(doc_id.isNull(), quoted(text_col)).alias("k2"),
    ]


def _lines(docs: DataFrame, site_col: str, id_col: str, text_col: str) -> DataFrame:
    """(k1, k2, site, pos, h1, h2) per line that isn't blank; two hashes keep different lines apart."""
    split = docs.select(
        *_row_key(docs, id_col, text_col),
        quoted(id_col).cast("long").alias("doc_id"),
        quoted(site_col).cast("string").alias("site"),
        F.posexplode(F.split(quoted(text_col), "\n")).alias("pos", "raw"),
    ).withColumn("line", F.btrim("raw", F.lit(" \t\r")))
    return split.where(F.col("line") != "").select(
        "k1", "k2", "doc_id", "site", "pos", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit("second"), "line").alias("h2")
    )


def spread(lines: DataFrame, min_sites: int, lg_k: int) -> DataFrame:
    """(h1, h2, first, sure) of the lines that may be boilerplate; ``sure`` is false where only a count can tell."""
    band = 4 * 1.04 / math.sqrt(2**lg_k)
    low, high = min_sites * (1 - band) - 0.5, min_sites * (1 + band) + 0.5  # the estimate is rounded
    sketches = lines.groupBy("h1", "h2").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(lg_k))).alias("sites"),
        F.min(F.struct("doc_id", "k1", "k2", "pos")).alias("first"),
    )
    return sketches.where(F.col("sites") >= low).select("h1", "h2", "first", (F.col("sites") > high).alias("sure"))


def removals(docs: DataFrame, site_col: str, min_sites: int = MIN_SITES, lg_k: int = LG_K, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(k1, k2, removed): ascending positions of the lines that go, for rows that lose any."""
    lines = _lines(docs, site_col, id_col, text_col)
    # Stored first, so that its real size decides how it is joined, and a shared line can be split where it isn't small.
    candidates = stored(spread(lines, min_sites, lg_k), "line-spread")
    hits = stored(lines.join(candidates, ["h1", "h2"]), "line-hits")
    counted = hits.where(~F.col("sure")).groupBy("h1", "h2").agg(F.countDistinct("site").alias("sites"))
    counted = counted.where(F.col("sites") >= min_sites).select("h1", "h2")
    gone = hits.where("sure").unionByName(hits.where(~F.col("sure")).join(counted, ["h1", "h2"], "left_semi"))
    here = F.struct("k1", "k2", "pos")
    gone = gone.where(here != F.struct(F.col("first.k1"), F.col("first.k2"), F.col("first.pos")))
    return gone.groupBy("k1", "k2").agg(F.sort_array(F.collect_set("pos")).alias("removed"))


def dedup(docs: DataFrame, site_col: str = "source", min_sites: int = MIN_SITES, lg_k: int = LG_K, id_col: str = "doc_id", text_col: str = "text", count_col: str = "n_removed") -> DataFrame:
    """``docs`` with boilerplate lines taken out of the text and their number in ``count_col``.

    A line is boilerplate if it stands, without spaces at its ends, on ``min_sites`` sites or more; blank
    lines never are, and a null site is no site.  It stays at its first place (lowest doc_id, nulls first, then
    position).  All rows and columns stay; null text stays null; a text of boilerplate alone becomes empty.
    """
    k1, k2, removed = (fresh(docs, c) for c in ("_k1", "_k2", "_removed"))
    keys = [c.alias(n) for c, n in zip(_row_key(docs, id_col, text_col), (k1, k2))]
    gone = removals(docs, site_col, min_sites, lg_k, id_col, text_col).toDF(k1, k2, removed)
    joined = docs.select("*", *keys).join(unsent(gone), [k1, k2], "left")
    lines, cuts = F.split(quoted(text_col), "\n"), F.col(removed)
    # What stays are the runs between two removed positions, and those at both ends.
    bounds = F.concat(F.array(F.lit(-1)), cuts, F.array(F.size(lines)))
    runs = F.transform(
        F.arrays_zip(F.slice(bounds, 1, F.size(bounds) - 1).alias("a"), F.slice(bounds, 2, F.size(bounds) - 1).alias("b")),
        lambda gap: F.slice(lines, gap["a"] + 2, gap["b"] - gap["a"] - 1),
    )
    kept = F.when(cuts.isNull(), quoted(text_col)).otherwise(F.array_join(F.flatten(runs), "\n"))
    return joined.select(
        *[kept.alias(c) if c == text_col else quoted(c) for c in docs.columns],
        F.when(cuts.isNull(), 0).otherwise(F.size(cuts)).cast("int").alias(count_col),
    )


def sql(min_sites: int = MIN_SITES) -> str:
    """(doc_id, text, n_removed) of table ``documents`` in DuckDB SQL."""
    return f"""
WITH lines AS (
  SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS raw,
         generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents
), named AS (
  SELECT *, trim(raw, chr(32) || chr(9) || chr(13)) AS line FROM lines
), spread AS (
  SELECT line, min(doc_id * 1000000000 + pos) AS first FROM named WHERE line <> ''
  GROUP BY line HAVING count(DISTINCT source) >= {min_sites}
), marked AS (
  SELECT n.doc_id, n.raw, n.pos, s.line IS NOT NULL AND n.doc_id * 1000000000 + n.pos <> s.first AS gone
  FROM named n LEFT JOIN spread s ON n.line = s.line
)
SELECT doc_id, coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text,
       CAST(count(*) FILTER (gone) AS INTEGER) AS n_removed
FROM marked GROUP BY doc_id
UNION ALL SELECT doc_id, text, 0 FROM documents WHERE text IS NULL"""
