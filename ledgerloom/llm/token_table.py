"""Token ids as Parquet list columns (operator 3).

One row per document in ascending doc_id order: ids as a list column with dictionary pages (a token
id has few distinct values), the increasing numbers with delta encoding, small pages with page
indexes in row groups of a set size.  So a reader fetches the counts without touching the ids, and
the ids of a doc_id range without touching the other pages.

``start`` is kept relative to its part (one part for each task that wrote); :func:`read_index` adds
the totals of earlier parts, one row per part.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import slices
from ledgerloom.llm.word_tokens import encoder, in_order, list_array, texts_of

SCHEMA = "doc_id long, part int, part_start long, n_tokens long, ids array<int>"


def tokenized(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of the file.  Null text counts as empty (the end id alone); repeated rows stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part, start = encoder(tokenizer, "<i4"), TaskContext.get().partitionId(), 0
        for batch in slices(batches, 1, 2 << 20):
            packed = words.encode(texts_of(batch), end_id)
            counts = [len(p) // 4 for p in packed]
            starts = []
            for n in counts:
                starts.append(start)
                start += n
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([part] * len(counts), pa.int32()), pa.array(starts, pa.int64()),
                 pa.array(counts, pa.int64()), list_array(packed)],
                ["doc_id", "part", "part_start", "n_tokens", "ids"],
            )

    return in_order(docs, id_col, text_col).mapInArrow(run, SCHEMA)


def write(tokens: DataFrame, path: str, row_group_bytes: int = 32 << 20, page_bytes: int = 256 << 10, page_rows: int = 512) -> None:
    """Write :func:`tokenized` rows; each task writes the row groups of its part in order."""
    options = {
        "compression": "zstd",
        "parquet.writer.version": "v2",  # numbers without a dictionary get delta encoding
        "parquet.enable.dictionary": "true",
        "parquet.enable.dictionary#doc_id": "false",
        "parquet.enable.dictionary#part_start": "false",
        "parquet.enable.dictionary#n_tokens": "false",
        "parquet.block.size": str(row_group_bytes),
        "parquet.page.size": str(page_bytes),
        "parquet.page.row.count.limit": str(page_rows),
    }
    tokens.write.options(**options).parquet(path)


def _with_start(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """``rows`` with the count of all ids before them instead of the place in the part."""
    totals = spark.read.schema(SCHEMA).parquet(path).groupBy("part").agg(F.sum("n_tokens").alias("total"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("before"))
    # One row per task that wrote: bounded by the number of shuffle partitions.
    return rows.join(F.broadcast(offsets), "part").withColumn("start", F.col("part_start") + F.col("before")).drop("part", "part_start", "before")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, n_tokens, start) without reading any ids."""
    return _with_start(spark, path, spark.read.schema(SCHEMA).parquet(path).drop("ids"))


def read_tokens(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids, start) of doc_ids from ``first`` to ``last``; other pages stay unread."""
    rows = spark.read.schema(SCHEMA).parquet(path)
    if first is not None:
        rows = rows.where(F.col("doc_id") >= first)
    if last is not None:
        rows = rows.where(F.col("doc_id") <= last)
    return _with_start(spark, path, rows)


def digest(spark: SparkSession, path: str) -> DataFrame:
    """Start, count and crc32 of each document's ids, as read from the file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends, values = batch.column(3).offsets.to_numpy(), batch.column(3).values.to_numpy()
            sums = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(ends, ends[1:])]
            counts = (ends[1:] - ends[:-1]).tolist()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(counts, pa.int64()), pa.array(sums, pa.int64())],
                ["doc_id", "part", "part_start", "n_tokens", "ids_crc32"],
            )

    rows = spark.read.schema(SCHEMA).parquet(path).select("doc_id", "part", "part_start", "ids")
    sums = rows.mapInArrow(run, "doc_id long, part int, part_start long, n_tokens long, ids_crc32 long")
    return _with_start(spark, path, sums)
