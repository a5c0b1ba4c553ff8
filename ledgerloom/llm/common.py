"""Helpers that the corpus operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

WORDS_KEPT = 400_000  # entries of a task's word cache


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(name: str) -> Column:
    """The column of this exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) only, so that further columns can't clash with an operator's own."""
    return docs.select(quoted(id_col).cast("long").alias("doc_id"), quoted(text_col).alias("text"))


def unsent(side: DataFrame) -> DataFrame:
    """A join side with a row a document or more, for joins that must not broadcast it.

    Spark sizes a side by the files that it comes from: rows that an explode or packed columns add don't count, so
    a side just under the broadcast limit may be many times as large in the driver's memory.
    """
    return side.hint("merge")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


class WordCache:
    """Word to value for one task, made by ``make(words)`` in batches; holds ``limit`` words, about.

    Two generations: words in use move to the young one, and when that is half full, it becomes the old
    one and what the old one still held goes.  So common words stay and memory is bounded.
    """

    def __init__(self, make: Callable[[list], list], limit: int = WORDS_KEPT):
        self.make, self.limit = make, limit
        self.young: dict = {}
        self.old: dict = {}

    def of(self, words: set) -> dict:
        """A table that has at least ``words``; good until the next call."""
        new = [w for w in words if w not in self.young]
        if self.young and len(self.young) + len(new) > self.limit // 2:
            self.old, self.young, new = self.young, {}, list(words)
        old, young, missing = self.old, self.young, []
        for w in new:
            if w in old:
                young[w] = old[w]
            else:
                missing.append(w)
        if missing:
            young.update(zip(missing, self.make(missing)))
        return young

    def clear(self) -> None:
        """At the end of a task, so that a Python worker that waits for other work holds no words."""
        self.young, self.old = {}, {}


def slices(batches: Iterator[pa.RecordBatch], column: int, most_bytes: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the strings of ``column`` take about ``most_bytes`` each (one row at least)."""
    for batch in batches:
        start, n = 0, batch.num_rows
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
        filled = 0
        for i in range(n):
            if i > start and filled + sizes[i] > most_bytes:
                yield batch.slice(start, i - start)
                start, filled = i, 0
            filled += sizes[i]
        if n > start:
            yield batch.slice(start)


def append(docs: DataFrame, text_col: str, fields: str, make: Callable[[], Callable[[list], list]], most_bytes: int = 1 << 19) -> DataFrame:
    """``docs`` with new columns that depend on the text of the row alone.

    ``make()`` runs once per task and returns a function from a list of texts (None for null) to one
    list or array per column of ``fields`` (DDL); the new names must not be in ``docs`` yet.
    """
    new = T.StructType.fromDDL(fields)
    at, types = docs.columns.index(text_col), to_arrow_schema(new).types
    # Plain names on the way, as Python operators can't address a column with a dot in its name.
    plain = [f"c{i}" for i in range(len(docs.columns) + len(new))]
    schema = T.StructType([T.StructField(n, f.dataType) for n, f in zip(plain, [*docs.schema.fields, *new.fields])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = make()
        for batch in slices(batches, at, most_bytes):
            values = function(batch.column(at).to_pylist())
            columns = [v if isinstance(v, pa.Array) else pa.array(v, t) for v, t in zip(values, types)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], plain)

    return docs.toDF(*plain[: len(docs.columns)]).mapInArrow(run, schema).toDF(*docs.columns, *new.names)
