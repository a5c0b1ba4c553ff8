"""Token counts of the documents in flat token files (operator 1).

A flat file holds fixed-width ids and nothing else; each document ends with the end id, which no text
may give.  The files are read in blocks of equal size by many tasks, one vectorised comparison finds the end ids of a
block, and a prefix scan over one small row per block stitches what crosses block boundaries:

* the last end id before a block says how much of its first document lies in earlier blocks;
* the number of end ids before a block numbers its documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import id_and_text, slices
from ledgerloom.llm.word_tokens import batches_of, encoder, texts_of
from ledgerloom.storage import stored

BLOCK_BYTES = 4 << 20


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI of Spark's, by the name that Arrow has for its scheme."""
    for spark_scheme in ("s3a:", "s3n:"):
        if uri.startswith(spark_scheme):
            uri = "s3:" + uri[len(spark_scheme) :]
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:") :]
    return fs.FileSystem.from_uri(uri)


def write_flat(docs: DataFrame, folder: str, tokenizer: str, end_id: int, dtype: str = "<u2", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One flat file per partition of ``docs``, in the order of its rows; returns which document stands where.

    A task writes under a name of its own attempt and renames at the end, so a repeated task leaves
    the same file.  Null text counts as empty.  A text that gives the end id itself is an error, as the
    scan would take it for several documents.  The result (doc_id, part, row) is stored, which writes
    the files.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        part, words, row = task.partitionId(), encoder(tokenizer, dtype), 0
        files, base = _open(folder)
        files.create_dir(base, recursive=True)
        name = f"{base}/.part-{part:06d}-{task.taskAttemptId()}"
        with files.open_output_stream(name) as out:
            for batch in slices(batches, 1):
                n, packed = batch.num_rows, b"".join(words.encode(texts_of(batch), end_id))
                if np.count_nonzero(np.frombuffer(packed, dtype) == end_id) != n:
                    raise ValueError(f"a text gives the end id {end_id} itself; take an id outside the vocabulary")
                out.write(packed)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([part] * n, pa.int32()), pa.array(range(row, row + n), pa.int64())],
                    ["doc_id", "part", "row"],
                )
                row += n
        files.move(name, f"{base}/part-{part:06d}.ids")

    # A frame that Spark plans without any partition runs no task, so the driver makes the folder.
    context = docs.sparkSession.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(context._jsc.hadoopConfiguration()).mkdirs(path)
    return stored(id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, part int, row long"), "flat-rows")


def scan(spark: SparkSession, folder: str, end_id: int, dtype: str = "<u2", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(path, row, start, n_tokens, closed) of every document in the ``*.ids`` files of ``folder``.

    ``row`` counts the documents of a file from 0, ``start`` the ids before it in the file, and
    ``n_tokens`` its ids with the end id.  Ids behind the last end id of a file are a document with
    ``closed`` false; a file without ids has none.
    """
    width = np.dtype(dtype).itemsize
    size = max(1, block_bytes // width) * width
    paths = spark.read.format("binaryFile").option("pathGlobFilter", "*.ids").load(folder).select("path", "length")  # contents stay unread
    blocks = (
        paths.where(F.col("length") > 0)
        .select("path", "length", F.explode(F.sequence(F.lit(0), F.floor((F.col("length") - 1) / size))).alias("block"))
        .repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path", "block")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for path, length, block in zip(*(c.to_pylist() for c in batch.columns)):
                    files, name = _open(path)
                    with files.open_input_file(name) as source:
                        source.seek(block * size)
                        ids = np.frombuffer(source.read(min(size, length - block * size)), dtype)
                    ends = np.flatnonzero(ids == end_id)
                    first = block * (size // width)
                    yield path, block, first, len(ids), (first + ends + 1).tolist()

        return batches_of(rows(), ["path", "block", "first", "n", "ends"], [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())], 64)

    found = stored(blocks.mapInArrow(run, "path string, block long, first long, n long, ends array<long>"), "separators")
    # Prefix scan over one row per block.
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("path")
    carried = found.select("path", "block", "first", "n", F.size("ends").alias("k"), F.try_element_at("ends", F.lit(-1)).alias("end")).select(
        "path",
        "block",
        F.coalesce(F.max("end").over(before), F.lit(0)).alias("open_from"),
        F.coalesce(F.sum("k").over(before), F.lit(0)).alias("row_before"),
        (F.col("block") == F.max("block").over(whole)).alias("is_last"),
    )
    rows = found.join(carried, ["path", "block"])
    total = F.col("first") + F.col("n")
    rest = F.coalesce(F.try_element_at("ends", F.lit(-1)), F.col("open_from")) < total
    ends = F.when(F.col("is_last") & rest, F.concat("ends", F.array(total))).otherwise(F.col("ends"))
    rows = rows.withColumn("closed_ends", F.size("ends")).withColumn("ends", ends)
    starts = F.concat(F.array("open_from"), F.slice("ends", 1, F.greatest(F.size("ends") - 1, F.lit(0))))
    return rows.where(F.size("ends") > 0).select(
        "path", "row_before", "closed_ends", F.posexplode(F.arrays_zip(starts.alias("start"), F.col("ends").alias("end"))).alias("at", "doc")
    ).select(
        "path",
        (F.col("row_before") + F.col("at")).alias("row"),
        F.col("doc.start").alias("start"),
        (F.col("doc.end") - F.col("doc.start")).alias("n_tokens"),
        (F.col("at") < F.col("closed_ends")).alias("closed"),
    )


def counts(docs: DataFrame, folder: str, tokenizer: str, end_id: int) -> DataFrame:
    """(doc_id, part, row, start, n_tokens) of ``docs`` from flat files that are written first and then scanned."""
    placed = write_flat(docs, folder, tokenizer, end_id)
    part = F.regexp_extract("path", r"part-(\d+)\.ids$", 1).cast("int")
    found = scan(docs.sparkSession, folder, end_id).select(part.alias("part"), "row", "start", "n_tokens")
    return placed.join(found, ["part", "row"]).select("doc_id", "part", "row", "start", "n_tokens")
