"""File-triggered jobs.

All run with ``availableNow``: they take what has arrived since the last run, as recorded in
their checkpoint, and stop.  Schedule them, or change the trigger to keep them running.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from ledgerloom.functions.dates import instant_to_ntz
from ledgerloom.operators.joins import not_booked
from ledgerloom.streaming.keyed_table import BUCKETS, KeyedTable


def file_stream(
    spark: SparkSession, folder: str, schema: T.StructType, fmt: str = "parquet",
    files_per_batch: int | None = None, **options: str,
) -> DataFrame:
    """New files of a folder with their name; a file is seen once, even if the job restarts."""
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder).withColumn("FILE_NAME", F.col("_metadata.file_name"))


def _finish(writer: DataStreamWriter, checkpoint: str) -> None:
    run = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    run.awaitTermination()


def load_new_files(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Append the rows of new files to a parquet table, exactly once."""
    _finish(stream.writeStream.format("parquet").option("path", target).outputMode("append"), checkpoint)


def _each_batch(stream: DataFrame, checkpoint: str, step: Callable[[DataFrame, int], None]) -> None:
    _finish(stream.writeStream.foreachBatch(step).outputMode("append"), checkpoint)


def read_versions(spark: SparkSession, target: str, name: str, upto: int | None = None) -> DataFrame | None:
    """The finished folders of a table kept in numbered ones, or None before the first; unfinished ones stay unread."""
    numbers = [n for n in _version_numbers(spark, target, name) if upto is None or n < upto]
    return spark.read.option("basePath", target).parquet(*[f"{target}/{name}={n}" for n in sorted(numbers)]) if numbers else None


def _version_numbers(spark: SparkSession, target: str, name: str) -> list[int]:
    """Numbers of the folders ``name=n`` that a finished write has left; any other trouble with the path is an error."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(path):
        return []
    names = [s.getPath() for s in files.listStatus(path) if s.getPath().getName().startswith(f"{name}=")]
    done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return [int(p.getName().split("=")[1]) for p in names if files.exists(done(p, "_SUCCESS"))]


def replace_keys(stream: DataFrame, key: str, target: str, checkpoint: str, buckets: int = BUCKETS) -> None:
    """Keep the latest rows per key in a :class:`KeyedTable`: a batch rewrites the buckets of its own keys only."""
    def step(batch: DataFrame, number: int) -> None:
        batch.persist()  # read for its buckets, its keys and its rows
        try:
            KeyedTable(batch.sparkSession, target, key, buckets).replace(batch, number)
        finally:
            batch.unpersist()

    _each_batch(stream, checkpoint, step)


def book_once(stream: DataFrame, key: str, ledger: str, checkpoint: str) -> None:
    """Append the rows of settlements that no earlier batch has booked.

    Each batch owns the folder ``batch=n`` and compares with the folders before it, so a
    repeated batch gives the same rows.  A settlement's rows must arrive in one batch: later
    rows of a booked settlement are left out, as in the batch reports.
    """
    def step(batch: DataFrame, number: int) -> None:
        booked = read_versions(batch.sparkSession, ledger, "batch", number)
        not_booked(batch, booked, key).write.mode("overwrite").parquet(f"{ledger}/batch={number}")

    _each_batch(stream, checkpoint, step)


def _event_time(stream: DataFrame, ts: str, late_days: int) -> DataFrame:
    """Watermark on ``_event``, the zone-less time read as UTC (a watermark needs an instant)."""
    instant = F.timestamp_seconds(F.unix_timestamp(ts))
    return stream.withColumn("_event", instant).withWatermark("_event", f"{late_days} days")


def daily_totals(stream: DataFrame, ts: str, keys: list[str], value: str, late_days: int = 14) -> DataFrame:
    """Daily sums per key; a day stays open for late records until ``late_days`` have passed after it.

    The state holds one row per open day and key.  Repeated records must be removed before,
    see :func:`distinct_records`.
    """
    return (
        _event_time(stream, ts, late_days)
        .groupBy(F.window("_event", "1 day").alias("_day"), *keys)
        .agg(F.sum(value).alias("total"))
        .select(instant_to_ntz(F.col("_day.start")).cast("date").alias("day"), *keys, "total")
    )


def distinct_records(stream: DataFrame, ts: str, record_key: list[str], late_days: int = 14) -> DataFrame:
    """First arrival of each record within the late-data tail."""
    return _event_time(stream, ts, late_days).dropDuplicatesWithinWatermark(record_key).drop("_event")


def write_daily_totals(totals: DataFrame, target: str, checkpoint: str) -> None:
    """Write the totals that each batch has changed, open days included, to a folder of its own.

    A repeated batch overwrites its folder.  Use :func:`read_daily_totals` to read.
    """
    def step(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

    _finish(totals.writeStream.foreachBatch(step).outputMode("update"), checkpoint)


def read_daily_totals(spark: SparkSession, target: str, keys: list[str]) -> DataFrame | None:
    """The latest total of each day and key; None before the first write."""
    rows = read_versions(spark, target, "batch")
    if rows is None:
        return None
    return rows.groupBy("day", *keys).agg(F.max_by("total", "batch").alias("total"))
