"""Ledgers and their roll-ups stored by month of the business date.

A roll-up of one month reads that month's folder only, and a batch of new ledger lines rolls only its own
months up again: the ledger is pruned at run time by the months of the batch, and the roll-up's other
folders stay as they are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONTH = "ledger_month"  # the partition column: yyyy-MM, as text
UNDATED = "undated"
SHARD = "ledger_shard"
SHARDS = 16  # parts of a month that are rolled up by tasks of their own


def month_of(ts: str | Column) -> Column:
    """Partition of a date or time; rows without one have a partition of their own."""
    column = F.col(ts) if isinstance(ts, str) else ts
    return F.coalesce(F.date_format(column.cast("date"), "yyyy-MM"), F.lit(UNDATED))


def append_by_month(df: DataFrame, ts: str, path: str) -> None:
    """Add lines; a month is one file per append, or several where it is large."""
    placed = df.withColumn(MONTH, month_of(ts))
    placed.hint("rebalance", MONTH).write.mode("append").partitionBy(MONTH).parquet(path)


def read_by_month(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table with its partition column; ``schema`` are the columns without it."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField(MONTH, T.StringType())])).parquet(path)


def in_months_of(table: DataFrame, batch: DataFrame, ts: str) -> DataFrame:
    """Rows of a stored table in the months that a batch touches; the other months' files aren't read.

    The months are found by a subquery when the scan starts; there are at most as many as the calendar has.
    """
    touched = batch.agg(F.collect_set(month_of(ts))).scalar()
    return table.where(F.array_contains(touched, F.col(MONTH)))


def refresh_rollup(
    ledger: DataFrame, batch: DataFrame, ts: str, roll_up: Callable[[DataFrame], DataFrame], month: str, path: str,
    shard_by: str | None = None,
) -> None:
    """Bring the roll-up stored at ``path`` up to date after ``batch`` was added to ``ledger``.

    ``roll_up`` groups by ``month``, the first day of the month of ``ts``, among other keys.  Run again, it
    writes the same rows; an empty batch writes nothing.  With ``shard_by``, a column that ``roll_up`` groups by,
    it has to group by ``MONTH`` and ``SHARD`` as well, which follow from its keys: the lines are then shuffled by
    these once, for the sums and for the files.
    """
    rows = rolled_up(in_months_of(ledger, batch, ts), roll_up, month, shard_by)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(path)


def rolled_up(lines: DataFrame, roll_up: Callable[[DataFrame], DataFrame], month: str, shard_by: str | None) -> DataFrame:
    """The roll-up with its partition column, spread for writing; see :func:`refresh_rollup`."""
    if shard_by is None:
        return roll_up(lines).withColumn(MONTH, month_of(month)).hint("rebalance", MONTH)
    shard = F.pmod(F.xxhash64(shard_by), F.lit(SHARDS))
    return roll_up(lines.withColumn(SHARD, shard).repartition(MONTH, SHARD)).drop(SHARD)
