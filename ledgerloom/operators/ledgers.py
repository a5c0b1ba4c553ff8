"""Ledgers stored in hash buckets of the settlement.

The check "is this settlement booked already?" runs on every report.  Against a bucketed ledger only the
new rows are shuffled, to the ledger's buckets; the ledger is read as it lies.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerloom.operators.maintenance import align_to

LEDGER_BUCKETS = 32


def open_ledger(spark: SparkSession, path: str, key: str, schema: T.StructType, buckets: int = LEDGER_BUCKETS) -> str:
    """Name of the table over the ledger at ``path``, which needs no rows yet; the same path gives the same table.

    The files tell rows apart by bucket, but only the table knows that they do, so a session opens a ledger
    before it reads it.  ``key`` and ``buckets`` have to be those that the ledger was begun with.
    """
    name = f"ledger_{hashlib.md5(path.encode()).hexdigest()}"
    if spark.catalog.tableExists(name):
        return name
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {int(buckets)} BUCKETS LOCATION '{path}'"
    )
    return name


def book(df: DataFrame, ledger: str) -> None:
    """Append rows to an opened ledger by column name; a large bucket is written by several tasks."""
    spark = df.sparkSession
    target = spark.table(ledger)
    key = next(c.name for c in spark.catalog.listColumns(ledger) if c.isBucket)
    align_to(df, target.schema).hint("rebalance", key).write.insertInto(ledger)
