"""Incremental table maintenance: idempotent loads, replacement, trimming, cursors.

Each operator returns the new content of the target; the caller writes it.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Cursor starts used when a target has no usable row.
NO_ORDER_CURSOR = "9999999999999"
NO_PAYOUT_CURSOR = 0
RELOAD_TAIL_DAYS = 14
OPEN_PAYOUT_STATES = ("pending", "in_transit")

# Hours before today's midnight at which each report window ends (one second less).
WINDOW_LAG_SECONDS = {
    "payouts": 24 * 3600 + 1,
    "balance": 48 * 3600 + 1,
    "webhook": 29 * 3600 + 1,
    "legacy": 24 * 3600,
}


def align_to(df: DataFrame, target: T.StructType, strict: bool = True) -> DataFrame:
    """Target's columns in target order; a missing one is an error, or NULL if not strict."""
    missing = [f.name for f in target.fields if f.name not in df.columns]
    if strict and missing:
        raise KeyError(f"missing columns: {missing}")
    return df.select(
        *[
            F.lit(None).cast(f.dataType).alias(f.name) if f.name in missing else F.col(f.name)
            for f in target.fields
        ]
    )


def conform(
    df: DataFrame, schema: T.StructType, deprecated: Sequence[str] = (), marker: str = "DEPRECATED"
) -> DataFrame:
    """Declared columns only, cast without errors; missing ones are NULL or the marker."""
    columns = []
    for field in schema.fields:
        if field.name in df.columns:
            value = F.col(f"`{field.name}`").try_cast(field.dataType)
        else:
            value = F.lit(marker if field.name in deprecated else None).cast(field.dataType)
        columns.append(value.alias(field.name))
    return df.select(*columns)


def quarantine(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Split into typed good rows and untouched bad rows.

    A row is bad if a non-NULL text value of a declared column cannot be read as its type.
    """
    def unreadable(field: T.StructField) -> Column:
        raw = F.col(field.name)
        return raw.isNotNull() & raw.try_cast(field.dataType).isNull()

    bad = F.lit(False)
    for field in schema.fields:
        bad = bad | unreadable(field)
    good = df.where(~bad).select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])
    return good, df.where(bad)


def stamp(df: DataFrame, file_name: Column | None = None, ts: Column | None = None,
          ts_name: str = "UPLOADED_DATETIME") -> DataFrame:
    """Lineage columns: source file and load time (pass both for repeatable runs)."""
    return df.withColumn(
        "FILE_NAME", file_name if file_name is not None else F.col("_metadata.file_name")
    ).withColumn(ts_name, ts if ts is not None else F.current_timestamp())


def new_files_only(df: DataFrame, existing: DataFrame | None, column: str = "FILE_NAME") -> DataFrame:
    """Rows of files that the target has not loaded yet; everything if there is no target."""
    if existing is None:
        return df
    loaded = existing.select(F.col(column).alias("_loaded")).distinct()
    return df.join(loaded, df[column] == loaded["_loaded"], "left_anti")


def replace_by_key(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Target without the keys of the batch, plus the batch."""
    keys = batch.select(F.col(key).cast("string").alias("_key")).distinct()
    kept = target.join(keys, target[key].cast("string") == keys["_key"], "left_anti")
    return kept.unionByName(batch)


def last_settled(target: DataFrame, days: int, as_of: date, number: str = "order_number", created: str = "created_at") -> DataFrame:
    """One row: the greatest number created more than ``days`` ago, NULL if no row is that old."""
    cutoff = F.lit(as_of).cast("timestamp_ntz") - F.expr(f"interval '{days}' day")
    return target.where(F.col(created) < cutoff).agg(F.max(F.col(number).try_cast("bigint")))


def first_open(target: DataFrame, key: str = "id", status: str = "payout_status") -> DataFrame:
    """One row: the smallest open payout id, NULL if all are closed."""
    return target.where(F.col(status).isin(*OPEN_PAYOUT_STATES)).agg(F.min(F.col(key).try_cast("bigint")))


def trim_recent(target: DataFrame, days: int, as_of: date, number: str = "order_number",
                created: str = "created_at") -> DataFrame:
    """Drop rows numbered above the greatest number created more than ``days`` ago.

    Rows without a number stay; so does everything if no row is that old.
    """
    settled = last_settled(target, days, as_of, number, created).scalar()
    return target.where(~F.coalesce(F.col(number).try_cast("bigint") > settled, F.lit(False)))


def trim_from_first_pending(target: DataFrame, key: str = "id", status: str = "payout_status") -> DataFrame:
    """Drop every row from the smallest open payout id on."""
    opened = first_open(target, key, status).scalar()
    return target.where(~F.coalesce(F.col(key).try_cast("bigint") >= opened, F.lit(False)))


def high_water_mark(target: DataFrame, order_col: str, return_col: str, default: str | None = None) -> DataFrame:
    """One row: ``return_col`` of the row with the numerically greatest ``order_col``."""
    mark = F.max_by(F.col(return_col), F.col(order_col).try_cast("bigint"))
    return target.agg(F.coalesce(mark, F.lit(default).cast("string")).alias("cursor"))


def time_cursor(target: DataFrame, ts: str, default: Column, after_seconds: int = 0) -> DataFrame:
    """One row: the latest time in the target, some seconds on; ``default`` where the target has none."""
    latest = F.max(ts) + F.make_dt_interval(secs=F.lit(after_seconds))
    return target.agg(F.coalesce(latest, default).alias("cursor"))


def last_refunded_order(orders: DataFrame, refunds: DataFrame) -> DataFrame:
    """Order ids under the name that holds the greatest refund id."""
    name = refunds.agg(F.max_by("name", "id")).scalar()
    return orders.where(F.col("name") == name).select("id").distinct()


def incremental_window(df: DataFrame, ts: str, start_after: Column, as_of: date, lag: str = "payouts") -> DataFrame:
    """Rows after the cursor up to the end of the report window of the given kind."""
    end = F.lit(as_of).cast("timestamp_ntz") - F.expr(f"interval '{WINDOW_LAG_SECONDS[lag]}' second")
    return df.where((F.col(ts) > start_after) & (F.col(ts) <= end))


def adjust_rows(df: DataFrame, predicate: Column, assignments: dict[str, Column]) -> DataFrame:
    """Rewrite columns on the rows that meet the predicate; all rows stay."""
    hit = F.coalesce(predicate, F.lit(False))
    return df.select(
        *[F.when(hit, assignments[c]).otherwise(F.col(c)).alias(c) if c in assignments else F.col(c) for c in df.columns]
    )


def append_table(df: DataFrame, table: str, path: str | None = None) -> None:
    """Append by column name; an empty frame appends nothing.  A new table lies at ``path``, else in the warehouse."""
    writer = df.write.mode("append")
    (writer.option("path", path) if path else writer).saveAsTable(table)


def load_batch(frames: Sequence[DataFrame], path: str) -> None:
    """Replace a table by the union of a batch of frames in one overwrite."""
    union = frames[0]
    for frame in frames[1:]:
        union = union.unionByName(frame)
    union.write.mode("overwrite").parquet(path)


def snapshot_csv(df: DataFrame, folder: str, day: date) -> str:
    """Dated CSV copy of a batch, one part file per partition."""
    path = f"{folder}/{day:%Y_%m_%d}"
    df.write.mode("overwrite").option("header", True).csv(path)
    return path
