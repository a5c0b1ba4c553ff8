"""Ingestion of landed API pages and files into typed master tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom import schemas
from ledgerloom.functions.dates import parse_ts
from ledgerloom.functions.text import ORDER_NULLS, PAYOUT_NULLS, canonical_id, null_tokens, strip_dot_zero
from ledgerloom.operators import maintenance, nested
from ledgerloom.operators.joins import attach_charge_refs
from ledgerloom.sources.files import typed

API_TIME_FORMATS = ("yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mm:ssXX", "yyyy-MM-dd HH:mm:ss")


def ingest_orders(documents: DataFrame, transactions: DataFrame | None = None, loaded_at: Column | None = None) -> DataFrame:
    """Order documents to typed order lines (63 columns), with charge references if given.

    Order: refund total, lines, discounts, flattening, missing columns, types, null spellings,
    checkout id, references.
    """
    lines = nested.explode_lines(nested.with_refund_total(documents))
    flat = nested.flatten_order(nested.first_discount(lines))
    names = {f.name for f in schemas.ORDER_MASTER.fields}
    text = flat.select(
        *[F.col(c).cast("string").alias(c) for c in flat.columns if c in names]
    )
    text = null_tokens(text, ORDER_NULLS, fold_case=True)

    def column(field) -> Column:
        if field.name == "UPDATED_FROM_API":
            return (loaded_at if loaded_at is not None else F.current_timestamp()).cast("timestamp_ntz").alias(field.name)
        if field.name not in text.columns:
            marker = "DEPRECATED" if field.name in schemas.DEPRECATED_ORDER_COLUMNS else None
            return F.lit(marker).cast(field.dataType).alias(field.name)
        if field.name == "checkout_id":
            return canonical_id(F.col("checkout_id")).alias("checkout_id")
        return typed(F.col(field.name), field.dataType, API_TIME_FORMATS).alias(field.name)

    orders = text.select(*[column(f) for f in schemas.ORDER_MASTER.fields])
    return orders if transactions is None else attach_charge_refs(orders, nested.charge_refs(transactions))


def ingest_refund_lines(documents: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """Refunded lines of refunded orders with typed dates and a load stamp."""
    refunded = documents.where(F.col("financial_status").isin("partially_refunded", "refunded"))
    rows = nested.refund_lines(refunded)
    for name in ("order_date", "cancel_date"):
        rows = rows.withColumn(name, parse_ts(F.col(name), API_TIME_FORMATS))
    return rows.withColumn("DATA_CREATED_AT", loaded_at if loaded_at is not None else F.current_timestamp())


def clean_payouts(page: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """Payout rows as typed text and numbers, null spellings removed, ids without ``.0``."""
    text = null_tokens(page.select(*[F.col(c).cast("string").alias(c) for c in page.columns]), PAYOUT_NULLS, False)

    def column(field) -> Column:
        raw = F.col(field.name) if field.name in text.columns else F.lit(None).cast("string")
        if field.dataType.simpleString() == "string":
            return strip_dot_zero(raw, anywhere=True).alias(field.name)
        return typed(raw, field.dataType, API_TIME_FORMATS).alias(field.name)

    rows = text.select(*[column(f) for f in schemas.PAYOUTS.fields])
    return rows.withColumn("UPDATED_FROM_API", loaded_at if loaded_at is not None else F.current_timestamp())


def ingest_payouts(target: DataFrame, page: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """New content of the payout table: open rows dropped, then rows after the cursor appended."""
    kept = maintenance.trim_from_first_pending(target)
    cursor = kept.agg(
        F.coalesce(F.max(F.col("id").try_cast("bigint")), F.lit(maintenance.NO_PAYOUT_CURSOR))
    ).scalar()
    fresh = clean_payouts(page, loaded_at)
    fresh = fresh.where(F.col("id").try_cast("bigint") > cursor)
    return kept.unionByName(fresh, allowMissingColumns=True)
