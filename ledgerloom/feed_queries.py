"""Registered queries of the file readers, the ingestion plans and the streaming jobs.

Each writes a canonical table out the way the outside system delivers it and reads it back.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom import landing, schemas
from ledgerloom.catalog import Catalog
from ledgerloom.documents import order_documents, transaction_pages
from ledgerloom.functions import dates
from ledgerloom.plans import ingest
from ledgerloom.queries import query, rpt_rakuten_full
from ledgerloom.sources import feeds
from ledgerloom.sources.files import read_json_pages
from ledgerloom.streaming import jobs
from ledgerloom.streaming.keyed_table import KeyedTable
from ledgerloom.streaming.range_table import RangeTable

LOADED_AT = "2023-01-01 00:00:00"


@query
def feed_settlement_txt(c: Catalog) -> DataFrame:
    return feeds.read_settlement_txt(c.spark, landing.settlement_txt(c)).drop("FILE_NAME")


@query
def feed_preamble_tsv(c: Catalog) -> DataFrame:
    rows = feeds.read_preamble_tsv(c.spark, landing.preamble_tsv(c))
    return rows.select(
        "settlement_id", "deposit_date", "transaction_type", "order_id", "amount_type", "amount_description", "amount",
        "posted_date_time", "sku", "quantity_purchased", "promotion_id",
    )


@query
def feed_payment_main(c: Catalog) -> DataFrame:
    return feeds.read_payment_sections(c.spark, landing.payment_sections(c))[0].drop("FILE_NAME")


@query
def feed_payment_coupon(c: Catalog) -> DataFrame:
    return feeds.read_payment_sections(c.spark, landing.payment_sections(c))[1].drop("FILE_NAME")


@query
def feed_rakuten_orders(c: Catalog) -> DataFrame:
    rows = feeds.read_rakuten_orders(c.spark, landing.rakuten_csv(c))
    return rows.select(
        "order_number", "order_date_time", "status", "product_name", "item_number", "unit_price", "quantity",
        "shipping_total", "delivery_location",
    )


@query
def feed_order_list(c: Catalog) -> DataFrame:
    rows = feeds.read_marketplace_tsv(c.spark, landing.order_list_tsv(c))
    return rows.select("amazon_order_id", "merchant_order_id", "purchase_date", "product_name", "sku", "quantity", "promotion_ids")


@query
def feed_stripe_payouts(c: Catalog) -> DataFrame:
    rows = feeds.read_stripe_payouts(c.spark, landing.payout_csv(c))
    return rows.select(*c.stripe_payouts.columns)


def _documents(c: Catalog) -> DataFrame:
    # the landed pages are read with the full document schema; absent fields are NULL
    docs = order_documents(c.orders, c.lineitem).withColumn("checkout_id", F.col("id"))
    return read_json_pages(c.spark, landing.order_pages(c, docs), "orders", schemas.ORDER_DOCUMENT, page_per_file=False)


@query
def ingest_orders(c: Catalog) -> DataFrame:
    rows = ingest.ingest_orders(_documents(c), transaction_pages(c.orders), dates.ntz(LOADED_AT))
    return rows.select(
        "id", "checkout_id", "created_at", "cancelled_at", "financial_status", "refund", "payment_gateway_names",
        "reference", "cart_token", "shipping_shop_amount", "shipping_presentment_amount", "ship_zip", "lineitem_quantity",
        "lineitem_name", "lineitem_price", "lineitem_sku", "lineitem_discount", "discount_code", "discount_amount",
        "total_price", "UPDATED_FROM_API",
    )


@query
def ingest_refund_lines(c: Catalog) -> DataFrame:
    return ingest.ingest_refund_lines(_documents(c), dates.ntz(LOADED_AT)).select(
        "id", "line_item_id", "quantity", "subtotal", "name", "order_date", "cancel_date", "shipping_amount", "product_name"
    )


@query
def ingest_payouts(c: Catalog) -> DataFrame:
    """The stored payouts lose their open tail and get the rows after it again from the page."""
    page = c.shopify_payouts.withColumn("payout_id", F.concat("payout_id", F.lit(".0"))).withColumn(
        "source_order_id", F.coalesce("source_order_id", F.lit("nan"))
    ).withColumn("processed_at", F.concat(F.date_format("processed_at", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00")))
    rows = ingest.ingest_payouts(c.shopify_payouts, page, dates.ntz(LOADED_AT))
    return rows.select("id", "type", "source_order_id", "payout_id", "payout_status", "amount", "fee", "net", "processed_at", "UPDATED_FROM_API")


# ---------------------------------------------------------------- streaming


def _stage(c: Catalog, name: str, rows: DataFrame) -> tuple[str, str, str]:
    """(source, target, checkpoint) folders with ``rows`` written to the source."""
    base = landing.new_folder(c, name)
    rows.write.parquet(f"{base}/in")
    return f"{base}/in", f"{base}/out", f"{base}/state"


@query
def stream_load_files(c: Catalog) -> DataFrame:
    """Every file once; a second run finds nothing new."""
    rows = c.stripe_payouts.select("balance_transaction_id", "created_utc", "gross")
    source, target, state = _stage(c, "load", rows)
    for _ in range(2):
        jobs.load_new_files(jobs.file_stream(c.spark, source, rows.schema), target, state)
    return c.spark.read.parquet(target).drop("FILE_NAME")


@query
def stream_replace_by_key(c: Catalog) -> DataFrame:
    """The stored lines first, then a file with the newer half of the orders under a new status."""
    rows = c.orders_master.select("id", "lineitem_sku", "financial_status", "created_at")
    source, target, state = _stage(c, "replace", rows)
    jobs.replace_keys(jobs.file_stream(c.spark, source, rows.schema).drop("FILE_NAME"), "id", target, state)
    newer = rows.where(F.col("created_at") >= dates.ntz("2001-02-01")).withColumn("financial_status", F.lit("archived"))
    newer.write.mode("append").parquet(source)
    jobs.replace_keys(jobs.file_stream(c.spark, source, rows.schema).drop("FILE_NAME"), "id", target, state)
    return KeyedTable(c.spark, target, "id").read()


@query
def trim_recent_stored(c: Catalog) -> DataFrame:
    """Orders stored in ranges of their number; the tail that will be loaded again goes."""
    table = RangeTable(c.spark, landing.new_folder(c, "orders"), "order_number", width=10_000)
    table.replace(c.orders_master.select("id", "order_number", "created_at", "lineitem_sku"), 0)
    table.trim_recent(1, 1500, date(2001, 8, 1))
    return table.read()


@query
def trim_from_first_pending_stored(c: Catalog) -> DataFrame:
    """Payouts stored in ranges of their id, down to the first open one, and loaded again up to their end."""
    rows = c.shopify_payouts.select("id", "payout_status", "amount")
    table = RangeTable(c.spark, landing.new_folder(c, "payouts"), "id", width=1_000_000)
    for number in (0, 2):
        table.replace(rows, number)
        table.trim_from_first_pending(number + 1)
    return table.read()


@query
def stream_distinct_records(c: Catalog) -> DataFrame:
    """A job stops and starts again; the second run gets the last two weeks once more, each record twice, and what is new."""
    rows = c.stripe_payouts.select("balance_transaction_id", "created_utc", "gross")
    stop = dates.ntz("1997-01-01")
    source, target, state = _stage(c, "distinct", rows.where(F.col("created_utc") < stop))

    def run() -> None:
        stream = jobs.file_stream(c.spark, source, rows.schema).drop("FILE_NAME")
        jobs.load_new_files(jobs.distinct_records(stream, "created_utc", ["balance_transaction_id"]), target, state)

    run()
    tail = rows.where((F.col("created_utc") >= stop - F.expr("interval '13' day")) & (F.col("created_utc") < stop))
    tail.unionAll(tail).unionAll(rows.where(F.col("created_utc") >= stop)).write.mode("append").parquet(source)
    run()
    return c.spark.read.schema(rows.schema).parquet(target)


@query
def stream_book_once(c: Catalog) -> DataFrame:
    """The same report lines arrive twice and are booked once."""
    rows = rpt_rakuten_full(c).select("control_number", "order_id", "item", "amount")
    source, target, state = _stage(c, "book", rows)
    jobs.book_once(jobs.file_stream(c.spark, source, rows.schema).drop("FILE_NAME"), "control_number", target, state)
    rows.write.mode("append").parquet(source)
    jobs.book_once(jobs.file_stream(c.spark, source, rows.schema).drop("FILE_NAME"), "control_number", target, state)
    return c.spark.read.parquet(target).drop("batch")


@query
def stream_daily_totals(c: Catalog) -> DataFrame:
    """Sales per day and gateway, the days that late records may still change included."""
    rows = c.orders_master.select("payment_gateway_names", "created_at", (F.col("lineitem_price") * F.col("lineitem_quantity")).alias("amount"))
    source, target, state = _stage(c, "daily", rows)
    stream = jobs.file_stream(c.spark, source, rows.schema)
    jobs.write_daily_totals(jobs.daily_totals(stream, "created_at", ["payment_gateway_names"], "amount"), target, state)
    return jobs.read_daily_totals(c.spark, target, ["payment_gateway_names"])
