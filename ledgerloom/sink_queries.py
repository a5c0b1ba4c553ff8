"""Registered queries of the sinks, cursors, windows and the feeds that other queries don't reach.

Each writes a canonical table the way a job would and reads it back.
"""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom import landing, schemas
from ledgerloom.catalog import Catalog
from ledgerloom.functions import dates, rules
from ledgerloom.operators import maintenance
from ledgerloom.plans import amazon
from ledgerloom.queries import booked, query, rpt_amazon_full, rpt_shopify_full
from ledgerloom.sources import feeds, files
from ledgerloom.sources.heads import JAPANESE
from ledgerloom.sources.rakuten_headers import BULK_COLUMN_COUNT, ORDER_HEADERS

LOADED_AT = "2023-01-01 00:00:00"
SPLIT = "1998-01-01"  # older and newer half of a table


def _payouts(c: Catalog) -> DataFrame:
    return c.stripe_payouts.select("balance_transaction_id", "created_utc", "gross")


def _halves(df: DataFrame, ts: str) -> tuple[DataFrame, DataFrame]:
    older = F.coalesce(F.col(ts) < dates.ntz(SPLIT), F.lit(True))
    return df.where(older), df.where(~older)


def _text_csv(c: Catalog, rows: DataFrame, name: str, **options: str) -> str:
    folder = landing.new_folder(c, name)
    rows.write.option("header", True).options(**options).csv(folder)
    return folder


@query
def append_table(c: Catalog) -> DataFrame:
    """Two appends to one table; the second frame has its columns in another order."""
    name = f"appended_{uuid.uuid4().hex}"
    older, newer = _halves(_payouts(c), "created_utc")
    folder = landing.new_folder(c, "appended")
    maintenance.append_table(older, name, folder)
    maintenance.append_table(newer.select("gross", "balance_transaction_id", "created_utc"), name, folder)
    return c.spark.table(name)


@query
def load_batch(c: Catalog) -> DataFrame:
    """A batch of two frames replaces what an earlier batch has left."""
    folder = landing.new_folder(c, "batch")
    older, newer = _halves(_payouts(c), "created_utc")
    maintenance.load_batch([older], folder)
    maintenance.load_batch([older, newer], folder)
    return c.spark.read.parquet(folder)


@query
def snapshot_csv(c: Catalog) -> DataFrame:
    path = maintenance.snapshot_csv(_payouts(c), landing.new_folder(c, "snapshot"), date(2023, 1, 1))
    return c.spark.read.option("header", True).schema("balance_transaction_id string, created_utc timestamp_ntz, gross double").csv(path)


@query
def align_to(c: Catalog) -> DataFrame:
    """Target columns in target order: one is missing, others are surplus."""
    target = T.StructType.fromDDL("gross double, note string, balance_transaction_id string")
    return maintenance.align_to(c.stripe_payouts, target, strict=False)


@query
def stamp(c: Catalog) -> DataFrame:
    return maintenance.stamp(_payouts(c), F.lit("PAY_1.csv"), dates.ntz(LOADED_AT))


@query
def incremental_windows(c: Catalog) -> DataFrame:
    """The rows of each kind of report window."""
    rows = _payouts(c)
    start = dates.ntz("1999-06-30 23:59:59")
    windows = [
        maintenance.incremental_window(rows, "created_utc", start, date(2000, 1, 1), lag).withColumn("lag", F.lit(lag))
        for lag in maintenance.WINDOW_LAG_SECONDS
    ]
    result = windows[0]
    for window in windows[1:]:
        result = result.unionByName(window)
    return result


@query
def time_cursors(c: Catalog) -> DataFrame:
    """Where the next balance, charge, payout and report requests begin."""
    first = dates.ntz("1990-01-01 00:00:00")
    cursors = {
        "balance": maintenance.time_cursor(c.stripe_payouts, "created_utc", first),
        "payout": maintenance.time_cursor(c.stripe_payouts, "automatic_payout_effective_at", first),
        "report": maintenance.time_cursor(c.stripe_api, "created_utc", first, after_seconds=1),
        "nothing yet": maintenance.time_cursor(c.stripe_payouts.where("false"), "created_utc", first),
    }
    result = None
    for name, cursor in cursors.items():
        row = cursor.select(F.lit(name).alias("request"), "cursor")
        result = row if result is None else result.unionByName(row)
    return result


@query
def delivery_lines_of_a_month(c: Catalog) -> DataFrame:
    """The delivery lines of one month are re-dated, for one settlement out of all."""
    report = booked(c, rpt_amazon_full)
    newest = report.agg(F.max("settlement_id")).scalar()
    hit = amazon.delivery_lines(rules.SALES_ACCOUNT, "Delivery", "Shipping", month=date(1998, 3, 1)) | (
        amazon.delivery_lines(rules.SALES_ACCOUNT, "Delivery", "Shipping") & (F.col("settlement_id") == newest)
    )
    moved = amazon.move_back_one_month(report, hit)
    return moved.select("settlement_id", "order_id", "sku", "item", "main_date", "order_full_date", "tax_calc_distinction", "total_real")


# ---------------------------------------------------------------- feeds


@query
def feed_stripe_balance(c: Catalog) -> DataFrame:
    table = c.stripe_payouts
    rows = table.select(
        *[
            (F.date_format(f.name, "yyyy-MM-dd HH:mm:ss") if f.name == "created_utc" else F.col(f.name) if f.name in table.columns
             else F.lit(None)).cast("string").alias(f.name)
            for f in schemas.STRIPE_BALANCE.fields
        ]
    )
    return feeds.read_stripe_balance(c.spark, _text_csv(c, rows, "balance")).select(
        "balance_transaction_id", "created_utc", "gross", "fee", "net", "reporting_category"
    )


def _broken_payouts(c: Catalog) -> str:
    """Payout files in which some amounts can't be read."""
    table = c.stripe_payouts
    bad = F.endswith("balance_transaction_id", F.lit("7"))
    rows = table.select(
        *[
            (F.when(bad, F.lit("1O.5")).otherwise(F.col("gross").cast("string")) if f.name == "gross"
             else F.date_format(f.name, "yyyy-MM-dd HH:mm:ss") if f.name in table.columns and "timestamp" in f.dataType.simpleString()
             else F.col(f.name) if f.name in table.columns else F.lit(None)).cast("string").alias(f.name)
            for f in schemas.STRIPE_PAYOUTS.fields
        ]
    )
    return _text_csv(c, rows, "broken")


@query
def feed_quarantine(c: Catalog) -> DataFrame:
    """Records per outcome: readable ones become rows, the others are kept as they came."""
    good, bad = feeds.read_stripe_payouts_apart(c.spark, _broken_payouts(c))
    kept = bad.select("balance_transaction_id", F.lit("bad").alias("outcome"))
    return good.select("balance_transaction_id", F.lit("good").alias("outcome")).unionByName(kept)


@query
def feed_rakuten_bulk(c: Catalog) -> DataFrame:
    """Both tables of older exports, named by position, over one folder."""
    names = list(ORDER_HEADERS.values())[:BULK_COLUMN_COUNT]
    rows = c.rakuten_orders.unionByName(c.rakuten_2020, allowMissingColumns=True)
    text = rows.withColumn("order_date_time", F.date_format("order_date_time", "yyyy-MM-dd HH:mm:ss"))
    text = text.select(*[(F.col(n) if n in rows.columns else F.lit(None)).cast("string").alias(f"c{i}") for i, n in enumerate(names)])
    files.allow_encoding(c.spark, JAPANESE)
    folder = _text_csv(c, text, "bulk", encoding=JAPANESE)
    return feeds.read_rakuten_bulk(c.spark, folder).select("order_number", "order_date_time", "item_number", "unit_price", "quantity")


@query
def feed_nomenclature(c: Catalog) -> DataFrame:
    table = c.nomenclature
    rows = table.select(*[(F.col(f.name) if f.name in table.columns else F.lit(None)).cast("string").alias(f.name) for f in schemas.NOMENCLATURE.fields])
    return feeds.load_nomenclature(c.spark, _text_csv(c, rows, "rules")).select("concatenated_fields", "remarks", "account", "item", "tax_distiction")


@query
def feed_report_sheet(c: Catalog) -> DataFrame:
    """A report exported for review and read back as a typed sheet."""
    report = booked(c, rpt_shopify_full)
    values = {"balance": "balance", "settlement_id": "control_number", "account": "account", "item": "item", "total_sum": "amount", "TOTAL": "real_amount"}
    rows = report.select(
        *[(F.col(values[f.name]) if f.name in values else F.lit(None)).cast("string").alias(f.name) for f in schemas.REPORT_SHEETS["sh"].fields]
    )
    return feeds.read_report_sheet(c.spark, _text_csv(c, rows, "sheet"), "sh").select(*values)


@query
def feed_mixed_headers(c: Catalog) -> DataFrame:
    """Order lists whose files differ in the order and number of their columns."""
    base = landing.new_folder(c, "mixed")
    files.allow_encoding(c.spark, JAPANESE)
    older, newer = _halves(c.order_central, "purchase_date")
    for name, half, columns in (("a", older, ["amazon_order_id", "sku", "quantity"]), ("b", newer, ["quantity", "ship_postal_code", "amazon_order_id", "sku"])):
        rows = half.select(*[F.col(x).cast("string").alias(x.replace("_", "-")) for x in columns])
        rows.write.option("header", True).option("sep", "\t").option("encoding", JAPANESE).csv(f"{base}/{name}")
    found = feeds.read_marketplace_tsv(c.spark, f"{base}/*", kind="oc")
    return found.select("amazon_order_id", "sku", "quantity", "ship_postal_code")


@query
def feed_quoted_breaks(c: Catalog) -> DataFrame:
    """Quoted cells that hold line breaks and quotes."""
    rows = c.order_central.select(
        F.col("amazon_order_id").alias("amazon-order-id"), F.concat(F.lit('two\nlines "'), "sku", F.lit('"')).alias("product-name"), F.col("sku"),
        F.col("quantity").cast("string").alias("quantity"),
    )
    folder = _text_csv(c, rows, "breaks", sep="\t", escape='"', quoteAll="true")
    found = feeds.read_marketplace_tsv(c.spark, folder, kind="oc", encoding="UTF-8", multi_line=True)
    return found.select("amazon_order_id", "product_name", "sku", "quantity")


@query
def feed_regional_orders(c: Catalog) -> DataFrame:
    """Regional order list in UTF-8 without the Japanese charset."""
    rows = c.order_central.select(
        F.col("amazon_order_id").alias("amazon-order-id"), F.lit("①番").alias("product-name"), "sku", F.col("quantity").cast("string").alias("quantity")
    )
    folder = _text_csv(c, rows, "regional", sep="\t")
    return feeds.read_preamble_tsv(c.spark, folder, kind="oc").select("amazon_order_id", "product_name", "sku", "quantity")


@query
def feed_routes(c: Catalog) -> DataFrame:
    """Files of two kinds in one folder, each to its own reader by file name prefix."""
    base = landing.new_folder(c, "routes")
    rows = c.stripe_payouts
    balance = rows.select(*[(F.date_format(f.name, "yyyy-MM-dd HH:mm:ss") if f.name == "created_utc" else F.col(f.name) if f.name in rows.columns
                             else F.lit(None)).cast("string").alias(f.name) for f in schemas.STRIPE_BALANCE.fields])
    balance.write.option("header", True).csv(f"{base}/BAL_1")
    payouts = rows.select(*[(F.date_format(f.name, "yyyy-MM-dd HH:mm:ss") if f.name in rows.columns and "timestamp" in f.dataType.simpleString()
                             else F.col(f.name) if f.name in rows.columns else F.lit(None)).cast("string").alias(f.name) for f in schemas.STRIPE_PAYOUTS.fields])
    payouts.write.option("header", True).csv(f"{base}/PAY_1")
    routed = files.route_by_prefix(c.spark, base, {"BAL": feeds.read_stripe_balance, "PAY": feeds.read_stripe_payouts})
    return routed["BAL"].select(F.lit("BAL").alias("kind"), "balance_transaction_id", "net").unionByName(
        routed["PAY"].select(F.lit("PAY").alias("kind"), "balance_transaction_id", "net")
    )
