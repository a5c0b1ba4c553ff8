"""Canonical settlement tables derived from the given star-schema tables.

The settlement feeds do not exist in the test data, so each canonical table is a SELECT over
the given tables.  One text serves Spark and the check engine: ``{name}`` is a table,
``{ntz}`` the engine's zone-less timestamp type.  Remainders only spread rows over channels,
states and edge cases; no row is left out of the channels to save work.
"""

from __future__ import annotations

import hashlib
import re
import weakref
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.operators.ledgers import book, open_ledger
from ledgerloom.operators.months import append_by_month, read_by_month
from ledgerloom.storage import checkpoint_dir, new_folder

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
               "embeddings", "pages", "benchmark", "labels", "conversations")

TABLES: dict[str, str] = {}

# Orders that have at least one line, with their order-level values.
TABLES["order_headers"] = """
SELECT o_orderkey AS k, o_custkey, cast(o_orderkey as string) AS id, '#' || cast(o_orderkey as string) AS name,
 'c' || cast(o_custkey as string) || '@example.com' AS email,
 o_orderdate + interval 1 second * ((o_orderkey * 37) % 86400) AS created_at,
 o_orderdate + interval 1 second * ((o_orderkey * 37) % 86400 + 60) AS processed_at,
 CASE cast(floor(o_orderkey / 4) as bigint) % 10 WHEN 0 THEN 'refunded' WHEN 1 THEN 'partially_refunded' WHEN 2 THEN NULL ELSE 'paid' END AS financial_status,
 CASE o_orderkey % 4 WHEN 0 THEN 'shopify_payments' WHEN 1 THEN 'stripe' WHEN 2 THEN 'amazon_payments' ELSE 'Komoju - card' END AS payment_gateway_names,
 o_totalprice, round(o_totalprice) AS total_price
FROM {orders} WHERE o_orderkey IN (SELECT l_orderkey FROM {lineitem})
"""

TABLES["orders_master"] = """
SELECT id, name, id AS order_number, email, created_at, processed_at, financial_status, payment_gateway_names,
 'direct' AS processing_method,
 CASE WHEN l_partkey % 20 = 0 THEN 'GoCLN シェイカー ' || p_name WHEN l_partkey % 97 = 0 THEN NULL ELSE p_name END AS lineitem_name,
 CASE WHEN l_partkey % 17 = 0 THEN NULL ELSE 'SKU' || lpad(cast(l_partkey as string), 6, '0') END AS lineitem_sku,
 l_quantity AS lineitem_quantity, round(l_extendedprice / l_quantity) AS lineitem_price,
 cast((k % 3) * 300 as double) AS shipping_shop_amount, cast((k % 3) * 300 as double) AS shipping_presentment_amount,
 CASE k % 5 WHEN 0 THEN round(o_totalprice * 0.05) WHEN 1 THEN NULL ELSE cast(0 as double) END AS total_discounts,
 CASE k % 5 WHEN 0 THEN round(o_totalprice * 0.05) ELSE cast(0 as double) END AS current_total_discounts,
 CASE k % 5 WHEN 0 THEN round(o_totalprice * 0.05) WHEN 1 THEN NULL ELSE cast(0 as double) END AS discount_amount,
 total_price, total_price - (k % 3) * 300 AS subtotal_price,
 CASE WHEN k % 7 = 0 THEN round(o_totalprice * 0.08) ELSE cast(0 as double) END AS total_tax,
 CASE WHEN k % 50 = 2 THEN NULL ELSE cast(1000000000000 + k as string) END AS checkout_id,
 lpad(cast(o_custkey % 1000 as string), 3, '0') || '-' || lpad(cast(o_custkey % 10000 as string), 4, '0') AS ship_zip
FROM {order_headers} JOIN {lineitem} ON l_orderkey = k JOIN {part} ON p_partkey = l_partkey
"""

TABLES["shopify_payouts"] = """
WITH o AS (SELECT id, k, processed_at, financial_status, total_price FROM {order_headers} WHERE payment_gateway_names = 'shopify_payments'),
p AS (
 SELECT k * 10 AS id, 'charge' AS type, 'charge' AS source_type, o.id AS source_order_id, total_price AS amount, round(total_price * 0.034) AS fee, k, processed_at FROM o
 UNION ALL SELECT k * 10 + 1, 'refund', 'Payments::Refund', o.id, -round(total_price * CASE WHEN financial_status = 'refunded' THEN 1 ELSE 0.3 END), cast(0 as double), k, processed_at FROM o WHERE financial_status IN ('refunded', 'partially_refunded')
 UNION ALL SELECT k * 10 + 2, 'dispute', 'Payments::Dispute', o.id, -total_price, cast(1300 as double), k, processed_at FROM o WHERE cast(floor(k / 4) as bigint) % 101 = 3
 UNION ALL SELECT k * 10 + 3, 'adjustment', 'adjustment', o.id, cast(-50 as double), cast(0 as double), k, processed_at FROM o WHERE cast(floor(k / 4) as bigint) % 89 = 5),
q AS (SELECT cast(id as string) AS id, type, source_type, source_order_id, amount, fee, amount - fee AS net,
 CASE WHEN cast(floor(k / 4) as bigint) % 40 = 7 THEN NULL ELSE cast(700000000 + cast(floor(k / 200) as bigint) as string) END AS payout_id,
 CASE WHEN k % 1000 = 996 THEN 'pending' WHEN k % 1000 = 992 THEN 'in_transit' ELSE 'paid' END AS payout_status, processed_at + interval 24 hours AS processed_at FROM p)
SELECT * FROM q UNION ALL
SELECT '9' || payout_id, 'payout', 'payout', cast(NULL as string), -sum(net), cast(0 as double), -sum(net), payout_id, 'paid', max(processed_at) + interval 24 hours FROM q WHERE payout_id IS NOT NULL GROUP BY payout_id
"""

TABLES["stripe_payouts"] = """
WITH o AS (SELECT id, email, processed_at, financial_status, total_price, k FROM {order_headers} WHERE payment_gateway_names = 'stripe'),
r AS (SELECT 'charge' AS reporting_category, total_price AS gross, round(total_price * 0.036) AS fee, 0 AS h, o.* FROM o
 UNION ALL SELECT 'refund', -total_price, cast(0 as double), 72, o.* FROM o WHERE financial_status = 'refunded'
 UNION ALL SELECT 'fee', cast(0 as double), round(total_price * 0.01), 1, o.* FROM o WHERE k % 8 = 1)
SELECT 'po_1' || lpad(cast(cast(floor(k / 100) as bigint) as string), 8, '0') AS automatic_payout_id, processed_at + interval 120 hours AS automatic_payout_effective_at,
 'txn_' || reporting_category || id AS balance_transaction_id, processed_at + interval 1 second * (k % 11) + interval 1 hour * h AS created_utc,
 'jpy' AS currency, gross, fee, gross - fee AS net, reporting_category, 'src_' || id AS source_id, email AS customer_email,
 'ch_' || id AS charge_id, CASE WHEN k % 6 = 1 THEN NULL ELSE '#' || id END AS order_id FROM r
"""

TABLES["stripe_api"] = """
SELECT balance_transaction_id, created_utc, currency, gross, fee, net, reporting_category, source_id, CASE WHEN cast(substr(charge_id, 4) as bigint) % 97 = 1 THEN 'x' || customer_email ELSE customer_email END AS customer_email, charge_id FROM {stripe_payouts}
"""

TABLES["amazon_pay"] = """
WITH o AS (SELECT id, financial_status, total_price, created_at, k FROM {order_headers} WHERE payment_gateway_names = 'amazon_payments'),
r AS (SELECT 'Capture' AS transactiontype, total_price AS transactionamount, 1 AS d, o.* FROM o
 UNION ALL SELECT 'Refund', -total_price, 6, o.* FROM o WHERE financial_status = 'refunded'
 UNION ALL SELECT 'Reserve', cast(0 as double), 0, o.* FROM o WHERE k % 30 = 2)
SELECT cast(900000 + cast(floor(k / 150) as bigint) as string) AS settlementid, 'S01-' || id || '-' || transactiontype AS amazontransactionid, transactiontype,
 'S/' || cast(1000000000000 + k as string) || '#1' AS sellerorderid, created_at + interval 24 hours * d AS transactionposteddate,
 transactionamount, -round(transactionamount * 0.039) AS transactionpercentagefee, transactionamount - round(transactionamount * 0.039) AS nettransactionamount FROM r
"""

TABLES["transaction_view"] = """
WITH l AS (SELECT l_orderkey AS k, l_partkey, l_returnflag, l_quantity, round(l_extendedprice) AS price, l_linenumber, l_shipdate FROM {lineitem}),
r AS (SELECT CASE WHEN l_returnflag = 'R' THEN 'Refund' ELSE 'Order' END AS transaction_type, 'ItemPrice' AS amount_type, 'Principal' AS amount_description, CASE WHEN l_returnflag = 'R' THEN -price ELSE price END AS amount, l_quantity AS quantity_purchased, l.* FROM l
 UNION ALL SELECT CASE WHEN l_returnflag = 'R' THEN 'Refund' ELSE 'Order' END, 'ItemFees', 'Commission', -round(price * 0.15), cast(NULL as double), l.* FROM l
 UNION ALL SELECT 'Order', 'Promotion', 'Shipping', -round(price * 0.02), cast(NULL as double), l.* FROM l WHERE l_linenumber = 2
 UNION ALL SELECT 'other-transaction', 'FBA Inventory Reimbursement', 'WAREHOUSE_DAMAGE', round(price * 0.5), l_quantity, l.* FROM l WHERE l_linenumber = 7
 UNION ALL SELECT 'CouponRedemptionFee', 'Coupon', NULL, cast(-60 as double), cast(NULL as double), l.* FROM l WHERE l_linenumber = 5)
SELECT cast(11000000000 + cast(floor(k / 300) as bigint) as double) AS settlement_id, transaction_type, amount_type, amount_description, amount, quantity_purchased,
 CASE WHEN k % 11 = 4 THEN 'A-X' || cast(k as string) ELSE 'A-' || cast(k as string) END AS order_id,
 'SKU' || lpad(cast(l_partkey as string), 6, '0') AS sku,
 CASE WHEN k % 401 = 9 THEN NULL ELSE l_shipdate + interval 1 second * ((k * 53) % 86400) END AS posted_date_time,
 CASE WHEN l_linenumber = 1 THEN cast('2002-01-01 00:00:00' as {ntz}) + interval 24 hours * (cast(floor(k / 300) as bigint) % 365) END AS deposit_date FROM r
"""

TABLES["order_central"] = """
SELECT 'A-' || cast(o_orderkey as string) AS amazon_order_id, CASE WHEN o_orderkey % 13 = 1 THEN 'M-' || cast(o_orderkey as string) END AS merchant_order_id,
 o_orderdate + interval 1 second * ((o_orderkey * 37) % 86400) AS purchase_date, lpad(cast(o_custkey % 1000 as string), 3, '0') || '-' || lpad(cast(o_custkey % 10000 as string), 4, '0') AS ship_postal_code,
 'SKU' || lpad(cast(l_partkey as string), 6, '0') AS sku, l_quantity AS quantity FROM {orders} JOIN {lineitem} ON l_orderkey = o_orderkey
"""

TABLES["rakuten_all"] = """
SELECT '2' || lpad(cast(o_orderkey as string), 9, '0') AS order_number, o_orderdate + interval 1 second * ((o_orderkey * 37) % 86400) AS order_date_time,
 CASE o_orderkey % 6 WHEN 0 THEN '900' WHEN 1 THEN '600' WHEN 2 THEN '500' WHEN 3 THEN '100' ELSE '700' END AS status,
 CASE WHEN l_partkey % 20 = 0 THEN 'GoCLN（ゴークリーン） シェイカー ' || p_name ELSE p_name END AS product_name,
 CASE WHEN l_partkey % 3 = 0 THEN 'v_' || '49' || lpad(cast(l_partkey as string), 11, '0') || 'x' ELSE '49' || lpad(cast(l_partkey as string), 11, '0') || '-b' END AS item_number,
 round(l_extendedprice / l_quantity) AS unit_price, l_quantity AS quantity, cast((o_orderkey % 3) * 300 as double) AS shipping_total,
 cast(CASE WHEN o_orderkey % 5 = 0 THEN 200 ELSE 0 END as double) AS store_issued_coupon_usage_amount,
 lpad(cast(o_custkey % 1000 as string), 3, '0') AS destination_postal_code_1, cast(o_custkey % 10000 as string) AS mailing_address_postal_code_2
FROM {orders} JOIN {lineitem} ON l_orderkey = o_orderkey JOIN {part} ON p_partkey = l_partkey
"""

TABLES["rakuten_2020"] = """
SELECT * FROM {rakuten_all} WHERE order_date_time < cast('1997-01-01 00:00:00' as {ntz})
"""

TABLES["rakuten_orders"] = """
SELECT * FROM {rakuten_all} WHERE order_date_time >= cast('1997-01-01 00:00:00' as {ntz})
"""

TABLES["rakuten_payment_main"] = """
SELECT order_number, CASE WHEN cast(order_number as bigint) % 9 = 0 THEN NULL ELSE 'R' || cast(cast(floor(cast(order_number as bigint) / 250) as bigint) as string) END AS report_id
FROM (SELECT '2' || lpad(id, 9, '0') AS order_number FROM {order_headers} WHERE k % 6 <> 3) AS paid
"""

TABLES["combined_sku"] = """
SELECT 'SKU' || lpad(cast(p_partkey as string), 6, '0') AS sku_item, 'Amazon' AS store_name, p_name AS item_name FROM {part} WHERE p_partkey % 4 <> 0
 UNION ALL SELECT 'SKU' || lpad(cast(p_partkey as string), 6, '0'), 'Shopify', p_name FROM {part} WHERE p_partkey % 5 <> 0
 UNION ALL SELECT '49' || lpad(cast(p_partkey as string), 11, '0'), 'Rakuten', p_name FROM {part}
"""

TABLES["nomenclature"] = """
SELECT * FROM (VALUES
 ('OrderItemPricePrincipal', 'Product Charges', '売上高', 'Sales', '課税売上8%（軽）'),
 ('RefundItemPricePrincipal', 'Product Charges Refund', '売上高', 'Sales', '課税売上8%（軽）'),
 ('OrderItemFeesCommission', 'Fee', '支払手数料', 'Fee', '対象外'),
 ('RefundItemFeesCommission', 'Fee', '支払手数料', 'Fee', '対象外'),
 ('OrderPromotionShipping', 'Shipping', '売上高', 'Delivery', '課税売上10%'),
 ('CouponRedemptionFeeCoupon', 'Fee', '支払手数料', 'Fee', '対象外')
) AS rules(concatenated_fields, remarks, account, item, tax_distiction)
"""

TABLES["full_imported"] = """
SELECT cast(day as date) AS transaction_date, supplier, settlement_id, account, item, cast(amount as double) AS amount, cast(tax_amount as double) AS tax_amount FROM (VALUES
 ('1994-01-31', 'Shopify', 'i1', '売上高', 'Sales', 12000, 888),
 ('1994-02-28', 'Shopify Komoju', 'i2', '売上高', 'Sales', 5400, 400),
 ('1994-02-28', 'Shopify Stripe', 'i3', '支払手数料', 'Fee Shopify', -194, 0),
 ('1994-03-31', 'Shopify Amazon', 'i4', '売上高', 'Delivery', 600, 54),
 ('1994-03-31', 'Rakuten', 'i5', '売上高', 'Sales', 8800, 651),
 ('1994-04-30', 'Rakuten', 'i6', '売上高', 'Delivery', 300, 27),
 ('1994-04-30', 'Amazon Seller', 'i7', '売上高', 'Sales', 99000, 7333),
 ('1994-05-31', 'Amazon Seller', 'i8', '支払手数料', 'Fee', -14850, 0),
 ('1994-05-31', 'Somebody Else', 'i9', '売上高', 'Sales', 1, 0),
 ('1994-06-30', 'Shopify', 'i10', '売上高', 'Sales', 0, 0)
) AS booked(day, supplier, settlement_id, account, item, amount, tax_amount)
"""

# Ledgers of the incremental reports: what an earlier run has booked, plus one row without a key.
TABLES["ledger_shopify"] = """
SELECT DISTINCT cast(payout_id as bigint) AS control_number FROM {shopify_payouts} WHERE cast(payout_id as bigint) % 3 = 0
 UNION ALL SELECT cast(NULL as bigint)
"""
TABLES["ledger_stripe"] = """
SELECT DISTINCT automatic_payout_id AS SETT_NUMBER FROM {stripe_payouts} WHERE cast(substr(automatic_payout_id, 5) as bigint) % 3 = 0
 UNION ALL SELECT cast(NULL as string)
"""
TABLES["ledger_amazonpay"] = """
SELECT DISTINCT settlementid AS control_number FROM {amazon_pay} WHERE cast(settlementid as bigint) % 3 = 0
 UNION ALL SELECT cast(NULL as string)
"""
TABLES["ledger_amazon"] = """
SELECT DISTINCT cast(cast(settlement_id as bigint) as string) AS settlement_id FROM {transaction_view} WHERE cast(settlement_id as bigint) % 3 = 0
 UNION ALL SELECT cast(NULL as string)
"""
TABLES["ledger_rakuten"] = """
SELECT DISTINCT report_id AS control_number FROM {rakuten_payment_main} WHERE cast(substr(report_id, 2) as bigint) % 3 = 0
 UNION ALL SELECT cast(NULL as string)
"""

# Text columns as they land in the feeds: null spellings, separators, two date formats.
TABLES["raw_text"] = """
SELECT cast(l_orderkey as string) || '-' || cast(l_linenumber as string) AS line_id,
 CASE l_partkey % 7 WHEN 0 THEN 'NaN' WHEN 1 THEN 'null' WHEN 2 THEN '' WHEN 3 THEN ' ' WHEN 4 THEN '<NA>' WHEN 5 THEN 'None' ELSE l_returnflag END AS flag_text,
 CASE WHEN l_partkey % 31 = 0 THEN 'n/a' WHEN l_extendedprice >= 1000 THEN cast(cast(floor(l_extendedprice / 1000) as bigint) as string) || ',' || lpad(cast(cast(floor(l_extendedprice) as bigint) % 1000 as string), 3, '0') ELSE cast(cast(floor(l_extendedprice) as bigint) as string) END AS price_text,
 CASE WHEN l_partkey % 5 = 0 THEN cast(l_orderkey as string) || '.0' WHEN l_partkey % 41 = 0 THEN 'x' || cast(l_orderkey as string) ELSE cast(l_orderkey as string) END AS id_text,
 CASE l_suppkey % 3 WHEN 0 THEN {dmy} || ' 10:20:30 UTC' WHEN 1 THEN {ymd} || 'T10:20:30+09:00' ELSE {dmy} END AS date_text,
 l_shipdate
FROM {lineitem}
"""

_DATE_TEXT = {
    "spark": {"dmy": "date_format(l_shipdate, 'dd.MM.yyyy')", "ymd": "date_format(l_shipdate, 'yyyy-MM-dd')"},
    "duckdb": {"dmy": "strftime(l_shipdate, '%d.%m.%Y')", "ymd": "strftime(l_shipdate, '%Y-%m-%d')"},
}
_NTZ = {"spark": "timestamp_ntz", "duckdb": "timestamp"}

# Order in which Spark joins the lines, where the text's own order would shuffle the order's columns with each line
# twice: the part comes first, so that only the line's own columns are shuffled by part.
_SPARK_JOINS = {
    "orders_master": (
        "FROM {order_headers} JOIN {lineitem} ON l_orderkey = k JOIN {part} ON p_partkey = l_partkey",
        "FROM {lineitem} JOIN {part} ON p_partkey = l_partkey JOIN {order_headers} ON k = l_orderkey",
    ),
    "rakuten_all": (
        "FROM {orders} JOIN {lineitem} ON l_orderkey = o_orderkey JOIN {part} ON p_partkey = l_partkey",
        "FROM {lineitem} JOIN {part} ON p_partkey = l_partkey JOIN {orders} ON o_orderkey = l_orderkey",
    ),
}


def text_for(name: str, engine: str) -> str:
    """SQL of a canonical table with the engine's own words filled in."""
    text = TABLES[name].replace("{ntz}", _NTZ[engine])
    if engine == "spark" and name in _SPARK_JOINS:
        text = text.replace(*_SPARK_JOINS[name])
    for key, value in _DATE_TEXT[engine].items():
        text = text.replace("{" + key + "}", value)
    return text.strip()


def dependencies(text: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", text)))


# Written out once per session, as the warehouse tables that the reports read: the payments, which have one or
# two rows an order and are read several times, and the ledgers.  The tables with a row or more a line are views:
# a query then moves the columns that it needs, and no whole copy of the lines is shuffled, written and read first.
LANDED = (
    "shopify_payouts", "stripe_payouts", "amazon_pay",
    "ledger_shopify", "ledger_stripe", "ledger_amazonpay", "ledger_amazon", "ledger_rakuten",
)

# Settlement that each ledger is bucketed by.
LEDGER_KEYS = {
    "ledger_shopify": "control_number", "ledger_stripe": "SETT_NUMBER", "ledger_amazonpay": "control_number",
    "ledger_amazon": "settlement_id", "ledger_rakuten": "control_number",
}
LANDED_BUCKETS = 8  # the test tables are small

_CATALOGS: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def catalog(spark: SparkSession, folder: str) -> Catalog:
    """The catalog of a folder, kept per session so that its plans are analysed once."""
    return _CATALOGS.setdefault(spark, {}).setdefault(folder, Catalog(spark, folder))


class Catalog:
    """Canonical tables of one data folder; the large ones are written on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._frames: dict[str, DataFrame] = {}

    def _land(self, name: str, frame: DataFrame) -> DataFrame:
        """Write a table to the session's shared folder and read it back.

        The reports then scan typed tables with column pruning and filter pushdown, and do not
        derive them again and again.  Rows are written where they are computed: a shuffle that only spreads
        them would move the whole table once more.  Ledgers lie in buckets of their key.
        """
        folder = f"{checkpoint_dir(self.spark)}/tables-{self.spark.sparkContext.applicationId}"
        path = f"{folder}/{hashlib.md5(self.folder.encode()).hexdigest()}/{name}"
        if name in LEDGER_KEYS:
            ledger = open_ledger(self.spark, path, LEDGER_KEYS[name], frame.schema, LANDED_BUCKETS)
            book(frame, ledger)
            return self.spark.table(ledger)
        frame.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)

    def stored(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A report or view that a query reads several times, written on first use."""
        if name not in self._frames:
            self._frames[name] = self._land(name, build())
        return self._frames[name]

    def stored_by_month(self, name: str, ts: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A report that is read by month, in folders by month of ``ts``; its ``ledger_month`` column comes last."""
        key = f"{name}_by_month"
        if key not in self._frames:
            frame, path = build(), new_folder(self.spark, key)
            append_by_month(frame, ts, path)
            self._frames[key] = read_by_month(self.spark, path, frame.schema)
        return self._frames[key]

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES and name not in BASE_TABLES:
            raise AttributeError(name)
        return self.table(name)

    def table(self, name: str) -> DataFrame:
        if name not in self._frames:
            if name in TABLES:
                text = text_for(name, "spark")
                inputs = {dep: self.table(dep) for dep in dependencies(text)}
                frame = self.spark.sql(text, **inputs)
                self._frames[name] = self._land(name, frame) if name in LANDED else frame
            else:
                self._frames[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._frames[name]
