"""Roll-ups.  Every key is projected to its final name first and grouped afterwards, so a key
that is renamed or rewritten is grouped by its new value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.dates import month_start, to_local
from ledgerloom.functions.money import REDUCED_TAX, STANDARD_TAX
from ledgerloom.functions.rules import EXPENSE, INCOME, balance_by_sign
from ledgerloom.functions.text import canonical_remark, rule_key
from ledgerloom.functions import first_match
from ledgerloom.operators.months import MONTH

SALES = "Sales"  # item of the lines that count as sales

# Products that are not goods, so their quantity is not counted.
NOT_GOODS = ("Shipping", "Discount", "Chargeback", "Handling Fee", "partial refund")


HOME = "_home"  # the order of a line, or what stands in for it


def order_home() -> Column:
    """What lines of one order share, for shuffling; lines without an order are spread by their settlement, time and stock code.

    The zero character keeps the stand-ins apart from real order ids.
    """
    spread = F.xxhash64("settlement_id", "posted_date_time", "sku").cast("string")
    return F.coalesce(F.col("order_id"), F.concat(F.lit("\0"), spread)).alias(HOME)


def fee_preagg(tv: DataFrame, by_order: bool = False) -> DataFrame:
    """Amounts and quantities per settlement, local time, type, order and stock code.

    ``by_order`` shuffles the lines by :func:`order_home`, which comes as a column more, so that later joins
    and sums by order need no shuffle of their own.
    """
    keys = [
        F.round("settlement_id").cast("bigint").alias("settlement_id"),
        to_local(F.col("posted_date_time")).alias("posted_date_time"),
        "transaction_type", "amount_type", "amount_description", "order_id", "sku",
    ]
    names = ["settlement_id", "posted_date_time", "transaction_type", "amount_type",
             "amount_description", "order_id", "sku"]
    lines = tv.select(*keys, "amount", "quantity_purchased")
    if by_order:
        lines, names = lines.select("*", order_home()).repartition(HOME), [*names, HOME]
    return (
        lines.groupBy(*names)
        .agg(F.sum("amount").alias("total_amount"), F.sum("quantity_purchased").alias("total_purchased"))
        .withColumn(
            "concat_fields",
            rule_key(F.col("transaction_type"), F.col("amount_type"), F.col("amount_description")),
        )
    )


def report_agg(lines: DataFrame, keys: Sequence[str], sum_col: str) -> DataFrame:
    """Signed and absolute sum per key with the balance side of the sum."""
    return (
        lines.groupBy(*keys)
        .agg(F.sum(sum_col).alias("total_real"))
        .withColumn("total_sum", F.abs("total_real"))
        .withColumn("balance", balance_by_sign(F.col("total_real")))
    )


def sheet_agg(report: DataFrame, min_settlement: str) -> DataFrame:
    """Condensed sheet of the settlements after ``min_settlement`` (compared as text)."""
    keys = ["settlement_id", "remarks", "main_date", "deposit_date", "supplier", "account", "item",
            "tax_distiction", "tax_calc_distinction"]
    label = F.col("tax_distiction")
    tax = first_match(
        [
            (label.like("%8%"), F.abs(F.round(F.col("total_real") * F.lit(REDUCED_TAX)))),
            (label.like("%10%"), F.abs(F.round(F.col("total_real") * F.lit(STANDARD_TAX)))),
        ],
        F.lit(0.0),
    )
    return (
        report_agg(report.where(F.col("settlement_id") > min_settlement), keys, "total_real")
        .where(F.col("total_real") != 0)
        .select(
            "balance", "settlement_id", "main_date", "deposit_date", "supplier", "account", "tax_distiction",
            F.col("total_sum").alias("total"), "tax_calc_distinction", tax.alias("tax"), "remarks", "item",
            F.lit(None).cast("string").alias("department"), F.lit(None).cast("string").alias("memo"),
        )
    )


def _monthly(lines: DataFrame, keys: Sequence[str]) -> DataFrame:
    return (
        lines.groupBy(*keys)
        .agg(F.sum("amount").alias("total_amount"), F.sum("quantity").alias("total_quantity"))
        .withColumn("balance", F.when(F.col("total_amount") < 0, EXPENSE).otherwise(INCOME))
    )


def _whole(quantity: Column) -> Column:
    return F.round(quantity).cast("bigint")


# What the monthly roll-up reads of a channel's ledger, and its column of the stock code.
SKU_MONTHLY_INPUT = {
    "amazon": ("settlement_id", "sku", "main_date", "account", "tax_distiction", "remarks", "item", "total_real", "total_purchased"),
    "rakuten": ("control_number", "item_number", "order_date", "account", "tax_distinction", "remarks", "item", "real_amount", "quantity"),
    "shopify": ("control_number", "sku", "transaction_date", "account", "tax_distinction", "remarks", "item", "product", "real_amount",
                "product_count"),
}
SKU_COLUMN = {"amazon": "sku", "rakuten": "item_number", "shopify": "sku"}


def sku_monthly(ledger: DataFrame, channel: str, also: Sequence[str] = ()) -> DataFrame:
    """Monthly amounts and goods quantities per stock code for one channel's ledger.

    ``also``: columns that follow from the keys and stay, such as those that the ledger is spread by.
    """
    remarks = F.col("remarks")
    if channel == "amazon":
        lines = ledger.select(
            "settlement_id", "sku", month_start(F.col("main_date")).alias("month"), "account", "tax_distiction",
            "remarks", "item", F.col("total_real").alias("amount"),
            F.when(remarks != "Product Charges", None).otherwise(_whole(F.col("total_purchased"))).alias("quantity"),
            *also,
        )
        keys = ["settlement_id", "sku", "month", "account", "tax_distiction", "remarks", "item"]
    elif channel == "rakuten":
        lines = ledger.select(
            "control_number", "item_number", month_start(F.col("order_date")).alias("month"), "account",
            "tax_distinction", "remarks", "item", F.col("real_amount").alias("amount"),
            F.when(~remarks.like("Product Charges%"), None).otherwise(_whole(F.col("quantity"))).alias("quantity"),
            *also,
        )
        keys = ["control_number", "item_number", "month", "account", "tax_distinction", "remarks", "item"]
    elif channel == "shopify":
        special = F.col("product").isin(*NOT_GOODS)
        lines = ledger.select(
            "control_number", "sku", month_start(F.col("transaction_date")).alias("month"), "account",
            "tax_distinction", canonical_remark(remarks).alias("remarks"), "item",
            F.when(special, F.col("product")).alias("product"), F.col("real_amount").alias("amount"),
            F.when(~remarks.like("Product Charges%") | special, None)
            .otherwise(_whole(F.col("product_count"))).alias("quantity"),
            *also,
        )
        keys = ["control_number", "sku", "month", "account", "tax_distinction", "remarks", "item", "product"]
    else:
        raise ValueError(f"unknown channel {channel!r}")
    return _monthly(lines, [*keys, *also])


def condensed_monthly(report: DataFrame) -> DataFrame:
    """Settlement report by month of accrual: 15 keys, 4 sums."""
    lines = report.select(
        "balance", "control_number", month_start(F.col("accrual_date")).alias("transaction_date"),
        F.col("settlement_date").alias("accrual_date"), "suppliers", "account", "tax_distinction",
        "tax_calculation_distinction", "remarks", "item", "department", "memo_tag",
        F.col("date_3").alias("settlement_date"), "settlement_account", "order_number",
        "amount", "tax_total", "settlement_amount", "real_amount",
    )
    keys = lines.columns[:15]
    return lines.groupBy(*keys).agg(
        F.sum("amount").alias("total"),
        F.sum("tax_total").alias("tax_tot"),
        F.sum("settlement_amount").alias("settlement_total_amount"),
        F.sum("real_amount").alias("real_total"),
    )


# What the sales of a month read of the dashboard feed, and of its lines that have no item names yet.
SALES_INPUT = ("transaction_date", "amount", "sku", "SOURCE", "item_name", "quantity")
SALES_LINES = ("transaction_date", "amount", "quantity", "sku", "SOURCE", "item", "account")


def sales_by_sku(feed: DataFrame, source: str, year: int, month: int) -> DataFrame:
    """Sales of one month and source; of a feed that is stored by month only that month is read."""
    when = F.col("transaction_date")
    if MONTH in feed.columns:
        feed = feed.where(F.col(MONTH) == f"{year:04}-{month:02}")
    return (
        feed.where((F.col("SOURCE") == source) & (F.year(when) == year) & (F.month(when) == month))
        .groupBy("item_name", "sku")
        .agg(F.sum("quantity").alias("q_sales"), F.sum("amount").alias("sales"))
    )


def yearly_sales_by_source(feed: DataFrame) -> DataFrame:
    return (
        feed.where(F.col("item") == SALES)
        .groupBy("SOURCE", F.year("transaction_date").alias("year"))
        .agg(F.sum("amount").alias("total"))
    )


def last_seen_by(df: DataFrame, predicate: Column, key: str, ts: str, name: str = "first_appearance_date") -> DataFrame:
    """Latest time per value among the rows that meet the predicate."""
    return df.where(predicate).groupBy(key).agg(F.max(ts).alias(name))


def control_total(df: DataFrame, predicate: Column, value: str = "total_real") -> DataFrame:
    """One row: the sum over the rows that meet the predicate (NULL if there are none)."""
    return df.where(predicate).agg(F.sum(value).alias("total_to_update"))


def sheet_monthly_fold(report: DataFrame) -> DataFrame:
    """Fold the sheet report by month: twelve keys, totals, taxes and the signed total."""
    signed = F.when(F.col("balance") == EXPENSE, -F.col("total")).otherwise(F.col("total"))
    lines = report.select(
        "balance", "settlement_id", month_start(F.col("main_date")).alias("month"), "deposit_date", "supplier",
        "account", "tax_distiction", "tax_calc_distinction", "remarks", "item", "department", "memo",
        "total", "tax", signed.alias("signed"),
    )
    return lines.groupBy(*lines.columns[:12]).agg(
        F.sum("total").alias("total"), F.sum("tax").alias("tax"), F.sum("signed").alias("real_value")
    )


def scalar_extreme(df: DataFrame, column: str, fn: str) -> DataFrame:
    """``max`` or ``min`` of a text id compared as a whole number."""
    number = F.col(column).try_cast("bigint")
    return df.agg({"max": F.max, "min": F.min}[fn](number).alias("value"))
