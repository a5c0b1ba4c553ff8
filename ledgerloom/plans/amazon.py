"""Marketplace settlement reports from the transaction view."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import first_match, null_of
from ledgerloom.functions.dates import to_local
from ledgerloom.functions.rules import TAX_INCLUDED
from ledgerloom.functions.text import rule_key
from ledgerloom.operators.aggregates import HOME, fee_preagg, report_agg, sheet_agg
from ledgerloom.operators.joins import apply_rules, join_cast_key, join_distinct, not_booked, semi_in
from ledgerloom.operators.maintenance import adjust_rows
from ledgerloom.operators.windows import latest_k, running_sum
from ledgerloom.storage import stored

SUPPLIER = "Amazon Seller"
REIMBURSEMENT = "FBA Inventory Reimbursement"

REPORT_COLUMNS = [
    "balance", "settlement_id", "main_date", "deposit_date", "supplier", "account", "tax_distiction",
    "total_sum", "tax_calc_distinction", "remarks", "item", "department", "memo", "DATE_TYPE", "sku",
    "total_purchased", "total_real", "order_id", "posted", "DATE_OF_QUERY", "deposit_full_date",
    "order_full_date",
]


def business_date(lines: DataFrame) -> DataFrame:
    """Business time and its origin: refunds and reimbursements count when posted, sales when ordered."""
    posted, ordered = F.col("posted_date_time"), F.col("purchase_date")
    rules = [
        (F.col("transaction_type") == "Refund", posted, "POSTED_DATE_REFUND"),
        (F.col("amount_type") == REIMBURSEMENT, posted, "POSTED_DATE_REIMBURSEMENT"),
        (ordered.isNull(), posted, "POSTED_DATE"),
    ]
    return lines.withColumn("main_time", first_match([(p, t) for p, t, _ in rules], ordered)).withColumn(
        "DATE_TYPE", first_match([(p, F.lit(n)) for p, _, n in rules], F.lit("ORDER_DATE"))
    )


def lines_under(tv: DataFrame, nomenclature: DataFrame, labels: Column) -> DataFrame:
    """Lines that a rule with these labels classifies; a line without a rule is none of them."""
    key = rule_key(F.col("transaction_type"), F.col("amount_type"), F.col("amount_description"))
    rules = nomenclature.where(labels).select("concatenated_fields")
    return semi_in(tv.withColumn("_rule", key), "_rule", rules).drop("_rule")


def classified_lines(tv: DataFrame, oc: DataFrame, nomenclature: DataFrame, labels: Column | None = None) -> DataFrame:
    """Pre-aggregated fee lines with order date, business date and accounting labels.

    Adding up comes before the joins, so the joins see far fewer rows.  The lines are shuffled once, by order
    (``HOME``); account-level fees have no order and match none.  ``labels``: only lines whose rule meets it, a
    condition on columns of the nomenclature; the others drop out before the shuffle.
    """
    if labels is not None:
        tv, nomenclature = lines_under(tv, nomenclature, labels), nomenclature.where(labels)
    orders = oc.where(F.col("amazon_order_id").isNotNull())
    dated = join_distinct(
        fee_preagg(tv, by_order=True), orders, [(HOME, "amazon_order_id")], {"purchase_date": to_local(F.col("purchase_date"))}
    )
    return apply_rules(business_date(dated).where(F.col("main_time").isNotNull()), nomenclature)


def _text_id() -> Column:
    """The settlement id of the transaction view, which loads it as a double, as text."""
    return F.round("settlement_id").cast("bigint").cast("string")


def _core(
    tv: DataFrame, oc: DataFrame, nomenclature: DataFrame, as_of: date, dated: DataFrame | None = None, by_order: bool = False,
    labels: Column | None = None,
) -> DataFrame:
    """Report lines with the deposit date; several deposit dates of a settlement repeat its lines.

    ``dated``: the rows that give the deposit dates, where ``tv`` comes from a join that need not run twice.
    ``by_order`` keeps ``HOME`` as a column more, for joins by order that find the lines where they lie.
    """
    keys = ["settlement_id", "main_time", "account", "tax_distiction", "remarks", "item", "DATE_TYPE", "sku",
            "order_id", "posted_date_time", "total_purchased"]
    # HOME is a function of other keys; it is named so that the lines stay where they are
    lines = report_agg(classified_lines(tv, oc, nomenclature, labels), [*keys, HOME], "total_amount").withColumn(
        "settlement_id", F.col("settlement_id").cast("string")
    )
    deposits = (
        (tv if dated is None else dated).where(F.col("deposit_date").isNotNull())
        .select(F.col("settlement_id").alias("sett"), F.col("deposit_date").alias("deposit_full_date"))
        .distinct()
    )
    return join_cast_key(lines, deposits, "settlement_id", "sett").select(
        "balance",
        "settlement_id",
        F.col("main_time").cast("date").alias("main_date"),
        to_local(F.col("deposit_full_date")).cast("date").alias("deposit_date"),
        F.lit(SUPPLIER).alias("supplier"),
        "account", "tax_distiction", "total_sum",
        F.lit(TAX_INCLUDED).alias("tax_calc_distinction"),
        "remarks", "item",
        null_of("string").alias("department"),
        null_of("string").alias("memo"),
        "DATE_TYPE", "sku", "total_purchased", "total_real", "order_id",
        F.col("posted_date_time").cast("date").alias("posted"),
        F.lit(as_of).alias("DATE_OF_QUERY"),
        "deposit_full_date",
        F.col("main_time").alias("order_full_date"),
        *([HOME] if by_order else []),
    )


def amazon_report(
    tv: DataFrame, oc: DataFrame, nomenclature: DataFrame, ledger: DataFrame | None = None, *, as_of: date, by_order: bool = False,
    labels: Column | None = None,
) -> DataFrame:
    """All settlements not yet booked; ``ledger=None`` rebuilds everything.

    The settlement is part of every key that follows, so booked ones drop out at the scan.
    ``by_order`` keeps the column ``HOME``.  ``labels``: only the lines whose rule meets this condition on account,
    item, remarks or tax label.
    """
    fresh = not_booked(tv.withColumn("_sett", _text_id()), ledger, "_sett", "settlement_id").drop("_sett")
    return _core(fresh, oc, nomenclature, as_of, dated=tv, by_order=by_order, labels=labels)


def amazon_report_latest(tv: DataFrame, oc: DataFrame, nomenclature: DataFrame, k: int = 5, *, as_of: date) -> DataFrame:
    """The ``k`` latest settlements of the transaction view (ids compare as text).

    The settlements are picked before anything is joined or added up.
    """
    recent = latest_k(tv.withColumn("_sett", _text_id()), "_sett", k).drop("_sett")
    return _core(recent, oc, nomenclature, as_of)


def amazon_sheet_report(
    tv: DataFrame, oc: DataFrame, nomenclature: DataFrame, min_settlement: str, *, as_of: date
) -> DataFrame:
    """Condensed report of the settlements after ``min_settlement``, zero sums left out."""
    later = tv.where(_text_id() > min_settlement)
    return sheet_agg(_core(later, oc, nomenclature, as_of), min_settlement)


def delivery_lines(
    account: str, item: str, remarks: str, settlement_id: str | None = None, month: date | None = None
) -> Column:
    """Predicate of the lines that a date correction looks at."""
    hit = (F.col("account") == account) & (F.col("item") == item) & (F.col("remarks") == remarks)
    if settlement_id is not None:
        hit = hit & (F.col("settlement_id") == settlement_id)
    if month is not None:
        hit = hit & (F.trunc(F.col("order_full_date").cast("date"), "MM") == F.lit(month))
    return hit


def adjust_running_sum(report: DataFrame, predicate: Column) -> DataFrame:
    """Running total by order time of the selected lines.  Eager: writes them, as a running sum reads its rows twice."""
    lines = report.where(predicate).select("item", "remarks", "account", "order_full_date", "total_real")
    return running_sum(stored(lines, "adjusted"), "order_full_date", "total_real")


def move_back_one_month(report: DataFrame, predicate: Column) -> DataFrame:
    """Re-date the selected lines one month earlier and tag them."""
    month = F.expr("interval 1 month")
    return adjust_rows(
        report,
        predicate,
        {
            "main_date": (F.col("main_date") - month).cast("date"),
            "order_full_date": F.col("order_full_date") - month,
            "tax_calc_distinction": F.lit("ONE MONTH SUBSTRACTED"),
        },
    )
