"""Accounting classification: rule sets are data, one function applies them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions import first_match
from ledgerloom.functions.money import REDUCED_TAX, STANDARD_TAX, truncate

# Labels of the bookkeeping system.
INCOME, EXPENSE = "収入", "支出"
SALES_ACCOUNT, FEE_ACCOUNT = "売上高", "支払手数料"
TAX_10, TAX_8, TAX_NONE = "課税売上10%", "課税売上8%（軽）", "対象外"
TAX_INCLUDED = "内税"
MISSING_RULE = "MISSING NOMENCLATURE"

# Names of the generated lines.
SHIPPING, DISCOUNT, FEE = "Shipping", "Discount", "Handling Fee"
CHARGEBACK, PARTIAL_REFUND, EXTRA_TAX = "Chargeback", "partial refund", "Tax not included"

# Products taxed at the standard rate.
SHAKER_ANYWHERE = "%シェイカー%"
SHAKER_EXACT = "GoCLN シェイカー"
SHAKER_MARKETPLACE = "GoCLN（ゴークリーン） シェイカー%"


@dataclass(frozen=True)
class Ruleset:
    """How one report turns a line's product name into accounting columns."""

    shaker_pattern: str  # LIKE pattern of standard-rate products
    fee_products: tuple[str, ...] = (FEE,)
    discount_remark: bool = True
    unknown_balance: str = "SOMETHING_WRONG"


RULESETS = {
    "sh": Ruleset(SHAKER_ANYWHERE, fee_products=(FEE, "adjustment"), discount_remark=False),
    "sh_old": Ruleset(SHAKER_EXACT, discount_remark=False),
    "ss": Ruleset(SHAKER_ANYWHERE, unknown_balance="ERROR"),
    "ss_old": Ruleset(SHAKER_EXACT, unknown_balance="ERROR"),
    "sa": Ruleset(SHAKER_ANYWHERE),
    "sa_old": Ruleset(SHAKER_EXACT),
}


def balance(amount: Column, unknown: str) -> Column:
    """Income above zero, expense at or below zero, a marker for NULL."""
    return first_match(
        [(amount > 0, F.lit(INCOME)), (amount <= 0, F.lit(EXPENSE))], F.lit(unknown)
    )


def balance_by_sign(amount: Column) -> Column:
    """Expense below zero, income from zero on, NULL for NULL."""
    return first_match([(amount < 0, F.lit(EXPENSE)), (amount >= 0, F.lit(INCOME))])


def classify(product: Column, order_number: Column, total: Column, rules: Ruleset) -> dict[str, Column]:
    """Account, tax class, tax amount, remark and item of a ledger line.

    The three product classes exclude each other, so their order does not matter; a NULL
    product is booked as reduced-rate sales with no remark and no item.
    """
    is_shipping = product == SHIPPING
    is_fee = product.isin(*rules.fee_products)
    standard_rate = is_shipping | product.like(rules.shaker_pattern)

    def remark(head: str) -> Column:
        return F.concat(F.lit(f"{head} ("), order_number, F.lit(")"))

    remarks = [(is_shipping, remark("Delivery")), (is_fee, remark("Fee"))]
    if rules.discount_remark:
        remarks.append((product == DISCOUNT, remark("Product Charges Discount")))
    remarks.append((product.isNotNull(), remark("Product Charges")))

    return {
        "account": F.when(is_fee, FEE_ACCOUNT).otherwise(SALES_ACCOUNT),
        "tax_distinction": first_match(
            [(standard_rate, F.lit(TAX_10)), (is_fee, F.lit(TAX_NONE))], F.lit(TAX_8)
        ),
        "tax_total": first_match(
            [
                (standard_rate, F.round(F.abs(total * F.lit(STANDARD_TAX)))),
                (is_fee, F.lit(0.0)),
            ],
            F.round(F.abs(total * F.lit(REDUCED_TAX))),
        ),
        "remarks": first_match(remarks),
        "item": first_match(
            [
                (is_shipping, F.lit("Delivery")),
                (is_fee, F.lit("Fee Shopify")),
                (product.isNotNull(), F.lit("Sales")),
            ]
        ),
    }


def classify_marketplace(product: Column, order_number: Column, total: Column) -> dict[str, Column]:
    """Rule set of the marketplace order report: taxes are cut, not rounded."""
    is_delivery = product == "delivery"
    standard_rate = is_delivery | product.like(SHAKER_MARKETPLACE)

    def remark(head: str) -> Column:
        return F.concat(F.lit(f"{head} (#"), order_number, F.lit(")"))

    return {
        "tax_distinction": first_match(
            [(standard_rate, F.lit(TAX_10)), (product.isNotNull(), F.lit(TAX_8))]
        ),
        "tax_amount": first_match(
            [
                (standard_rate, F.abs(truncate(total * F.lit(STANDARD_TAX)))),
                (product.isNotNull(), F.abs(truncate(total * F.lit(REDUCED_TAX)))),
            ]
        ),
        "remarks": first_match(
            [
                (is_delivery, remark("Delivery")),
                (product == "points", remark("Points issued")),
                (product.isNotNull(), remark("Product Charges")),
            ]
        ),
        "item": first_match(
            [(is_delivery, F.lit("Delivery")), (product.isNotNull(), F.lit("Sales"))]
        ),
    }
