"""Pieces shared by the three shop reports: line schema, line values, ledger columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions import null_of
from ledgerloom.functions.money import eleventh, net_of_eleventh, net_of_tax, tax_part
from ledgerloom.functions.rules import TAX_INCLUDED, Ruleset, balance, classify
from ledgerloom.schemas import schema

# Amounts of a line before classification.
LINE_AMOUNTS = "subtotal double, tax double, total double, product_count double, product string"


def line_schema(extra: str):
    return schema(f"order_number string, mail string, date_transaction timestamp_ntz, {LINE_AMOUNTS}, {extra}")


def goods(quantity: Column, price: Column) -> dict[str, Column]:
    """Amounts of a goods line: the total includes reduced-rate tax."""
    total = quantity * price
    return {"subtotal": net_of_tax(total), "tax": tax_part(total), "total": total, "product_count": quantity}


def single(product: str, subtotal: Column, tax: Column, total: Column) -> dict[str, Column]:
    """Amounts of a once-per-order line."""
    return {
        "subtotal": subtotal, "tax": tax, "total": total,
        "product_count": F.lit(1.0), "product": F.lit(product),
    }


def standard_rate(product: str, amount: Column, total: Column | None = None) -> dict[str, Column]:
    """A once-per-order line that includes standard-rate tax (one eleventh)."""
    return single(product, net_of_eleventh(amount), eleventh(amount), amount if total is None else total)


def ledger_columns(rules: Ruleset, amount: Column | None = None) -> dict[str, Column]:
    """Accounting columns of a classified line."""
    total = F.col("total")
    return {
        "balance": balance(total, rules.unknown_balance),
        **classify(F.col("product"), F.col("order_number"), total, rules),
        "amount": F.abs(total) if amount is None else amount,
        "tax_calculation_distinction": F.lit(TAX_INCLUDED),
        "department": null_of("string"),
        "memo_tag": null_of("string"),
        "settlement_account": F.lit("Shopify"),
    }


def pick(columns: dict[str, Column], order: str) -> list[Column]:
    return [columns[name].alias(name) for name in order.split()]
