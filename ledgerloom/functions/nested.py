"""Expressions over arrays, structs and raw JSON text; no Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sum_amounts(items: Column, field: str = "amount", whole_units: bool = False) -> Column:
    """Sum of a numeric text field over an array of structs; 0 for an empty or NULL array.

    ``whole_units`` cuts each amount to whole units before adding.
    """
    def amount(item: Column) -> Column:
        value = F.coalesce(item.getField(field).try_cast("double"), F.lit(0.0))
        return value.cast("bigint").cast("double") if whole_units else value

    return F.coalesce(
        F.aggregate(items, F.lit(0.0), lambda total, item: total + amount(item)), F.lit(0.0)
    )


def first_field(items: Column, field: str) -> Column:
    """A field of the first element; NULL if there is no element."""
    return F.get(items, F.lit(0)).getField(field)


def refund_total(refunds: Column) -> Column:
    """Sum of all refunded line subtotals of an order; 0 if there are none."""
    lines = F.flatten(
        F.transform(refunds, lambda r: F.coalesce(r.getField("refund_line_items"), F.array()))
    )
    return F.coalesce(
        F.aggregate(
            lines, F.lit(0.0), lambda total, ln: total + F.coalesce(ln.getField("subtotal"), F.lit(0.0))
        ),
        F.lit(0.0),
    )


def find_tokens(json_text: Column, prefix: str) -> Column:
    """Sorted distinct string values that start with ``prefix`` at any depth of a JSON text.

    The look-ahead skips object keys.  Escaped quotes inside a token are not supported.
    """
    pattern = f'"({prefix}[^"]*)"(?!\\s*:)'
    return F.array_sort(F.array_distinct(F.regexp_extract_all(json_text, F.lit(pattern), F.lit(1))))
