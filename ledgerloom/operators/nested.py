"""Flattening of nested order documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.nested import find_tokens, first_field, refund_total, sum_amounts
from ledgerloom.functions.text import clean_text


def explode_lines(orders: DataFrame) -> DataFrame:
    """One row per order line; an order without lines stays with NULL line columns."""
    return (
        orders.withColumn("_line", F.explode_outer("line_items"))
        .select(
            *[c for c in orders.columns if c != "line_items"],
            F.col("_line.quantity").cast("double").alias("lineitem_quantity"),
            F.col("_line.name").alias("lineitem_name"),
            F.col("_line.price").try_cast("double").alias("lineitem_price"),
            F.col("_line.sku").alias("lineitem_sku"),
            sum_amounts(F.col("_line.discount_allocations"), whole_units=True).alias("lineitem_discount"),
        )
    )


def first_discount(orders: DataFrame) -> DataFrame:
    """Code, amount and type of the first discount; gateway list and notes as plain text."""
    codes = F.col("discount_codes")
    out = (
        orders.withColumn("discount_code", first_field(codes, "code"))
        .withColumn("discount_amount", first_field(codes, "amount").try_cast("double"))
        .withColumn("discount_type", first_field(codes, "type"))
        .drop("discount_codes")
    )
    if "payment_gateway_names" in out.columns:
        names = F.col("payment_gateway_names")
        joined = clean_text(F.array_join(names, ", "))
        out = out.withColumn("payment_gateway_names", F.when(F.size(names) > 0, joined))
    if "note_attributes" in out.columns:
        notes = F.col("note_attributes")
        pairs = F.transform(
            notes,
            lambda n: F.concat(
                F.lit("name: "), F.coalesce(n.getField("name"), F.lit("None")),
                F.lit(", value: "), F.coalesce(n.getField("value"), F.lit("None")),
            ),
        )
        out = out.withColumn("note_attributes", F.when(F.size(notes) > 0, clean_text(F.array_join(pairs, ", "))))
    return out


def with_refund_total(orders: DataFrame) -> DataFrame:
    return orders.withColumn("refund", refund_total(F.col("refunds"))).drop("refunds")


def refund_lines(orders: DataFrame) -> DataFrame:
    """One row per refunded line with its order's context; missing parts are NULL, shipping 0."""
    return (
        orders.withColumn("_refund", F.explode("refunds"))
        .withColumn("_rl", F.explode("_refund.refund_line_items"))
        .select(
            F.col("_rl.id").alias("id"),
            F.col("_rl.line_item_id").alias("line_item_id"),
            F.col("_rl.location_id").cast("string").alias("location_id"),
            F.col("_rl.quantity").cast("double").alias("quantity"),
            F.col("_rl.restock_type").alias("restock_type"),
            F.col("_rl.subtotal").alias("subtotal"),
            F.col("_rl.total_tax").alias("total_tax"),
            "name",
            F.col("created_at").alias("order_date"),
            F.col("cancelled_at").alias("cancel_date"),
            "financial_status",
            F.coalesce(
                F.col("total_shipping_price_set.shop_money.amount").try_cast("double"), F.lit(0.0)
            ).alias("shipping_amount"),
            F.col("_rl.line_item.fulfillment_status").alias("fulfillment_status"),
            F.col("_rl.line_item.name").alias("product_name"),
            F.col("_rl.line_item.sku").alias("sku"),
            F.col("_rl.line_item.price").try_cast("double").alias("line_price"),
            F.col("_rl.line_item.total_discount").try_cast("double").alias("line_discount"),
        )
    )


def flatten_prefix(df: DataFrame, prefixes: dict[str, str]) -> DataFrame:
    """Replace structs by their leaf fields.

    ``prefixes`` maps a struct path (``a.b``) to the prefix of the new names.  Other columns
    stay, except the top-level structs that were opened.
    """
    opened = {path.split(".")[0] for path in prefixes}
    columns = [F.col(c) for c in df.columns if c not in opened]
    for path, prefix in prefixes.items():
        struct: T.DataType = df.schema
        for part in path.split("."):
            struct = struct[part].dataType
        columns += [F.col(f"{path}.{f.name}").alias(prefix + f.name) for f in struct.fields]
    return df.select(*columns)


# New name prefixes of the order's money and address structs.
ORDER_STRUCTS = {
    "total_shipping_price_set.shop_money": "shipping_shop_",
    "total_shipping_price_set.presentment_money": "shipping_presentment_",
    "shipping_address": "ship_",
}
ORDER_STRUCT_LEFTOVERS = ("shipping_shop_currency_code", "shipping_presentment_currency_code")


def flatten_order(orders: DataFrame) -> DataFrame:
    present = {p: n for p, n in ORDER_STRUCTS.items() if p.split(".")[0] in orders.columns}
    return flatten_prefix(orders, present).drop(*ORDER_STRUCT_LEFTOVERS)


def charge_refs(transactions: DataFrame) -> DataFrame:
    """Charge reference per order from its transaction page.

    Input: ``order_id`` and ``transactions``, an array of raw JSON objects.  Only successful
    ones count.  Tokens found anywhere are joined by ``-``; an order without tokens gets one
    row per successful transaction with that transaction's ``payment_id``.
    """
    ok = F.filter("transactions", lambda t: F.get_json_object(t, "$.status") == "success")
    ids = F.transform("_ok", lambda t: F.get_json_object(t, "$.payment_id"))
    return (
        transactions.select("order_id", ok.alias("_ok"))
        .withColumn("_tokens", find_tokens(F.array_join("_ok", ","), "ch_"))
        .withColumn(
            "_refs",
            F.when(F.size("_tokens") > 0, F.array(F.array_join("_tokens", "-"))).otherwise(ids),
        )
        .select("order_id", F.explode("_refs").alias("charge_ref"))
    )


def distinct_ids(df: DataFrame, column: str = "id") -> DataFrame:
    return df.select(column).distinct()
