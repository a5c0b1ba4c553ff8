"""Declared schemas of all feeds.  Fixed values: column names and types of the outside systems."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "date": T.DateType(),
}


def schema(text: str) -> T.StructType:
    """Schema from plain ``name type`` columns with commas between them; needs no session, as Spark's own parser would."""
    columns = [column.split() for column in text.split(",") if column.strip()]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in columns])


def as_text(typed: T.StructType) -> T.StructType:
    """The same columns, all read as text."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in typed.fields])


STRIPE_BALANCE = schema("""
    balance_transaction_id string, created_utc timestamp_ntz, currency string, gross double, fee
    double, net double, reporting_category string, source_id string, description string,
    customer_facing_amount double, customer_facing_currency string, customer_id string,
    customer_email string, customer_description string, charge_id string, payment_intent_id string,
    invoice_id string, payment_method_type string,
""")

STRIPE_PAYOUTS = schema("""
    automatic_payout_id string, automatic_payout_effective_at timestamp_ntz,
    balance_transaction_id string, created_utc timestamp_ntz, created timestamp_ntz,
    available_on_utc timestamp_ntz, available_on timestamp_ntz, currency string, gross double,
    fee double, net double, reporting_category string, source_id string, description string,
    customer_facing_amount double, customer_facing_currency string, customer_id string,
    customer_email string, charge_id string, payment_intent_id string,
    charge_created_utc timestamp_ntz, invoice_id string, order_id string,
    payment_method_type string, connected_account_id string, connected_account_name string,
""")

AMAZON_PAY = schema("""
    transactionposteddate timestamp_ntz, settlementid string, amazontransactionid string,
    sellerreferenceid string, transactiontype string, amazonorderreferenceid string,
    sellerorderid string, storename string, currencycode string, transactiondescription string,
    transactionamount double, transactionpercentagefee double, transactionfixedfee double,
    totaltransactionfee double, nettransactionamount double, settlement_end_date timestamp_ntz,
""")

TRANSACTION_VIEW = schema("""
    settlement_id double, settlement_start_date timestamp_ntz, settlement_end_date timestamp_ntz,
    deposit_date timestamp_ntz, total_amount double, currency string, transaction_type string,
    order_id string, merchant_order_id string, adjustment_id string, shipment_id string,
    marketplace_name string, amount_type string, amount_description string, amount double,
    fulfillment_id string, posted_date timestamp_ntz, posted_date_time timestamp_ntz,
    order_item_code string, merchant_order_item_id string, merchant_adjustment_item_id double,
    sku string, quantity_purchased double, promotion_id string,
""")

ORDER_CENTRAL = schema("""
    amazon_order_id string, merchant_order_id string, purchase_date timestamp_ntz,
    last_updated_date timestamp_ntz, order_status string, fulfillment_channel string,
    sales_channel string, order_channel string, url string, ship_service_level string,
    product_name string, sku string, asin string, item_status string, quantity bigint,
    currency string, item_price double, item_tax double, shipping_price double, shipping_tax double,
    gift_wrap_price double, gift_wrap_tax double, item_promotion_discount double,
    ship_promotion_discount double, ship_city string, ship_state string, ship_postal_code string,
    ship_country string, promotion_ids string,
""")

# Accepted time formats of the marketplace reports, tried in this order.
MARKETPLACE_TIME_FORMATS = {
    "tv": ("dd.MM.yyyy HH:mm:ss z", "dd.MM.yyyy", "yyyy-MM-dd HH:mm:ss"),
    "oc": ("yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mm:ssXX", "dd.MM.yyyy", "yyyy-MM-dd HH:mm:ss"),
}

PAYMENT_MAIN = schema("""
    number string, order_confirmation_date timestamp_ntz, order_number string,
    payment_number string, payment_institution_link_number string, onquiry_number string,
    payment_confirmation_date timestamp_ntz, rakuten_pay_money double, payment_method string,
    summary string, report_id string,
""")

# Header text of the coupon section; two spellings exist for two of the names.
COUPON_HEADERS = {
    "連番": "number",
    "注文確認日": "order_confirmation_date",
    "課税資産譲渡日": "order_confirmation_date",
    "受注番号": "order_number",
    "クーポン利用確定日": "coupon_confirmation_date",
    "クーポン支払額確定日": "coupon_confirmation_date",
    "クーポン利用額": "coupon_amount",
    "クーポン名": "coupon_name",
}
PAYMENT_COUPON = schema("""
    order_number string, order_confirmation_date timestamp_ntz, coupon_name string,
    coupon_amount double, coupon_confirmation_date timestamp_ntz, report_id string,
""")
SECTION_HEADER, SECTION_TOTAL = "連番", "合計"

NOMENCLATURE = schema("""
    transaction_type string, amount_type string, amount_description string,
    concatenated_fields string, remarks string, account string, item string, tax_distiction string,
""")

_SHEET = """
    balance string, settlement_id string, purchase_or_posted_date timestamp_ntz,
    payment_date timestamp_ntz, supplier string, account string, tax_distiction string,
    total_sum double, tax_calc_distinction string, tax_amount string, remarks string, item string,
    department string, memo string, pay_date timestamp_ntz, payment_account string,
    payment_amount double,
"""
REPORT_SHEETS = {
    "sa": schema(_SHEET + "LAST_UPDATED string, TOTAL double"),
    "ss": schema(_SHEET + "TOTAL double"),
    "sh": schema(_SHEET + "TOTAL double"),
}

# Flattened order line, as stored in the order master.
ORDER_MASTER = schema("""
    id string, buyer_accepts_marketing boolean, cancel_reason string, cancelled_at timestamp_ntz,
    cart_token string, checkout_id string, checkout_token string, confirmed string,
    contact_email string, created_at timestamp_ntz, current_subtotal_price double,
    current_total_discounts double, current_total_price double, current_total_tax string,
    email string, financial_status string, fulfillment_status string, refund double, name string,
    note string, note_attributes string, number string, order_number string,
    payment_gateway_names string, processed_at timestamp_ntz, processing_method string,
    reference string, source_identifier string, source_name string, tags string, token string,
    total_outstanding double, updated_at timestamp_ntz, shipping_shop_amount double,
    shipping_presentment_amount double, lineitem_quantity double, lineitem_name string,
    lineitem_price double, lineitem_sku string, discount_code string, discount_amount double,
    discount_type string, subtotal_price double, total_price double, total_tax double,
    UPDATED_FROM_API timestamp_ntz, ship_address1 string, ship_phone string, ship_city string,
    ship_zip string, ship_province string, ship_country string, ship_first_name string,
    ship_last_name string, ship_address2 string, ship_company string, ship_name string,
    ship_latitude double, ship_longitude double, ship_country_code string,
    ship_province_code string, total_discounts double, lineitem_discount double,
""")
DEPRECATED_ORDER_COLUMNS = ("gateway", "cart_token", "checkout_token", "token", "processing_method")

PAYOUTS = schema("""
    id string, type string, payout_id string, payout_status string, amount double, fee double,
    net double, source_id string, source_type string, source_order_id string,
    source_order_transaction_id string, processed_at timestamp_ntz,
    adjustment_order_transactions string,
""")

_LINE = """
    array<struct<quantity bigint, name string, price string, sku string,
      discount_allocations array<struct<amount string>>>>
"""
_REFUND_LINE = """
    struct<id bigint, line_item_id bigint, location_id bigint, quantity bigint, restock_type string,
      subtotal double, total_tax double, line_item struct<name string, sku string, price string,
      total_discount string, fulfillment_status string>>
"""
_MONEY = "struct<amount string, currency_code string>"
_ADDRESS = """
    struct<address1 string, phone string, city string, zip string, province string, country string,
      first_name string, last_name string, address2 string, company string, name string,
      latitude double, longitude double, country_code string, province_code string>
"""
# Nested order document, as it lands from the shop.
ORDER_DOCUMENT = f"""
    id bigint, name string, email string, order_number bigint, created_at string,
    processed_at string, updated_at string, cancelled_at string, cancel_reason string,
    confirmed boolean, contact_email string, buyer_accepts_marketing boolean, number bigint,
    financial_status string, fulfillment_status string, reference string, checkout_id bigint,
    note string, tags string, source_identifier string, source_name string,
    payment_gateway_names array<string>,
    note_attributes array<struct<name string, value string>>,
    discount_codes array<struct<code string, amount string, type string>>,
    line_items {_LINE}, refunds array<struct<refund_line_items array<{_REFUND_LINE}>>>,
    total_shipping_price_set struct<shop_money {_MONEY}, presentment_money {_MONEY}>,
    shipping_address {_ADDRESS},
    current_subtotal_price string, current_total_price string, current_total_discounts string,
    current_total_tax string, total_discounts string, total_outstanding string,
    subtotal_price string, total_price string, total_tax string
"""
