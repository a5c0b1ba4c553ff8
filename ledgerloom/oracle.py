"""The registered queries as SQL for the check engine, written apart from the Spark plans.

``VIEWS`` are shared sub-queries, ``QUERIES`` the results.  ``{name}`` is another view or a
canonical table; :func:`compose` puts everything a query needs in front of it as CTEs.
"""

from __future__ import annotations

from ledgerloom.catalog import BASE_TABLES, TABLES, dependencies, text_for

VIEWS: dict[str, str] = {}
QUERIES: dict[str, str] = {}


def _sql_of(name: str) -> str | None:
    if name in VIEWS:
        return VIEWS[name]
    if name in TABLES:
        return text_for(name, "duckdb")
    if name in QUERIES:
        return QUERIES[name]
    if name in BASE_TABLES:
        return None
    raise KeyError(name)


def _fill(text: str) -> str:
    for dep in dependencies(text):
        text = text.replace("{" + dep + "}", dep)
    return text


def compose(text: str) -> str:
    """Self-contained SQL: the needed views in dependency order, then the query."""
    order: list[str] = []

    def visit(body: str) -> None:
        for dep in dependencies(body):
            inner = _sql_of(dep)
            if inner is not None and dep not in order:
                visit(inner)
                order.append(dep)

    visit(text)
    if not order:
        return _fill(text)
    parts = ",\n".join(f"{n} AS ({_fill(_sql_of(n))})" for n in order)
    return f"WITH {parts}\nSELECT * FROM ({_fill(text)}) AS result"


def sql() -> dict[str, str]:
    return {name: compose(text) for name, text in QUERIES.items()}


# ---------------------------------------------------------------- small SQL writers

LOCAL = "+ interval 9 hours"
NUL = "cast(NULL as varchar)"


def _stack(source: str, columns: list[str], kinds: list[tuple[bool, str, dict[str, str]]]) -> str:
    """UNION ALL of one SELECT per kind of line."""
    selects = []
    for distinct, where, values in kinds:
        # adding zero turns a negative zero into plain zero
        values = {c: f"({v})+0" if c == "total" else v for c, v in values.items()}
        items = ", ".join(f"{values.get(c, c)} AS {c}" for c in columns)
        selects.append(f"SELECT {'DISTINCT ' if distinct else ''}{items} FROM {source} WHERE {where}")
    return "\nUNION ALL ".join(selects)


def _goods(q: str, p: str) -> dict[str, str]:
    return {"total": f"{q}*{p}", "subtotal": f"round({q}*{p}/1.08)", "tax": f"{q}*{p}-round({q}*{p}/1.08)", "pieces": q}


def _once(product: str, total: str, subtotal: str, tax: str) -> dict[str, str]:
    return {"product": f"'{product}'", "total": total, "subtotal": subtotal, "tax": tax, "pieces": "cast(1 as double)"}


def _tenth(product: str, x: str, total: str | None = None, sign: str = "") -> dict[str, str]:
    return _once(product, total or f"{sign}{x}", f"{sign}round({x}-{x}/11)", f"{sign}round({x}/11)")


def _labels(ten: str, fees: str, discount: bool) -> dict[str, str]:
    """Accounting labels as SQL over product, total and order_number."""
    note = "WHEN product='Discount' THEN 'Product Charges Discount (' || order_number || ')' " if discount else ""
    return {
        "account": f"CASE WHEN product IN ({fees}) THEN '支払手数料' ELSE '売上高' END",
        "tax_distinction": f"CASE WHEN {ten} THEN '課税売上10%' WHEN product IN ({fees}) THEN '対象外' ELSE '課税売上8%（軽）' END",
        "tax_total": f"CASE WHEN {ten} THEN round(abs(total*0.1)) WHEN product IN ({fees}) THEN 0 ELSE round(abs(total*0.08)) END",
        "remarks": "CASE WHEN product='Shipping' THEN 'Delivery (' || order_number || ')' "
                   f"WHEN product IN ({fees}) THEN 'Fee (' || order_number || ')' {note}"
                   "WHEN product IS NOT NULL THEN 'Product Charges (' || order_number || ')' END",
        "item": f"CASE WHEN product='Shipping' THEN 'Delivery' WHEN product IN ({fees}) THEN 'Fee Shopify' WHEN product IS NOT NULL THEN 'Sales' END",
        "tax_calculation_distinction": "'内税'",
        "department": NUL, "memo_tag": NUL, "settlement_account": "'Shopify'",
    }


def _side(x: str, unknown: str) -> str:
    return f"CASE WHEN {x}>0 THEN '収入' WHEN {x}<=0 THEN '支出' ELSE '{unknown}' END"


def _select(columns: str, values: dict[str, str]) -> str:
    return ", ".join(f"{values.get(c, c)} AS {c}" for c in columns.split())


def _unbooked(report: str, ledger: str, key: str) -> str:
    return f"SELECT * FROM {{{report}}} WHERE {key} NOT IN (SELECT {key} FROM {{{ledger}}} WHERE {key} IS NOT NULL)"


TEN_NEW = "(product='Shipping' OR product LIKE '%シェイカー%')"
TEN_OLD = "product IN ('Shipping','GoCLN シェイカー')"
ADJ = "'Handling Fee','adjustment'"
FEE = "'Handling Fee'"

# ---------------------------------------------------------------- shop payments

VIEWS["sh_dates"] = "SELECT DISTINCT payout_id, processed_at AS paid FROM {shopify_payouts} WHERE source_type='payout' AND payout_id IS NOT NULL"
VIEWS["sh_pairs"] = """
SELECT o.name AS order_number, o.email AS mail, p.payout_id AS control_number, o.processed_at + interval 9 hours AS sold,
 o.payment_gateway_names AS gateway, p.source_type, o.financial_status, p.type, p.net, p.amount, p.fee,
 o.lineitem_name, o.lineitem_sku, o.lineitem_quantity, o.lineitem_price, o.shipping_shop_amount, o.total_discounts,
 o.discount_amount, o.current_total_discounts AS ctd,
 CASE WHEN p.type='adjustment' THEN 'adjust' WHEN p.source_type LIKE '%Dispute' THEN 'dispute'
  WHEN p.source_type NOT LIKE '%Refund' THEN 'sale' WHEN o.financial_status='partially_refunded' THEN 'part'
  WHEN o.financial_status IS NULL THEN 'unknown' ELSE 'full' END AS kind
FROM {shopify_payouts} p JOIN {orders_master} o ON p.source_order_id=o.id WHERE p.payout_id IS NOT NULL
"""
VIEWS["sh_settled"] = """
SELECT s.*, CASE kind WHEN 'adjust' THEN 'adjustment' WHEN 'dispute' THEN 'Chargeback' WHEN 'full' THEN 'Refund ' || lineitem_name WHEN 'part' THEN 'partial refund' ELSE lineitem_name END AS product,
 CASE WHEN kind IN ('adjust','dispute','part') THEN 1 ELSE lineitem_quantity END AS q,
 CASE kind WHEN 'adjust' THEN net WHEN 'part' THEN amount WHEN 'dispute' THEN amount WHEN 'full' THEN -lineitem_price ELSE lineitem_price END AS p,
 CASE WHEN financial_status='refunded' THEN 0 ELSE total_discounts END AS disc,
 CASE kind WHEN 'part' THEN 'partial refund' WHEN 'adjust' THEN 'adjustment' ELSE coalesce(lineitem_sku,'SPECIAL_ITEM') END AS code,
 CASE WHEN kind IN ('full','part','unknown') THEN 0 ELSE fee END AS cost
FROM {sh_pairs} s LEFT JOIN {sh_dates} d ON d.payout_id=s.control_number
"""
_SH_COLS = ["order_number", "control_number", "mail", "sold", "subtotal", "tax", "total", "pieces", "product", "gateway", "sku",
            "source_type", "financial_status"]
_SH_PART = "financial_status='partially_refunded' AND lower(source_type) LIKE '%refund'"
_SH_CTD = "CASE WHEN product LIKE 'Refund%' THEN abs(ctd) ELSE -ctd END"
_DISC = {
    "product": "'Discount'", "pieces": "cast(1 as double)",
    "subtotal": "CASE WHEN product LIKE 'Refund%' THEN abs(round(ctd-ctd/11)) ELSE -round(ctd-ctd/11) END",
    "tax": "CASE WHEN product LIKE 'Refund%' THEN abs(round(ctd/11)) ELSE -round(ctd/11) END",
}
VIEWS["sh_lines"] = _stack("{sh_settled}", _SH_COLS, [
    (False, "product<>'Chargeback' AND code<>'partial refund'", {**_goods("q", "p"), "sku": "code"}),
    (True, "code='partial refund'", {**_goods("q", "p"), "sku": "code"}),
    (True, "product='Chargeback'", {**_goods("q", "p"), "sku": NUL}),
    (True, "shipping_shop_amount<>0", {
        **_tenth("Shipping", "shipping_shop_amount",
                 f"CASE WHEN {_SH_PART} THEN 0 WHEN lower(source_type) LIKE '%refund' THEN -shipping_shop_amount WHEN lower(source_type)='charge' THEN shipping_shop_amount END"),
        "sku": NUL}),
    (True, "disc<>0 OR ctd<>0", {**_DISC, "total": f"CASE WHEN {_SH_PART} THEN 0 ELSE {_SH_CTD} END", "sku": NUL}),
    (True, "true", {**_once("Handling Fee", "-cost", "-cost", "0"), "sku": NUL}),
])
_SH_REPORT = """balance control_number transaction_date accrual_date suppliers account tax_distinction amount
 tax_calculation_distinction tax_total remarks item department memo_tag settlement_date settlement_account
 settlement_amount real_amount product product_count sku order_number source_type financial_status real_date"""
_SH_WHEN = "CASE WHEN lower(source_type) LIKE '%refund%' THEN paid + interval 57 hours ELSE sold END"
QUERIES["rpt_shopify_full"] = "SELECT " + _select(_SH_REPORT, {
    **_labels(TEN_NEW, ADJ, False), "balance": _side("total", "SOMETHING_WRONG"), "control_number": "cast(control_number as bigint)",
    "transaction_date": f"cast({_SH_WHEN} as date)", "accrual_date": NUL, "suppliers": "'Shopify'", "amount": "abs(total)",
    "settlement_date": "cast(paid + interval 57 hours as date)", "settlement_amount": "abs(total)", "real_amount": "total",
    "product_count": "pieces", "real_date": _SH_WHEN,
}) + " FROM {sh_lines} LEFT JOIN {sh_dates} ON control_number=payout_id WHERE total<>0"
QUERIES["rpt_shopify"] = _unbooked("rpt_shopify_full", "ledger_shopify", "control_number")

VIEWS["sh_settled_v1"] = """
SELECT *, CASE kind WHEN 'dispute' THEN 'Chargeback' WHEN 'adjust' THEN lineitem_name WHEN 'sale' THEN lineitem_name ELSE 'Refund ' || lineitem_name END AS product,
 CASE WHEN kind IN ('dispute','part') THEN 1 ELSE lineitem_quantity END AS q,
 CASE WHEN kind IN ('dispute','part') THEN amount WHEN kind='full' THEN -lineitem_price ELSE lineitem_price END AS p,
 CASE WHEN financial_status='refunded' THEN 0 ELSE discount_amount END AS disc,
 CASE WHEN kind IN ('full','part','unknown') OR financial_status='refunded' THEN 0 WHEN kind='dispute' THEN -shipping_shop_amount ELSE shipping_shop_amount END AS ship,
 CASE WHEN kind IN ('full','part','unknown') THEN 0 ELSE fee END AS cost
FROM {sh_pairs}
"""
_SH1_COLS = ["order_number", "control_number", "mail", "sold", "subtotal", "tax", "total", "pieces", "product", "gateway"]
VIEWS["sh_lines_v1"] = _stack("{sh_settled_v1}", _SH1_COLS, [
    (False, "product<>'Chargeback'", _goods("q", "p")),
    (True, "product='Chargeback'", _goods("q", "p")),
    (True, "ship<>0", _tenth("Shipping", "ship")),
    (True, "disc<>0 OR ctd<>0", {**_DISC, "total": _SH_CTD}),
    (True, "true", _once("Handling Fee", "-cost", "-cost", "0")),
])
_SH1_REPORT = """balance control_number transaction_date accrual_date suppliers account tax_distinction amount
 tax_calculation_distinction tax_total remarks item department memo_tag settlement_date settlement_account settlement_amount"""
QUERIES["rpt_shopify_v1"] = "SELECT " + _select(_SH1_REPORT, {
    **_labels(TEN_OLD, FEE, False), "balance": _side("total", "SOMETHING_WRONG"), "control_number": "cast(control_number as bigint)",
    "transaction_date": "cast(sold as date)", "accrual_date": NUL, "suppliers": "gateway", "amount": "abs(total)",
    "settlement_date": "cast(paid as date)", "settlement_amount": "total",
}) + " FROM {sh_lines_v1} LEFT JOIN {sh_dates} ON control_number=payout_id"

# ---------------------------------------------------------------- card gateway

VIEWS["ss_own"] = """
SELECT name AS order_number, email AS mail, processed_at + interval 9 hours AS sold, processing_method, shipping_shop_amount AS ship,
 discount_amount AS disc, total_tax AS extra, subtotal_price AS part_price, total_price AS whole_price, lineitem_name, lineitem_sku,
 lineitem_quantity AS q, lineitem_price AS p, coalesce(payment_gateway_names='stripe', false) AS own
FROM {orders_master} WHERE payment_gateway_names='stripe' OR name IN (SELECT name FROM {orders_master} WHERE payment_gateway_names='stripe')
"""
_SS_COLS = ["order_number", "mail", "sold", "subtotal", "tax", "total", "pieces", "product", "processing_method", "sku"]
VIEWS["ss_lines"] = _stack("{ss_own}", _SS_COLS, [
    (False, "own", {**_goods("q", "p"), "product": "lineitem_name", "sku": "lineitem_sku"}),
    (True, "own AND ship>0", {**_tenth("Shipping", "ship"), "sku": NUL}),
    (True, "own AND extra>0", {**_once("Tax not included", "extra", "extra", "round(ship/11)"), "sku": NUL}),
    (True, "own AND disc<>0", {**_tenth("Discount", "disc", sign="-"), "sku": NUL}),
    (True, "order_number IS NOT NULL", {**_once("Handling Fee", "-(round(whole_price*0.036)+round(whole_price*0.01))",
                                                 "-(round(part_price*0.036)+round(part_price*0.01))", "0"), "sku": NUL}),
])
VIEWS["ss_lines_due"] = """
SELECT * FROM {ss_lines} WHERE cast(sold as date) < (SELECT max(created_utc) + interval 1 day FROM {stripe_payouts})
"""
VIEWS["ss_matched"] = """
SELECT c.charge_id, c.balance_transaction_id, o.name, c.customer_email, o.email,
 CASE WHEN c.customer_email<>o.email THEN 'WRONG_UNION' END AS verify
FROM (SELECT *, row_number() OVER (ORDER BY created_utc, balance_transaction_id) AS n FROM {stripe_api} WHERE reporting_category='charge') c
LEFT JOIN (SELECT *, row_number() OVER (ORDER BY created_at, name, email) AS n
 FROM (SELECT DISTINCT name, email, created_at FROM {orders_master} WHERE payment_gateway_names='stripe')) o USING (n)
"""
VIEWS["ss_paid"] = """
SELECT p.*, CASE WHEN m.verify IS NOT NULL THEN 'BAD_REPORT' ELSE m.name END AS name
FROM (SELECT DISTINCT * FROM {stripe_payouts}) p LEFT JOIN {ss_matched} m USING (charge_id)
"""
_SS_REPORT = """balance control_number accrual_date settlement_date suppliers account tax_distinction amount
 tax_calculation_distinction tax_total remarks item department memo_tag date_3 settlement_account settlement_amount
 real_amount ORDER_NUMBER MAIL reporting_category product product_count sku SETT_NUMBER real_date"""
_SS_AMT = "CASE WHEN reporting_category='refund' AND product='Handling Fee' THEN 0 WHEN reporting_category='fee' AND product='Handling Fee' THEN abs(fee) WHEN reporting_category='refund' AND product<>'Handling Fee' THEN abs(net) ELSE abs(total) END"
_SS_REAL = "CASE WHEN reporting_category='refund' AND product IN ('Shipping','Handling Fee') THEN 0 WHEN reporting_category='fee' AND product='Handling Fee' THEN fee WHEN reporting_category='refund' AND product NOT IN ('Shipping','Handling Fee') THEN net ELSE total END"
_SS_WHEN = "CASE WHEN reporting_category<>'charge' THEN created_utc ELSE sold END"
_SS_LABELS = _labels(TEN_NEW, FEE, True)
QUERIES["rpt_stripe_full"] = "SELECT " + _select(_SS_REPORT, {
    **_SS_LABELS, "balance": _side(f"({_SS_REAL})", "ERROR"), "control_number": "substr(automatic_payout_id,5,20)",
    "tax_distinction": "CASE reporting_category WHEN 'refund' THEN '課税売上8%（軽）' WHEN 'fee' THEN '対象外' ELSE " + _SS_LABELS["tax_distinction"] + " END",
    "accrual_date": f"cast({_SS_WHEN} as date)", "settlement_date": NUL, "suppliers": "'Shopify Stripe'", "amount": _SS_AMT,
    "date_3": "strftime(automatic_payout_effective_at,'%Y-%m-%d')", "settlement_amount": _SS_AMT, "real_amount": _SS_REAL,
    "ORDER_NUMBER": "order_number", "MAIL": "mail", "product_count": "pieces", "SETT_NUMBER": "automatic_payout_id", "real_date": _SS_WHEN,
}) + f" FROM {{ss_lines_due}} LEFT JOIN {{ss_paid}} ON name=order_number WHERE ({_SS_AMT})<>0"
QUERIES["rpt_stripe"] = _unbooked("rpt_stripe_full", "ledger_stripe", "SETT_NUMBER")
_SS1_REPORT = """balance control_number accrual_date settlement_date suppliers account tax_distinction amount
 tax_calculation_distinction tax_total remarks item department memo_tag date_3 settlement_account settlement_amount
 LAST_UPDATED ORDER_NUMBER MAIL"""
QUERIES["rpt_stripe_v1"] = "SELECT " + _select(_SS1_REPORT, {
    **_labels(TEN_OLD, FEE, True), "balance": _side("total", "ERROR"), "control_number": "substr(automatic_payout_id,5,20)",
    "accrual_date": "strftime(sold,'%Y-%m-%d')", "settlement_date": NUL, "suppliers": "'Shopify Stripe'", "amount": "abs(total)",
    "date_3": "strftime(automatic_payout_effective_at,'%Y-%m-%d')", "settlement_amount": "total",
    "LAST_UPDATED": "(SELECT cast(max(processed_at) as date) FROM {orders_master} WHERE payment_gateway_names='stripe')",
    "ORDER_NUMBER": "order_number", "MAIL": "mail",
}) + """ FROM {ss_lines_due} LEFT JOIN {stripe_payouts} ON customer_email=mail AND sold < created_utc + interval 9 hours
 AND date_diff('second', sold, created_utc + interval 9 hours) <= 7 WHERE total IS NOT NULL"""

# ---------------------------------------------------------------- wallet payments

VIEWS["sa_contained"] = """
SELECT sellerorderid, checkout_id FROM (SELECT DISTINCT sellerorderid FROM {amazon_pay}) JOIN (SELECT DISTINCT checkout_id FROM {orders_master})
 ON sellerorderid LIKE '%' || checkout_id || '%'
"""
VIEWS["sa_pairs"] = """
SELECT o.name AS order_number, o.email AS mail, o.created_at + interval 9 hours AS sold, o.processing_method, o.lineitem_name, o.lineitem_sku,
 o.lineitem_quantity AS q, CASE WHEN a.transactiontype='Refund' THEN -o.lineitem_price ELSE o.lineitem_price END AS p,
 o.shipping_presentment_amount AS ship, o.total_discounts, o.discount_amount, a.settlementid, a.transactiontype, a.transactionpercentagefee AS cost,
 m.latest, CASE WHEN lower(a.transactiontype)='refund' THEN -1 ELSE 1 END AS s
FROM {amazon_pay} a JOIN {sa_contained} t ON t.sellerorderid=a.sellerorderid JOIN {orders_master} o ON o.checkout_id=t.checkout_id
LEFT JOIN (SELECT settlementid, max(transactionposteddate) AS latest FROM {amazon_pay} GROUP BY 1) m ON m.settlementid=a.settlementid
WHERE o.name IS NOT NULL AND a.transactiontype IN ('Capture','Refund')
"""
_SA_COLS = ["order_number", "settlementid", "mail", "sold", "subtotal", "tax", "total", "pieces", "product", "processing_method",
            "transactiontype", "latest", "sku", "unit_price"]
VIEWS["sa_lines"] = _stack("{sa_pairs}", _SA_COLS, [
    (False, "true", {**_goods("q", "p"), "product": "lineitem_name", "sku": "lineitem_sku", "unit_price": "p"}),
    (True, "ship>0", {**_once("Shipping", "s*ship", "s*round(ship-ship/11)", "s*round(ship/11)"), "sku": NUL, "unit_price": "ship"}),
    (True, "total_discounts<>0", {**_once("Discount", "-s*total_discounts", "-s*round(total_discounts-total_discounts/11)",
                                          "-s*round(total_discounts/11)"), "sku": NUL, "unit_price": "total_discounts"}),
    (True, "true", {**_once("Handling Fee", "cost", "cost", "0"), "sku": NUL, "unit_price": "cost"}),
])
_SA_REPORT = """balance control_number accrual_date settlement_date suppliers account tax_distinction amount
 tax_calculation_distinction tax_total remarks item department memo_tag date_3 settlement_account settlement_amount
 real_amount transactiontype product product_count unit_price sku order_number real_date"""
QUERIES["rpt_amazonpay_full"] = "SELECT " + _select(_SA_REPORT, {
    **_labels(TEN_NEW, FEE, True), "balance": _side("total", "SOMETHING_WRONG"), "control_number": "settlementid",
    "accrual_date": "cast(sold as date)", "settlement_date": NUL, "suppliers": "'Shopify Amazon'", "amount": "abs(total)",
    "date_3": "cast(latest as date)", "settlement_amount": "abs(total)", "real_amount": "total", "product_count": "pieces", "real_date": "sold",
}) + " FROM {sa_lines} WHERE total<>0"
QUERIES["rpt_amazonpay"] = _unbooked("rpt_amazonpay_full", "ledger_amazonpay", "control_number")
VIEWS["sa_lines_v1"] = _stack("{sa_pairs}", [c for c in _SA_COLS if c not in ("transactiontype", "sku", "unit_price")], [
    (False, "true", {**_goods("q", "p"), "product": "lineitem_name"}),
    (True, "ship>0", _tenth("Shipping", "ship")),
    (True, "discount_amount<>0", {**_once("Discount", "-s*discount_amount", "-s*round(discount_amount-discount_amount/11)", "-s*round(discount_amount/11)"),
                                  "mail": "mail"}),
    (True, "true", _once("Handling Fee", "cost", "cost", "0")),
])
QUERIES["rpt_amazonpay_v1"] = "SELECT " + _select(_SH1_REPORT.replace("transaction_date accrual_date", "accrual_date settlement_date").replace(
    "settlement_date settlement_account", "date_3 settlement_account"), {
    **_labels(TEN_OLD, FEE, True), "balance": _side("total", "SOMETHING_WRONG"), "control_number": "settlementid",
    "accrual_date": "strftime(sold,'%Y-%m-%d')", "settlement_date": NUL, "suppliers": "'Shopify Amazon'", "amount": "abs(total)",
    "date_3": "cast(latest as date)", "settlement_amount": "total",
}) + " FROM {sa_lines_v1}"
QUERIES["condensed_monthly"] = """
SELECT balance, control_number, cast(date_trunc('month', accrual_date) as date) AS transaction_date, cast(NULL as varchar) AS accrual_date,
 suppliers, account, tax_distinction, sum(amount) AS total, tax_calculation_distinction, sum(tax_total) AS tax_tot, remarks, item,
 department, memo_tag, date_3 AS settlement_date, settlement_account, sum(settlement_amount) AS settlement_total_amount,
 sum(real_amount) AS real_total, order_number
FROM (SELECT * EXCLUDE (settlement_date) FROM {rpt_amazonpay_full}) r GROUP BY ALL
"""

# ---------------------------------------------------------------- marketplace

VIEWS["az_sums"] = """
SELECT cast(round(settlement_id) as bigint) AS sett, posted_date_time + interval 9 hours AS posted, transaction_type, amount_type, amount_description,
 order_id, sku, sum(amount) AS total_amount, sum(quantity_purchased) AS total_purchased
FROM {transaction_view} GROUP BY ALL
"""
VIEWS["az_dated"] = """
SELECT z.*, c.bought, CASE WHEN transaction_type IN ('CouponRedemptionFee','Imaging Services') THEN transaction_type || amount_type
  ELSE transaction_type || amount_type || amount_description END AS rule,
 CASE WHEN transaction_type='Refund' THEN 'POSTED_DATE_REFUND' WHEN amount_type='FBA Inventory Reimbursement' THEN 'POSTED_DATE_REIMBURSEMENT'
  WHEN bought IS NULL THEN 'POSTED_DATE' ELSE 'ORDER_DATE' END AS DATE_TYPE
FROM {az_sums} z LEFT JOIN (SELECT DISTINCT amazon_order_id, purchase_date + interval 9 hours AS bought FROM {order_central}) c ON c.amazon_order_id=z.order_id
"""
VIEWS["az_lines"] = """
SELECT cast(sett as varchar) AS settlement_id, main, coalesce(n.account,'MISSING NOMENCLATURE') AS account, n.tax_distiction, n.remarks, n.item, DATE_TYPE,
 sku, order_id, posted, total_purchased, sum(total_amount) AS total_real
FROM (SELECT *, CASE DATE_TYPE WHEN 'ORDER_DATE' THEN bought ELSE posted END AS main FROM {az_dated}) d
LEFT JOIN {nomenclature} n ON n.concatenated_fields=d.rule WHERE main IS NOT NULL GROUP BY ALL
"""
_AZ_SIDE = "CASE WHEN {0}<0 THEN '支出' WHEN {0}>=0 THEN '収入' END"
QUERIES["rpt_amazon_full"] = f"""
SELECT {_AZ_SIDE.format("total_real")} AS balance, settlement_id, cast(main as date) AS main_date, cast(deposited + interval 9 hours as date) AS deposit_date,
 'Amazon Seller' AS supplier, account, tax_distiction, abs(total_real) AS total_sum, '内税' AS tax_calc_distinction, remarks, item,
 {NUL} AS department, {NUL} AS memo, DATE_TYPE, sku, total_purchased, total_real, order_id, cast(posted as date) AS posted,
 date '2023-01-01' AS DATE_OF_QUERY, deposited AS deposit_full_date, main AS order_full_date
FROM {{az_lines}} LEFT JOIN (SELECT DISTINCT cast(cast(settlement_id as bigint) as varchar) AS dep, deposit_date AS deposited
 FROM {{transaction_view}} WHERE deposit_date IS NOT NULL) ON dep=settlement_id
"""
QUERIES["rpt_amazon"] = _unbooked("rpt_amazon_full", "ledger_amazon", "settlement_id")
QUERIES["rpt_amazon_latest"] = """
SELECT * FROM {rpt_amazon_full} WHERE settlement_id IN (SELECT DISTINCT cast(cast(settlement_id as bigint) as varchar) AS s FROM {transaction_view} ORDER BY s DESC LIMIT 5)
"""
QUERIES["rpt_amazon_sheet"] = f"""
SELECT {_AZ_SIDE.format("t")} AS balance, settlement_id, main_date, deposit_date, supplier, account, tax_distiction, abs(t) AS total, tax_calc_distinction,
 CASE WHEN tax_distiction LIKE '%8%' THEN abs(round(t*0.08)) WHEN tax_distiction LIKE '%10%' THEN abs(round(t*0.1)) ELSE 0 END AS tax,
 remarks, item, {NUL} AS department, {NUL} AS memo
FROM (SELECT settlement_id, remarks, main_date, deposit_date, supplier, account, item, tax_distiction, tax_calc_distinction, sum(total_real) AS t
 FROM {{rpt_amazon_full}} WHERE settlement_id > '11000000010' GROUP BY ALL HAVING sum(total_real)<>0)
"""
QUERIES["sheet_monthly_fold"] = """
SELECT balance, settlement_id, cast(date_trunc('month', main_date) as date) AS month, deposit_date, supplier, account, tax_distiction,
 tax_calc_distinction, remarks, item, department, memo, sum(total) AS total, sum(tax) AS tax, sum(CASE balance WHEN '支出' THEN -total ELSE total END) AS real_value
FROM {rpt_amazon_sheet} GROUP BY ALL
"""

# ---------------------------------------------------------------- second marketplace

_ZIP = "destination_postal_code_1 || '-' || repeat('0', greatest(4-length(mailing_address_postal_code_2),0)) || mailing_address_postal_code_2"
_SKU13 = "CASE WHEN item_number LIKE 'v_%' THEN substr(item_number,3,13) ELSE substr(item_number,1,13) END"
VIEWS["rk_orders"] = f"""
SELECT order_number, order_date_time AS order_date, status, shipping_total AS ship, store_issued_coupon_usage_amount AS coupon, product_name AS title,
 {_SKU13} AS code, unit_price AS price, quantity AS q, {_ZIP} AS zip_code
FROM (SELECT * FROM {{rakuten_orders}} UNION ALL SELECT * FROM {{rakuten_2020}})
"""
_RK_COLS = ["order_number", "order_date", "status", "delivery", "product_name", "item_number", "unit_price", "quantity", "unit_per_price", "zip_code"]
VIEWS["rk_lines"] = _stack("{rk_orders}", _RK_COLS, [
    (False, "true", {"delivery": "ship", "product_name": "title", "item_number": "code", "unit_price": "price", "quantity": "q", "unit_per_price": "price*q"}),
    (True, "ship>0", {"delivery": "ship", "product_name": "'delivery'", "item_number": NUL, "unit_price": "ship", "quantity": "1", "unit_per_price": "ship"}),
    (True, "coupon>0", {"delivery": "cast(NULL as double)", "product_name": "'points'", "item_number": NUL, "unit_price": "-coupon", "quantity": "1", "unit_per_price": "-coupon"}),
])
_RK_TEN = "(product_name='delivery' OR product_name LIKE 'GoCLN（ゴークリーン） シェイカー%')"
_RK_VOID = "CASE WHEN status='900' AND product_name IN ('delivery','points') THEN 0 ELSE {} END"
QUERIES["rpt_rakuten_full"] = f"""
SELECT * FROM (SELECT coalesce({_AZ_SIDE.format("unit_per_price")}, 'Unknown value') AS balance, report_id AS control_number, cast(order_date as date) AS order_date, {NUL} AS payment_date,
 'Rakuten' AS supplier, '売上高' AS account, CASE WHEN {_RK_TEN} THEN '課税売上10%' WHEN product_name IS NOT NULL THEN '課税売上8%（軽）' END AS tax_distinction,
 {_RK_VOID.format("abs(unit_per_price)")} AS amount, '内税' AS tax_calculation_distinction,
 CASE WHEN {_RK_TEN} THEN abs(trunc(unit_per_price*0.1)) WHEN product_name IS NOT NULL THEN abs(trunc(unit_per_price*0.08)) END AS tax_amount,
 CASE product_name WHEN 'delivery' THEN 'Delivery' WHEN 'points' THEN 'Points issued' ELSE 'Product Charges' END || ' (#' || l.order_number || ')' AS remarks,
 CASE WHEN product_name='delivery' THEN 'Delivery' WHEN product_name IS NOT NULL THEN 'Sales' END AS item, l.order_number AS order_id, item_number, quantity,
 order_date AS full_date, zip_code, {_RK_VOID.format("unit_per_price")} AS real_amount, product_name
 FROM {{rk_lines}} l JOIN (SELECT DISTINCT order_number, report_id FROM {{rakuten_payment_main}}) p ON p.order_number=l.order_number WHERE report_id IS NOT NULL)
WHERE amount<>0
"""
QUERIES["rpt_rakuten"] = _unbooked("rpt_rakuten_full", "ledger_rakuten", "control_number")

# ---------------------------------------------------------------- dashboards

VIEWS["areas"] = "SELECT DISTINCT coalesce(merchant_order_id, amazon_order_id) AS eff, ship_postal_code AS zip_code, purchase_date + interval 9 hours AS bought FROM {order_central} WHERE amazon_order_id IS NOT NULL"
_RATE = "CASE WHEN {0} LIKE '%8%' THEN 0.08 WHEN {0} LIKE '%10%' THEN 0.1 ELSE 0 END::double"


def _channels(az_quantity: str, rk_amount: str) -> str:
    shop = " UNION ALL ".join(
        f"SELECT real_date AS transaction_date, real_amount AS amount, product_count AS quantity, sku, item, cast({sett} as varchar) AS settlement_id,"
        f" order_number AS ord, account, {_RATE.format('tax_distinction')} AS tax_multip FROM {{{ledger}}}"
        for sett, ledger in (("control_number", "rpt_amazonpay_full"), ("SETT_NUMBER", "rpt_stripe_full"), ("control_number", "rpt_shopify_full"))
    )
    return f"""
SELECT order_full_date AS transaction_date, total_real AS amount, {az_quantity} AS quantity, sku, 'Amazon' AS SOURCE, zip_code, item, settlement_id, account,
 {_RATE.format("tax_distiction")} AS tax_multip FROM {{rpt_amazon_full}} LEFT JOIN {{areas}} ON eff=order_id
UNION ALL SELECT full_date, {rk_amount}, quantity, item_number, 'Rakuten', zip_code, item, control_number, account, {_RATE.format("tax_distinction")} FROM {{rpt_rakuten_full}}
UNION ALL SELECT transaction_date, amount, quantity, sku, 'Shopify', ship_zip, item, settlement_id, account, tax_multip
 FROM ({shop}) LEFT JOIN (SELECT DISTINCT name, ship_zip FROM {{orders_master}}) ON name=ord
"""


VIEWS["all_channels"] = _channels(
    "CASE WHEN remarks IN ('Product Charges','Product Charges Refund','Product Charges Inventory Reimbursement') THEN total_purchased ELSE 0 END", "real_amount")
VIEWS["all_channels_lite"] = _channels("total_purchased", "amount")
QUERIES["rpt_dashboard"] = """
SELECT transaction_date, amount, sku, SOURCE, zip_code, item, settlement_id, item_name, account,
 CASE WHEN item<>'Sales' THEN 0 WHEN account='売上高' AND sku IS NOT NULL AND item_name IS NOT NULL THEN sign(amount)*quantity ELSE 0 END AS quantity,
 tax_multip, amount AS amount_no_tax, amount-round(amount/(1+tax_multip)) AS amount_tax
FROM {all_channels} LEFT JOIN {combined_sku} ON sku_item=sku AND store_name=SOURCE WHERE amount<>0
UNION ALL SELECT cast(transaction_date as timestamp), NULL, NULL,
 CASE WHEN supplier LIKE 'Shopify%' THEN 'Shopify' WHEN supplier='Rakuten' THEN 'Rakuten' ELSE 'Amazon' END, NULL, item, settlement_id, NULL, account, NULL, NULL,
 -tax_amount, amount FROM {full_imported} WHERE supplier<>'Somebody Else'
"""
QUERIES["rpt_dashboard_lite"] = """
SELECT c.* EXCLUDE (account, tax_multip), item_name FROM {all_channels_lite} c LEFT JOIN {combined_sku} ON sku_item=sku AND store_name=SOURCE
"""


def _feed(wanted: str, code: str, paid: str, store: str) -> str:
    return f"""
SELECT f.*, item_name FROM (
 SELECT coalesce(bought, posted_date_time) AS transaction_date, sum(amount) AS amount, sum(quantity_purchased) AS quantity, sku, zip_code, 'Amazon' AS SOURCE
 FROM {{transaction_view}} LEFT JOIN {{areas}} ON eff=order_id WHERE transaction_type='Order' AND {wanted}
 GROUP BY settlement_id, coalesce(bought, posted_date_time), sku, zip_code
 UNION ALL SELECT order_date_time + interval 9 hours, quantity*unit_price, quantity, {code}, {_ZIP}, 'Rakuten' FROM {{rakuten_orders}} WHERE status IN ('500','600','700')
 UNION ALL SELECT created_at + interval 9 hours, lineitem_price*lineitem_quantity, lineitem_quantity, lineitem_sku, ship_zip, 'Shopify' FROM {{orders_master}} WHERE {paid}
) f LEFT JOIN {{combined_sku}} ON sku_item=f.sku {store}
"""


QUERIES["rpt_sales_feed_v1"] = _feed("amount_description='Principal'", "substr(item_number,1,13)", "true", "")
QUERIES["rpt_sales_feed_v2"] = _feed("amount_type IN ('ItemPrice','ItemFees','Promotion','Points')", _SKU13, "financial_status='paid'", "AND store_name=f.SOURCE")

_M = "CASE WHEN sum({0})<0 THEN '支出' ELSE '収入' END AS balance"
QUERIES["sku_monthly_amazon"] = f"""
SELECT {_M.format("total_real")}, settlement_id, sku, cast(date_trunc('month', main_date) as date) AS month, account, tax_distiction, remarks, item, sum(total_real) AS total_amount,
 cast(sum(CASE WHEN remarks='Product Charges' OR remarks IS NULL THEN total_purchased END) as bigint) AS total_quantity FROM {{rpt_amazon_full}}
GROUP BY settlement_id, sku, 4, account, tax_distiction, remarks, item
"""
QUERIES["sku_monthly_rakuten"] = f"""
SELECT {_M.format("real_amount")}, control_number, item_number, cast(date_trunc('month', order_date) as date) AS month, account, tax_distinction, remarks, item, sum(real_amount) AS total_amount,
 cast(sum(CASE WHEN remarks LIKE 'Product Charges%' OR remarks IS NULL THEN quantity END) as bigint) AS total_quantity FROM {{rpt_rakuten_full}}
GROUP BY control_number, item_number, 4, account, tax_distinction, remarks, item
"""
QUERIES["sku_monthly_shopify"] = f"""
SELECT {_M.format("real_amount")}, control_number, sku, cast(date_trunc('month', transaction_date) as date) AS month, account, tax_distinction, remark AS remarks, item,
 kind AS product, sum(real_amount) AS total_amount, cast(sum(CASE WHEN kind IS NULL AND (remark='Product Charges' OR remarks IS NULL) THEN product_count END) as bigint) AS total_quantity
FROM (SELECT *, CASE WHEN remarks LIKE 'Product Charges%' THEN 'Product Charges' WHEN remarks LIKE 'Delivery%' THEN 'Delivery' WHEN remarks LIKE 'Fee%' THEN 'Fee' END AS remark,
 CASE WHEN product IN ('Shipping','Discount','Chargeback','Handling Fee','partial refund') THEN product END AS kind FROM {{rpt_shopify_full}})
GROUP BY control_number, sku, 4, account, tax_distinction, remark, item, kind
"""
for _channel in ("amazon", "rakuten", "shopify"):
    QUERIES[f"sku_monthly_refresh_{_channel}"] = QUERIES[f"sku_monthly_{_channel}"]
QUERIES["sales_by_sku"] = """
SELECT item_name, sku, sum(quantity) AS q_sales, sum(amount) AS sales FROM {rpt_dashboard}
WHERE SOURCE='Amazon' AND transaction_date >= '1998-01-01' AND transaction_date < '1998-02-01' GROUP BY item_name, sku
"""
QUERIES["yearly_sales_by_source"] = """
SELECT SOURCE, cast(year(transaction_date) as int) AS year, sum(amount) AS total FROM {rpt_dashboard} WHERE item='Sales' GROUP BY 1, 2
"""

# ================================================================ single operators

# ---------------------------------------------------------------- joins

QUERIES["inner_payout_orders"] = """
SELECT p.id AS payout_row, type, amount, name, lineitem_name, lineitem_quantity FROM {shopify_payouts} p, {orders_master} o WHERE o.id=p.source_order_id
"""
QUERIES["left_distinct_dim"] = """
SELECT id, p.payout_id, amount, paid AS paid_at FROM {shopify_payouts} p LEFT JOIN {sh_dates} d USING (payout_id) WHERE source_type<>'payout'
"""
QUERIES["contains_join"] = """
SELECT amazontransactionid, a.sellerorderid, o.checkout_id, name, lineitem_sku, lineitem_quantity
FROM {amazon_pay} a JOIN {sa_contained} t ON t.sellerorderid=a.sellerorderid JOIN {orders_master} o ON o.checkout_id=t.checkout_id
"""
QUERIES["time_window_join"] = """
SELECT name, email, processed_at, balance_transaction_id, created_utc FROM (SELECT DISTINCT name, email, processed_at FROM {orders_master} WHERE payment_gateway_names='stripe')
LEFT JOIN {stripe_payouts} ON customer_email=email AND processed_at<created_utc AND epoch(date_trunc('second',created_utc))-epoch(date_trunc('second',processed_at))<=7
"""
QUERIES["positional_join"] = "SELECT charge_id, name, verify FROM {ss_matched}"
QUERIES["right_distinct_join"] = """
SELECT charge_id, reporting_category, automatic_payout_id, gross FROM (SELECT DISTINCT charge_id, reporting_category, automatic_payout_id FROM {stripe_payouts})
LEFT JOIN (SELECT charge_id, gross FROM {stripe_api} WHERE reporting_category='charge') USING (charge_id)
"""
QUERIES["validated_lookup_join"] = """
SELECT id, payment_gateway_names, lineitem_sku, CASE WHEN payment_gateway_names='stripe' THEN 'ch_' || id END AS reference FROM {orders_master}
"""
QUERIES["semi_gateway"] = """
SELECT name, email, lineitem_name, total_price FROM {orders_master} WHERE name IN (SELECT name FROM {orders_master} WHERE lower(payment_gateway_names) LIKE '%stripe%')
"""
_PAID_ROWS = "SELECT id, cast(payout_id as bigint) AS control_number, amount FROM {shopify_payouts}"
QUERIES["null_aware_anti_ledger"] = f"SELECT * FROM ({_PAID_ROWS}) WHERE control_number NOT IN (SELECT control_number FROM {{ledger_shopify}} WHERE control_number IS NOT NULL)"
QUERIES["null_aware_anti_empty_ledger"] = _PAID_ROWS
QUERIES["fee_preagg"] = """
SELECT sett AS settlement_id, posted AS posted_date_time, transaction_type, amount_type, amount_description, order_id, sku, total_amount, total_purchased,
 CASE WHEN transaction_type='CouponRedemptionFee' THEN transaction_type || amount_type ELSE transaction_type || amount_type || amount_description END AS concat_fields FROM {az_sums}
"""
QUERIES["rule_key_join"] = """
SELECT f.*, remarks, coalesce(account,'MISSING NOMENCLATURE') AS account, item, tax_distiction FROM {fee_preagg} f LEFT JOIN {nomenclature} ON concatenated_fields=concat_fields
"""
QUERIES["sku_store_join"] = """
SELECT name, lineitem_sku AS sku, 'Shopify' AS SOURCE, lineitem_quantity, item_name FROM {orders_master} LEFT JOIN {combined_sku} ON sku_item=lineitem_sku AND store_name='Shopify'
"""
QUERIES["sku_only_join"] = """
SELECT name, lineitem_sku AS sku, 'Shopify' AS SOURCE, lineitem_quantity, item_name FROM {orders_master} LEFT JOIN {combined_sku} ON sku_item=lineitem_sku
"""
QUERIES["cast_key_join"] = """
SELECT sett_text, amount, deposit_date FROM (SELECT cast(cast(settlement_id as bigint) as varchar) AS sett_text, sum(amount) AS amount FROM {transaction_view} GROUP BY 1)
LEFT JOIN (SELECT DISTINCT settlement_id, deposit_date FROM {transaction_view} WHERE deposit_date IS NOT NULL) ON cast(sett_text as double)=settlement_id
"""
QUERIES["scalar_max_per_group"] = "SELECT amazontransactionid, settlementid, max(transactionposteddate) OVER (PARTITION BY settlementid) AS last_updated FROM {amazon_pay}"
QUERIES["scalar_lookup"] = "SELECT id, payout_id, (SELECT paid FROM {sh_dates} d WHERE d.payout_id=p.payout_id) AS paid_at FROM {shopify_payouts} p"
QUERIES["scalar_bound_filter"] = "SELECT name, lineitem_sku, created_at FROM {orders_master} WHERE created_at < (SELECT max(created_utc) FROM {stripe_payouts}) - interval 365 day"

# ---------------------------------------------------------------- expansion and classification

_LINE = "order_number, mail, sold AS date_transaction, subtotal+0 AS subtotal, tax+0 AS tax, total, pieces AS product_count, product"
QUERIES["expand_sh"] = f"SELECT {_LINE}, control_number, sku, source_type FROM {{sh_lines}}"
QUERIES["expand_sh_v1"] = f"SELECT {_LINE}, control_number FROM {{sh_lines_v1}}"
QUERIES["expand_ss"] = f"SELECT {_LINE}, sku FROM {{ss_lines}}"
QUERIES["expand_sa"] = f"SELECT {_LINE}, settlementid AS settlement_id, unit_price FROM {{sa_lines}}"
QUERIES["expand_rk"] = "SELECT * FROM {rk_lines}"
QUERIES["classify_sh"] = "SELECT account, tax_distinction, item, balance, count(*) AS n, sum(amount) AS amount, sum(tax_total) AS tax FROM {rpt_shopify_full} GROUP BY ALL"
QUERIES["classify_ss"] = """
SELECT account, tax_distinction, item, balance, reporting_category, count(*) AS n, sum(amount) AS amount, sum(real_amount) AS real_amount FROM {rpt_stripe_full} GROUP BY ALL
"""
for _name, _ten in (("classify_sa", TEN_NEW), ("classify_sa_old", TEN_OLD)):
    QUERIES[_name] = "SELECT product, total, " + _select("account tax_distinction tax_total remarks item", _labels(_ten, FEE, True)) + (
        " FROM (SELECT lineitem_name AS product, name AS order_number, lineitem_price*lineitem_quantity AS total FROM {orders_master})")
QUERIES["classify_rk"] = f"""
SELECT product_name, unit_per_price, CASE WHEN {_RK_TEN} THEN '課税売上10%' WHEN product_name IS NOT NULL THEN '課税売上8%（軽）' END AS tax_distinction,
 abs(trunc(unit_per_price * CASE WHEN {_RK_TEN} THEN 0.1::double WHEN product_name IS NOT NULL THEN 0.08::double END)) AS tax_amount,
 CASE product_name WHEN 'delivery' THEN 'Delivery' WHEN 'points' THEN 'Points issued' ELSE 'Product Charges' END || ' (#' || order_number || ')' AS remarks,
 CASE WHEN product_name='delivery' THEN 'Delivery' ELSE 'Sales' END AS item FROM {{rk_lines}}
"""
QUERIES["tax_split"] = """
SELECT l_orderkey, l_linenumber, t AS total, round(t/1.08) AS net, t-round(t/1.08) AS tax, round(t-t/11) AS net11, round(t/11) AS tax11
FROM (SELECT l_orderkey, l_linenumber, round(l_extendedprice) AS t FROM {lineitem})
"""
QUERIES["gateway_fee"] = "SELECT o_orderkey, -(round(round(o_totalprice)*0.036)+round(round(o_totalprice)*0.01)) AS fee FROM {orders}"
QUERIES["signed_qty"] = """
SELECT name, lineitem_sku AS sku, item, amount, lineitem_quantity AS q, CASE WHEN item='Sales' AND item_name IS NOT NULL AND amount<>0 THEN sign(amount)*lineitem_quantity ELSE 0 END AS quantity
FROM (SELECT *, CASE financial_status WHEN 'refunded' THEN -lineitem_price ELSE lineitem_price END AS amount, CASE WHEN shipping_shop_amount>0 THEN 'Sales' ELSE 'Delivery' END AS item FROM {orders_master})
LEFT JOIN {combined_sku} ON sku_item=lineitem_sku AND store_name='Shopify'
"""
QUERIES["norm_sku"] = f"SELECT order_number, item_number, {_SKU13} AS sku, substr(item_number,1,13) AS short FROM {{rakuten_all}}"
QUERIES["zip_code"] = f"SELECT order_number, {_ZIP} AS zip_code FROM {{rakuten_all}}"
QUERIES["tax_from_label"] = f"""
SELECT *, total_real-round(total_real/(1+rate)) AS tax FROM (SELECT settlement_id, order_id, tax_distiction, total_real, {_RATE.format("tax_distiction")} AS rate FROM {{rpt_amazon_full}})
"""
QUERIES["business_date"] = """
SELECT sett AS settlement_id, order_id, sku, amount_type, CASE DATE_TYPE WHEN 'ORDER_DATE' THEN bought ELSE posted END AS main_time, DATE_TYPE FROM {az_dated}
"""

# ---------------------------------------------------------------- aggregates and windows

QUERIES["report_agg"] = f"""
SELECT sett AS settlement_id, coalesce(account,'MISSING NOMENCLATURE') AS account, remarks, item, DATE_TYPE, sum(total_amount) AS total_real, abs(sum(total_amount)) AS total_sum,
 {_AZ_SIDE.format("sum(total_amount)")} AS balance FROM {{az_dated}} LEFT JOIN {{nomenclature}} ON concatenated_fields=rule
WHERE CASE DATE_TYPE WHEN 'ORDER_DATE' THEN bought ELSE posted END IS NOT NULL GROUP BY 1, 2, 3, 4, 5
"""
QUERIES["having_nonzero"] = QUERIES["rpt_amazon_sheet"].replace("11000000010", "0")
_DELIVERY = "account='売上高' AND item='Delivery' AND remarks='Shipping'"
QUERIES["running_sum"] = f"""
SELECT item, remarks, account, order_full_date, total_real, sum(total_real) OVER (ORDER BY order_full_date NULLS FIRST) AS running_sum FROM {{rpt_amazon_full}} WHERE {_DELIVERY}
"""
QUERIES["running_sum_shipdate"] = """
SELECT l_orderkey, l_linenumber, l_shipdate, price, sum(price) OVER (ORDER BY l_shipdate) AS running_sum FROM (SELECT *, round(l_extendedprice) AS price FROM {lineitem})
"""
QUERIES["last_seen_by_amount"] = f"SELECT total_real, max(order_full_date) AS first_appearance_date FROM {{rpt_amazon_full}} WHERE {_DELIVERY} GROUP BY 1"
QUERIES["control_total"] = f"SELECT sum(total_real) AS total_to_update FROM {{rpt_amazon_full}} WHERE {_DELIVERY}"
QUERIES["latest_k_settlements"] = """
SELECT sett, order_id, amount FROM (SELECT cast(cast(settlement_id as bigint) as varchar) AS sett, order_id, amount FROM {transaction_view})
QUALIFY dense_rank() OVER (ORDER BY sett DESC) <= 5
"""
QUERIES["scalar_extreme"] = "SELECT max(cast(order_number as bigint)) AS value FROM {orders_master}"
QUERIES["global_row_number"] = "SELECT event_id, user_id, ts, row_number() OVER (ORDER BY user_id, ts, event_id) AS row_number FROM {events}"
QUERIES["order_report"] = "SELECT name, lineitem_sku, lineitem_quantity, total_price FROM {orders_master} ORDER BY total_price DESC NULLS LAST, name NULLS FIRST, lineitem_sku NULLS FIRST"
QUERIES["distinct_rows"] = "SELECT name, ship_zip FROM {orders_master} GROUP BY ALL"
QUERIES["union_channels"] = """
SELECT SOURCE, sku, count(*) AS n FROM (SELECT 'Shopify' AS SOURCE, lineitem_sku AS sku FROM {orders_master} UNION ALL SELECT 'Amazon', sku FROM {transaction_view}) GROUP BY ALL
"""

# ---------------------------------------------------------------- maintenance

QUERIES["replace_by_key"] = """
SELECT id, lineitem_name, CASE WHEN created_at >= '2001-02-01' THEN 'archived' ELSE financial_status END AS financial_status, created_at FROM {orders_master}
"""
QUERIES["trim_recent"] = """
SELECT id, order_number, created_at, lineitem_sku FROM {orders_master} WHERE cast(order_number as bigint) <=
 (SELECT max(cast(order_number as bigint)) FROM {orders_master} WHERE created_at < timestamp '2001-08-01' - interval 1500 day)
"""
QUERIES["trim_from_first_pending"] = """
SELECT id, payout_status, amount FROM {shopify_payouts} WHERE cast(id as bigint) < (SELECT min(cast(id as bigint)) FROM {shopify_payouts} WHERE payout_status IN ('pending','in_transit'))
"""
for _name in ("trim_recent", "trim_from_first_pending"):
    QUERIES[f"{_name}_stored"] = QUERIES[_name]
QUERIES["new_files_only"] = """
SELECT l_orderkey, l_linenumber, 'TV_' || strftime(l_shipdate,'%Y_%m') || '.txt' AS FILE_NAME FROM {lineitem} WHERE l_shipdate >= '1999-01-01'
"""
QUERIES["high_water_mark"] = "SELECT DISTINCT name AS cursor FROM {orders_master} WHERE cast(order_number as bigint) = (SELECT max(cast(order_number as bigint)) FROM {orders_master})"
QUERIES["incremental_window"] = """
SELECT balance_transaction_id, created_utc, gross FROM {stripe_payouts} WHERE created_utc > '1999-06-30 23:59:59' AND created_utc <= '1999-12-29 23:59:59'
"""
QUERIES["adjust_rows"] = f"""
SELECT settlement_id, order_id, sku, item, CASE WHEN {_DELIVERY} THEN cast(main_date - interval 1 month as date) ELSE main_date END AS main_date,
 CASE WHEN {_DELIVERY} THEN order_full_date - interval 1 month ELSE order_full_date END AS order_full_date,
 CASE WHEN {_DELIVERY} THEN 'ONE MONTH SUBSTRACTED' ELSE tax_calc_distinction END AS tax_calc_distinction, total_real FROM {{rpt_amazon_full}}
"""
QUERIES["null_tokens"] = """
SELECT line_id, CASE WHEN flag_text IN ('NaN','null','',' ','<NA>') THEN NULL ELSE flag_text END AS flag_text,
 CASE WHEN flag_text IN ('NaN','null','','<NA>','None') THEN NULL ELSE flag_text END AS order_text,
 CASE WHEN flag_text IN ('NaN','null','','None') THEN NULL ELSE flag_text END AS payout_text FROM {raw_text}
"""
QUERIES["parse_ts_fallback"] = """
SELECT line_id, date_text, l_shipdate + CASE WHEN date_text LIKE '%UTC' THEN interval 37230 seconds WHEN date_text LIKE '%T%' THEN interval 4830 seconds ELSE interval 0 seconds END AS parsed FROM {raw_text}
"""
QUERIES["clean_number"] = "SELECT line_id, price_text, try_cast(replace(price_text, ',', '') as double) AS price FROM {raw_text}"
QUERIES["canonical_id"] = """
SELECT line_id, id_text, CASE WHEN id_text LIKE 'x%' THEN NULL ELSE split_part(id_text, '.', 1) END AS canonical, split_part(id_text, '.', 1) AS stripped,
 replace(id_text, '.0', '') AS stripped_anywhere FROM {raw_text}
"""
QUERIES["conform_schema"] = f"""
SELECT line_id, try_cast(id_text as double) AS id_text, try_cast(price_text as double) AS price_text, 'DEPRECATED' AS token, {NUL} AS note FROM {{raw_text}}
"""
QUERIES["quarantine_good"] = """
SELECT line_id, cast(id_text as bigint) AS id_text, cast(replace(price_text, ',', '') as double) AS price_text FROM {raw_text}
WHERE price_text<>'n/a' AND id_text NOT LIKE 'x%' AND id_text NOT LIKE '%.0'
"""
QUERIES["quarantine_bad"] = """
SELECT line_id, id_text, replace(price_text, ',', '') AS price_text FROM {raw_text} WHERE price_text='n/a' OR id_text LIKE 'x%' OR id_text LIKE '%.0'
"""
QUERIES["epoch_to_ts"] = "SELECT event_id, date_trunc('second', ts) AS created FROM {events}"

# ---------------------------------------------------------------- nested documents, from the same formulas without nesting

VIEWS["keys"] = "SELECT o_orderkey AS k, o_custkey, o_orderdate FROM {orders}"
_ITEM = "'Item ' || l_partkey"
_ITEM_SKU = "CASE WHEN l_partkey%17<>0 THEN 'SKU' || l_partkey END"
QUERIES["explode_lines"] = f"""
SELECT k AS id, '#' || k AS name, l_quantity AS lineitem_quantity, {_ITEM} AS lineitem_name, round(l_extendedprice/l_quantity) AS lineitem_price, {_ITEM_SKU} AS lineitem_sku,
 CASE WHEN l_discount>0 THEN round(l_extendedprice*l_discount) ELSE 0 END + CASE WHEN l_discount>0.05 THEN l_linenumber ELSE 0 END AS lineitem_discount
FROM {{keys}} LEFT JOIN {{lineitem}} ON l_orderkey=k
"""
QUERIES["first_discount"] = """
SELECT k AS id, CASE k%4 WHEN 0 THEN 'shopify_payments' WHEN 1 THEN 'stripe, gift_card' WHEN 2 THEN 'Komoju - card' END AS payment_gateway_names,
 CASE WHEN k%5<>0 THEN 'name: gift, value: Its ' || k END AS note_attributes, CASE WHEN k%3>0 THEN 'C' || (k%10) END AS discount_code,
 CASE WHEN k%3>0 THEN (k%500)::double END AS discount_amount, CASE WHEN k%3>0 THEN 'fixed_amount' END AS discount_type FROM {keys}
"""
VIEWS["refund_rows"] = "SELECT * FROM {keys} JOIN {lineitem} ON l_orderkey=k WHERE l_returnflag='R'"
QUERIES["refund_total"] = """
SELECT k AS id, coalesce(s, 0) AS refund FROM {keys} LEFT JOIN (SELECT k, sum(round(l_extendedprice)) AS s FROM {refund_rows} GROUP BY k) USING (k)
"""
QUERIES["refund_lines"] = f"""
SELECT k*100+l_linenumber AS id, k*10+l_linenumber AS line_item_id, CASE WHEN l_suppkey%4<>0 THEN cast(l_suppkey%7 as varchar) END AS location_id, l_quantity AS quantity,
 'return' AS restock_type, round(l_extendedprice) AS subtotal, round(l_extendedprice*l_tax) AS total_tax, '#' || k AS name, strftime(o_orderdate,'%Y-%m-%d') || 'T10:00:00Z' AS order_date,
 CASE WHEN k%20=0 THEN strftime(o_orderdate,'%Y-%m-%d') || 'T12:00:00Z' END AS cancel_date, CASE WHEN k%3=0 THEN 'paid' ELSE 'refunded' END AS financial_status,
 CASE WHEN k%9=0 THEN 0 ELSE (k%3)*300 END::double AS shipping_amount, CASE WHEN l_partkey%11<>0 AND l_linestatus='F' THEN 'fulfilled' END AS fulfillment_status,
 CASE WHEN l_partkey%11<>0 THEN {_ITEM} END AS product_name, CASE WHEN l_partkey%11<>0 THEN {_ITEM_SKU} END AS sku,
 CASE WHEN l_partkey%11<>0 THEN round(l_extendedprice/l_quantity) END AS line_price, CASE WHEN l_partkey%11<>0 THEN round(l_extendedprice*l_discount) END AS line_discount FROM {{refund_rows}}
"""
QUERIES["flatten_prefix"] = """
SELECT k AS id, CASE WHEN k%9<>0 THEN cast((k%3)*300 as varchar) END AS shipping_shop_amount, CASE WHEN k%9<>0 THEN cast((k%3)*2 as varchar) END AS shipping_presentment_amount,
 'City ' || (o_custkey%20) AS ship_city, cast(o_custkey%1000 as varchar) AS ship_zip, CASE WHEN o_custkey%13<>0 THEN 'JP' END AS ship_country FROM {keys}
"""
QUERIES["find_tokens_json"] = """
SELECT event_id, CASE WHEN a=b THEN a ELSE least(a,b) || ',' || greatest(a,b) END AS tokens FROM (SELECT event_id, 'ch_' || (event_id%7) AS a, 'ch_' || user_id AS b FROM {events})
"""
VIEWS["good_moves"] = "SELECT k, j FROM {keys}, (SELECT unnest([0,1,2]) AS j) WHERE j < k%4 AND (k+j)%3<>0"
QUERIES["charge_refs"] = """
SELECT cast(k as varchar) AS order_id, 'pay_' || k || '_' || j AS charge_ref FROM {good_moves} WHERE k%5<2
UNION ALL SELECT cast(k as varchar), string_agg(t, '-' ORDER BY t) FROM (
 SELECT k, 'ch_' || k AS t FROM {good_moves} WHERE k%5>=2 UNION SELECT k, 'ch_' || (k%5+j) FROM {good_moves} WHERE k%5>=2) GROUP BY k
"""
QUERIES["order_ids"] = "SELECT DISTINCT id FROM {orders_master}"

# ---------------------------------------------------------------- feeds, ingestion, streaming

_LOADED = "timestamp '2023-01-01 00:00:00'"
QUERIES["feed_settlement_txt"] = f"""
SELECT transactionposteddate, settlementid, amazontransactionid, {NUL} AS sellerreferenceid, transactiontype, {NUL} AS amazonorderreferenceid, sellerorderid,
 {NUL} AS storename, 'JPY' AS currencycode, {NUL} AS transactiondescription, transactionamount, transactionpercentagefee+0 AS transactionpercentagefee, 0::double AS transactionfixedfee,
 transactionpercentagefee+0 AS totaltransactionfee, nettransactionamount, timestamp '2002-01-31 00:00:00' AS settlement_end_date FROM {{amazon_pay}}
"""
QUERIES["feed_preamble_tsv"] = f"""
SELECT settlement_id, deposit_date, transaction_type, order_id, amount_type, amount_description, amount, posted_date_time, sku, quantity_purchased, {NUL} AS promotion_id FROM {{transaction_view}}
"""
QUERIES["feed_payment_main"] = f"""
SELECT timestamp '2002-01-05' AS order_confirmation_date, order_number, 'P' || order_number AS payment_number, 'L1' AS payment_institution_link_number, {NUL} AS onquiry_number,
 timestamp '2002-01-06' AS payment_confirmation_date, (cast(order_number as bigint)%100000)::double AS rakuten_pay_money, 'card' AS payment_method, {NUL} AS summary,
 substr(report_id, 2) AS report_id FROM {{rakuten_payment_main}}
"""
QUERIES["feed_payment_coupon"] = """
SELECT DISTINCT order_number, date_trunc('day', order_date_time)::timestamp AS order_confirmation_date, '値引, クーポン' AS coupon_name, store_issued_coupon_usage_amount AS coupon_amount,
 timestamp '2002-01-07' AS coupon_confirmation_date, '77' AS report_id FROM {rakuten_all} WHERE store_issued_coupon_usage_amount>0
"""
QUERIES["feed_rakuten_orders"] = f"""
SELECT order_number, order_date_time, status, product_name, item_number, unit_price, quantity, shipping_total, {NUL} AS delivery_location FROM {{rakuten_all}}
"""
QUERIES["feed_order_list"] = f"""
SELECT amazon_order_id, merchant_order_id, purchase_date, '①番 サプリ' AS product_name, sku, cast(quantity as bigint) AS quantity, {NUL} AS promotion_ids FROM {{order_central}}
"""
QUERIES["feed_stripe_payouts"] = "SELECT * FROM {stripe_payouts}"
QUERIES["ingest_orders"] = f"""
SELECT cast(id as varchar) AS id, cast(id as varchar) AS checkout_id, o_orderdate + interval 10 hours AS created_at, CASE WHEN id%20=0 THEN o_orderdate + interval 12 hours END AS cancelled_at,
 CASE WHEN id%3=0 THEN 'paid' ELSE 'refunded' END AS financial_status, refund, payment_gateway_names,
 CASE WHEN id%4 IN (1,2) AND gateway_ok THEN charge_ref END AS reference, 'DEPRECATED' AS cart_token,
 cast(shipping_shop_amount as double) AS shipping_shop_amount, cast(shipping_presentment_amount as double) AS shipping_presentment_amount, ship_zip,
 lineitem_quantity, lineitem_name, lineitem_price, lineitem_sku, lineitem_discount, discount_code, discount_amount, round(o_totalprice) AS total_price, {_LOADED} AS UPDATED_FROM_API
FROM {{explode_lines}} JOIN {{first_discount}} USING (id) JOIN {{refund_total}} USING (id) JOIN {{flatten_prefix}} USING (id) JOIN {{orders}} ON o_orderkey=id
LEFT JOIN (SELECT order_id, min(charge_ref) AS charge_ref FROM {{charge_refs}} GROUP BY 1) ON order_id=cast(id as varchar)
LEFT JOIN (SELECT cast(order_id as bigint)%4 AS g, max(n)=1 AS gateway_ok FROM (SELECT order_id, count(*) AS n FROM {{charge_refs}} GROUP BY 1) GROUP BY 1) ON g=id%4
"""
QUERIES["ingest_refund_lines"] = """
SELECT id, line_item_id, quantity, subtotal, name, cast(replace(order_date,'Z','') as timestamp) AS order_date, cast(replace(cancel_date,'Z','') as timestamp) AS cancel_date,
 shipping_amount, product_name FROM {refund_lines} WHERE financial_status='refunded'
"""
VIEWS["settled_payouts"] = "SELECT * FROM {shopify_payouts} WHERE cast(id as bigint) < (SELECT min(cast(id as bigint)) FROM {shopify_payouts} WHERE payout_status IN ('pending','in_transit'))"
QUERIES["ingest_payouts"] = f"""
SELECT p.id, type, source_order_id, payout_id, payout_status, amount, fee, net, processed_at, CASE WHEN s.id IS NULL THEN {_LOADED} END AS UPDATED_FROM_API
FROM {{shopify_payouts}} p LEFT JOIN (SELECT id FROM {{settled_payouts}}) s ON s.id=p.id
"""
QUERIES["stream_load_files"] = "SELECT balance_transaction_id, created_utc, gross FROM {stripe_payouts}"
QUERIES["stream_replace_by_key"] = """
SELECT id, lineitem_sku, CASE WHEN created_at >= '2001-02-01' THEN 'archived' ELSE financial_status END AS financial_status, created_at FROM {orders_master}
"""
QUERIES["stream_distinct_records"] = "SELECT DISTINCT balance_transaction_id, created_utc, gross FROM {stripe_payouts}"
QUERIES["stream_book_once"] = "SELECT control_number, order_id, item, amount FROM {rpt_rakuten_full}"
QUERIES["stream_daily_totals"] = """
SELECT cast(created_at as date) AS day, payment_gateway_names, sum(lineitem_price*lineitem_quantity) AS total FROM {orders_master}
GROUP BY 1, 2
"""

_PAYOUTS = "SELECT balance_transaction_id, created_utc, gross FROM {stripe_payouts}"
for _name in ("append_table", "load_batch", "snapshot_csv"):
    QUERIES[_name] = _PAYOUTS
QUERIES["align_to"] = f"SELECT gross, {NUL} AS note, balance_transaction_id FROM {{stripe_payouts}}"
QUERIES["stamp"] = """
SELECT balance_transaction_id, created_utc, gross, 'PAY_1.csv' AS FILE_NAME, cast('2023-01-01 00:00:00' as timestamp) AS UPLOADED_DATETIME FROM {stripe_payouts}
"""
QUERIES["incremental_windows"] = """
SELECT balance_transaction_id, created_utc, gross, lag FROM {stripe_payouts},
 (VALUES ('payouts', '1999-12-30 23:59:59'), ('balance', '1999-12-29 23:59:59'), ('webhook', '1999-12-30 18:59:59'), ('legacy', '1999-12-31 00:00:00')) AS ends(lag, until)
WHERE created_utc > '1999-06-30 23:59:59' AND created_utc <= cast(until as timestamp)
"""
QUERIES["time_cursors"] = """
SELECT 'balance' AS request, max(created_utc) AS cursor FROM {stripe_payouts}
UNION ALL SELECT 'payout', max(automatic_payout_effective_at) FROM {stripe_payouts}
UNION ALL SELECT 'report', max(created_utc) + interval 1 second FROM {stripe_api}
UNION ALL SELECT 'nothing yet', cast('1990-01-01 00:00:00' as timestamp)
"""
_OF_A_MONTH = f"({_DELIVERY} AND (date_trunc('month', order_full_date) = '1998-03-01' OR settlement_id = (SELECT max(settlement_id) FROM {{rpt_amazon_full}})))"
QUERIES["delivery_lines_of_a_month"] = f"""
SELECT settlement_id, order_id, sku, item, CASE WHEN {_OF_A_MONTH} THEN cast(main_date - interval 1 month as date) ELSE main_date END AS main_date,
 CASE WHEN {_OF_A_MONTH} THEN order_full_date - interval 1 month ELSE order_full_date END AS order_full_date,
 CASE WHEN {_OF_A_MONTH} THEN 'ONE MONTH SUBSTRACTED' ELSE tax_calc_distinction END AS tax_calc_distinction, total_real FROM {{rpt_amazon_full}}
"""
QUERIES["feed_stripe_balance"] = "SELECT balance_transaction_id, created_utc, gross, fee, net, reporting_category FROM {stripe_payouts}"
QUERIES["feed_quarantine"] = "SELECT balance_transaction_id, CASE WHEN balance_transaction_id LIKE '%7' THEN 'bad' ELSE 'good' END AS outcome FROM {stripe_payouts}"
QUERIES["feed_rakuten_bulk"] = """
SELECT order_number, order_date_time, item_number, unit_price, quantity FROM {rakuten_orders}
UNION ALL SELECT order_number, order_date_time, item_number, unit_price, quantity FROM {rakuten_2020}
"""
QUERIES["feed_nomenclature"] = "SELECT concatenated_fields, remarks, account, item, tax_distiction FROM {nomenclature}"
QUERIES["feed_report_sheet"] = """
SELECT balance, cast(control_number as varchar) AS settlement_id, account, item, amount AS total_sum, real_amount AS "TOTAL" FROM {rpt_shopify_full}
"""
QUERIES["feed_mixed_headers"] = f"""
SELECT amazon_order_id, sku, cast(quantity as bigint) AS quantity, CASE WHEN purchase_date >= '1998-01-01' THEN ship_postal_code END AS ship_postal_code FROM {{order_central}}
"""
QUERIES["feed_quoted_breaks"] = """
SELECT amazon_order_id, 'two' || chr(10) || 'lines "' || sku || '"' AS product_name, sku, cast(quantity as bigint) AS quantity FROM {order_central}
"""
QUERIES["feed_regional_orders"] = "SELECT amazon_order_id, '①番' AS product_name, sku, cast(quantity as bigint) AS quantity FROM {order_central}"
QUERIES["feed_routes"] = """
SELECT 'BAL' AS kind, balance_transaction_id, net FROM {stripe_payouts} UNION ALL SELECT 'PAY', balance_transaction_id, net FROM {stripe_payouts}
"""
