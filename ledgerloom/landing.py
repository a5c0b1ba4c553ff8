"""Write canonical tables out as feed files, the way the outside systems deliver them.

Used to drive the file readers with data that grows with the given tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.catalog import Catalog
from ledgerloom.storage import checkpoint_dir
from ledgerloom.schemas import STRIPE_PAYOUTS
from ledgerloom.sources.files import allow_encoding
from ledgerloom.sources.heads import JAPANESE
from ledgerloom.sources.rakuten_headers import ORDER_HEADERS


def new_folder(c: Catalog, name: str) -> str:
    """A fresh folder in the session's shared folder."""
    return f"{checkpoint_dir(c.spark)}/feeds/{name}-{uuid.uuid4().hex}"


def write_reports(lines: DataFrame, folder: str, compression: str = "none") -> str:
    """One text file per report number, lines in order of (section, line).

    Input: ``report``, ``section``, ``line``.  Rows of a section have no order of their own.  A compressed file is
    read by one task, so ``compression`` is for reports that don't grow with the tables.
    """
    (
        lines.repartition("report")
        .sortWithinPartitions("report", "section", "line")
        .select("report", "line")
        .write.option("compression", compression).partitionBy("report").text(folder)
    )
    return f"{folder}/*/"


def quoted(*cells: Column) -> Column:
    """CSV line with every cell quoted; NULL becomes an empty cell."""
    return F.concat(
        F.lit('"'), F.concat_ws('","', *[F.coalesce(c.cast("string"), F.lit("")) for c in cells]), F.lit('"')
    )


def _fixed(reports: DataFrame, section: int, line: Column) -> DataFrame:
    return reports.select("report", F.lit(section).alias("section"), line.alias("line"))


def all_rakuten(c: Catalog) -> DataFrame:
    """Order lines of both tables, the older and the newer one."""
    return c.rakuten_2020.unionByName(c.rakuten_orders)


def settlement_txt(c: Catalog) -> str:
    """Wallet settlement reports: preamble with the end date, quoted cells, thousands separators."""
    header = ["TransactionPostedDate", "SettlementId", "AmazonTransactionId", "SellerReferenceId", "TransactionType",
              "AmazonOrderReferenceId", "SellerOrderId", "StoreName", "CurrencyCode", "TransactionDescription",
              "TransactionAmount", "TransactionPercentageFee", "TransactionFixedFee", "TotalTransactionFee",
              "NetTransactionAmount"]
    report = F.floor(F.col("settlementid").cast("bigint") / 25)
    none = F.lit(None)

    def money(name: str) -> Column:
        return F.format_number(F.col(name) + F.lit(0.0), 2)

    rows = c.amazon_pay.select(
        report.alias("report"),
        F.lit(3).alias("section"),
        quoted(
            F.date_format("transactionposteddate", "yyyy-MM-dd HH:mm:ss"), F.col("settlementid"),
            F.col("amazontransactionid"), none, F.col("transactiontype"), none, F.col("sellerorderid"), none,
            F.lit("JPY"), none, money("transactionamount"), money("transactionpercentagefee"), F.lit("0"),
            money("transactionpercentagefee"), money("nettransactionamount"),
        ).alias("line"),
    )
    reports = rows.select("report").distinct()
    lines = _fixed(reports, 0, F.lit("Settlement report")).unionByName(
        _fixed(reports, 1, F.lit('SettlementEndDate,"2002-01-31 00:00:00"'))
    ).unionByName(_fixed(reports, 2, F.lit(",".join(f'"{h}"' for h in header)))).unionByName(rows)
    return write_reports(lines, new_folder(c, "settlement"))


def preamble_tsv(c: Catalog) -> str:
    """Regional transaction views: 6 or 7 preamble lines; every other report has no promotion column."""
    report = F.floor(F.col("settlement_id") / 20).cast("bigint")
    names = ["settlement-id", "deposit-date", "transaction-type", "order-id", "amount-type", "amount-description",
             "amount", "posted-date-time", "sku", "quantity-purchased"]

    def moment(name: str) -> Column:
        return F.concat(F.date_format(name, "dd.MM.yyyy HH:mm:ss"), F.lit(" UTC"))

    cells = [F.col("settlement_id").cast("bigint"), moment("deposit_date"), F.col("transaction_type"), F.col("order_id"),
             F.col("amount_type"), F.col("amount_description"), F.col("amount"), moment("posted_date_time"),
             F.col("sku"), F.col("quantity_purchased")]
    odd = F.pmod("report", F.lit(2)) == 1
    rows = c.transaction_view.select(
        report.alias("report"),
        F.lit(9).alias("section"),
        F.concat_ws("\t", *[F.coalesce(x.cast("string"), F.lit("NaN")) for x in cells]).alias("line"),
    ).withColumn("line", F.when(odd, F.concat("line", F.lit("\t"))).otherwise(F.col("line")))
    reports = rows.select("report").distinct()
    header = F.when(odd, F.lit("\t".join(names + ["promotion-id"]))).otherwise(F.lit("\t".join(names)))
    lines = _fixed(reports, 8, header)
    for number in range(6):
        lines = lines.unionByName(_fixed(reports, number, F.lit(f"note {number}")))
    lines = lines.unionByName(_fixed(reports.where(odd), 6, F.lit("note 6"))).unionByName(rows)
    return write_reports(lines, new_folder(c, "preamble"), "gzip")  # 20 settlements a report


def payment_sections(c: Catalog) -> str:
    """Marketplace payment reports: three lines, main section, total, coupon section, total."""
    report = F.floor(F.col("order_number").cast("bigint") / 5000)
    paid = c.rakuten_payment_main.select(
        report.alias("report"), F.lit(4).alias("section"),
        quoted(
            F.lit("1"), F.lit("2002/01/05"), F.col("order_number"), F.concat(F.lit("P"), "order_number"), F.lit("L1"),
            F.lit(None), F.lit("2002/01/06"), F.format_number(F.col("order_number").cast("bigint") % 100000, 0),
            F.lit("card"), F.lit(None), F.concat(F.substring("report_id", 2, 20), F.lit(".0")),
        ).alias("line"),
    )
    coupons = (
        all_rakuten(c).where("store_issued_coupon_usage_amount > 0")
        .select("order_number", "order_date_time", "store_issued_coupon_usage_amount").distinct()
        .select(
            report.alias("report"), F.lit(7).alias("section"),
            quoted(
                F.lit("1"), F.col("order_number"), F.date_format("order_date_time", "yyyy/MM/dd"), F.lit("値引, クーポン"),
                F.col("store_issued_coupon_usage_amount"), F.lit("2002/01/07"), F.lit(None), F.lit(None), F.lit(None),
                F.lit(None), F.lit("77.0"),
            ).alias("line"),
        )
    )
    reports = paid.select("report").unionByName(coupons.select("report")).distinct()
    main_header = "連番,注文確認日,受注番号,決済番号,決済機関連携番号,お問合せ番号,決済確定日,楽天ペイ入金額,決済方法,摘要,"
    coupon_header = "連番,受注番号,課税資産譲渡日,クーポン名,クーポン利用額,クーポン支払額確定日,,,,,"
    lines = paid.unionByName(coupons)
    for section, text in ((0, "report"), (1, "period"), (2, ""), (3, main_header), (5, "合計,,,,,,,1,,,"),
                          (6, coupon_header), (8, "合計,,,,1,,,,,,")):
        lines = lines.unionByName(_fixed(reports, section, F.lit(text)))
    return write_reports(lines, new_folder(c, "payments"))


def rakuten_csv(c: Catalog) -> str:
    """Order export with all headers in the Japanese character set."""
    lines = all_rakuten(c)
    known = {n: F.col(n) for n in lines.columns}
    known["order_date_time"] = F.date_format("order_date_time", "yyyy-MM-dd HH:mm:ss")
    rows = lines.select(
        *[known.get(en, F.lit(None)).cast("string").alias(jp) for jp, en in ORDER_HEADERS.items()]
    )
    folder = new_folder(c, "rakuten")
    allow_encoding(c.spark, JAPANESE)
    rows.write.option("header", True).option("encoding", JAPANESE).csv(folder)
    return folder


def order_list_tsv(c: Catalog) -> str:
    """Order list of the marketplace in the Japanese character set, times with an offset."""
    rows = c.order_central.select(
        F.col("amazon_order_id").alias("amazon-order-id"),
        F.coalesce("merchant_order_id", F.lit("NaN")).alias("merchant-order-id"),
        F.concat(F.date_format("purchase_date", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00")).alias("purchase-date"),
        F.lit("①番 サプリ").alias("product-name"),
        F.col("ship_postal_code").alias("ship-postal-code"),
        F.col("sku").alias("sku"),
        F.col("quantity").alias("quantity"),
    )
    folder = new_folder(c, "orderlist")
    allow_encoding(c.spark, JAPANESE)
    rows.write.option("header", True).option("sep", "\t").option("encoding", JAPANESE).csv(folder)
    return folder


def payout_csv(c: Catalog) -> str:
    """Card gateway payouts with their 26 columns."""
    table = c.stripe_payouts
    rows = table.select(
        *[
            (F.date_format(f.name, "yyyy-MM-dd HH:mm:ss") if f.name in table.columns and f.dataType.simpleString() == "timestamp_ntz"
             else F.col(f.name) if f.name in table.columns else F.lit(None)).cast("string").alias(f.name)
            for f in STRIPE_PAYOUTS.fields
        ]
    )
    folder = new_folder(c, "payouts")
    rows.write.option("header", True).csv(folder)
    return folder


def order_pages(c: Catalog, documents: DataFrame, per_page: int = 250) -> str:
    """API pages of at most ``per_page`` order documents under one key, compressed as an API sends them.

    Plain, they take ten times as much disk as the orders and lines that they are made of.
    """
    pages = documents.groupBy(F.floor(F.col("id") / per_page).alias("page")).agg(
        F.collect_list(F.struct(*documents.columns)).alias("orders")
    )
    folder = new_folder(c, "pages")
    pages.select("orders").write.option("compression", "gzip").json(folder)
    return folder
