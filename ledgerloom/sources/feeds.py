"""One reader per feed, built from the generic readers and the declared schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom import schemas
from ledgerloom.functions.text import (
    MARKETPLACE_NULLS, RAKUTEN_NULLS, clean_number, normalize_headers, null_token, strip_dot_zero,
)
from ledgerloom.operators.maintenance import conform
from ledgerloom.sources.files import (
    greatest, numbered_lines, per_file, read_delimited, read_delimited_apart, read_headed_text, read_preamble,
    section_marks, sections, split_cells, typed,
)
from ledgerloom.sources.heads import JAPANESE
from ledgerloom.sources.rakuten_headers import BULK_COLUMN_COUNT, NUMBER_COLUMNS, ORDER_HEADERS, TIME_COLUMNS

MARKETPLACE_SCHEMAS = {"tv": schemas.TRANSACTION_VIEW, "oc": schemas.ORDER_CENTRAL}


def classify_marketplace(columns: Sequence[str]) -> str:
    """Kind of a marketplace report by its header: transaction view or order list."""
    names = {c.lower().strip().replace("-", "_") for c in columns}
    if "settlement_id" in names:
        return "tv"
    if "amazon_order_id" in names:
        return "oc"
    raise ValueError("neither a transaction view nor an order report")


def _coerce(df: DataFrame, target: T.StructType, nulls: Sequence[str], formats: Sequence[str]) -> DataFrame:
    """Declared columns from text: null spellings, then typed reading; missing ones are NULL."""
    def column(field: T.StructField) -> Column:
        raw = F.col(f"`{field.name}`") if field.name in df.columns else F.lit(None).cast("string")
        return typed(null_token(raw, nulls, fold_case=True), field.dataType, formats).alias(field.name)

    return df.select(*[column(f) for f in target.fields], "FILE_NAME")


def read_marketplace_tsv(
    spark: SparkSession, path: str | Sequence[str], kind: str | None = None, encoding: str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Marketplace report: transaction view or order list.

    Unless ``encoding`` says otherwise, each file is read in UTF-8 or the Japanese encoding, whichever fits it;
    plain files as UTF-8 for the transaction view and as Japanese for the order list.
    """
    kind = kind or classify_marketplace(read_headed_text(spark, path, "\t", encoding or (JAPANESE, "UTF-8")).columns)
    encoding = encoding or {"tv": ("UTF-8", JAPANESE), "oc": (JAPANESE, "UTF-8")}[kind]
    raw = normalize_headers(read_headed_text(spark, path, "\t", encoding, multi_line=multi_line).withColumnRenamed("FILE_NAME", "_f"))
    return _coerce(
        raw.withColumnRenamed("_f", "FILE_NAME"),
        MARKETPLACE_SCHEMAS[kind],
        MARKETPLACE_NULLS,
        schemas.MARKETPLACE_TIME_FORMATS[kind] + ("yyyy-MM-dd",),
    )


def report_kind(file_name: str) -> str:
    """Kind of a regional report by its file name; other names are rejected."""
    for kind in ("tv", "oc"):
        if kind in file_name.lower():
            return kind
    raise ValueError(f"not a known report: {file_name}")


def read_preamble_tsv(
    spark: SparkSession, path: str | Sequence[str], header_key: str | None = None, kind: str = "tv"
) -> DataFrame:
    """Regional report with a preamble, if any: transaction view, or order list with ``kind="oc"``; columns may be missing."""
    return read_preamble(
        spark, path, MARKETPLACE_SCHEMAS[kind], header_key or {"tv": "settlement-id", "oc": "amazon-order-id"}[kind], "\t",
        MARKETPLACE_NULLS, schemas.MARKETPLACE_TIME_FORMATS[kind] + ("yyyy-MM-dd",) * (kind == "oc"),
    )


def read_settlement_txt(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Payment settlement text: end date in the preamble, quoted cells, thousands separators."""
    end_line = F.when(F.contains("line", F.lit("SettlementEndDate")), F.col("line"))
    end_date = F.replace(F.split_part("settlement_end_date", F.lit(","), F.lit(2)), F.lit('"'), F.lit(""))
    text = schemas.as_text(T.StructType(schemas.AMAZON_PAY.fields[:-1]))
    rows = read_preamble(
        spark, path, text, "TransactionPostedDate", ",", ("",), (), {"settlement_end_date": greatest(end_line)}
    ).withColumn("settlement_end_date", end_date)

    def column(field: T.StructField) -> Column:
        raw = F.col(field.name)
        if isinstance(field.dataType, T.DoubleType):
            return clean_number(raw, (",",)).alias(field.name)
        return typed(raw, field.dataType).alias(field.name)

    return rows.select(*[column(f) for f in schemas.AMAZON_PAY.fields], "FILE_NAME")


def read_payment_sections(spark: SparkSession, path: str | Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Payment report with two sections: (main, coupon).

    The first header line starts the main section, which ends at the first total line; the
    next header line starts the coupon section, which ends at the next total line.
    """
    lines = numbered_lines(spark, path)
    lead = F.replace(F.split_part("line", F.lit(","), F.lit(1)), F.lit('"'), F.lit(""))
    lines = lines.withColumn("_lead", lead)
    is_header, is_total = F.col("_lead") == schemas.SECTION_HEADER, F.col("_lead") == schemas.SECTION_TOTAL
    translation = F.create_map(*[F.lit(x) for pair in schemas.COUPON_HEADERS.items() for x in pair])
    names = F.transform(
        split_cells(F.col("_coupon.line"), ","), lambda name: F.coalesce(F.element_at(translation, name), F.lit("error"))
    )
    bounds = {f"_{name}": mark for name, mark in sections("_marks").items()}
    placed = per_file(lines, {"_marks": section_marks(is_header, is_total)}, {**bounds, "_names": names}).drop("_marks")
    width = len(schemas.PAYMENT_MAIN.fields)

    def cell(raw: Column, field: T.StructField) -> Column:
        raw = null_token(raw, ("", "nan"), True)
        if isinstance(field.dataType, T.DoubleType):
            return clean_number(raw, (",",)).alias(field.name)
        if field.name == "report_id":
            return strip_dot_zero(raw).alias(field.name)
        return typed(raw, field.dataType, ("yyyy/MM/dd", "yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss")).alias(field.name)

    data = placed.where(F.col("line") != "").withColumn("_cells", split_cells(F.col("line"), ","))
    main = data.where((F.col("pos") > F.col("_main.pos")) & (F.col("pos") < F.col("_total.pos"))).select(
        *[cell(F.get("_cells", F.lit(i)), f) for i, f in enumerate(schemas.PAYMENT_MAIN.fields) if f.name != "number"],
        "FILE_NAME",
    )
    def coupon_cell(field: T.StructField) -> Column:
        # the unnamed last column of the whole file is the report id
        at = F.lit(width) if field.name == "report_id" else F.array_position("_names", field.name)
        return cell(F.when(at > 0, F.get("_cells", (at - 1).cast("int"))), field)

    after = F.col("_coupon").isNotNull() & (F.col("pos") > F.col("_coupon.pos"))
    before = F.col("_end").isNull() | (F.col("pos") < F.col("_end.pos"))
    coupon = data.where(after & before).select(
        *[coupon_cell(f) for f in schemas.PAYMENT_COUPON.fields], "FILE_NAME"
    )
    return main, coupon


def _rakuten_type(name: str) -> T.DataType:
    if name in TIME_COLUMNS:
        return T.TimestampNTZType()
    return T.DoubleType() if name in NUMBER_COLUMNS else T.StringType()


RAKUTEN_TIME_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "yyyy/MM/dd HH:mm:ss", "yyyy/MM/dd", "HH:mm:ss")


def read_rakuten_orders(
    spark: SparkSession, path: str | Sequence[str], encoding: str | Sequence[str] = (JAPANESE, "UTF-8"), strict: bool = True,
    multi_line: bool = False,
) -> DataFrame:
    """Order export under translated names; headers outside the dictionary are dropped.

    A file is read in the first encoding in which its header shows the order number column.
    """
    raw = read_headed_text(spark, path, ",", encoding, next(iter(ORDER_HEADERS)), multi_line)
    missing = [jp for jp in ORDER_HEADERS if jp not in raw.columns]
    if strict and missing:
        raise KeyError(f"missing headers: {missing}")
    renamed = raw.select(
        *[F.col(f"`{jp}`").alias(en) for jp, en in ORDER_HEADERS.items() if jp in raw.columns], "FILE_NAME"
    )
    return _rakuten_types(renamed, list(ORDER_HEADERS.values()))


def _rakuten_types(df: DataFrame, names: list[str]) -> DataFrame:
    def column(name: str) -> Column:
        raw = F.col(name) if name in df.columns else F.lit(None).cast("string")
        return typed(null_token(raw, RAKUTEN_NULLS, False), _rakuten_type(name), RAKUTEN_TIME_FORMATS).alias(name)

    return df.select(*[column(n) for n in names], "FILE_NAME")


def read_rakuten_bulk(spark: SparkSession, path: str | Sequence[str], encoding: str = JAPANESE) -> DataFrame:
    """All older exports of a folder in one read, columns named by position."""
    names = list(ORDER_HEADERS.values())[:BULK_COLUMN_COUNT]
    text = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return _rakuten_types(read_delimited(spark, path, text, ",", encoding), names)


_GATEWAY_TIMES = {"timestampNTZFormat": "yyyy-MM-dd HH:mm:ss"}


def read_stripe_balance(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Card gateway balance; an unreadable record fails the read."""
    return read_delimited(spark, path, schemas.STRIPE_BALANCE, **_GATEWAY_TIMES)


def read_stripe_payouts(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Card gateway payouts; an unreadable record fails the read."""
    return read_delimited(spark, path, schemas.STRIPE_PAYOUTS, **_GATEWAY_TIMES)


def read_stripe_payouts_apart(spark: SparkSession, path: str | Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(good payouts, rows with an unreadable value as text)."""
    return read_delimited_apart(spark, path, schemas.STRIPE_PAYOUTS)


def load_nomenclature(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return read_delimited(spark, path, schemas.NOMENCLATURE).drop("FILE_NAME")


def read_report_sheet(spark: SparkSession, path: str | Sequence[str], kind: str) -> DataFrame:
    """Reviewed report sheet as a typed table; ``sa`` has one column more than ``ss``/``sh``."""
    target = schemas.REPORT_SHEETS[kind]
    raw = read_delimited(spark, path, schemas.as_text(target)).drop("FILE_NAME")
    return conform(raw, target)
