"""String cleaning and key normalisation."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions import first_match

# The spellings of "no value" per feed, and whether case is ignored.
MARKETPLACE_NULLS = ("nan", "null", "<na>", "", " ")
ORDER_NULLS = ("nan", "none", "null", "na", "<na>", "<nan>", "")
PAYOUT_NULLS = ("nan", "", "None", "null", "NaN", "NAN")
RAKUTEN_NULLS = ("nan", "null", "none")


def null_token(text: Column, tokens: Sequence[str], fold_case: bool) -> Column:
    probe = F.lower(text) if fold_case else text
    return F.when(~probe.isin(*tokens), text)


def null_tokens(
    df: DataFrame, tokens: Sequence[str], fold_case: bool, columns: Iterable[str] | None = None
) -> DataFrame:
    """Turn null spellings into NULL in the string columns (or in ``columns``)."""
    wanted = set(columns) if columns is not None else {
        f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)
    }
    return df.select(
        *[
            null_token(F.col(f"`{c}`"), tokens, fold_case).alias(c) if c in wanted else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


def normalize_headers(df: DataFrame, drop_commas: bool = False) -> DataFrame:
    """Lower-case, trimmed names; dashes become underscores, or commas are removed."""
    def rename(name: str) -> str:
        return name.replace(",", "").lower() if drop_commas else name.lower().strip().replace("-", "_")

    return df.toDF(*[rename(c) for c in df.columns])


def clean_number(text: Column, drop: Sequence[str]) -> Column:
    """Remove the given pieces of text, then read a double (NULL if it is not a number)."""
    for piece in drop:
        text = F.replace(text, F.lit(piece), F.lit(""))
    return text.try_cast("double")


def strip_dot_zero(text: Column, anywhere: bool = False) -> Column:
    """Undo ids that were read as floats (``77.0``).

    ``anywhere=True`` removes every ``.0``, as the original feeds did: ``1.05`` becomes ``15``.
    """
    if anywhere:
        return F.replace(text, F.lit(".0"), F.lit(""))
    return F.regexp_replace(text, r"\.0$", "")


def canonical_id(text: Column) -> Column:
    """Whole-number text of an id such as ``1234.0`` or ``1.234E3``.

    Plain numbers of any length are cut on the text and keep all digits.  Exponent forms are read as
    numbers of up to 32 digits; anything else is NULL.
    """
    plain = F.btrim(text)
    pattern = r"^([+-]?)0*(\d+)(?:\.\d*)?$"
    digits, sign = F.regexp_extract(plain, pattern, 2), F.regexp_extract(plain, pattern, 1)
    whole = F.when((sign == "-") & (digits != "0"), F.concat(F.lit("-"), digits)).otherwise(digits)
    number = F.regexp_replace(plain.try_cast("decimal(38,6)").cast("string"), r"\.\d*$", "")
    return F.when(digits != "", whole).otherwise(F.when(number == "-0", F.lit("0")).otherwise(number))


def clean_text(text: Column) -> Column:
    """Drop the brackets, braces, single quotes and line breaks of a rendered nested value."""
    return F.regexp_replace(text, r"[{}\[\]'\n]", "")


def normalize_sku(item_number: Column) -> Column:
    """13-character stock code; a leading ``v`` plus any one character is skipped."""
    return F.when(item_number.like("v_%"), F.substring(item_number, 3, 13)).otherwise(
        F.left(item_number, F.lit(13))
    )


def short_sku(item_number: Column) -> Column:
    return F.left(item_number, F.lit(13))


def zip_code(area: Column, local: Column) -> Column:
    """``area-local`` with the local part zero-filled to 4 characters and never cut."""
    missing = F.lit(4) - F.char_length(local)
    padded = F.when(missing > 0, F.concat(F.repeat(F.lit("0"), missing), local)).otherwise(local)
    return F.concat(area, F.lit("-"), padded)


# Transaction types whose rule key leaves out the description.
SHORT_KEY_TYPES = ("CouponRedemptionFee", "Imaging Services")


def rule_key(transaction_type: Column, amount_type: Column, description: Column) -> Column:
    """Key into the nomenclature; NULL if one of its parts is NULL."""
    return F.when(
        transaction_type.isin(*SHORT_KEY_TYPES), F.concat(transaction_type, amount_type)
    ).otherwise(F.concat(transaction_type, amount_type, description))


def canonical_remark(remarks: Column) -> Column:
    """Remark without the order number that follows it."""
    return first_match(
        [(remarks.like(f"{head}%"), F.lit(head)) for head in ("Product Charges", "Delivery", "Fee")]
    )


def payout_number(payout_id: Column) -> Column:
    """Payout id without its four-character prefix."""
    return F.substring(payout_id, 5, 20)
