"""Tax, fee and rounding arithmetic.

Amounts are doubles that hold whole currency units; ``F.round`` rounds half away from zero.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions import first_match

# Consumption tax rates and the two gateway fee rates.
REDUCED_TAX = 0.08
STANDARD_TAX = 0.1
REDUCED_TAX_DIVISOR = 1.08
INCLUDED_TAX_DIVISOR = 11
GATEWAY_FEE_RATES = (0.036, 0.01)


def net_of_tax(total: Column) -> Column:
    """Amount without the reduced-rate tax that is included in ``total``."""
    return F.round(total / F.lit(REDUCED_TAX_DIVISOR))


def tax_part(total: Column) -> Column:
    """Remainder of :func:`net_of_tax`, so that both parts add up to ``total``."""
    return total - net_of_tax(total)


def net_of_eleventh(amount: Column) -> Column:
    """Standard-rate amount without tax (ten elevenths), rounded."""
    return F.round(amount - amount / F.lit(INCLUDED_TAX_DIVISOR))


def eleventh(amount: Column) -> Column:
    """Standard-rate tax included in ``amount`` (one eleventh), rounded."""
    return F.round(amount / F.lit(INCLUDED_TAX_DIVISOR))


def gateway_fee(price: Column) -> Column:
    """Negative fee: each rate is rounded on its own before they are added."""
    base_rate, extra_rate = GATEWAY_FEE_RATES
    return -(F.round(price * F.lit(base_rate)) + F.round(price * F.lit(extra_rate)))


def truncate(amount: Column) -> Column:
    """Drop the fraction toward zero (Spark's own ``trunc`` works on dates only)."""
    return F.when(amount < 0, F.ceil(amount)).otherwise(F.floor(amount)).cast("double")


def tax_rate_of_label(label: Column) -> Column:
    """Multiplier named in a tax class label; 0 where the label names none."""
    return first_match(
        [
            (label.like("%8%"), F.lit(REDUCED_TAX)),
            (label.like("%10%"), F.lit(STANDARD_TAX)),
        ],
        F.lit(0.0),
    )


def included_tax(amount: Column, rate: Column) -> Column:
    return amount - F.round(amount / (F.lit(1) + rate))
