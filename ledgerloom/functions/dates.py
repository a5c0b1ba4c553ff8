"""Zone-less time handling.

All business times are ``timestamp_ntz``: the shift to local time is written out in the
reports, so the session time zone must never touch the values.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Hours between UTC and the seller's local time, and the payout booking shift.
LOCAL_OFFSET_HOURS = 9
PAYOUT_SHIFT_HOURS = 57

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"
_QUOTED = re.compile(r"'[^']*'")


def shift_hours(ts: Column, hours: int) -> Column:
    return ts + F.expr(f"interval '{hours}' hour")


def to_local(ts: Column) -> Column:
    return shift_hours(ts, LOCAL_OFFSET_HOURS)


def ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def instant_to_ntz(instant: Column) -> Column:
    """UTC wall clock of an instant, whatever the session time zone is."""
    return F.expr(_EPOCH) + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), (F.unix_micros(instant) / F.lit(1_000_000)).cast("decimal(18,6)")
    )


def epoch_to_ts(seconds: Column) -> Column:
    """Epoch seconds to a zone-less UTC timestamp."""
    return instant_to_ntz(F.timestamp_seconds(seconds))


def epoch_second(ts: Column) -> Column:
    """Whole seconds since 1970, rounded down."""
    return F.unix_timestamp(ts)


def parse_ts(text: Column, formats: Sequence[str]) -> Column:
    """First format that fits, per row; NULL where none does.

    A format with a zone field is read as an instant and normalised to UTC.
    """
    attempts = []
    for fmt in formats:
        parsed = F.try_to_timestamp(text, F.lit(fmt))
        zoned = re.search("[zZxXVO]", _QUOTED.sub("", fmt)) is not None
        attempts.append(instant_to_ntz(parsed) if zoned else parsed.cast("timestamp_ntz"))
    return F.coalesce(*attempts)


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")
