"""A stored table whose buckets are ranges of a numeric key, for reloading tails.

Order numbers and payout ids grow, so a trim takes away the upper end of the key.  Here it rewrites the
one range that holds the bound, and the ranges above it are just left out of the next commit file; the
files below the bound are neither read in full nor touched, however old and large the table is.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.maintenance import first_open, last_settled
from ledgerloom.streaming.keyed_table import _BUCKET, KeyedTable

WIDTH = 100_000  # key numbers of one range
UNNUMBERED = -(1 << 62)  # bucket of the rows whose key is no number; no trim reaches it


class RangeTable(KeyedTable):
    """The table at ``target``, in ranges of ``width`` numbers of the text or numeric column ``key``.

    ``replace`` loads batches, as in a :class:`KeyedTable`; a batch lists the ranges that it touches, so the
    width has to suit the span of the numbers.
    """

    def __init__(self, spark: SparkSession, target: str, key: str, width: int = WIDTH):
        super().__init__(spark, target, key, width)
        self.width = width

    def _number(self) -> Column:
        return F.col(self.key).try_cast("bigint")

    def _place(self) -> Column:
        number, width = self._number(), F.lit(self.width).cast("bigint")
        below = number - F.pmod(number, width)  # a multiple of the width, so that the division is exact
        return F.coalesce(F.call_function("div", below, width), F.lit(UNNUMBERED))

    def _trim(self, last: int | None, number: int) -> None:
        """Commit without the rows whose number is above ``last``; None keeps all."""
        table = self._at(number)
        if last is None:
            self._write_commit(number, table)
            return
        edge = last // self.width
        kept = {b: n for b, n in table.items() if b < edge}
        if edge in table:
            rows = self._rows({edge: table[edge]}).where(self._number() <= last)
            if not rows.isEmpty():
                placed = rows.withColumn(_BUCKET, F.lit(edge)).hint("rebalance", _BUCKET)
                placed.write.mode("overwrite").partitionBy(_BUCKET).parquet(f"{self.target}/batch={number}")
                kept[edge] = number
        self._write_commit(number, kept)

    def trim_recent(self, number: int, days: int, as_of: date, created: str = "created_at") -> None:
        """Batch ``number``: drop the rows that ``maintenance.trim_recent`` drops."""
        current = self.read(before=number)
        self._trim(current and last_settled(current, days, as_of, self.key, created).first()[0], number)

    def trim_from_first_pending(self, number: int, status: str = "payout_status") -> None:
        """Batch ``number``: drop the rows that ``maintenance.trim_from_first_pending`` drops."""
        current = self.read(before=number)
        first = current and first_open(current, self.key, status).first()[0]
        self._trim(None if first is None else first - 1, number)
