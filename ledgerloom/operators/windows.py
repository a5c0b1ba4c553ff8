"""Global row numbers and running sums without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.storage import checkpoint_dir, stored

_POSITION_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def _frozen_layout(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Range-sorted rows with their partition number and position, written once.

    Range bounds are sampled, so a second evaluation could cut elsewhere; the checkpoint
    fixes them and lets later stages survive lost executors.
    """
    checkpoint_dir(df.sparkSession)
    laid_out = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_slot", F.monotonically_increasing_id())
        .checkpoint()
    )
    return laid_out.withColumn("_part", F.shiftright("_slot", _POSITION_BITS)).withColumn(
        "_pos", F.col("_slot").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    )


def _before(parts: DataFrame, totals: Sequence[str]) -> DataFrame:
    """Per partition: totals of all earlier partitions.

    The input has one row per range partition, so one task computes it, and its size is bounded
    by the number of shuffle partitions, so it may be broadcast.
    """
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return F.broadcast(
        parts.select(
            F.col("_part").alias("_at"),
            *[F.coalesce(F.sum(t).over(earlier), F.lit(0)).alias(f"{t}_before") for t in totals],
        )
    )


def global_row_number(df: DataFrame, order: Sequence[str], name: str = "row_number") -> DataFrame:
    """1-based position of each row in the total order.  Eager: writes one checkpoint."""
    rows = _frozen_layout(df, order)
    offsets = _before(rows.groupBy("_part").agg(F.count("*").alias("_n")), ["_n"])
    return (
        rows.join(offsets, F.col("_part") == F.col("_at"))
        .withColumn(name, F.col("_n_before") + F.col("_pos") + F.lit(1))
        .drop("_slot", "_part", "_pos", "_at", "_n_before")
    )


def numbered_sides(
    left: DataFrame, right: DataFrame, left_order: Sequence[str], right_order: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """Both frames with the 1-based position of each row in its own order, as ``_ln`` and ``_rn``.

    The two share one range partitioning, tagged by side: the left rows come first, so a right row's
    position is its place in the whole less the number of left rows.  Eager: writes one table, in which
    each side is a struct, so that a later stage reads the columns of one side only.
    """
    tagged = left.select(F.lit(0).alias("_side"), F.struct(*_quoted(left.columns)).alias("_l")).unionByName(
        right.select(F.lit(1).alias("_side"), F.struct(*_quoted(right.columns)).alias("_r")), allowMissingColumns=True
    )
    order = [F.col("_side"), *[F.col("_l")[c] for c in left_order], *[F.col("_r")[c] for c in right_order]]
    slot = F.monotonically_increasing_id()
    rows = stored(tagged.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_slot", slot), "sides")
    rows = rows.withColumn("_part", F.shiftright("_slot", _POSITION_BITS))
    place = F.col("_slot").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)) + F.lit(1)
    offsets = _before(rows.groupBy("_part").agg(F.count("*").alias("_n")), ["_n"])
    lefts = rows.where(F.col("_side") == 0).agg(F.count("*")).scalar()

    def side(tag: int, struct: str, columns: Sequence[str], name: str) -> DataFrame:
        number = F.col("_n_before") + place - (lefts if tag else F.lit(0))
        own = rows.where(F.col("_side") == tag).join(offsets, F.col("_part") == F.col("_at"))
        return own.select(*[F.col(struct)[c].alias(c) for c in columns], number.alias(name))

    return side(0, "_l", left.columns, "_ln"), side(1, "_r", right.columns, "_rn")


def _quoted(names: Sequence[str]) -> list[Column]:
    return [F.col("`" + n.replace("`", "``") + "`") for n in names]


def running_sum(df: DataFrame, order_col: str, value_col: str, name: str = "running_sum") -> DataFrame:
    """Running total in ``order_col`` order; rows with equal order values share one total.

    Values are first added up per order value (partial sums before the shuffle), the prefix
    sums are built per range partition plus an offset, and then joined back.  NULL order
    values sort first and form one group.  The total is NULL until the first non-NULL value.
    """
    groups = df.groupBy(F.col(order_col).alias("_order")).agg(
        F.coalesce(F.sum(value_col), F.lit(0)).alias("_sum"), F.count(value_col).alias("_n")
    )
    rows = _frozen_layout(groups, ["_order"])
    parts = rows.groupBy("_part").agg(F.sum("_sum").alias("_sum"), F.sum("_n").alias("_n"))
    offsets = _before(parts, ["_sum", "_n"])
    so_far = Window.partitionBy("_part").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    local = rows.select(
        "_order", "_part", F.sum("_sum").over(so_far).alias("_sum"), F.sum("_n").over(so_far).alias("_n")
    )
    totals = local.join(offsets, F.col("_part") == F.col("_at")).select(
        "_order",
        F.when(F.col("_n") + F.col("_n_before") > 0, F.col("_sum") + F.col("_sum_before")).alias(name),
    )
    return df.join(totals, df[order_col].eqNullSafe(totals["_order"]), "left").drop("_order")


def latest_k(df: DataFrame, key: str, k: int) -> DataFrame:
    """Rows of the ``k`` greatest distinct keys (text keys compare as text)."""
    newest = df.select(F.col(key).alias("_key")).distinct().orderBy(F.desc("_key")).limit(k)
    return df.join(newest, df[key] == newest["_key"], "left_semi")


def order_report(df: DataFrame, spec: Sequence[tuple[str, bool]]) -> DataFrame:
    """Sort for display; ``spec`` lists (column, ascending).  NULLs first up, last down.

    Reports come back unsorted because a total sort shuffles everything; use this at the edge.
    """
    return df.orderBy(*[F.asc_nulls_first(c) if up else F.desc_nulls_last(c) for c, up in spec])
