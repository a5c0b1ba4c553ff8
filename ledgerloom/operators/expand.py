"""Ledger expansion: one wide row becomes several ledger lines."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Branch:
    """One kind of line: which rows yield it and with which values.

    ``distinct`` lines come from values that repeat on every row of an order, and equal lines
    count once within their branch.
    """

    name: str
    where: Column | None
    columns: dict[str, Column]
    distinct: bool = False


def _value(column: Column, data_type: T.DataType) -> Column:
    """Cast; adding zero turns a negative zero (a negated empty amount) into plain zero."""
    cast = column.cast(data_type)
    return cast + F.lit(0.0) if isinstance(data_type, T.DoubleType) else cast


def _emit(df: DataFrame, branches: list[Branch], schema: T.StructType) -> DataFrame:
    """All lines of the branches in one pass over ``df``."""
    def line(number: int, branch: Branch) -> Column:
        keep = F.coalesce(branch.where, F.lit(False)) if branch.where is not None else F.lit(True)
        return F.struct(
            keep.alias("_keep"),
            F.lit(number).alias("_branch"),
            *[_value(branch.columns[f.name], f.dataType).alias(f.name) for f in schema.fields],
        )

    lines = F.array(*[line(n, b) for n, b in enumerate(branches)])
    return df.select(F.inline(lines)).where("_keep").drop("_keep")


def expand_once(df: DataFrame, branches: list[Branch], schema: T.StructType) -> DataFrame:
    """The lines of :func:`expand` in one pass over ``df``: for frames that are dear to compute twice.

    All lines are counted per branch; a plain line comes back as often as it was counted, a DISTINCT
    one once.  The price is a shuffle of the plain lines, repeats collapsed.
    """
    unique = [n for n, b in enumerate(branches) if b.distinct]
    counted = _emit(df, branches, schema).groupBy("_branch", *[f.name for f in schema.fields]).agg(F.count("*").alias("_n"))
    times = F.when(F.col("_branch").isin(*unique), 1).otherwise(F.col("_n").cast("int"))
    return counted.withColumn("_copy", F.explode(F.array_repeat(F.lit(True), times))).drop("_branch", "_n", "_copy")


def expand(df: DataFrame, branches: list[Branch], schema: T.StructType) -> DataFrame:
    """``UNION ALL`` of the branches, each DISTINCT or not, in at most two passes over ``df``.

    Plain branches need no shuffle.  All DISTINCT branches share one pass and one shuffle, and
    their repeats collapse in the partial aggregation before it.  The branch number takes part
    in the DISTINCT, so equal lines of two branches both stay.
    """
    plain = [b for b in branches if not b.distinct]
    unique = [b for b in branches if b.distinct]
    parts = []
    if plain:
        parts.append(_emit(df, plain, schema))
    if unique:
        parts.append(_emit(df, unique, schema).distinct())
    return reduce(DataFrame.unionByName, parts).drop("_branch")


def union_channels(*feeds: DataFrame) -> DataFrame:
    """Cross-channel union by column name."""
    return reduce(DataFrame.unionByName, feeds)
