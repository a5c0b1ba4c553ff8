"""Reconciliation joins.

No join here carries a broadcast hint: a side is broadcast only when Spark finds its size to
be under ``spark.sql.autoBroadcastJoinThreshold``, from statistics or at run time.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.dates import epoch_second
from ledgerloom.functions.rules import MISSING_RULE
from ledgerloom.operators.windows import numbered_sides


def _same(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    return reduce(lambda a, b: a & b, [left[lk] == right[rk] for lk, rk in pairs])


def join_lines(payouts: DataFrame, orders: DataFrame) -> DataFrame:
    """Payout rows with every line of their order (inner, one payout to many lines)."""
    return payouts.join(orders, payouts["source_order_id"] == orders["id"], "inner")


def join_distinct(
    left: DataFrame,
    dim: DataFrame,
    keys: Sequence[tuple[str, str]],
    columns: dict[str, Column],
    sparse: bool = False,
) -> DataFrame:
    """Left join with the DISTINCT projection of ``dim``.

    ``keys`` pairs left and dimension columns; ``columns`` names the attached expressions.
    Several distinct rows of one key still repeat the left row.  ``sparse`` says that the
    first left key is NULL on many rows, see :func:`join_sparse_left`.
    """
    picked = dim.select(
        *[F.col(dk).alias(f"_k{i}") for i, (_, dk) in enumerate(keys)],
        *[c.alias(name) for name, c in columns.items()],
    ).distinct()
    pairs = [(lk, f"_k{i}") for i, (lk, _) in enumerate(keys)]
    if sparse:
        return join_sparse_left(left, picked, pairs)
    return left.join(picked, _same(left, picked, pairs), "left").drop(*[k for _, k in pairs])


def join_sparse_left(
    left: DataFrame, right: DataFrame, keys: Sequence[tuple[str, str]]
) -> DataFrame:
    """Left join whose first left key is NULL on many rows.

    All those rows would hash to one partition.  They match nothing, so they are spread by a
    hash of the whole row; being a function of the row, a retried task sends each row to the
    same place.  The right key columns are dropped.
    """
    sparse = left[keys[0][0]].isNull()
    spread = left.withColumn("_spread", F.when(sparse, F.xxhash64(*[left[c] for c in left.columns])))
    other = right.where(F.col(keys[0][1]).isNotNull()).withColumn("_fixed", F.lit(None).cast("bigint"))
    on = _same(spread, other, keys) & spread["_spread"].eqNullSafe(other["_fixed"])
    right_keys = [other[rk] for _, rk in keys]
    return spread.join(other, on, "left").drop(*right_keys).drop("_spread", "_fixed")


def contains_pairs(texts: DataFrame, text_col: str, ids: DataFrame, id_col: str) -> DataFrame:
    """Distinct (text, id) with the id inside the text, by equality on substrings.

    The lengths that occur among the ids come from an aggregate in the same query; each
    distinct text is cut into all its substrings of those lengths, which are then joined on
    equality.  The work is linear in the length of the texts, and only keys are shuffled.
    Ids are literal text: LIKE wildcards have no meaning in them.  Empty ids match nothing.
    """
    known = ids.select(F.col(id_col).alias("_id")).where(F.length("_id") > 0).distinct()
    lengths = known.select(F.collect_set(F.length("_id")).alias("l")).scalar()
    words = texts.select(F.col(text_col).alias("_text")).where("_text IS NOT NULL").distinct()
    sized = words.withColumn("_len", F.explode(lengths)).where(F.col("_len") <= F.length("_text"))
    pieces = sized.select(
        "_text",
        F.explode(
            F.sequence(F.lit(1), F.length("_text") - F.col("_len") + F.lit(1))
        ).alias("_at"),
        "_len",
    ).select("_text", F.col("_text").substr(F.col("_at"), F.col("_len")).alias("_id"))
    return pieces.join(known, "_id", "left_semi").distinct()


def contains_join(left: DataFrame, text_col: str, right: DataFrame, id_col: str) -> DataFrame:
    """Inner join on ``text_col LIKE '%' || id_col || '%'`` without a nested loop."""
    pairs = contains_pairs(left, text_col, right, id_col)
    return (
        left.join(pairs, left[text_col] == pairs["_text"])
        .join(right, F.col("_id") == right[id_col])
        .drop("_text", "_id")
    )


def time_window_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[tuple[str, str]],
    left_ts: str,
    right_ts: str,
    max_seconds: int,
) -> DataFrame:
    """Left join: equal keys, left strictly earlier, at most ``max_seconds`` boundaries apart.

    Time is cut into buckets one second longer than the limit.  A right row is listed under
    the one or two buckets in which its partners can lie, a left row has exactly one, so no
    pair appears twice and the outer join needs no second pass.  A hot key is cut by time.
    """
    width = max_seconds + 1
    bucketed = left.withColumn("_bucket", F.floor(epoch_second(F.col(left_ts)) / width))
    second = epoch_second(F.col(right_ts))
    listed = right.withColumn(
        "_slot",
        F.explode(
            F.sequence(F.floor((second - F.lit(max_seconds)) / width), F.floor(second / width))
        ),
    )
    on = (
        _same(bucketed, listed, keys)
        & (bucketed["_bucket"] == listed["_slot"])
        & (bucketed[left_ts] < listed[right_ts])
        & (epoch_second(listed[right_ts]) - epoch_second(bucketed[left_ts]) <= max_seconds)
    )
    return bucketed.join(listed, on, "left").drop("_bucket", "_slot")


def positional_join(
    left: DataFrame,
    right: DataFrame,
    left_order: Sequence[str],
    right_order: Sequence[str],
    check: tuple[str, str],
) -> DataFrame:
    """Left join of the n-th left row with the n-th right row.

    ``verify`` is ``WRONG_UNION`` where the ``check`` columns differ and NULL otherwise (also
    when one is NULL).  The orders must be total: add a tie-break column.
    """
    numbered_left, numbered_right = numbered_sides(left, right, left_order, right_order)
    joined = numbered_left.join(numbered_right, F.col("_ln") == F.col("_rn"), "left")
    wrong = F.when(F.col(check[0]) != F.col(check[1]), F.lit("WRONG_UNION"))
    return joined.withColumn("verify", wrong).drop("_ln", "_rn")


def right_distinct(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Right outer join with the distinct rows of ``right``; keeps the right key."""
    rows = right.distinct()
    return left.withColumnRenamed(on, "_on").join(rows, F.col("_on") == rows[on], "right").drop("_on")


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: tuple[str, str],
    fill: tuple[str, str],
    validate: bool = True,
) -> DataFrame:
    """Fill NULLs of a left column from a many-to-one lookup.

    A repeated right key voids the whole lookup: the left side comes back unchanged.  With
    ``validate=False`` the smallest value of a repeated key is used instead.
    """
    left_key, right_key = on
    target, source = fill
    lookup = (
        right.where(F.col(right_key).isNotNull())
        .groupBy(F.col(right_key).alias("_key"))
        .agg(F.min(source).alias("_value"), F.count("*").alias("_n"))
    )
    value = F.col("_value")
    if validate:
        broken = lookup.where("_n > 1").exists()
        value = F.when(~broken, value)
    return (
        left.join(lookup, left[left_key] == F.col("_key"), "left")
        .withColumn(target, F.coalesce(F.col(target), value))
        .drop("_key", "_value", "_n")
    )


def attach_charge_refs(orders: DataFrame, refs: DataFrame) -> DataFrame:
    """Charge references for the two outside gateways, all of them in one lookup.

    A repeated key in one gateway's references drops only that gateway's references.  Where both have
    one for an order, the first gateway's counts.
    """
    gateways = ("stripe", "komoju")
    tags = F.array(*[F.when(gateway_matches(F.col("payment_gateway_names"), g), F.lit(g)) for g in gateways])
    ids = orders.select(F.col("id").alias("_gid"), F.explode(F.array_compact(tags)).alias("_gateway")).distinct()
    lookup = refs.join(ids, refs["order_id"] == ids["_gid"]).groupBy("_gid", "_gateway").agg(
        F.min("charge_ref").alias("_value"), F.count("*").alias("_n")
    )
    broken = lookup.agg(F.collect_set(F.when(F.col("_n") > 1, F.col("_gateway")))).scalar()
    wide = lookup.groupBy("_gid").agg(
        *[F.max(F.when(F.col("_gateway") == g, F.col("_value"))).alias(f"_ref_{g}") for g in gateways]
    )
    usable = [F.when(~F.array_contains(broken, g), F.col(f"_ref_{g}")) for g in gateways]
    return (
        orders.join(wide, orders["id"] == wide["_gid"], "left")
        .withColumn("reference", F.coalesce("reference", *usable))
        .drop("_gid", *[f"_ref_{g}" for g in gateways])
    )


def gateway_matches(names: Column, gateway: str) -> Column:
    """Case-insensitive substring test on a gateway list; NULL counts as no match."""
    return F.coalesce(F.contains(F.lower(names), F.lit(gateway)), F.lit(False))


def semi_in(df: DataFrame, column: str, values: DataFrame) -> DataFrame:
    """Rows whose column is among the single column of ``values``."""
    wanted = values.toDF("_wanted")
    return df.join(wanted, df[column] == wanted["_wanted"], "left_semi")


def not_booked(
    df: DataFrame, ledger: DataFrame | None, key: str, ledger_key: str | None = None, null_keys_stay: bool = False
) -> DataFrame:
    """Rows whose key is not in the ledger, with the NULL rules of SQL ``NOT IN``.

    Keys already in the ledger drop out.  A NULL key drops out too, unless the ledger holds no
    key at all, or ``null_keys_stay``.  This is a plain anti join: a large ledger is not broadcast, and
    one that is bucketed by its key, of the key's type, is not shuffled either.
    """
    if ledger is None:
        return df
    booked = ledger.select(F.col(ledger_key or key).alias("_booked")).where("_booked IS NOT NULL")
    kept = df if null_keys_stay else df.where(F.col(key).isNotNull() | ~booked.exists())
    keys = booked.distinct()
    return kept.join(keys, kept[key] == keys["_booked"], "left_anti")


def apply_rules(df: DataFrame, nomenclature: DataFrame, key: str = "concat_fields") -> DataFrame:
    """Accounting labels by rule key; ``MISSING NOMENCLATURE`` as account where none fits."""
    rules = nomenclature.select("concatenated_fields", "remarks", "account", "item", "tax_distiction")
    joined = df.join(rules, df[key] == rules["concatenated_fields"], "left")
    return joined.withColumn("account", F.coalesce("account", F.lit(MISSING_RULE))).drop("concatenated_fields")


def attach_item(df: DataFrame, sku_map: DataFrame, with_store: bool = True) -> DataFrame:
    """Item name by stock code, within the own channel or (older form) across all channels."""
    names = sku_map.select("sku_item", "store_name", "item_name")
    if with_store:
        return join_sparse_left(df, names, [("sku", "sku_item"), ("SOURCE", "store_name")])
    return join_sparse_left(df, names.drop("store_name"), [("sku", "sku_item")])


def join_cast_key(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Left join of a text id with an id that was loaded as a double."""
    keyed = right.withColumn(
        "_cast_key", F.round(F.col(right_key)).cast("bigint").cast("string")
    ).drop(right_key)
    return left.join(keyed, left[left_key] == keyed["_cast_key"], "left").drop("_cast_key")


def with_group_max(df: DataFrame, source: DataFrame, key: str, column: str, name: str) -> DataFrame:
    """Attach the largest ``column`` of all ``source`` rows with the same key."""
    top = source.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.max(column).alias(name))
    return df.join(top, df[key] == F.col("_key"), "left").drop("_key")


def scalar_lookup(df: DataFrame, dim: DataFrame, key: tuple[str, str], column: str, name: str) -> DataFrame:
    """Attach the one value of a key; two rows of a key that is looked up raise an error."""
    one = dim.where(F.col(key[1]).isNotNull()).groupBy(F.col(key[1]).alias("_key")).agg(
        F.max(column).alias("_value"), F.count("*").alias("_n")
    )
    checked = F.when(
        F.col("_n") > 1, F.raise_error(F.concat(F.lit("more than one row for key "), F.col("_key")))
    ).otherwise(F.col("_value"))
    return df.join(one, df[key[0]] == F.col("_key"), "left").withColumn(name, checked).drop("_key", "_value", "_n")


def scalar_bound(df: DataFrame, column: Column, bounds: DataFrame, bound: Column) -> DataFrame:
    """Rows with ``column`` below one aggregate of another table (none if that is NULL)."""
    return df.where(column < bounds.select(bound).scalar())
