"""Shuffled, computable placement of documents in shards (operator 2).

Rows get gapless numbers 0..n-1 in (doc_id, hash, size) order.  A Feistel network over a domain of
``a * b >= n`` numbers permutes them; a number that leaves 0..n-1 walks on along its cycle until it
is back inside, so the result is a permutation of 0..n-1.  Shard and slot are the remainder and the
quotient of the permuted number, so shards differ by one row at most, slots have no gaps, and any
row's place follows from its number, the row count and the seed alone.

Only DataFrame functions; the row numbers come from range partitions and one offset per partition.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import id_and_text
from ledgerloom.operators.windows import global_row_number

PRIME = 2**31 - 1  # round values stay below it, so that products fit in a long
ROUNDS = 8
SIDES = 4096


def domain(n: int) -> tuple[int, int]:
    """Sides (a, b) of a domain with few numbers beyond ``n``: the best of ``SIDES`` with ``a`` up to twice the root."""
    root = math.isqrt(max(n, 1) - 1) + 1
    tried = (root + j * (root // SIDES + 1) for j in range(SIDES))
    return min(((a, -(-n // a) or 1) for a in tried), key=lambda side: side[0] * side[1])


def _mix(value: Column, step: Column, seed: int) -> Column:
    """Round function: a keyed square modulo the prime, then a keyed multiple."""
    t = (value * F.lit(48271) + (step + F.lit(1)) * F.lit(40692 + seed % 10_000_019)) % PRIME
    return (((t * t) % PRIME) * F.lit(69621) + step * F.lit(16807) + t) % PRIME


def _network(x: Column, a: int, b: int, seed: int) -> Column:
    """Even steps change the left half by the right one, odd steps the right by the left."""
    start = F.struct(((x - x % b) / b).cast("long").alias("l"), (x % b).alias("r"))

    def step(acc: Column, i: Column) -> Column:
        left, right = acc["l"], acc["r"]
        even = i % 2 == 0
        return F.struct(
            F.when(even, (left + _mix(right, i, seed)) % a).otherwise(left).alias("l"),
            F.when(even, right).otherwise((right + _mix(left, i, seed)) % b).alias("r"),
        )

    return F.aggregate(F.sequence(F.lit(0).cast("long"), F.lit(ROUNDS - 1).cast("long")), start, step, lambda acc: acc["l"] * b + acc["r"])


def permuted(x: Column, n: int, seed: int = 0) -> Column:
    """Place of row number ``x`` (0..n-1) in the shuffled order.

    A walk leaves 0..n-1 for at most ``a * b - n`` steps, as a cycle has no number twice, so that
    many steps always bring it back.  Only the few numbers that leave it walk at all.
    """
    a, b = domain(n)
    once = _network(x, a, b, seed)
    if a * b == n:
        return once
    steps = F.sequence(F.lit(1), F.lit(a * b - n))
    walked = F.aggregate(steps, once, lambda at, _: F.when(at < n, at).otherwise(_network(at, a, b, seed)))
    return F.when(once < n, once).otherwise(walked)


def shards(docs: DataFrame, shard_count: int = 40, seed: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, row, shard, slot) for every row.

    Null text counts as empty.  Equal rows get places of their own, in any order among them; null
    doc_ids come first.  The numbering writes one checkpoint; an empty table gives no rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = id_and_text(docs, id_col, text_col).select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    )
    numbered = global_row_number(rows, ["doc_id", "text_crc32", "size"], "number").withColumn("row", F.col("number") - 1)
    n = numbered.count()  # over the checkpoint
    placed = numbered.withColumn("place", permuted(F.col("row"), n, seed))
    return placed.select(
        "doc_id", "size", "text_crc32", "row",
        (F.col("place") % shard_count).cast("int").alias("shard"),
        ((F.col("place") - F.col("place") % shard_count) / shard_count).cast("long").alias("slot"),
    )


def placement(docs: DataFrame, shard_count: int = 40) -> DataFrame:
    """The placement under its law: counts of two shards differ by one row at most."""
    return shards(docs, shard_count).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def _network_sql(source: str, seed: int) -> str:
    """``source`` (number, x, n, a, b) with ``place``, round by round."""
    text = f"SELECT number, n, a, b, x // b AS l, x % b AS r FROM ({source})"
    for i in range(ROUNDS):
        value, side = ("r", "l") if i % 2 == 0 else ("l", "r")
        key = (i + 1) * (40692 + seed % 10_000_019)
        text = f"SELECT *, ({value} * 48271 + {key}) % {PRIME} AS t FROM ({text})"
        mixed = f"((((t * t) % {PRIME}) * 69621 + {i * 16807} + t) % {PRIME})"
        halves = {"l": "l", "r": "r"} | {side: f"({side} + {mixed}) % {'a' if side == 'l' else 'b'}"}
        text = f"SELECT number, n, a, b, {halves['l']} AS l, {halves['r']} AS r FROM ({text})"
    return f"SELECT number, n, a, b, l * b + r AS place FROM ({text})"


def sql(shard_count: int = 40, seed: int = 0) -> str:
    """:func:`placement` of table ``documents`` in DuckDB SQL; crc32 goes byte by byte over a table from its rule."""
    polynomial = 0xEDB88320
    shift = f"CASE WHEN c % 2 = 1 THEN xor(c // 2, {polynomial}) ELSE c // 2 END"
    entry = "CAST(k AS BIGINT)"
    for _ in range(8):
        entry = f"(SELECT {shift} FROM (SELECT {entry} AS c))"
    return f"""
WITH RECURSIVE crc AS (
  SELECT list(c ORDER BY k) AS entries FROM (SELECT k, {entry} AS c FROM range(256) t(k))
), bytes AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), sized AS (
  SELECT doc_id, CAST(length(h) // 2 + 16 AS BIGINT) AS size,
    xor(list_reduce(
      list_prepend(4294967295, list_transform(range(length(h) // 2), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT))),
      lambda c, byte: xor(c // 256, entries[1 + xor(c % 256, byte)])
    ), 4294967295) AS text_crc32
  FROM bytes, crc
), total AS (
  SELECT greatest(count(*), 1) AS n FROM documents
), sides AS (
  SELECT n, a, greatest((n + a - 1) // a, 1) AS b
  FROM (SELECT n, root + unnest(range({SIDES})) * (root // {SIDES} + 1) AS a FROM (SELECT n, CAST(ceil(sqrt(n)) AS BIGINT) AS root FROM total))
  ORDER BY a * b, a LIMIT 1
), numbered AS (
  SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS number FROM sized
), walk AS (
  {_network_sql("SELECT number, number AS x, n, a, b FROM numbered, sides", seed)}
  UNION ALL
  {_network_sql("SELECT number, place AS x, n, a, b FROM walk WHERE place >= n", seed)}
)
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(place % {shard_count} AS INTEGER) AS shard, place // {shard_count} AS slot,
  CAST(NULL AS INTEGER) AS grown_shard
FROM numbered JOIN walk USING (number) WHERE place < n"""
