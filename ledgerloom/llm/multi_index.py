"""Near-duplicate groups of SimHash fingerprints by multi-index hashing (operator 8).

Fingerprints link at three or fewer differing bits, so one of their two 32-bit halves differs in one
bit at most.  Each distinct fingerprint is entered under both halves and looked up under each half
and under each half with one set bit cleared (of two keys that differ in one bit, one is the other
with a bit cleared, so the whole ball of radius one is covered by its lower side).  Matches are
verified over all 64 bits.

Copies collapse to one fingerprint first.  Where more than ``bucket_limit`` fingerprints share a key,
the same step is taken anew inside the bucket on the bits that the key leaves open (32, then 16), so
no bucket gives all its pairs; the last level has 256 possible members at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import fresh, quoted, unsent
from ledgerloom.llm.components import components
from ledgerloom.llm.simhash import fingerprints
from ledgerloom.storage import stored

MAX_BITS = 3
BUCKET_LIMIT = 256


def _ball(key: Column, width: int) -> Column:
    """``key`` and every value that clears one of its set bits."""
    cleared = F.transform(F.array(*[F.lit(1 << i) for i in range(width)]), lambda bit: F.when(key.bitwiseAND(bit) != 0, key.bitwiseXOR(bit)))
    return F.concat(F.array(key), F.filter(cleared, lambda k: k.isNotNull()))


def _entries(rows: DataFrame, width: int) -> DataFrame:
    """``rows`` (context, open, fp) entered under both halves of their ``width`` open bits: side, key, still open bits."""
    half = width // 2
    mask = F.lit((1 << half) - 1).cast("long")
    high, low = F.shiftrightunsigned("open", half).bitwiseAND(mask), F.col("open").bitwiseAND(mask)
    sides = F.array(
        F.struct(F.lit(0).alias("side"), high.alias("key"), low.alias("rest")),
        F.struct(F.lit(1).alias("side"), low.alias("key"), high.alias("rest")),
    )
    return rows.select("context", "fp", F.explode(sides).alias("s")).select("context", "fp", "s.side", "s.key", "s.rest")


def _bucket() -> Column:
    return F.xxhash64("context", "side", "key")  # equal hashes of different keys only add candidates


def links(prints: DataFrame, max_bits: int = MAX_BITS, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """(a, b): every pair of the distinct fingerprints ``prints`` (fp) that differ in ``max_bits`` (3 at most) bits or fewer."""
    if not 0 <= max_bits <= 3:
        raise ValueError("two halves with balls of radius one cover distances up to three")
    rows = prints.select(F.lit(0).cast("long").alias("context"), F.col("fp").alias("open"), "fp")
    found: DataFrame | None = None
    width = 64
    while True:
        half = width // 2
        entries = _entries(rows, width)
        index = entries.select(_bucket().alias("bucket"), F.col("fp").alias("b"), "rest")
        probes = entries.select("context", "side", F.explode(_ball(F.col("key"), half)).alias("key"), F.col("fp").alias("a"), "rest")
        probes = probes.select(_bucket().alias("bucket"), "a", "rest")
        full = None
        if half > 8:
            full = stored(index.groupBy("bucket").count().where(F.col("count") > bucket_limit).select("bucket"), "full-buckets")
            if full.isEmpty():
                full = None
        light_index, light_probes = index, probes
        if full is not None:
            light_index, light_probes = (x.join(full, "bucket", "left_anti") for x in (index, probes))
        distance = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
        pairs = (
            light_probes.select("bucket", "a")
            .join(unsent(light_index.select("bucket", "b")), "bucket")
            .where((F.col("a") != F.col("b")) & (distance <= max_bits))
            .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        )
        found = pairs if found is None else found.unionByName(pairs)
        if full is None:
            return found.distinct()
        # A full bucket goes on with all that is entered in it or looks there.
        members = index.select("bucket", F.col("b").alias("fp"), "rest").unionByName(probes.select("bucket", F.col("a").alias("fp"), "rest"))
        members = members.join(full, "bucket", "left_semi").distinct()
        rows = stored(members.select(F.col("bucket").alias("context"), F.col("rest").alias("open"), "fp"), "full-members")
        width = half


def _rooted(marked: DataFrame, max_bits: int) -> DataFrame:
    """(fp, root, first) per distinct fingerprint; ``first`` is its row with the lowest id, null ids last."""
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "tie")
    prints = stored(marked.groupBy("fp").agg(F.min(row).alias("first")), "prints")
    roots = components(links(prints.select("fp"), max_bits))
    return prints.join(unsent(roots), F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("root", "fp").alias("root"), "first")


def groups(docs: DataFrame, max_bits: int = MAX_BITS, width: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp, component_id) for every row; ``component_id`` is the smallest doc_id that links reach.

    Null text has fingerprint 0 like a text without words; those link like any other.  Repeated rows
    stay.  A null doc_id counts only where a component has no other; its id is null then.
    """
    marked = stored(fingerprints(docs, width, id_col, text_col), "fingerprints")
    rooted = _rooted(marked, max_bits)
    ids = rooted.groupBy("root").agg(F.min("first.doc_id").alias("component_id")).withColumnRenamed("root", "r")
    named = rooted.join(ids, F.col("root") == F.col("r")).select(F.col("fp").alias("f"), "component_id")
    return marked.join(unsent(named), F.col("fp") == F.col("f")).select("doc_id", "fp", "component_id")


def hexed(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame, max_bits: int = MAX_BITS, width: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group, with all columns: that of the smallest doc_id (a null one only where there is no other).

    Of several rows with this doc_id the one with the smallest text hash stays, of equal rows any one.
    """
    marked = stored(fingerprints(docs, width, id_col, text_col), "fingerprints")
    chosen = stored(_rooted(marked, max_bits).groupBy("root").agg(F.min("first").alias("first")).select("first.doc_id", "first.tie"), "chosen")
    i, t = fresh(docs, "_chosen_id"), fresh(docs, "_chosen_tie")
    here = quoted(id_col).cast("long").eqNullSafe(quoted(i)) & F.xxhash64(quoted(text_col)).eqNullSafe(quoted(t))
    kept = docs.join(unsent(chosen.toDF(i, t)), here, "left_semi")
    times = marked.groupBy("doc_id", "tie").agg(F.count("*").alias("n")).where(F.col("n") > 1).alias("m")
    several = times.join(unsent(chosen).alias("c"), F.col("m.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("m.tie") == F.col("c.tie")), "left_semi")
    several = stored(several.select("doc_id", "tie").toDF(i, t), "repeated")
    if several.isEmpty():
        return kept
    one = kept.join(unsent(several), here, "left_semi").withColumn(i, quoted(id_col).cast("long")).withColumn(t, F.xxhash64(quoted(text_col)))
    return kept.join(unsent(several), here, "left_anti").unionByName(one.dropDuplicates([i, t]).drop(i, t))
