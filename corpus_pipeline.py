"""Corpus cleaning pipeline: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import hyper_profiles, line_spread, multi_index, piece_codec, window_join
from ledgerloom.llm.common import fresh, quoted, table
from ledgerloom.storage import new_folder, stored


LOW_SHARE = 0.001  # share of each language's calibration rows that may lie below its least cosine


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language can be told; texts without a letter (or null) go, and those far from every language.

    The least cosine of a language is a low quantile over all labelled rows that are not held out and
    that get this language.  A language that none of them gets has no least cosine.
    """
    name, score = fresh(docs, "_language"), fresh(docs, "_score")
    found = stored(hyper_profiles.predict(docs, hyper_profiles.learn(docs), lang_name=name, score_name=score), "languages")
    told = found.where(quoted(name) != "und")
    known = told.where(~hyper_profiles.held_out() & F.col("lang").isNotNull())
    low = known.groupBy(quoted(name).alias("lang")).agg(F.percentile_approx(quoted(score), LOW_SHARE, 100_000).alias("least"))
    least = {r["lang"]: r["least"] for r in low.collect()}  # one row a language
    if least:
        bound = F.create_map(*[F.lit(x) for pair in least.items() for x in pair])
        told = told.where(quoted(score) >= F.coalesce(F.try_element_at(bound, quoted(name)), F.lit(0.0)))
    return told.select(*map(quoted, docs.columns))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines leave the texts; ``n_chars`` follows where a text has changed."""
    count = fresh(docs, "_removed")
    done = line_spread.dedup(docs, count_col=count)
    changed = F.when(quoted(count) > 0, F.char_length("text").cast("long")).otherwise(quoted("n_chars"))
    return done.select(*[changed.alias(c) if c == "n_chars" else quoted(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id."""
    return multi_index.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with words of a benchmark window go."""
    return window_join.clean(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and hashes of the documents that are left."""
    return piece_codec.digest(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("language ID", language_id),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("SentencePiece encoding and decoding", encode),
]

ORACLE_SQL = None  # SQL can't express the stages; tests hold them against plain versions


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        path = new_folder(spark, f"stage-{number}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
