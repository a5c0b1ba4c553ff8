"""Registered queries of the corpus operators: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import byte_codec, feistel_shards, hyper_profiles, impact_grid, isolation_rules, license_scan, line_spread, multi_index, piece_codec, separator_scan, token_table, turn_repair, window_join
from ledgerloom.llm.common import table
from ledgerloom.storage import new_folder

END_OF_DOCUMENT = 49408  # first id behind the word_bpe_49k vocabulary: no text gives it, not even a literal '<|endoftext|>' (49407)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def sql() -> dict[str, str]:
    return {
        "op2_feistel_shards": feistel_shards.sql(),
        "op4_line_spread": line_spread.sql(),
        "op7_window_join": window_join.sql(),
        "op12_turn_repair": turn_repair.sql(),
        "op13_impact_grid": impact_grid.sql(),
    }


@query
def op1_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "flat")
    return separator_scan.counts(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"), END_OF_DOCUMENT)


@query
def op2_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feistel_shards.placement(table(spark, sf_dir, "documents"))


@query
def op3_token_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "tokens")
    token_table.write(token_table.tokenized(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2), path)
    return token_table.digest(spark, path)


@query
def op4_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_spread.dedup(table(spark, sf_dir, "documents").select("doc_id", "text", "source")).drop("source")


@query
def op5_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.digest(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


@query
def op7_window_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_join.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op8_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = multi_index.groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", multi_index.hexed(found["fp"]).alias("fingerprint"), "component_id")


@query
def op9_hyper_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyper_profiles.identify(table(spark, sf_dir, "documents"))


@query
def op10_isolation_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return isolation_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op11_byte_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_codec.digest(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


@query
def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.report(table(spark, sf_dir, "conversations"))


@query
def op13_impact_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return impact_grid.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
