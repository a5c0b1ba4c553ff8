"""Generic readers for messy text files."""

from __future__ import annotations

import csv
from collections.abc import Callable, Sequence
from functools import reduce
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.text import null_token
from ledgerloom.functions.dates import parse_ts
from ledgerloom.operators.maintenance import quarantine
from ledgerloom.sources.heads import decode, file_heads
from ledgerloom.storage import checkpoint_dir, stored


def allow_encoding(spark: SparkSession, encoding: str) -> None:
    """Spark accepts character sets outside its short list only with this switch."""
    if encoding.upper() not in ("UTF-8", "UTF-16", "US-ASCII", "ISO-8859-1"):
        spark.conf.set("spark.sql.legacy.javaCharsets", "true")


def read_delimited(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: T.StructType,
    sep: str = ",",
    encoding: str = "UTF-8",
    multi_line: bool = False,
    **options: str,
) -> DataFrame:
    """Headed CSV/TSV with a declared schema, read by position; plus ``FILE_NAME``.

    A record that doesn't fit the schema fails the read; :func:`read_delimited_apart` keeps such records
    aside instead.  Quoted line breaks need ``multi_line``, which reads each file in one task.
    """
    reader = _delimited(spark, sep, encoding, multi_line, options).schema(columns).option("mode", "FAILFAST")
    return reader.csv(path).select("*", F.col("_metadata.file_name").alias("FILE_NAME"))


def read_delimited_apart(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: T.StructType,
    sep: str = ",",
    encoding: str = "UTF-8",
    multi_line: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(typed good rows, rows with an unreadable value as they came), both with ``FILE_NAME``."""
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in columns.fields])
    rows = _delimited(spark, sep, encoding, multi_line, {}).schema(text).csv(path)
    named = rows.select("*", F.col("_metadata.file_name").alias("FILE_NAME"))
    return quarantine(named, T.StructType([*columns.fields, T.StructField("FILE_NAME", T.StringType())]))


def _delimited(spark: SparkSession, sep: str, encoding: str, multi_line: bool, options: dict[str, str]) -> DataFrameReader:
    allow_encoding(spark, encoding)
    reader = spark.read.option("sep", sep).option("header", True).option("enforceSchema", True).option("encoding", encoding)
    return reader.option("multiLine", multi_line).option("escape", '"').options(**options)


def _header_groups(spark: SparkSession, path: str | Sequence[str], encodings: Sequence[str]) -> list[tuple[bytes, list[str], list[str]]]:
    """(first line, encodings that fit, files) of the files that share both; the driver gets file names, which it lists for any read anyway."""
    heads = file_heads(spark, path, encodings).groupBy("head", "encodings").agg(F.collect_list("file").alias("files"))
    return sorted((bytes(r["head"]), r["encodings"], sorted(unquote(f) for f in r["files"])) for r in heads.collect())


def _header(head: bytes, fitting: Sequence[str], expect: str | None) -> tuple[str, str]:
    """(header, encoding): the first encoding that fits the file and, if asked, shows ``expect`` in its header."""
    for encoding in fitting:
        text = decode(head, encoding).lstrip("\ufeff")
        if expect is None or expect in text:
            return text, encoding
    raise ValueError(f"no encoding fits a file that begins with {head[:80]!r}")


def _names(cells: Sequence[str]) -> list[str]:
    """Header names, repeated ones told apart by their place."""
    return [f"{c}{i}" if cells.index(c) != i else c for i, c in enumerate(cells)]


def read_headed_text(
    spark: SparkSession,
    path: str | Sequence[str],
    sep: str,
    encoding: str | Sequence[str],
    expect: str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Headed files with every column as text under its own header name; plus ``FILE_NAME``.

    Each file goes by its own header, so files may differ in columns and their order; a column that a file
    lacks is NULL there.  Of several encodings a file gets the first that fits its header and samples of its
    body and, if ``expect`` is given, shows that name in the header.
    """
    encodings = [encoding] if isinstance(encoding, str) else list(encoding)
    parts = []
    for head, fitting, files in _header_groups(spark, path, encodings):
        text, own = _header(head, fitting, expect)
        names = _names(next(csv.reader([text], delimiter=sep), []))
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        reader = _delimited(spark, sep, own, multi_line, {}).schema(schema)
        parts.append(reader.csv(files).select("*", F.col("_metadata.file_name").alias("FILE_NAME")))
    if not parts:
        raise ValueError(f"no files under {path}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def numbered_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Lines with a position that follows their order within a file.  Eager: one checkpoint.

    Large files are still split among tasks.  A position is (block start, row number of the
    scan); the checkpoint fixes it, because another scan could be cut into other blocks.
    """
    checkpoint_dir(spark)
    return (
        spark.read.text(path)
        .select(
            F.col("_metadata.file_name").alias("FILE_NAME"),
            F.col("_metadata.file_path").alias("file_path"),
            F.struct(
                F.col("_metadata.file_block_start").alias("block"),
                F.monotonically_increasing_id().alias("row"),
            ).alias("pos"),
            F.regexp_replace("value", "^﻿|\r$", "").alias("line"),
        )
        .checkpoint()
    )


class Fact(NamedTuple):
    """Something about a file that comes together from its blocks: an aggregate over lines, and one over the blocks' values."""

    of_block: Column
    merged: Callable[[Column], Column]


def first_line(condition: Column) -> Fact:
    """(pos, line) of the first line that meets the condition."""
    return Fact(F.min(F.when(condition, F.struct("pos", "line"))), F.min)


def greatest(value: Column) -> Fact:
    return Fact(F.max(value), F.max)


def per_file(lines: DataFrame, facts: dict[str, Fact], derived: dict[str, Column] | None = None) -> DataFrame:
    """Attach facts about each file to its lines, by block: a large file's lines stay spread over its blocks.

    One row per block is stored; the files' facts come from these rows, go back to them, and only then meet
    the lines, in one join on file and block.  ``derived`` columns are computed from the facts, once per file.
    """
    block = F.col("pos.block")
    blocks = lines.groupBy(F.col("file_path").alias("_path"), block.alias("_block")).agg(*[f.of_block.alias(n) for n, f in facts.items()])
    blocks = stored(blocks, "blocks")
    files = blocks.groupBy("_path").agg(*[f.merged(F.col(n)).alias(n) for n, f in facts.items()])
    for name, column in (derived or {}).items():
        files = files.withColumn(name, column)
    known = blocks.select("_path", "_block").join(files, "_path")
    return lines.join(known, (F.col("file_path") == F.col("_path")) & (block == F.col("_block"))).drop("_path", "_block")


def _sections_of(marks: Column) -> dict[str, Column]:
    """Bounds of two sections among marks (pos, total, line) in order: each starts behind a header and ends at a total.

    ``main`` is the first header, ``total`` the first total, ``coupon`` the first header behind that, ``end`` the
    first total behind that; ``other`` the first total behind the first header.
    """
    def first(total: bool, behind: Column | None = None) -> Column:
        def wanted(mark: Column) -> Column:
            kind = mark["total"] if total else ~mark["total"]
            return kind if behind is None else kind & (mark["pos"] > behind["pos"])

        return F.get(F.filter(marks, wanted), 0)

    found = {"main": first(False), "total": first(True)}
    found["coupon"] = first(False, found["total"])
    return found | {"end": first(True, found["coupon"]), "other": first(True, found["main"])}


def section_marks(is_header: Column, is_total: Column) -> Fact:
    """The marks of a file that bound its two sections.

    A block keeps at most five of its marks, whatever state the blocks before it leave the file in: its first
    header and total, and what follows each.
    """
    mark = F.when(is_header | is_total, F.struct("pos", is_total.alias("total"), "line"))

    def kept(marks: Column) -> Column:
        return F.array_compact(F.array(*_sections_of(F.array_sort(marks)).values()))

    return Fact(kept(F.collect_list(mark)), lambda column: F.array_sort(F.flatten(F.collect_list(column))))


def sections(marks: str) -> dict[str, Column]:
    """Bounds of the sections from the column of :func:`section_marks`."""
    return {name: mark for name, mark in _sections_of(F.col(marks)).items() if name != "other"}


_QUOTED_CELLS = r'(?:^|,)("(?:[^"]|"")*"|[^,"]*)'


def split_cells(line: Column, sep: str) -> Column:
    """Cells of a line in one pass; comma cells may be quoted and then hold commas."""
    if sep != ",":
        return F.split(line, sep)
    cells = F.regexp_extract_all(line, F.lit(_QUOTED_CELLS), F.lit(1))

    def unquote(cell: Column) -> Column:
        inner = F.replace(cell.substr(F.lit(2), F.length(cell) - 2), F.lit('""'), F.lit('"'))
        return F.when(F.startswith(cell, F.lit('"')), inner).otherwise(cell)

    return F.transform(cells, unquote)


def typed(column: Column, data_type: T.DataType, formats: Sequence[str] = ()) -> Column:
    """Read a text value as the declared type; NULL where that fails."""
    if isinstance(data_type, T.TimestampNTZType) and formats:
        return parse_ts(column, formats)
    if isinstance(data_type, T.LongType):
        return F.coalesce(column.try_cast("bigint"), column.try_cast("double").try_cast("bigint"))
    return column.try_cast(data_type)


def read_preamble(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: T.StructType,
    header_key: str,
    sep: str = "\t",
    nulls: Sequence[str] = (),
    formats: Sequence[str] = (),
    facts: dict[str, Fact] | None = None,
) -> DataFrame:
    """Delimited files with a preamble of any length before the header line.

    The header is the first line that contains ``header_key``.  Columns are found by the
    header of each file, so optional columns may be missing and files may differ.  ``facts``
    about each file are kept as columns.
    """
    wanted = [f.name for f in columns.fields]
    lines = numbered_lines(spark, path)
    header = first_line(F.contains(F.col("line"), F.lit(header_key)))

    def clean_header(name: Column) -> Column:
        return F.replace(F.lower(F.trim(F.replace(name, F.lit(","), F.lit("")))), F.lit("-"), F.lit("_"))

    names = F.transform(split_cells(F.col("_header.line"), sep), clean_header)
    places = F.struct(*[F.array_position("_names", n).alias(n) for n in wanted])
    rows = (
        per_file(lines, {"_header": header, **(facts or {})}, {"_names": names, "_places": places})
        .where((F.col("pos") > F.col("_header.pos")) & (F.trim("line") != ""))
        .withColumn("_cells", split_cells(F.col("line"), sep))
    )

    def column(field: T.StructField) -> Column:
        at = F.col(f"_places.{field.name}")
        raw = F.when(at > 0, F.get("_cells", (at - 1).cast("int")))
        raw = null_token(raw, nulls, fold_case=True) if nulls else raw
        return typed(raw, field.dataType, formats).alias(field.name)

    return rows.select(*[column(columns[n]) for n in wanted], *(facts or {}), "FILE_NAME")


def read_json_pages(
    spark: SparkSession, path: str | Sequence[str], key: str, document: str, page_per_file: bool = True
) -> DataFrame:
    """Rows of all landed API pages: each page holds a list of documents under ``key``.

    A page is a whole file, or one line of a file with ``page_per_file=False``.
    """
    pages = spark.read.schema(f"`{key}` array<struct<{document}>>").option("multiLine", page_per_file).json(path)
    return pages.select(F.explode(key).alias("_row")).select("_row.*")


def route_by_prefix(
    spark: SparkSession, folder: str, readers: dict[str, Callable[[SparkSession, str], DataFrame]]
) -> dict[str, DataFrame]:
    """Rows per file name prefix through the prefix's own reader; files of other prefixes stay unread."""
    return {prefix: reader(spark, f"{folder}/{prefix}*") for prefix, reader in readers.items()}
