"""Byte-level BPE encoding by overlapping chunks, and decoding (operator 11).

Texts are cut into chunks that reach a little into the next one, and all chunks are pre-tokenised in
parallel.  A chunk that starts inside a pre-token may cut wrongly at first.  Where its boundaries and
those of the chunk before first agree, both go on alike, as a match of the pattern depends only on
the text from its start on; so that place is where the two are stitched.  Then the pieces between two
such places are encoded by the ranks, again in parallel, and the ids of a text are joined.

Only a boundary that can't change with the text behind the chunk counts for the chunk before, which is
one that ends two characters or more before the chunk's end.  A text with two chunks that agree nowhere
in their overlap (a pre-token longer than that) is scanned as one piece.  A text of one chunk needs no
stitching and never leaves its task.

Null text counts as empty; repeated rows stay, and equal long rows are encoded once; null ids pass through.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import WordCache, id_and_text, slices
from ledgerloom.llm.word_tokens import list_array
from ledgerloom.storage import stored

CHUNK = 1 << 15  # characters
OVERLAP = 1 << 10
_TOKENS = "doc_id long, ids array<int>"
# What public_tokenizers.PATTERN cuts, where the classes of Python's own engine are right.
_PLAIN = re.compile(r""" ?[^\W\d_]+|'(?:s|t|re|ve|m|ll|d)| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+""")


_EVERY = "".join(chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000)


def _members(name: str) -> set[str]:
    """All characters of a class, as the tokenizer's library has it; its tables differ from Python's by version."""
    single = {bytes([b]): b for b in range(256)}
    found = tiktoken.Encoding("class", pat_str=name, mergeable_ranks=single, special_tokens={}).encode_ordinary(_EVERY)
    return set(bytes(found).decode())


def _ranges(chars: set[str]) -> str:
    """``chars`` as the inside of a character class."""
    points = np.array(sorted(map(ord, chars)))
    first = points[np.concatenate([[True], np.diff(points) > 1])]
    last = points[np.concatenate([np.diff(points) > 1, [True]])]
    return "".join(f"\\U{a:08X}-\\U{b:08X}" for a, b in zip(first.tolist(), last.tolist()))


class Cutter:
    """Pre-tokens of a text: the matches of public_tokenizers.PATTERN, which leave no character out."""

    def __init__(self) -> None:
        letters, numbers, spaces = (_members(c) for c in (r"\p{L}", r"\p{N}", r"\s"))
        own = [set(re.findall(c, _EVERY)) for c in (r"[^\W\d_]", r"\d", r"\s")]
        odd = (letters ^ own[0]) | (numbers ^ own[1]) | (spaces ^ own[2])
        self.odd = odd
        self.odd_ascii = [c for c in odd if c.isascii()]
        pattern = public_tokenizers.PATTERN
        for name, chars in ((r"\p{L}", letters), (r"\p{N}", numbers)):
            pattern = pattern.replace(f"[^\\s\\p{{L}}\\p{{N}}]", f"[^\\s{_ranges(letters | numbers)}]").replace(name, f"[{_ranges(chars)}]")
        self.exact = regex.compile(pattern)

    def __call__(self, text: str) -> list[str]:
        if text.isascii():
            odd = any(c in text for c in self.odd_ascii)
        else:
            odd = not self.odd.isdisjoint(text)
        return (self.exact if odd else _PLAIN).findall(text)


@lru_cache(maxsize=1)
def cutter() -> Cutter:
    return Cutter()


def boundaries(words: list[str]) -> np.ndarray:
    """Where the pre-tokens begin and end; 0 first."""
    return np.cumsum([0, *map(len, words)])


class ByteEncoder:
    """Ids of pre-tokens by merge ranks, each new one once while it is kept, and their bytes back."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.bytes = {i: token for token, i in ranks.items()}
        # The merges of one pre-token; as a text of its own it is cut no further.
        merges = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.words = WordCache(lambda words: [np.array(merges(w), "<i4").tobytes() for w in words], 200_000)

    def packed(self, cut: list[list[str]]) -> list[bytes]:
        """32-bit ids of texts that are cut already."""
        known = self.words.of(set().union(*cut))
        return [b"".join([known[w] for w in words]) for words in cut]

    def raw(self, ids: list[int]) -> bytes:
        return b"".join([self.bytes[i] for i in ids])


@lru_cache(maxsize=2)
def _encoder(path: str) -> ByteEncoder:
    return ByteEncoder(path)


def _with_bytes(encoder: ByteEncoder, doc_ids: pa.Array, ids: pa.ListArray) -> pa.RecordBatch:
    ends, values = ids.offsets.to_numpy(), ids.values.to_numpy()
    raw = [encoder.raw(values[a:b].tolist()) if k else None for a, b, k in zip(ends, ends[1:], ids.is_valid().to_pylist())]
    return pa.RecordBatch.from_arrays([doc_ids, ids, pa.array(raw, pa.binary())], ["doc_id", "ids", "raw"])


def decode(tokens: DataFrame, ranks: str) -> DataFrame:
    """``tokens`` (doc_id, ids) with ``raw``, the bytes of the ids one behind the other; null ids give null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(ranks)
        for batch in batches:
            yield _with_bytes(encoder, batch.column(0), batch.column(1))

    return tokens.select("doc_id", "ids").mapInArrow(run, f"{_TOKENS}, raw binary")


def _short(rows: DataFrame, ranks: str, with_bytes: bool) -> DataFrame:
    """Texts of one chunk, encoded where they are read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, cut = _encoder(ranks), cutter()
        for batch in slices(batches, 1):
            ids = list_array(encoder.packed([cut(t) for t in batch.column(1).to_pylist()]))
            yield _with_bytes(encoder, batch.column(0), ids) if with_bytes else pa.RecordBatch.from_arrays([batch.column(0), ids], ["doc_id", "ids"])

    return rows.mapInArrow(run, f"{_TOKENS}, raw binary" if with_bytes else _TOKENS)


def _chunks(rows: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """(key, k, doc_id, body, ahead, copies): the chunks of long texts, spread over the tasks; ``ahead`` is the overlap."""
    keyed = rows.withColumn("key", F.sha2(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "text"), 256))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            for doc_id, text, key in zip(*(c.to_pylist() for c in batch.columns)):
                at = range(0, len(text), chunk)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key] * len(at)), pa.array(range(len(at)), pa.int32()), pa.array([doc_id] * len(at), pa.int64()),
                     pa.array([text[i : i + chunk] for i in at]), pa.array([text[i + chunk : i + chunk + overlap] for i in at])],
                    ["key", "k", "doc_id", "body", "ahead"],
                )

    cut = keyed.mapInArrow(run, "key string, k int, doc_id long, body string, ahead string")
    # Equal rows (same id and text) become one, with their number.
    return cut.groupBy("key", "k").agg(*[F.first(c).alias(c) for c in ("doc_id", "body", "ahead")], F.count("*").alias("copies"))


def _ends(chunks: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """(key, k, head, tail): boundaries in the first and in the last ``overlap`` characters of each chunk.

    Both count from where the chunk, or the next one, begins.  ``tail`` has only those that stand fast.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = cutter()
        for batch in slices(batches, 2):
            heads, tails = [], []
            for body, ahead in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                found = boundaries(cut(body + ahead))
                heads.append(found[found <= overlap].tolist())
                firm = found if len(ahead) < overlap else found[found <= len(body) + len(ahead) - 2]
                tails.append((firm[firm >= chunk] - chunk).tolist())
            lists = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(heads, lists), pa.array(tails, lists)], ["key", "k", "head", "tail"])

    return chunks.select("key", "k", "body", "ahead").mapInArrow(run, "key string, k int, head array<int>, tail array<int>")


def stitched(chunks: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """(key, k, start, end, whole): the part of each chunk that counts, from its start; no end: to the text's end.

    ``whole``: some chunk of the text agrees nowhere with the one before.
    """
    order = Window.partitionBy("key").orderBy("k")
    agreed = F.array_min(F.array_intersect("head", F.lag("tail").over(order)))
    found = _ends(chunks, chunk, overlap).select("key", "k", F.when(F.col("k") == 0, 0).otherwise(agreed).alias("start"))
    end = F.lead("start").over(order) + F.lit(chunk)
    return found.select("key", "k", "start", end.alias("end"), F.max(F.col("start").isNull()).over(Window.partitionBy("key")).alias("whole"))


def _long(rows: DataFrame, ranks: str, chunk: int, overlap: int) -> DataFrame:
    """(doc_id, ids) of texts of several chunks."""
    chunks = stored(_chunks(rows, chunk, overlap), "chunks")
    placed = chunks.join(stored(stitched(chunks, chunk, overlap), "stitches"), ["key", "k"])
    fields = ["key", "k", "doc_id", "copies", "body", "ahead", "start", "end"]
    # A text that can't be stitched is put together again and is one piece.
    whole = placed.where("whole").groupBy("key").agg(F.first("doc_id").alias("doc_id"), F.first("copies").alias("copies"), F.sort_array(F.collect_list(F.struct("k", "body"))).alias("parts"))
    whole = whole.select("key", F.lit(0).alias("k"), "doc_id", "copies", F.array_join("parts.body", "").alias("body"), F.lit("").alias("ahead"), F.lit(0).alias("start"), F.lit(None).cast("int").alias("end"))
    pieces = placed.where("NOT whole").select(*fields).union(whole.select(*fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, cut = _encoder(ranks), cutter()
        for batch in slices(batches, 4):
            words = []
            for body, ahead, start, end in zip(*(c.to_pylist() for c in batch.columns[4:])):
                text = (body + ahead)[start:]  # with the overlap, as the last pieces depend on what follows them
                found = cut(text)
                words.append(found[: int(np.searchsorted(boundaries(found), len(text) if end is None else end - start))])
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], list_array(encoder.packed(words))], [*fields[:4], "ids"])

    coded = pieces.mapInArrow(run, "key string, k int, doc_id long, copies long, ids array<int>")
    joined = coded.groupBy("key").agg(F.first("doc_id").alias("doc_id"), F.first("copies").alias("copies"), F.sort_array(F.collect_list(F.struct("k", "ids"))).alias("parts"))
    each = joined.select("doc_id", F.flatten("parts.ids").alias("ids"), F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"))
    return each.drop("copy")


def _split(docs: DataFrame, id_col: str, text_col: str, chunk: int) -> tuple[DataFrame, DataFrame]:
    rows = id_and_text(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    return rows.where(F.char_length("text") <= chunk), rows.where(F.char_length("text") > chunk)


def encode(docs: DataFrame, ranks: str, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(doc_id, ids) of each whole text; ``ranks`` is the path of the rank file."""
    short, long = _split(docs, id_col, text_col, chunk)
    return _short(short, ranks, False).union(_long(long, ranks, chunk, overlap))


def round_trip(docs: DataFrame, ranks: str, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(doc_id, ids, raw): :func:`encode` and :func:`decode`; texts of one chunk take one step for both."""
    short, long = _split(docs, id_col, text_col, chunk)
    return _short(short, ranks, True).union(decode(_long(long, ranks, chunk, overlap), ranks))


def digest(docs: DataFrame, ranks: str) -> DataFrame:
    """Length and hash of each document's ids, and hash of the bytes that they decode to."""
    return round_trip(docs, ranks).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("raw", 256).alias("decoded_sha256"),
    )
