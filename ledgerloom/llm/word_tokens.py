"""Token ids of texts through the tokenizers library, each new word encoded once per worker while it is kept."""

from __future__ import annotations

import os
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import WordCache, id_and_text


# The tokenizer's own cuts: runs of letters, contractions, single digits, runs of anything else but white space.
_ASCII_CUTS = re.compile(r"[a-z]+|'(?:[stmd]|[rv]e|ll)|[0-9]|[^a-z0-9\s]+")
_CUTS = re.compile(r"[^\W\d_]+|'(?:[sStTmMdD]|[rRvV][eE]|[lL][lL])|\d|(?:[^\w\s]|_)+")
# Texts with these are cut at plain white space only: special tokens, spaces that not everyone takes for white space,
# and the one letter whose lower case isn't letters alone.
_RARE = ["<|", "\u0130", *(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \t\n\r")]
_ASCII_RARE = [c for c in _RARE if c.isascii()]
_AT_ONCE = 20_000


class WordTokens:
    """Ids of a text for a word-end tokenizer that drops white space, so that its words can be encoded apart.

    Texts are cut where the tokenizer cuts them; what a cut leaves together the library cuts itself.  New words
    go to the library joined by spaces, many in one call, and come apart at the ids that end a word.
    """

    def __init__(self, path: str, dtype: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks share the cores already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = dtype
        known = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(known.values()) + 1, dtype=bool)
        for word, i in known.items():
            self.ends[i] = word.endswith("</w>")
        self.words = WordCache(self._encode, 600_000)  # kept from task to task, as most words of a task stand in others too

    def _alone(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, self.dtype).tobytes()

    def _encode(self, words: list[str]) -> list[bytes]:
        found: dict[str, bytes] = {}
        simple = [w for w in words if w.isalpha()]
        for at in range(0, len(simple), _AT_ONCE):
            part = simple[at : at + _AT_ONCE]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids)
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(part):  # a word has come out as several
                found.update((w, self._alone(w)) for w in part)
                continue
            packed, width = ids.astype(self.dtype).tobytes(), np.dtype(self.dtype).itemsize
            places = [0, *(stops * width).tolist()]
            found.update((w, packed[i:j]) for w, i, j in zip(part, places, places[1:]))
        return [found[w] if w in found else self._alone(w) for w in words]

    def _cut(self, text: str) -> list[str]:
        if text.isascii():
            if not any(c in text for c in _ASCII_RARE):
                return _ASCII_CUTS.findall(text.lower())
        elif not any(c in text for c in _RARE) and unicodedata.is_normalized("NFC", text):
            return _CUTS.findall(text)
        return text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")

    def encode(self, texts: list[str], end_id: int) -> list[bytes]:
        """Packed ids with ``end_id`` behind, per text."""
        cut = [self._cut(t) for t in texts]
        end, words = np.array([end_id], self.dtype).tobytes(), self.words.of(set().union(*cut))
        return [b"".join([words[w] for w in ws]) + end for ws in cut]


@lru_cache(maxsize=2)
def encoder(path: str, dtype: str) -> WordTokens:
    return WordTokens(path, dtype)


def in_order(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text) in ascending doc_id order over the partitions; equal ids by a hash of the text, nulls first."""
    rows = id_and_text(docs, id_col, text_col).withColumn("tie", F.xxhash64("text"))
    return rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text").drop("tie")


def texts_of(batch: pa.RecordBatch) -> list[str]:
    return batch.column(1).fill_null("").to_pylist()


def list_array(packed: list[bytes]) -> pa.ListArray:
    """Lists of 32-bit ids from their packed form."""
    ends = np.cumsum([0, *[len(p) // 4 for p in packed]]).astype("<i4")
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(packed), "<i4")))


def batches_of(rows: Iterator[tuple], names: list[str], types: list[pa.DataType], size: int = 5000) -> Iterator[pa.RecordBatch]:
    """Plain rows as record batches."""
    held: list[tuple] = []

    def batch() -> pa.RecordBatch:
        columns = zip(*held) if held else [[] for _ in names]
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names)

    for row in rows:
        held.append(row)
        if len(held) == size:
            yield batch()
            held = []
    if held:
        yield batch()
