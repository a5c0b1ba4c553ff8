"""SimHash fingerprints of documents."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import id_and_text, slices

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))  # A-Z alone; other bytes stay
_hash = partial(xxhash.xxh64_intdigest, seed=42)


def shingles(text: str, width: int = 3) -> list[bytes]:
    """Runs of ``width`` words, repeats included; all words where there are fewer; none without words."""
    words = text.encode().translate(_LOWER).split()
    if len(words) <= width:
        return [b" ".join(words)] if words else []
    return [b" ".join(run) for run in zip(*(words[i:] for i in range(width)))]


_LONG_TEXT = 1 << 20  # characters above which a text is hashed piece by piece
_WORDS_AT_ONCE = 50_000


def _bits(hashes: np.ndarray) -> np.ndarray:
    return np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _long_fingerprint(text: str, width: int) -> np.uint64:
    """The fingerprint of one long text with few shingles held at a time."""
    words = text.encode().translate(_LOWER).split()
    sums, n = np.zeros(64, dtype=np.int64), 0
    for at in range(0, max(len(words) - width + 1, 1) if words else 0, _WORDS_AT_ONCE):
        runs = zip(*(words[at + i : at + i + _WORDS_AT_ONCE] for i in range(width))) if len(words) > width else [words]
        hashes = np.fromiter((_hash(b" ".join(run)) for run in runs), dtype="<u8")
        sums += _bits(hashes).sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return np.packbits((2 * sums > n).astype(np.uint8), bitorder="little").view("<u8")[0]


def fingerprints_of(texts: list[str], width: int = 3) -> np.ndarray:
    """64-bit fingerprint of each text: a bit is set if it is in over half of the shingles' hashes."""
    if any(len(t) > _LONG_TEXT for t in texts):
        return np.array([_long_fingerprint(t, width) for t in texts], dtype=np.uint64)
    parts = [shingles(t, width) for t in texts]
    counts = np.array([len(p) for p in parts], dtype=np.int64)
    out = np.zeros(len(texts), dtype=np.uint64)
    used = counts > 0
    if not used.any():
        return out
    hashes = np.fromiter(map(_hash, chain.from_iterable(parts)), dtype="<u8", count=int(counts.sum()))
    bits = _bits(hashes)
    starts = np.concatenate([[0], np.cumsum(counts[used])[:-1]])
    sums = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
    majority = (2 * sums > counts[used][:, None]).astype(np.uint8)
    out[used] = np.packbits(majority, axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprints(docs: DataFrame, width: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, tie, fp): fingerprint as a signed long, and a hash of the text to tell rows with equal ids apart.

    Null text has no words and so fingerprint 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1, 1 << 18):
            found = fingerprints_of(batch.column(1).fill_null("").to_pylist(), width)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found.view(np.int64))], ["doc_id", "tie", "fp"])

    rows = id_and_text(docs, id_col, text_col).withColumn("tie", F.xxhash64("text"))
    return rows.mapInArrow(run, "doc_id long, tie long, fp long")
