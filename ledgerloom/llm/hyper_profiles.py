"""Language identification with hyperdimensional profiles (operator 9).

Every letter has a random vector of +1 and -1.  A trigram binds its letters: the vectors, turned by
two, one and no places, are multiplied.  A text bundles (adds) its trigrams, a language the trigrams
of its learning texts, and a text gets the language with the greatest cosine.

The vector of a trigram follows from its letters, so a slice of texts is one product of trigram
counts and trigram vectors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import append, quoted, slices

DIMENSIONS = 1024
MAX_LEARNING_ROWS = 60_000  # labelled rows that the profiles learn from, chosen by a hash of the id
GAP = 32  # stands for everything between words
_TEXTS_AT_ONCE = 128
_CHARS_AT_ONCE = 200_000  # bounds the table of counts by text and trigram; a longer text stands alone
_TRIGRAMS_AT_ONCE = 8192  # bounds the table of trigram vectors


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


@lru_cache(maxsize=100_000)
def _letter_vector(code: int) -> np.ndarray:
    random = np.random.Generator(np.random.Philox(key=code))
    return (random.integers(0, 2, DIMENSIONS, dtype=np.int8) * 2 - 1).astype(np.int8)


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(letters of each trigram, counts by text and trigram, whether a text has a letter)."""
    raw = [f" {t.lower()} ".encode("utf-32-le", "surrogatepass") for t in texts]
    codes = np.frombuffer(b"".join(raw), dtype="<u4")
    owner = np.repeat(np.arange(len(texts)), [len(r) // 4 for r in raw])
    is_letter = _letters()[codes]
    lettered = np.bincount(owner, weights=is_letter, minlength=len(texts)) > 0
    symbols = np.where(is_letter, codes, GAP)
    double = np.zeros(len(symbols), dtype=bool)
    double[1:] = (symbols[1:] == GAP) & (symbols[:-1] == GAP) & (owner[1:] == owner[:-1])
    symbols, owner = symbols[~double], owner[~double]
    alphabet, place = np.unique(symbols, return_inverse=True)
    k = len(alphabet)
    same = owner[2:] == owner[:-2] if len(owner) > 2 else np.zeros(0, dtype=bool)
    names = (place[:-2].astype(np.int64) * k + place[1:-1]) * k + place[2:] if len(owner) > 2 else np.zeros(0, dtype=np.int64)
    names, owner = names[same], owner[2:][same] if len(owner) > 2 else owner[:0]
    if 0 < k**3 <= 1 << 22:
        flags = np.zeros(k**3, dtype=np.int32)
        flags[names] = 1
        used = np.flatnonzero(flags)
        flags[used] = np.arange(len(used))
        index = flags[names]
    else:
        used, index = np.unique(names, return_inverse=True)
    counts = np.bincount(owner * max(len(used), 1) + index, minlength=len(texts) * len(used)).reshape(len(texts), len(used))
    spelled = np.stack([alphabet[used // (k * k)], alphabet[used // k % k], alphabet[used % k]], axis=1) if len(used) else np.zeros((0, 3), dtype=np.int64)
    return spelled, counts, lettered


def trigram_vectors(spelled: np.ndarray) -> np.ndarray:
    codes, place = np.unique(spelled, return_inverse=True)
    if not len(codes):
        return np.zeros((0, DIMENSIONS), dtype=np.float32)
    letters = np.stack([_letter_vector(int(c)) for c in codes])
    place = place.reshape(-1, 3)
    bound = np.roll(letters, 2, axis=1)[place[:, 0]] * np.roll(letters, 1, axis=1)[place[:, 1]] * letters[place[:, 2]]
    return bound.astype(np.float32)


def bundle(spelled: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of the trigram vectors of each row of ``counts``."""
    total = np.zeros((len(counts), DIMENSIONS), dtype=counts.dtype)
    for at in range(0, len(spelled), _TRIGRAMS_AT_ONCE):
        part = slice(at, at + _TRIGRAMS_AT_ONCE)
        total += counts[:, part] @ trigram_vectors(spelled[part]).astype(counts.dtype, copy=False)
    return total


def _groups(texts: list[str]) -> Iterator[list[str]]:
    group: list[str] = []
    size = 0
    for text in texts:
        if group and (len(group) == _TEXTS_AT_ONCE or size + len(text) > _CHARS_AT_ONCE):
            yield group
            group, size = [], 0
        group.append(text)
        size += len(text)
    if group:
        yield group


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that are never learned from: a remainder of 2, or no id."""
    return F.coalesce(F.crc32(quoted(id_col).cast("string")) % 4 == 2, F.lit(True))


def learn(docs: DataFrame, most: int = MAX_LEARNING_ROWS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict[str, np.ndarray]:
    """Profile of each language, from rows that are not held out and have a language and a text.

    Where there are more than ``most`` such rows, those with the lowest hash of the id count, about
    ``most`` of them.  The driver gets one vector per language.
    """
    rows = docs.where(~held_out(id_col) & quoted(lang_col).isNotNull() & quoted(text_col).isNotNull())
    total = rows.count()
    if total > most:
        rows = rows.where(F.pmod(F.xxhash64(quoted(id_col)), F.lit(1 << 20)) < int((1 << 20) * most / total))
    rows = rows.select(quoted(lang_col).cast("string").alias("lang"), quoted(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in slices(batches, 1):
            langs = batch.column(0).to_pylist()
            names = sorted(set(langs))
            by_lang = [" ".join(t for t, x in zip(batch.column(1).to_pylist(), langs) if x == name) for name in names]
            spelled, counts, _ = trigrams(by_lang)
            for name, vector in zip(names, bundle(spelled, counts.astype(np.float64))):
                sums[name] = sums.get(name, 0) + vector
        for name, vector in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * DIMENSIONS), pa.array(range(DIMENSIONS), pa.int32()), pa.array(vector.astype(np.int64))],
                ["lang", "at", "value"],
            )

    bundled = rows.mapInArrow(run, "lang string, at int, value long").groupBy("lang", "at").agg(F.sum("value").alias("value"))
    by_lang = bundled.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("at", "value"))).alias("vector")).select("lang", "vector.value")
    return {r["lang"]: np.array(r["value"], dtype=np.float64) for r in by_lang.collect()}


def _judge(profiles: dict[str, np.ndarray]) -> Callable[[list[str | None]], list]:
    names = sorted(n for n, v in profiles.items() if np.any(v))
    matrix = np.stack([profiles[n] / np.linalg.norm(profiles[n]) for n in names]).astype(np.float32) if names else np.zeros((0, DIMENSIONS), np.float32)

    def judge(texts: list[str | None]) -> list:
        found: list[str] = []
        scores: list[float] = []
        for group in _groups([t or "" for t in texts]):
            spelled, counts, lettered = trigrams(group)
            vectors = bundle(spelled, counts.astype(np.float32))
            size = np.linalg.norm(vectors, axis=1)
            cosines = (vectors @ matrix.T) / np.where(size > 0, size, 1)[:, None]
            for has, row in zip(lettered, cosines):
                best = int(row.argmax()) if has and names else -1
                found.append(names[best] if best >= 0 else "und")
                scores.append(float(min(1.0, max(0.0, row[best]))) if best >= 0 else 0.0)
        return [found, scores]

    return judge


def predict(docs: DataFrame, profiles: dict[str, np.ndarray], text_col: str = "text", lang_name: str = "lang_pred", score_name: str = "score") -> DataFrame:
    """``docs`` with the language of each whole text and its cosine (0 to 1).

    Null texts, texts without a letter, and all texts where nothing was learned are ``und`` with 0; among
    equal cosines the first name wins.
    """
    return append(docs, text_col, f"`{lang_name}` string, `{score_name}` double", lambda: _judge(profiles))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row."""
    profiles = learn(docs, id_col=id_col, text_col=text_col, lang_col=lang_col)
    rows = docs.select(quoted(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), quoted(text_col).alias("text"))
    return predict(rows, profiles).drop("text")
