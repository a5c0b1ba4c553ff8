"""SentencePiece encoding and decoding (operator 5).

A merge-type (BPE) vocabulary is encoded without running the merges over the text.  A sequence of
pieces is the encoding exactly if each neighbouring pair, merged anew on its own, gives that pair
back.  So the encoder takes the longest piece at each place (Aho-Corasick), checks it against its
left neighbour by re-merging the two (remembered per pair), and goes back one piece when no piece
fits, noting the place in a bitfield so that it is never tried again.

Text is cut before each run of spaces, and between letters and other characters, where the
vocabulary has no piece across such a cut; merges can't cross it either.  Each run is encoded once
per task while it stays in the bounded cache.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import WordCache, id_and_text, slices

SPACE = "▁"

class PieceEncoder:
    """Ids of a text under a SentencePiece BPE model with byte fallback."""

    def __init__(self, model_path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        ids = range(model.get_piece_size())
        special = [i for i in ids if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)]
        self.model = model
        self.end_id = model.eos_id()
        self.ids = {model.id_to_piece(i): i for i in set(ids) - set(special)}
        self.rank = {p: -model.get_score(i) for p, i in self.ids.items()}
        self.bytes = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.matcher = ahocorasick.Automaton()
        for piece in self.ids:
            self.matcher.add_word(piece, len(piece))
        self.matcher.make_automaton()
        # Where pieces have spaces in front only, and never letters beside other characters, no merge crosses these
        # cuts; characters of no piece may lie on either side.
        inner = [p.lstrip(SPACE) for p in self.ids]
        letters = re.escape("".join(sorted({c for p in inner for c in p if c.isalpha()})))
        spaced = all(SPACE not in p for p in inner)
        if spaced and letters and all(p.isalpha() or not any(map(str.isalpha, p)) for p in inner):
            self.cut = re.compile(f"{SPACE}*[{letters}]+|{SPACE}*[^{letters}{SPACE}]+|{SPACE}+").findall
        elif spaced:
            self.cut = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+").findall
        else:
            self.cut = lambda text: [text] if text else []
        self.packed = {p: np.array([i], "<i4").tobytes() for p, i in self.ids.items()}
        self.widest = max(map(len, self.ids))
        self.pairs: dict[tuple[str, str], bool] = {}
        self.prefixes: dict[str, str] = {}
        self.words = WordCache(lambda words: [self._ids(w) for w in words])

    def remerge(self, text: str) -> list[str]:
        """The plain merge procedure: always the best pair, the leftmost among equals."""
        parts, rank = list(text), self.rank
        while True:
            ranked = [(rank[pair], i) for i, pair in enumerate(map(str.__add__, parts, parts[1:])) if pair in rank]
            if not ranked:
                return parts
            best = min(ranked)[1]
            parts[best : best + 2] = [parts[best] + parts[best + 1]]

    def fits(self, left: str, right: str) -> bool:
        """Whether ``right`` can follow ``left`` ('': stand first)."""
        found = self.pairs.get((left, right))
        if found is None:
            if len(self.pairs) > 200_000:
                self.pairs.clear()
            found = self.pairs[left, right] = self.remerge(left + right) == ([left, right] if left else [right])
        return found

    def shorter(self, piece: str) -> str:
        """The longest piece, or single character, that is a proper prefix; remembered, as prefixes of pieces are few."""
        found = piece[:-1]
        while len(found) > 1 and found not in self.ids:
            found = found[:-1]
        self.prefixes[piece] = found
        return found

    def pieces(self, text: str) -> list[str]:
        """The encoding of ``text`` by backtracking."""
        n, pos, left = len(text), 0, ""
        pairs, out = self.pairs, []
        # The longest matches, one behind the other, up to the first that doesn't fit its neighbour.
        for last, length in self.matcher.iter_long(text):
            if last + 1 - length != pos:
                break
            piece = text[pos : last + 1]
            found = pairs.get((left, piece))
            if not (self.fits(left, piece) if found is None else found):
                break
            out.append(piece)
            pos, left = last + 1, piece
        failed = 0  # bitfield of the places from which the rest can't be encoded
        ids, prefixes, reach, widest = self.ids, self.prefixes, self.matcher.longest_prefix, self.widest
        piece = ""
        fresh = True  # no piece has been tried at this place yet
        while pos < n:
            if fresh:
                piece = text[pos : pos + widest]
                piece = piece[: reach(piece) or 1]
                if piece not in ids and len(piece) > 1:
                    piece = prefixes.get(piece) or self.shorter(piece)
            while piece:
                end = pos + len(piece)
                if not failed or not failed >> end & 1:
                    found = pairs.get((left, piece))
                    if self.fits(left, piece) if found is None else found:
                        break
                piece = (prefixes.get(piece) or self.shorter(piece)) if len(piece) > 1 else ""
            fresh = bool(piece)
            if fresh:
                out.append(piece)
                pos, left = end, piece
            else:  # go back: the place has failed, and so has the piece that led here
                failed |= 1 << pos
                piece = out.pop()
                pos -= len(piece)
                left = out[-1] if out else ""
        return out

    def _ids(self, text: str) -> bytes:
        packed = self.packed
        return b"".join([packed[p] if p in packed else self._spelled(p) for p in self.pieces(text)])

    def _spelled(self, char: str) -> bytes:
        return np.array([self.bytes[b] for b in char.encode()], "<i4").tobytes()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids with the end id, per text."""
        cut = [self.cut(self.model.normalize(text)) for text in texts]
        known = self.words.of(set().union(*cut))
        end = np.array([self.end_id], "<i4").tobytes()
        return [np.frombuffer(b"".join([known[w] for w in words]) + end, "<i4") for words in cut]


@lru_cache(maxsize=2)
def _encoder(model_path: str) -> PieceEncoder:
    return PieceEncoder(model_path)


def _lists(ids: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, ids)]).astype("i4")
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)))


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): the ids of each whole text and the end id.  Null text counts as empty; repeated rows stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(model_path)
        for batch in slices(batches, 1):
            ids = encoder.encode(batch.column(1).fill_null("").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(ids)], ["doc_id", "ids"])
        encoder.words.clear()

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


@lru_cache(maxsize=2)
def _model(model_path: str) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_file=model_path)


def decode(tokens: DataFrame, model_path: str) -> DataFrame:
    """``tokens`` (doc_id, ids) with ``text``, the library's decoding of the ids; null ids give null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(model_path)
        for batch in batches:
            ids = batch.column(1)
            ends, values, known = ids.offsets.to_numpy(), ids.values.to_numpy(), ids.is_valid().to_pylist()
            texts = [model.decode(values[a:b].tolist()) if k else None for a, b, k in zip(ends, ends[1:], known)]
            yield pa.RecordBatch.from_arrays([batch.column(0), ids, pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    return tokens.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, text string")


def round_trip(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, text): :func:`encode` and :func:`decode` in one step, so that a task needs one Python worker."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(model_path)
        for batch in slices(batches, 1):
            ids = encoder.encode(batch.column(1).fill_null("").to_pylist())
            texts = [encoder.model.decode(x.tolist()) for x in ids]
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(ids), pa.array(texts, pa.string())], ["doc_id", "ids", "text"])
        encoder.words.clear()

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>, text string")


def digest(docs: DataFrame, model_path: str) -> DataFrame:
    """Length and hashes of each document's ids, and hash of what they decode to."""
    return round_trip(docs, model_path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("text"), 256).alias("decoded_sha256"),
    )
