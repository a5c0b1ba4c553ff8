"""Operator 11 against the tiktoken library."""

import base64
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from ledgerloom.llm import byte_codec
from ledgerloom.llm.common import table
from tests.llm.plain import SMALL, empty, odd_rows, sha

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
LIBRARY = tiktoken.Encoding(
    "plain", pat_str=public_tokenizers.PATTERN, special_tokens={},
    mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))},
)


def expected(rows):
    return Counter((i, tuple(LIBRARY.encode_ordinary(t or "")), (t or "").encode()) for i, t in rows)


def found(df):
    return Counter((r["doc_id"], tuple(r["ids"]), bytes(r["raw"])) for r in df.collect())


@pytest.mark.parametrize("which", ["documents", "odd", "empty"])
def test_round_trip(spark, which):
    docs = {"documents": lambda: table(spark, SMALL, "documents"), "odd": lambda: odd_rows(spark), "empty": lambda: empty(spark)}[which]()
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert found(byte_codec.round_trip(docs, RANKS)) == expected(rows)


@pytest.mark.parametrize("chunk,overlap", [(40, 12), (64, 63), (7, 3)])
def test_chunks_are_stitched(spark, chunk, overlap):
    """Small chunks, so that every text has many, with pre-tokens longer than the overlap and cuts at every kind of place."""
    draw = random.Random(chunk)
    parts = ["word", " ", "  ", "\n\n", "\n", "'s", "'re", "'", " don't", "123", " 45", "?!", " ...", "é", "日本", " ", "x" * 30, " " * 20, "½", "\x1c", "'r", "　 "]
    texts = ["".join(draw.choices(parts, k=draw.randrange(200))) for _ in range(60)] + ["a" * 500, " " * 300, "\n" * 200 + "b", "ab " * 200]
    rows = [*enumerate(texts), (None, texts[0]), (3, texts[3]), (3, texts[3]), (4, texts[3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = expected(rows)
    assert found(byte_codec.round_trip(docs, RANKS, chunk=chunk, overlap=overlap)) == want
    coded = byte_codec.encode(docs, RANKS, chunk=chunk, overlap=overlap)
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in coded.collect()) == Counter({k[:2]: n for k, n in want.items()})


def test_stitches_are_true_boundaries(spark):
    """Texts with short words are stitched, none is scanned as a whole."""
    docs = table(spark, SMALL, "documents").select("doc_id", "text").where("char_length(text) > 400")
    chunks = byte_codec._chunks(docs, 200, 100)
    rows = byte_codec.stitched(chunks, 200, 100).collect()
    assert len(rows) > 100 and not any(r["whole"] for r in rows)
    keys = {r["key"]: r["doc_id"] for r in chunks.select("key", "doc_id").distinct().collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in rows:
        true = byte_codec.boundaries(byte_codec.cutter()(texts[keys[r["key"]]]))
        assert 200 * r["k"] + r["start"] in set(true.tolist())


def test_every_character_has_the_class_of_the_library():
    every = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    random.Random(3).shuffle(every)
    text = "".join(every[:50_000]) + " ".join(every) + "a".join(every[:50_000]) + "1".join(every[:50_000])
    encoder = byte_codec._encoder(RANKS)
    assert encoder.packed([byte_codec.cutter()(text)])[0] == np.array(LIBRARY.encode_ordinary(text), "<i4").tobytes()


def test_long_pieces(spark):
    draw = random.Random(1)
    texts = ["".join(draw.choices(letters, k=n)) for n in (65, 1000, 70_000) for letters in ("a", "abcdefghijklmnopqrstuvwxyz", "aé日", " ", "?!")]
    docs = spark.createDataFrame(enumerate(texts), "doc_id long, text string")
    assert found(byte_codec.round_trip(docs, RANKS)) == expected(enumerate(texts))


def test_digest(spark):
    docs = odd_rows(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = Counter((i, len(ids), sha(" ".join(map(str, ids))), sha(raw.decode())) for (i, ids, raw), n in expected(rows).items() for _ in range(n))
    assert Counter(tuple(r) for r in byte_codec.digest(docs, RANKS).collect()) == want


def test_null_ids_decode_to_null(spark):
    tokens = spark.createDataFrame([(1, None), (2, []), (None, [0, 50255])], "doc_id long, ids array<int>")
    assert {(r["doc_id"], r["raw"] and bytes(r["raw"])) for r in byte_codec.decode(tokens, RANKS).collect()} == {
        (1, None), (2, b""), (None, LIBRARY.decode_bytes([0, 50255]))}
