"""Operators 1, 3 and 5 against their libraries."""

import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from ledgerloom.llm import piece_codec, separator_scan, token_table, word_tokens
from ledgerloom.llm import queries as llm_queries
from ledgerloom.llm.common import WordCache, table
from ledgerloom.storage import new_folder
from tests.llm.plain import SMALL, empty, odd_rows, sha

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def documents(spark):
    return table(spark, SMALL, "documents")


def _sorted(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: [(x is not None, x) for x in r])


@pytest.mark.parametrize("which", ["documents", "odd"])
def test_pieces_equal_the_library(spark, documents, which):
    rows = documents if which == "documents" else odd_rows(spark)
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    want = []
    for r in rows.collect():
        ids = model.encode(r["text"] or "") + [model.eos_id()]
        want.append((r["doc_id"], len(ids), sha(" ".join(map(str, ids))), sha(model.decode(ids))))
    assert _sorted(piece_codec.digest(rows, PIECES).collect()) == _sorted(want)


def test_encode_and_decode_apart(spark):
    rows = odd_rows(spark)
    there = piece_codec.encode(rows, PIECES)
    back = piece_codec.decode(there.unionByName(spark.createDataFrame([(7, None)], there.schema)), PIECES)
    both = piece_codec.round_trip(rows, PIECES)
    assert _sorted((r[0], str(r[1]), r[2]) for r in back.where("ids IS NOT NULL").collect()) == _sorted((r[0], str(r[1]), r[2]) for r in both.collect())
    assert [r["text"] for r in back.where("ids IS NULL").collect()] == [None]


def test_pieces_of_hard_words():
    encoder = piece_codec.PieceEncoder(PIECES)
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    random = np.random.default_rng(3)
    known = sorted(encoder.ids)
    texts = ["".join(random.choice(known, 12)).replace("▁", " ") for _ in range(400)]
    texts += ["".join(random.choice(list("abcdehinorst ,.%1_éß日\n"), 80)) for _ in range(400)]
    for text, ids in zip(texts, encoder.encode(texts)):
        assert list(ids) == model.encode(text) + [model.eos_id()]
    for text in texts[:40]:
        plain = model.normalize(text).replace("\n", "")
        assert encoder.pieces(plain) == encoder.remerge(plain)


def test_word_cache_keeps_what_is_asked_for():
    made = []
    cache = WordCache(lambda words: made.extend(words) or [w * 2 for w in words], 4)
    for words in ({"a", "b"}, {"a", "c"}, {"a", "d", "e", "f", "g"}, {"a"}):
        assert {w: cache.of(words)[w] for w in words} == {w: w * 2 for w in words}
    assert made.count("a") == 1


def test_empty_tables(spark):
    assert piece_codec.digest(empty(spark), PIECES).count() == 0
    path = new_folder(spark, "tokens")
    token_table.write(token_table.tokenized(empty(spark), WORDS, 2), path)
    assert token_table.digest(spark, path).count() == 0



@pytest.mark.parametrize("which", ["documents", "odd"])
def test_token_table_equals_the_library(spark, documents, which):
    rows = documents if which == "documents" else odd_rows(spark)
    path = new_folder(spark, "tokens")
    token_table.write(token_table.tokenized(rows, WORDS, 2), path)
    tokenizer = Tokenizer.from_file(WORDS)
    found = token_table.digest(spark, path).collect()
    want = []
    for r in rows.collect():
        ids = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [2]
        want.append((r["doc_id"], len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
    assert _sorted((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in found) == _sorted(want)
    by_start = sorted(found, key=lambda r: r["start"])
    at = 0
    for r in by_start:  # gapless, in doc_id order, null ids first
        assert r["start"] == at
        at += r["n_tokens"]
    ids = [-1 if r["doc_id"] is None else r["doc_id"] for r in by_start]
    assert ids == sorted(ids)


def test_token_table_is_read_in_part(spark, documents):
    path = new_folder(spark, "tokens")
    token_table.write(token_table.tokenized(documents, WORDS, 2), path)
    part = token_table.read_tokens(spark, path, 20, 29)
    assert sorted(r["doc_id"] for r in part.collect()) == list(range(20, 30))
    assert "PushedFilters: [IsNotNull(doc_id), GreaterThanOrEqual(doc_id,20)" in part._jdf.queryExecution().toString()
    index = token_table.read_index(spark, path)
    assert "ids" not in index._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]
    assert index.count() == documents.count()


@pytest.mark.parametrize("block_bytes", [2, 6, 1000, 1 << 22])
def test_separators_are_stitched(spark, tmp_path, block_bytes):
    files = {"part-000000.ids": [9, 9], "part-000001.ids": [1, 2, 9, 3, 3, 3, 3, 3, 3, 9, 9, 5], "part-000002.ids": [], "part-000003.ids": [4] * 50 + [9]}
    for name, ids in files.items():
        (tmp_path / name).write_bytes(np.array(ids, "<u2").tobytes())
    found = separator_scan.scan(spark, str(tmp_path), 9, block_bytes=block_bytes)
    got = sorted((r["path"].rsplit("/", 1)[1], r["row"], r["start"], r["n_tokens"], r["closed"]) for r in found.collect())
    want = []
    for name, ids in files.items():
        start = row = 0
        for i, x in enumerate(ids):
            if x == 9 or i + 1 == len(ids):
                want.append((name, row, start, i + 1 - start, x == 9))
                start, row = i + 1, row + 1
    assert got == sorted(want)


@pytest.mark.parametrize("which", ["documents", "odd"])
def test_counts_from_flat_files(spark, documents, which):
    rows = documents if which == "documents" else odd_rows(spark).where("text IS NULL OR NOT contains(text, '<|endoftext|>')")
    found = separator_scan.counts(rows, new_folder(spark, "flat"), WORDS, 49407)
    tokenizer = Tokenizer.from_file(WORDS)
    want = [(r["doc_id"], len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids) + 1) for r in rows.collect()]
    assert _sorted((r["doc_id"], r["n_tokens"]) for r in found.collect()) == _sorted(want)


def test_a_literal_end_of_text_is_no_separator(spark, tmp_path):
    texts = ["a <|endoftext|> b", "<|endoftext|><|endoftext|>", "plain words", None, "last"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    rows.write.parquet(str(tmp_path / "documents.parquet"))
    tokenizer = Tokenizer.from_file(WORDS)
    want = [(i, len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1) for i, t in enumerate(texts)]
    found = llm_queries.all_queries()["op1_separator_scan"](spark, str(tmp_path)).collect()
    assert _sorted((r["doc_id"], r["n_tokens"]) for r in found) == want
    with pytest.raises(Exception, match="gives the end id 49407 itself"):
        separator_scan.counts(rows, new_folder(spark, "flat"), WORDS, 49407)


def test_flat_files_of_empty_tables(spark, documents, tmp_path):
    """A frame that Spark plans without a partition, and a table without rows."""
    assert separator_scan.counts(documents.where("false"), new_folder(spark, "flat"), WORDS, 49408).count() == 0
    assert separator_scan.counts(empty(spark), new_folder(spark, "flat"), WORDS, 49408).count() == 0
    documents.limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert llm_queries.all_queries()["op1_separator_scan"](spark, str(tmp_path)).collect() == []


def test_names_of_file_systems():
    assert separator_scan._open("file:/tmp/a")[1] == "/tmp/a" == separator_scan._open("file:///tmp/a")[1]


def test_new_words_equal_the_library():
    """Words of many scripts, in both cases, with letters that have odd lower cases."""
    draw, tokenizer = random.Random(6), Tokenizer.from_file(WORDS)
    letters = [c for c in map(chr, range(0x500)) if c.isalpha()]
    words = ["".join(draw.choices(part, k=draw.randrange(1, 12))) for part in (letters[:52], letters[:200], letters[:400], letters) for _ in range(3000)]
    words += ["\u0130", "a\u0130b", "\u00aa", "\u00df", "STRASSE", "\u03a3\u03a3", "\u0149", "\u01c5"]
    encoder = word_tokens.WordTokens(WORDS, "<i4")
    for word, packed in zip(words, encoder._encode(words)):
        assert np.frombuffer(packed, "<i4").tolist() == tokenizer.encode(word, add_special_tokens=False).ids, word
