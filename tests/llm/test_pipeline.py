"""The pipeline, stage by stage, against plain versions."""

import random
import re
from collections import Counter, defaultdict

import corpus_pipeline
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import Row

import __spark_entry__ as entry
from ledgerloom.llm.common import table
from tests.llm.plain import SMALL, boilerplate_removed, component_ids, contamination, empty, fingerprint, odd_rows, sha


def _rows(frame):
    return [r.asDict() for r in frame.collect()]


def _plain(docs, bench):
    """What each stage makes of the rows, one after the other."""
    docs = [d for d in docs if re.search(r"[^\W\d_]", d["text"] or "")]
    yield docs
    done = boilerplate_removed([(d["doc_id"], d["text"], d["source"]) for d in docs], 5)
    docs = [d | {"text": t, "n_chars": len(t) if n else d["n_chars"]} for d, (_, t, n) in zip(docs, done)]
    yield docs
    prints = defaultdict(list)
    for d in docs:
        prints[fingerprint(d["text"])].append(d["doc_id"])
    kept = set(component_ids(prints).values())
    docs = [d for d in docs if d["doc_id"] in kept]
    yield docs
    hit = {r[0] for r in contamination([(d["doc_id"], d["text"]) for d in docs], bench) if r[5]}
    docs = [d for d in docs if d["doc_id"] not in hit]
    yield docs
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    coded = [(d["doc_id"], model.encode(d["text"]) + [model.eos_id()]) for d in docs]
    yield [
        {"doc_id": i, "n_tokens": len(ids), "ids_sha256": sha(" ".join(map(str, ids))), "decoded_sha256": sha(model.decode(ids))} for i, ids in coded
    ]


@pytest.fixture(scope="module")
def stages(spark):
    rows = _rows(table(spark, SMALL, "documents"))
    bench = [(r["item_id"], r["text"]) for r in table(spark, SMALL, "benchmark").collect()]
    return list(_plain(rows, bench))


def test_each_stage(spark, stages):
    docs = table(spark, SMALL, "documents")
    before = docs.count()
    for (name, stage), want in zip(corpus_pipeline.STAGES, stages):
        docs = stage(spark, docs, SMALL)
        got = docs.collect()
        key = lambda d: tuple(sorted(d.items()))
        assert Counter(key(r.asDict()) for r in got) == Counter(map(key, want)), name
        docs = spark.createDataFrame(got, docs.schema)
    assert docs.count() < before


def test_the_whole(spark, stages):
    found = entry.queries()["pipeline"](spark, SMALL)
    assert sorted(r["doc_id"] for r in found.collect()) == sorted(d["doc_id"] for d in stages[-1])


def test_stages_stand_hard_rows(spark):
    for docs in (odd_rows(spark), empty(spark)):
        columns = docs.columns
        for at, (_, stage) in enumerate(corpus_pipeline.STAGES):
            docs = stage(spark, docs, SMALL)
            rows = docs.collect()
            if at < 4:
                assert docs.columns == columns
                docs = spark.createDataFrame(rows, docs.schema)


def test_letter_noise_has_no_language(spark):
    docs = table(spark, SMALL, "documents")
    chance = random.Random(5)
    noise = ["".join(chance.choice("abcdefghijklmnopqrstuvwxyz    ") for _ in range(n)) for n in (20, 60, 200)] + ["私は学生です。" * 30]
    rows = [Row(**{c: None for c in docs.columns} | {"doc_id": 10**9 + i, "text": t}) for i, t in enumerate(noise)]
    mixed = docs.unionByName(spark.createDataFrame(rows, docs.schema))
    kept = {r["doc_id"] for r in corpus_pipeline.language_id(spark, mixed, SMALL).select("doc_id").collect()}
    assert kept == {r["doc_id"] for r in docs.collect() if re.search(r"[^\W\d_]", r["text"] or "")}
