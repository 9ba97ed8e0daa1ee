"""Texts that are no valid UTF-8: no operator dies of one, and each has its stated result."""

import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.data import got, passage, same
from tickwise.llm import (chat, decontaminate, lsh_forest, mixing, phrase_dedup, quality_rules, suffix_dedup,
                          token_store, toxicity, queries)

SHARED = passage(31, 130).encode()
BODIES = {1: b"\xff" + SHARED, 2: SHARED + b" \xc3", 3: passage(32, 80).encode() + b"\x80 end", 4: b"\xed\xa0\x80", 5: b""}


@pytest.fixture
def docs(spark):
    df = spark.createDataFrame([(d, bytearray(b), "en", f"s{d % 2}", len(b)) for d, b in BODIES.items()],
                               "doc_id bigint, body binary, lang string, source string, n_chars bigint")
    return df.select("doc_id", F.col("body").cast("string").alias("text"), "lang", "source", "n_chars")


def _replaced():
    return [(d, b.decode("utf-8", "replace")) for d, b in BODIES.items()]


def _raw():
    return [(d, b.decode("utf-8", "surrogateescape")) for d, b in BODIES.items()]


def test_decontamination(spark, docs):
    items = spark.createDataFrame([(7, SHARED.decode()[:300])], "item_id bigint, text string")
    found = decontaminate.find(docs, items)
    rows = found.select("doc_id", "n_words", "n_hit", "contaminated").collect()
    want = {r[0]: (r[1], r[2], r[5]) for r in brute.op1(_replaced(), [(7, SHARED.decode()[:300])])}
    assert {r[0]: tuple(r[1:]) for r in rows} == want
    assert decontaminate.clean(docs, items).count() == sum(not v[2] for v in want.values())


def test_chat(spark, docs):
    turns = docs.select(F.lit(1).cast("bigint").alias("conv_id"), F.col("doc_id").alias("turn"),
                        F.lit("assistant").alias("role"), "text")
    rows = chat.digests(chat.render(chat.fold(chat.log_of_turns(turns)))).collect()
    want = brute.op3([(1, d, "assistant", t) for d, t in _replaced()])
    assert [tuple(r[:5]) for r in rows] == want


def test_bytes_and_words(docs, monkeypatch):
    monkeypatch.setattr(brute, "sha", lambda x: __import__("hashlib").sha256(
        x if isinstance(x, bytes) else x.encode("utf-8", "surrogateescape")).hexdigest())
    five = [(d, len(b)) for d, b in BODIES.items()]
    rows = suffix_dedup.dedup(docs).collect()
    assert sorted((r.doc_id, r.n_bytes) for r in rows) == five
    assert {r.doc_id: r.n_removed for r in rows} == {1: len(SHARED), 2: len(SHARED), 3: 0, 4: 0, 5: 0}
    same(got(phrase_dedup.dedup(docs), "doc_id", "n_words", "n_removed", "kept_sha256"), brute.op10(_raw()))
    same(got(lsh_forest.join_similar(docs), "doc_id", "class_id", "n_links", "n_copies"), brute.op9(_raw()))
    assert lsh_forest.keep_one(docs).count() == len({r[1] for r in brute.op9(_raw())})


def test_others(spark, docs, scratch):
    same(got(quality_rules.judge(docs), "doc_id", "n_words"), [r[:2] for r in brute.op4(_replaced())])
    assert mixing.mix(docs).count() > 0
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (4, 0)], "doc_id bigint, toxic int")
    scored = toxicity.score(docs, toxicity.learn(docs, labels)).collect()
    assert len(scored) == len(BODIES) and all(0 <= r.score <= 1 for r in scored)
    token_store.write_store(docs, scratch + "/t", queries.encoder)
    back = token_store.read_store(spark, scratch + "/t").withColumn("c", token_store.id_checksum(F.col("ids")))
    same(got(back, "doc_id", "start", "n_tokens", "c"), brute.op8(_replaced(), queries.tokenizer_path()))
