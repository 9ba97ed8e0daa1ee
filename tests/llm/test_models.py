"""Mixing, toxicity, token output and the pipeline."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SMOKE_SF
from tests.llm import brute
from tests.llm.data import SCHEMA, awkward_rows, documents, got, pairs, passage, same
from tickwise.llm import decontaminate, mixing, quality_rules, queries, token_store, toxicity

# ---------------------------------------------------------------- mixing


def _sizes(rows):
    return [(d, s, len(brute.SPACE_WORD.findall(t or ""))) for d, t, _, s, _ in rows]


def test_mix_targets_and_words(spark):
    rnd = random.Random(3)
    rows = [(i, passage(i, rnd.randint(1, 60)), "en", "hot" if i % 3 == 0 else rnd.choice(["a", "b", "é", None]), 0)
            for i in range(900)]
    out = mixing.copies(documents(spark, rows)).collect()
    target = brute.op6_targets(_sizes(rows))
    assert len(out) == len(rows)
    for source in target:
        own = [r for r in out if r["source"] == source]
        assert own[0]["target"] == pytest.approx(target[source])
        taken = sum(r["size"] * r["copies"] for r in own)
        assert abs(taken - target[source]) <= 60  # less than the largest document
        rate = target[source] / own[0]["source_size"]
        assert {r["copies"] for r in own} <= {int(rate), int(rate) + 1}
    again = mixing.copies(documents(spark, rows).repartition(7)).collect()
    assert sorted(out, key=str) == sorted(again, key=str)


def test_mix_expected_copies(spark):
    """Over many seeds a document is taken as often as its source's rate says."""
    rows = [(i, passage(i, 5 + i % 7), "en", "s", 0) for i in range(12)] + [(99, passage(99, 80), "en", "t", 0)]
    total, rate = np.zeros(12), None
    for seed in range(30):
        got_ = {r["doc_id"]: r for r in mixing.copies(documents(spark, rows), seed=seed, fanout=4).collect()}
        rate = got_[0]["target"] / got_[0]["source_size"]
        total += [got_[i]["copies"] for i in range(12)]
    assert abs(total.mean() / 30 - rate) < 0.08 and (abs(total / 30 - rate) < 0.45).all()


def test_mix_awkward(spark):
    rows = awkward_rows() + awkward_rows()[4:6]
    out = mixing.copies(documents(spark, rows)).collect()
    assert len(out) == len(rows) and all(0 <= r["copies"] <= 3 for r in out)
    assert mixing.copies(documents(spark, [])).count() == 0
    blank = mixing.copies(documents(spark, [(1, None, "x", None, 0), (2, "", "x", "s", 0)])).collect()
    assert [r["copies"] for r in blank] == [0, 0]
    mixed = mixing.mix(documents(spark, rows))
    assert mixed.columns == documents(spark, rows).columns
    by_id = {(r["doc_id"], r["size"]): r["copies"] for r in out}
    counted = {(r["doc_id"], r["text"]): r["count"] for r in mixed.groupBy("doc_id", "text").count().collect()}
    for (d, t), n in counted.items():
        repeats = sum(1 for r in rows if (r[0], r[1]) == (d, t))
        assert n == repeats * by_id[(d, len(brute.SPACE_WORD.findall(t or "")))]


def test_mix_is_native(spark):
    plan = queries.op6_mix(spark, SMOKE_SF)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


# ---------------------------------------------------------------- toxicity


def test_segments_are_maximal():
    scores = [4, -5, 3, -3, 1, 2, -2, 2, -2, 1, 5]
    sums = [0.0, *np.cumsum(scores).tolist()]
    found = toxicity.maximal_segments([i for i, s in enumerate(scores) if s > 0], sums)
    assert found == [(0, 1, 4), (2, 3, 3), (4, 11, 7)]


def test_toxicity_held_out(spark):
    sf = SMOKE_SF.replace("0.001", "0.1")
    out = {r["doc_id"]: r for r in queries.op7_toxicity(spark, sf).collect()}
    labels = [(out[d]["score"], t) for d, t in brute.rows(sf, "labels", "doc_id", "toxic") if out[d]["held_out"]]
    bad, good = [s for s, t in labels if t == 1], [s for s, t in labels if t == 0]
    assert sum(s >= 0.5 for s in bad) > 0.85 * len(bad) and sum(s >= 0.5 for s in good) <= 0.01 * len(good)
    auc = np.mean([(b > g) + 0.5 * (b == g) for b in bad for g in good])
    assert auc > 0.9
    import zlib

    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in out.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in out.values())


def test_toxicity_finds_passages(spark):
    rnd = random.Random(1)
    rows, labels = [], []
    for i in range(400):
        words = passage(i, 60).split()
        bad = i % 4 == 0
        if bad:
            words[20:24] = [rnd.choice(["vile", "idiot", "scum"]) for _ in range(4)]
        rows.append((i, " ".join(words), "en", "s", 0))
        labels.append((i, int(bad)))
    labels += [(0, 1), (None, 1), (9999, 1), (5, None)]
    rows += [(500, None, "en", "s", 0), (501, "", "en", "s", 0), (None, "vile idiot scum vile", "en", "s", 0)]
    model = toxicity.learn(documents(spark, rows), spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    out = {r["doc_id"]: r for r in toxicity.score(documents(spark, rows), model).collect()}
    assert all(out[i]["predicted"] == (i % 4 == 0) for i in range(400))
    assert all(any(a <= 20 and b >= 24 for a, b in out[i]["passages"]) for i in range(0, 400, 4))
    assert out[500]["predicted"] == out[501]["predicted"] == 0 and out[None]["predicted"] == 1


def test_toxicity_without_labels(spark):
    labels = spark.createDataFrame([], "doc_id bigint, toxic int")
    model = toxicity.learn(documents(spark), labels)
    out = toxicity.score(documents(spark), model).collect()
    assert len(out) == len(awkward_rows()) and not any(r["predicted"] for r in out)
    assert toxicity.score(documents(spark, []), model).count() == 0


# ---------------------------------------------------------------- tokens


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 60_000), st.integers(0, 2**64 - 1)), max_size=300),
       st.integers(1, 9))
def test_simple8b_round_trip(ids, times):
    values = np.array(ids * times, np.uint64)
    assert (token_store.decode(token_store.encode(values), len(values)) == values).all()


def test_simple8b_is_dense():
    values = np.random.default_rng(1).integers(0, 1000, 50_000).astype(np.uint64)
    assert len(token_store.encode(values)) < 50_000 * 8 / 6 * 1.02


def test_encoder_matches_library():
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    plain, encode = Tokenizer.from_file(path), token_store.byte_level_encoder(path, room=50)
    rnd = random.Random(2)
    texts = [r[1] for r in awkward_rows()] + [t for _, t in brute.rows(SMOKE_SF, "documents", "doc_id", "text")]
    texts += ["".join(rnd.choice("ab1é  \n\t'sd!²\u00a0\u0300日") for _ in range(40)) for _ in range(4000)]
    texts += ["a <|endoftext|> b", "<|endoftext|>"]
    for at in range(0, len(texts), 500):
        part = [t or "" for t in texts[at:at + 500]]
        want = [[*c.ids, 0] for c in plain.encode_batch(part, add_special_tokens=False)]
        assert [np.frombuffer(ids, "<u4").tolist() for ids in encode([t.encode() for t in part])] == want


def test_token_store(spark, scratch, monkeypatch):
    monkeypatch.setattr(token_store, "BLOCK_DOCS", 3)
    rows = awkward_rows()
    token_store.write_store(documents(spark, rows), scratch + "/s", queries.encoder, 4)
    back = token_store.read_store(spark, scratch + "/s").withColumn(
        "ids_crc32", token_store.id_checksum(F.col("ids")))
    same(got(back, "doc_id", "start", "n_tokens", "ids_crc32"), brute.op8(pairs(rows), queries.tokenizer_path()))
    token_store.write_store(documents(spark, []), scratch + "/e", queries.encoder)
    assert token_store.read_store(spark, scratch + "/e").count() == 0


def test_token_table(spark):
    docs = brute.rows(SMOKE_SF, "documents", "doc_id", "text")
    same(got(queries.op8_token_store(spark, SMOKE_SF), "doc_id", "start", "n_tokens", "ids_crc32"),
         brute.op8(docs, queries.tokenizer_path()))


# ---------------------------------------------------------------- pipeline


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SMOKE_SF}/documents.parquet")
    texts = dict(brute.rows(SMOKE_SF, "documents", "doc_id", "text"))
    (_, quality), (_, near), (_, bench), (_, mixture), (_, tokens) = corpus_pipeline.STAGES
    good = quality(spark, docs, SMOKE_SF).cache()
    judged = queries.op4_quality_rules(spark, SMOKE_SF).filter("kept").collect()
    assert {r["doc_id"] for r in good.collect()} == {r["doc_id"] for r in judged}
    one = near(spark, good, SMOKE_SF).cache()
    left = [(r["doc_id"], texts[r["doc_id"]]) for r in good.collect()]
    assert sorted(r["doc_id"] for r in one.collect()) == sorted({c for _, c, _, _ in brute.op9(left)})
    clean = bench(spark, one, SMOKE_SF).cache()
    items = brute.rows(SMOKE_SF, "benchmark", "item_id", "text")
    want = {r[0] for r in brute.op1([(r["doc_id"], r["text"]) for r in one.collect()], items) if not r[5]}
    assert {r["doc_id"] for r in clean.collect()} == want
    mixed = mixture(spark, clean, SMOKE_SF).cache()
    assert mixed.columns == docs.columns == clean.columns == one.columns == good.columns
    copies = {r["doc_id"]: r["copies"] for r in mixing.copies(clean).filter("copies > 0").collect()}
    assert {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == copies
    out = tokens(spark, mixed, SMOKE_SF)
    want = brute.op8([(r["doc_id"], r["text"]) for r in mixed.collect()], queries.tokenizer_path())
    same(got(out, "doc_id", "start", "n_tokens", "ids_crc32"), want)
    assert got(corpus_pipeline.run(spark, SMOKE_SF), "doc_id", "n_tokens") == got(out, "doc_id", "n_tokens")


def test_pipeline_awkward(spark):
    """Each stage over all awkward rows, with repeats, null ids, extra and clashing columns."""
    rows = awkward_rows() + awkward_rows()[8:13] + [(None, None, None, None, None)] * 2
    docs = documents(spark, rows)
    (_, quality), (_, near), (_, bench), (_, mixture), (_, tokens) = corpus_pipeline.STAGES

    def ids(df):
        assert df.columns == docs.columns
        return sorted((r["doc_id"] for r in df.collect()), key=str)

    judged = quality_rules.judge(docs).filter("kept").select("doc_id").collect()
    assert ids(quality(spark, docs, SMOKE_SF)) == sorted((r[0] for r in judged), key=str)
    one = ids(near(spark, docs, SMOKE_SF))
    blank = [d for d, t in pairs(rows) if not (t or "").split()]
    heads = {c for d, c, _, _ in brute.op9([(d, t) for d, t in pairs(rows) if d is not None and (t or "").split()])}
    assert set(one) - {None} == heads | {d for d in blank if d is not None}
    items = brute.rows(SMOKE_SF, "benchmark", "item_id", "text")
    clean = [r[0] for r in brute.op1(pairs(rows), items) if not r[5]]
    assert ids(bench(spark, docs, SMOKE_SF)) == sorted(clean, key=str)
    mixed = ids(mixture(spark, docs, SMOKE_SF))
    taken = [r["doc_id"] for r in mixing.copies(docs).collect() for _ in range(r["copies"])]
    assert mixed == sorted(taken, key=str)
    same(got(tokens(spark, docs, SMOKE_SF), "doc_id", "n_tokens"),
         [(r[0], r[2]) for r in brute.op8(pairs(rows), queries.tokenizer_path())])


def test_pipeline_empty(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMOKE_SF)
        assert docs.count() == 0


def test_decontaminate_large_batch(spark):
    bench = spark.createDataFrame([(1, passage(1, 13))], "item_id bigint, text string")
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit(passage(1, 14)).alias("text"))
    assert decontaminate.find(docs, bench).filter("contaminated AND n_hit = 13").count() == 3000
