"""The registered queries of the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.llm import (byte_bpe, chat, collocations, decontaminate, lsh_forest, mixing, phrase_dedup, prefix_trie, quality_rules,
                          suffix_dedup, token_store, toxicity, url_filter)
from tickwise.llm.common import shared_dir, table

#: The name of the tokenizer's file; its folder is that of the public_tokenizers package.
TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"

#: The sites that are judged by host and path.
SITE_RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"),
              ("org/fr/", "allow"))
#: Words that mark the host of an advertising, spam, gambling, pharmacy or adult site.
BAD_HOST_WORDS = ("ads", "spam", "casino", "bets", "poker", "adult", "porn", "xxx", "pills", "viagra")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit",
                        F.size("items").cast("long").alias("n_items"),
                        decontaminate.items_digest(F.col("items")).alias("items_sha256"),
                        "contaminated")


def url_rules() -> list[url_filter.UrlRule]:
    return [*(url_filter.site_rule(site, verdict) for site, verdict in SITE_RULES),
            *(url_filter.word_rule(w) for w in BAD_HOST_WORDS)]


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge_urls(table(spark, sf_dir, "pages"), url_rules())
    return judged.select("page_id", "host", "path",
                         F.when(F.col("rank") == 1, F.col("rule")).alias("rule"), "verdict")


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", control), (-7, 1, "assistant", control)],
                                  "conv_id bigint, turn bigint, role string, text string")
    log = chat.log_of_turns(turns.unionByName(extra))
    return chat.digests(chat.render(chat.fold(log)))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "base_failed", "kept")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("removed")


def op6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = mixing.copies(table(spark, sf_dir, "documents"))
    return taken.select("doc_id", "size", "source_size", "target",
                        (F.col("size") * F.col("copies")).cast("long").alias("taken"), "source")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5))
    labels = table(spark, sf_dir, "labels").filter(fold != 0)
    model = toxicity.learn(docs, labels)
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "score",
                         "predicted", F.size("passages").alias("n_passages"))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def encoder():
    return token_store.byte_level_encoder(tokenizer_path())


def op8_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = f"{shared_dir(spark)}/tickwise-llm/tokens-{uuid.uuid4().hex}"
    token_store.write_store(docs, path, encoder)
    back = token_store.read_store(spark, path)
    return back.select("doc_id", "start", "n_tokens", token_store.id_checksum(F.col("ids")).alias("ids_crc32"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lsh_forest.join_similar(docs).select("doc_id", "class_id", "n_links", "n_copies")


def op10_phrase_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("removed")


def ranks_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(RANKS)


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = byte_bpe.encode(docs, ranks_path, byte_bpe.tiktoken_classes())
    decoded = byte_bpe.decode(coded.withColumn("ids_sha256", F.sha2("ids", 256)), ranks_path)
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2("body", 256).alias("decoded_sha256"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (
    op1_decontaminate, op2_url_filter, op3_chat_format, op4_quality_rules, op5_suffix_dedup, op6_mix,
    op7_toxicity, op8_token_store, op9_jaccard_join, op10_phrase_dedup,
    op11_byte_bpe, op12_collocations, op13_prefix_trie)}
