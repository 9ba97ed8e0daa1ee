"""The corpus pipeline: from raw documents to token ids on disk.

Each stage is one of the operators of ``tickwise.llm``; it gets what its predecessor kept
and its decisions take effect.  All but the last return every column of their documents, extra
ones too, whatever their names; an empty table gives an empty one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.llm import decontaminate, lsh_forest, mixing, quality_rules, token_store
from tickwise.llm.common import shared_dir, staged, table
from tickwise.llm.queries import encoder


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality rules keep.  Null, empty and short texts go; rows are judged one by
    one, so repeated rows share their fate; a null doc_id is no reason to go."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: that of the least doc_id (null last; of
    several texts with it the least hash; of repeated rows one).  Texts without words stay."""
    return lsh_forest.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages.  Texts without words have none, nor has any
    document where the benchmark is empty; repeated rows share their fate."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the source mix takes them, 0 to 3 times.  A null source is a source,
    the last one; a null text has no words and is not taken; repeated rows are one document and
    are taken alike."""
    return mixing.mix(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token ids, written and read back: doc_id, start, n_tokens and ids_crc32.
    A null text has the end id alone; a null doc_id comes first; rows with one doc_id are
    ordered by a hash of their text."""
    path = f"{shared_dir(spark)}/tickwise-llm/corpus-{uuid.uuid4().hex}"
    token_store.write_store(docs, path, encoder)
    return token_store.read_store(spark, path).select(
        "doc_id", "start", "n_tokens", token_store.id_checksum(F.col("ids")).alias("ids_crc32"))


STAGES = [("quality rules", quality), ("n-gram Jaccard join", near_duplicates),
          ("benchmark decontamination", decontamination), ("mixing sources to target weights", mixture),
          ("token-ID / binary output", token_output)]

#: The near-duplicate, mixing and token stages are beyond SQL; tests hold them to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written before the next reads them."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), "pipeline-" + name.split()[0])
    return STAGES[-1][1](spark, docs, sf_dir)
