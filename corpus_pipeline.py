"""The corpus pipeline: documents in, packed training sequences out.

Stages, in order: quality rules, exact deduplication, SimHash near-duplicates
(one document of each group stays), mixing sources to target weights, packing.
Each stage reads all that the one before kept, written as Parquet in the shared
folder of ``spark.checkpoint.dir``; a stage that fails is run again from there.
All stages but the last return the columns of ``documents``.

The stages before the last work on whole rows, so rows that share a doc_id, null
columns, further columns and empty tables pass as their operators define.
Tokenization has no SQL form, so ``ORACLE_SQL`` is None and the tests hold the
pipeline against a plain version.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from relaywatch.llm import common, exact_dedup, mixing, packing, quality, simhash

ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.share_code(spark)
    return quality.good_documents(docs)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.share_code(spark)
    index = exact_dedup.DigestIndex(spark, common.scratch(spark, "digest-index"))
    return exact_dedup.distinct_texts(docs, index)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.share_code(spark)
    return simhash.one_per_group(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.share_code(spark)
    return mixing.sampled(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.share_code(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)


STAGES = [("quality_rules", quality_rules), ("exact_dedup", exact_duplicates),
          ("simhash_near_dedup", near_duplicates), ("mix_sources", mix_sources),
          ("packing", pack_sequences)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
