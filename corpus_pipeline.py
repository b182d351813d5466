"""From raw documents to packed training sequences: five stages, each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, packing, quality_rules, secret_scan, simhash_trie
from tidemark.llm.common import prepare, table
from tidemark.llm.registry import vocabulary
from tidemark.session import staged


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. The field is fitted on labelled documents of ``docs``."""
    prepare(spark)
    return quality_rules.keep_good(docs, quality_rules.train(docs, table(spark, sf_dir, "labels")))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints, the one with the smallest id."""
    prepare(spark)
    return simhash_trie.dedup(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item."""
    prepare(spark)
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced; n_chars is the new text's."""
    prepare(spark)
    return secret_scan.redact(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences."""
    return packing.pack_documents(docs, vocabulary("word_bpe_49k.json")).withColumnRenamed("id", "doc_id")


STAGES = [("quality rules", rules), ("near copies", near_copies), ("benchmark leaks", benchmark_leaks), ("secrets", secrets), ("packing", sequences)]
#: No SQL: the field's labels, the tiling, the Markov models and the packing are beyond it. Tested step by step.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
