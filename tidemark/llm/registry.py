"""Queries of the operators of this package over the driver tables, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import chat_format, decontaminate, html_blocks, packing, prefix_trie, quality_mil, quality_rules, secret_scan, sentence_pieces, simhash_trie, substring_dedup, token_counts, whitening
from tidemark.llm.common import table


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.tiktoken"))
    return counts.withColumnRenamed("id", "doc_id")


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    said = "</s>[INST] ok [/INST]"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    kinds = [F.col(f.name).cast(f.dataType) for f in rows.schema.fields]
    own = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string").select(*kinds)
    names = vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    packs, places = chat_format.format_conversations(rows.unionByName(own), *names)
    back = chat_format.read_back(packs, *names)
    turns = F.array_join(F.zip_with("roles", "texts", lambda r, t: F.concat(r, F.lit("\n"), t, F.lit("\n"))), "")
    digests = back.select("leaf", F.size("texts").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"), F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))
    return places.join(digests, "leaf").select(F.col("conv").alias("conv_id"), "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = decontaminate.contaminated_pairs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return pairs.withColumnsRenamed({"id": "doc_id", "item": "item_id"})


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    network = quality_mil.train(docs, table(spark, sf_dir, "labels"))
    scored = quality_mil.score_documents(docs, network).withColumnRenamed("id", "doc_id")
    return scored.select("doc_id", (quality_mil.remainder("doc_id") == 2).alias("held_out"), "score", "predicted", "n_passages")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    field = quality_rules.train(docs, table(spark, sf_dir, "labels"))
    return quality_rules.measure(docs, field).withColumnRenamed("id", "doc_id").drop("text_hash")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))
    return pieces.withColumnRenamed("id", "doc_id")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = substring_dedup.dedup_substrings(table(spark, sf_dir, "documents"))
    return cleaned.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    texts = html_blocks.extract(pages, html_blocks.train(pages), keep=("url",))
    return texts.select(F.col("id").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"), "n_blocks", "n_main")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("secrets", lambda s: s["kind"] < 3)

    def of_kind(k: int) -> Column:  # a second parameter of the lambda, even one with a default, would be the index
        return F.size(F.filter(base, lambda s: s["kind"] == k)).cast("long")

    counts = [of_kind(k).alias(n) for k, n in enumerate(("n_assign", "n_access", "n_hex"))]
    return found.select("doc_id", *counts, F.sha2(secret_scan.span_text(base), 256).alias("base_sha256"), secret_scan.span_text(F.col("secrets")).alias("spans"))


def op10_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_trie.simhash_components(table(spark, sf_dir, "documents"))
    return groups.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.whiten(table(spark, sf_dir, "embeddings"))
    # a long holds the deviation up to some millions of vectors; the decimal holds it beyond
    return rows.withColumn("deviation_exact", F.col("deviation")).withColumn("deviation", F.expr("try_cast(deviation as long)"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    rebuilt = prefix_trie.share_openings(prefix_trie.turn_digests(table(spark, sf_dir, "conversations")))
    nodes = prefix_trie.trie(prefix_trie.chains(rebuilt))
    return nodes.withColumnsRenamed({"conv": "conv_id", "parent_conv": "parent_conv_id", "saved": "saved_tokens", "ends": "ends_sha256"})


def op13_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = sentence_pieces.encode(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"), decoded=True)
    numbers = F.array_join(F.col("ids").cast("array<string>"), ",")
    return pieces.select(F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"), F.sha2(numbers, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_token_counts, op2_chat_format, op3_decontaminate, op4_quality_classifier, op5_quality_rules, op6_packing, op7_substring_dedup, op8_html_extraction, op9_secret_scan, op10_simhash_dedup, op11_embedding_whitening, op12_prefix_trie, op13_sentence_pieces)
}
ORACLES: dict[str, str] = {}
