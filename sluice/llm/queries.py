"""Registered queries of the operators: thin digests over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import language_id, toxicity
from sluice.llm.conversation_trie import conversation_trie
from sluice.llm.decontaminate import find_overlaps
from sluice.llm.embedding_dedup import near_duplicate_vectors
from sluice.llm.hard_negatives import mine_hard_negatives
from sluice.llm.html_extract import extract
from sluice.llm.license_scan import scan_licenses
from sluice.llm.line_dedup import dedup_lines
from sluice.llm.minhash_dedup import near_duplicates
from sluice.llm.packing import pack_documents
from sluice.llm.sharding import shard
from sluice.llm.suffix_dedup import remove_repeats
from sluice.sources.tables import read_table


TOXIC_SCORE = 0.7
SHARD_BYTES = 1 << 20


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read_table(spark, sf_dir, "documents"))


def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"), n_words=4)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = toxicity.held_out()
    labels = toxicity.sample_labels(read_table(spark, sf_dir, "labels").where(~held_out))
    labelled = docs.join(F.broadcast(labels.toDF("doc_id", "toxic", "weight")), "doc_id")
    scored = toxicity.score_toxicity(docs, toxicity.train(labelled, weight_col="weight"))
    predicted = (F.col("score") >= TOXIC_SCORE).cast("int")
    return scored.select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"))


def op5_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read_table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents"), tokenizer_path())


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = language_id.held_out()
    model = language_id.train(docs.where(~held_out))
    found = language_id.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = shard(read_table(spark, sf_dir, "documents").select("doc_id", "text"), SHARD_BYTES)
    return sharded.select("doc_id", "depth", "prefix", "overflow", "n_bytes", "shard_bytes")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_overlaps(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(read_table(spark, sf_dir, "embeddings"))


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_repeats(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(vectors.withColumn("label", noisy), F.col("vec_id") % 100 == 0)


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(read_table(spark, sf_dir, "conversations"))


LLM_QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_license_scan": op2_license_scan,
    "op3_minhash_dedup": op3_minhash_dedup,
    "op4_toxicity": op4_toxicity,
    "op5_html_extract": op5_html_extract,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_language_id": op7_language_id,
    "op8_sharding": op8_sharding,
    "op9_decontamination": op9_decontamination,
    "op10_embedding_dedup": op10_embedding_dedup,
    "op11_suffix_dedup": op11_suffix_dedup,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_conversation_trie": op13_conversation_trie,
}
