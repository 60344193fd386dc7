"""A corpus pipeline of five of the training-data operators.

Each stage works on everything its predecessor kept; all but the last return
the columns of ``documents``, rows of null ids included.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import language_id
from sluice.llm.decontaminate import find_overlaps
from sluice.llm.line_dedup import dedup_lines
from sluice.llm.minhash_dedup import near_duplicates
from sluice.llm.packing import pack_documents
from sluice.llm.queries import tokenizer_path
from sluice.llm.store import col, stage
from sluice.sources.tables import read_table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: texts without a letter, or unlike all languages, go."""
    model = language_id.train(docs.where(~language_id.held_out()))
    return language_id.identify(docs, model).where("NOT rejected").select(*[col(c) for c in docs.columns])


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: lines that another document has first go from the texts."""
    kept = dedup_lines(docs)
    n_chars = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return kept.withColumn("n_chars", n_chars).select(*[col(c) for c in docs.columns])


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: the smallest id of each group of near copies stays, and of
    rows alike in id and text one. Rows of a null id all stay."""
    columns = [col(c) for c in docs.columns]
    dropped = stage(near_duplicates(docs).where("NOT kept").select("doc_id").distinct(), "near-copies")
    keyed = docs.join(dropped, "doc_id", "left_anti").withColumn("__row_text", F.xxhash64("text"))
    key = ["doc_id", "__row_text"]
    repeated = stage(
        docs.where("doc_id IS NOT NULL").groupBy("doc_id", F.xxhash64("text").alias("__row_text"))
        .count().where("count > 1").select(*key),
        "repeated-rows",
    )
    once = keyed.join(repeated, key, "left_semi").dropDuplicates(key)
    return keyed.join(repeated, key, "left_anti").select(*columns).union(once.select(*columns))


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents that hold a passage of the benchmark go."""
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.xxhash64("text"))
    keyed = docs.withColumn("row_key", key)
    found = find_overlaps(keyed, read_table(spark, sf_dir, "benchmark"), id_col="row_key")
    return keyed.join(found.select("row_key"), "row_key", "left_anti").select(*[col(c) for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: the documents left, packed into sequences of 2048 ids."""
    return pack_documents(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("language_id", known_language),
    ("line_dedup", repeated_lines),
    ("near_dedup", near_copies),
    ("decontamination", no_benchmark),
    ("packing", packing),
]

#: SQL expresses neither the language model nor the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is staged as Parquet."""
    docs = read_table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), name)
    return docs
