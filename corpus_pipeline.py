"""A training-data pipeline over ``documents``: each stage reads what the one before has kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fitmesh.llm.bpe import encode
from fitmesh.llm.decontaminate import decontaminate
from fitmesh.llm.line_dedup import line_dedup
from fitmesh.llm.near_dedup import near_duplicates
from fitmesh.llm.quality import quality
from fitmesh.llm.storage import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the repetition and symbol rules."""
    return quality(docs, carry=COLUMNS).where("kept").select(*COLUMNS)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated runs of lines deleted; a document that consists of nothing else goes."""
    found = line_dedup(docs.select(*COLUMNS))
    found = found.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines")))
    changed = F.when(F.col("n_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return found.withColumn("n_chars", changed).select(*COLUMNS)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id."""
    gone = near_duplicates(docs).where("not kept").select("doc_id").distinct()
    return docs.select(*COLUMNS).join(gone, "doc_id", "left_anti")


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a test item's text, whole, edited or in large part."""
    return decontaminate(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet")).where("kept").select(*COLUMNS)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids, ids_sha256, decoded_sha256`` of every document left."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return encode(docs, path, public_tokenizers.PATTERN, digests=True)


STAGES = [("quality", quality_stage), ("lines", line_stage), ("near_duplicates", near_stage), ("benchmark", benchmark_stage), ("tokens", token_stage)]

ORACLE_SQL = None  # tokens cannot be expressed in SQL; tests/llm compares the stages with plain Python


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, name)
    return docs
