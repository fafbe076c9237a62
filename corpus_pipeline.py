"""The corpus pipeline: documents in, training sequences out. Each stage is written as Parquet and read back by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import decontaminate, exact_dedup, lang_id, ngram_join, packing
from millrace.llm.common import documents, materialize


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; the model is learned from the labelled ones, but for the held-out quarter. Texts without letters,
    in other scripts, in languages unlike the learned ones, and random letters go."""
    model = lang_id.learn(docs.where(~lang_id.held_out()))
    return lang_id.keep_identified(docs, model)


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of identical texts the row with the largest doc_id."""
    return exact_dedup.drop_exact_copies(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the row with the least doc_id."""
    return ngram_join.drop_near_duplicates(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact),
    ("ngram_jaccard_join", drop_near),
    ("benchmark_decontamination", drop_benchmark),
    ("best_fit_packing", pack),
]

#: Language scores, MinHash classes and token ids have no SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"stage-{name}")
    return docs
