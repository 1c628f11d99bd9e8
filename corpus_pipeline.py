"""A training corpus from raw documents: filter, dedup, decontaminate, pack.

Each stage is a function of (spark, docs, sf_dir); its result is written as
Parquet and reread as the next one's docs. All but the last return the columns
of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barsignal.llm import decontaminate, line_dedup, minhash, packing, quality
from barsignal.llm.common import prepare, shared, table
from barsignal.llm.tokens import vocabulary_file

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model does not reject."""
    model = quality.learn_quality(docs, table(spark, sf_dir, "labels"))
    return docs.where(quality.quality_score(model, F.col("text")) >= quality.THRESHOLD)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without later repeated runs of lines; n_chars follows."""
    prepare(spark)
    found = line_dedup.line_dedup(docs)
    return found.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies."""
    prepare(spark)
    return minhash.first_of_groups(docs).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents that are left, with their places in sequences."""
    prepare(spark)
    return packing.pack(packing.token_pieces(docs, vocabulary_file(), with_ids=False).drop("ids"))


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_deduplication),
    ("minhash near-dedup", near_deduplication),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", best_fit_packing),
]

# Compression, hashing sketches and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = shared(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
