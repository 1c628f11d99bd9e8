"""The registered queries of the subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from barsignal.llm import (
    conversation_trie, decontaminate, embedding_dedup, html_text, language, license_scan, line_dedup, minhash, packing, quality,
    ranked_search, token_output, toxicity,
)
from barsignal.llm.common import fold_of, table
from barsignal.llm.conversation_trie_sql import CONVERSATION_TRIE
from barsignal.llm.license_scan_sql import LICENSE_SCAN
from barsignal.llm.line_dedup_sql import LINE_DEDUP
from barsignal.llm.ranked_search_sql import RANKED_SEARCH
from barsignal.llm.tokens import vocabulary_file

Query = Callable[[SparkSession, str], DataFrame]


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.line_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", F.md5(F.col("text").cast("binary")).alias("text_md5"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(table(spark, sf_dir, "documents"), vocabulary_file(), with_ids=False)
    return packing.pack(pieces.drop("ids"))


def op4_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = token_output.token_files(table(spark, sf_dir, "documents"), vocabulary_file())
    return token_output.read_tokens(index, with_ids=False).drop("ids")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = toxicity.with_toxicity(docs, toxicity.learn_toxicity(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", (fold_of("doc_id", 4) == 2).alias("held_out"), "score", "predicted")


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.main_text(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.with_language(docs, language.learn_language(docs))
    return found.select("doc_id", (fold_of("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = quality.with_quality(docs, quality.learn_quality(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", (fold_of("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.license_scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


QUERIES: dict[str, Query] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_decontamination": op2_decontamination,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_token_output": op4_token_output,
    "op5_toxicity": op5_toxicity,
    "op6_embedding_near_dedup": op6_embedding_near_dedup,
    "op7_html_extraction": op7_html_extraction,
    "op8_language_id": op8_language_id,
    "op9_minhash_near_dedup": op9_minhash_near_dedup,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_ranked_search": op11_ranked_search,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_license_scan": op13_license_scan,
    "pipeline": corpus_pipeline.run,
}

SQL: dict[str, str] = {
    "op1_line_dedup": LINE_DEDUP, "op11_ranked_search": RANKED_SEARCH, "op12_conversation_trie": CONVERSATION_TRIE, "op13_license_scan": LICENSE_SCAN,
}
