"""One query per operator over its whole table, with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stratalake.llm import chat, periodic_runs
from stratalake.llm import oracle as O
from stratalake.llm.bm25 import top_k
from stratalake.llm.graph_search import nearest
from stratalake.llm.html_main import extract_main_text
from stratalake.llm.jaccard_join import jaccard_components
from stratalake.llm.packing import pack
from stratalake.llm.paragraph_dedup import remove_repeats
from stratalake.llm.piece_codec import digests
from stratalake.llm.quality import scores, train
from stratalake.llm.tables import table
from stratalake.llm.token_files import token_file_rows
from stratalake.llm.vector_dups import near_duplicate_vectors
from stratalake.llm.whitening import whiten

#: Texts of conversation -1: control strings of a common chat template.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.range(2).selectExpr(
        "-1L as conv_id", "id as turn", "if(id = 0, 'user', 'assistant') as role", f"'{CONTROL_TEXT}' as text")
    turns = chat.canonical_turns(rows.unionByName(more), "conv_id")
    return chat.digest(chat.formatted(turns), "conv_id")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


def op4_exact_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return top_k(docs, docs.where("doc_id % 100 = 0").selectExpr("doc_id as query_id", "text"), k=10)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "text", "repeated_spans", "removed_words")


def op6_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file_rows(table(spark, sf_dir, "documents"))


def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"), cosine=0.95)


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), size=4, percent=85)


def op9_sentencepiece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scores(docs, train(docs, table(spark, sf_dir, "labels")))


def op11_approximate_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return nearest(rows, rows.where("vec_id % 100 = 0").selectExpr("vec_id as query_id", "embedding"), k=10)


def op12_periodic_run_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.with_planted_runs(table(spark, sf_dir, "documents"))
    return periodic_runs.digest(periodic_runs.collapse_runs(docs, least=24, times=3))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"), most=4)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_chat_formatting, op2_best_fit_packing, op3_html_extraction, op4_exact_top_k_search, op5_substring_dedup,
        op6_token_id_output, op7_embedding_near_dedup, op8_ngram_jaccard_join, op9_sentencepiece_codec,
        op10_quality_classifier, op11_approximate_nearest_neighbours, op12_periodic_run_detection, op13_embedding_whitening,
    )
}
ORACLE: dict[str, str] = {
    "op1_chat_formatting": O.CHAT_FORMATTING,
    "op4_exact_top_k_search": O.EXACT_TOP_K_SEARCH,
    "op7_embedding_near_dedup": O.EMBEDDING_NEAR_DEDUP,
    "op8_ngram_jaccard_join": O.NGRAM_JACCARD_JOIN,
}
