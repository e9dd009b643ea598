"""A corpus pipeline over ``documents``: each stage works on all that the stage before it kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.jaccard_join import jaccard_components
from stratalake.llm.packing import pack
from stratalake.llm.paragraph_dedup import remove_repeats
from stratalake.llm.quality import keep_good, train
from stratalake.llm.tables import table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps; it is trained on the rated ones among them."""
    return keep_good(docs, train(docs, table(spark, sf_dir, "labels")))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies: five-word shingles, similarity of 0.8 or more.

    Rows with a NULL doc_id are compared with nothing and stay. Rows that share a doc_id
    are one document: all of them stay or all go, exact copies included.
    """
    copies = jaccard_components(docs, size=5, percent=80).where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(copies, "doc_id", "left_anti").select(docs.columns)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that an earlier one has; those of which nothing is left go."""
    cut = remove_repeats(docs)
    left = cut.where("removed_words = 0 or text rlike '[^ \\t-\\r]'")
    return left.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents' pieces in sequences of 2048 tokens."""
    return pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", good_documents),
    ("ngram_jaccard_join", one_of_each_group),
    ("substring_dedup", without_repeats),
    ("best_fit_packing", packed),
]

#: The stages train a model, hash and pack: SQL cannot express them.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, on ``documents``; the places of what is left.

    Documents without a text or words go in the first stage, unless no document is labelled: then that
    stage keeps all. An empty table gives no rows.
    """
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, f"stage-{name}")
    return docs
