"""Cleaning of the corpus in stages; each stage's result is written as Parquet and read again as the next one's input."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from placemill.llm import bpe, langid, quality
from placemill.llm.decontaminate import remove_contaminated
from placemill.llm.jaccard import keep_one_of_each
from placemill.llm.queries import language_network, quality_model
from placemill.staging import remove_path, scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter go, and those in no learned language, as random letters or an unknown script.

    No probability of one language is asked for: a document in several languages has none that is high.
    """
    return langid.keep_identified(docs, language_network(docs, outside=True))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are predicted to be of low quality go."""
    return quality.keep_good(docs, quality_model(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays."""
    return keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which at least a twentieth is benchmark text go."""
    return remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of the ids and of the text decoded from them."""
    automaton = bpe.load(public_tokenizers.path("byte_bpe_50k.json"))
    return bpe.encode_with_digests(docs, automaton, keep=["doc_id"])


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("quality_classifier", quality_classifier),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("bpe_encoding", bpe_encoding),
]

#: The stages learn models, which SQL cannot express; tests compare each stage with a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents. A stage's input is deleted once the next one's is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before is not None:
            remove_path(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
