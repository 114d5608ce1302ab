"""Registered queries: each operator over its whole table, with the parameters it would run with in production."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placemill.llm import bpe, langid, quality
from placemill.llm.decontaminate import find_contamination
from placemill.llm.jaccard import similar_documents
from placemill.llm.materialise import materialise
from placemill.llm.prefixes import conversation_trie
from placemill.llm.rollups import TOKENIZERS, Rollup, count_tokens, deleted, inserted, revised
from placemill.llm.sharding import shard_records
from placemill.llm.syncmers import fingerprint_documents
from placemill.llm.tensored import near_duplicates
from placemill.llm.urlfilter import Rule, canonical, filter_urls, host_of
from placemill.llm.variants import spelling_variants
from placemill.staging import pin, scratch_path

URL_RULES = [
    Rule("allow", "org"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
]
#: Names of hosts whose pages are listed.
LISTED_NAMES = ("adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm")
#: Vocabulary file whose tokens are counted, without its ending.
VOCABULARY = "byte_bpe_50k"
#: Characters that a revision takes out of texts of low quality.
NOISE = "[%*&$#!|]+"
#: Key of the training order.
ORDER_KEY = 20240607


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _remainder(doc_id: str, by: int) -> Column:
    """crc32 of the id as text, modulo ``by``; null for a null id."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(by))


def language_network(documents: DataFrame, **options) -> langid.Network | None:
    """Fitted to the documents whose remainder by 4 is known and not 2."""
    return langid.fit(documents.select("doc_id", "text", "lang").filter(_remainder("doc_id", 4) != 2), **options)


def quality_model(documents: DataFrame, labels: DataFrame) -> quality.Model | None:
    """Fitted to the labels whose remainder by 5 is known and not 0."""
    return quality.fit(documents, labels.filter(_remainder("doc_id", 5) != 0))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(_remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out")
    texts = documents.select("doc_id", held_out, "text")
    return langid.identify(texts, language_network(documents), keep=["doc_id", "held_out"])


def op2_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(_table(spark, sf_dir, "documents"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list holds the canonical URLs of all pages on hosts with a listed name."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    named = host_of(F.col("url")).rlike(rf"(^|\.)({'|'.join(LISTED_NAMES)})\.")
    listed = pages.filter(named).select(canonical(F.col("url")).alias("key"))
    return filter_urls(pages, listed, URL_RULES, keep=["page_id"])


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_records(_table(spark, sf_dir, "documents"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = (_table(spark, sf_dir, name) for name in ("documents", "labels"))
    held_out = F.coalesce(_remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out")
    texts = documents.select("doc_id", held_out, "text")
    return quality.assess(texts, quality_model(documents, labels), keep=["doc_id", "held_out"])


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches: all documents come in, toxic ones go, and those of low quality are counted anew without noise.

    One batch is delivered a second time, which changes nothing. Tokenizer versions: two that built-in expressions count,
    and the vocabulary file that documents are encoded with.
    """
    documents, labels = (_table(spark, sf_dir, name) for name in ("documents", "labels"))
    # Null where there is no noise, and the count is the old one.
    cleaned = F.when(F.col("text").rlike(NOISE), F.regexp_replace("text", NOISE, ""))

    def version(name: str, old: Column, new: Column) -> Column:
        changed = F.when(F.col("cleaned").isNotNull(), new)
        return F.struct(F.lit(name).alias("tokenizer"), old.alias("old_tokens"), changed.alias("new_tokens"))

    counts = [version(name, count_tokens(F.col("text"), name), count_tokens(F.col("cleaned"), name)) for name in TOKENIZERS]
    texts = documents.select("doc_id", "source", "lang", "text", cleaned.alias("cleaned"))
    texts = texts.withColumn("counts", F.array(*counts))
    # The text goes to Python once and does not come back.
    automaton, keys = bpe.load(public_tokenizers.path(f"{VOCABULARY}.json")), ["doc_id", "source", "lang", "counts"]
    whole = bpe.count_tokens(texts, automaton, keep=[*keys, "cleaned"]).withColumnRenamed("n_tokens", "n_old")
    both = bpe.count_tokens(whole, automaton, text="cleaned", keep=[*keys, "cleaned", "n_old"])
    last = F.array(version(VOCABULARY, F.col("n_old"), F.col("n_tokens")))
    counted = pin(both.select("doc_id", "source", "lang", F.concat("counts", last).alias("counts")), "counts")
    marks = labels.groupBy(F.col("doc_id").alias("__id")).agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
    marked = counted.join(marks, F.col("doc_id") == F.col("__id"), "left")
    each = marked.select("source", "lang", "toxic", "quality", F.inline("counts"))
    toxic = F.coalesce(F.col("toxic") == 1, F.lit(False))
    each = each.withColumn("tokens", F.coalesce("new_tokens", "old_tokens"))
    first = each.withColumn("tokens", F.col("old_tokens"))
    batches = [inserted(first), deleted(first.filter(toxic)), revised(each.filter(~toxic & (F.col("quality") == 0)))]
    rollup = Rollup(spark, scratch_path(spark, "rollup"))
    for number, changes in enumerate(batches):
        rollup.commit(number, changes)
    rollup.commit(1, batches[1])
    rollup.fold()
    return rollup.totals()


def op7_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    automaton = bpe.load(public_tokenizers.path("byte_bpe_50k.json"))
    return bpe.token_digests(_table(spark, sf_dir, "documents"), automaton, keep=["doc_id"])


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(_table(spark, sf_dir, "documents")).drop("text_hash", "class_key")


def op9_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record with its place; the digest is that of its tokens."""
    written = materialise(_table(spark, sf_dir, "documents"), key=ORDER_KEY)
    return written.withColumn("tokens_sha256", F.sha2("tokens", 256)).drop("tokens")


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = (_table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return find_contamination(documents, benchmark, keep=["doc_id"])


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(_table(spark, sf_dir, "documents"))


def op12_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op13_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(_table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    function.__name__: function
    for function in (
        op1_language_id,
        op2_document_fingerprints,
        op3_url_filter,
        op4_sharding,
        op5_quality_classifier,
        op6_token_counts,
        op7_bpe_encoding,
        op8_ngram_jaccard_join,
        op9_training_order,
        op10_benchmark_decontamination,
        op11_spelling_variants,
        op12_minhash_near_dedup,
        op13_conversation_prefix_trie,
    )
}
