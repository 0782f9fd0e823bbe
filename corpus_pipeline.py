"""From raw documents to token ids: quality, near duplicates, repeated passages, benchmark leaks, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes it as Parquet into the shared scratch folder and
gives it to the next stage. All stages but the last return the columns of `documents`. NULL texts pass through every stage
(as an empty list of tokens in the end), empty tables stay empty, and further columns of the documents are kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablejobs.llm import decontaminate, jaccard, quality, substrings, tokens
from tablejobs.llm.queries import TOKENIZERS, table
from tablejobs.session import scratch_dir

TOKENIZER = f"{TOKENIZERS}/word_bpe_49k.json"
LEAST_QUALITY = 0.5

# No SQL for the stages of classifiers and tokens; tests compare `run` with a version by brute force.
ORACLE_SQL = None


# Columns that the stages read; further ones are carried under names that no operator uses.
READ = ("doc_id", "text", "lang", "source", "n_chars")


def _carried(docs: DataFrame) -> DataFrame:
    return docs.withColumnsRenamed({c: f"__own_{i}" for i, c in enumerate(docs.columns) if c not in READ})


def _given_back(found: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of `docs`, with their names and in their order."""
    own = [F.col(c if c in READ else f"__own_{i}").alias(c) for i, c in enumerate(docs.columns)]
    return found.select(*own)


def _with_text(found: DataFrame, text: Column, docs: DataFrame) -> DataFrame:
    """The columns of the documents with another text and its length."""
    changed = found.withColumn("text", text).withColumn("n_chars", F.char_length("text").cast("long"))
    return _given_back(changed, docs)


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality, by their text and their site, is more likely good than not."""
    classifier = quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = quality.posteriors(quality.evidence(_carried(docs), classifier), host="source", path="lang")
    return _given_back(scored.filter(F.col("score") >= LEAST_QUALITY), docs)


def first_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of near duplicates. Rows of one id stay or go together."""
    found = jaccard.similar_documents(docs)
    gone = found.filter("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 50 words that an earlier document has; all others stay as they are."""
    found = substrings.remove_repeats(_carried(docs))
    return _with_text(found, F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text")), docs)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words that lie in windows of the benchmark; all others stay as they are."""
    found = decontaminate.find_leaks(_carried(docs), table(spark, sf_dir, "benchmark"))
    return _with_text(decontaminate.remove_spans(found), F.col("text"), docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded): ids as little-endian unsigned 32-bit integers, and the text they stand for."""
    return tokens.encode_and_decode(docs, TOKENIZER)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", good_documents),
    ("ngram_jaccard_join", first_of_similar),
    ("substring_dedup", without_repeats),
    ("benchmark_decontamination", without_leaks),
    ("bpe_encoding", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
