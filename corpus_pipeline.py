"""The corpus pipeline: documents in, token ids of clean documents out.

Every stage is a function of (spark, docs, sf_dir) and works on all rows that
the stage before it kept; its result is written as Parquet and read again, so a
lost executor never reaches back beyond a stage.  All but the last return the
columns of documents.

What a stage wrote on its way is dropped when the next stage begins, as its result
is a table of its own by then; a result that still reads from it keeps it.  Every
stage handles nulls, empty and very long texts, repeated rows and ties as its
operator says: a null or empty text has no lines, shingles or tokens; equal rows are
each judged alike, and of a group the smallest doc_id stays (ties by row); an empty
table passes through empty.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from veilspark.llm.bpe import bpe_round_trip
from veilspark.llm.decontaminate import clean
from veilspark.llm.jaccard import one_per_component
from veilspark.llm.lines import without_repeated_lines
from veilspark.llm.quality_rules import good_rows
from veilspark.sources.stage import drop_unread, live_stages, staged

_left: set[str] = set()


def _stage(work: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """``work``, after which its intermediate tables are known, so that the next stage drops them."""

    @wraps(work)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        global _left
        _left = drop_unread(_left, docs)
        before = live_stages()
        result = work(spark, docs, sf_dir)
        _left = _left | live_stages() - before
        return result

    return run_stage


@_stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that weak supervision over the rules finds good."""
    return good_rows(docs)


@_stage
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated and nearly repeated lines go; so do documents left without a word.
    ``n_chars`` follows the text."""
    return without_repeated_lines(docs).withColumn("n_chars", F.length("text").cast("long"))


@_stage
def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, 0.8."""
    return one_per_component(docs, width=5, percent=80)


@_stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark item."""
    return clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@_stage
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of ids and of the decoded text."""
    return bpe_round_trip(
        docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN,
        keep=["doc_id", "lang", "source"], outputs=("n_tokens", "ids", "ids_sha256", "decoded_sha256"),
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("jaccard_join", jaccard_join),
    ("decontamination", decontamination),
    ("bpe", tokens),
]

# Expectation maximisation, banding and byte-pair merges have no SQL form; the
# stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            before = live_stages()
            docs = staged(docs)
            _left.update(live_stages() - before)  # kept by the next stage, which reads it, and dropped by the one after
    return docs
