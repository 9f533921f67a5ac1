"""The corpus pipeline: documents to packed training sequences.

Each stage takes (spark, docs, sf_dir), works on all rows that the one before kept, and returns a DataFrame, which is
written as Parquet and read again for the next. All but the last return the columns of documents.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attestry.llm import decontaminate, jaccard, language, packing, suffixes
from attestry.llm.queries import prepared, table, tokenizer
from attestry.llm.store import drop, noted, release, stored

#: Passages of over so many words that stand elsewhere as well go, and so do repeated stretches of 400 bytes.
PASSAGE = 50

#: Tables that the newest stage over a folder has stored. They are read until that stage's result is written.
_HELD: dict[str, list[str]] = {}


def _stage(work: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """A stage that deletes what the one before has stored, as its result is written by now."""

    @functools.wraps(work)
    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        prepared(spark)
        release(_HELD.pop(sf_dir, []), docs)
        with noted() as paths:
            out = work(spark, docs, sf_dir)
        _HELD[sf_dir] = paths
        return out

    return stage


@_stage
def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labels teach; texts without letters and texts that no model explains go."""
    return language.keep_known(docs, language.fit(docs))


@_stage
def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest id."""
    return jaccard.keep_one(docs)


@_stage
def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the long passages that stand elsewhere as well. No document goes; n_chars follows its text."""
    kept = suffixes.remove(docs, passage=PASSAGE + 1)
    return kept.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else kept


@_stage
def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


@_stage
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all documents' tokens in training sequences."""
    return packing.pack(docs, tokenizer())


STAGES = [
    ("language_id", known_language),
    ("ngram_jaccard", one_of_each),
    ("suffix_dedup", without_repeats),
    ("decontaminate", without_benchmark),
    ("packing", packed),
]

#: The stages can't be put as SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before, docs = docs, stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        drop(before)
    release(_HELD.pop(sf_dir, []), docs)
    return docs
