"""The corpus pipeline: quality rules, exact dedup, near dedup, mixing, encoding.

``STAGES`` are (name, function) pairs; a function takes (spark, docs, sf_dir) and
returns a DataFrame. Each stage works on all that its predecessor kept and its
decisions take effect; all but the last return the columns of ``documents``.
``run`` writes every stage as Parquet to the shared folder and reads it again.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

from marquee.llm import bpe_automaton, exact_dedup, mixing, ngram_join, quality_rules
from marquee.llm.scratch import documents, ship_package, written
from marquee.sources.tables import table


def stage(work):
    """A stage as the pipeline's callers run it: on a session that can run this package's tasks."""
    @functools.wraps(work)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return work(spark, docs, sf_dir)
    return run_stage


@stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go. Cutoffs come from narrow measures; texts pass the scan only."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


@stage
def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row stays, the one with the largest id."""
    return exact_dedup.keep_first(docs)


@stage
def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one document stays, the one with the smallest id."""
    return ngram_join.keep_smallest(docs)


@stage
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mixture takes it, dealt to shards by the splitting tree and shuffled in them."""
    return mixing.mixed_rows(docs)


@stage
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every row of the mixture."""
    return bpe_automaton.encode_documents(docs, bpe_automaton.word_bpe_path())


STAGES = [("quality rules", quality), ("exact dedup", exact), ("n-gram Jaccard join", near), ("mixing", mix), ("BPE encoding", encode)]

#: Exact binomial cutoffs and dedup are SQL, but the mixture's permutation and the tokenizer are not.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = documents(spark, sf_dir)
    for name, work in STAGES:
        docs = written(work(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-").lower())
    return docs
