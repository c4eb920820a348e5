"""The text pipeline: documents go through five stages, each written and read again.

A stage gets all that the one before kept; all but the last return the columns of documents.
Nulls, empty texts, ties and repeated rows have the results that the operators' docstrings state;
empty tables go through.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

from concord.llm import decontaminate, exact, mixing, near, toxicity
from concord.llm.frames import free_sent, shipped, small_batches, table, written


def stage(function):
    """A stage that ships the package first, frees what the stages before have sent, and works in small batches."""

    @functools.wraps(function)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        free_sent(spark)
        small_batches(spark)
        return shipped(function)(spark, docs, sf_dir)

    return run


@stage
def _toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity models reject go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


@stage
def _exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays."""
    return exact.keep_exact(docs)


@stage
def _near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one document stays."""
    return near.keep_one(docs)


@stage
def _decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with words of the benchmark's windows go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


@stage
def _mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document that is left."""
    return mixing.mix_sources(docs)


STAGES = [
    ("toxicity", _toxicity),
    ("exact dedup", _exact),
    ("n-gram Jaccard join", _near),
    ("benchmark decontamination", _decontaminate),
    ("mixing sources", _mix),
]

#: The models of the first stage have no SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of sf_dir; intermediate tables are in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for _, function in STAGES[:-1]:
        docs = written(function(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
