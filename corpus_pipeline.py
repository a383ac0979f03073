"""Corpus pipeline over the ``documents`` table: each stage works on all that the one before kept.

Every stage but the last returns the columns of ``documents``; the last adds the rate of each document (expected copies) and
the copies drawn.  A stage's result is written as Parquet and read again as the next stage's input.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.llm import decontaminate, jaccard_join, line_dedup, mixing, toxicity
from foldwise.llm.common import ship, staged, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def stage(fn):
    """A stage ships the package to the Python workers before its first job, and sees the columns of ``documents`` only."""
    @functools.wraps(fn)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, docs.select(*COLUMNS), sf_dir)
    return run


@stage
def toxic(spark, docs, sf_dir):
    """Documents that the compression distance scores as toxic go."""
    return toxicity.reject(docs, table(spark, sf_dir, "labels"))


@stage
def lines(spark, docs, sf_dir):
    """Lines that over a tenth of a source's documents share go; n_chars follows."""
    return line_dedup.dedup_lines(docs, "source", "text").withColumn("n_chars", F.length("text").cast("long"))


@stage
def near(spark, docs, sf_dir):
    """One document of each group of near duplicates stays (word shingles of five, Jaccard similarity of 0.8 or more)."""
    return jaccard_join.one_of_each(docs)


@stage
def leaks(spark, docs, sf_dir):
    """Documents that hold ten consecutive words of a benchmark item, or a whole shorter item, go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


@stage
def weights(spark, docs, sf_dir):
    """Rates at which the documents meet the target shares of the labelled domains."""
    return mixing.mixed(docs, table(spark, sf_dir, "labels"))


STAGES = [("toxicity", toxic), ("line_dedup", lines), ("jaccard_join", near), ("decontamination", leaks), ("source_mixing", weights)]

#: a trained classifier, a randomised join and an iterative fit have no SQL form; tests/llm holds each stage against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, f) in enumerate(STAGES):
        docs = f(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = staged(docs)
    return docs
