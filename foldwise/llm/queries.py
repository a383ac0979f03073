"""Registered queries of the subpackage (spark, sf_dir) -> DataFrame, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.llm import chat, decontaminate, forest, jaccard_join, language, line_dedup, lm, merkle, mixing, repair, secrets, substring_dedup, toxicity
from foldwise.llm.common import ship, table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return fn(spark, sf_dir)
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if sql:
            ORACLE[name] = sql
        return run
    return deco


@register("op6_line_dedup", line_dedup.PAGE_REPORT_SQL)
def op6(spark, sf_dir):
    """Boilerplate lines of each site dropped from its web pages."""
    return line_dedup.page_report(table(spark, sf_dir, "pages"))


@register("op9_secret_scan", secrets.SCAN_SQL)
def op9(spark, sf_dir):
    """Secrets of every document, with ownership of their values over the corpus."""
    return secrets.scan(table(spark, sf_dir, "documents"))


@register("op2_decontamination", decontaminate.REPORT_SQL)
def op2(spark, sf_dir):
    """Benchmark windows of ten words in every document."""
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op7_nearest_neighbours")
def op7(spark, sf_dir):
    """20 nearest rows, by inner product, of every embedding whose id is divisible by 20."""
    return forest.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@register("op4_substring_dedup", substring_dedup.REPORT_SQL)
def op4(spark, sf_dir):
    """Windows of 20 words that start earlier in the corpus cut out of every document."""
    return substring_dedup.dedup(table(spark, sf_dir, "documents"), digest=True).withColumnRenamed("kept", "kept_sha256")


@register("op3_language_id")
def op3(spark, sf_dir):
    """Language of every document by byte-context code lengths."""
    return language.report(table(spark, sf_dir, "documents"))


@register("op8_toxicity")
def op8(spark, sf_dir):
    """Toxicity of every document by compression distance."""
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op5_lm_scoring")
def op5(spark, sf_dir):
    """Log probability of every document by logistic context mixing, and by smoothed word counts."""
    return lm.report(table(spark, sf_dir, "documents"))


@register("op10_source_mixing")
def op10(spark, sf_dir):
    """Posteriors of every document over the domains of the labelled table, and rates that meet the target weights."""
    return mixing.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op1_jaccard_join", jaccard_join.JOIN_SQL)
def op1(spark, sf_dir):
    """Near-duplicate class and number of links of every document."""
    return jaccard_join.join(table(spark, sf_dir, "documents")).drop("key")


@register("op11_merkle_manifest", merkle.REPORT_SQL)
def op11(spark, sf_dir):
    """Merkle proof of every document, checked after some texts were changed."""
    return merkle.report(table(spark, sf_dir, "documents"))


@register("op12_chat_formatting", chat.REPORT_SQL)
def op12(spark, sf_dir):
    """All conversations in the chat template, read back with their loss mask."""
    return chat.report(table(spark, sf_dir, "conversations"))


@register("op13_conversation_repair", repair.REPORT_SQL)
def op13(spark, sf_dir):
    """Cheapest structural repair of every conversation after damage."""
    return repair.report(table(spark, sf_dir, "conversations"))
