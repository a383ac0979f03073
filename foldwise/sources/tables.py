"""Bindings of the study roles to the driver tables.

binary table B / 5-class table C: one row per order, built from orders, customer,
nation, region and per-order lineitem sums.  vectors V: embeddings.  quality Q:
documents joined with labels.  All are plain DataFrame plans; Catalyst prunes the
parquet columns and pushes filters into the scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Feature roles of table B / C (fixed values of this binding).
ORDER_ID = "id"
ORDER_NUM = ["o_totalprice", "c_acctbal", "li_qty", "li_lines", "li_disc"]
ORDER_CAT = ["c_mktsegment", "n_name", "r_name", "o_year"]  # plus o_orderpriority (B) / o_orderstatus (C)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def orders_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: id, labels, numerics (with nulls), categories (with nulls).

    * ``y_bin``   = 1.0 when ``o_orderstatus = 'F'`` (the binary label)
    * ``o_orderpriority`` (5 levels) is the label of table C and is a
      feature of table B; ``o_orderstatus`` is B's label source and a feature of C
    * ``c_acctbal`` is null for every 7th order key and ``c_mktsegment`` for every
      11th, so imputers and null-aware encoders have work (the driver tables hold no nulls)
    * ``li_*`` are null for orders without line items (a natural left-join null)

    nation (25 rows) and region (5 rows) are fixed-size TPC-H dimensions, so they are
    broadcast; customer and the lineitem aggregate are joined by key (shuffle at scale).
    """
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    li = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.sum("l_quantity").alias("li_qty"),
            F.count(F.lit(1)).cast("double").alias("li_lines"),
            F.avg("l_discount").alias("li_disc"),
        )
    )
    nr = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
    df = (
        o.join(c, o.o_custkey == c.c_custkey)
        .join(F.broadcast(nr), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(li, o.o_orderkey == li.l_orderkey, "left")
    )
    key = F.col("o_orderkey")
    return df.select(
        key.alias("id"),
        (F.col("o_orderstatus") == F.lit("F")).cast("double").alias("y_bin"),
        F.col("o_orderpriority"),
        F.col("o_orderstatus"),
        F.col("o_totalprice"),
        F.when(key % 7 == 0, F.lit(None).cast("double")).otherwise(F.col("c_acctbal")).alias("c_acctbal"),
        F.col("li_qty"),
        F.col("li_lines"),
        F.col("li_disc"),
        F.when(key % 11 == 0, F.lit(None).cast("string")).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
        F.col("n_name"),
        F.col("r_name"),
        F.year("o_orderdate").cast("string").alias("o_year"),
    )


def embeddings_base(spark: SparkSession, sf_dir: str, n_dims: int | None = None) -> DataFrame:
    """Vector table V: id, label, ``x`` as array<double> (first ``n_dims`` dimensions or all)."""
    e = table(spark, sf_dir, "embeddings")
    x = F.transform("embedding", lambda v: v.cast("double"))
    if n_dims is not None:
        x = F.slice(x, 1, n_dims)
    return e.select(F.col("vec_id").alias("id"), F.col("label").cast("long").alias("label"), x.alias("x"))


def quality_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text-quality table Q: labelled documents with their light-weight columns only."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return d.join(lab, "doc_id").select(
        F.col("doc_id").alias("id"),
        F.col("quality").cast("double").alias("y"),
        "lang",
        "source",
        F.col("n_chars").cast("double").alias("n_chars"),
    )
