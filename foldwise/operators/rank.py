"""Ranks without global windows (W1, W4, A8 helpers).

``cumulative_before`` gives, for every distinct sort key inside an optional group,
the total weight of the keys before it.  Keys are range-partitioned (each partition
holds a contiguous key range), partition totals become offsets (a table of
partitions x groups rows) and the running sum is taken inside a partition only, so
no task ever holds a whole group.  Averaged ranks (``rankdata(method='average')``),
dense indices and run rankings are built on it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foldwise.session import cut_lineage, join_dim


def cumulative_before(df: DataFrame, keys: list[str], weight: str, group: list[str] | None = None,
                      partitions: int | None = None) -> DataFrame:
    """df holds one row per (group, keys) with a weight; adds ``_before`` = sum of weights of
    smaller keys in the same group (keys compared in order; ties impossible: keys are distinct).

    ``partitions`` defaults to the session's number of shuffle partitions, which is sized for the data."""
    group = group or []
    partitions = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    b = cut_lineage(df.repartitionByRange(partitions, *group, *keys).withColumn("_b", F.spark_partition_id()))
    tot = b.groupBy(*group, "_b").agg(F.sum(weight).alias("_t"))
    w_off = Window.partitionBy(*group).orderBy("_b") if group else Window.orderBy("_b")  # <= partitions rows per group
    offs = tot.select(*group, "_b", (F.sum("_t").over(w_off) - F.col("_t")).alias("_off"))
    w_in = Window.partitionBy(*group, "_b").orderBy(*keys)
    run = F.sum(weight).over(w_in) - F.col(weight)
    return b.join(F.broadcast(offs), [*group, "_b"]).withColumn("_before", F.col("_off") + run).drop("_b", "_off")


def average_rank(df: DataFrame, value: str, group: list[str] | None = None, out: str = "rank") -> DataFrame:
    """1-based average rank of ``value`` within ``group`` (ties share the mean rank)."""
    group = group or []
    counts = df.groupBy(*group, value).agg(F.count(F.lit(1)).alias("_c"))
    cb = cumulative_before(counts, [value], "_c", group)
    dim = cb.select(*group, value, (F.col("_before") + (F.col("_c") + 1) / 2.0).alias(out))
    # few distinct scores are broadcast; else a saturated score is one hot key of a join that adaptive execution splits
    return join_dim(df, cut_lineage(dim), [*group, value], "inner")


def rank_normalised(df: DataFrame, value: str, group: list[str] | None = None, out: str = "rank_norm") -> DataFrame:
    """Average rank divided by the largest average rank of the group."""
    group = group or []
    r = average_rank(df, value, group, "_r")
    if not group:
        mx = r.agg(F.max("_r")).collect()[0][0]
        return r.withColumn(out, F.col("_r") / F.lit(mx)).drop("_r")
    mx = r.groupBy(*group).agg(F.max("_r").alias("_mx"))  # one row per group
    return r.join(F.broadcast(mx), group).withColumn(out, F.col("_r") / F.col("_mx")).drop("_r", "_mx")


def best_by(df: DataFrame, score: str, tiebreak: list[str], group: list[str] | None = None) -> DataFrame:
    """W4 best run / K9 winner: max score, first candidate on ties (keys of any type) -- one aggregation with min_by."""
    group = group or []
    key = F.struct((-F.col(score)).alias("s"), *[F.col(t).alias(f"t{i}") for i, t in enumerate(tiebreak)])
    cols = [c for c in df.columns if c not in group]
    agg = df.groupBy(*group).agg(F.min_by(F.struct(*cols), key).alias("_best"))
    return agg.select(*group, "_best.*")


def rank_runs(df: DataFrame, score: str, tiebreak: list[str], out: str = "rank") -> DataFrame:
    """1-based position of each run ordered by score desc, then tiebreak asc (runs are few)."""
    w = Window.orderBy(F.col(score).desc(), *[F.col(t).asc() for t in tiebreak])  # runs table: parameter-sized
    return df.withColumn(out, F.row_number().over(w))
