"""Profile and grouping aggregations (A1-A12, A16).  Each is one aggregation with
map-side partial aggregation; results are small (per value / per column)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foldwise.session import cut_lineage


def value_counts(df: DataFrame, col: str, dropna: bool = True) -> DataFrame:
    """A1 (dropna) / A3 (null counted as its own group): (value, n)."""
    d = df.filter(F.col(col).isNotNull()) if dropna else df
    return d.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def relative_frequency(df: DataFrame, col: str) -> DataFrame:
    """A2: count / non-null count.  The denominator is a one-row aggregate, not a global window."""
    vc = value_counts(df, col)
    tot = df.agg(F.count(col).alias("_tot"))
    return vc.join(F.broadcast(tot), how="inner").select("value", (F.col("n") / F.col("_tot")).alias("freq"))


def target_stats(df: DataFrame, col: str, y: str) -> DataFrame:
    """A4: mean and count of the target per value (null key dropped, as pandas groupby)."""
    return (df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("value"))
            .agg(F.avg(F.col(y).cast("double")).alias("mean"), F.count(F.lit(1)).alias("n")))


def class_distribution(df: DataFrame, col: str, y: str, k: int) -> DataFrame:
    """A5: P(class | value) for classes 0..k-1 (absent classes -> 0)."""
    agg = df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum((F.col(y) == i).cast("long")).alias(f"_c{i}") for i in range(k)])
    return agg.select("value", *[(F.col(f"_c{i}") / F.col("_n")).alias(f"p{i}") for i in range(k)])


def mean_of_group_means(df: DataFrame, col: str, y: str) -> DataFrame:
    """Global mean of y and the mean of the per-value means."""
    gm = df.agg(F.avg(F.col(y).cast("double")).alias("global_mean"))
    cm = target_stats(df, col, y).agg(F.avg("mean").alias("mean_of_means"))
    return gm.join(F.broadcast(cm), how="inner")


def dense_index(df: DataFrame, col: str, partitions: int | None = None) -> DataFrame:
    """Sorted distinct values with their 0-based index, (value, idx).

    Distinct values are range-partitioned by value (so each partition holds one value
    range), partition sizes give offsets, and the row number is taken per partition only:
    no single task ever holds all distinct values.  The bucketed table is checkpointed so
    a recomputation cannot move a value to another bucket.  ``partitions`` defaults to the session's shuffle partitions.
    """
    partitions = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    d = df.select(F.col(col).alias("value")).filter(F.col("value").isNotNull()).distinct()
    b = cut_lineage(d.repartitionByRange(partitions, "value").withColumn("_b", F.spark_partition_id()))
    cnt = b.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    offs = cnt.select("_b", (F.sum("_n").over(Window.orderBy("_b")) - F.col("_n")).alias("_off"))  # <= partitions rows
    rn = F.row_number().over(Window.partitionBy("_b").orderBy("value"))
    return b.join(F.broadcast(offs), "_b").select("value", (F.col("_off") + rn - 1).cast("long").alias("idx"))


def distinct_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """Exact distinct count per column, (col, n_distinct).

    Long form (col, value) -> distinct -> count per col: two shuffles of distinct pairs
    only, instead of one aggregate with many count(DISTINCT) (which expands every row
    once per column).
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).cast("string").alias("value")) for c in cols])
    long = df.select(F.inline(pairs)).filter(F.col("value").isNotNull())
    return long.distinct().groupBy("col").agg(F.count(F.lit(1)).alias("n_distinct"))


def null_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """A10: (col, n_null) in one aggregation."""
    r = df.agg(*[F.sum(F.isnull(c).cast("long")).alias(c) for c in cols])
    return r.select(F.inline(F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).alias("n_null")) for c in cols])))


def shape(df: DataFrame) -> DataFrame:
    """(n_rows, n_cols)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)).cast("long"))


def head(df: DataFrame, id_col: str, n: int = 5) -> DataFrame:
    """First n rows by id (a top-n, the feature itself)."""
    return df.orderBy(id_col).limit(n)


def class_balance(df: DataFrame, y: str, by: list[str] | None = None) -> DataFrame:
    """Counts per class (per split)."""
    return df.groupBy(*(by or []), F.col(y).alias("label")).agg(F.count(F.lit(1)).alias("n"))


def column_means(df: DataFrame, cols: list[str]) -> dict:
    """Column means (one aggregation) for the safety fill ``fillna(means)``."""
    r = df.agg(*[F.avg(c).alias(c) for c in cols]).collect()[0]
    return {c: r[c] for c in cols}
