"""Deterministic folds and splits.

A row's place is fixed by ``md5('<seed>:<id>')`` and the id, so any engine can
repeat the assignment (numpy shuffles cannot be repeated).  Stratified k-fold gives
the rank of the row inside its class, modulo k; the hold-out takes the first
``round(frac * n_class)`` ranks of each class.

Scale: a plain ``row_number() over (partition by class ...)`` would put a whole
class (possibly a third of all rows) into one task.  Instead the rank is computed in
two levels: rows are split into ``16**prefix`` hash buckets (uniform, so a hot class
is split evenly), bucket counts give each bucket's offset inside its class (a small
table of at most classes x 16**prefix rows), and the row number is taken inside
(class, bucket) only.  The result equals the global per-class row number exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F



def hash_key(id_col: str, seed: int | str) -> Column:
    """Hex md5 of ``'<seed>:<id>'``; orders rows the same way in Spark and in SQL engines."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string")))


def stratified_rank(df: DataFrame, id_col: str, strata: str | None, seed: int | str, prefix: int = 4,
                    rank_col: str = "_rank", size_col: str = "_n_stratum") -> DataFrame:
    """Add the 0-based rank of each row inside its stratum, ordered by (hash, id), and the stratum size.

    Rows are shuffled and sorted once, by (stratum, bucket), and numbered inside it.  Bucket sizes are counted beside
    that from the id and the stratum alone, with map-side partial counts (a table of at most strata x
    16**prefix rows); their running sum per stratum gives each bucket's offset, which joins the numbered rows
    where they lie.
    """
    # stratum as two non-null plain keys (null flag, text): equality joins and partitionings then
    # line up exactly (no null-safe or float-normalised key forcing another exchange)
    stn = F.isnull(F.col(strata)) if strata else F.lit(False)
    stv = F.coalesce(F.col(strata).cast("string"), F.lit("")) if strata else F.lit("")
    keys = ["_stn", "_stv", "_b"]
    d = (df.withColumn("_stn", stn).withColumn("_stv", stv).withColumn("_h", hash_key(id_col, seed))
         .withColumn("_b", F.substring("_h", 1, prefix)))
    ranked = d.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy("_h", id_col)))
    counts = d.groupBy(*keys).agg(F.count(F.lit(1)).alias("_cnt"))
    w_st = Window.partitionBy("_stn", "_stv")
    offs = counts.select(
        *keys,
        (F.sum("_cnt").over(w_st.orderBy("_b")) - F.col("_cnt")).alias("_off"),
        F.sum("_cnt").over(w_st).alias(size_col),
    )
    out = ranked.join(offs, keys, "inner").withColumn(rank_col, F.col("_off") + F.col("_rn") - 1)
    return out.drop("_stn", "_stv", "_h", "_b", "_off", "_rn")


def stratified_kfold(df: DataFrame, id_col: str, label: str, k: int = 5, seed: int = 42,
                     fold_col: str = "fold", prefix: int = 4) -> DataFrame:
    """Stratified, shuffled, seeded k-fold; per class the fold sizes differ by at most one."""
    r = stratified_rank(df, id_col, label, seed, prefix)
    return r.withColumn(fold_col, (F.col("_rank") % k).cast("int")).drop("_rank", "_n_stratum")


def kfold(df: DataFrame, id_col: str, k: int = 5, seed: int = 42, fold_col: str = "fold", prefix: int = 4) -> DataFrame:
    """Plain shuffled k-fold (one stratum)."""
    r = stratified_rank(df, id_col, None, seed, prefix)
    return r.withColumn(fold_col, (F.col("_rank") % k).cast("int")).drop("_rank", "_n_stratum")


def stratified_holdout(df: DataFrame, id_col: str, label: str, frac: float = 0.2, seed: int = 7,
                       split_col: str = "split", prefix: int = 4) -> DataFrame:
    """Stratified hold-out; the first ``round(frac * n_class)`` rows of each class go to 'test'."""
    r = stratified_rank(df, id_col, label, seed, prefix)
    is_test = F.col("_rank") < F.round(F.col("_n_stratum") * F.lit(float(frac)))
    return r.withColumn(split_col, F.when(is_test, F.lit("test")).otherwise(F.lit("train"))).drop("_rank", "_n_stratum")


def holdout_and_kfold(df: DataFrame, id_col: str, label: str, frac: float = 0.2, k: int = 5, seed: int = 42,
                      split_col: str = "split", fold_col: str = "fold", prefix: int = 4) -> DataFrame:
    """W7 + W5 from ONE ranking pass.

    Both use the order (hash(seed:id), id) inside the class: the first
    ``t_c = round(frac * n_c)`` rows of class c are 'test'; a train row's rank among
    the train rows of its class is ``rank - t_c``, so its fold is ``(rank - t_c) % k``.
    Test rows get fold -1.
    """
    r = stratified_rank(df, id_col, label, seed, prefix)
    t_c = F.round(F.col("_n_stratum") * F.lit(float(frac))).cast("long")
    is_test = F.col("_rank") < t_c
    return (r.withColumn(split_col, F.when(is_test, F.lit("test")).otherwise(F.lit("train")))
            .withColumn(fold_col, F.when(is_test, F.lit(-1)).otherwise((F.col("_rank") - t_c) % k).cast("int"))
            .drop("_rank", "_n_stratum"))


def stratified_sample_split(df: DataFrame, id_col: str, label: str, frac: float = 0.2, test_frac: float = 0.2,
                            seed: int = 7, prefix: int = 4) -> DataFrame:
    """Stratified sample of ``frac`` of the rows, then a stratified split of that sample.

    Returns the sampled rows only with a ``split`` column; the sample is the sampling feature
    itself (not a cap), and both steps are exact hold-outs.
    """
    s = stratified_holdout(df, id_col, label, frac, seed, "_in_sample", prefix).filter(F.col("_in_sample") == "test")
    return stratified_holdout(s.drop("_in_sample"), id_col, label, test_frac, f"{seed}s", "split", prefix)


def union_train_test(train: DataFrame, test: DataFrame) -> DataFrame:
    """Union by column name; columns missing on one side (the label) become null."""
    return train.unionByName(test, allowMissingColumns=True)
