"""Shared preparation of the study tables: hold-out split and folds, materialised once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.operators.folds import holdout_and_kfold
from foldwise.session import cut_lineage, discard, stage
from foldwise.sources.tables import orders_base

SEED = 42


def split_train_test(df: DataFrame, id_col: str, label: str, frac: float = 0.2, k: int = 5,
                     seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """W7 hold-out (the 'test' part plays test.csv) and W5 folds on the train part, one ranking pass.

    The split table is cut from its lineage once (checkpoint in the shared folder), so
    train and test do not each recompute the source joins and the rank window.
    """
    source = stage(df)  # the ranking reads it twice, the source tables are read and joined once
    s = cut_lineage(holdout_and_kfold(source, id_col, label, frac, k, seed))
    discard(source)
    train = s.filter(F.col("split") == "train").drop("split")
    test = s.filter(F.col("split") == "test").drop("split", "fold")
    return train, test


def orders_train_test(spark: SparkSession, sf_dir: str, label: str = "y_bin", k: int = 5):
    return split_train_test(orders_base(spark, sf_dir), "id", label, k=k)
