"""Sources and sinks (S1-S6): CSV with explicit schema, submission CSV, stage tables.

Stage tables go under the session's shared checkpoint folder (``spark.checkpoint.dir``)
unless a path is given, so every executor can read what another wrote.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from foldwise.session import ensure_checkpoint_dir


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Header CSV with an explicit schema (no inference pass)."""
    return spark.read.schema(schema).option("header", True).csv(path)


def write_submission(df: DataFrame, path: str, partition_by: list[str] | None = None, single_file: bool = False) -> None:
    """(id, label) CSV with header; one directory per seed with ``partition_by=['seed']``.
    ``single_file`` coalesces to one part file (only for small results)."""
    out = df.coalesce(1) if single_file else df
    w = out.write.mode("overwrite").option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


def write_stage(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Parquet stage table (probabilities, meta features), partitioned by seed / stage."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    """Read a stage table; filters on partition columns prune directories."""
    return spark.read.parquet(path)


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory for a stage table."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/stage/{name}-{uuid.uuid4().hex[:12]}"
