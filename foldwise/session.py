"""Session helpers: building a session for tests / bench, lineage cuts, size-checked broadcast."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Bytes above which a dimension table is joined by shuffle instead of broadcast.
BROADCAST_MAX_BYTES = 64 << 20


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "foldwise") -> SparkSession:
    """Session for tests and the bench. On a cluster the caller brings its own session."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names for checkpoints, if any."""
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        spark.sparkContext.setCheckpointDir(d)
    return d


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the session's checkpoint dir; only a local session without one (tests, bench) gets a scratch folder."""
    d = checkpoint_dir(spark)
    if not d:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="foldwise-ckpt-", dir=os.environ.get("FOLDWISE_SCRATCH", "/tmp"))
        spark.sparkContext.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame) -> DataFrame:
    """The rows written once to the shared checkpoint folder and read again (survives executor loss; columns stay prunable)."""
    return stage(df)


def stage(df: DataFrame, replaces: DataFrame | None = None) -> DataFrame:
    """The rows written as parquet to the shared checkpoint folder and read again; a stage that it ``replaces`` is deleted then.

    All others are deleted when the application ends."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    delete_on_exit(spark, path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stage_path = path
    if replaces is not None:
        discard(replaces)
    return out


def stage_spread(df: DataFrame) -> DataFrame:
    """A stage that many passes will read: a small table is dealt over as many files as there are cores."""
    out, n = stage(df), df.sparkSession.sparkContext.defaultParallelism
    return stage(out.repartition(n), replaces=out) if out.rdd.getNumPartitions() < n else out


def delete_on_exit(spark: SparkSession, path: str) -> None:
    """Has the file system delete a folder of intermediate rows when the driver ends."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)


def discard(staged: DataFrame) -> None:
    """Deletes the files of a stage whose rows are no longer needed."""
    spark, path = staged.sparkSession, staged.__dict__.get("_stage_path")
    if path:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def table_bytes(df: DataFrame, rows: int | None = None) -> int:
    """Bytes of a fitted table: 16 a number, strings and arrays by their lengths; with known ``rows``, 64 a string and 256 an array."""
    kinds = dict(df.dtypes)
    text = [c for c, t in kinds.items() if t == "string"]
    arrays = [c for c, t in kinds.items() if t.startswith("array")]
    flat = 16 * (len(kinds) - len(text) - len(arrays))
    if rows is not None:
        return rows * (flat + 64 * len(text) + 256 * len(arrays))
    each = F.lit(flat)
    for c in text:
        each = each + 16 + F.coalesce(F.octet_length(c), F.lit(0))
    for c in arrays:
        each = each + 16 + 16 * F.greatest(F.size(c), F.lit(0))
    return int(df.agg(F.sum(each.cast("long"))).first()[0] or 0)


def join_dim(big: DataFrame, dim: DataFrame, on, how: str = "left", max_bytes: int = BROADCAST_MAX_BYTES, dim_rows: int | None = None) -> DataFrame:
    """Join a fitted dimension table; broadcast it only when its bytes are checked to be few.

    ``dim_rows`` lets a caller pass a bound of its rows that it already knows (e.g. number of folds x classes);
    otherwise the table is summed (it is an aggregate, so that is cheap).
    Above the bound the join is left to Catalyst / AQE (shuffle join, skew-join splitting).
    """
    if table_bytes(dim, dim_rows) <= max_bytes:
        dim = F.broadcast(dim)
    return big.join(dim, on=on, how=how)
