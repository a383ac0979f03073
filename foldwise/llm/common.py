"""Helpers shared by the operators: staged tables, reading, driver-side bounds."""

from __future__ import annotations

import hashlib
import os
import shutil
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.session import checkpoint_dir, delete_on_exit, ensure_checkpoint_dir

_SHIPPED: set = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: bytes of an Arrow batch between Spark and the Python workers: texts are long, and both sides hold a batch or two
BATCH_BYTES = 4 << 20


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, as ``--py-files`` would; once per application.

    Arrow batches of the session are bounded by bytes unless it says how large they are to be."""
    key = spark.sparkContext.applicationId
    bound = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not spark.sparkContext.getConf().contains(bound):
        spark.conf.set(bound, str(BATCH_BYTES))
    if key in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    out = tempfile.mkdtemp(prefix="foldwise-llm-")
    spark.sparkContext.addPyFile(shutil.make_archive(os.path.join(out, "foldwise"), "zip", root_dir=root, base_dir="foldwise"))
    _SHIPPED.add(key)


def staged(df: DataFrame) -> DataFrame:
    """The rows written to, and read again from, the shared folder of spark.checkpoint.dir.

    It cuts the lineage (a lost executor costs no recomputation of what came before) and gives
    the planner the true size.  The folder is deleted when the driver ends.  Only where the session names no folder (tests) a scratch one is made."""
    spark = df.sparkSession
    base = checkpoint_dir(spark) or ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    delete_on_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if(df: DataFrame, max_rows: int = 500_000) -> DataFrame:
    """``df`` (a staged table of a few narrow columns) with a broadcast hint if it is counted to be small; else the join is a shuffle."""
    return F.broadcast(df) if df.count() <= max_rows else df


def fresh(names, *wanted: str) -> list[str]:
    """Names not used by the columns ``names``, for working columns beside any extra columns of the caller."""
    out = []
    for w in wanted:
        while w.lower() in {n.lower() for n in names} | {n.lower() for n in out}:
            w = "_" + w
        out.append(w)
    return out


def sha256_hex(c):
    return F.sha2(F.encode(c, "UTF-8"), 256)


def text_bytes(df: DataFrame, col: str) -> int:
    """UTF-8 bytes of a text column over all rows."""
    return int(df.agg(F.sum(F.octet_length(col))).first()[0] or 0)


def text_key(col: str):
    """64-bit key of a text; with the document's id it names a document (rows equal in both are the same document)."""
    return F.xxhash64(F.coalesce(F.col(col), F.lit("")))


def hash_share(marked: DataFrame, label: str, id_col: str, max_rows: int, salt: int = 0) -> DataFrame:
    """The rows of a labelled table whose id hashes into a share that leaves about ``max_rows`` rows of each label (all, if fewer)."""
    bound = marked.groupBy(F.col(label).alias("_of")).agg(F.least(F.lit(1.0), F.lit(float(max_rows)) / F.count(F.lit(1))).alias("_share"))
    place = F.pmod(F.xxhash64(id_col, F.lit(salt)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    return marked.join(F.broadcast(bound), F.col(label) == F.col("_of")).filter(place < F.col("_share")).drop("_of", "_share")


def sampled_pieces(text: bytes, max_bytes: int, piece: int = 4096) -> bytes:
    """The text if it has at most ``max_bytes``; else as many pieces of it, drawn by hash from its whole length, in their order."""
    if len(text) <= max_bytes:
        return text
    n = len(text) // piece
    drawn = sorted(range(n), key=lambda i: hashlib.blake2b(text[i * piece : (i + 1) * piece] + str(i).encode(), digest_size=8).digest())[: max(1, max_bytes // piece)]
    return b"".join(text[i * piece : (i + 1) * piece].decode(errors="ignore").encode() for i in sorted(drawn))


def bounded_texts(rows: DataFrame, label: str, id_col: str, text: str, max_bytes: int = 65536, salt: int = 0):
    """Rows of a bounded sample on the driver: Arrow table (label, text) in the order of a hash; of texts of over ``max_bytes`` pieces
    drawn by hash from their whole length."""
    def cut(batches):
        for b in batches:
            texts = [sampled_pieces(x.as_buffer().to_pybytes(), max_bytes).decode() for x in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("h"), b.column("label"), pa.array(texts, pa.string())], ["h", "label", "text"])

    kind = rows.schema[label].dataType.simpleString()
    few = rows.filter(F.col(text).isNotNull()).select(F.xxhash64(id_col, F.lit(salt)).alias("h"), F.col(label).alias("label"), F.col(text).alias("text"))
    return few.mapInArrow(cut, f"h long, label {kind}, text string").orderBy("h", "text").select("label", "text").toArrow()


def fold(id_col, mod: int):
    """crc32 of the id as text, modulo ``mod``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % mod
