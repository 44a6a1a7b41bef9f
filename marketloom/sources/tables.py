"""Where results are kept: views, full-refresh tables, appended tables, and
scratch tables that cut lineage.

Scratch tables go to the folder the cluster names in ``spark.checkpoint.dir``
(shared storage, so they survive the loss of an executor).  Where the setting is
absent, a local master, as in unit tests, uses a temporary folder; a cluster is
refused, because executors would write to disks of their own."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_fallback: list[str] = []

#: Rows of the largest input table behind one partition of a shuffle or one bucket.
PARTITION_ROWS = 1_000_000


def shared_dir(spark: SparkSession) -> str:
    """Root folder for scratch tables of this application."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if not _fallback:
            _fallback.append(tempfile.mkdtemp(prefix="marketloom-"))
        base = _fallback[0]
    return f"{base.rstrip('/')}/marketloom/{spark.sparkContext.applicationId}"


def write_scratch(df: DataFrame, label: str, folder: str | None = None) -> DataFrame:
    """Write ``df`` once and return a reader over the written files.  A caller that
    gives its own ``folder`` deletes it when it is done (``Folder.delete``)."""
    spark = df.sparkSession
    path = f"{folder or shared_dir(spark) + '/scratch'}/{label}-{uuid.uuid4().hex[:12]}"
    df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def deal_by_size(spark: SparkSession, rows: int) -> int:
    """Deal rows to more partitions, if an input of ``rows`` rows asks for it, so that what a
    task sorts or groups does not grow with the input.  Adaptive execution joins small
    partitions again; buckets are as many.  Never fewer than the session deals to already."""
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    least = int(spark.conf.get(initial, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    n = max(least, -(-rows // PARTITION_ROWS))
    if n > least:
        spark.conf.set(initial, str(n))
    return n


def write_buckets(df: DataFrame, label: str, key: str) -> DataFrame:
    """Write ``df`` once, dealt by ``key``: what groups its rows by the key, or joins
    tables dealt by the same key, needs no shuffle.  One task writes all rows of a key."""
    spark = df.sparkSession
    # as many as Spark deals rows to otherwise: with fewer, it would deal the table again
    n = int(
        spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
        or spark.conf.get("spark.sql.shuffle.partitions")
    )
    name = f"{label}_{uuid.uuid4().hex[:12]}"
    dealt = df.repartition(n, key).write.bucketBy(n, key).option("compression", "zstd")
    dealt.option("path", f"{shared_dir(spark)}/scratch/{name}").saveAsTable(name)
    return spark.table(name)


def save_view(df: DataFrame, name: str) -> DataFrame:
    """Materialise nothing: register a temporary view."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def save_table(df: DataFrame, path: str, mode: str = "overwrite") -> DataFrame:
    """Full-refresh (``overwrite``) or append into a Parquet table."""
    if mode not in ("overwrite", "append"):
        raise ValueError(f"unsupported mode {mode!r}")
    df.write.mode(mode).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
