"""Contiguous balanced shards from global prefix sums of byte sizes.

Documents are put in one global order, written once in range partitions, and
totalled per partition.  The running sum of the partition totals (one row per
partition) plus a running sum inside each partition is the global prefix sum;
the prefix sum times the shard count over the total bytes is the shard.

Order: hash of the text, then id, so that equal texts are neighbours.  A group
of equal texts that is no larger than the largest document moves as one unit,
larger groups are cut like any other run of documents, so every cut is within
one largest document of its ideal place.  Nulls: a text counts as no bytes and
CRC 0; null ids sort first.  Repeated rows are rows of their own.  Ties (same
text, same id) are interchangeable."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketloom.sources.tables import write_scratch

#: Bytes of framing counted for each document.
OVERHEAD = 8


def shard_by_bytes(
    docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text",
    partitions: int | None = None,
) -> DataFrame:
    """(id, size, text_crc32, shard, slot): one row per row of ``docs``."""
    spark = docs.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    narrow = docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + F.lit(OVERHEAD)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("crc"),
        F.xxhash64(text).alias("h"),
    )
    ordered = write_scratch(
        narrow.repartitionByRange(parts, "h", "id").withColumn(
            "pid", F.spark_partition_id()
        ),
        "shard-order",
    )
    # one row per range partition: a running total before each of them
    totals = ordered.groupBy("pid").agg(
        F.sum("size").alias("bytes"), F.count("*").alias("rows"), F.max("size").alias("most")
    )
    before = Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    totals = totals.select(
        "pid",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(everything).alias("all_bytes"),
        F.max("most").over(everything).alias("largest"),
    )
    inside = Window.partitionBy("pid").orderBy("h", "id")
    placed = ordered.join(F.broadcast(totals), "pid").select(
        "id", "size", "crc", "h", "all_bytes", "largest",
        (
            F.col("bytes_before")
            + F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0))
            - F.col("size")
        ).alias("start"),
        (F.col("rows_before") + F.row_number().over(inside) - 1).alias("rank"),
    )
    placed = write_scratch(placed, "shard-starts")
    groups = (
        placed.groupBy("h").agg(
            F.min("start").alias("unit"), F.sum("size").alias("unit_bytes"),
            F.count("*").alias("n"), F.max("largest").alias("largest"),
        )
        .filter((F.col("n") > 1) & (F.col("unit_bytes") <= F.col("largest")))
        .select("h", "unit")
    )
    cut = placed.join(groups, "h", "left").select(
        "id", "size", "crc", "rank",
        F.expr(f"cast(({shards} * cast(coalesce(unit, start) as decimal(38,0))) div all_bytes as int)")
        .alias("shard"),
    )
    firsts = cut.groupBy("shard").agg(F.min("rank").alias("first"))
    return cut.join(F.broadcast(firsts), "shard").select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard",
        (F.col("rank") - F.col("first")).alias("slot"),
    )
