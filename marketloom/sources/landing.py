"""Landing copy: source tables stored with every column as text."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

# The source tables the daily landing step copies.
LANDED = ["orders", "order_items", "products", "customers", "sellers", "order_reviews"]
# Fixed value: prefix of the landed tables.
PREFIX = "olist_"


def as_text(df: DataFrame) -> DataFrame:
    return df.select([F.col(c).cast("string").alias(c) for c in df.columns])


def land_raw_text(
    spark: SparkSession,
    read: Callable[[str], DataFrame],
    out_dir: str,
    tables: list[str] = LANDED,
) -> DataFrame:
    """Copy each table to ``out_dir/<prefix><table>`` as text.

    ``read(name)`` may return any DataFrame (a JDBC read included) and may
    raise: that table is marked failed and the others go on.  An empty source
    is skipped.  Rows are counted while they are written, not by a second
    pass.  Returns one row per table: ``(table, status, rows)``."""
    outcome = []
    for name in tables:
        try:
            df = read(name)
            if df.isEmpty():
                log.warning("no data found in %s", name)
                outcome.append((name, "skipped", 0))
                continue
            seen = Observation(f"land_{name}")
            text = as_text(df).observe(seen, F.count(F.lit(1)).alias("rows"))
            text.write.mode("overwrite").parquet(f"{out_dir}/{PREFIX}{name}")
            outcome.append((name, "ok", seen.get["rows"]))
        except Exception as e:
            log.warning("landing of %s failed: %r", name, e)
            outcome.append((name, "failed", 0))
    return spark.createDataFrame(outcome, "table string, status string, rows bigint")


def land_status(summary: DataFrame) -> DataFrame:
    """One row: tables processed / failed, rows, and the overall status."""
    return summary.agg(
        F.count_if(F.col("status") == "ok").alias("tables_processed"),
        F.count_if(F.col("status") == "failed").alias("tables_failed"),
        F.sum("rows").alias("rows_processed"),
    ).withColumn(
        "status",
        F.when(F.col("tables_failed") == 0, "success").otherwise("partial_failure"),
    )
