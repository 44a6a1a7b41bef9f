"""Pieces the dashboard queries share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def rmean(c: str, digits: int = 2) -> Column:
    """``round(avg(c), digits)`` in exact decimals."""
    avg = F.avg(F.col(c).cast("decimal(24,6)"))
    return F.round(avg, digits).cast(f"decimal(24,{digits})").alias(c)


def rsum(c: str) -> Column:
    return F.sum(c).cast("decimal(20,2)").alias(c)


def isum(c: str) -> Column:
    return F.sum(c).cast("bigint").alias(c)


def over_groups(c: str) -> Column:
    """``sum(sum(x)) over ()``: the frame is already grouped (one row per
    state, tier, category ...), so the single partition is as small as the
    report itself."""
    return F.sum(c).over(W.partitionBy())


def scalar_sum(df: DataFrame, c: str) -> Column:
    return df.agg(F.sum(c)).scalar()


def scalar_count(df: DataFrame) -> Column:
    return df.agg(F.count("*")).scalar()


def down(c: str) -> Column:
    return F.col(c).desc_nulls_first()


def up(c: str) -> Column:
    return F.col(c).asc_nulls_last()


# The ranges and labels of the reports.
PRICE_RANGES = [
    (None, 50, "Under $50"),
    (50, "99.99", "$50-$99"),
    (100, "249.99", "$100-$249"),
    (250, "499.99", "$250-$499"),
    (500, "999.99", "$500-$999"),
]

REVIEW_RANGES = [
    (1, "1.9", "1.0-1.9"),
    (2, "2.9", "2.0-2.9"),
    (3, "3.4", "3.0-3.4"),
    ("3.5", "3.9", "3.5-3.9"),
    (4, "4.4", "4.0-4.4"),
    ("4.5", 5, "4.5-5.0"),
]
