"""Segment analysis queries over the intermediate models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from marketloom.functions import mean, month_start, ratio, total
from marketloom.plans.dashboard_parts import rsum


def seller_month_gmv(m) -> DataFrame:
    """GMV per seller and month of purchase."""
    return (
        m["seller_order_history"]
        .groupBy("seller_id", month_start("order_date").alias("month"))
        .agg(total("order_value").alias("gmv"))
    )


def with_growth(monthly: DataFrame) -> DataFrame:
    """Month-over-month growth; the window holds one row per active month."""
    prev = F.lag("gmv").over(W.partitionBy("seller_id").orderBy("month"))
    return monthly.withColumn("prev_month_gmv", prev).withColumn(
        "growth_rate", ratio(F.col("gmv") - F.col("prev_month_gmv"), "prev_month_gmv", 6)
    )


def q_seg_customer_matrix(m, as_of) -> DataFrame:
    return (
        m["int_customer_orders"]
        .groupBy("frequency_segment", "value_segment")
        .agg(F.count("*").alias("customer_count"), rsum("total_spent").alias("total_revenue"))
        .orderBy("frequency_segment", "value_segment")
    )


def q_seg_nps(m, as_of) -> DataFrame:
    return (
        m["int_customer_orders"]
        .groupBy("nps_segment")
        .agg(
            F.count("*").alias("customer_count"),
            mean("avg_review_score", 6).alias("avg_satisfaction"),
            (
                F.count_if(F.col("total_orders") > 1).cast("double") / F.count("*")
            ).alias("repeat_purchase_rate"),
        )
    )


def q_seg_seller_matrix(m, as_of) -> DataFrame:
    return (
        m["int_seller_performance"]
        .groupBy("performance_segment", "delivery_segment")
        .agg(
            F.count("*").alias("seller_count"),
            mean("total_gmv").alias("avg_gmv"),
            mean("on_time_delivery_rate").alias("avg_delivery_rate"),
        )
    )


def q_seg_seller_growth(m, as_of) -> DataFrame:
    segments = m["int_seller_performance"].select(
        "seller_id", "volume_segment", "value_segment"
    )
    return (
        with_growth(seller_month_gmv(m))
        .join(segments, "seller_id")
        .groupBy("volume_segment", "value_segment")
        .agg(mean("growth_rate", 6).alias("avg_growth_rate"))
    )


def q_seg_category(m, as_of) -> DataFrame:
    categories = m["stg_product_categories"].select(
        "category_id", F.col("category_name_english").alias("category_name")
    )
    return (
        m["int_product_performance"]
        .join(categories, "category_id")
        .groupBy("category_name", "volume_segment", "price_segment")
        .agg(
            F.count("*").alias("product_count"),
            rsum("total_gmv").alias("category_gmv"),
            mean("avg_review_score", 6).alias("avg_satisfaction"),
        )
    )


def q_seg_logistics(m, as_of) -> DataFrame:
    return (
        m["int_product_performance"]
        .groupBy("weight_segment", "size_segment")
        .agg(
            F.count("*").alias("product_count"),
            mean("total_gmv").alias("avg_gmv"),
            mean("avg_review_score", 6).alias("avg_satisfaction"),
        )
    )


SEGMENT_QUERIES = {
    f.__name__: f
    for f in [
        q_seg_customer_matrix, q_seg_nps, q_seg_seller_matrix, q_seg_seller_growth,
        q_seg_category, q_seg_logistics,
    ]
}
