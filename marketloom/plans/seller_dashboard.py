"""Seller dashboard queries over the seller mart and the seller histories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.functions import ladder, month_start, pct, ranges, ratio
from marketloom.operators.keyed import top_per_key
from marketloom.plans.dashboard_parts import REVIEW_RANGES, down, isum, rmean, rsum, up


def _mart(m) -> DataFrame:
    return m["mart_sellers"]


def _round(c: str, digits: int):
    return F.round(c, digits).cast(f"decimal(24,{digits})")


_COUNT = lambda: F.count("*").alias("seller_count")
_RATING = lambda: rmean("average_review_score").alias("avg_review_score")


def q_sell_1_1(m, as_of) -> DataFrame:
    """Top 20 sellers by revenue."""
    return (
        _mart(m)
        .select(
            "seller_id", "seller_city", "seller_state", "total_orders",
            "total_items_sold", "total_revenue", "total_gmv",
            _round("average_review_score", 2).alias("average_review_score"),
            "delivered_orders", "canceled_orders",
        )
        .orderBy(down("total_revenue"), "seller_id")
        .limit(20)
    )


def q_sell_1_2(m, as_of) -> DataFrame:
    """Active sellers, orders and revenue by month."""
    monthly = (
        m["seller_order_history"]
        .groupBy("seller_id", month_start("order_date").alias("month"))
        .agg(F.count("*").alias("order_count"), rsum("order_value").alias("revenue"))
    )
    return (
        monthly.groupBy("month")
        .agg(
            F.count("seller_id").alias("active_sellers"),
            isum("order_count").alias("total_orders"),
            rsum("revenue").alias("total_revenue"),
        )
        .withColumn("revenue_per_seller", ratio("total_revenue", "active_sellers"))
        .orderBy(up("month"))
    )


def q_sell_1_3(m, as_of) -> DataFrame:
    """Sellers by state."""
    return (
        _mart(m)
        .groupBy("seller_state")
        .agg(
            _COUNT(), rsum("total_revenue"), isum("total_orders"), _RATING(),
            isum("on_time_deliveries").alias("_on_time"),
            isum("delivered_orders").alias("_delivered"),
        )
        .select(
            "seller_state", "seller_count", "total_revenue", "total_orders",
            "avg_review_score",
            ratio("total_revenue", "seller_count").alias("revenue_per_seller"),
            ratio("total_orders", "seller_count").alias("orders_per_seller"),
            pct("_on_time", "_delivered").alias("on_time_delivery_rate"),
        )
        .orderBy(down("total_revenue"))
    )


def q_sell_1_4(m, as_of) -> DataFrame:
    """Sellers by value, volume and recency."""
    return (
        _mart(m)
        .groupBy("value_segment", "volume_segment", "recency_segment")
        .agg(_COUNT(), rsum("total_revenue"), _RATING(), isum("total_orders").alias("_o"))
        .select(
            "value_segment", "volume_segment", "recency_segment", "seller_count",
            "total_revenue", "avg_review_score",
            ratio("total_revenue", "_o").alias("avg_order_value"),
            ratio("total_revenue", "seller_count").alias("revenue_per_seller"),
        )
        .orderBy(down("total_revenue"))
    )


def q_sell_2_1(m, as_of) -> DataFrame:
    """Product diversity by value segment."""
    products = "unique_products_sold"
    return (
        _mart(m)
        .groupBy("value_segment")
        .agg(
            _COUNT(),
            isum(products).alias("total_unique_products"),
            rmean(products).alias("avg_products_per_seller"),
            F.max(products).alias("max_products"),
            F.min(products).alias("min_products"),
        )
        .orderBy(down("avg_products_per_seller"))
    )


def q_sell_2_2(m, as_of) -> DataFrame:
    """Each seller's best category, rolled up by category."""
    per_category = (
        m["seller_category_history"]
        .groupBy("seller_id", "category")
        .agg(F.count("*").alias("product_count"), rsum("category_revenue").alias("revenue"))
    )
    best = top_per_key(per_category, "seller_id", "revenue", "category")
    return (
        best.groupBy("category")
        .agg(
            _COUNT(),
            isum("product_count").alias("total_products"),
            rsum("revenue").alias("total_revenue"),
        )
        .orderBy(down("total_revenue"))
    )


def q_sell_2_3(m, as_of) -> DataFrame:
    """Product diversity bands against revenue."""
    band = ranges(
        "unique_products_sold",
        [
            (1, 5, "1-5 products"),
            (6, 20, "6-20 products"),
            (21, 50, "21-50 products"),
            (51, 100, "51-100 products"),
        ],
        "100+ products",
    )
    return (
        _mart(m)
        .groupBy(band.alias("product_diversity"))
        .agg(
            _COUNT(),
            rmean("total_revenue").alias("avg_revenue"),
            rmean("total_orders").alias("avg_orders"),
            _RATING(),
        )
        .orderBy(down("avg_revenue"))
    )


def q_sell_3_1(m, as_of) -> DataFrame:
    """On-time delivery, top 20 of sellers with more than 10 deliveries."""
    return (
        _mart(m)
        .filter("delivered_orders > 10")
        .select(
            "seller_id", "seller_state", "delivered_orders", "on_time_deliveries",
            "late_deliveries", "on_time_delivery_rate",
            _round("average_delivery_time_days", 1).alias("avg_delivery_days"),
            _round("average_delivery_variance_days", 1).alias("avg_variance_days"),
            "average_review_score",
        )
        .orderBy(down("on_time_delivery_rate"), "seller_id")
        .limit(20)
    )


def q_sell_3_2(m, as_of) -> DataFrame:
    """Delivery by state."""
    return (
        _mart(m)
        .groupBy("seller_state")
        .agg(
            isum("delivered_orders").alias("total_delivered_orders"),
            isum("on_time_deliveries").alias("total_on_time"),
            isum("late_deliveries").alias("total_late"),
            rmean("average_delivery_time_days", 1).alias("avg_delivery_days"),
            rmean("average_delivery_variance_days", 1).alias("avg_variance_days"),
        )
        .withColumn("state_on_time_rate", pct("total_on_time", "total_delivered_orders"))
        .orderBy(down("state_on_time_rate"))
    )


def q_sell_3_3(m, as_of) -> DataFrame:
    """On-time bands against ratings."""
    band = ladder(
        "on_time_delivery_rate",
        [
            (90, "90-100% on-time"),
            (80, "80-89% on-time"),
            (70, "70-79% on-time"),
            (60, "60-69% on-time"),
        ],
        "Below 60% on-time",
    )
    return (
        _mart(m)
        .filter("delivered_orders > 5")
        .groupBy(band.alias("delivery_performance"))
        .agg(
            _COUNT(),
            _RATING(),
            F.count_if(F.col("rating_segment") == "excellent").alias(
                "excellent_rated_sellers"
            ),
            F.count_if(F.col("rating_segment") == "poor").alias("poor_rated_sellers"),
        )
        .withColumn("pct_excellent_ratings", pct("excellent_rated_sellers", "seller_count"))
        .orderBy("delivery_performance")
    )


def q_sell_4_1(m, as_of) -> DataFrame:
    """Customers by value segment."""
    return (
        _mart(m)
        .groupBy("value_segment")
        .agg(
            _COUNT(),
            isum("unique_customers").alias("total_customers"),
            rmean("unique_customers").alias("avg_customers_per_seller"),
            isum("total_orders").alias("_o"),
        )
        .withColumn("customer_order_ratio", ratio("total_customers", "_o", 3))
        .drop("_o")
        .orderBy(down("avg_customers_per_seller"))
    )


def q_sell_4_2(m, as_of) -> DataFrame:
    """Retention: customers who came back to the same seller, top 20."""
    returning = (
        m["seller_order_history"]
        .groupBy("seller_id", "customer_id")
        .agg(F.count("order_id").alias("orders"))
        .groupBy("seller_id")
        .agg(F.count_if(F.col("orders") >= 2).alias("returning_customers"))
    )
    return (
        _mart(m)
        .filter("unique_customers > 10")
        .join(returning, "seller_id", "left")
        .select(
            "seller_id", "seller_city", "seller_state", "total_orders", "total_revenue",
            F.col("unique_customers").alias("total_customers"),
            F.coalesce("returning_customers", F.lit(0)).alias("returning_customers"),
            pct(F.coalesce("returning_customers", F.lit(0)), "unique_customers").alias(
                "retention_rate"
            ),
            "average_review_score",
        )
        .orderBy(down("retention_rate"), "seller_id")
        .limit(20)
    )


def q_sell_5_1(m, as_of) -> DataFrame:
    """Rating segments."""
    score = "average_review_score"
    return (
        _mart(m)
        .filter("total_orders > 5")
        .groupBy("rating_segment")
        .agg(
            _COUNT(),
            F.round(F.min(score), 2).alias("min_review_score"),
            _RATING(),
            F.round(F.max(score), 2).alias("max_review_score"),
            isum("total_orders"),
            rsum("total_revenue"),
        )
        .withColumn("avg_order_value", ratio("total_revenue", "total_orders"))
        .orderBy(down("min_review_score"))
    )


def q_sell_5_2(m, as_of) -> DataFrame:
    """Review score ranges against revenue."""
    return (
        _mart(m)
        .filter("total_orders > 5")
        .groupBy(
            ranges("average_review_score", REVIEW_RANGES, "No reviews").alias(
                "review_score_range"
            )
        )
        .agg(
            _COUNT(),
            rmean("total_orders").alias("avg_orders"),
            rmean("total_revenue").alias("avg_revenue"),
            rsum("total_revenue").alias("_r"),
            isum("total_orders").alias("_o"),
        )
        .select(
            "review_score_range", "seller_count", "avg_orders", "avg_revenue",
            ratio("_r", "seller_count").alias("revenue_per_seller"),
            ratio("_r", "_o").alias("avg_order_value"),
        )
        .orderBy("review_score_range")
    )


def q_sell_5_3(m, as_of) -> DataFrame:
    """Positive review rate by value segment."""
    return (
        _mart(m)
        .filter("orders_with_reviews > 5")
        .groupBy("value_segment")
        .agg(
            _COUNT(),
            rmean("positive_review_rate").alias("avg_positive_review_rate"),
            rmean("total_revenue").alias("avg_revenue"),
            rmean("on_time_delivery_rate").alias("avg_on_time_delivery_rate"),
            rmean("average_delivery_time_days", 1).alias("avg_delivery_days"),
        )
        .orderBy(down("avg_positive_review_rate"))
    )


SELLER_QUERIES = {
    f.__name__: f
    for f in [
        q_sell_1_1, q_sell_1_2, q_sell_1_3, q_sell_1_4, q_sell_2_1, q_sell_2_2,
        q_sell_2_3, q_sell_3_1, q_sell_3_2, q_sell_3_3, q_sell_4_1, q_sell_4_2,
        q_sell_5_1, q_sell_5_2, q_sell_5_3,
    ]
}
