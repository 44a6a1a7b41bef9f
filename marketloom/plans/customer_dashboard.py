"""Customer dashboard queries over the customer mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.functions import day_diff, month_start, pct, ranges, ratio, state_name
from marketloom.operators.ranking import ntile
from marketloom.plans.dashboard_parts import (
    PRICE_RANGES,
    down,
    isum,
    over_groups,
    rmean,
    rsum,
    scalar_count,
    scalar_sum,
    up,
)


def _mart(m) -> DataFrame:
    return m["mart_customer_analytics"]


def _with_state(m) -> DataFrame:
    states = m["int_customer_orders"].select("customer_id", "state_normalized")
    return (
        _mart(m)
        .select("customer_id", "total_spent")
        .join(states, "customer_id")
        .withColumn("customer_state", state_name("state_normalized"))
    )


def q_cust_1_1(m, as_of) -> DataFrame:
    """New customers by month of the first order."""
    return (
        _mart(m)
        .groupBy(month_start("first_order_date").alias("month"))
        .agg(F.count("*").alias("new_customers"))
        .orderBy(up("month"))
    )


def q_cust_1_2(m, as_of) -> DataFrame:
    """Customers per state with their share."""
    return (
        _with_state(m)
        .groupBy("customer_state")
        .agg(F.count("*").alias("customer_count"))
        .withColumn("percentage", pct("customer_count", scalar_count(_mart(m))))
        .orderBy(down("customer_count"))
    )


def q_cust_1_3(m, as_of) -> DataFrame:
    """Customers by month of the last order, newest first."""
    return (
        _mart(m)
        .groupBy(month_start("last_order_date").alias("month"))
        .agg(F.count("*").alias("customer_count"))
        .orderBy(down("month"))
    )


def q_cust_2_1(m, as_of) -> DataFrame:
    """Average order value by frequency, value and tier."""
    return (
        _mart(m)
        .groupBy("frequency_segment", "value_segment", "customer_tier")
        .agg(
            rmean("avg_order_value"),
            F.count("*").alias("customer_count"),
            isum("total_orders"),
        )
        .orderBy(down("avg_order_value"))
    )


def q_cust_2_2(m, as_of) -> DataFrame:
    """Lifetime value quintiles; ties are split by customer id."""
    tiles = ntile(_mart(m), "customer_id", "total_spent", 5, "ltv_quintile")
    return (
        tiles.groupBy("ltv_quintile")
        .agg(
            F.min("total_spent").alias("min_ltv"),
            rmean("total_spent").alias("avg_ltv"),
            F.max("total_spent").alias("max_ltv"),
            F.count("*").alias("customer_count"),
            rsum("total_spent").alias("total_revenue"),
        )
        .withColumn(
            "revenue_percentage",
            pct("total_revenue", scalar_sum(_mart(m), "total_spent")),
        )
        .orderBy("ltv_quintile")
    )


def q_cust_2_3(m, as_of) -> DataFrame:
    """Customers and revenue per average-order-value range."""
    return (
        _mart(m)
        .groupBy(
            ranges("avg_order_value", PRICE_RANGES, "$1000+").alias(
                "average_order_value_range"
            )
        )
        .agg(F.count("*").alias("customer_count"), rsum("total_spent").alias("total_revenue"))
        .select(
            "average_order_value_range",
            "customer_count",
            pct("customer_count", scalar_count(_mart(m))).alias("proportion_of_customers"),
            "total_revenue",
            pct("total_revenue", scalar_sum(_mart(m), "total_spent")).alias(
                "proportion_of_revenue"
            ),
        )
        .orderBy(down("proportion_of_revenue"))
    )


def q_cust_3_1(m, as_of) -> DataFrame:
    """Tier comparison with revenue share."""
    return (
        _mart(m)
        .groupBy("customer_tier")
        .agg(
            F.count("*").alias("customer_count"),
            rmean("total_spent").alias("avg_customer_ltv"),
            rmean("total_orders").alias("avg_orders_per_customer"),
            rmean("avg_order_value"),
            isum("total_orders"),
            rsum("total_spent").alias("total_revenue"),
        )
        .withColumn("revenue_percentage", pct("total_revenue", over_groups("total_revenue")))
        .orderBy(down("total_revenue"))
    )


def q_cust_3_2(m, as_of) -> DataFrame:
    """One-time and repeat purchasers."""
    kind = ranges(
        "total_orders",
        [
            (1, 1, "One-time customer"),
            (2, 3, "Occasional customer (2-3 orders)"),
            (4, 6, "Regular customer (4-6 orders)"),
        ],
        "Loyal customer (7+ orders)",
    )
    return (
        _mart(m)
        .groupBy(kind.alias("customer_type"))
        .agg(
            F.count("*").alias("customer_count"),
            rmean("total_spent").alias("avg_ltv"),
            rsum("total_spent").alias("total_revenue"),
        )
        .select(
            "customer_type",
            "customer_count",
            pct("customer_count", scalar_count(_mart(m))).alias("percentage"),
            "avg_ltv",
            "total_revenue",
            pct("total_revenue", over_groups("total_revenue")).alias("revenue_percentage"),
        )
        .orderBy(down("avg_ltv"))
    )


def q_cust_3_3(m, as_of) -> DataFrame:
    """Recency bands relative to the reference day."""
    today = as_of.cast("date").cast("timestamp_ntz")
    since = day_diff(today, "last_order_date")
    band = (
        F.when(F.col("is_active") == 1, "Active (past 3 months)")
        .when(since <= 180, "Recent (3-6 months)")
        .when(since <= 365, "Lapsed (6-12 months)")
        .otherwise("Inactive (12+ months)")
    )
    return (
        _mart(m)
        .groupBy(band.alias("recency_segment"))
        .agg(
            F.count("*").alias("customer_count"),
            rmean("total_spent").alias("avg_ltv"),
            rmean("total_orders").alias("avg_orders"),
            rsum("total_spent").alias("total_revenue"),
        )
        .withColumn("percentage", pct("customer_count", scalar_count(_mart(m))))
        .orderBy(down("total_revenue"))
    )


def q_cust_4_1(m, as_of) -> DataFrame:
    """Satisfaction and promoter share by tier."""
    return (
        _mart(m)
        .groupBy("customer_tier")
        .agg(
            F.count("*").alias("customer_count"),
            rmean("avg_review_score"),
            rmean("positive_review_rate").alias("avg_positive_review_rate"),
            F.count_if(F.col("is_promoter") == 1).alias("promoters"),
        )
        .withColumn("promoter_percentage", pct("promoters", "customer_count"))
        .orderBy(down("avg_review_score"))
    )


def q_cust_5_1(m, as_of) -> DataFrame:
    """Revenue by tier.  ``customer_percentage`` divides by the number of
    tiers, as the dashboard does; ``customer_share`` by all customers."""
    groups = F.lit(0) + over_groups("_one")
    return (
        _mart(m)
        .groupBy("customer_tier")
        .agg(rsum("total_spent").alias("total_revenue"), F.count("*").alias("customer_count"))
        .withColumn("_one", F.lit(1))
        .select(
            "customer_tier",
            "total_revenue",
            pct("total_revenue", over_groups("total_revenue")).alias("revenue_percentage"),
            "customer_count",
            pct("customer_count", groups).alias("customer_percentage"),
            pct("customer_count", over_groups("customer_count")).alias("customer_share"),
        )
        .orderBy(down("total_revenue"))
    )


def q_cust_5_2(m, as_of) -> DataFrame:
    """Revenue by state."""
    return (
        _with_state(m)
        .groupBy("customer_state")
        .agg(rsum("total_spent").alias("total_revenue"), F.count("*").alias("customer_count"))
        .select(
            "*",
            ratio("total_revenue", "customer_count").alias("revenue_per_customer"),
            pct("total_revenue", over_groups("total_revenue")).alias("revenue_percentage"),
        )
        .orderBy(down("total_revenue"))
    )


def q_cust_5_3(m, as_of) -> DataFrame:
    """Revenue per lifetime day by tier."""
    return (
        _mart(m)
        .filter("customer_lifetime_days > 0")
        .groupBy("customer_tier")
        .agg(
            F.count("*").alias("customer_count"),
            rsum("total_spent").alias("total_revenue"),
            rmean("customer_lifetime_days").alias("avg_days_since_first_order"),
            rsum("daily_customer_value").alias("avg_revenue_per_day_lifetime"),
        )
        .orderBy(down("avg_revenue_per_day_lifetime"))
    )


CUSTOMER_QUERIES = {
    f.__name__: f
    for f in [
        q_cust_1_1, q_cust_1_2, q_cust_1_3, q_cust_2_1, q_cust_2_2, q_cust_2_3,
        q_cust_3_1, q_cust_3_2, q_cust_3_3, q_cust_4_1, q_cust_5_1, q_cust_5_2,
        q_cust_5_3,
    ]
}
