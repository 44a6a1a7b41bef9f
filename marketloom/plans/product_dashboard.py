"""Product dashboard queries over the product mart, and the month report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from marketloom.functions import month_label, month_start, pct, ranges, ratio
from marketloom.plans.dashboard_parts import (
    PRICE_RANGES,
    REVIEW_RANGES,
    down,
    isum,
    over_groups,
    rmean,
    rsum,
    scalar_sum,
    up,
)


def _mart(m) -> DataFrame:
    return m["mart_product_analytics"]


def _round2(c: str):
    return F.round(c, 2).cast("decimal(24,2)").alias(c)


_COUNT = lambda: F.count("*").alias("product_count")
_REVENUE = lambda: rsum("gmv").alias("total_revenue")
_RATING = lambda: rmean("avg_review_score")


def q_prod_1_1(m, as_of) -> DataFrame:
    """Top 20 products by orders."""
    return (
        _mart(m)
        .select(
            "product_id",
            "category_name",
            "total_orders",
            F.col("gmv").alias("gross_merchandise_value"),
            "avg_price",
            _round2("avg_review_score"),
            ratio("gmv", "total_orders").alias("revenue_per_order"),
            "volume_ranking",
            "rating_tier",
        )
        .orderBy(down("total_orders"), "product_id")
        .limit(20)
    )


def q_prod_1_2(m, as_of) -> DataFrame:
    """Products and revenue by month of first sale."""
    return (
        _mart(m)
        .groupBy(month_start("first_ordered_at").alias("month"))
        .agg(F.count("product_id").alias("products_sold"), isum("total_orders"), _REVENUE())
        .withColumn("avg_order_value", ratio("total_revenue", "total_orders"))
        .orderBy(up("month"))
    )


def q_prod_1_3(m, as_of) -> DataFrame:
    """Category comparison."""
    return (
        _mart(m)
        .groupBy("category_name")
        .agg(_COUNT(), isum("total_orders"), rsum("gmv").alias("total_gmv"), _RATING())
        .select(
            "*",
            ratio("total_gmv", "total_orders").alias("avg_order_value"),
            ratio("total_gmv", "product_count").alias("revenue_per_product"),
        )
        .orderBy(down("total_gmv"))
    )


def q_prod_1_4(m, as_of) -> DataFrame:
    """Price ranges of products that were sold."""
    return (
        _mart(m)
        .filter("total_orders > 0")
        .groupBy(ranges("avg_price", PRICE_RANGES, "$1000+").alias("price_range"))
        .agg(_COUNT(), isum("total_orders"), rsum("gmv").alias("total_gmv"), _RATING())
        .withColumn("avg_order_value", ratio("total_gmv", "total_orders"))
        .orderBy(down("total_gmv"))
    )


def q_prod_2_1(m, as_of) -> DataFrame:
    """Category by month of first sale."""
    return (
        _mart(m)
        .groupBy("category_name", month_start("first_ordered_at").alias("month"))
        .agg(
            isum("total_orders").alias("order_count"),
            F.count("product_id").alias("product_count"),
            _REVENUE(),
        )
        .withColumn("avg_order_value", ratio("total_revenue", "order_count"))
        .orderBy(up("category_name"), up("month"))
    )


def q_prod_2_2(m, as_of) -> DataFrame:
    """Seasonality of product introductions, with the share in the category."""
    in_category = F.sum("total_revenue").over(W.partitionBy("category_name"))
    return (
        _mart(m)
        .groupBy(
            "category_name",
            F.month("first_ordered_at").cast("bigint").alias("month_number"),
            month_label("first_ordered_at").alias("month_name"),
        )
        .agg(F.count("*").alias("new_products"), _REVENUE())
        .withColumn("pct_category_revenue", pct("total_revenue", in_category))
        .orderBy(up("category_name"), up("month_number"))
    )


def q_prod_2_3(m, as_of) -> DataFrame:
    """Categories by rating."""
    tier = F.col("rating_tier")
    return (
        _mart(m)
        .groupBy("category_name")
        .agg(
            _COUNT(),
            rmean("avg_review_score").alias("avg_category_rating"),
            isum("total_orders"),
            _REVENUE(),
            rmean("price_variance").alias("avg_price_variance"),
            F.count_if(tier == "excellent").alias("excellent_rated_products"),
            F.count_if(~tier.isin("excellent", "poor")).alias("average_rated_products"),
            F.count_if(tier == "poor").alias("poorly_rated_products"),
        )
        .withColumn("avg_order_value", ratio("total_revenue", "total_orders"))
        .orderBy(down("avg_category_rating"))
    )


def q_prod_2_4(m, as_of, limit: int = 20) -> DataFrame:
    """Pairs of categories with the correlation over all pairs of their
    products, the top ``limit``.

    Over a full cross product two variables are uncorrelated by construction:
    the covariance is exactly 0, so the correlation is 0, or NULL when a side
    has no variance.  Variances per category are enough, no product pair is
    ever formed.

    Only the first ``limit`` names of each of the four no-variance classes can be
    the left side of a reported pair: replacing the left name by any of ``limit``
    earlier ones of the same class gives as many better pairs.  The left side is
    therefore at most 4 x ``limit`` rows, and the pairs that times the
    categories."""
    flat = lambda c: (
        (F.min(c).eqNullSafe(F.max(c))) | (F.count(c) == 0)
    )
    stats = (
        _mart(m)
        .filter(F.col("category_name").isNotNull())
        .groupBy("category_name")
        .agg(
            F.count("product_id").alias("products"),
            rmean("avg_review_score").alias("rating"),
            flat("avg_price").alias("flat_price"),
            flat("total_orders").alias("flat_orders"),
        )
        .filter("products > 5")
    )
    first = W.partitionBy("flat_price", "flat_orders").orderBy("category_name")
    left = (
        stats.withColumn("_r", F.row_number().over(first))
        .filter(F.col("_r") <= limit)
        .drop("_r")
    )
    a, b = left.alias("a"), stats.alias("b")
    zero = F.lit(0).cast("decimal(4,2)")
    corr = lambda c: F.when(
        ~(F.col(f"a.flat_{c}") | F.col(f"b.flat_{c}")), zero
    )
    return (
        b.join(F.broadcast(a), F.col("a.category_name") < F.col("b.category_name"))
        .select(
            F.col("a.category_name").alias("category_1"),
            F.col("b.category_name").alias("category_2"),
            F.col("a.products").alias("products_in_category_1"),
            F.col("b.products").alias("products_in_category_2"),
            F.col("a.rating").alias("category_1_avg_rating"),
            F.col("b.rating").alias("category_2_avg_rating"),
            corr("price").alias("price_correlation"),
            corr("orders").alias("order_volume_correlation"),
        )
        .orderBy(
            down("order_volume_correlation"),
            down("price_correlation"),
            "category_1",
            "category_2",
        )
        .limit(limit)
    )


def q_prod_3_1(m, as_of) -> DataFrame:
    """Review score ranges."""
    return (
        _mart(m)
        .groupBy(ranges("avg_review_score", REVIEW_RANGES, "No reviews").alias("review_range"))
        .agg(_COUNT(), isum("total_orders"), _REVENUE())
        .select(
            "*",
            pct("total_revenue", over_groups("total_revenue")).alias("pct_total_revenue"),
            ratio("total_revenue", "total_orders").alias("avg_order_value"),
        )
        .orderBy("review_range")
    )


def q_prod_3_2(m, as_of) -> DataFrame:
    """Rating tier against revenue."""
    return (
        _mart(m)
        .filter("review_count > 0")
        .groupBy("rating_tier")
        .agg(_COUNT(), _RATING(), isum("total_orders"), _REVENUE())
        .select(
            "*",
            ratio("total_revenue", "total_orders").alias("avg_order_value"),
            pct("total_revenue", over_groups("total_revenue")).alias("pct_total_revenue"),
        )
        .orderBy(down("avg_review_score"))
    )


def q_prod_3_3(m, as_of) -> DataFrame:
    """Share of excellent and poor products per category."""
    return (
        _mart(m)
        .filter("review_count > 0")
        .groupBy("category_name")
        .agg(
            _COUNT(),
            _RATING(),
            F.expr("count_if(avg_review_score >= 4.5)").alias("excellent_products"),
            F.expr("count_if(avg_review_score <= 2.5)").alias("poor_products"),
        )
        .select(
            "*",
            pct("excellent_products", "product_count").alias("pct_excellent"),
            pct("poor_products", "product_count").alias("pct_poor"),
        )
        .orderBy(down("avg_review_score"))
    )


def q_prod_4_1(m, as_of) -> DataFrame:
    """Weight bands."""
    band = ranges(
        "weight_g",
        [
            (None, 500, "Lightweight (<500g)"),
            (500, 1999, "Medium (500g-2kg)"),
            (2000, 4999, "Heavy (2-5kg)"),
            (5000, 9999, "Very Heavy (5-10kg)"),
            (10000, None, "Bulky (10kg+)"),
        ],
        "Unknown",
    )
    return (
        _mart(m)
        .filter("weight_g is not null")
        .groupBy(band.alias("weight_category"))
        .agg(_COUNT(), rmean("avg_price"), isum("total_orders"), _REVENUE())
        .withColumn("avg_order_value", ratio("total_revenue", "total_orders"))
        .orderBy(down("avg_price"))
    )


def q_prod_4_2(m, as_of) -> DataFrame:
    """Volume bands."""
    band = ranges(
        "volume_cm3",
        [
            (None, 1000, "Very Small (<1,000 cm³)"),
            (1000, 4999, "Small (1,000-5,000 cm³)"),
            (5000, 19999, "Medium (5,000-20,000 cm³)"),
            (20000, 49999, "Large (20,000-50,000 cm³)"),
            (50000, None, "Very Large (50,000+ cm³)"),
        ],
        "Dimensions Missing",
    )
    return (
        _mart(m)
        .groupBy(band.alias("size_category"))
        .agg(_COUNT(), rmean("avg_price"), isum("total_orders"), _REVENUE(), _RATING())
        .orderBy(down("total_orders"))
    )


def q_prod_5_1(m, as_of) -> DataFrame:
    """Top 20 categories by revenue."""
    return (
        _mart(m)
        .groupBy("category_name")
        .agg(_COUNT(), isum("total_orders"), _REVENUE(), _RATING())
        .withColumn("revenue_per_product", ratio("total_revenue", "product_count"))
        .orderBy(down("total_revenue"), up("category_name"))
        .limit(20)
    )


def q_prod_5_2(m, as_of) -> DataFrame:
    """Volume ranking groups."""
    return (
        _mart(m)
        .groupBy("volume_ranking")
        .agg(_COUNT(), isum("total_orders"), _REVENUE(), _RATING())
        .select(
            "*",
            ratio("total_revenue", "total_orders").alias("avg_order_value"),
            pct("total_revenue", over_groups("total_revenue")).alias("pct_total_revenue"),
        )
        .orderBy(down("total_orders"))
    )


def q_prod_5_3(m, as_of) -> DataFrame:
    """Category lifecycle."""
    return (
        _mart(m)
        .groupBy("category_name")
        .agg(
            rmean("active_months", 1).alias("avg_active_months"),
            rmean("days_since_first_order", 1).alias("avg_days_since_first_order"),
            rmean("days_since_last_order", 1).alias("avg_days_since_last_order"),
            _COUNT(),
            F.count_if(F.col("days_since_last_order") <= 90).alias("recently_sold_products"),
        )
        .withColumn("pct_recently_sold", pct("recently_sold_products", "product_count"))
        .orderBy(down("pct_recently_sold"))
    )


def _first_sold_in(m, month: str) -> DataFrame:
    """Products first sold in the month; a plain range on the timestamp, so it
    reaches the scan."""
    start = F.lit(month).cast("date")
    first = F.col("first_ordered_at")
    return _mart(m).filter(
        (first >= start.cast("timestamp_ntz"))
        & (first < F.add_months(start, 1).cast("timestamp_ntz"))
    )


def q_nov_products(m, as_of, month: str = "2017-11-01", limit: int = 20) -> DataFrame:
    """Top products first sold in a month."""
    sold = _first_sold_in(m, month).filter("total_orders > 0")
    return (
        sold.select(
            "product_id",
            "category_name",
            F.date_format("first_ordered_at", "yyyy-MM-dd").alias("first_order_date"),
            "total_orders",
            F.col("gmv").alias("total_revenue"),
            "avg_price",
            _round2("avg_review_score"),
            pct("gmv", scalar_sum(sold, "gmv")).alias("pct_of_month_revenue"),
        )
        .orderBy(down("total_revenue"), "product_id")
        .limit(limit)
    )


def q_nov_categories(m, as_of, month: str = "2017-11-01", limit: int = 10) -> DataFrame:
    """Categories of the products first sold in a month."""
    sold = _first_sold_in(m, month)
    day = F.date_format("first_ordered_at", "yyyy-MM-dd")
    return (
        sold.groupBy("category_name")
        .agg(
            _COUNT(),
            F.min(day).alias("earliest_order_date"),
            F.max(day).alias("latest_order_date"),
            isum("total_orders"),
            _REVENUE(),
            _RATING(),
        )
        .withColumn("pct_of_month_revenue", pct("total_revenue", scalar_sum(sold, "gmv")))
        .orderBy(down("total_revenue"), up("category_name"))
        .limit(limit)
    )


PRODUCT_QUERIES = {
    f.__name__: f
    for f in [
        q_prod_1_1, q_prod_1_2, q_prod_1_3, q_prod_1_4, q_prod_2_1, q_prod_2_2,
        q_prod_2_3, q_prod_2_4, q_prod_3_1, q_prod_3_2, q_prod_3_3, q_prod_4_1,
        q_prod_4_2, q_prod_5_1, q_prod_5_2, q_prod_5_3, q_nov_products,
        q_nov_categories,
    ]
}
