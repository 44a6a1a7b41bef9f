"""Marts: dashboard marts with whole-table percentiles, and entity marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.functions import (
    day_diff,
    from_cents,
    ladder,
    mean,
    mean_over_all,
    pct,
    ratio,
    total,
    weighted_mean,
    weighted_mean_micros,
)
from marketloom.functions.time import micros_between
from marketloom.operators.ranking import percent_ranks
from marketloom.plans.intermediate import RATING_STEPS, month_span, months_in, per_item, with_distinct



# ---------------------------------------------------------------- dashboards


def mart_customer_analytics(m, as_of: Column) -> DataFrame:
    """Customer tiers, activity, value relative to the average, percentiles."""
    freq, value = F.col("frequency_segment"), F.col("value_segment")
    tier = (
        F.when((freq == "high_frequency") & (value == "high_value"), "VIP")
        .when((freq == "high_frequency") & (value == "medium_value"), "Loyal")
        .when(
            (freq == "medium_frequency") & value.isin("high_value", "medium_value"),
            "Growing",
        )
        .when((freq == "low_frequency") & (value == "high_value"), "Big Spender")
        .otherwise("Standard")
    )
    recent = F.add_months(as_of.cast("date"), -3).cast("timestamp_ntz")
    c = m["int_customer_orders"]
    relative = lambda col: F.try_divide(
        F.col(col).cast("double"), mean_over_all(c, col)
    )
    ranked = percent_ranks(
        c,
        "customer_id",
        {
            "spend_percentile": ("total_spent", "asc"),
            "frequency_percentile": ("total_orders", "asc"),
            "satisfaction_percentile": ("avg_review_score", "asc"),
        },
    )
    return ranked.select(
        "customer_id",
        "frequency_segment",
        "value_segment",
        "nps_segment",
        tier.alias("customer_tier"),
        "total_orders",
        "total_spent",
        F.col("avg_order_amount").alias("avg_order_value"),
        "avg_review_score",
        F.col("first_order_at").alias("first_order_date"),
        F.col("last_order_at").alias("last_order_date"),
        "customer_lifetime_days",
        F.col("spend_per_day").alias("daily_customer_value"),
        "unique_sellers_bought_from",
        "total_items_purchased",
        "positive_review_rate",
        "on_time_delivery_rate",
        F.when(F.col("nps_segment") == "promoter", 1).otherwise(0).alias("is_promoter"),
        F.when(F.col("last_order_at") >= recent, 1).otherwise(0).alias("is_active"),
        relative("total_spent").alias("relative_customer_value"),
        relative("avg_order_amount").alias("relative_order_value"),
        "spend_percentile",
        "frequency_percentile",
        "satisfaction_percentile",
        as_of.alias("generated_at"),
    )


_TOP = [("0.9", "top 10%"), ("0.7", "top 30%"), ("0.5", "top 50%")]


def _label(share: str, steps, otherwise: str) -> Column:
    """Label of a percentile; the corrected ones have no label when unknown."""
    known = F.col(share).cast("decimal(20,12)")
    return ladder(known, steps, otherwise)


def _corrected(share: str, steps, otherwise: str) -> Column:
    return F.when(F.col(share).isNotNull(), _label(share, steps, otherwise))


def mart_seller_analytics(m, as_of: Column) -> DataFrame:
    """Seller rankings.  The percentiles are descending (best = 0) yet labelled
    from the top, as in the dashboards being replaced; the ``*_corrected``
    labels rank ascending among known values."""
    ranks = {
        "gmv": "total_gmv",
        "review": "avg_review_score",
        "delivery": "on_time_delivery_rate",
        "volume": "total_orders",
    }
    specs = {f"_{k}": (c, "desc") for k, c in ranks.items()}
    specs |= {f"_{k}_up": (c, "asc_known") for k, c in ranks.items()}
    ranked = percent_ranks(m["int_seller_performance"], "seller_id", specs)
    score = (F.col("_gmv") + F.col("_review") + F.col("_delivery") + F.col("_volume")) / 4
    return ranked.select(
        "seller_id", "zip_code_prefix", "city_normalized", "state_normalized",
        "total_orders", "total_gmv", "unique_customers", "avg_review_score",
        "on_time_delivery_rate", "avg_delivery_time_days", "customer_reorder_rate",
        "first_order_at", "last_order_at", "seller_lifetime_days", "active_months",
        "orders_per_month", "gmv_per_month", "avg_order_value", "positive_reviews",
        "negative_reviews", "positive_review_rate", "volume_segment", "value_segment",
        "performance_segment", "delivery_segment",
        *[_label(f"_{k}", _TOP, "bottom 50%").alias(f"{k}_ranking") for k in ranks],
        score.alias("overall_seller_score"),
        *[
            _corrected(f"_{k}_up", _TOP, "bottom 50%").alias(f"{k}_ranking_corrected")
            for k in ranks
        ],
        as_of.alias("generated_at"),
    )


def mart_product_analytics(m, as_of: Column) -> DataFrame:
    """Product rankings and tiers, with the English category name."""
    price = [("0.9", "premium"), ("0.7", "high"), ("0.3", "medium")]
    rating = [("0.9", "excellent"), ("0.7", "good"), ("0.4", "average")]
    ranked = percent_ranks(
        m["int_product_performance"],
        "product_id",
        {
            "_volume": ("total_orders", "desc"),
            "_price": ("avg_price", "desc"),
            "_review": ("avg_review_score", "desc"),
            "_volume_up": ("total_orders", "asc_known"),
            "_price_up": ("avg_price", "asc_known"),
            "_review_up": ("avg_review_score", "asc_known"),
        },
    )
    return ranked.select(
        "product_id",
        F.col("category_name_english").alias("category_name"),
        "category_id", "weight_g", "length_cm", "height_cm", "width_cm", "volume_cm3",
        "is_missing_dimensions", "total_orders", "gmv", "avg_price", "min_price",
        "max_price", "price_variance", "first_ordered_at", "last_ordered_at",
        "days_since_first_order", "days_since_last_order", "active_months",
        "review_count", "avg_review_score", "positive_reviews", "negative_reviews",
        "review_rate",
        _label("_volume", _TOP, "bottom 50%").alias("volume_ranking"),
        _label("_price", price, "low").alias("price_tier"),
        _label("_review", rating, "poor").alias("rating_tier"),
        ((F.col("_volume") + F.col("_review")) / 2).alias("overall_product_score"),
        _corrected("_volume_up", _TOP, "bottom 50%").alias("volume_ranking_corrected"),
        _corrected("_price_up", price, "low").alias("price_tier_corrected"),
        _corrected("_review_up", rating, "poor").alias("rating_tier_corrected"),
        as_of.alias("generated_at"),
    )


# ------------------------------------------------------------------ entities


def _recency(since: Column, with_year: bool = True) -> Column:
    steps = [(30, "active_30d"), (90, "active_90d"), (180, "active_180d")]
    if with_year:
        steps.append((365, "active_365d"))
    out = None
    for days, name in steps:
        out = F.when(since <= days, name) if out is None else out.when(since <= days, name)
    return out.otherwise("inactive")


def _or_zero(*names: str) -> list[Column]:
    return [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in names]


def mart_orders(m, as_of=None) -> DataFrame:
    return m["int_orders_with_items"]


def mart_products(m, as_of=None) -> DataFrame:
    return m["int_product_performance"]


def _with_coordinates(df: DataFrame, m) -> DataFrame:
    """Coordinates by zip prefix (five digits: at most 100,000 rows)."""
    geo = m["stg_geolocation"].select(
        "zip_code_prefix",
        F.col("latitude").alias("geolocation_lat"),
        F.col("longitude").alias("geolocation_lng"),
    )
    return df.join(geo, "zip_code_prefix", "left")


def mart_customers(m, as_of: Column) -> DataFrame:
    """Recency / frequency / monetary segments per customer."""
    late = ~F.col("is_delivered_on_time") & F.col("is_delivered")
    per_customer = m["int_orders_with_items"].groupBy("customer_id").agg(
        F.count("order_id").alias("total_orders"),
        F.count_if("is_delivered").alias("delivered_orders"),
        F.count_if("is_canceled").alias("canceled_orders"),
        F.count_if("is_delivered_on_time").alias("on_time_deliveries"),
        F.count_if(late).alias("late_deliveries"),
        total("total_amount").alias("lifetime_value"),
        total("products_amount").alias("total_products_amount"),
        total("shipping_amount").alias("total_shipping_amount"),
        total("payment_total").alias("total_payment_amount"),
        mean("total_amount").alias("average_order_value"),
        mean("item_count").alias("average_items_per_order"),
        F.sum("item_count").alias("total_items_purchased"),
        F.sum("unique_products").alias("total_unique_products"),
        F.sum("unique_sellers").alias("total_unique_sellers"),
        mean("shipping_amount").alias("average_shipping_amount"),
        *[
            F.count_if(f"used_{t}").alias(f"{t}_orders")
            for t in ("credit_card", "boleto", "voucher", "debit_card")
        ],
        mean("review_score").alias("average_review_score"),
        F.count("review_score").alias("orders_with_reviews"),
        F.count_if("is_positive_review").alias("positive_reviews"),
        F.count_if("is_negative_review").alias("negative_reviews"),
        F.count_if("has_review_comment").alias("reviews_with_comments"),
        F.min("purchased_at").alias("first_order_date"),
        F.max("purchased_at").alias("last_order_date"),
        mean("delivery_time_days").alias("average_delivery_time_days"),
        mean("delivery_variance_days").alias("average_delivery_variance_days"),
        months_in("purchased_at", month_span(m["int_orders_with_items"], "purchased_at")).alias("active_months"),
    )
    joined = _with_coordinates(m["stg_customers"], m).join(
        per_customer, "customer_id", "left"
    )
    since = day_diff(as_of, "last_order_date")
    return joined.select(
        "customer_id",
        "customer_unique_id",
        F.col("city").alias("customer_city"),
        F.col("state").alias("customer_state"),
        "geolocation_lat",
        "geolocation_lng",
        *_or_zero(
            "total_orders", "delivered_orders", "canceled_orders", "on_time_deliveries",
            "late_deliveries", "lifetime_value", "total_products_amount",
            "total_shipping_amount", "total_payment_amount", "average_order_value",
            "average_items_per_order", "total_items_purchased", "total_unique_products",
            "total_unique_sellers", "average_shipping_amount", "credit_card_orders",
            "boleto_orders", "voucher_orders", "debit_card_orders",
        ),
        "average_review_score",
        *_or_zero(
            "orders_with_reviews", "positive_reviews", "negative_reviews",
            "reviews_with_comments",
        ),
        "first_order_date",
        "last_order_date",
        *_or_zero("average_delivery_time_days", "average_delivery_variance_days"),
        day_diff(as_of, "first_order_date").alias("days_since_first_order"),
        since.alias("days_since_last_order"),
        *_or_zero("active_months"),
        F.coalesce(F.col("total_orders") > 1, F.lit(False)).alias("is_repeat_customer"),
        F.when(F.col("last_order_date").isNull(), "no_orders")
        .otherwise(_recency(since))
        .alias("recency_segment"),
        ladder("total_orders", [(4, "high"), (2, "medium")], "low").alias(
            "frequency_segment"
        ),
        ladder("lifetime_value", [(500, "high"), (100, "medium")], "low").alias(
            "monetary_segment"
        ),
        ladder(
            "average_review_score",
            [("4.5", "promoter"), ("3.0", "passive")],
            "detractor",
            null="unknown",
        ).alias("nps_segment"),
    )


def delivery_terms() -> list[Column]:
    """What the seller mart needs of an order and the order facts do not have."""
    return [
        F.col("is_delivered"),
        micros_between("delivered_at", "purchased_at").alias("_took"),
        micros_between("estimated_delivery_at", "delivered_at").alias("_early"),
    ]


def mart_sellers(m, as_of: Column) -> DataFrame:
    """Sales, delivery and rating segments per seller."""
    orders = m["stg_orders"].select(
        "order_id", "customer_id", "purchased_at", "is_delivered_on_time", "order_status", *delivery_terms()
    )
    reviews = m["int_orders_with_items"].select(
        "order_id", "review_score", "is_positive_review", "is_negative_review",
        "has_review_comment",
    )
    sold = m["int_order_sellers"].join(orders, "order_id").join(reviews, "order_id", "left")
    items = (
        m["stg_order_items"]
        .select("order_id", "seller_id", "product_id")
        .join(orders.select("order_id"), "order_id", "left_semi")
    )
    return seller_mart(m, as_of, sold, items, month_span(orders, "purchased_at"))


def seller_mart(m, as_of: Column, sold: DataFrame, items: DataFrame, span: tuple[int, int] | None) -> DataFrame:
    """The columns of the seller mart from (order, seller) with what the order says, and from
    (seller, product), repeated or not; both of orders that exist."""
    n = F.col("item_rows")
    late = ~F.col("is_delivered_on_time") & F.col("is_delivered")
    day = 86_400_000_000
    sold = sold.filter(F.col("seller_id").isNotNull())
    per_seller = (
        with_distinct(sold, "seller_id", "customer_id", "unique_customers", [
            F.count("*").alias("total_orders"),
            per_item("is_delivered").alias("delivered_orders"),
            per_item(F.col("order_status") == "canceled").alias("canceled_orders"),
            per_item("is_delivered_on_time").alias("on_time_deliveries"),
            per_item(late).alias("late_deliveries"),
            F.sum("items").alias("total_items_sold"),
            from_cents(F.sum("price_cents")).alias("total_revenue"),
            from_cents(F.sum("shipping_cents")).alias("total_shipping_revenue"),
            from_cents(F.sum("gmv_cents")).alias("total_gmv"),
            F.sum("priced").alias("_priced"),
            F.sum("freighted").alias("_freighted"),
            weighted_mean(n, "review_score").alias("average_review_score"),
            F.count("review_score").alias("orders_with_reviews"),
            F.count_if("is_positive_review").alias("positive_reviews"),
            F.count_if("is_negative_review").alias("negative_reviews"),
            F.count_if("has_review_comment").alias("reviews_with_comments"),
            F.min("purchased_at").alias("first_order_date"),
            F.max("purchased_at").alias("last_order_date"),
            weighted_mean_micros(n, "_took", day).alias("average_delivery_time_days"),
            weighted_mean_micros(n, "_early", day).alias("average_delivery_variance_days"),
            months_in("purchased_at", span).alias("active_months"),
        ])
        .withColumn("average_item_price", ratio("total_revenue", "_priced", 6))
        .withColumn("average_shipping_fee", ratio("total_shipping_revenue", "_freighted", 6))
    )
    # every item whose order exists, reduced to distinct (seller, product)
    products = (
        items.select("seller_id", "product_id")
        .distinct()
        .groupBy("seller_id")
        .agg(F.count("product_id").alias("unique_products_sold"))
    )
    joined = (
        _with_coordinates(m["stg_sellers"], m)
        .join(per_seller, "seller_id", "left")
        .join(products, "seller_id", "left")
    )
    since = day_diff(as_of, "last_order_date")
    rate = lambda a, b, guard: F.when(
        (F.col(a) > 0) & (F.col(guard) > 0), pct(a, b)
    ).otherwise(0)
    return joined.select(
        "seller_id",
        F.col("city").alias("seller_city"),
        F.col("state").alias("seller_state"),
        "geolocation_lat",
        "geolocation_lng",
        *_or_zero(
            "total_orders", "delivered_orders", "canceled_orders", "on_time_deliveries",
            "late_deliveries", "unique_products_sold", "total_items_sold",
            "total_revenue", "total_shipping_revenue", "total_gmv",
            "average_item_price", "average_shipping_fee", "unique_customers",
        ),
        "average_review_score",
        *_or_zero(
            "orders_with_reviews", "positive_reviews", "negative_reviews",
            "reviews_with_comments",
        ),
        "first_order_date",
        "last_order_date",
        *_or_zero("average_delivery_time_days", "average_delivery_variance_days"),
        day_diff(as_of, "first_order_date").alias("days_since_first_order"),
        since.alias("days_since_last_order"),
        *_or_zero("active_months"),
        F.when(F.col("last_order_date").isNull(), "no_orders")
        .otherwise(_recency(since))
        .alias("recency_segment"),
        ladder(
            "total_orders", [(50, "high_volume"), (10, "medium_volume")], "low_volume"
        ).alias("volume_segment"),
        ladder(
            "total_gmv", [(10000, "high_value"), (1000, "medium_value")], "low_value"
        ).alias("value_segment"),
        ladder("average_review_score", RATING_STEPS, "poor", null="unknown").alias(
            "rating_segment"
        ),
        rate("on_time_deliveries", "delivered_orders", "total_orders").alias(
            "on_time_delivery_rate"
        ),
        rate("positive_reviews", "orders_with_reviews", "orders_with_reviews").alias(
            "positive_review_rate"
        ),
    )


def mart_product_categories(m, as_of: Column) -> DataFrame:
    """Totals per English category.  Product totals are summed once per
    product; orders and customers are counted over the category's orders."""
    ordered = m["int_order_products"].select("order_id", "product_id").join(
        m["int_orders_with_items"].select("order_id", "customer_id"), "order_id")
    return category_mart(m, as_of, ordered)


def category_mart(m, as_of: Column, ordered: DataFrame) -> DataFrame:
    """The columns of the category mart from products and from (order, product) with the
    customer, of orders that exist."""
    p = m["mart_products"].withColumn("category_name", F.col("category_name_english"))
    sums = p.groupBy("category_name").agg(
        F.count("product_id").alias("total_products"),
        *[
            F.sum(c).cast("decimal(20,2)").alias(c)
            for c in ("total_revenue", "total_shipping_revenue", "total_gmv")
        ],
        mean("avg_review_score", 6).alias("average_review_score"),
        F.count_if(F.col("avg_review_score") >= 4).alias("highly_rated_products"),
        F.sum("review_count").alias("total_reviews"),
        F.min("first_ordered_at").alias("first_ordered_at"),
        F.max("last_ordered_at").alias("last_ordered_at"),
    )
    # a category with a third of all orders is spread by order before counting
    orders = (
        ordered.join(p.select("product_id", "category_name"), "product_id")
        .groupBy("category_name", "order_id")
        .agg(F.max("customer_id").alias("customer_id"))
        .groupBy(F.col("category_name").alias("_c"))
        .agg(
            F.count("order_id").alias("total_orders"),
            F.count_distinct("customer_id").alias("unique_customers"),
        )
    )
    since = day_diff(as_of, "last_ordered_at")
    joined = sums.join(orders, F.col("category_name").eqNullSafe(F.col("_c")), "left")
    return joined.select(
        "category_name",
        "total_products",
        *_or_zero("total_orders", "unique_customers"),
        "total_revenue",
        "total_shipping_revenue",
        "total_gmv",
        "average_review_score",
        "highly_rated_products",
        "total_reviews",
        "first_ordered_at",
        "last_ordered_at",
        ratio("total_revenue", "total_products", 6).alias("revenue_per_product"),
        # both sides are integers: the quotient is truncated
        F.expr("coalesce(total_orders, 0) div nullif(total_products, 0)").alias(
            "orders_per_product"
        ),
        F.when(F.col("total_products") > 100, "large")
        .when(F.col("total_products") > 20, "medium")
        .otherwise("small")
        .alias("category_size"),
        F.when(F.col("total_revenue") > 100000, "high_revenue")
        .when(F.col("total_revenue") > 10000, "medium_revenue")
        .otherwise("low_revenue")
        .alias("revenue_segment"),
        F.when(F.col("total_orders") > 1000, "high_volume")
        .when(F.col("total_orders") > 100, "medium_volume")
        .otherwise("low_volume")
        .alias("volume_segment"),
        ladder("average_review_score", RATING_STEPS, "poor", null="unknown").alias(
            "rating_segment"
        ),
        since.alias("days_since_last_order"),
        _recency(since, with_year=False).alias("recency_segment"),
    )


# ------------------------------------------------- seller history, kept long


def seller_order_history(m, as_of=None) -> DataFrame:
    """(seller, order) with date and value: the two parallel arrays of the
    seller dashboard in long form, so that no seller's history is gathered."""
    return (
        m["int_order_sellers"]
        .filter(F.col("seller_id").isNotNull())
        .join(
            m["int_orders_with_items"].select("order_id", "customer_id", "purchased_at"),
            "order_id",
        )
        .select(
            "seller_id", "order_id", "customer_id",
            F.col("purchased_at").alias("order_date"),
            from_cents("price_cents").alias("order_value"),
        )
    )


def seller_category_history(m, as_of=None) -> DataFrame:
    """(seller, product) with its category and revenue, in long form."""
    return (
        m["stg_order_items"]
        .filter(F.col("seller_id").isNotNull())
        .groupBy("seller_id", "product_id")
        .agg(total("price_amount").alias("category_revenue"))
        .join(
            m["int_product_performance"].select(
                "product_id", F.col("category_name_english").alias("category")
            ),
            "product_id",
            "left",
        )
    )


MARTS = {
    f.__name__: f
    for f in [
        mart_orders,
        mart_products,
        mart_customers,
        mart_sellers,
        mart_product_categories,
        mart_customer_analytics,
        mart_seller_analytics,
        mart_product_analytics,
        seller_order_history,
        seller_category_history,
    ]
}
