"""Columns and reports that are documented but have no model of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from marketloom.functions import ladder, month_start, pct, total
from marketloom.functions.time import micros_between
from marketloom.operators.ranking import percent_ranks
from marketloom.plans.segments import seller_month_gmv, with_growth


def _fifths(share: str, names=("High", "Medium", "Low")):
    """Top 20 %, middle 60 %, bottom 20 % of the known values."""
    high, middle, low = names
    return F.when(
        F.col(share).isNotNull(),
        ladder(F.col(share).cast("decimal(20,12)"), [("0.8", high), ("0.2", middle)], low),
    )


def decl_pct_segments(m, as_of) -> DataFrame:
    """Percentile segments of customers, sellers and products, in long form."""
    plans = [
        ("customer", "int_customer_orders", "customer_id",
         {"spend": "total_spent", "orders": "total_orders"}),
        ("seller", "int_seller_performance", "seller_id",
         {"orders": "total_orders", "gmv": "total_gmv"}),
        ("product", "int_product_performance", "product_id",
         {"orders": "total_orders", "price": "avg_price"}),
    ]
    parts = []
    for entity, model, key, measures in plans:
        narrow = m[model].select(key, *measures.values())
        ranked = percent_ranks(
            narrow, key, {f"_{k}": (c, "asc_known") for k, c in measures.items()}
        )
        rows = [
            F.struct(
                F.lit(k).alias("measure"),
                _fifths(
                    f"_{k}",
                    ("Premium", "Standard", "Budget") if k == "price"
                    else ("High", "Medium", "Low"),
                ).alias("segment"),
            )
            for k in measures
        ]
        parts.append(
            ranked.select(
                F.lit(entity).alias("entity"),
                F.col(key).alias("entity_id"),
                F.explode(F.array(*rows)).alias("_s"),
            ).select("entity", "entity_id", "_s.measure", "_s.segment")
        )
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def decl_seller_tier(m, as_of) -> DataFrame:
    perf, delivery = F.col("performance_segment"), F.col("delivery_segment")
    fine = lambda c: c.isin("excellent", "good")
    tier = (
        F.when((perf == "excellent") & (delivery == "excellent"), "Elite")
        .when(fine(perf) & fine(delivery), "Premium")
        .when((perf == "poor") | (delivery == "poor"), "At Risk")
        .otherwise("Standard")
    )
    return m["int_seller_performance"].select("seller_id", tier.alias("seller_tier"))


def decl_mom_growth(m, as_of) -> DataFrame:
    return with_growth(seller_month_gmv(m)).select(
        "seller_id", "month", "gmv", F.col("growth_rate").alias("mom_growth_rate")
    )


def decl_product_tier(m, as_of) -> DataFrame:
    volume, rating = F.col("volume_segment"), F.col("rating_segment")
    tier = (
        F.when((volume == "high_volume") & (F.col("price_segment") == "premium"), "Premium")
        .when((volume == "high_volume") & rating.isin("excellent", "good"), "Popular")
        .when((volume == "low_volume") & (rating == "poor"), "At Risk")
        .otherwise("Standard")
    )
    return m["int_product_performance"].select("product_id", tier.alias("product_tier"))


def decl_logistics_complexity(m, as_of) -> DataFrame:
    weight, size = F.col("weight_segment"), F.col("size_segment")
    level = (
        F.when((weight == "heavy") | (size == "large"), "High")
        .when((weight == "light") & (size == "small"), "Low")
        .otherwise("Medium")
    )
    return m["int_product_performance"].select(
        "product_id", level.alias("logistics_complexity")
    )


def decl_category_relative_gmv(m, as_of) -> DataFrame:
    """Product GMV over the mean of its category.  The means are aggregated
    and joined back, so a large category is not one window partition."""
    p = m["int_product_performance"].select("product_id", "category_id", "gmv")
    means = p.groupBy(F.col("category_id").alias("_c")).agg(
        F.sum("gmv").alias("_s"), F.count("gmv").alias("_n")
    )
    joined = p.join(means, F.col("category_id").eqNullSafe(F.col("_c")), "left")
    return joined.select(
        "product_id",
        "category_id",
        F.try_divide(
            F.col("gmv").cast("double"), F.col("_s").cast("double") / F.col("_n")
        ).alias("category_relative_gmv"),
    )


# ------------------------------------------------------------ star schema


def dim_customers(m, as_of=None) -> DataFrame:
    return m["stg_customers"].select(
        "customer_id", "customer_unique_id", "location_id", "city_normalized",
        "state_normalized",
    )


def dim_products(m, as_of=None) -> DataFrame:
    return m["stg_products"].join(m["stg_product_categories"], "category_id", "left").select(
        "product_id", "category_id", "category_name_english", "weight_g", "volume_cm3",
        "is_missing_dimensions",
    )


def dim_locations(m, as_of=None) -> DataFrame:
    return m["stg_geolocation"].select(
        "zip_code_prefix", "city_normalized", "state_normalized", "latitude", "longitude"
    )


def dim_dates(m, as_of=None) -> DataFrame:
    """Calendar from the first to the last purchase day."""
    span = m["stg_orders"].agg(
        F.min("purchased_at").cast("date").alias("a"),
        F.max("purchased_at").cast("date").alias("b"),
    )
    return span.select(F.explode(F.sequence("a", "b")).alias("day")).select(
        F.col("day").cast("timestamp_ntz").alias("day"),
        F.year("day").cast("bigint").alias("year"),
        F.month("day").cast("bigint").alias("month"),
        F.dayofmonth("day").cast("bigint").alias("day_of_month"),
        (F.weekday("day") + 1).cast("bigint").alias("iso_weekday"),
    )


def fct_orders(m, as_of=None) -> DataFrame:
    return m["int_orders_with_items"].select(
        "order_id", "customer_id", "order_status", "purchased_at", "item_count",
        "total_amount", "payment_total", "review_score",
    )


def fct_order_items(m, as_of=None) -> DataFrame:
    return m["stg_order_items"].select(
        "order_item_sk", "order_id", "order_item_id", "product_id", "seller_id",
        "price_amount", "shipping_amount", "total_amount",
    )


def fct_payments(m, as_of=None) -> DataFrame:
    return m["stg_order_payments"].select(
        "order_payment_sk", "order_id", "payment_type", "payment_installments",
        "payment_amount",
    )


def fct_shipping(m, as_of=None) -> DataFrame:
    return m["stg_orders"].select(
        "order_id", "approved_at", "shipped_at", "delivered_at", "estimated_delivery_at",
        "is_delivered", "is_delivered_on_time",
    )


STAR = {
    f.__name__: f
    for f in [
        dim_customers, dim_products, dim_locations, dim_dates, fct_orders,
        fct_order_items, fct_payments, fct_shipping,
    ]
}


def decl_star_schema(m, as_of) -> DataFrame:
    """Row count of each star-schema table."""
    out = None
    for name, f in STAR.items():
        n = f(m).agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows")
        out = n if out is None else out.unionByName(n)
    return out


# ---------------------------------------------------------------- reports


def decl_cohort_retention(m, as_of) -> DataFrame:
    """Customers active n months after the month of their first order."""
    active = (
        m["stg_orders"]
        .select("customer_id", month_start("purchased_at").alias("month"))
        .distinct()
    )
    # one row per customer and month, so the window partition is a calendar
    first = F.min("month").over(W.partitionBy("customer_id"))
    index = lambda c: F.year(c) * 12 + F.month(c)
    sizes = (
        active.withColumn("cohort_month", first)
        .groupBy(
            "cohort_month",
            (index("month") - index("cohort_month")).cast("bigint").alias("months_since"),
        )
        .agg(F.count("*").alias("active_customers"))
    )
    start = F.max(F.when(F.col("months_since") == 0, F.col("active_customers"))).over(
        W.partitionBy("cohort_month")
    )
    return sizes.withColumn("retention_rate", pct("active_customers", start))


def decl_payment_mix(m, as_of) -> DataFrame:
    """Orders and amount per payment type and month."""
    by_order = m["stg_order_payments"].groupBy("order_id", "payment_type").agg(
        total("payment_amount").alias("amount")
    )
    return (
        by_order.join(m["stg_orders"].select("order_id", "purchased_at"), "order_id")
        .groupBy(month_start("purchased_at").alias("month"), "payment_type")
        .agg(F.count("*").alias("orders"), total("amount").alias("amount"))
    )


def decl_fulfilment_timeline(m, as_of) -> DataFrame:
    """Mean hours of each fulfilment step by month, and the late share."""
    hours = lambda a, b: _mean_hours(micros_between(a, b))
    return (
        m["stg_orders"]
        .groupBy(month_start("purchased_at").alias("month"))
        .agg(
            F.count("*").alias("orders"),
            hours("approved_at", "purchased_at").alias("hours_to_approve"),
            hours("shipped_at", "approved_at").alias("hours_to_ship"),
            hours("delivered_at", "shipped_at").alias("hours_to_deliver"),
            F.count_if(F.col("is_delivered") & ~F.col("is_delivered_on_time")).alias("_late"),
            F.count_if("is_delivered").alias("_done"),
        )
        .select(
            "month", "orders", "hours_to_approve", "hours_to_ship", "hours_to_deliver",
            pct("_late", "_done").alias("late_share"),
        )
    )


def _mean_hours(micros):
    s = F.sum(micros.cast("decimal(20,0)")).cast("decimal(32,0)")
    n = F.count(micros).cast("decimal(18,0)") * F.lit(3_600_000_000).cast("decimal(12,0)")
    return F.try_divide(s, n.cast("decimal(32,0)")).cast("decimal(24,6)")


def segment_migration(old: DataFrame, new: DataFrame, key: str, segment: str) -> DataFrame:
    """Counts of keys moving from one segment to another between snapshots."""
    return (
        old.select(key, F.col(segment).alias("old_segment"))
        .join(new.select(key, F.col(segment).alias("new_segment")), key, "full")
        .groupBy("old_segment", "new_segment")
        .agg(F.count("*").alias("moved"))
    )


def _frequency_at(m, until) -> DataFrame:
    orders = m["stg_orders"].filter(F.col("purchased_at") < until)
    return (
        orders.groupBy("customer_id").agg(F.count("*").alias("orders"))
        .select(
            "customer_id",
            ladder(
                "orders", [(5, "high_frequency"), (2, "medium_frequency")], "low_frequency"
            ).alias("frequency_segment"),
        )
    )


def decl_segment_migration(m, as_of) -> DataFrame:
    """Frequency segments three years before the reference time and at it."""
    before = F.add_months(as_of.cast("date"), -36).cast("timestamp_ntz")
    return segment_migration(
        _frequency_at(m, before), _frequency_at(m, as_of), "customer_id",
        "frequency_segment",
    )


DECLARED_QUERIES = {
    **STAR,
    **{
        f.__name__: f
        for f in [
            decl_pct_segments, decl_seller_tier, decl_mom_growth, decl_product_tier,
            decl_logistics_complexity, decl_category_relative_gmv, decl_star_schema,
            decl_cohort_retention, decl_payment_mix, decl_fulfilment_timeline,
            decl_segment_migration,
        ]
    },
}
