"""One small query per relational operator or function, over whole tables.

The models use all of these together; here each can be read, explained and
compared on its own.  ``m`` maps model names to DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from marketloom.functions import (
    day_diff,
    epoch_diff,
    guarded_corr,
    initcap_words,
    ladder,
    mean,
    mean_over_all,
    month_label,
    month_start,
    pct,
    ratio,
    sample_stddev,
    state_name,
    surrogate_key,
    to_seconds,
    total,
    unnest_zip,
)
from marketloom.operators.keyed import distinct_on, missing_parents, top_per_key, upsert
from marketloom.operators.ranking import ntile, percent_ranks, positions
from marketloom.plans.dashboard_parts import down, over_groups, scalar_sum, up

OPERATOR_QUERIES = {}


def query(f):
    OPERATOR_QUERIES[f.__name__] = f
    return f


# ---------------------------------------------------------------- filters


@query
def filter_compare(m, as_of) -> DataFrame:
    return m["mart_sellers"].filter("delivered_orders > 10").select(
        "seller_id", "delivered_orders"
    )


@query
def filter_month_eq(m, as_of) -> DataFrame:
    start = F.lit("1995-03-01").cast("date")
    ts = F.col("purchased_at")
    return m["stg_orders"].filter(
        (ts >= start.cast("timestamp_ntz"))
        & (ts < F.add_months(start, 1).cast("timestamp_ntz"))
    ).select("order_id", "purchased_at")


@query
def filter_is_not_null(m, as_of) -> DataFrame:
    return m["stg_products"].filter("weight_g is not null").select("product_id", "weight_g")


@query
def filter_between(m, as_of) -> DataFrame:
    return m["int_customer_orders"].filter(
        F.col("avg_order_amount").between(500, 1000)
    ).select("customer_id", "avg_order_amount")


@query
def filter_in_list(m, as_of) -> DataFrame:
    tier = F.col("rating_tier")
    return m["mart_product_analytics"].groupBy("price_tier").agg(
        F.count_if(~tier.isin("excellent", "poor")).alias("middle_products"),
        F.count_if(tier.isin("excellent", "poor")).alias("outer_products"),
    )


@query
def filter_in_subquery(m, as_of) -> DataFrame:
    canceled = m["stg_orders"].filter("order_status = 'canceled'").select("order_id")
    return (
        m["stg_order_items"]
        .select("order_id", "order_item_id", "price_amount")
        .join(canceled, "order_id", "left_semi")
    )


@query
def filter_gt_scalar_subquery(m, as_of) -> DataFrame:
    seen = m["stg_orders"].filter("purchased_at < timestamp_ntz'2001-01-01 00:00:00'")
    floor = F.lit("2000-01-01 00:00:00").cast("timestamp_ntz")
    mark = seen.agg(F.coalesce(F.max("purchased_at"), floor)).scalar()
    return m["stg_orders"].filter(F.col("purchased_at") > mark).select(
        "order_id", "purchased_at"
    )


@query
def having(m, as_of) -> DataFrame:
    return (
        m["mart_product_analytics"]
        .groupBy("category_name")
        .agg(F.count_distinct("product_id").alias("products"))
        .filter("products > 5")
    )


@query
def filter_window_result(m, as_of) -> DataFrame:
    per_category = (
        m["seller_category_history"]
        .groupBy("seller_id", "category")
        .agg(total("category_revenue").alias("revenue"))
    )
    return top_per_key(per_category, "seller_id", "revenue", "category")


@query
def filter_boolean_logic(m, as_of) -> DataFrame:
    return m["stg_orders"].filter(
        "(delivered_at is not null and delivered_at > estimated_delivery_at)"
        " or (approved_at is not null and shipped_at is null)"
    ).groupBy("order_status").agg(F.count("*").alias("orders"))


# ------------------------------------------------------------------ joins


@query
def join_order_rollups(m, as_of) -> DataFrame:
    joined = m["stg_orders"].select("order_id", "order_status")
    for part in ("int_order_items_agg", "int_order_financials", "int_order_reviews_agg"):
        joined = joined.join(m[part], "order_id", "left")
    return joined.select(
        "order_id", "order_status", "item_count", "payment_total", "review_score"
    )


@query
def join_customer_orders(m, as_of) -> DataFrame:
    orders = m["int_orders_with_items"].groupBy("customer_id").agg(
        F.count("*").alias("orders"), total("total_amount").alias("spent")
    )
    return (
        m["stg_customers"].select("customer_id", "state")
        .join(orders, "customer_id", "left")
        .join(m["int_customer_payments"], "customer_id", "left")
    )


@query
def join_product_orders(m, as_of) -> DataFrame:
    sold = (
        m["int_order_products"]
        .join(m["stg_orders"].select("order_id", "is_delivered"), "order_id", "left")
        .groupBy("product_id")
        .agg(F.count("*").alias("orders"), F.count_if("is_delivered").alias("delivered"))
    )
    return (
        m["stg_products"].select("product_id", "category_id")
        .join(m["stg_product_categories"], "category_id", "left")
        .join(sold, "product_id", "left")
        .select("product_id", "category_name_english", "orders", "delivered")
    )


@query
def join_seller_orders(m, as_of) -> DataFrame:
    sold = (
        m["int_order_sellers"]
        .join(m["stg_orders"].select("order_id", "purchased_at"), "order_id", "left")
        .groupBy("seller_id")
        .agg(F.sum("items").alias("items"), F.max("purchased_at").alias("last_sale"))
    )
    return m["stg_sellers"].select("seller_id", "state").join(sold, "seller_id", "left")


@query
def join_inner_items_orders(m, as_of) -> DataFrame:
    return (
        m["stg_order_items"].select("order_id", "order_item_id", "seller_id")
        .join(m["stg_orders"].select("order_id", "customer_id"), "order_id")
    )


@query
def join_left_rollup(m, as_of) -> DataFrame:
    return (
        m["int_order_sellers"].select("order_id", "seller_id", "items")
        .join(m["stg_orders"].select("order_id", "order_status"), "order_id")
        .join(m["int_orders_with_items"].select("order_id", "review_score"), "order_id", "left")
    )


@query
def join_dim_attach(m, as_of) -> DataFrame:
    late = m["stg_orders"].filter("not is_delivered_on_time and is_delivered")
    per_customer = late.groupBy("customer_id").agg(F.count("*").alias("late"))
    return m["stg_customers"].select("customer_id").join(
        per_customer, "customer_id", "left"
    ).select("customer_id", F.coalesce("late", F.lit(0)).alias("late_deliveries"))


@query
def join_mart_category(m, as_of) -> DataFrame:
    return (
        m["int_product_performance"].select("product_id", "category_id", "total_orders")
        .join(m["stg_product_categories"], "category_id", "left")
        .select("product_id", F.col("category_name_english").alias("category_name"),
                "total_orders")
    )


@query
def join_category_products(m, as_of) -> DataFrame:
    pairs = m["int_order_products"].select("product_id", "order_id")
    return (
        m["mart_products"].select("product_id", "category_name_english")
        .join(pairs, "product_id", "left")
        .groupBy("category_name_english", "order_id")
        .agg(F.count("product_id").alias("n"))
        .groupBy("category_name_english")
        .agg(F.count("order_id").alias("orders"))
    )


@query
def join_mart_state(m, as_of) -> DataFrame:
    return (
        m["mart_customer_analytics"].select("customer_id", "customer_tier")
        .join(m["int_customer_orders"].select("customer_id", "state_normalized"),
              "customer_id")
        .groupBy("customer_tier", "state_normalized")
        .agg(F.count("*").alias("customers"))
    )


def _category_sizes(m) -> DataFrame:
    return (
        m["mart_product_analytics"]
        .filter("category_name is not null")
        .groupBy("category_name")
        .agg(F.count("product_id").alias("products"))
    )


def _later(m) -> DataFrame:
    """Per category, how many categories sort after it and how many products
    those have.  Prefix sums over range partitions; no pair is formed."""
    sizes = _category_sizes(m)
    totals = sizes.agg(F.count("*").alias("n"), F.sum("products").alias("p"))
    ahead = positions(sizes, ["category_name"], "products", "theta").withColumnRenamed(
        "before", "_products_before"
    )
    return positions(ahead, ["category_name"], label="theta").select(
        "category_name",
        "products",
        (totals.select("n").scalar() - F.col("before") - 1).alias("later_categories"),
        (totals.select("p").scalar() - F.col("_products_before") - F.col("products"))
        .alias("later_products"),
    ).filter("later_categories > 0")


@query
def join_theta_pairs(m, as_of) -> DataFrame:
    """Per category, the categories that sort after it (``c1.name < c2.name``):
    how many, how many products they have."""
    return _later(m).drop("products")


@query
def join_pair_products(m, as_of) -> DataFrame:
    """Per category, the pairs of its products with those of all categories that
    sort after it: the product of two counts."""
    return _later(m).select(
        F.col("category_name").alias("category_1"),
        (F.col("products") * F.col("later_products")).alias("product_pairs"),
    )


@query
def join_totals(m, as_of) -> DataFrame:
    items = m["stg_order_items"].groupBy("order_id").agg(
        total("price_amount").alias("item_total"))
    paid = m["stg_order_payments"].groupBy("order_id").agg(
        total("payment_amount").alias("payment_total"))
    return items.join(paid, "order_id")


@query
def join_category_guide(m, as_of) -> DataFrame:
    return (
        m["int_product_performance"].select("product_id", "category_id", "volume_segment")
        .join(m["stg_product_categories"].select("category_id", "category_name_english"),
              "category_id")
        .groupBy("category_name_english", "volume_segment")
        .agg(F.count("*").alias("products"))
    )


@query
def semi_join(m, as_of) -> DataFrame:
    buyers = m["stg_orders"].filter("purchased_at >= timestamp_ntz'2001-06-01 00:00:00'")
    return m["stg_customers"].select("customer_id", "city").join(
        buyers.select("customer_id"), "customer_id", "left_semi"
    )


@query
def lateral_unnest(m, as_of) -> DataFrame:
    return (
        m["int_orders_with_items"]
        .select(F.explode("payment_methods").alias("payment_method"))
        .groupBy("payment_method")
        .agg(F.count("*").alias("orders"))
    )


@query
def lateral_unnest_ordinality(m, as_of) -> DataFrame:
    return unnest_zip(
        m["int_orders_with_items"],
        ["order_id"],
        {"seller_ids": "seller_id", "payment_methods": "payment_method"},
    )


@query
def correlated_scalar_count(m, as_of) -> DataFrame:
    """Distinct sellers per customer; decorrelated into two grouped counts."""
    sellers = (
        m["int_orders_with_items"]
        .select("customer_id", F.explode("seller_ids").alias("s"))
        .distinct()
        .groupBy("customer_id")
        .agg(F.count("s").alias("n"))
    )
    return m["stg_customers"].select("customer_id").join(
        sellers, "customer_id", "left"
    ).select("customer_id", F.coalesce("n", F.lit(0)).alias("unique_sellers"))


@query
def anti_join(m, as_of) -> DataFrame:
    return missing_parents(m["stg_orders"], "order_id", m["stg_order_items"], "order_id")\
        .select(F.col("_k").alias("order_id"))


# ------------------------------------------------------------ aggregates


@query
def agg_count_star(m, as_of) -> DataFrame:
    return m["stg_orders"].groupBy("order_status").agg(F.count("*").alias("orders"))


@query
def agg_count_distinct(m, as_of) -> DataFrame:
    return m["stg_order_items"].groupBy("seller_id").agg(
        F.count_distinct("product_id").alias("products"),
        F.count_distinct("order_id").alias("orders"),
    )


@query
def agg_count_distinct_expr(m, as_of) -> DataFrame:
    return m["stg_orders"].groupBy("customer_id").agg(
        F.count_distinct(month_start("purchased_at")).alias("active_months")
    )


@query
def agg_count_distinct_case(m, as_of) -> DataFrame:
    late = F.when(~F.col("is_delivered_on_time"), F.col("customer_id"))
    return m["stg_orders"].groupBy("order_status").agg(
        F.count_distinct(late).alias("customers_with_late_orders")
    )


@query
def agg_count_case(m, as_of) -> DataFrame:
    return m["stg_order_reviews"].groupBy("review_score").agg(
        F.count_if("has_review_comment").alias("with_comment"),
        F.count_if(F.col("response_time_hours") > 24).alias("slow_answers"),
    )


@query
def agg_sum(m, as_of) -> DataFrame:
    return m["stg_order_items"].groupBy("product_id").agg(
        total("price_amount").alias("revenue"),
        F.sum("order_item_id").alias("item_numbers"),
    )


@query
def agg_sum_case(m, as_of) -> DataFrame:
    kind = F.col("payment_type")
    return m["stg_order_payments"].groupBy("payment_installments").agg(
        F.sum(F.when(kind == "credit_card", F.col("payment_amount")).otherwise(0))
        .cast("decimal(20,2)").alias("credit_card_amount"),
        F.sum(F.when(kind == "voucher", 1).otherwise(0)).alias("vouchers"),
    )


@query
def agg_sum_bool(m, as_of) -> DataFrame:
    return m["stg_orders"].groupBy("customer_id").agg(
        F.count_if("is_delivered").alias("delivered_orders"),
        F.count_if("is_delivered_on_time").alias("on_time_deliveries"),
    )


@query
def agg_avg(m, as_of) -> DataFrame:
    return m["stg_order_items"].groupBy("seller_id").agg(
        mean("price_amount").alias("avg_price"),
        mean("shipping_amount").alias("avg_shipping"),
    )


@query
def agg_min_max(m, as_of) -> DataFrame:
    day = F.date_format("purchased_at", "yyyy-MM-dd")
    return m["stg_orders"].groupBy("order_status").agg(
        F.min("purchased_at").alias("first_at"),
        F.max("purchased_at").alias("last_at"),
        F.min(day).alias("first_day"),
        F.max(day).alias("last_day"),
    )


@query
def agg_bool_any(m, as_of) -> DataFrame:
    return m["stg_order_payments"].groupBy("order_id").agg(
        F.bool_or("is_voucher").alias("used_voucher"),
        F.bool_or("is_boleto").alias("used_boleto"),
    )


@query
def agg_max_is_not_null(m, as_of) -> DataFrame:
    return m["stg_order_reviews"].groupBy("order_id").agg(
        F.max("review_comment_message").isNotNull().alias("has_comment")
    )


@query
def agg_stddev(m, as_of) -> DataFrame:
    p = F.col("price_amount")
    return m["stg_order_items"].groupBy("seller_id").agg(
        F.count(p).alias("n"), F.sum(p).alias("s"), F.sum(p * p).alias("ss")
    ).select("seller_id", sample_stddev("n", "s", "ss").alias("price_variance"))


@query
def agg_corr(m, as_of) -> DataFrame:
    return m["mart_product_analytics"].groupBy("category_name").agg(
        F.round(guarded_corr("avg_price", "total_orders"), 6).alias("price_order_corr")
    )


@query
def agg_array_distinct(m, as_of) -> DataFrame:
    return m["stg_order_payments"].groupBy("payment_installments").agg(
        F.sort_array(F.collect_set("payment_type")).alias("payment_types")
    )


@query
def agg_of_agg_over(m, as_of) -> DataFrame:
    return (
        m["int_customer_orders"].groupBy("state_normalized")
        .agg(total("total_spent").alias("spent"))
        .withColumn("share", pct("spent", over_groups("spent")))
    )


@query
def agg_scalar_share(m, as_of) -> DataFrame:
    c = m["int_customer_orders"]
    return (
        c.groupBy("value_segment").agg(total("total_spent").alias("spent"))
        .withColumn("share", pct("spent", scalar_sum(c, "total_spent")))
    )


@query
def agg_conditional_ratio(m, as_of) -> DataFrame:
    return (
        m["mart_sellers"].groupBy("seller_state")
        .agg(F.sum("on_time_deliveries").alias("on_time"),
             F.sum("delivered_orders").alias("delivered"))
        .withColumn("on_time_rate", pct("on_time", "delivered"))
    )


@query
def group_by_expr(m, as_of) -> DataFrame:
    return m["stg_orders"].groupBy(month_start("purchased_at").alias("month")).agg(
        F.count("*").alias("orders")
    )


@query
def group_by_multi(m, as_of) -> DataFrame:
    return m["int_product_performance"].groupBy(
        "weight_segment", "size_segment", "price_segment", "volume_segment"
    ).agg(F.count("*").alias("products"))


@query
def distinct(m, as_of) -> DataFrame:
    return m["stg_order_items"].select("seller_id", "product_id").distinct()


def _distinct_on_zip(m, as_of) -> DataFrame:
    return distinct_on(
        m["geolocation"], ["geolocation_zip_code_prefix"],
        ["geolocation_lat", "geolocation_lng"],
    )


OPERATOR_QUERIES["distinct_on"] = _distinct_on_zip


# ---------------------------------------------------------------- windows


@query
def win_percent_rank(m, as_of) -> DataFrame:
    return percent_ranks(
        m["int_customer_orders"].select("customer_id", "total_spent", "avg_review_score"),
        "customer_id",
        {
            "spend_rank": ("total_spent", "asc"),
            "score_rank": ("avg_review_score", "desc"),
            "known_score_rank": ("avg_review_score", "asc_known"),
        },
    )


@query
def win_avg_all(m, as_of) -> DataFrame:
    c = m["int_customer_orders"].select("customer_id", "total_spent")
    return c.select(
        "customer_id",
        F.try_divide(F.col("total_spent").cast("double"), mean_over_all(c, "total_spent"))
        .alias("relative_value"),
    )


@query
def win_ntile(m, as_of) -> DataFrame:
    return ntile(m["int_customer_orders"], "customer_id", "total_spent", 5, "quintile")


@query
def win_row_number(m, as_of) -> DataFrame:
    """Rank of each category inside its seller; a seller has one row per
    category here, so the window partition is short."""
    w = W.partitionBy("seller_id").orderBy(down("revenue"), up("category"))
    return (
        m["seller_category_history"].groupBy("seller_id", "category")
        .agg(total("category_revenue").alias("revenue"))
        .select("seller_id", "category", F.row_number().over(w).alias("category_rank"))
    )


@query
def win_sum_partition(m, as_of) -> DataFrame:
    w = W.partitionBy("category_name")
    return (
        m["mart_product_analytics"].groupBy("category_name", "price_tier")
        .agg(total("gmv").alias("gmv"))
        .withColumn("category_gmv", F.sum("gmv").over(w).cast("decimal(20,2)"))
    )


@query
def win_sum_all(m, as_of) -> DataFrame:
    return (
        m["mart_sellers"].groupBy("seller_state").agg(total("total_revenue").alias("revenue"))
        .withColumn("all_revenue", over_groups("revenue").cast("decimal(20,2)"))
    )


@query
def win_count_all(m, as_of) -> DataFrame:
    return (
        m["mart_customer_analytics"].groupBy("customer_tier")
        .agg(F.count("*").alias("customers"))
        .withColumn("tiers", F.count("*").over(W.partitionBy()))
    )


@query
def win_lag(m, as_of) -> DataFrame:
    w = W.partitionBy("seller_id").orderBy("month")
    return (
        m["seller_order_history"]
        .groupBy("seller_id", month_start("order_date").alias("month"))
        .agg(total("order_value").alias("gmv"))
        .withColumn("prev_month_gmv", F.lag("gmv").over(w))
    )


# ----------------------------------------------------- sorts, sets, limits


@query
def sort_asc(m, as_of) -> DataFrame:
    return m["mart_product_analytics"].groupBy("category_name").agg(
        F.count("*").alias("products")
    ).orderBy(up("products"), up("category_name"))


@query
def sort_desc(m, as_of) -> DataFrame:
    return m["mart_product_analytics"].groupBy("category_name").agg(
        total("gmv").alias("gmv")
    ).orderBy(down("gmv"), down("category_name"))


@query
def topk(m, as_of) -> DataFrame:
    return (
        m["int_customer_orders"].select("customer_id", "total_spent")
        .orderBy(down("total_spent"), "customer_id").limit(20)
    )


@query
def union_all(m, as_of) -> DataFrame:
    places = lambda t: m[t].select("zip_code_prefix", "city", "state")
    return places("stg_customers").unionByName(places("stg_sellers"))


@query
def filter_after_union(m, as_of) -> DataFrame:
    return union_all(m, as_of).filter("state = 'SP'")


@query
def upsert_union(m, as_of) -> DataFrame:
    """Canceled orders re-arrive with their status corrected."""
    cols = ["order_id", "order_status", "purchased_at"]
    old = m["stg_orders"].select(*cols)
    batch = old.filter("order_status = 'canceled'").withColumn(
        "order_status", F.lit("refunded")
    )
    return upsert(old, batch, "order_id")


# ------------------------------------------------------- scalar functions


@query
def fn_initcap(m, as_of) -> DataFrame:
    return m["customers"].select(
        "customer_id", initcap_words("customer_city").alias("city_normalized"))


@query
def fn_upper(m, as_of) -> DataFrame:
    return m["customers"].select("customer_id", F.upper("customer_city").alias("city_upper"))


@query
def fn_trim(m, as_of) -> DataFrame:
    text = F.col("review_comment_message")
    return m["order_reviews"].select(
        "review_id", F.trim(text).alias("message"), (F.trim(text) != "").alias("is_filled"))


@query
def fn_length(m, as_of) -> DataFrame:
    return m["order_reviews"].select(
        "review_id", F.length("review_comment_message").alias("message_length"))


@query
def fn_surrogate_key(m, as_of) -> DataFrame:
    return m["order_items"].select(
        "order_id", "order_item_id", surrogate_key("order_id", "order_item_id").alias("sk"))


@query
def fn_to_char_date(m, as_of) -> DataFrame:
    return m["stg_orders"].select(
        "order_id", F.date_format("purchased_at", "yyyy-MM-dd").alias("purchase_day"))


@query
def fn_to_char_month(m, as_of) -> DataFrame:
    return m["stg_orders"].groupBy(month_label("purchased_at").alias("month_name")).agg(
        F.count("*").alias("orders"))


@query
def fn_date_trunc_month(m, as_of) -> DataFrame:
    return m["stg_orders"].select("order_id", month_start("purchased_at").alias("month"))


@query
def fn_date_part_month(m, as_of) -> DataFrame:
    return m["stg_orders"].select(
        "order_id", F.month("purchased_at").cast("bigint").alias("month_number"))


@query
def fn_day_diff(m, as_of) -> DataFrame:
    return m["stg_orders"].select(
        "order_id",
        day_diff("delivered_at", "purchased_at").alias("delivery_days"),
        day_diff("delivered_at", "estimated_delivery_at").alias("variance_days"),
        day_diff(as_of, "purchased_at").alias("age_days"),
    )


@query
def fn_epoch_diff(m, as_of) -> DataFrame:
    return m["stg_orders"].select(
        "order_id",
        epoch_diff("delivered_at", "purchased_at", 86400.0).alias("delivery_days"),
        epoch_diff("approved_at", "purchased_at", 3600.0).alias("approval_hours"),
    )


@query
def fn_interval_arith(m, as_of) -> DataFrame:
    recent = F.add_months(as_of.cast("date"), -3).cast("timestamp_ntz")
    old = F.add_months(as_of.cast("date"), -60).cast("timestamp_ntz")
    p = F.col("purchased_at")
    return m["stg_orders"].select(
        "order_id", (p >= recent).alias("last_3_months"), (p > old).alias("last_5_years"))


@query
def fn_interval_value(m, as_of) -> DataFrame:
    return m["int_orders_with_items"].select(
        "order_id",
        to_seconds("actual_delivery_time").alias("delivery_seconds"),
        to_seconds("delivery_variance").alias("variance_seconds"),
    )


@query
def fn_now(m, as_of) -> DataFrame:
    """Recency columns take the reference time as a parameter."""
    return m["int_customer_orders"].select(
        "customer_id", day_diff(as_of, "last_order_at").alias("days_since_last_order"),
        as_of.alias("generated_at"))


@query
def fn_round(m, as_of) -> DataFrame:
    return m["int_product_performance"].select(
        "product_id",
        *[F.round("avg_price", d).cast(f"decimal(20,{d})").alias(f"avg_price_{d}")
          for d in (1, 2, 3)],
    )


@query
def fn_abs(m, as_of) -> DataFrame:
    gap = F.abs(F.col("payment_total") - F.col("total_amount"))
    return m["int_orders_with_items"].select(
        "order_id", gap.alias("payment_gap"),
        F.abs("delivery_variance_days").alias("off_by_days"))


@query
def fn_nullif_div(m, as_of) -> DataFrame:
    return m["int_customer_orders"].select(
        "customer_id", ratio("total_spent", "customer_lifetime_days").alias("spend_per_day"))


@query
def fn_coalesce(m, as_of) -> DataFrame:
    return m["int_orders_with_items"].select(
        "order_id", F.coalesce("item_count", F.lit(0)).alias("item_count"),
        F.coalesce("review_score", F.lit(-1)).alias("review_score"))


@query
def fn_case_searched(m, as_of) -> DataFrame:
    return m["int_orders_with_items"].select(
        "order_id",
        ladder("total_amount", [(500, "high"), (100, "medium")], "low", null="none").alias(
            "order_size"),
    )


@query
def fn_case_simple(m, as_of) -> DataFrame:
    return m["stg_customers"].groupBy(state_name("state").alias("state_name")).agg(
        F.count("*").alias("customers"))


@query
def fn_cast(m, as_of) -> DataFrame:
    return m["order_items"].select(
        "order_id", "order_item_id",
        F.col("price").cast("int").alias("whole_price"),
        F.col("price").cast("string").alias("price_text"),
        F.col("order_item_id").cast("double").alias("item_number"),
        F.col("shipping_limit_date").cast("date").alias("limit_day"),
    )


@query
def fn_bool_expr(m, as_of) -> DataFrame:
    return m["stg_orders"].select(
        "order_id", (F.col("order_status") == "canceled").alias("is_canceled"),
        (~F.col("is_delivered_on_time") & F.col("is_delivered")).alias("is_late"))
