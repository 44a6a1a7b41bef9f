"""Intermediate models: one row per order, customer, product, seller.

Two rules keep them distributable when a key is hot.  Facts are aggregated
before they are joined, first to (order, entity) grain, which spreads a hot
order over its entities and a hot entity over its orders; and every join has a
unique key on at least one side.  ``count(distinct ...)`` over the item facts
becomes a plain count at the pre-aggregated grain."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.functions import (
    cents,
    day_diff,
    from_cents,
    ladder,
    mean,
    month_start,
    pct,
    ratio,
    sample_stddev,
    total,
)

def int_order_sellers(m, as_of=None) -> DataFrame:
    """Items rolled up to (order, seller)."""
    return m["stg_order_items"].groupBy("order_id", "seller_id").agg(
        F.count("*").alias("item_rows"),
        F.count("order_item_id").alias("items"),
        F.count("price_amount").alias("priced"),
        F.count("shipping_amount").alias("freighted"),
        F.sum(cents("price_amount")).alias("price_cents"),
        F.sum(cents("shipping_amount")).alias("shipping_cents"),
        F.sum(cents("total_amount")).alias("gmv_cents"),
        F.min("shipping_limit_at").alias("first_limit"),
        F.max("shipping_limit_at").alias("last_limit"),
    )


def int_order_products(m, as_of=None) -> DataFrame:
    """Items rolled up to (order, product)."""
    return m["stg_order_items"].groupBy("order_id", "product_id").agg(*order_product_sums())


def order_product_sums() -> list[Column]:
    price = F.col("price_amount")
    return [
        F.count("*").alias("item_rows"),
        F.count(price).alias("priced"),
        F.count("shipping_amount").alias("freighted"),
        F.sum(cents(price)).alias("price_cents"),
        F.sum(price * price).cast("decimal(34,4)").alias("price_sq"),
        F.sum(cents("shipping_amount")).alias("shipping_cents"),
        F.sum(cents("total_amount")).alias("gmv_cents"),
        F.min(price).alias("min_price"),
        F.max(price).alias("max_price"),
        F.sum("order_item_id").alias("item_numbers"),
    ]


def int_order_items_agg(m, as_of=None) -> DataFrame:
    """Items per order: counts, amounts, sellers, shipping limits."""
    sellers = m["int_order_sellers"].groupBy("order_id").agg(
        F.count("seller_id").alias("unique_sellers"),
        from_cents(F.sum("price_cents")).alias("products_amount"),
        from_cents(F.sum("shipping_cents")).alias("shipping_amount"),
        from_cents(F.sum("gmv_cents")).alias("total_amount"),
        F.min("first_limit").alias("first_shipping_limit_date"),
        F.max("last_limit").alias("last_shipping_limit_date"),
        F.sort_array(F.collect_list("seller_id")).alias("seller_ids"),
    )
    products = m["int_order_products"].groupBy("order_id").agg(
        F.count("product_id").alias("unique_products")
    )
    numbers = (
        m["stg_order_items"]
        .select("order_id", "order_item_id")
        .distinct()
        .groupBy("order_id")
        .agg(F.count("order_item_id").alias("item_count"))
    )
    return sellers.join(products, "order_id").join(numbers, "order_id")


PAYMENT_TYPES = ["credit_card", "boleto", "voucher", "debit_card"]


def int_order_financials(m, as_of=None) -> DataFrame:
    """Payments per order: amounts by type, flags, counts."""
    kind, paid = F.col("payment_type"), cents("payment_amount")
    amounts = m["stg_order_payments"].groupBy("order_id").agg(
        from_cents(F.sum(paid)).alias("payment_total"),
        *[
            from_cents(F.sum(F.when(kind == t, paid).otherwise(0))).alias(f"{t}_amount")
            for t in PAYMENT_TYPES
        ],
        *[
            F.max(F.coalesce(kind == t, F.lit(False))).alias(f"used_{t}")
            for t in PAYMENT_TYPES
        ],
        F.sort_array(F.collect_set(kind)).alias("payment_methods"),  # one entry per payment type
        F.max("payment_installments").alias("max_installments"),
    )
    amounts = amounts.withColumn("payment_methods_count", F.size("payment_methods").cast("bigint"))
    # the surrogate key is never NULL, so it counts a missing number once
    numbers = (
        m["stg_order_payments"]
        .select("order_id", "payment_sequential")
        .distinct()
        .groupBy("order_id")
        .agg(
            F.count("*").alias("payment_count"),
            F.count("payment_sequential").alias("payment_installments"),
        )
    )
    return amounts.join(numbers, "order_id")


def int_order_reviews_agg(m, as_of=None) -> DataFrame:
    """Reviews per order; an order can be both positive and negative."""
    score = F.col("review_score")
    return m["stg_order_reviews"].groupBy("order_id").agg(
        F.max(score).alias("review_score"),
        F.max(F.col("review_comment_message").isNotNull()).alias("has_review_comment"),
        F.max(F.coalesce(score >= 4, F.lit(False))).alias("is_positive_review"),
        F.max(F.coalesce(score <= 2, F.lit(False))).alias("is_negative_review"),
        F.max("created_at").alias("review_creation_date"),
        F.max("answered_at").alias("review_answer_timestamp"),
    )


def int_orders_with_items(m, as_of=None) -> DataFrame:
    """One row per order with its item, payment and review rollups."""
    done = (F.col("order_status") == "delivered") & F.col("delivered_at").isNotNull()
    status = lambda s: (F.col("order_status") == s).alias(f"is_{s}")
    joined = (
        m["stg_orders"]
        .join(m["int_order_items_agg"], "order_id", "left")
        .join(m["int_order_financials"], "order_id", "left")
        .join(m["int_order_reviews_agg"], "order_id", "left")
    )
    gap = F.abs(F.col("payment_total") - F.col("total_amount"))
    return joined.select(
        "order_id",
        "customer_id",
        "purchased_at",
        "approved_at",
        "estimated_delivery_at",
        F.col("delivered_at").alias("delivery_date"),
        F.col("shipped_at").alias("last_updated_status_at"),
        F.when(done, F.col("delivered_at") - F.col("purchased_at")).alias(
            "actual_delivery_time"
        ),
        F.when(done, F.col("delivered_at") - F.col("estimated_delivery_at")).alias(
            "delivery_variance"
        ),
        F.when(done, day_diff("delivered_at", "purchased_at")).alias("delivery_time_days"),
        F.when(done, day_diff("delivered_at", "estimated_delivery_at")).alias(
            "delivery_variance_days"
        ),
        "item_count",
        "unique_products",
        "unique_sellers",
        "products_amount",
        "shipping_amount",
        "total_amount",
        "first_shipping_limit_date",
        "last_shipping_limit_date",
        "payment_total",
        *[f"{t}_amount" for t in PAYMENT_TYPES],
        "payment_count",
        "payment_installments",
        *[f"used_{t}" for t in PAYMENT_TYPES],
        "payment_methods_count",
        "review_score",
        "has_review_comment",
        "is_positive_review",
        "is_negative_review",
        "review_creation_date",
        "review_answer_timestamp",
        "order_status",
        "is_delivered",
        status("canceled"),
        status("shipped"),
        status("unavailable"),
        status("invoiced"),
        status("processing"),
        status("created"),
        status("approved"),
        "is_delivered_on_time",
        # read by the customer model and by the declared column tests
        F.col("item_count").alias("number_of_items"),
        F.col("unique_sellers").alias("number_of_sellers"),
        "seller_ids",
        "payment_methods",
        F.col("products_amount").alias("total_items_amount"),
        F.col("shipping_amount").alias("total_shipping_amount"),
        F.col("total_amount").alias("total_order_amount"),
        F.col("payment_total").alias("total_payment_amount"),
        "max_installments",
        (gap > 1).alias("has_payment_discrepancy"),
    )


def int_customer_payments(m, as_of=None) -> DataFrame:
    """Distinct payment methods per customer, as a sorted array (one entry per
    payment type that exists)."""
    return (
        m["int_orders_with_items"]
        .select("customer_id", F.explode("payment_methods").alias("pm"))
        .groupBy("customer_id")
        .agg(F.sort_array(F.collect_set("pm")).alias("all_payment_methods_used"))
    )


def _customer_sellers(m) -> DataFrame:
    return (
        m["int_orders_with_items"]
        .select("customer_id", F.explode("seller_ids").alias("seller_id"))
        .distinct()
        .groupBy("customer_id")
        .agg(F.count("seller_id").alias("unique_sellers_bought_from"))
    )


def _zeroed(df: DataFrame, names: list[str]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in names})


def int_customer_orders(m, as_of=None) -> DataFrame:
    """Order history per customer, customers without orders included."""
    is_ = lambda s: F.count_if(F.col("order_status") == s)
    on_time = F.col("is_delivered_on_time")
    per_customer = m["int_orders_with_items"].groupBy("customer_id").agg(
        F.count("order_id").alias("total_orders"),
        is_("delivered").alias("delivered_orders"),
        is_("canceled").alias("canceled_orders"),
        F.sum("number_of_items").alias("total_items_purchased"),
        *[total(c).alias(c) for c in ("total_items_amount", "total_shipping_amount")],
        total("total_order_amount").alias("total_spent"),
        mean("total_order_amount").alias("avg_order_amount"),
        F.max("total_order_amount").alias("max_order_amount"),
        mean("max_installments").alias("avg_installments_used"),
        F.count_if("has_payment_discrepancy").alias("orders_with_payment_issues"),
        mean("review_score").alias("avg_review_score"),
        F.count_if("is_positive_review").alias("positive_reviews"),
        F.count_if("is_negative_review").alias("negative_reviews"),
        F.count_if("has_review_comment").alias("reviews_with_comments"),
        mean("delivery_time_days").alias("avg_delivery_time_days"),
        F.count_if(on_time).alias("on_time_deliveries"),
        F.count_if(~on_time).alias("late_deliveries"),
        F.min("purchased_at").alias("first_order_at"),
        F.max("purchased_at").alias("last_order_at"),
        months_in("purchased_at", month_span(m["int_orders_with_items"], "purchased_at")).alias("active_months"),
    )
    base = (
        m["stg_customers"]
        .select("customer_id", "zip_code_prefix", "city_normalized", "state_normalized")
        .join(per_customer, "customer_id", "left")
        .join(m["int_customer_payments"], "customer_id", "left")
        .join(_customer_sellers(m), "customer_id", "left")
        .withColumn("customer_lifetime_days", day_diff("last_order_at", "first_order_at"))
    )
    base = _zeroed(
        base,
        [
            "total_orders", "delivered_orders", "canceled_orders",
            "unique_sellers_bought_from", "orders_with_payment_issues",
            "positive_reviews", "negative_reviews", "reviews_with_comments",
            "on_time_deliveries", "late_deliveries", "active_months",
        ],
    )
    return base.select(
        "*",
        ratio("total_orders", "active_months").alias("orders_per_month"),
        ratio("total_spent", "total_orders").alias("avg_monthly_spend"),
        pct("positive_reviews", "total_orders").alias("positive_review_rate"),
        pct("on_time_deliveries", "delivered_orders").alias("on_time_delivery_rate"),
        pct("canceled_orders", "total_orders").alias("order_cancellation_rate"),
        ratio("total_spent", "customer_lifetime_days").alias("spend_per_day"),
        ratio("total_spent", "active_months").alias("spend_per_month"),
        ladder(
            "total_orders",
            [(5, "high_frequency"), (2, "medium_frequency")],
            "low_frequency",
        ).alias("frequency_segment"),
        ladder(
            "avg_order_amount", [(500, "high_value"), (100, "medium_value")], "low_value"
        ).alias("value_segment"),
        ladder("avg_review_score", [(4, "promoter"), (3, "passive")], "detractor").alias(
            "nps_segment"
        ),
    )


def per_item(flag):
    """Count an order-level condition once per item row behind it."""
    flag = F.col(flag) if isinstance(flag, str) else flag
    return F.coalesce(F.sum(F.when(flag, F.col("item_rows"))), F.lit(0))


#: Words of 64 months beyond which months are kept as a set (42 years).
MONTH_WORDS = 8


def _month_number(ts: str):
    return F.year(ts) * 12 + F.month(ts)


def month_span(df: DataFrame, ts: str) -> tuple[int, int] | None:
    """Number of the first month and words of 64 months up to the last; ``None``
    if that are too many."""
    first, last = df.agg(F.min(_month_number(ts)), F.max(_month_number(ts))).first()
    if first is None:
        return 0, 1
    words = (last - first) // 64 + 1
    return (first, words) if words <= MONTH_WORDS else None


def months_in(ts: str, span: tuple[int, int] | None = None):
    """Distinct months, as bits of whole numbers, one bit for every month of ``span``.

    Beside another distinct count, ``count_distinct`` would send every joined row
    through the shuffle once for each of the two, and a set of months, which it is
    without a span, would travel with every row."""
    if span is None:
        return F.size(F.collect_set(month_start(ts))).cast("bigint")
    first, words = span
    at = _month_number(ts) - first
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(at, F.lit(64)))
    found = [
        F.bit_count(F.bit_or(F.when((at >= 64 * w) & (at < 64 * (w + 1)), bit))) for w in range(words)
    ]
    return reduce(Column.__add__, [F.coalesce(n, F.lit(0)) for n in found]).cast("bigint")


def known(x, weight="item_rows"):
    """``weight`` where ``x`` is true, or known, else 0: a term of a sum."""
    x = F.col(x) if isinstance(x, str) else x
    return F.when(x, F.col(weight)).otherwise(0)


def times(x, weight="item_rows"):
    """``weight`` times ``x``, 0 where it is unknown: a term of a sum."""
    return F.coalesce(F.col(weight) * F.col(x), F.lit(0))


def sum_ratio(num, den):
    """The weighted mean of two sums (see ``weighted_mean``)."""
    q = F.try_divide(F.col(num).cast("decimal(22,0)"), F.col(den).cast("decimal(18,0)"))
    return q.cast("decimal(24,6)")


def amount(sum_of_cents, rows):
    """Money of a sum, NULL if it is over no row."""
    return F.when(F.col(rows) > 0, from_cents(sum_of_cents))


RATING_STEPS = [("4.5", "excellent"), ("4.0", "good"), ("3.0", "average")]


# What an order adds to a product's or seller's sums.  All terms are whole numbers or exact
# decimals, so they can be taken back row by row.


def order_terms() -> dict:
    return {
        "review_num": times("review_score"),
        "review_den": known(F.col("review_score").isNotNull()),
        "positive_reviews": known("is_positive_review"),
        "negative_reviews": known("is_negative_review"),
        "took_num": times("delivery_time_days"),
        "took_den": known(F.col("delivery_time_days").isNotNull()),
        "on_time_deliveries": known("is_delivered_on_time"),
        "late_deliveries": known(~F.col("is_delivered_on_time")),
        "price_sum": F.coalesce("price_cents", F.lit(0)),
        "shipping_sum": F.coalesce("shipping_cents", F.lit(0)),
        "priced_rows": F.col("priced"),
        "freighted_rows": F.col("freighted"),
    }


def seller_terms() -> dict:
    return {
        **order_terms(),
        "total_orders": F.col("is_found").cast("bigint"),
        "delivered_orders": known(F.col("order_status") == "delivered"),
        "canceled_orders": known(F.col("order_status") == "canceled"),
    }


def product_terms() -> dict:
    return {
        **order_terms(),
        "total_orders": F.col("order_id").isNotNull().cast("bigint"),
        "reviews_with_comments": known("has_review_comment"),
        "variance_num": times("delivery_variance_days"),
        "variance_den": known(F.col("delivery_variance_days").isNotNull()),
        "gmv_sum": F.coalesce("gmv_cents", F.lit(0)),
        "gmv_rows": F.col("gmv_cents").isNotNull().cast("bigint"),
        "square_sum": F.coalesce("price_sq", F.lit(0)).cast("decimal(34,4)"),
        "items_sum": F.coalesce("item_numbers", F.lit(0)),
        "numbered_rows": F.col("item_numbers").isNotNull().cast("bigint"),
    }


#: Least and greatest values, by column.
SELLER_EXTREMES = {"first_at": ("min", "purchased_at"), "last_at": ("max", "purchased_at")}
PRODUCT_EXTREMES = {
    **SELLER_EXTREMES, "min_price": ("min", "min_price"), "max_price": ("max", "max_price"),
}


def _order_columns(m) -> DataFrame:
    return m["int_orders_with_items"].select(
        "order_id", F.lit(True).alias("_found"), "customer_id", "order_status", "purchased_at",
        "review_score", "is_positive_review", "is_negative_review", "has_review_comment",
        "delivery_time_days", "delivery_variance_days", "is_delivered_on_time",
    )


def order_seller_facts(m) -> DataFrame:
    """(order, seller) with what the order says; orders that are not known have
    nothing to say."""
    return m["int_order_sellers"].join(_order_columns(m), "order_id", "left").withColumn(
        "is_found", F.coalesce("_found", F.lit(False))
    ).drop("_found")


def order_product_facts(m) -> DataFrame:
    """(order, product) with what the order says."""
    return m["int_order_products"].join(_order_columns(m), "order_id", "left").drop("_found")


def summed(terms: dict, extremes: dict) -> list:
    return [
        *[F.sum(e).alias(n) for n, e in terms.items()],
        *[getattr(F, how)(c).alias(n) for n, (how, c) in extremes.items()],
    ]


def with_distinct(df: DataFrame, key: str, value: str, out: str, sums: list[Column]) -> DataFrame:
    """``sums`` per known ``key``, and the number of distinct ``value`` as ``out``.

    In one aggregate, every sum would go through the shuffle once for each (key, value);
    apart, pairs go through it and sums of what a task has read."""
    distinct = df.select(key, value).distinct().groupBy(key).agg(F.count(value).alias(out))
    return df.groupBy(key).agg(*sums).join(distinct, key)


def int_product_performance(m, as_of) -> DataFrame:
    """Sales, review and delivery measures per product."""
    facts = order_product_facts(m).filter(F.col("product_id").isNotNull())
    span = month_span(m["int_orders_with_items"], "purchased_at")
    sums = with_distinct(facts, "product_id", "customer_id", "unique_customers", [
        *summed(product_terms(), PRODUCT_EXTREMES),
        months_in("purchased_at", span).alias("active_months"),
    ])
    sellers = (
        m["stg_order_items"]
        .select("product_id", "seller_id")
        .distinct()
        .groupBy("product_id")
        .agg(F.count("seller_id").alias("unique_sellers"))
    )
    return product_measures(m, as_of, sums, sellers)


def product_measures(m, as_of, sums: DataFrame, sellers: DataFrame) -> DataFrame:
    """The columns of the product model from sums per product and from the number of
    sellers per product."""
    per_product = sums.select(
        "product_id", "total_orders", "unique_customers",
        amount("price_sum", "priced_rows").alias("total_revenue"),
        amount("shipping_sum", "freighted_rows").alias("total_shipping_revenue"),
        amount("gmv_sum", "gmv_rows").alias("total_gmv"),
        "min_price", "max_price",
        sum_ratio("review_num", "review_den").alias("avg_review_score"),
        "positive_reviews", "negative_reviews", "reviews_with_comments",
        F.col("review_den").alias("review_count"),
        sum_ratio("took_num", "took_den").alias("avg_delivery_time_days"),
        sum_ratio("variance_num", "variance_den").alias("avg_delivery_variance_days"),
        "on_time_deliveries", "late_deliveries",
        F.col("first_at").alias("first_ordered_at"), F.col("last_at").alias("last_ordered_at"),
        "active_months",
        F.when(F.col("numbered_rows") > 0, F.col("items_sum")).alias("total_items_sold"),
        "square_sum", "priced_rows", "freighted_rows",
    )
    per_product = (
        per_product.withColumn(
            "price_variance", sample_stddev("priced_rows", "total_revenue", "square_sum"))
        .withColumn("avg_price", ratio("total_revenue", "priced_rows", 6))
        .withColumn("avg_shipping_fee", ratio("total_shipping_revenue", "freighted_rows", 6))
        .drop("square_sum", "priced_rows", "freighted_rows")
    )
    base = _zeroed(
        m["stg_products"]
        .join(m["stg_product_categories"], "category_id", "left")
        .join(per_product, "product_id", "left")
        .join(sellers, "product_id", "left"),
        [
            "total_orders", "unique_customers", "unique_sellers", "positive_reviews",
            "negative_reviews", "reviews_with_comments", "review_count",
            "on_time_deliveries", "late_deliveries", "active_months",
        ],
    )
    return base.select(
        "product_id", "category_id", "category_name_english", "category_name_portuguese",
        "name_length", "description_length", "photos_count", "weight_g", "length_cm",
        "height_cm", "width_cm", "volume_cm3", "is_missing_dimensions", "total_orders",
        "unique_customers", "unique_sellers", "total_revenue", "total_shipping_revenue",
        "total_gmv", "min_price", "max_price", "price_variance", "avg_price",
        "avg_shipping_fee", "avg_review_score", "positive_reviews", "negative_reviews",
        "reviews_with_comments", "review_count", "avg_delivery_time_days",
        "avg_delivery_variance_days", "on_time_deliveries", "late_deliveries",
        "first_ordered_at", "last_ordered_at", "active_months",
        day_diff(as_of, "first_ordered_at").alias("days_since_first_order"),
        day_diff(as_of, "last_ordered_at").alias("days_since_last_order"),
        day_diff("last_ordered_at", "first_ordered_at").alias("product_lifetime_days"),
        "total_items_sold",
        ratio("total_orders", "active_months").alias("orders_per_month"),
        ratio("total_gmv", "active_months").alias("gmv_per_month"),
        pct("positive_reviews", "total_orders").alias("positive_review_rate"),
        pct("on_time_deliveries", "total_orders").alias("on_time_delivery_rate"),
        pct("review_count", "total_orders").alias("review_rate"),
        F.col("total_gmv").alias("gmv"),
        ladder(
            "total_orders", [(50, "high_volume"), (10, "medium_volume")], "low_volume"
        ).alias("volume_segment"),
        ladder("avg_price", [(500, "premium"), (100, "mid_range")], "budget").alias(
            "price_segment"
        ),
        ladder("avg_review_score", RATING_STEPS, "poor").alias("rating_segment"),
        ladder("weight_g", [(10000, "heavy"), (2000, "medium")], "light").alias(
            "weight_segment"
        ),
        ladder("volume_cm3", [(50000, "large"), (10000, "medium")], "small").alias(
            "size_segment"
        ),
    )


def int_seller_performance(m, as_of=None) -> DataFrame:
    """Order, customer, review and delivery measures per seller.

    Order-level flags count once per item, so rates can exceed 100."""
    facts = order_seller_facts(m).filter(F.col("seller_id").isNotNull())
    span = month_span(m["int_orders_with_items"], "purchased_at")
    return seller_measures(m, with_distinct(facts, "seller_id", "customer_id", "unique_customers", [
        *summed(seller_terms(), SELLER_EXTREMES),
        months_in("purchased_at", span).alias("active_months"),
    ]))


def seller_measures(m, sums: DataFrame) -> DataFrame:
    """The columns of the seller model from sums per seller."""
    per_seller = sums.select(
        "seller_id", "total_orders", "delivered_orders", "canceled_orders", "unique_customers",
        amount("price_sum", "priced_rows").alias("total_gmv"),
        amount("shipping_sum", "freighted_rows").alias("total_shipping_collected"),
        sum_ratio("review_num", "review_den").alias("avg_review_score"),
        "positive_reviews", "negative_reviews",
        sum_ratio("took_num", "took_den").alias("avg_delivery_time_days"),
        "on_time_deliveries", "late_deliveries",
        F.col("first_at").alias("first_order_at"), F.col("last_at").alias("last_order_at"),
        "active_months",
        ratio(amount("price_sum", "priced_rows"), "priced_rows", 6).alias("avg_order_item_value"),
    )
    base = _zeroed(
        m["stg_sellers"]
        .select("seller_id", "zip_code_prefix", "city_normalized", "state_normalized")
        .join(per_seller, "seller_id", "left"),
        [
            "total_orders", "delivered_orders", "canceled_orders", "unique_customers",
            "positive_reviews", "negative_reviews", "on_time_deliveries",
            "late_deliveries", "active_months",
        ],
    ).withColumn("seller_lifetime_days", day_diff("last_order_at", "first_order_at"))
    rated = base.select(
        "*",
        ratio("total_orders", "active_months").alias("orders_per_month"),
        ratio("total_gmv", "active_months").alias("gmv_per_month"),
        ratio("total_gmv", "total_orders").alias("avg_order_value"),
        pct("positive_reviews", "total_orders").alias("positive_review_rate"),
        pct("on_time_deliveries", "total_orders").alias("on_time_delivery_rate"),
        ratio("unique_customers", "total_orders").alias("customer_reorder_rate"),
    )
    return rated.select(
        "*",
        ladder(
            "total_orders", [(100, "high_volume"), (20, "medium_volume")], "low_volume"
        ).alias("volume_segment"),
        ladder(
            "total_gmv", [(50000, "high_value"), (10000, "medium_value")], "low_value"
        ).alias("value_segment"),
        ladder("avg_review_score", RATING_STEPS, "poor").alias("performance_segment"),
        ladder(
            "on_time_delivery_rate",
            [(95, "excellent"), (85, "good"), (70, "average")],
            "poor",
        ).alias("delivery_segment"),
    )


INTERMEDIATE = {
    f.__name__: f
    for f in [
        int_order_sellers,
        int_order_products,
        int_order_items_agg,
        int_order_financials,
        int_order_reviews_agg,
        int_orders_with_items,
        int_customer_payments,
        int_customer_orders,
        int_product_performance,
        int_seller_performance,
    ]
}
