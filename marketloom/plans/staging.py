"""Staging models: rename, cast, derive flags.

Each takes the raw table (typed or all text) and is a plain projection, except
geolocation, which keeps one row per zip prefix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.functions import epoch_diff, initcap_words, money, pad_zip, surrogate_key
from marketloom.operators.keyed import distinct_on


def _flag(cond: Column) -> Column:
    """A condition that is unknown counts as false."""
    return F.coalesce(cond, F.lit(False))


def _place(prefix: str) -> list[Column]:
    city, state = f"{prefix}_city", f"{prefix}_state"
    return [
        F.col(city).alias("city"),
        F.col(state).alias("state"),
        initcap_words(city).alias("city_normalized"),
        F.upper(state).alias("state_normalized"),
    ]


def _with_location(df: DataFrame) -> DataFrame:
    key = surrogate_key("zip_code_prefix", "city_normalized", "state_normalized")
    return df.withColumn("location_id", key)


def stg_customers(raw) -> DataFrame:
    return _with_location(
        raw["customers"].select(
            "customer_id",
            "customer_unique_id",
            pad_zip("customer_zip_code_prefix").alias("zip_code_prefix"),
            *_place("customer"),
        )
    )


def stg_sellers(raw) -> DataFrame:
    return _with_location(
        raw["sellers"].select(
            "seller_id",
            pad_zip("seller_zip_code_prefix").alias("zip_code_prefix"),
            *_place("seller"),
        )
    )


def stg_geolocation(raw) -> DataFrame:
    points = raw["geolocation"].select(
        pad_zip("geolocation_zip_code_prefix").alias("zip_code_prefix"),
        F.col("geolocation_lat").cast("double").alias("latitude"),
        F.col("geolocation_lng").cast("double").alias("longitude"),
        F.col("geolocation_city").alias("city"),
        F.col("geolocation_state").alias("state"),
    )
    # normalise after the reduction: one row per zip instead of all points
    kept = distinct_on(points, ["zip_code_prefix"], ["latitude", "longitude"])
    return kept.select(
        "*",
        initcap_words("city").alias("city_normalized"),
        F.upper("state").alias("state_normalized"),
    )


def stg_orders(raw) -> DataFrame:
    ts = lambda c: F.col(c).cast("timestamp_ntz")
    o = raw["orders"].select(
        "order_id",
        "customer_id",
        "order_status",
        ts("order_purchase_timestamp").alias("purchased_at"),
        ts("order_approved_at").alias("approved_at"),
        ts("order_delivered_carrier_date").alias("shipped_at"),
        ts("order_delivered_customer_date").alias("delivered_at"),
        ts("order_estimated_delivery_date").alias("estimated_delivery_at"),
    )
    return o.select(
        "*",
        epoch_diff("delivered_at", "purchased_at", 86400.0).alias("delivery_time_days"),
        epoch_diff("estimated_delivery_at", "delivered_at", 86400.0).alias(
            "delivery_variance_days"
        ),
        _flag(F.col("delivered_at") <= F.col("estimated_delivery_at")).alias(
            "is_delivered_on_time"
        ),
        F.col("delivered_at").isNotNull().alias("is_delivered"),
    )


def stg_order_items(raw) -> DataFrame:
    price, freight = money("price"), money("freight_value")
    return raw["order_items"].select(
        surrogate_key("order_id", "order_item_id").alias("order_item_sk"),
        "order_id",
        F.col("order_item_id").cast("int").alias("order_item_id"),
        "product_id",
        "seller_id",
        F.col("shipping_limit_date").cast("timestamp_ntz").alias("shipping_limit_at"),
        price.alias("price_amount"),
        freight.alias("shipping_amount"),
        (price + freight).alias("total_amount"),
        _flag(price == 0).alias("is_free_item"),
        _flag(freight == 0).alias("is_free_shipping"),
    )


def stg_order_payments(raw) -> DataFrame:
    n = F.col("payment_installments").cast("int")
    amount = money("payment_value")
    kind = F.col("payment_type")
    return raw["order_payments"].select(
        surrogate_key("order_id", "payment_sequential").alias("order_payment_sk"),
        "order_id",
        F.col("payment_sequential").cast("int").alias("payment_sequential"),
        "payment_type",
        n.alias("payment_installments"),
        amount.alias("payment_amount"),
        _flag(n > 1).alias("is_installment_payment"),
        _flag(kind == "credit_card").alias("is_credit_card"),
        _flag(kind == "debit_card").alias("is_debit_card"),
        _flag(kind == "voucher").alias("is_voucher"),
        _flag(kind == "boleto").alias("is_boleto"),
        F.round(F.try_divide(amount, n.cast("decimal(10,0)")), 6)
        .cast("decimal(18,6)")
        .alias("installment_amount"),
    )


def stg_order_reviews(raw) -> DataFrame:
    r = raw["order_reviews"].select(
        "review_id",
        "order_id",
        F.col("review_score").cast("int").alias("review_score"),
        "review_comment_title",
        "review_comment_message",
        F.col("review_creation_date").cast("timestamp_ntz").alias("created_at"),
        F.col("review_answer_timestamp").cast("timestamp_ntz").alias("answered_at"),
    )
    return r.select(
        "*",
        _flag(F.col("review_score") >= 4).alias("is_positive_review"),
        _flag(F.col("review_score") <= 2).alias("is_negative_review"),
        _flag(F.trim("review_comment_message") != "").alias("has_review_comment"),
        epoch_diff("answered_at", "created_at", 3600.0).alias("response_time_hours"),
    )


def stg_product_categories(raw) -> DataFrame:
    return raw["product_categories"].select(
        F.col("product_category_name").alias("category_id"),
        F.col("product_category_name_english").alias("category_name_english"),
        F.col("product_category_name").alias("category_name_portuguese"),
    )


def stg_products(raw) -> DataFrame:
    size = ["length_cm", "height_cm", "width_cm"]
    p = raw["products"].select(
        "product_id",
        F.col("product_category_name").alias("category_id"),
        *[F.col(f"product_{c}").cast("double").alias(c) for c in ["weight_g", *size]],
        F.col("product_name_lenght").cast("int").alias("name_length"),
        F.col("product_description_lenght").cast("int").alias("description_length"),
        F.col("product_photos_qty").cast("int").alias("photos_count"),
    )
    volume = F.col("length_cm") * F.col("height_cm") * F.col("width_cm")
    lacking = F.col("weight_g").isNull()
    for c in size:
        lacking = lacking | F.col(c).isNull()
    return p.select(
        "*",
        volume.cast("decimal(18,2)").alias("volume_cm3"),
        lacking.alias("is_missing_dimensions"),
    )


STAGING = {
    "stg_customers": stg_customers,
    "stg_sellers": stg_sellers,
    "stg_geolocation": stg_geolocation,
    "stg_orders": stg_orders,
    "stg_order_items": stg_order_items,
    "stg_order_payments": stg_order_payments,
    "stg_order_reviews": stg_order_reviews,
    "stg_product_categories": stg_product_categories,
    "stg_products": stg_products,
}
