"""Fixed schemas of the nine source tables and the file each is loaded from."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


_KINDS = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "decimal(10,2)": T.DecimalType(10, 2),
    "timestamp_ntz": T.TimestampNTZType(),
}


def _schema(ddl: str) -> T.StructType:
    """A schema from DDL (Spark's own parser needs a running session)."""
    out = T.StructType()
    for part in ddl.split(", "):
        name, kind = part.split()
        out.add(name, _KINDS[kind])
    return out


@dataclass(frozen=True)
class SourceTable:
    """One declared source: file name, column types, CSV peculiarities."""

    name: str
    file: str
    schema: T.StructType
    free_text: bool = False  # quoted fields may contain line breaks
    zip_column: str | None = None


# File names, table names and column names of the public dataset
# (two product columns are misspelled at the source).
SOURCES = {
    t.name: t
    for t in [
        SourceTable(
            "customers",
            "olist_customers_dataset.csv",
            _schema(
                "customer_id string, customer_unique_id string, customer_zip_code_prefix string, "
                "customer_city string, customer_state string"
            ),
            zip_column="customer_zip_code_prefix",
        ),
        SourceTable(
            "geolocation",
            "olist_geolocation_dataset.csv",
            _schema(
                "geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double, "
                "geolocation_city string, geolocation_state string"
            ),
            zip_column="geolocation_zip_code_prefix",
        ),
        SourceTable(
            "order_items",
            "olist_order_items_dataset.csv",
            _schema(
                "order_id string, order_item_id int, product_id string, seller_id string, "
                "shipping_limit_date timestamp_ntz, price decimal(10,2), freight_value decimal(10,2)"
            ),
        ),
        SourceTable(
            "order_payments",
            "olist_order_payments_dataset.csv",
            _schema(
                "order_id string, payment_sequential int, payment_type string, "
                "payment_installments int, payment_value decimal(10,2)"
            ),
        ),
        SourceTable(
            "order_reviews",
            "olist_order_reviews_dataset.csv",
            _schema(
                "review_id string, order_id string, review_score int, review_comment_title string, "
                "review_comment_message string, review_creation_date timestamp_ntz, "
                "review_answer_timestamp timestamp_ntz"
            ),
            free_text=True,
        ),
        SourceTable(
            "orders",
            "olist_orders_dataset.csv",
            _schema(
                "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz, "
                "order_approved_at timestamp_ntz, order_delivered_carrier_date timestamp_ntz, "
                "order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz"
            ),
        ),
        SourceTable(
            "products",
            "olist_products_dataset.csv",
            _schema(
                "product_id string, product_category_name string, product_name_lenght int, "
                "product_description_lenght int, product_photos_qty int, "
                "product_weight_g double, product_length_cm double, product_height_cm double, "
                "product_width_cm double"
            ),
        ),
        SourceTable(
            "sellers",
            "olist_sellers_dataset.csv",
            _schema(
                "seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string"
            ),
            zip_column="seller_zip_code_prefix",
        ),
        SourceTable(
            "product_categories",
            "product_category_name_translation.csv",
            _schema("product_category_name string, product_category_name_english string"),
        ),
    ]
}
