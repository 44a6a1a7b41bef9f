"""SQL of the source, sink and incremental runs."""

from __future__ import annotations

from marketloom.oracle.models import shown
from marketloom.sources.landing import LANDED
from marketloom.sources.schemas import SOURCES

_ROWS = "(SELECT COUNT(*) FROM raw_{t})"

SOURCE_SQL = {
    "inc_orders_with_items": shown("int_orders_with_items"),
    "inc_customer_orders": shown("int_customer_orders"),
    "inc_product_performance": shown("int_product_performance"),
    "inc_seller_performance": shown("int_seller_performance"),
    "inc_mart_orders": shown("mart_orders"),
    "inc_mart_customers": shown("mart_customers"),
    "inc_mart_sellers": shown("mart_sellers"),
    "inc_mart_products": shown("mart_products"),
    "inc_mart_categories": shown("mart_product_categories"),
    "inc_schema_sync": """SELECT customer_id, city,
 CASE WHEN state='SP' THEN city_normalized END AS city_normalized FROM stg_customers""",
    "sink_incremental": "SELECT order_id, order_status, purchased_at FROM stg_orders",
    "stream_monthly_orders": """SELECT CAST(date_trunc('month', purchased_at) AS TIMESTAMP)
 AS month, COUNT(*) AS orders FROM stg_orders GROUP BY 1""",
    "src_csv": "SELECT * FROM raw_orders",
    "src_registry": "\nUNION ALL ".join(
        f"SELECT '{t}' AS \"table\", 'loaded' AS status, {_ROWS.format(t=t)} AS rows"
        for t in SOURCES
    ),
    "chunked_append": "SELECT * FROM raw_order_reviews",
    "land_raw_text": "\nUNION ALL ".join(
        f"SELECT '{t}' AS \"table\", 'ok' AS status, {_ROWS.format(t=t)} AS rows"
        for t in LANDED
    ),
    "land_status": f"""SELECT 6 AS tables_processed, 1 AS tables_failed,
 CAST({"+".join(_ROWS.format(t=t) for t in LANDED)} AS BIGINT) AS rows_processed,
 'partial_failure' AS status""",
    "seed_translation": "SELECT * FROM raw_product_categories",
    "sink_view": "SELECT * FROM stg_customers",
    "sink_table": "SELECT * FROM stg_sellers",
}
