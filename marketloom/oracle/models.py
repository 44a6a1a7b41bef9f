"""CTEs: source tables derived from the test tables, then every model."""

from __future__ import annotations

from marketloom.functions.buckets import BRAZIL_STATES
from marketloom.oracle.base import (
    AS_OF,
    avg,
    count_if,
    days,
    div,
    flag,
    isum,
    ladder,
    month,
    msum,
    pct,
    wavg,
)

_CODES = ", ".join(f"'{code}'" for code in BRAZIL_STATES)
_STATE = f"([{_CODES}])[{{k}} + 1]"
_ZIP = "lpad(CAST(1000+{k} AS VARCHAR), 5, '0')"
_CITY = "concat(lower(r_name), ' ', replace(lower(n_name), '_', '-'))"
_CENTS = "CAST(round(l_extendedprice*100) AS BIGINT)//100"
_TAX = "CAST(round(l_tax*100) AS BIGINT)"


def _shift(d: str, h: str) -> str:
    return f"(o_orderdate + (to_days(CAST({d} AS INT)) + to_hours(CAST({h} AS INT))))"


def _money(cents: str) -> str:
    return (
        f"CAST(CAST({cents} AS DECIMAL(12,0))*CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,2))"
    )


def _located(table: str, key: str) -> str:
    return (
        f"{table} JOIN nation n ON {key}=n.n_nationkey"
        " JOIN region r ON n.n_regionkey=r.r_regionkey"
    )


def _initcap(c: str) -> str:
    words = f"regexp_extract_all(lower({c}), '([\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}]+)')"
    caps = f"[concat(upper(w[1]), substr(w, 2)) FOR w IN {words}]"
    return f"array_to_string({caps}, '')"


def _sk(*cols: str) -> str:
    null = "'_dbt_utils_surrogate_key_null_'"
    parts = ", ".join(f"COALESCE(CAST({c} AS VARCHAR), {null})" for c in cols)
    return f"md5(concat_ws('-', {parts}))"


def _epoch(a: str, b: str, k: str) -> str:
    return f"CAST(epoch_us({a}) - epoch_us({b}) AS DOUBLE)/{k}"


_DONE = "o_orderstatus IN ('F','P')"
_TYPES = ["credit_card", "boleto", "voucher", "debit_card"]

CTES: dict[str, str] = {}

# ------------------------------------------------------------ source tables

CTES["raw_customers"] = f"""
SELECT CAST(c_custkey AS VARCHAR) AS customer_id, md5(c_name) AS customer_unique_id,
 {_ZIP.format(k="c_nationkey")} AS customer_zip_code_prefix, {_CITY} AS customer_city,
 {_STATE.format(k="c_nationkey")} AS customer_state
FROM {_located("customer c", "c.c_nationkey")}"""

CTES["raw_sellers"] = f"""
SELECT CAST(s_suppkey AS VARCHAR) AS seller_id,
 {_ZIP.format(k="s_nationkey")} AS seller_zip_code_prefix, {_CITY} AS seller_city,
 {_STATE.format(k="s_nationkey")} AS seller_state
FROM {_located("supplier s", "s.s_nationkey")}"""

CTES["raw_geolocation"] = f"""
SELECT {_ZIP.format(k="c_nationkey")} AS geolocation_zip_code_prefix,
 CAST(-33+(c_custkey%38) AS DOUBLE) AS geolocation_lat,
 CAST(-73+(c_custkey%37) AS DOUBLE) AS geolocation_lng,
 {_CITY} AS geolocation_city, {_STATE.format(k="c_nationkey")} AS geolocation_state
FROM {_located("customer c", "c.c_nationkey")}"""

CTES["raw_orders"] = f"""
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
 CASE WHEN {_DONE} THEN 'delivered' WHEN o_orderkey%7=0 THEN 'canceled'
  WHEN o_orderkey%7=1 THEN 'unavailable' WHEN o_orderkey%7=2 THEN 'invoiced'
  WHEN o_orderkey%7=3 THEN 'processing' WHEN o_orderkey%7=4 THEN 'created'
  WHEN o_orderkey%7=5 THEN 'approved' ELSE 'shipped' END AS order_status,
 {_shift("0", "o_orderkey%24")} AS order_purchase_timestamp,
 {_shift("0", "o_orderkey%24+1")} AS order_approved_at,
 CASE WHEN {_DONE} THEN {_shift("2", "o_orderkey%24")} END AS order_delivered_carrier_date,
 CASE WHEN {_DONE} AND o_orderkey%50<>0 THEN
  {_shift("3+o_orderkey%30", "o_orderkey%24+o_orderkey%17")} END
  AS order_delivered_customer_date,
 {_shift("24", "0")} AS order_estimated_delivery_date
FROM orders"""

CTES["raw_order_items"] = f"""
SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(rn AS INT) AS order_item_id,
 CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
 l_shipdate AS shipping_limit_date, {_money("cents")} AS price,
 {_money("cents*taxpct//100")} AS freight_value
FROM (SELECT *, {_CENTS} AS cents, {_TAX} AS taxpct,
 row_number() OVER (PARTITION BY l_orderkey
  ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice) AS rn
 FROM lineitem) x"""

CTES["raw_order_payments"] = f"""
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(seq AS INT) AS payment_sequential,
 CASE WHEN seq=2 OR o_orderpriority='4-NOT SPECIFIED' THEN 'voucher'
  WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN 'credit_card'
  WHEN o_orderpriority='3-MEDIUM' THEN 'boleto' ELSE 'debit_card' END AS payment_type,
 CAST(CASE WHEN seq=1 AND o_orderpriority IN ('1-URGENT','2-HIGH')
  THEN 1+o_orderkey%10 ELSE 1 END AS INT) AS payment_installments,
 {_money("CAST(CASE WHEN seq=2 THEN 500 WHEN o_orderkey%11=0 THEN tot-500"
         " WHEN o_orderkey%97=0 THEN tot+250 ELSE tot END AS BIGINT)")} AS payment_value
FROM (SELECT l_orderkey AS ok, SUM(cents + cents*taxpct//100) AS tot
 FROM (SELECT l_orderkey, {_CENTS} AS cents, {_TAX} AS taxpct FROM lineitem) y
 GROUP BY l_orderkey) t
JOIN orders o ON o.o_orderkey=t.ok
JOIN (SELECT 1 AS seq UNION ALL SELECT 2) k ON k.seq=1 OR o.o_orderkey%11=0"""

CTES["raw_order_reviews"] = f"""
SELECT md5(concat(CAST(o_orderkey AS VARCHAR),'-',CAST(dup AS VARCHAR))) AS review_id,
 CAST(o_orderkey AS VARCHAR) AS order_id,
 CAST(1+(o_orderkey*7+o_custkey+dup*3)%5 AS INT) AS review_score,
 CASE WHEN o_orderkey%4=0 THEN 'titulo' END AS review_comment_title,
 CASE WHEN o_orderkey%3=0 THEN concat('comentario ',CAST(o_orderkey AS VARCHAR))
  WHEN o_orderkey%3=1 THEN '  ' END AS review_comment_message,
 {_shift("35+dup", "0")} AS review_creation_date,
 {_shift("36+dup", "o_orderkey%72")} AS review_answer_timestamp
FROM orders o JOIN (SELECT 0 AS dup UNION ALL SELECT 1) k
 ON (k.dup=0 AND o.o_orderkey%10<>0) OR (k.dup=1 AND o.o_orderkey%40=1)"""

_CAT = "concat(lower(p_type),'_',lower(replace(p_brand,'#','_')))"
CTES["raw_products"] = f"""
SELECT CAST(p_partkey AS VARCHAR) AS product_id,
 CASE WHEN p_partkey%61<>0 THEN {_CAT} END AS product_category_name,
 CAST(length(p_name) AS INT) AS product_name_lenght,
 CAST(100+p_partkey%900 AS INT) AS product_description_lenght,
 CAST(1+p_size%6 AS INT) AS product_photos_qty,
 CASE WHEN p_partkey%53<>0 THEN CAST(p_size*250 AS DOUBLE) END AS product_weight_g,
 CAST(10+p_size AS DOUBLE) AS product_length_cm,
 CAST(2+p_size%40 AS DOUBLE) AS product_height_cm,
 CAST(8+p_partkey%45 AS DOUBLE) AS product_width_cm
FROM part"""

CTES["raw_product_categories"] = f"""
SELECT cat AS product_category_name, concat('en_',cat) AS product_category_name_english
FROM (SELECT DISTINCT {_CAT} AS cat FROM part WHERE p_type<>'PROMO') z"""

# ------------------------------------------------------------------ staging


def _party(table: str, p: str, extra: str) -> str:
    return f"""
SELECT *, {_sk("zip_code_prefix", "city_normalized", "state_normalized")} AS location_id
FROM (SELECT {extra}, {p}_zip_code_prefix AS zip_code_prefix, {p}_city AS city,
 {p}_state AS state, {_initcap(p + "_city")} AS city_normalized,
 upper({p}_state) AS state_normalized FROM {table})"""


CTES["stg_customers"] = _party(
    "raw_customers", "customer", "customer_id, customer_unique_id"
)
CTES["stg_sellers"] = _party("raw_sellers", "seller", "seller_id")
CTES["stg_geolocation"] = f"""
SELECT DISTINCT ON (zip_code_prefix) * FROM
(SELECT geolocation_zip_code_prefix AS zip_code_prefix, geolocation_lat AS latitude,
 geolocation_lng AS longitude, geolocation_city AS city, geolocation_state AS state,
 {_initcap("geolocation_city")} AS city_normalized,
 upper(geolocation_state) AS state_normalized FROM raw_geolocation)
ORDER BY zip_code_prefix, latitude, longitude, city, state"""
CTES["stg_orders"] = f"""
SELECT order_id, customer_id, order_status, order_purchase_timestamp AS purchased_at,
 order_approved_at AS approved_at, order_delivered_carrier_date AS shipped_at,
 order_delivered_customer_date AS delivered_at,
 order_estimated_delivery_date AS estimated_delivery_at,
 {_epoch("order_delivered_customer_date", "order_purchase_timestamp", "86400000000.0")}
  AS delivery_time_days,
 {_epoch("order_estimated_delivery_date", "order_delivered_customer_date",
         "86400000000.0")} AS delivery_variance_days,
 {flag("order_delivered_customer_date <= order_estimated_delivery_date")}
  AS is_delivered_on_time,
 order_delivered_customer_date IS NOT NULL AS is_delivered
FROM raw_orders"""
CTES["stg_order_items"] = f"""
SELECT {_sk("order_id", "order_item_id")} AS order_item_sk, order_id, order_item_id,
 product_id, seller_id, shipping_limit_date AS shipping_limit_at,
 price AS price_amount, freight_value AS shipping_amount,
 price + freight_value AS total_amount, {flag("price=0")} AS is_free_item,
 {flag("freight_value=0")} AS is_free_shipping
FROM raw_order_items"""
CTES["stg_order_payments"] = f"""
SELECT {_sk("order_id", "payment_sequential")} AS order_payment_sk, order_id,
 payment_sequential, payment_type, payment_installments, payment_value AS payment_amount,
 {flag("payment_installments>1")} AS is_installment_payment,
 {flag("payment_type='credit_card'")} AS is_credit_card,
 {flag("payment_type='debit_card'")} AS is_debit_card,
 {flag("payment_type='voucher'")} AS is_voucher,
 {flag("payment_type='boleto'")} AS is_boleto,
 {div("payment_value", "payment_installments", 6)} AS installment_amount
FROM raw_order_payments"""
CTES["stg_order_reviews"] = f"""
SELECT review_id, order_id, review_score, review_comment_title, review_comment_message,
 review_creation_date AS created_at, review_answer_timestamp AS answered_at,
 {flag("review_score>=4")} AS is_positive_review,
 {flag("review_score<=2")} AS is_negative_review,
 {flag("trim(review_comment_message)<>''")} AS has_review_comment,
 {_epoch("review_answer_timestamp", "review_creation_date", "3600000000.0")}
  AS response_time_hours
FROM raw_order_reviews"""
CTES["stg_product_categories"] = """
SELECT product_category_name AS category_id,
 product_category_name_english AS category_name_english,
 product_category_name AS category_name_portuguese FROM raw_product_categories"""
CTES["stg_products"] = """
SELECT product_id, product_category_name AS category_id, product_weight_g AS weight_g,
 product_length_cm AS length_cm, product_height_cm AS height_cm,
 product_width_cm AS width_cm, product_name_lenght AS name_length,
 product_description_lenght AS description_length, product_photos_qty AS photos_count,
 CAST(product_length_cm*product_height_cm*product_width_cm AS DECIMAL(18,2)) AS volume_cm3,
 (product_weight_g IS NULL OR product_length_cm IS NULL OR product_height_cm IS NULL
  OR product_width_cm IS NULL) AS is_missing_dimensions
FROM raw_products"""

# ------------------------------------------------------------- intermediate

CTES["int_order_sellers"] = f"""
SELECT order_id, seller_id, COUNT(*) AS item_rows, COUNT(order_item_id) AS items,
 COUNT(price_amount) AS priced, COUNT(shipping_amount) AS freighted,
 {isum("CAST(price_amount*100 AS BIGINT)")} AS price_cents,
 {isum("CAST(shipping_amount*100 AS BIGINT)")} AS shipping_cents,
 {isum("CAST(total_amount*100 AS BIGINT)")} AS gmv_cents, MIN(shipping_limit_at) AS first_limit,
 MAX(shipping_limit_at) AS last_limit
FROM stg_order_items GROUP BY order_id, seller_id"""
CTES["int_order_products"] = f"""
SELECT order_id, product_id, COUNT(*) AS item_rows, COUNT(price_amount) AS priced,
 COUNT(shipping_amount) AS freighted,
 {isum("CAST(price_amount*100 AS BIGINT)")} AS price_cents,
 CAST(SUM(CAST(price_amount AS DECIMAL(18,2))*price_amount) AS DECIMAL(34,4)) AS price_sq,
 {isum("CAST(shipping_amount*100 AS BIGINT)")} AS shipping_cents,
 {isum("CAST(total_amount*100 AS BIGINT)")} AS gmv_cents,
 MIN(price_amount) AS min_price, MAX(price_amount) AS max_price,
 {isum("order_item_id")} AS item_numbers
FROM stg_order_items GROUP BY order_id, product_id"""
CTES["int_order_items_agg"] = f"""
SELECT order_id, COUNT(DISTINCT order_item_id) AS item_count,
 COUNT(DISTINCT product_id) AS unique_products,
 COUNT(DISTINCT seller_id) AS unique_sellers, {msum("price_amount")} AS products_amount,
 {msum("shipping_amount")} AS shipping_amount, {msum("total_amount")} AS total_amount,
 MIN(shipping_limit_at) AS first_shipping_limit_date,
 MAX(shipping_limit_at) AS last_shipping_limit_date,
 list_sort(array_agg(DISTINCT seller_id)) AS seller_ids
FROM stg_order_items GROUP BY order_id"""
CTES["int_order_financials"] = f"""
SELECT order_id, {msum("payment_amount")} AS payment_total,
 {", ".join(msum(f"CASE WHEN payment_type='{t}' THEN payment_amount ELSE 0 END")
            + f" AS {t}_amount" for t in _TYPES)},
 COUNT(DISTINCT order_payment_sk) AS payment_count,
 COUNT(DISTINCT payment_sequential) AS payment_installments,
 {", ".join(f"MAX(CASE WHEN payment_type='{t}' THEN 1 ELSE 0 END)=1 AS used_{t}"
            for t in _TYPES)},
 COUNT(DISTINCT payment_type) AS payment_methods_count,
 list_sort(array_agg(DISTINCT payment_type)) AS payment_methods,
 MAX(payment_installments) AS max_installments
FROM stg_order_payments GROUP BY order_id"""
CTES["int_order_reviews_agg"] = """
SELECT order_id, MAX(review_score) AS review_score,
 MAX(review_comment_message) IS NOT NULL AS has_review_comment,
 MAX(CASE WHEN review_score>=4 THEN 1 ELSE 0 END)=1 AS is_positive_review,
 MAX(CASE WHEN review_score<=2 THEN 1 ELSE 0 END)=1 AS is_negative_review,
 MAX(created_at) AS review_creation_date, MAX(answered_at) AS review_answer_timestamp
FROM stg_order_reviews GROUP BY order_id"""
_OK = "o.order_status='delivered' AND o.delivered_at IS NOT NULL"
_STATUS = ["canceled", "shipped", "unavailable", "invoiced", "processing", "created",
           "approved"]
CTES["int_orders_with_items"] = f"""
SELECT o.order_id, o.customer_id, o.purchased_at, o.approved_at, o.estimated_delivery_at,
 o.delivered_at AS delivery_date, o.shipped_at AS last_updated_status_at,
 CASE WHEN {_OK} THEN CAST(epoch(o.delivered_at) - epoch(o.purchased_at) AS BIGINT) END
  AS actual_delivery_time,
 CASE WHEN {_OK} THEN CAST(epoch(o.delivered_at) - epoch(o.estimated_delivery_at)
  AS BIGINT) END AS delivery_variance,
 CASE WHEN {_OK} THEN {days("o.delivered_at", "o.purchased_at")} END AS delivery_time_days,
 CASE WHEN {_OK} THEN {days("o.delivered_at", "o.estimated_delivery_at")} END
  AS delivery_variance_days,
 i.item_count, i.unique_products, i.unique_sellers, i.products_amount, i.shipping_amount,
 i.total_amount, i.first_shipping_limit_date, i.last_shipping_limit_date, p.payment_total,
 {", ".join(f"p.{t}_amount" for t in _TYPES)}, p.payment_count, p.payment_installments,
 {", ".join(f"p.used_{t}" for t in _TYPES)}, p.payment_methods_count, r.review_score,
 r.has_review_comment, r.is_positive_review, r.is_negative_review,
 r.review_creation_date, r.review_answer_timestamp, o.order_status, o.is_delivered,
 {", ".join(f"o.order_status='{s}' AS is_{s}" for s in _STATUS)}, o.is_delivered_on_time,
 i.item_count AS number_of_items, i.unique_sellers AS number_of_sellers, i.seller_ids,
 p.payment_methods, i.products_amount AS total_items_amount,
 i.shipping_amount AS total_shipping_amount, i.total_amount AS total_order_amount,
 p.payment_total AS total_payment_amount, p.max_installments,
 abs(p.payment_total - i.total_amount) > 1 AS has_payment_discrepancy
FROM stg_orders o LEFT JOIN int_order_items_agg i ON o.order_id=i.order_id
LEFT JOIN int_order_financials p ON o.order_id=p.order_id
LEFT JOIN int_order_reviews_agg r ON o.order_id=r.order_id"""
CTES["int_customer_payments"] = """
SELECT o.customer_id, list_sort(array_agg(DISTINCT pm)) AS all_payment_methods_used
FROM (SELECT customer_id, unnest(payment_methods) AS pm FROM int_orders_with_items) o
GROUP BY o.customer_id"""
CTES["customer_sellers"] = """
SELECT customer_id, COUNT(DISTINCT s) AS unique_sellers_bought_from
FROM (SELECT customer_id, unnest(seller_ids) AS s FROM int_orders_with_items)
GROUP BY customer_id"""
CTES["customer_base"] = f"""
SELECT c.customer_id, c.zip_code_prefix, c.city_normalized, c.state_normalized,
 COUNT(DISTINCT o.order_id) AS total_orders,
 {isum("CASE WHEN o.order_status='delivered' THEN 1 ELSE 0 END")} AS delivered_orders,
 {isum("CASE WHEN o.order_status='canceled' THEN 1 ELSE 0 END")} AS canceled_orders,
 {isum("o.number_of_items")} AS total_items_purchased,
 {msum("o.total_items_amount")} AS total_items_amount,
 {msum("o.total_shipping_amount")} AS total_shipping_amount,
 {msum("o.total_order_amount")} AS total_spent,
 {avg("o.total_order_amount")} AS avg_order_amount,
 MAX(o.total_order_amount) AS max_order_amount,
 {avg("o.max_installments", 0)} AS avg_installments_used,
 {isum("CASE WHEN o.has_payment_discrepancy THEN 1 ELSE 0 END")}
  AS orders_with_payment_issues,
 {avg("o.review_score", 0)} AS avg_review_score,
 {count_if("o.is_positive_review")} AS positive_reviews,
 {count_if("o.is_negative_review")} AS negative_reviews,
 {count_if("o.has_review_comment")} AS reviews_with_comments,
 {avg("o.delivery_time_days", 0)} AS avg_delivery_time_days,
 {isum("CASE WHEN o.is_delivered_on_time THEN 1 ELSE 0 END")} AS on_time_deliveries,
 {isum("CASE WHEN NOT o.is_delivered_on_time THEN 1 ELSE 0 END")} AS late_deliveries,
 MIN(o.purchased_at) AS first_order_at, MAX(o.purchased_at) AS last_order_at,
 COUNT(DISTINCT date_trunc('month', o.purchased_at)) AS active_months,
 date_part('day', MAX(o.purchased_at) - MIN(o.purchased_at)) AS customer_lifetime_days
FROM stg_customers c LEFT JOIN int_orders_with_items o ON c.customer_id=o.customer_id
GROUP BY 1,2,3,4"""
CTES["int_customer_orders"] = f"""
SELECT b.*, cp.all_payment_methods_used,
 COALESCE(cs.unique_sellers_bought_from, 0) AS unique_sellers_bought_from,
 {div("total_orders", "active_months", 2, 0)} AS orders_per_month,
 {div("total_spent", "total_orders")} AS avg_monthly_spend,
 {pct("positive_reviews", "total_orders")} AS positive_review_rate,
 {pct("on_time_deliveries", "delivered_orders")} AS on_time_delivery_rate,
 {pct("canceled_orders", "total_orders")} AS order_cancellation_rate,
 {div("total_spent", "customer_lifetime_days")} AS spend_per_day,
 {div("total_spent", "active_months")} AS spend_per_month,
 {ladder("total_orders", [(5, "high_frequency"), (2, "medium_frequency")],
         "low_frequency")} AS frequency_segment,
 {ladder("avg_order_amount", [(500, "high_value"), (100, "medium_value")], "low_value")}
  AS value_segment,
 {ladder("avg_review_score", [(4, "promoter"), (3, "passive")], "detractor")} AS nps_segment
FROM customer_base b LEFT JOIN int_customer_payments cp ON b.customer_id=cp.customer_id
LEFT JOIN customer_sellers cs ON b.customer_id=cs.customer_id"""
_RATING = [("4.5", "excellent"), ("4.0", "good"), ("3.0", "average")]
_PROD_KEYS = (
    "p.product_id, p.category_id, c.category_name_english, c.category_name_portuguese,"
    " p.name_length, p.description_length, p.photos_count, p.weight_g, p.length_cm,"
    " p.height_cm, p.width_cm, p.volume_cm3, p.is_missing_dimensions"
)
_X = "CAST(oi.price_amount*100 AS HUGEINT)"
CTES["product_base"] = f"""
SELECT {_PROD_KEYS}, COUNT(DISTINCT oi.order_id) AS total_orders,
 COUNT(DISTINCT o.customer_id) AS unique_customers,
 COUNT(DISTINCT oi.seller_id) AS unique_sellers, {msum("oi.price_amount")} AS total_revenue,
 {msum("oi.shipping_amount")} AS total_shipping_revenue,
 {msum("oi.total_amount")} AS total_gmv, MIN(oi.price_amount) AS min_price,
 MAX(oi.price_amount) AS max_price,
 CASE WHEN COUNT(oi.price_amount)>1 THEN CAST(sqrt(CAST(COUNT({_X})*SUM({_X}*{_X})
  - SUM({_X})*SUM({_X}) AS DOUBLE)/10000
  /(CAST(COUNT({_X}) AS DOUBLE)*(CAST(COUNT({_X}) AS DOUBLE)-1))) AS DECIMAL(18,6)) END
  AS price_variance,
 {avg("oi.price_amount")} AS avg_price, {avg("oi.shipping_amount")} AS avg_shipping_fee,
 {avg("o.review_score", 0)} AS avg_review_score,
 {count_if("o.is_positive_review")} AS positive_reviews,
 {count_if("o.is_negative_review")} AS negative_reviews,
 {count_if("o.has_review_comment")} AS reviews_with_comments,
 COUNT(o.review_score) AS review_count,
 {avg("o.delivery_time_days", 0)} AS avg_delivery_time_days,
 {avg("o.delivery_variance_days", 0)} AS avg_delivery_variance_days,
 {isum("CASE WHEN o.is_delivered_on_time THEN 1 ELSE 0 END")} AS on_time_deliveries,
 {isum("CASE WHEN NOT o.is_delivered_on_time THEN 1 ELSE 0 END")} AS late_deliveries,
 MIN(o.purchased_at) AS first_ordered_at, MAX(o.purchased_at) AS last_ordered_at,
 COUNT(DISTINCT date_trunc('month', o.purchased_at)) AS active_months,
 date_part('day', {AS_OF} - MIN(o.purchased_at)) AS days_since_first_order,
 date_part('day', {AS_OF} - MAX(o.purchased_at)) AS days_since_last_order,
 date_part('day', MAX(o.purchased_at) - MIN(o.purchased_at)) AS product_lifetime_days,
 {isum("oi.order_item_id")} AS total_items_sold
FROM stg_products p LEFT JOIN stg_product_categories c ON p.category_id=c.category_id
LEFT JOIN stg_order_items oi ON p.product_id=oi.product_id
LEFT JOIN int_orders_with_items o ON oi.order_id=o.order_id
GROUP BY {_PROD_KEYS}"""
CTES["int_product_performance"] = f"""
SELECT *, {div("total_orders", "active_months", 2, 0)} AS orders_per_month,
 {div("total_gmv", "active_months")} AS gmv_per_month,
 {pct("positive_reviews", "total_orders")} AS positive_review_rate,
 {pct("on_time_deliveries", "total_orders")} AS on_time_delivery_rate,
 {pct("review_count", "total_orders")} AS review_rate, total_gmv AS gmv,
 {ladder("total_orders", [(50, "high_volume"), (10, "medium_volume")], "low_volume")}
  AS volume_segment,
 {ladder("avg_price", [(500, "premium"), (100, "mid_range")], "budget")} AS price_segment,
 {ladder("avg_review_score", _RATING, "poor")} AS rating_segment,
 {ladder("weight_g", [(10000, "heavy"), (2000, "medium")], "light")} AS weight_segment,
 {ladder("volume_cm3", [(50000, "large"), (10000, "medium")], "small")} AS size_segment
FROM product_base"""
CTES["seller_base"] = f"""
SELECT s.seller_id, s.zip_code_prefix, s.city_normalized, s.state_normalized,
 COUNT(DISTINCT o.order_id) AS total_orders,
 {isum("CASE WHEN o.order_status='delivered' THEN 1 ELSE 0 END")} AS delivered_orders,
 {isum("CASE WHEN o.order_status='canceled' THEN 1 ELSE 0 END")} AS canceled_orders,
 COUNT(DISTINCT o.customer_id) AS unique_customers, {msum("oi.price_amount")} AS total_gmv,
 {avg("oi.price_amount")} AS avg_order_item_value,
 {msum("oi.shipping_amount")} AS total_shipping_collected,
 {avg("o.review_score", 0)} AS avg_review_score,
 {count_if("o.is_positive_review")} AS positive_reviews,
 {count_if("o.is_negative_review")} AS negative_reviews,
 {avg("o.delivery_time_days", 0)} AS avg_delivery_time_days,
 {isum("CASE WHEN o.is_delivered_on_time THEN 1 ELSE 0 END")} AS on_time_deliveries,
 {isum("CASE WHEN NOT o.is_delivered_on_time THEN 1 ELSE 0 END")} AS late_deliveries,
 MIN(o.purchased_at) AS first_order_at, MAX(o.purchased_at) AS last_order_at,
 COUNT(DISTINCT date_trunc('month', o.purchased_at)) AS active_months,
 date_part('day', MAX(o.purchased_at) - MIN(o.purchased_at)) AS seller_lifetime_days
FROM stg_sellers s LEFT JOIN stg_order_items oi ON s.seller_id=oi.seller_id
LEFT JOIN int_orders_with_items o ON oi.order_id=o.order_id GROUP BY 1,2,3,4"""
CTES["seller_rated"] = f"""
SELECT *, {div("total_orders", "active_months", 2, 0)} AS orders_per_month,
 {div("total_gmv", "active_months")} AS gmv_per_month,
 {div("total_gmv", "total_orders")} AS avg_order_value,
 {pct("positive_reviews", "total_orders")} AS positive_review_rate,
 {pct("on_time_deliveries", "total_orders")} AS on_time_delivery_rate,
 {div("unique_customers", "total_orders", 2, 0)} AS customer_reorder_rate FROM seller_base"""
CTES["int_seller_performance"] = f"""
SELECT *,
 {ladder("total_orders", [(100, "high_volume"), (20, "medium_volume")], "low_volume")}
  AS volume_segment,
 {ladder("total_gmv", [(50000, "high_value"), (10000, "medium_value")], "low_value")}
  AS value_segment,
 {ladder("avg_review_score", _RATING, "poor")} AS performance_segment,
 {ladder("on_time_delivery_rate", [(95, "excellent"), (85, "good"), (70, "average")],
         "poor")} AS delivery_segment FROM seller_rated"""

# --------------------------------------------------------- dashboard marts

_REL = "CAST({c} AS DOUBLE)/(CAST(SUM({c}) OVER () AS DOUBLE)/COUNT({c}) OVER ())"
CTES["mart_customer_analytics"] = f"""
SELECT customer_id, frequency_segment, value_segment, nps_segment,
 CASE WHEN frequency_segment='high_frequency' AND value_segment='high_value' THEN 'VIP'
  WHEN frequency_segment='high_frequency' AND value_segment='medium_value' THEN 'Loyal'
  WHEN frequency_segment='medium_frequency'
   AND value_segment IN ('high_value','medium_value') THEN 'Growing'
  WHEN frequency_segment='low_frequency' AND value_segment='high_value' THEN 'Big Spender'
  ELSE 'Standard' END AS customer_tier,
 total_orders, total_spent, avg_order_amount AS avg_order_value, avg_review_score,
 first_order_at AS first_order_date, last_order_at AS last_order_date,
 customer_lifetime_days, spend_per_day AS daily_customer_value,
 unique_sellers_bought_from, total_items_purchased, positive_review_rate,
 on_time_delivery_rate,
 CASE WHEN nps_segment='promoter' THEN 1 ELSE 0 END AS is_promoter,
 CASE WHEN last_order_at >= {AS_OF} - INTERVAL 3 MONTH THEN 1 ELSE 0 END AS is_active,
 {_REL.format(c="total_spent")} AS relative_customer_value,
 {_REL.format(c="avg_order_amount")} AS relative_order_value,
 percent_rank() OVER (ORDER BY total_spent ASC NULLS LAST) AS spend_percentile,
 percent_rank() OVER (ORDER BY total_orders ASC NULLS LAST) AS frequency_percentile,
 percent_rank() OVER (ORDER BY avg_review_score ASC NULLS LAST) AS satisfaction_percentile,
 {AS_OF} AS generated_at
FROM int_customer_orders"""


def _down(c: str) -> str:
    return f"percent_rank() OVER (ORDER BY {c} DESC NULLS FIRST)"


def _up(c: str) -> str:
    return (
        f"CASE WHEN {c} IS NOT NULL THEN"
        f" percent_rank() OVER (PARTITION BY {c} IS NULL ORDER BY {c} ASC) END"
    )


_TOP = [("0.9", "top 10%"), ("0.7", "top 30%"), ("0.5", "top 50%")]
_SELLER_RANKS = {
    "gmv": "total_gmv",
    "review": "avg_review_score",
    "delivery": "on_time_delivery_rate",
    "volume": "total_orders",
}


def _fixed(c: str, steps, otherwise: str) -> str:
    return f"CASE WHEN {c} IS NOT NULL THEN {ladder(c, steps, otherwise)} END"


CTES["seller_ranked"] = f"""
SELECT *, {", ".join(f"{_down(c)} AS {k}_d, {_up(c)} AS {k}_u"
                     for k, c in _SELLER_RANKS.items())} FROM int_seller_performance"""
CTES["mart_seller_analytics"] = f"""
SELECT seller_id, zip_code_prefix, city_normalized, state_normalized, total_orders,
 total_gmv, unique_customers, avg_review_score, on_time_delivery_rate,
 avg_delivery_time_days, customer_reorder_rate, first_order_at, last_order_at,
 seller_lifetime_days, active_months, orders_per_month, gmv_per_month, avg_order_value,
 positive_reviews, negative_reviews, positive_review_rate, volume_segment, value_segment,
 performance_segment, delivery_segment,
 {", ".join(ladder(f"{k}_d", _TOP, "bottom 50%") + f" AS {k}_ranking"
            for k in _SELLER_RANKS)},
 (gmv_d + review_d + delivery_d + volume_d)/4 AS overall_seller_score,
 {", ".join(_fixed(f"{k}_u", _TOP, "bottom 50%") + f" AS {k}_ranking_corrected"
            for k in _SELLER_RANKS)},
 {AS_OF} AS generated_at FROM seller_ranked"""
_PRICE = [("0.9", "premium"), ("0.7", "high"), ("0.3", "medium")]
_STARS = [("0.9", "excellent"), ("0.7", "good"), ("0.4", "average")]
CTES["product_ranked"] = f"""
SELECT *, {_down("total_orders")} AS vol_d, {_down("avg_price")} AS price_d,
 {_down("avg_review_score")} AS rev_d, {_up("total_orders")} AS vol_u,
 {_up("avg_price")} AS price_u, {_up("avg_review_score")} AS rev_u
FROM int_product_performance"""
CTES["mart_product_analytics"] = f"""
SELECT product_id, category_name_english AS category_name, category_id, weight_g,
 length_cm, height_cm, width_cm, volume_cm3, is_missing_dimensions, total_orders, gmv,
 avg_price, min_price, max_price, price_variance, first_ordered_at, last_ordered_at,
 days_since_first_order, days_since_last_order, active_months, review_count,
 avg_review_score, positive_reviews, negative_reviews, review_rate,
 {ladder("vol_d", _TOP, "bottom 50%")} AS volume_ranking,
 {ladder("price_d", _PRICE, "low")} AS price_tier,
 {ladder("rev_d", _STARS, "poor")} AS rating_tier,
 (vol_d + rev_d)/2 AS overall_product_score,
 {_fixed("vol_u", _TOP, "bottom 50%")} AS volume_ranking_corrected,
 {_fixed("price_u", _PRICE, "low")} AS price_tier_corrected,
 {_fixed("rev_u", _STARS, "poor")} AS rating_tier_corrected,
 {AS_OF} AS generated_at FROM product_ranked"""

# ------------------------------------------------------------ entity marts

CTES["mart_orders"] = "SELECT * FROM int_orders_with_items"
CTES["mart_products"] = "SELECT * FROM int_product_performance"


def _recency(col: str, year: bool = True) -> str:
    d = days(AS_OF, col)
    out = (
        f"WHEN {d}<=30 THEN 'active_30d' WHEN {d}<=90 THEN 'active_90d'"
        f" WHEN {d}<=180 THEN 'active_180d'"
    )
    if year:
        out += f" WHEN {d}<=365 THEN 'active_365d'"
    return out + " ELSE 'inactive' END"


def _zero(prefix: str, names: str) -> str:
    return ", ".join(f"COALESCE({prefix}.{c}, 0) AS {c}" for c in names.split())


CTES["customer_sums"] = f"""
SELECT o.customer_id, COUNT(DISTINCT o.order_id) AS total_orders,
 {count_if("o.is_delivered")} AS delivered_orders,
 {count_if("o.is_canceled")} AS canceled_orders,
 {count_if("o.is_delivered_on_time")} AS on_time_deliveries,
 {count_if("NOT o.is_delivered_on_time AND o.is_delivered")} AS late_deliveries,
 {msum("o.total_amount")} AS lifetime_value,
 {msum("o.products_amount")} AS total_products_amount,
 {msum("o.shipping_amount")} AS total_shipping_amount,
 {msum("o.payment_total")} AS total_payment_amount,
 {avg("o.total_amount")} AS average_order_value,
 {avg("o.item_count", 0)} AS average_items_per_order,
 {isum("o.item_count")} AS total_items_purchased,
 {isum("o.unique_products")} AS total_unique_products,
 {isum("o.unique_sellers")} AS total_unique_sellers,
 {avg("o.shipping_amount")} AS average_shipping_amount,
 {", ".join(f"COUNT(DISTINCT CASE WHEN o.used_{t} THEN o.order_id END) AS {t}_orders"
            for t in _TYPES)},
 {avg("o.review_score", 0)} AS average_review_score,
 COUNT(DISTINCT CASE WHEN o.review_score IS NOT NULL THEN o.order_id END)
  AS orders_with_reviews,
 COUNT(DISTINCT CASE WHEN o.is_positive_review THEN o.order_id END) AS positive_reviews,
 COUNT(DISTINCT CASE WHEN o.is_negative_review THEN o.order_id END) AS negative_reviews,
 COUNT(DISTINCT CASE WHEN o.has_review_comment THEN o.order_id END)
  AS reviews_with_comments,
 MIN(o.purchased_at) AS first_order_date, MAX(o.purchased_at) AS last_order_date,
 {avg("o.delivery_time_days", 0)} AS average_delivery_time_days,
 {avg("o.delivery_variance_days", 0)} AS average_delivery_variance_days,
 COUNT(DISTINCT date_trunc('month', o.purchased_at)) AS active_months
FROM int_orders_with_items o GROUP BY 1"""
CTES["mart_customers"] = f"""
SELECT c.customer_id, c.customer_unique_id, c.city AS customer_city,
 c.state AS customer_state, g.latitude AS geolocation_lat, g.longitude AS geolocation_lng,
 {_zero("o", "total_orders delivered_orders canceled_orders on_time_deliveries"
        " late_deliveries lifetime_value total_products_amount total_shipping_amount"
        " total_payment_amount average_order_value average_items_per_order"
        " total_items_purchased total_unique_products total_unique_sellers"
        " average_shipping_amount credit_card_orders boleto_orders voucher_orders"
        " debit_card_orders")},
 o.average_review_score,
 {_zero("o", "orders_with_reviews positive_reviews negative_reviews"
        " reviews_with_comments")},
 o.first_order_date, o.last_order_date,
 {_zero("o", "average_delivery_time_days average_delivery_variance_days")},
 {days(AS_OF, "o.first_order_date")} AS days_since_first_order,
 {days(AS_OF, "o.last_order_date")} AS days_since_last_order,
 {_zero("o", "active_months")}, {flag("o.total_orders > 1")} AS is_repeat_customer,
 CASE WHEN o.last_order_date IS NULL THEN 'no_orders' {_recency("o.last_order_date")}
  AS recency_segment,
 {ladder("o.total_orders", [(4, "high"), (2, "medium")], "low")} AS frequency_segment,
 {ladder("o.lifetime_value", [(500, "high"), (100, "medium")], "low")} AS monetary_segment,
 {ladder("o.average_review_score", [("4.5", "promoter"), ("3.0", "passive")], "detractor",
         "unknown")} AS nps_segment
FROM stg_customers c LEFT JOIN customer_sums o ON c.customer_id=o.customer_id
LEFT JOIN stg_geolocation g ON c.zip_code_prefix=g.zip_code_prefix"""
_TOOK = "(epoch_us(o.delivered_at)-epoch_us(o.purchased_at))"
_EARLY = "(epoch_us(o.estimated_delivery_at)-epoch_us(o.delivered_at))"
CTES["seller_sums"] = f"""
SELECT oi.seller_id, COUNT(DISTINCT oi.order_id) AS total_orders,
 {count_if("o.is_delivered")} AS delivered_orders,
 {count_if("o.order_status='canceled'")} AS canceled_orders,
 {count_if("o.is_delivered_on_time")} AS on_time_deliveries,
 {count_if("NOT o.is_delivered_on_time AND o.is_delivered")} AS late_deliveries,
 COUNT(DISTINCT oi.product_id) AS unique_products_sold,
 COUNT(oi.order_item_id) AS total_items_sold, {msum("oi.price_amount")} AS total_revenue,
 {msum("oi.shipping_amount")} AS total_shipping_revenue,
 {msum("oi.total_amount")} AS total_gmv, {avg("oi.price_amount")} AS average_item_price,
 {avg("oi.shipping_amount")} AS average_shipping_fee,
 COUNT(DISTINCT o.customer_id) AS unique_customers,
 {avg("r.review_score", 0)} AS average_review_score,
 COUNT(DISTINCT CASE WHEN r.review_score IS NOT NULL THEN o.order_id END)
  AS orders_with_reviews,
 COUNT(DISTINCT CASE WHEN r.is_positive_review THEN o.order_id END) AS positive_reviews,
 COUNT(DISTINCT CASE WHEN r.is_negative_review THEN o.order_id END) AS negative_reviews,
 COUNT(DISTINCT CASE WHEN r.has_review_comment THEN o.order_id END)
  AS reviews_with_comments,
 MIN(o.purchased_at) AS first_order_date, MAX(o.purchased_at) AS last_order_date,
 {wavg("1", _TOOK, 6, 86400000000)} AS average_delivery_time_days,
 {wavg("1", _EARLY, 6, 86400000000)} AS average_delivery_variance_days,
 COUNT(DISTINCT date_trunc('month', o.purchased_at)) AS active_months
FROM stg_order_items oi JOIN stg_orders o ON oi.order_id=o.order_id
LEFT JOIN int_orders_with_items r ON oi.order_id=r.order_id GROUP BY 1"""
CTES["mart_sellers"] = f"""
SELECT s.seller_id, s.city AS seller_city, s.state AS seller_state,
 g.latitude AS geolocation_lat, g.longitude AS geolocation_lng,
 {_zero("o", "total_orders delivered_orders canceled_orders on_time_deliveries"
        " late_deliveries unique_products_sold total_items_sold total_revenue"
        " total_shipping_revenue total_gmv average_item_price average_shipping_fee"
        " unique_customers")},
 o.average_review_score,
 {_zero("o", "orders_with_reviews positive_reviews negative_reviews"
        " reviews_with_comments")},
 o.first_order_date, o.last_order_date,
 {_zero("o", "average_delivery_time_days average_delivery_variance_days")},
 {days(AS_OF, "o.first_order_date")} AS days_since_first_order,
 {days(AS_OF, "o.last_order_date")} AS days_since_last_order,
 {_zero("o", "active_months")},
 CASE WHEN o.last_order_date IS NULL THEN 'no_orders' {_recency("o.last_order_date")}
  AS recency_segment,
 {ladder("o.total_orders", [(50, "high_volume"), (10, "medium_volume")], "low_volume")}
  AS volume_segment,
 {ladder("o.total_gmv", [(10000, "high_value"), (1000, "medium_value")], "low_value")}
  AS value_segment,
 {ladder("o.average_review_score", _RATING, "poor", "unknown")} AS rating_segment,
 CASE WHEN o.on_time_deliveries>0 AND o.total_orders>0
  THEN {pct("o.on_time_deliveries", "o.delivered_orders")} ELSE 0 END
  AS on_time_delivery_rate,
 CASE WHEN o.positive_reviews>0 AND o.orders_with_reviews>0
  THEN {pct("o.positive_reviews", "o.orders_with_reviews")} ELSE 0 END
  AS positive_review_rate
FROM stg_sellers s LEFT JOIN seller_sums o ON s.seller_id=o.seller_id
LEFT JOIN stg_geolocation g ON s.zip_code_prefix=g.zip_code_prefix"""
CTES["category_sums"] = f"""
SELECT category_name_english AS category_name,
 COUNT(DISTINCT product_id) AS total_products, {msum("total_revenue")} AS total_revenue,
 {msum("total_shipping_revenue")} AS total_shipping_revenue,
 {msum("total_gmv")} AS total_gmv, {avg("avg_review_score", 6)} AS average_review_score,
 {count_if("avg_review_score >= 4")} AS highly_rated_products,
 {isum("review_count")} AS total_reviews, MIN(first_ordered_at) AS first_ordered_at,
 MAX(last_ordered_at) AS last_ordered_at
FROM int_product_performance GROUP BY 1"""
CTES["category_orders"] = """
SELECT p.category_name_english AS category_name, COUNT(DISTINCT o.order_id) AS total_orders,
 COUNT(DISTINCT o.customer_id) AS unique_customers
FROM int_product_performance p JOIN stg_order_items oi ON p.product_id=oi.product_id
JOIN stg_orders o ON oi.order_id=o.order_id GROUP BY 1"""
CTES["mart_product_categories"] = f"""
SELECT s.category_name, s.total_products, {_zero("o", "total_orders unique_customers")},
 s.total_revenue, s.total_shipping_revenue, s.total_gmv, s.average_review_score,
 s.highly_rated_products, s.total_reviews, s.first_ordered_at, s.last_ordered_at,
 {div("s.total_revenue", "s.total_products", 6)} AS revenue_per_product,
 COALESCE(o.total_orders, 0)//s.total_products AS orders_per_product,
 CASE WHEN s.total_products>100 THEN 'large' WHEN s.total_products>20 THEN 'medium'
  ELSE 'small' END AS category_size,
 CASE WHEN s.total_revenue>100000 THEN 'high_revenue'
  WHEN s.total_revenue>10000 THEN 'medium_revenue' ELSE 'low_revenue' END
  AS revenue_segment,
 CASE WHEN o.total_orders>1000 THEN 'high_volume' WHEN o.total_orders>100
  THEN 'medium_volume' ELSE 'low_volume' END AS volume_segment,
 {ladder("s.average_review_score", _RATING, "poor", "unknown")} AS rating_segment,
 {days(AS_OF, "s.last_ordered_at")} AS days_since_last_order,
 CASE {_recency("s.last_ordered_at", False)} AS recency_segment
FROM category_sums s
LEFT JOIN category_orders o ON s.category_name IS NOT DISTINCT FROM o.category_name"""
CTES["seller_order_history"] = """
SELECT s.seller_id, s.order_id, o.customer_id, o.purchased_at AS order_date,
 CAST(s.price_cents*CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS order_value
FROM int_order_sellers s JOIN stg_orders o ON s.order_id=o.order_id"""
CTES["seller_category_history"] = f"""
SELECT s.seller_id, s.product_id, s.category_revenue, p.category_name_english AS category
FROM (SELECT seller_id, product_id, {msum("price_amount")} AS category_revenue
 FROM stg_order_items GROUP BY 1,2) s
LEFT JOIN int_product_performance p ON s.product_id=p.product_id"""

# ---------------------------------------------- columns to show as DOUBLE

_PROD_DEC = (
    "total_revenue total_shipping_revenue total_gmv min_price max_price price_variance"
    " avg_price avg_shipping_fee avg_review_score avg_delivery_time_days"
    " avg_delivery_variance_days volume_cm3 orders_per_month gmv_per_month"
    " positive_review_rate on_time_delivery_rate review_rate gmv"
)
_ORD_DEC = (
    "products_amount shipping_amount total_amount payment_total credit_card_amount"
    " boleto_amount voucher_amount debit_card_amount total_items_amount"
    " total_shipping_amount total_order_amount total_payment_amount"
)
DECIMALS = {
    "stg_order_items": "price_amount shipping_amount total_amount",
    "stg_order_payments": "payment_amount installment_amount",
    "stg_products": "volume_cm3",
    "raw_order_items": "price freight_value",
    "raw_order_payments": "payment_value",
    "int_order_products": "price_sq min_price max_price",
    "int_order_items_agg": "products_amount shipping_amount total_amount",
    "int_order_financials": "payment_total credit_card_amount boleto_amount"
    " voucher_amount debit_card_amount",
    "int_orders_with_items": _ORD_DEC,
    "mart_orders": _ORD_DEC,
    "int_customer_orders": "total_items_amount total_shipping_amount total_spent"
    " avg_order_amount max_order_amount avg_installments_used avg_review_score"
    " avg_delivery_time_days orders_per_month avg_monthly_spend positive_review_rate"
    " on_time_delivery_rate order_cancellation_rate spend_per_day spend_per_month",
    "int_product_performance": _PROD_DEC,
    "mart_products": _PROD_DEC,
    "int_seller_performance": "total_gmv avg_order_item_value total_shipping_collected"
    " avg_review_score avg_delivery_time_days orders_per_month gmv_per_month"
    " avg_order_value positive_review_rate on_time_delivery_rate customer_reorder_rate",
    "mart_customer_analytics": "total_spent avg_order_value avg_review_score"
    " daily_customer_value positive_review_rate on_time_delivery_rate",
    "mart_seller_analytics": "total_gmv avg_review_score on_time_delivery_rate"
    " avg_delivery_time_days customer_reorder_rate orders_per_month gmv_per_month"
    " avg_order_value positive_review_rate",
    "mart_product_analytics": "volume_cm3 gmv avg_price min_price max_price"
    " price_variance avg_review_score review_rate",
    "mart_customers": "lifetime_value total_products_amount total_shipping_amount"
    " total_payment_amount average_order_value average_items_per_order"
    " average_shipping_amount average_review_score average_delivery_time_days"
    " average_delivery_variance_days",
    "mart_sellers": "total_revenue total_shipping_revenue total_gmv average_item_price"
    " average_shipping_fee average_review_score average_delivery_time_days"
    " average_delivery_variance_days on_time_delivery_rate positive_review_rate",
    "mart_product_categories": "total_revenue total_shipping_revenue total_gmv"
    " average_review_score revenue_per_product",
    "seller_order_history": "order_value",
    "seller_category_history": "category_revenue",
}
LISTS = {
    "int_order_items_agg": ["seller_ids"],
    "int_orders_with_items": ["seller_ids", "payment_methods"],
    "mart_orders": ["seller_ids", "payment_methods"],
    "int_order_financials": ["payment_methods"],
    "int_customer_payments": ["all_payment_methods_used"],
    "int_customer_orders": ["all_payment_methods_used"],
}


def shown(name: str) -> str:
    """``SELECT`` of a whole model in comparable types."""
    swaps = [f"CAST({c} AS DOUBLE) AS {c}" for c in DECIMALS.get(name, "").split()]
    swaps += [f"array_to_string({c}, ',') AS {c}" for c in LISTS.get(name, [])]
    star = f"* REPLACE ({', '.join(swaps)})" if swaps else "*"
    return f"SELECT {star} FROM {name}"
