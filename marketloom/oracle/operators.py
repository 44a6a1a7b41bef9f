"""SQL of the single-operator queries."""

from __future__ import annotations

from marketloom.functions.buckets import BRAZIL_STATES
from marketloom.oracle.base import (
    AS_OF,
    avg,
    count_if,
    days,
    dbl,
    div,
    isum,
    ladder,
    month,
    msum,
    pct,
)
from marketloom.oracle.models import _epoch, _initcap, _sk

_STATES = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in BRAZIL_STATES.items())
_CAT_REV = f"""(SELECT seller_id, category, {msum("category_revenue")} AS revenue
 FROM seller_category_history GROUP BY 1,2)"""
_CAT_RANK = f"""(SELECT *, row_number() OVER (PARTITION BY seller_id
 ORDER BY revenue DESC NULLS FIRST, category ASC NULLS LAST) AS category_rank
 FROM {_CAT_REV})"""
_SIZES = """(SELECT category_name, COUNT(DISTINCT product_id) AS products
 FROM mart_product_analytics WHERE category_name IS NOT NULL GROUP BY 1)"""
_PLACES = """SELECT zip_code_prefix, city, state FROM stg_customers
 UNION ALL SELECT zip_code_prefix, city, state FROM stg_sellers"""
_X = "CAST(price_amount*100 AS HUGEINT)"

OPERATOR_SQL: dict[str, str] = {
    "filter_compare": """SELECT seller_id, delivered_orders FROM mart_sellers
WHERE delivered_orders>10""",
    "filter_month_eq": """SELECT order_id, purchased_at FROM stg_orders
WHERE date_trunc('month', purchased_at)=DATE '1995-03-01'""",
    "filter_is_not_null": """SELECT product_id, weight_g FROM stg_products
WHERE weight_g IS NOT NULL""",
    "filter_between": f"""SELECT customer_id, {dbl("avg_order_amount")} AS avg_order_amount
FROM int_customer_orders WHERE int_customer_orders.avg_order_amount BETWEEN 500 AND 1000""",
    "filter_in_list": f"""SELECT price_tier,
 {count_if("rating_tier NOT IN ('excellent','poor')")} AS middle_products,
 {count_if("rating_tier IN ('excellent','poor')")} AS outer_products
FROM mart_product_analytics GROUP BY 1""",
    "filter_in_subquery": f"""SELECT order_id, order_item_id,
 {dbl("price_amount")} AS price_amount FROM stg_order_items
WHERE order_id IN (SELECT order_id FROM stg_orders WHERE order_status='canceled')""",
    "filter_gt_scalar_subquery": """SELECT order_id, purchased_at FROM stg_orders
WHERE purchased_at > (SELECT COALESCE(MAX(purchased_at), TIMESTAMP '2000-01-01')
 FROM stg_orders WHERE purchased_at < TIMESTAMP '2001-01-01')""",
    "having": """SELECT category_name, COUNT(DISTINCT product_id) AS products
FROM mart_product_analytics GROUP BY 1 HAVING COUNT(DISTINCT product_id)>5""",
    "filter_window_result": f"""SELECT seller_id, category, {dbl("revenue")} AS revenue
FROM {_CAT_RANK} WHERE category_rank=1""",
    "filter_boolean_logic": """SELECT order_status, COUNT(*) AS orders FROM stg_orders
WHERE (delivered_at IS NOT NULL AND delivered_at > estimated_delivery_at)
 OR (approved_at IS NOT NULL AND shipped_at IS NULL) GROUP BY 1""",
    "join_order_rollups": f"""SELECT o.order_id, o.order_status, i.item_count,
 {dbl("p.payment_total")} AS payment_total, r.review_score FROM stg_orders o
LEFT JOIN int_order_items_agg i ON o.order_id=i.order_id
LEFT JOIN int_order_financials p ON o.order_id=p.order_id
LEFT JOIN int_order_reviews_agg r ON o.order_id=r.order_id""",
    "join_customer_orders": f"""SELECT c.customer_id, c.state, o.orders,
 {dbl("o.spent")} AS spent,
 array_to_string(p.all_payment_methods_used, ',') AS all_payment_methods_used
FROM stg_customers c LEFT JOIN (SELECT customer_id, COUNT(*) AS orders,
 {msum("total_amount")} AS spent FROM int_orders_with_items GROUP BY 1) o
 ON c.customer_id=o.customer_id
LEFT JOIN int_customer_payments p ON c.customer_id=p.customer_id""",
    "join_product_orders": f"""SELECT p.product_id, c.category_name_english, s.orders,
 s.delivered FROM stg_products p
LEFT JOIN stg_product_categories c ON p.category_id=c.category_id
LEFT JOIN (SELECT i.product_id, COUNT(DISTINCT i.order_id) AS orders,
 COUNT(DISTINCT CASE WHEN o.is_delivered THEN o.order_id END) AS delivered
 FROM stg_order_items i LEFT JOIN stg_orders o ON i.order_id=o.order_id GROUP BY 1) s
 ON p.product_id=s.product_id""",
    "join_seller_orders": """SELECT s.seller_id, s.state, COUNT(i.order_item_id) AS items,
 MAX(o.purchased_at) AS last_sale FROM stg_sellers s
LEFT JOIN stg_order_items i ON s.seller_id=i.seller_id
LEFT JOIN stg_orders o ON i.order_id=o.order_id GROUP BY 1,2""",
    "join_inner_items_orders": """SELECT i.order_id, i.order_item_id, i.seller_id,
 o.customer_id FROM stg_order_items i JOIN stg_orders o ON i.order_id=o.order_id""",
    "join_left_rollup": """SELECT i.order_id, i.seller_id, i.items, o.order_status,
 r.review_score FROM int_order_sellers i JOIN stg_orders o ON i.order_id=o.order_id
LEFT JOIN int_orders_with_items r ON i.order_id=r.order_id""",
    "join_dim_attach": f"""SELECT c.customer_id,
 {count_if("NOT o.is_delivered_on_time AND o.is_delivered")} AS late_deliveries
FROM stg_customers c LEFT JOIN stg_orders o ON c.customer_id=o.customer_id GROUP BY 1""",
    "join_mart_category": """SELECT p.product_id, c.category_name_english AS category_name,
 p.total_orders FROM int_product_performance p
LEFT JOIN stg_product_categories c ON p.category_id=c.category_id""",
    "join_category_products": """SELECT p.category_name_english,
 COUNT(DISTINCT i.order_id) AS orders FROM mart_products p
LEFT JOIN stg_order_items i ON p.product_id=i.product_id GROUP BY 1""",
    "join_mart_state": """SELECT a.customer_tier, o.state_normalized, COUNT(*) AS customers
FROM mart_customer_analytics a
JOIN int_customer_orders o ON a.customer_id=o.customer_id GROUP BY 1,2""",
    "join_theta_pairs": f"""SELECT c1.category_name, COUNT(*) AS later_categories,
 {isum("c2.products")} AS later_products
FROM {_SIZES} c1 JOIN {_SIZES} c2 ON c1.category_name<c2.category_name GROUP BY 1""",
    "join_pair_products": f"""SELECT c1.category_name AS category_1, COUNT(*) AS product_pairs
FROM {_SIZES} c1 JOIN {_SIZES} c2 ON c1.category_name<c2.category_name
JOIN mart_product_analytics p1 ON p1.category_name=c1.category_name
JOIN mart_product_analytics p2 ON p2.category_name=c2.category_name
GROUP BY 1""",
    "join_totals": f"""SELECT i.order_id, {dbl("i.item_total")} AS item_total,
 {dbl("p.payment_total")} AS payment_total
FROM (SELECT order_id, SUM(price_amount) AS item_total FROM stg_order_items GROUP BY 1) i
JOIN (SELECT order_id, SUM(payment_amount) AS payment_total FROM stg_order_payments
 GROUP BY 1) p ON i.order_id=p.order_id""",
    "join_category_guide": """SELECT c.category_name_english, p.volume_segment,
 COUNT(*) AS products FROM int_product_performance p
JOIN stg_product_categories c ON p.category_id=c.category_id GROUP BY 1,2""",
    "semi_join": """SELECT customer_id, city FROM stg_customers WHERE customer_id IN
(SELECT customer_id FROM stg_orders WHERE purchased_at >= TIMESTAMP '2001-06-01')""",
    "lateral_unnest": """SELECT payment_method, COUNT(*) AS orders
FROM (SELECT unnest(payment_methods) AS payment_method FROM int_orders_with_items)
GROUP BY 1""",
    "lateral_unnest_ordinality": """SELECT s.order_id, s.idx, s.seller_id, p.payment_method
FROM (SELECT order_id, unnest(seller_ids) AS seller_id,
 unnest(range(1, len(seller_ids)+1)) AS idx FROM int_orders_with_items) s
JOIN (SELECT order_id, unnest(payment_methods) AS payment_method,
 unnest(range(1, len(payment_methods)+1)) AS idx2 FROM int_orders_with_items) p
 ON s.order_id=p.order_id AND s.idx=p.idx2""",
    "correlated_scalar_count": """SELECT c.customer_id,
 COALESCE(x.n, 0) AS unique_sellers FROM stg_customers c
LEFT JOIN (SELECT o.customer_id, COUNT(DISTINCT i.seller_id) AS n FROM stg_orders o
 JOIN stg_order_items i ON o.order_id=i.order_id GROUP BY 1) x
 ON c.customer_id=x.customer_id""",
    "anti_join": """SELECT order_id FROM stg_orders
WHERE order_id NOT IN (SELECT order_id FROM stg_order_items)""",
    "agg_count_star": "SELECT order_status, COUNT(*) AS orders FROM stg_orders GROUP BY 1",
    "agg_count_distinct": """SELECT seller_id, COUNT(DISTINCT product_id) AS products,
 COUNT(DISTINCT order_id) AS orders FROM stg_order_items GROUP BY 1""",
    "agg_count_distinct_expr": """SELECT customer_id,
 COUNT(DISTINCT date_trunc('month', purchased_at)) AS active_months
FROM stg_orders GROUP BY 1""",
    "agg_count_distinct_case": """SELECT order_status,
 COUNT(DISTINCT CASE WHEN NOT is_delivered_on_time THEN customer_id END)
  AS customers_with_late_orders FROM stg_orders GROUP BY 1""",
    "agg_count_case": f"""SELECT review_score,
 {count_if("has_review_comment")} AS with_comment,
 {count_if("response_time_hours>24")} AS slow_answers FROM stg_order_reviews GROUP BY 1""",
    "agg_sum": f"""SELECT product_id, {dbl("SUM(price_amount)")} AS revenue,
 {isum("order_item_id")} AS item_numbers FROM stg_order_items GROUP BY 1""",
    "agg_sum_case": f"""SELECT payment_installments,
 {dbl("SUM(CASE WHEN payment_type='credit_card' THEN payment_amount ELSE 0 END)")}
  AS credit_card_amount,
 {isum("CASE WHEN payment_type='voucher' THEN 1 ELSE 0 END")} AS vouchers
FROM stg_order_payments GROUP BY 1""",
    "agg_sum_bool": f"""SELECT customer_id,
 {isum("CAST(is_delivered AS INT)")} AS delivered_orders,
 {isum("CAST(is_delivered_on_time AS INT)")} AS on_time_deliveries
FROM stg_orders GROUP BY 1""",
    "agg_avg": f"""SELECT seller_id, {dbl(avg("price_amount"))} AS avg_price,
 {dbl(avg("shipping_amount"))} AS avg_shipping FROM stg_order_items GROUP BY 1""",
    "agg_min_max": """SELECT order_status, MIN(purchased_at) AS first_at,
 MAX(purchased_at) AS last_at, MIN(strftime(purchased_at, '%Y-%m-%d')) AS first_day,
 MAX(strftime(purchased_at, '%Y-%m-%d')) AS last_day FROM stg_orders GROUP BY 1""",
    "agg_bool_any": """SELECT order_id,
 MAX(CASE WHEN payment_type='voucher' THEN 1 ELSE 0 END)=1 AS used_voucher,
 MAX(CASE WHEN payment_type='boleto' THEN 1 ELSE 0 END)=1 AS used_boleto
FROM stg_order_payments GROUP BY 1""",
    "agg_max_is_not_null": """SELECT order_id,
 MAX(review_comment_message) IS NOT NULL AS has_comment FROM stg_order_reviews GROUP BY 1""",
    "agg_stddev": f"""SELECT seller_id, CASE WHEN COUNT({_X})>1 THEN CAST(CAST(sqrt(CAST(
 COUNT({_X})*SUM({_X}*{_X}) - SUM({_X})*SUM({_X}) AS DOUBLE)/10000
 /(CAST(COUNT({_X}) AS DOUBLE)*(CAST(COUNT({_X}) AS DOUBLE)-1))) AS DECIMAL(18,6))
 AS DOUBLE) END AS price_variance FROM stg_order_items GROUP BY 1""",
    "agg_corr": """SELECT category_name, CASE WHEN COUNT(DISTINCT avg_price)>1
 AND COUNT(DISTINCT CASE WHEN avg_price IS NOT NULL THEN total_orders END)>1
 THEN round(corr(CAST(avg_price AS DOUBLE), CAST(total_orders AS DOUBLE)), 6) END
 AS price_order_corr FROM mart_product_analytics GROUP BY 1""",
    "agg_array_distinct": """SELECT payment_installments,
 array_to_string(list_sort(array_agg(DISTINCT payment_type)), ',') AS payment_types
FROM stg_order_payments GROUP BY 1""",
    "agg_of_agg_over": f"""SELECT state_normalized, {dbl("spent")} AS spent,
 {dbl(pct("spent", "SUM(spent) OVER ()", 2, 2, 2))} AS share
FROM (SELECT state_normalized, {msum("total_spent")} AS spent FROM int_customer_orders
 GROUP BY 1) t""",
    "agg_scalar_share": f"""SELECT value_segment, {dbl("SUM(total_spent)")} AS spent,
 {dbl(pct("SUM(total_spent)", "(SELECT SUM(total_spent) FROM int_customer_orders)",
          2, 2, 2))} AS share FROM int_customer_orders GROUP BY 1""",
    "agg_conditional_ratio": f"""SELECT seller_state,
 {isum("on_time_deliveries")} AS on_time, {isum("delivered_orders")} AS delivered,
 {dbl(pct("SUM(on_time_deliveries)", "SUM(delivered_orders)"))} AS on_time_rate
FROM mart_sellers GROUP BY 1""",
    "group_by_expr": f"""SELECT {month("purchased_at")} AS month, COUNT(*) AS orders
FROM stg_orders GROUP BY 1""",
    "group_by_multi": """SELECT weight_segment, size_segment, price_segment,
 volume_segment, COUNT(*) AS products FROM int_product_performance GROUP BY 1,2,3,4""",
    "distinct": "SELECT DISTINCT seller_id, product_id FROM stg_order_items",
    "distinct_on": """SELECT DISTINCT ON (geolocation_zip_code_prefix) *
FROM raw_geolocation ORDER BY geolocation_zip_code_prefix, geolocation_lat,
 geolocation_lng, geolocation_city, geolocation_state""",
    "win_percent_rank": f"""SELECT customer_id, {dbl("total_spent")} AS total_spent,
 {dbl("avg_review_score")} AS avg_review_score,
 percent_rank() OVER (ORDER BY int_customer_orders.total_spent ASC NULLS LAST)
  AS spend_rank,
 percent_rank() OVER (ORDER BY int_customer_orders.avg_review_score DESC NULLS FIRST)
  AS score_rank,
 CASE WHEN int_customer_orders.avg_review_score IS NOT NULL THEN percent_rank() OVER
  (PARTITION BY int_customer_orders.avg_review_score IS NULL
   ORDER BY int_customer_orders.avg_review_score) END AS known_score_rank
FROM int_customer_orders""",
    "win_avg_all": """SELECT customer_id, CAST(total_spent AS DOUBLE)
 /(CAST(SUM(total_spent) OVER () AS DOUBLE)/COUNT(total_spent) OVER ()) AS relative_value
FROM int_customer_orders""",
    "win_ntile": f"""SELECT customer_id, {dbl("total_spent")} AS total_spent, ntile(5) OVER
 (ORDER BY int_customer_orders.total_spent ASC NULLS LAST, customer_id) AS quintile
FROM int_customer_orders""",
    "win_row_number": f"SELECT seller_id, category, category_rank FROM {_CAT_RANK}",
    "win_sum_partition": f"""SELECT category_name, price_tier, {dbl("t.g")} AS gmv,
 {dbl("SUM(t.g) OVER (PARTITION BY category_name)")} AS category_gmv
FROM (SELECT category_name, price_tier, {msum("gmv")} AS g FROM mart_product_analytics
 GROUP BY 1,2) t""",
    "win_sum_all": f"""SELECT seller_state, {dbl("t.r")} AS revenue,
 {dbl("SUM(t.r) OVER ()")} AS all_revenue FROM (SELECT seller_state,
 {msum("total_revenue")} AS r FROM mart_sellers GROUP BY 1) t""",
    "win_count_all": """SELECT customer_tier, COUNT(*) AS customers,
 COUNT(*) OVER () AS tiers FROM mart_customer_analytics GROUP BY 1""",
    "win_lag": f"""SELECT seller_id, month, {dbl("t.g")} AS gmv,
 {dbl("lag(t.g) OVER (PARTITION BY seller_id ORDER BY month)")} AS prev_month_gmv
FROM (SELECT seller_id, {month("order_date")} AS month, {msum("order_value")} AS g
 FROM seller_order_history GROUP BY 1,2) t""",
    "sort_asc": """SELECT category_name, COUNT(*) AS products FROM mart_product_analytics
GROUP BY 1 ORDER BY 2 ASC NULLS LAST, 1 ASC NULLS LAST""",
    "sort_desc": f"""SELECT category_name, {dbl("SUM(gmv)")} AS gmv
FROM mart_product_analytics GROUP BY 1 ORDER BY 2 DESC NULLS FIRST, 1 DESC NULLS FIRST""",
    "topk": f"""SELECT customer_id, {dbl("total_spent")} AS total_spent
FROM int_customer_orders ORDER BY int_customer_orders.total_spent DESC NULLS FIRST,
 customer_id LIMIT 20""",
    "union_all": _PLACES,
    "filter_after_union": f"SELECT * FROM ({_PLACES}) WHERE state='SP'",
    "upsert_union": """SELECT order_id, CASE WHEN order_status='canceled' THEN 'refunded'
 ELSE order_status END AS order_status, purchased_at FROM stg_orders""",
    "fn_initcap": f"""SELECT customer_id, {_initcap("customer_city")} AS city_normalized
FROM raw_customers""",
    "fn_upper": "SELECT customer_id, upper(customer_city) AS city_upper FROM raw_customers",
    "fn_trim": """SELECT review_id, trim(review_comment_message) AS message,
 trim(review_comment_message)<>'' AS is_filled FROM raw_order_reviews""",
    "fn_length": """SELECT review_id, length(review_comment_message) AS message_length
FROM raw_order_reviews""",
    "fn_surrogate_key": f"""SELECT order_id, order_item_id,
 {_sk("order_id", "order_item_id")} AS sk FROM raw_order_items""",
    "fn_to_char_date": """SELECT order_id, strftime(purchased_at, '%Y-%m-%d')
 AS purchase_day FROM stg_orders""",
    "fn_to_char_month": """SELECT rpad(monthname(purchased_at), 9, ' ') AS month_name,
 COUNT(*) AS orders FROM stg_orders GROUP BY 1""",
    "fn_date_trunc_month": f"""SELECT order_id, {month("purchased_at")} AS month
FROM stg_orders""",
    "fn_date_part_month": """SELECT order_id, date_part('month', purchased_at)
 AS month_number FROM stg_orders""",
    "fn_day_diff": f"""SELECT order_id, {days("delivered_at", "purchased_at")}
 AS delivery_days, {days("delivered_at", "estimated_delivery_at")} AS variance_days,
 {days(AS_OF, "purchased_at")} AS age_days FROM stg_orders""",
    "fn_epoch_diff": f"""SELECT order_id,
 {_epoch("delivered_at", "purchased_at", "86400000000.0")} AS delivery_days,
 {_epoch("approved_at", "purchased_at", "3600000000.0")} AS approval_hours
FROM stg_orders""",
    "fn_interval_arith": f"""SELECT order_id,
 purchased_at >= {AS_OF} - INTERVAL 3 MONTH AS last_3_months,
 purchased_at > {AS_OF} - INTERVAL 5 YEAR AS last_5_years FROM stg_orders""",
    "fn_interval_value": """SELECT order_id, actual_delivery_time AS delivery_seconds,
 delivery_variance AS variance_seconds FROM int_orders_with_items""",
    "fn_now": f"""SELECT customer_id, {days(AS_OF, "last_order_at")}
 AS days_since_last_order, {AS_OF} AS generated_at FROM int_customer_orders""",
    "fn_round": f"""SELECT product_id, {dbl(div("avg_price", "1", 1, 6))} AS avg_price_1,
 {dbl(div("avg_price", "1", 2, 6))} AS avg_price_2,
 {dbl(div("avg_price", "1", 3, 6))} AS avg_price_3 FROM int_product_performance""",
    "fn_abs": f"""SELECT order_id, {dbl("abs(payment_total - total_amount)")}
 AS payment_gap, abs(delivery_variance_days) AS off_by_days FROM int_orders_with_items""",
    "fn_nullif_div": f"""SELECT customer_id,
 {dbl(div("total_spent", "customer_lifetime_days"))} AS spend_per_day
FROM int_customer_orders""",
    "fn_coalesce": """SELECT order_id, COALESCE(item_count, 0) AS item_count,
 COALESCE(review_score, -1) AS review_score FROM int_orders_with_items""",
    "fn_case_searched": f"""SELECT order_id,
 {ladder("total_amount", [(500, "high"), (100, "medium")], "low", "none")} AS order_size
FROM int_orders_with_items""",
    "fn_case_simple": f"""SELECT CASE state {_STATES} ELSE state END AS state_name,
 COUNT(*) AS customers FROM stg_customers GROUP BY 1""",
    "fn_cast": """SELECT order_id, order_item_id, CAST(trunc(price) AS INT) AS whole_price,
 CAST(price AS VARCHAR) AS price_text, CAST(order_item_id AS DOUBLE) AS item_number,
 CAST(CAST(shipping_limit_date AS DATE) AS TIMESTAMP) AS limit_day FROM raw_order_items""",
    "fn_bool_expr": """SELECT order_id, order_status='canceled' AS is_canceled,
 NOT is_delivered_on_time AND is_delivered AS is_late FROM stg_orders""",
}
