"""SQL of the documented columns and reports."""

from __future__ import annotations

from marketloom.oracle.base import AS_OF, count_if, dbl, ladder, month, pct, wavg


def _seg(entity, model, key, measure, col, names=("High", "Medium", "Low")):
    high, middle, low = names
    return f"""SELECT '{entity}' AS entity, {key} AS entity_id, '{measure}' AS measure,
 CASE WHEN v IS NOT NULL THEN {ladder("r", [("0.8", high), ("0.2", middle)], low)} END
 AS segment FROM (SELECT {key}, {col} AS v,
 percent_rank() OVER (PARTITION BY {col} IS NULL ORDER BY {col}) AS r FROM {model})"""


_STAR = {
    "dim_customers": """SELECT customer_id, customer_unique_id, location_id,
 city_normalized, state_normalized FROM stg_customers""",
    "dim_products": f"""SELECT p.product_id, p.category_id, c.category_name_english,
 p.weight_g, {dbl("p.volume_cm3")} AS volume_cm3, p.is_missing_dimensions
FROM stg_products p LEFT JOIN stg_product_categories c ON p.category_id=c.category_id""",
    "dim_locations": """SELECT zip_code_prefix, city_normalized, state_normalized, latitude,
 longitude FROM stg_geolocation""",
    "dim_dates": """SELECT day, date_part('year', day) AS year,
 date_part('month', day) AS month, date_part('day', day) AS day_of_month,
 date_part('isodow', day) AS iso_weekday FROM (SELECT unnest(generate_series(
 date_trunc('day', MIN(purchased_at))::TIMESTAMP,
 date_trunc('day', MAX(purchased_at))::TIMESTAMP, INTERVAL 1 DAY)) AS day
 FROM stg_orders)""",
    "fct_orders": f"""SELECT order_id, customer_id, order_status, purchased_at, item_count,
 {dbl("total_amount")} AS total_amount, {dbl("payment_total")} AS payment_total,
 review_score FROM int_orders_with_items""",
    "fct_order_items": f"""SELECT order_item_sk, order_id, order_item_id, product_id,
 seller_id, {dbl("price_amount")} AS price_amount,
 {dbl("shipping_amount")} AS shipping_amount, {dbl("total_amount")} AS total_amount
FROM stg_order_items""",
    "fct_payments": f"""SELECT order_payment_sk, order_id, payment_type,
 payment_installments, {dbl("payment_amount")} AS payment_amount FROM stg_order_payments""",
    "fct_shipping": """SELECT order_id, approved_at, shipped_at, delivered_at,
 estimated_delivery_at, is_delivered, is_delivered_on_time FROM stg_orders""",
}
_HOURS = {
    "hours_to_approve": ("approved_at", "purchased_at"),
    "hours_to_ship": ("shipped_at", "approved_at"),
    "hours_to_deliver": ("delivered_at", "shipped_at"),
}
_FREQ = ladder("n", [(5, "high_frequency"), (2, "medium_frequency")], "low_frequency")


def _freq_at(t: str) -> str:
    return f"""(SELECT customer_id, {_FREQ} AS s FROM (SELECT customer_id, COUNT(*) AS n
 FROM stg_orders WHERE purchased_at < {t} GROUP BY 1))"""


DECLARED_SQL = {
    **_STAR,
    "decl_pct_segments": "\nUNION ALL ".join([
        _seg("customer", "int_customer_orders", "customer_id", "spend", "total_spent"),
        _seg("customer", "int_customer_orders", "customer_id", "orders", "total_orders"),
        _seg("seller", "int_seller_performance", "seller_id", "orders", "total_orders"),
        _seg("seller", "int_seller_performance", "seller_id", "gmv", "total_gmv"),
        _seg("product", "int_product_performance", "product_id", "orders", "total_orders"),
        _seg("product", "int_product_performance", "product_id", "price", "avg_price",
             ("Premium", "Standard", "Budget")),
    ]),
    "decl_seller_tier": """SELECT seller_id, CASE WHEN performance_segment='excellent'
 AND delivery_segment='excellent' THEN 'Elite'
 WHEN performance_segment IN ('excellent','good') AND delivery_segment IN
 ('excellent','good') THEN 'Premium' WHEN performance_segment='poor'
 OR delivery_segment='poor' THEN 'At Risk' ELSE 'Standard' END AS seller_tier
FROM int_seller_performance""",
    "decl_mom_growth": f"""SELECT seller_id, month, {dbl("gmv")} AS gmv,
 {dbl("growth_rate")} AS mom_growth_rate FROM seller_growth""",
    "decl_product_tier": """SELECT product_id, CASE WHEN volume_segment='high_volume'
 AND price_segment='premium' THEN 'Premium' WHEN volume_segment='high_volume'
 AND rating_segment IN ('excellent','good') THEN 'Popular'
 WHEN volume_segment='low_volume' AND rating_segment='poor' THEN 'At Risk'
 ELSE 'Standard' END AS product_tier FROM int_product_performance""",
    "decl_logistics_complexity": """SELECT product_id, CASE WHEN weight_segment='heavy'
 OR size_segment='large' THEN 'High' WHEN weight_segment='light'
 AND size_segment='small' THEN 'Low' ELSE 'Medium' END AS logistics_complexity
FROM int_product_performance""",
    "decl_category_relative_gmv": """SELECT product_id, category_id, CAST(gmv AS DOUBLE)
 /(CAST(SUM(gmv) OVER (PARTITION BY category_id) AS DOUBLE)
 /COUNT(gmv) OVER (PARTITION BY category_id)) AS category_relative_gmv
FROM int_product_performance""",
    "decl_star_schema": "\nUNION ALL ".join(
        f"SELECT '{name}' AS \"table\", COUNT(*) AS rows FROM ({sql}) {name}_t"
        for name, sql in _STAR.items()
    ),
    "decl_cohort_retention": f"""SELECT cohort_month, months_since, active_customers,
 {dbl(pct("active_customers", "MAX(CASE WHEN months_since=0 THEN active_customers END)"
          " OVER (PARTITION BY cohort_month)"))} AS retention_rate
FROM (SELECT f.cohort_month, date_diff('month', f.cohort_month, o.purchased_at)
 AS months_since, COUNT(DISTINCT o.customer_id) AS active_customers
 FROM stg_orders o JOIN (SELECT customer_id, {month("MIN(purchased_at)")} AS cohort_month
  FROM stg_orders GROUP BY 1) f ON o.customer_id=f.customer_id GROUP BY 1,2)""",
    "decl_payment_mix": f"""SELECT {month("o.purchased_at")} AS month, p.payment_type,
 COUNT(DISTINCT p.order_id) AS orders, {dbl("SUM(p.payment_amount)")} AS amount
FROM stg_order_payments p JOIN stg_orders o ON p.order_id=o.order_id GROUP BY 1,2""",
    "decl_fulfilment_timeline": f"""SELECT {month("purchased_at")} AS month,
 COUNT(*) AS orders, {", ".join(
    dbl(wavg("1", f"(epoch_us({a})-epoch_us({b}))", 6, 3600000000)) + f" AS {k}"
    for k, (a, b) in _HOURS.items())},
 {dbl(pct(count_if("is_delivered AND NOT is_delivered_on_time"),
          count_if("is_delivered")))} AS late_share FROM stg_orders GROUP BY 1""",
    "decl_segment_migration": f"""SELECT a.s AS old_segment, b.s AS new_segment,
 COUNT(*) AS moved FROM {_freq_at(f"{AS_OF} - INTERVAL 36 MONTH")} a
FULL JOIN {_freq_at(AS_OF)} b ON a.customer_id=b.customer_id GROUP BY 1,2""",
}
