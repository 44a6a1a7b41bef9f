"""SQL of the dashboard and segment queries over the model CTEs."""

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
    ravg,
    rat,
)
from marketloom.plans.dashboard_parts import PRICE_RANGES, REVIEW_RANGES

MONTH = "1995-03-01"

_STATES = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in BRAZIL_STATES.items())


def _share(c: str, scale: int) -> str:
    """``c / sum(c) over ()`` in percent, half-up."""
    return dbl(pct(c, f"SUM({c}) OVER ()", scale, 2, scale))


def _ranges(x: str, steps, otherwise: str) -> str:
    body = ""
    for low, high, label in steps:
        if low is None:
            cond = f"{x} < {high}"
        elif high is None:
            cond = f"{x} >= {low}"
        else:
            cond = f"{x} BETWEEN {low} AND {high}"
        body += f" WHEN {cond} THEN '{label}'"
    return f"CASE{body} ELSE '{otherwise}' END"


_PRICE, _STARS = PRICE_RANGES, REVIEW_RANGES
_C = "mart_customer_analytics"
_P = "mart_product_analytics"
_S = "mart_sellers"
_BY_STATE = f"""(SELECT CASE co.state_normalized {_STATES} ELSE co.state_normalized END
 AS customer_state, ca.total_spent
 FROM {_C} ca JOIN int_customer_orders co ON ca.customer_id=co.customer_id)"""

_SPENT = f"{msum('total_spent')} AS total_revenue"
_AOV = dbl(div("SUM(gmv)", "SUM(total_orders)"))
_GMV = dbl("SUM(gmv)")
_ORDERS = isum("total_orders")
_RATING = ravg("avg_review_score")
_SHARE_GMV = dbl(pct("SUM(gmv)", "SUM(SUM(gmv)) OVER ()", 2, 2, 2))
_SREV = dbl("SUM(total_revenue)")
_SRATING = ravg("average_review_score")

DASHBOARD_SQL: dict[str, str] = {
    "q_cust_1_1": f"""SELECT {month("first_order_date")} AS month, COUNT(*) AS new_customers
FROM {_C} GROUP BY 1""",
    "q_cust_1_2": f"""SELECT customer_state, COUNT(*) AS customer_count,
 {dbl(pct("COUNT(*)", f"(SELECT COUNT(*) FROM {_C})"))} AS percentage
FROM {_BY_STATE} GROUP BY 1""",
    "q_cust_1_3": f"""SELECT {month("last_order_date")} AS month, COUNT(*) AS customer_count
FROM {_C} GROUP BY 1""",
    "q_cust_2_1": f"""SELECT frequency_segment, value_segment, customer_tier,
 {ravg("avg_order_value")} AS avg_order_value, COUNT(*) AS customer_count,
 {_ORDERS} AS total_orders FROM {_C} GROUP BY 1,2,3""",
    "q_cust_2_2": f"""SELECT ltv_quintile, {dbl("MIN(total_spent)")} AS min_ltv,
 {ravg("total_spent")} AS avg_ltv, {dbl("MAX(total_spent)")} AS max_ltv,
 COUNT(*) AS customer_count, {dbl("SUM(total_spent)")} AS total_revenue,
 {dbl(pct("SUM(total_spent)", f"(SELECT SUM(total_spent) FROM {_C})", 2, 2, 2))}
  AS revenue_percentage
FROM (SELECT customer_id, total_spent,
 ntile(5) OVER (ORDER BY total_spent ASC NULLS LAST, customer_id) AS ltv_quintile
 FROM {_C}) GROUP BY 1""",
    "q_cust_2_3": f"""SELECT {_ranges("avg_order_value", _PRICE, "$1000+")}
 AS average_order_value_range, COUNT(*) AS customer_count,
 {dbl(pct("COUNT(*)", f"(SELECT COUNT(*) FROM {_C})"))} AS proportion_of_customers,
 {dbl("SUM(total_spent)")} AS total_revenue,
 {dbl(pct("SUM(total_spent)", f"(SELECT SUM(total_spent) FROM {_C})", 2, 2, 2))}
  AS proportion_of_revenue FROM {_C} GROUP BY 1""",
    "q_cust_3_1": f"""SELECT customer_tier, customer_count, avg_customer_ltv,
 avg_orders_per_customer, avg_order_value, total_orders,
 {dbl("total_revenue")} AS total_revenue,
 {_share("total_revenue", 2)} AS revenue_percentage
FROM (SELECT customer_tier, COUNT(*) AS customer_count,
 {ravg("total_spent")} AS avg_customer_ltv,
 {ravg("total_orders")} AS avg_orders_per_customer,
 {ravg("avg_order_value")} AS avg_order_value, {_ORDERS} AS total_orders, {_SPENT}
 FROM {_C} GROUP BY 1)""",
    "q_cust_3_2": f"""SELECT customer_type, customer_count,
 {dbl(pct("customer_count", f"(SELECT COUNT(*) FROM {_C})"))} AS percentage, avg_ltv,
 {dbl("total_revenue")} AS total_revenue, {_share("total_revenue", 2)} AS revenue_percentage
FROM (SELECT CASE WHEN total_orders=1 THEN 'One-time customer'
 WHEN total_orders BETWEEN 2 AND 3 THEN 'Occasional customer (2-3 orders)'
 WHEN total_orders BETWEEN 4 AND 6 THEN 'Regular customer (4-6 orders)'
 ELSE 'Loyal customer (7+ orders)' END AS customer_type, COUNT(*) AS customer_count,
 {ravg("total_spent")} AS avg_ltv, {_SPENT} FROM {_C} GROUP BY 1)""",
    "q_cust_3_3": f"""SELECT CASE WHEN is_active=1 THEN 'Active (past 3 months)'
 WHEN {days(AS_OF, "last_order_date")}<=180 THEN 'Recent (3-6 months)'
 WHEN {days(AS_OF, "last_order_date")}<=365 THEN 'Lapsed (6-12 months)'
 ELSE 'Inactive (12+ months)' END AS recency_segment, COUNT(*) AS customer_count,
 {dbl(pct("COUNT(*)", f"(SELECT COUNT(*) FROM {_C})"))} AS percentage,
 {ravg("total_spent")} AS avg_ltv, {ravg("total_orders")} AS avg_orders,
 {dbl("SUM(total_spent)")} AS total_revenue FROM {_C} GROUP BY 1""",
    "q_cust_4_1": f"""SELECT customer_tier, COUNT(*) AS customer_count,
 {_RATING} AS avg_review_score,
 {ravg("positive_review_rate")} AS avg_positive_review_rate,
 {count_if("is_promoter=1")} AS promoters,
 {dbl(pct(count_if("is_promoter=1"), "COUNT(*)"))} AS promoter_percentage
FROM {_C} GROUP BY 1""",
    "q_cust_5_1": f"""SELECT customer_tier, {dbl("total_revenue")} AS total_revenue,
 {_share("total_revenue", 2)} AS revenue_percentage, customer_count,
 {dbl(pct("customer_count", "COUNT(*) OVER ()"))} AS customer_percentage,
 {_share("customer_count", 0)} AS customer_share
FROM (SELECT customer_tier, {_SPENT}, COUNT(*) AS customer_count FROM {_C} GROUP BY 1)""",
    "q_cust_5_2": f"""SELECT customer_state, {dbl("total_revenue")} AS total_revenue,
 customer_count, {dbl(div("total_revenue", "customer_count"))} AS revenue_per_customer,
 {_share("total_revenue", 2)} AS revenue_percentage
FROM (SELECT customer_state, {_SPENT}, COUNT(*) AS customer_count
 FROM {_BY_STATE} GROUP BY 1)""",
    "q_cust_5_3": f"""SELECT customer_tier, COUNT(*) AS customer_count,
 {dbl("SUM(total_spent)")} AS total_revenue,
 {ravg("customer_lifetime_days")} AS avg_days_since_first_order,
 {dbl("SUM(daily_customer_value)")} AS avg_revenue_per_day_lifetime
FROM {_C} WHERE customer_lifetime_days>0 GROUP BY 1""",
    # ------------------------------------------------------------ products
    "q_prod_1_1": f"""SELECT product_id, category_name, total_orders,
 {dbl("gmv")} AS gross_merchandise_value, {dbl("avg_price")} AS avg_price,
 {dbl(div("avg_review_score", "1", 2, 6))} AS avg_review_score,
 {dbl(div("gmv", "total_orders"))} AS revenue_per_order, volume_ranking, rating_tier
FROM {_P} ORDER BY total_orders DESC NULLS FIRST, product_id LIMIT 20""",
    "q_prod_1_2": f"""SELECT {month("first_ordered_at")} AS month,
 COUNT(DISTINCT product_id) AS products_sold, {_ORDERS} AS total_orders,
 {_GMV} AS total_revenue, {_AOV} AS avg_order_value FROM {_P} GROUP BY 1""",
    "q_prod_1_3": f"""SELECT category_name, COUNT(*) AS product_count,
 {_ORDERS} AS total_orders, {_GMV} AS total_gmv, {_RATING} AS avg_review_score,
 {_AOV} AS avg_order_value, {dbl(div("SUM(gmv)", "COUNT(*)"))} AS revenue_per_product
FROM {_P} GROUP BY 1""",
    "q_prod_1_4": f"""SELECT {_ranges("avg_price", _PRICE, "$1000+")} AS price_range,
 COUNT(*) AS product_count, {_ORDERS} AS total_orders, {_GMV} AS total_gmv,
 {_RATING} AS avg_review_score, {_AOV} AS avg_order_value
FROM {_P} WHERE total_orders>0 GROUP BY 1""",
    "q_prod_2_1": f"""SELECT category_name, {month("first_ordered_at")} AS month,
 {_ORDERS} AS order_count, COUNT(DISTINCT product_id) AS product_count,
 {_GMV} AS total_revenue, {_AOV} AS avg_order_value FROM {_P} GROUP BY 1,2""",
    "q_prod_2_2": f"""SELECT category_name, month_number, month_name, new_products,
 {dbl("total_revenue")} AS total_revenue,
 {dbl(pct("total_revenue", "SUM(total_revenue) OVER (PARTITION BY category_name)",
          2, 2, 2))} AS pct_category_revenue
FROM (SELECT category_name, date_part('month', first_ordered_at) AS month_number,
 rpad(monthname(first_ordered_at), 9, ' ') AS month_name, COUNT(*) AS new_products,
 {msum("gmv")} AS total_revenue FROM {_P} GROUP BY 1,2,3)""",
    "q_prod_2_3": f"""SELECT category_name, COUNT(*) AS product_count,
 {_RATING} AS avg_category_rating, {_ORDERS} AS total_orders, {_GMV} AS total_revenue,
 {_AOV} AS avg_order_value, {ravg("price_variance")} AS avg_price_variance,
 {count_if("rating_tier='excellent'")} AS excellent_rated_products,
 {count_if("rating_tier NOT IN ('excellent','poor')")} AS average_rated_products,
 {count_if("rating_tier='poor'")} AS poorly_rated_products FROM {_P} GROUP BY 1""",
    "q_prod_2_4": f"""SELECT c1.category_name AS category_1, c2.category_name AS category_2,
 c1.n AS products_in_category_1, c2.n AS products_in_category_2,
 c1.rating AS category_1_avg_rating, c2.rating AS category_2_avg_rating,
 ABS(ROUND(x.price, 2)) AS price_correlation, ABS(ROUND(x.orders, 2)) AS order_volume_correlation
FROM (SELECT p1.category_name AS a, p2.category_name AS b,
 CASE WHEN COUNT(DISTINCT p1.avg_price)>1 AND COUNT(DISTINCT p2.avg_price)>1
  THEN corr(p1.avg_price::DOUBLE, p2.avg_price::DOUBLE) END AS price,
 CASE WHEN COUNT(DISTINCT p1.total_orders)>1 AND COUNT(DISTINCT p2.total_orders)>1
  THEN corr(p1.total_orders, p2.total_orders) END AS orders
 FROM {_P} p1 JOIN {_P} p2 ON p1.category_name < p2.category_name GROUP BY 1,2) x
JOIN (SELECT category_name, COUNT(DISTINCT product_id) AS n, {_RATING} AS rating
 FROM {_P} GROUP BY 1 HAVING COUNT(DISTINCT product_id)>5) c1 ON c1.category_name = x.a
JOIN (SELECT category_name, COUNT(DISTINCT product_id) AS n, {_RATING} AS rating
 FROM {_P} GROUP BY 1 HAVING COUNT(DISTINCT product_id)>5) c2 ON c2.category_name = x.b
ORDER BY order_volume_correlation DESC NULLS FIRST, price_correlation DESC NULLS FIRST,
 1, 2 LIMIT 20""",
    "q_prod_3_1": f"""SELECT {_ranges("avg_review_score", _STARS, "No reviews")}
 AS review_range, COUNT(*) AS product_count, {_SHARE_GMV} AS pct_total_revenue,
 {_ORDERS} AS total_orders, {_GMV} AS total_revenue, {_AOV} AS avg_order_value
FROM {_P} GROUP BY 1""",
    "q_prod_3_2": f"""SELECT rating_tier, COUNT(*) AS product_count,
 {_RATING} AS avg_review_score, {_ORDERS} AS total_orders, {_GMV} AS total_revenue,
 {_AOV} AS avg_order_value, {_SHARE_GMV} AS pct_total_revenue
FROM {_P} WHERE review_count>0 GROUP BY 1""",
    "q_prod_3_3": f"""SELECT category_name, COUNT(*) AS product_count,
 {_RATING} AS avg_review_score, {count_if("avg_review_score>=4.5")} AS excellent_products,
 {count_if("avg_review_score<=2.5")} AS poor_products,
 {dbl(pct(count_if("avg_review_score>=4.5"), "COUNT(*)"))} AS pct_excellent,
 {dbl(pct(count_if("avg_review_score<=2.5"), "COUNT(*)"))} AS pct_poor
FROM {_P} WHERE review_count>0 GROUP BY 1""",
    "q_prod_4_1": f"""SELECT CASE WHEN weight_g<500 THEN 'Lightweight (<500g)'
 WHEN weight_g BETWEEN 500 AND 1999 THEN 'Medium (500g-2kg)'
 WHEN weight_g BETWEEN 2000 AND 4999 THEN 'Heavy (2-5kg)'
 WHEN weight_g BETWEEN 5000 AND 9999 THEN 'Very Heavy (5-10kg)'
 WHEN weight_g>=10000 THEN 'Bulky (10kg+)' ELSE 'Unknown' END AS weight_category,
 COUNT(*) AS product_count, {ravg("avg_price")} AS avg_price, {_ORDERS} AS total_orders,
 {_GMV} AS total_revenue, {_AOV} AS avg_order_value
FROM {_P} WHERE weight_g IS NOT NULL GROUP BY 1""",
    "q_prod_4_2": f"""SELECT CASE WHEN volume_cm3<1000 THEN 'Very Small (<1,000 cm³)'
 WHEN volume_cm3 BETWEEN 1000 AND 4999 THEN 'Small (1,000-5,000 cm³)'
 WHEN volume_cm3 BETWEEN 5000 AND 19999 THEN 'Medium (5,000-20,000 cm³)'
 WHEN volume_cm3 BETWEEN 20000 AND 49999 THEN 'Large (20,000-50,000 cm³)'
 WHEN volume_cm3>=50000 THEN 'Very Large (50,000+ cm³)' ELSE 'Dimensions Missing' END
 AS size_category, COUNT(*) AS product_count, {ravg("avg_price")} AS avg_price,
 {_ORDERS} AS total_orders, {_GMV} AS total_revenue, {_RATING} AS avg_review_score
FROM {_P} GROUP BY 1""",
    "q_prod_5_1": f"""SELECT category_name, COUNT(*) AS product_count,
 {_ORDERS} AS total_orders, {_GMV} AS total_revenue,
 {dbl(div("SUM(gmv)", "COUNT(*)"))} AS revenue_per_product, {_RATING} AS avg_review_score
FROM {_P} GROUP BY 1 ORDER BY SUM(gmv) DESC NULLS FIRST, 1 ASC NULLS LAST LIMIT 20""",
    "q_prod_5_2": f"""SELECT volume_ranking, COUNT(*) AS product_count,
 {_ORDERS} AS total_orders, {_GMV} AS total_revenue, {_AOV} AS avg_order_value,
 {_RATING} AS avg_review_score, {_SHARE_GMV} AS pct_total_revenue FROM {_P} GROUP BY 1""",
    "q_prod_5_3": f"""SELECT category_name,
 {ravg("active_months", 1, 0)} AS avg_active_months,
 {ravg("days_since_first_order", 1, 0)} AS avg_days_since_first_order,
 {ravg("days_since_last_order", 1, 0)} AS avg_days_since_last_order,
 COUNT(*) AS product_count,
 {count_if("days_since_last_order<=90")} AS recently_sold_products,
 {dbl(pct(count_if("days_since_last_order<=90"), "COUNT(*)"))} AS pct_recently_sold
FROM {_P} GROUP BY 1""",
    "q_nov_products": f"""SELECT product_id, category_name,
 strftime(first_ordered_at, '%Y-%m-%d') AS first_order_date, total_orders,
 {dbl("gmv")} AS total_revenue, {dbl("avg_price")} AS avg_price,
 {dbl(div("avg_review_score", "1", 2, 6))} AS avg_review_score,
 {dbl(pct("gmv", "SUM(gmv) OVER ()", 2, 2, 2))} AS pct_of_month_revenue
FROM {_P} WHERE date_trunc('month', first_ordered_at)=DATE '{MONTH}' AND total_orders>0
ORDER BY gmv DESC NULLS FIRST, product_id LIMIT 20""",
    "q_nov_categories": f"""SELECT category_name, COUNT(*) AS product_count,
 MIN(strftime(first_ordered_at, '%Y-%m-%d')) AS earliest_order_date,
 MAX(strftime(first_ordered_at, '%Y-%m-%d')) AS latest_order_date,
 {_ORDERS} AS total_orders, {_GMV} AS total_revenue, {_RATING} AS avg_review_score,
 {_SHARE_GMV} AS pct_of_month_revenue
FROM {_P} WHERE date_trunc('month', first_ordered_at)=DATE '{MONTH}' GROUP BY 1
ORDER BY SUM(gmv) DESC NULLS FIRST, 1 ASC NULLS LAST LIMIT 10""",
    # ------------------------------------------------------------- sellers
    "q_sell_1_1": f"""SELECT seller_id, seller_city, seller_state, total_orders,
 total_items_sold, {dbl("total_revenue")} AS total_revenue, {dbl("total_gmv")} AS total_gmv,
 {dbl(div("average_review_score", "1", 2, 6))} AS average_review_score, delivered_orders,
 canceled_orders FROM {_S} ORDER BY {_S}.total_revenue DESC NULLS FIRST, seller_id
LIMIT 20""",
    "q_sell_1_2": f"""SELECT month, COUNT(DISTINCT seller_id) AS active_sellers,
 {isum("order_count")} AS total_orders, {dbl("SUM(revenue)")} AS total_revenue,
 {dbl(div("SUM(revenue)", "COUNT(DISTINCT seller_id)"))} AS revenue_per_seller
FROM (SELECT seller_id, {month("order_date")} AS month, COUNT(*) AS order_count,
 {msum("order_value")} AS revenue FROM seller_order_history GROUP BY 1,2) GROUP BY 1""",
    "q_sell_1_3": f"""SELECT seller_state, COUNT(*) AS seller_count,
 {_SREV} AS total_revenue, {_ORDERS} AS total_orders, {_SRATING} AS avg_review_score,
 {dbl(div("SUM(total_revenue)", "COUNT(*)"))} AS revenue_per_seller,
 {dbl(div("SUM(total_orders)", "COUNT(*)", 2, 0))} AS orders_per_seller,
 {dbl(pct("SUM(on_time_deliveries)", "SUM(delivered_orders)"))} AS on_time_delivery_rate
FROM {_S} GROUP BY 1""",
    "q_sell_1_4": f"""SELECT value_segment, volume_segment, recency_segment,
 COUNT(*) AS seller_count, {_SREV} AS total_revenue, {_SRATING} AS avg_review_score,
 {dbl(div("SUM(total_revenue)", "SUM(total_orders)"))} AS avg_order_value,
 {dbl(div("SUM(total_revenue)", "COUNT(*)"))} AS revenue_per_seller
FROM {_S} GROUP BY 1,2,3""",
    "q_sell_2_1": f"""SELECT value_segment, COUNT(*) AS seller_count,
 {isum("unique_products_sold")} AS total_unique_products,
 {ravg("unique_products_sold", 2, 0)} AS avg_products_per_seller,
 MAX(unique_products_sold) AS max_products, MIN(unique_products_sold) AS min_products
FROM {_S} GROUP BY 1""",
    "q_sell_2_2": f"""SELECT category, COUNT(*) AS seller_count,
 {isum("product_count")} AS total_products, {dbl("SUM(revenue)")} AS total_revenue
FROM (SELECT *, row_number() OVER (PARTITION BY seller_id
 ORDER BY revenue DESC NULLS FIRST, category ASC NULLS LAST) AS category_rank
 FROM (SELECT seller_id, category, COUNT(*) AS product_count,
  {msum("category_revenue")} AS revenue FROM seller_category_history GROUP BY 1,2))
WHERE category_rank=1 GROUP BY 1""",
    "q_sell_2_3": f"""SELECT CASE WHEN unique_products_sold BETWEEN 1 AND 5
 THEN '1-5 products' WHEN unique_products_sold BETWEEN 6 AND 20 THEN '6-20 products'
 WHEN unique_products_sold BETWEEN 21 AND 50 THEN '21-50 products'
 WHEN unique_products_sold BETWEEN 51 AND 100 THEN '51-100 products'
 ELSE '100+ products' END AS product_diversity, COUNT(*) AS seller_count,
 {ravg("total_revenue")} AS avg_revenue, {ravg("total_orders")} AS avg_orders,
 {_SRATING} AS avg_review_score FROM {_S} GROUP BY 1""",
    "q_sell_3_1": f"""SELECT seller_id, seller_state, delivered_orders, on_time_deliveries,
 late_deliveries, {dbl("on_time_delivery_rate")} AS on_time_delivery_rate,
 {dbl(div("average_delivery_time_days", "1", 1, 6))} AS avg_delivery_days,
 {dbl(div("average_delivery_variance_days", "1", 1, 6))} AS avg_variance_days,
 {dbl("average_review_score")} AS average_review_score FROM {_S} WHERE delivered_orders>10
ORDER BY {_S}.on_time_delivery_rate DESC NULLS FIRST, seller_id LIMIT 20""",
    "q_sell_3_2": f"""SELECT seller_state,
 {isum("delivered_orders")} AS total_delivered_orders,
 {isum("on_time_deliveries")} AS total_on_time, {isum("late_deliveries")} AS total_late,
 {dbl(pct("SUM(on_time_deliveries)", "SUM(delivered_orders)"))} AS state_on_time_rate,
 {ravg("average_delivery_time_days", 1)} AS avg_delivery_days,
 {ravg("average_delivery_variance_days", 1)} AS avg_variance_days FROM {_S} GROUP BY 1""",
    "q_sell_3_3": f"""SELECT {ladder("on_time_delivery_rate", [(90, "90-100% on-time"),
  (80, "80-89% on-time"), (70, "70-79% on-time"), (60, "60-69% on-time")],
  "Below 60% on-time")} AS delivery_performance, COUNT(*) AS seller_count,
 {_SRATING} AS avg_review_score,
 {count_if("rating_segment='excellent'")} AS excellent_rated_sellers,
 {count_if("rating_segment='poor'")} AS poor_rated_sellers,
 {dbl(pct(count_if("rating_segment='excellent'"), "COUNT(*)"))} AS pct_excellent_ratings
FROM {_S} WHERE delivered_orders>5 GROUP BY 1""",
    "q_sell_4_1": f"""SELECT value_segment, COUNT(*) AS seller_count,
 {isum("unique_customers")} AS total_customers,
 {ravg("unique_customers", 2, 0)} AS avg_customers_per_seller,
 {dbl(rat("SUM(unique_customers)", "SUM(total_orders)", 3))} AS customer_order_ratio
FROM {_S} GROUP BY 1""",
    "q_sell_4_2": f"""SELECT s.seller_id, s.seller_city, s.seller_state, s.total_orders,
 {dbl("s.total_revenue")} AS total_revenue, s.unique_customers AS total_customers,
 COALESCE(r.n, 0) AS returning_customers,
 {dbl(pct("COALESCE(r.n, 0)", "s.unique_customers"))} AS retention_rate,
 {dbl("s.average_review_score")} AS average_review_score
FROM {_S} s LEFT JOIN (SELECT seller_id, {count_if("c>=2")} AS n
 FROM (SELECT seller_id, customer_id, COUNT(DISTINCT order_id) AS c
  FROM seller_order_history GROUP BY 1,2) GROUP BY 1) r ON s.seller_id=r.seller_id
WHERE s.unique_customers>10
ORDER BY retention_rate DESC NULLS FIRST, s.seller_id LIMIT 20""",
    "q_sell_5_1": f"""SELECT rating_segment, COUNT(*) AS seller_count,
 {dbl(div("MIN(average_review_score)", "1", 2, 6))} AS min_review_score,
 {_SRATING} AS avg_review_score,
 {dbl(div("MAX(average_review_score)", "1", 2, 6))} AS max_review_score,
 {_ORDERS} AS total_orders, {_SREV} AS total_revenue,
 {dbl(div("SUM(total_revenue)", "SUM(total_orders)"))} AS avg_order_value
FROM {_S} WHERE total_orders>5 GROUP BY 1""",
    "q_sell_5_2": f"""SELECT {_ranges("average_review_score", _STARS, "No reviews")}
 AS review_score_range, COUNT(*) AS seller_count, {ravg("total_orders")} AS avg_orders,
 {ravg("total_revenue")} AS avg_revenue,
 {dbl(div("SUM(total_revenue)", "COUNT(*)"))} AS revenue_per_seller,
 {dbl(div("SUM(total_revenue)", "SUM(total_orders)"))} AS avg_order_value
FROM {_S} WHERE total_orders>5 GROUP BY 1""",
    "q_sell_5_3": f"""SELECT value_segment, COUNT(*) AS seller_count,
 {ravg("positive_review_rate")} AS avg_positive_review_rate,
 {ravg("total_revenue")} AS avg_revenue,
 {ravg("on_time_delivery_rate")} AS avg_on_time_delivery_rate,
 {ravg("average_delivery_time_days", 1)} AS avg_delivery_days
FROM {_S} WHERE orders_with_reviews>5 GROUP BY 1""",
    # ------------------------------------------------------------ segments
    "q_seg_customer_matrix": f"""SELECT frequency_segment, value_segment,
 COUNT(*) AS customer_count, {dbl("SUM(total_spent)")} AS total_revenue
FROM int_customer_orders GROUP BY 1,2""",
    "q_seg_nps": f"""SELECT nps_segment, COUNT(*) AS customer_count,
 {dbl(avg("avg_review_score", 6))} AS avg_satisfaction,
 CAST(SUM(CASE WHEN total_orders>1 THEN 1 ELSE 0 END) AS DOUBLE)/COUNT(*)
  AS repeat_purchase_rate FROM int_customer_orders GROUP BY 1""",
    "q_seg_seller_matrix": f"""SELECT performance_segment, delivery_segment,
 COUNT(*) AS seller_count, {dbl(avg("total_gmv"))} AS avg_gmv,
 {dbl(avg("on_time_delivery_rate"))} AS avg_delivery_rate
FROM int_seller_performance GROUP BY 1,2""",
    "q_seg_seller_growth": f"""SELECT s.volume_segment, s.value_segment,
 {dbl(avg("g.growth_rate", 6))} AS avg_growth_rate
FROM seller_growth g JOIN int_seller_performance s ON g.seller_id=s.seller_id
GROUP BY 1,2""",
    "q_seg_category": f"""SELECT pc.category_name_english AS category_name,
 pp.volume_segment, pp.price_segment, COUNT(*) AS product_count,
 {dbl("SUM(pp.total_gmv)")} AS category_gmv,
 {dbl(avg("pp.avg_review_score", 6))} AS avg_satisfaction
FROM int_product_performance pp
JOIN stg_product_categories pc ON pp.category_id=pc.category_id GROUP BY 1,2,3""",
    "q_seg_logistics": f"""SELECT weight_segment, size_segment, COUNT(*) AS product_count,
 {dbl(avg("total_gmv"))} AS avg_gmv, {dbl(avg("avg_review_score", 6))} AS avg_satisfaction
FROM int_product_performance GROUP BY 1,2""",
}

EXTRA_CTES = {
    "seller_months": f"""SELECT seller_id, {month("order_date")} AS month,
 {msum("order_value")} AS gmv FROM seller_order_history GROUP BY 1,2""",
}
# growth = (gmv - prev) / prev: both in cents, so the scale cancels
EXTRA_CTES["seller_growth"] = f"""
SELECT *, {rat("(gmv - prev_month_gmv)*100", "prev_month_gmv*100", 6)} AS growth_rate
FROM (SELECT *, lag(gmv) OVER (PARTITION BY seller_id ORDER BY month) AS prev_month_gmv
 FROM seller_months)"""
