from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from marketloom.plans.dashboard_parts import PRICE_RANGES
from marketloom.plans.customer_dashboard import q_cust_3_2
from marketloom.plans.product_dashboard import q_nov_products, q_prod_2_4
from marketloom.plans.quality import (
    dq_order_dates,
    dq_revenue_integrity,
    evaluate,
    failing_rows,
)
from marketloom.plans.intermediate import month_span, months_in
from marketloom.plans.rules import Rule, all_rules
from marketloom.plans.warehouse import DEPENDS, MODELS, Warehouse
from marketloom.sources.schemas import SOURCES
from shop import ROWS, order, shop


@pytest.fixture(scope="module")
def m(spark):
    return Warehouse(spark, shop(spark), "2018-01-01", tables=())


def row(df, **key):
    (k, v), = key.items()
    return df.filter(f"{k} = '{v}'").first().asDict()


def test_staging_accepts_text_and_normalises(m):
    c2 = row(m["stg_customers"], customer_id="c2")
    assert (c2["zip_code_prefix"], c2["city_normalized"], c2["state_normalized"]) == (
        "01002", "Embu-Guacu", "SP")
    assert row(m["stg_geolocation"], zip_code_prefix="01001")["latitude"] == -23.6
    o1 = row(m["stg_orders"], order_id="o1")
    assert o1["delivery_time_days"] == 4.0 and o1["delivery_variance_days"] == 1.5
    assert o1["is_delivered_on_time"] and not row(m["stg_orders"], order_id="o3")["is_delivered"]
    pay = row(m["stg_order_payments"], order_id="o2")
    assert pay["installment_amount"] is None and pay["is_boleto"]
    assert row(m["stg_products"], product_id="p2")["is_missing_dimensions"]
    assert not row(m["stg_order_reviews"], review_id="r3")["has_review_comment"]


def test_order_rollup(m):
    o1 = row(m["int_orders_with_items"], order_id="o1")
    assert (o1["item_count"], o1["unique_products"], o1["unique_sellers"]) == (3, 2, 2)
    assert o1["total_amount"] == D("220.00") and o1["payment_count"] == 2
    assert o1["is_positive_review"] and o1["is_negative_review"]  # two reviews
    assert o1["seller_ids"] == ["s1", "s2"] and o1["max_installments"] == 3
    assert o1["delivery_variance_days"] == -1  # 36 hours early
    o4 = row(m["int_orders_with_items"], order_id="o4")
    assert o4["item_count"] is None and o4["payment_total"] is None
    assert row(m["int_orders_with_items"], order_id="o2")["has_payment_discrepancy"]
    assert m["int_orders_with_items"].count() == len(ROWS["orders"])


def test_customer_without_orders(m):
    c3 = row(m["int_customer_orders"], customer_id="c3")
    assert c3["total_orders"] == 0 and c3["total_spent"] is None
    assert (c3["frequency_segment"], c3["nps_segment"]) == ("low_frequency", "detractor")
    entity = row(m["mart_customers"], customer_id="c3")
    assert (entity["recency_segment"], entity["nps_segment"]) == ("no_orders", "unknown")
    assert entity["lifetime_value"] == 0 and entity["geolocation_lat"] == -22.9
    # no orders falls through every range of the report
    kinds = {r["customer_type"] for r in q_cust_3_2(m, m.as_of).collect()}
    assert "Loyal customer (7+ orders)" in kinds


def test_customer_lifetime(m):
    c1 = row(m["int_customer_orders"], customer_id="c1")
    assert c1["total_orders"] == 2 and c1["customer_lifetime_days"] == 31
    assert c1["spend_per_day"] == D("17.10")  # 530.00 / 31 = 17.0967...
    assert c1["all_payment_methods_used"] == ["boleto", "credit_card", "voucher"]
    assert c1["unique_sellers_bought_from"] == 2
    c2 = row(m["int_customer_orders"], customer_id="c2")
    assert c2["on_time_delivery_rate"] is None  # nothing delivered: no error


def test_item_weighted_rates_can_exceed_100(m):
    s1 = row(m["int_seller_performance"], seller_id="s1")
    # o1 counts twice for s1 (two items), so 2 of 3 orders ... are 66.67 %
    assert s1["total_orders"] == 3 and s1["on_time_deliveries"] == 2
    p1 = row(m["int_product_performance"], product_id="p1")
    assert p1["total_orders"] == 2 and p1["positive_reviews"] == 2
    assert p1["positive_review_rate"] == D("100.00") and p1["total_items_sold"] == 4
    assert row(m["int_product_performance"], product_id="p3")["total_orders"] == 0


def test_category_mart_counts_each_product_once(m):
    bed = row(m["mart_product_categories"], category_name="bed")
    assert bed["total_products"] == 1 and bed["total_orders"] == 2
    assert bed["total_revenue"] == D("500.01") and bed["orders_per_product"] == 2


def test_percentile_marts_on_tiny_data(m):
    assert m["mart_customer_analytics"].count() == 3
    top = row(m["mart_customer_analytics"], customer_id="c3")
    assert top["spend_percentile"] == 1.0  # NULL spend sorts last
    assert m["mart_seller_analytics"].count() == 2
    assert m["mart_product_analytics"].count() == 3


def test_month_report_defaults_to_november_2017(spark):
    late = [order("o9", "c1", "delivered", "2017-11-10 00:00:00")]
    items = [("o9", 1, "p3", "s1", None, "10.00", "1.00")]
    m = Warehouse(spark, shop(spark, orders=ROWS["orders"] + late,
                              order_items=ROWS["order_items"] + items), "2018-01-01", tables=())
    rows = q_nov_products(m, m.as_of).collect()
    assert [(r["product_id"], r["first_order_date"], r["pct_of_month_revenue"]) for r in rows] == [
        ("p3", "2017-11-10", D("100.00"))]


def test_category_pairs_match_a_full_cross_product(spark):
    """All pairs by brute force, zero variance included."""
    rng = range(7)
    products, items, orders = [], [], []
    for c in range(24):
        for i in rng:
            pid = f"p{c}_{i}"
            products.append((pid, f"cat{c:02d}", 1, 1, 1, 1.0, 1.0, 1.0, 1.0))
            price = "10.00" if c % 5 == 0 else f"{10 + i}.00"  # every 5th is flat
            items.append((f"o{pid}", 1, pid, "s1", None, price, "0.00"))
            orders.append(order(f"o{pid}", "c1", "created", "2017-01-01 00:00:00"))
            if c % 7 and i == 0:
                items.append((f"x{pid}", 1, pid, "s1", None, price, "0.00"))
                orders.append(order(f"x{pid}", "c1", "created", "2017-01-02 00:00:00"))
    cats = [(f"cat{c:02d}", f"en{c:02d}") for c in range(24)]
    m = Warehouse(spark, shop(spark, products=products, order_items=items, orders=orders,
                              product_categories=cats, order_reviews=[], order_payments=[]),
                  "2018-01-01", tables=())
    got = [(r["category_1"], r["category_2"], r["price_correlation"], r["order_volume_correlation"])
           for r in q_prod_2_4(m, m.as_of).collect()]
    zero = D("0.00")
    pairs = []
    for a in range(24):
        for b in range(a + 1, 24):
            pairs.append((f"en{a:02d}", f"en{b:02d}",
                          None if a % 5 == 0 or b % 5 == 0 else zero,
                          None if a % 7 == 0 or b % 7 == 0 else zero))
    pairs.sort(key=lambda p: (p[3] is not None, p[2] is not None, p[0], p[1]))
    assert got == pairs[:20]


def test_model_graph_is_complete_and_acyclic():
    from graphlib import TopologicalSorter

    order_ = list(TopologicalSorter(DEPENDS).static_order())
    assert set(DEPENDS) == set(MODELS) and set(SOURCES) <= set(order_)
    rank = {"stg": 0, "int": 1, "mar": 2, "sel": 2}
    for name, deps in DEPENDS.items():
        for d in deps:
            if d in MODELS:
                assert rank[d[:3]] <= rank[name[:3]]


def test_declared_dependencies_are_what_models_read(spark):
    data = shop(spark)

    class Spy(Warehouse):
        def __getitem__(self, name):
            seen.add(name)
            return super().__getitem__(name)

    seen = set()
    w = Spy(spark, data, "2018-01-01", tables=())
    for name, fn in MODELS.items():
        for d in DEPENDS[name]:
            w[d]
        seen.clear()
        fn(w) if name.startswith("stg_") else fn(w, w.as_of)
        assert seen <= set(DEPENDS[name]), name


def test_rules_find_broken_rows(spark):
    bad = shop(spark, customers=ROWS["customers"] + [("c1", "u9", "1", " ", "ZZ")],
               orders=ROWS["orders"] + [order("o8", "nobody", "lost", "2017-05-02 00:00:00",
                                              "2017-05-01 00:00:00")])
    m = Warehouse(spark, bad, "2018-01-01", tables=())
    rules = [r for r in all_rules() if r.model in ("customers", "stg_orders", "stg_geolocation")]
    got = {(r["model"], r["column"], r["test"].split("(")[0]): r["failing_rows"]
           for r in evaluate(m, rules, "timestamp_ntz'2018-01-01 00:00:00'").collect()}
    assert got["customers", "customer_id", "unique"] == 1
    assert got["stg_orders", "customer_id", "relationships"] == 1
    assert got["stg_orders", "order_status", "accepted_values"] == 1
    assert got["stg_orders", "order_id", "relationships"] == 2  # o4 and o8 have no items
    assert got["stg_orders", "*", "equal_rowcount"] == 0
    assert got["stg_orders", "delivery_time_days", "expression_row"] == 1
    assert [r["order_id"] for r in dq_order_dates(m, m.as_of).collect()] == ["o8"]
    gaps = {r["order_id"] for r in dq_revenue_integrity(m, with_freight=True).collect()}
    assert gaps == {"o2"}


def test_rule_counts():
    kinds = {}
    for r in all_rules():
        if r.variant == "declared":
            kinds[r.kind] = kinds.get(r.kind, 0) + 1
    assert kinds["unique"] == 17 and kinds["not_null"] == 101
    assert kinds["expression_row"] == 52 and kinds["relationships"] == 15
    assert isinstance(all_rules()[0], Rule) and len(PRICE_RANGES) == 5


def test_failing_rows_agree_with_the_counts(spark):
    data = {
        "t": spark.createDataFrame(
            [(1, "x", 5), (1, "y", -1), (None, "x", 2), (None, "z", None), (7, "", 3)],
            "id int, name string, n int"),
        "p": spark.createDataFrame([("x",), ("y",)], "name string"),
    }
    rules = [
        Rule("unique", "t", "id"), Rule("unique_combination", "t", "id, name"),
        Rule("not_null", "t", "id"), Rule("positive", "t", "n"),
        Rule("not_empty_string", "t", "name"), Rule("relationships", "t", "name", ("p", "name")),
    ]
    got = [failing_rows(data, r, "current_timestamp()").count() for r in rules]
    assert got == [2, 0, 2, 1, 1, 2]


def test_distinct_months_travel_as_bits(spark):
    dates = ["2017-01-31", "2017-01-01", "2021-12-31", "2016-02-29", None, "2017-02-01"]
    df = spark.createDataFrame(
        [(i % 2, d) for i, d in enumerate(dates)] + [(2, None), (3, "2024-05-05")], "k int, d string"
    ).select("k", F.col("d").cast("timestamp_ntz").alias("d"))
    want = {0: 2, 1: 3, 2: 0, 3: 1}
    span = month_span(df, "d")
    assert span == (2016 * 12 + 2, 2)
    for s in (span, None):
        got = df.groupBy("k").agg(months_in("d", s).alias("n"))
        assert {r["k"]: r["n"] for r in got.collect()} == want
    assert "ObjectHash" not in df.groupBy("k").agg(months_in("d", span))._jdf.queryExecution().toString()
    far = df.union(spark.sql("select 4, timestamp_ntz'9999-12-31 00:00:00'"))
    assert month_span(far, "d") is None and month_span(df.limit(0), "d") == (0, 1)


def test_product_and_seller_sums_need_no_sets(m, spark):
    spark.conf.set("spark.sql.debug.maxToStringFields", "10000")  # whole plans
    try:
        for name in ("int_product_performance", "int_seller_performance", "mart_sellers"):
            plan = MODELS[name](m, m.as_of)._jdf.queryExecution().optimizedPlan().toString()
            assert "bit_or" in plan and "collect_set" not in plan, name
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")


def test_customer_sums_are_not_split_by_month(m, spark):
    spark.conf.set("spark.sql.debug.maxToStringFields", "10000")  # whole plans
    try:
        for name in ("int_customer_orders", "mart_customers"):
            plan = MODELS[name](m, m.as_of)._jdf.queryExecution().optimizedPlan().toString()
            assert "bit_or" in plan and "count(distinct" not in plan, name
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")


def test_payments_are_dealt_by_order_only(spark):
    pays = [("a", 1, None, 2, "5.00"), ("a", 2, "voucher", 1, None), ("a", 2, "voucher", 4, "1.00"),
            ("b", None, "boleto", None, None), ("c", 1, "pix", 1, "7.00")]
    fin = Warehouse(spark, shop(spark, order_payments=pays), "2018-01-01", tables=())["int_order_financials"]
    plan = fin._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in plan.splitlines() if "Exchange hash" in x and "payment_type" in x]
    a, b, c = (row(fin, order_id=k) for k in "abc")
    assert (a["payment_total"], a["voucher_amount"], a["boleto_amount"]) == (D("6.00"), D("1.00"), D("0.00"))
    assert (a["payment_methods"], a["payment_methods_count"], a["max_installments"]) == (["voucher"], 1, 4)
    assert (a["payment_count"], a["payment_installments"]) == (2, 2)
    assert (b["payment_total"], b["boleto_amount"], b["used_boleto"], b["max_installments"]) == (None, None, True, None)
    assert (c["payment_methods"], c["used_voucher"], c["credit_card_amount"]) == (["pix"], False, D("0.00"))
