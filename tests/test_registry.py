"""Registered queries against their SQL, on the smallest test tables."""

import math
import os

import pytest

import __spark_entry__ as contract
from marketloom.oracle.registry import all_sql
from marketloom.plans.pipeline import QualityError, run_pipeline
from marketloom.plans.quality import COUNT_KINDS, ROW_KINDS, evaluate, one_pass
from marketloom.plans.rules import Rule, all_rules
from marketloom.plans.warehouse import Warehouse
from marketloom.registry import NOW_SQL, _Checked, registered
from marketloom.sources.fixture import FixtureSources
from marketloom.sources.schemas import SOURCES
from shop import ROWS, shop

DATA = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables not present")
SAMPLE = [
    "stg_geolocation", "int_orders_with_items", "int_customer_orders",
    "int_product_performance", "mart_sellers", "mart_product_categories",
    "mart_customer_analytics", "mart_seller_analytics", "q_cust_2_2", "q_prod_2_4",
    "q_prod_5_1", "q_sell_1_2", "q_sell_2_2", "q_seg_seller_growth", "win_ntile",
    "lateral_unnest_ordinality", "dq_unique", "decl_cohort_retention", "src_csv",
]


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"create view {f.split('.')[0]} as select * from read_parquet('{DATA}/{f}')")
    return con


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return v.isoformat() if hasattr(v, "isoformat") else repr(v)


@needs_data
@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, duck, name):
    df = contract.queries()[name](spark, DATA)
    cur = duck.execute(contract.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    order = sorted(cols)
    want = sorted([norm(r[cols.index(c)]) for c in order] for r in cur.fetchall())
    got = sorted([norm(r[c]) for c in order] for r in df.collect())
    assert got == want


def test_every_query_has_sql():
    assert set(registered()) == set(all_sql())
    assert set(registered()) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@needs_data
def test_entry(spark):
    assert contract.entry(spark).count() == 20


@needs_data
def test_pipeline_publishes(spark, tmp_path):
    run = run_pipeline(spark, FixtureSources(spark, DATA), str(tmp_path), "2002-01-01")
    assert spark.table("mart_customer_analytics").count() == 150
    assert run.quality.filter("severity = 'error' and failing_rows > 0").isEmpty()
    assert run.landed.filter("status = 'ok'").count() == 6


def test_pipeline_stops_before_publishing(spark, tmp_path):
    data = shop(spark, customers=ROWS["customers"] + [ROWS["customers"][0]])
    spark.catalog.dropTempView("mart_customers")
    rules = [Rule("unique", "customers", "customer_id", severity="error")]
    with pytest.raises(QualityError, match="customers.customer_id"):
        run_pipeline(spark, data, str(tmp_path), "2018-01-01", land=False, rules=rules)
    assert not spark.catalog.tableExists("mart_customers")


def test_one_pass_counts_like_rule_by_rule(spark):
    """Each model is scanned once for all its rules that look at rows."""
    m = Warehouse(spark, shop(spark), "2018-01-01", tables=())
    now = "timestamp_ntz'2018-01-01 00:00:00'"
    models = ("stg_orders", "stg_order_items", "stg_customers", "customers", "orders")
    rules = [
        r for r in all_rules() if r.model in models and r.kind in ROW_KINDS | COUNT_KINDS
        and (r.kind != "equal_rowcount" or r.args[0] in models)
    ]
    assert len(rules) > 10
    counts = one_pass(m, rules, now)
    shown = lambda df: sorted(map(str, df.collect()))
    alone = [row for r in rules[::4] for row in shown(evaluate(m, [r], now))]
    assert sorted(alone) == shown(evaluate(m, rules[::4], now, counts))
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == len({r.model for r in rules} | {r.args[0] for r in rules if r.kind == "equal_rowcount"})


def test_report_builds_only_what_its_rules_are_about(spark):
    """A report on the sources builds no model; one on more counts only what is new."""
    m = Warehouse(spark, shop(spark), "2018-01-01", tables=())
    report = _Checked(m)
    shown = lambda df: sorted(map(str, df.collect()))
    declared = [r for r in all_rules() if r.model in SOURCES]
    found = shown(evaluate(report, declared, NOW_SQL, report.counts(declared)))
    assert set(m._built) <= set(SOURCES)
    assert found == shown(evaluate(m, declared, NOW_SQL))
    more = declared + [r for r in all_rules() if r.model in ("stg_customers", "stg_orders") and r.kind in ROW_KINDS]
    counts = report.counts(more)
    assert shown(evaluate(report, more, NOW_SQL, counts)) == shown(evaluate(m, more, NOW_SQL))
    assert set(m._built) <= {*SOURCES, "stg_customers", "stg_orders"}
    assert counts.groupBy("model", "test", "column").count().filter("count > 1").isEmpty()
