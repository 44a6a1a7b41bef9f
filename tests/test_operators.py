import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from marketloom.operators.keyed import distinct_on, missing_parents, top_per_key, upsert
from marketloom.operators import ranking
from marketloom.operators.ranking import ntile, number_within, percent_ranks, positions
from marketloom.plans.intermediate import with_distinct
from marketloom.sources.tables import deal_by_size, write_buckets


def values(n, seed):
    r = random.Random(seed)
    # a third of the rows share one value, some are NULL
    pick = lambda: None if r.random() < 0.1 else 7 if r.random() < 0.33 else r.randrange(n)
    return [(f"k{i}", pick(), r.randrange(3)) for i in range(n)]


def check_ranks(df):
    got = percent_ranks(df, "k", {
        "up": ("x", "asc"), "down": ("x", "desc"), "known": ("x", "asc_known"),
        "other": ("y", "asc")})
    known = W.partitionBy(F.col("x").isNull()).orderBy("x")
    want = df.select(
        "k",
        F.percent_rank().over(W.orderBy(F.col("x").asc_nulls_last())).alias("up"),
        F.percent_rank().over(W.orderBy(F.col("x").desc_nulls_first())).alias("down"),
        F.when(F.col("x").isNotNull(), F.percent_rank().over(known)).alias("known"),
        F.percent_rank().over(W.orderBy("y")).alias("other"),
    )
    cols = ["k", "up", "down", "known", "other"]
    assert sorted(map(str, got.select(cols).collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("n", [1, 2, 500])
def test_percent_ranks_equal_builtin(spark, n):
    check_ranks(spark.createDataFrame(values(n, n), "k string, x int, y int"))


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(xs=st.lists(st.one_of(st.none(), st.integers(-3, 3)), min_size=1, max_size=30))
def test_percent_ranks_property(spark, xs):
    rows = [(f"k{i}", x, i % 2) for i, x in enumerate(xs)]
    check_ranks(spark.createDataFrame(rows, "k string, x int, y int"))


@pytest.mark.parametrize("n", [1, 3, 5, 103])
def test_ntile_equals_builtin(spark, n):
    df = spark.createDataFrame(values(n, n), "k string, x int, y int")
    got = {r["k"]: r["t"] for r in ntile(df, "k", "x", 5, "t").collect()}
    w = W.orderBy(F.col("x").asc_nulls_last(), "k")
    want = {r["k"]: r["t"] for r in df.select("k", F.ntile(5).over(w).alias("t")).collect()}
    assert got == want


def test_number_within_hot_and_null_groups(spark):
    rows = [(1 if i % 3 else None if i % 2 else i, i) for i in range(300)]
    df = spark.createDataFrame(rows, "g int, v int")
    got = number_within(df, "g", ["v"], "n").collect()
    w = W.partitionBy("g").orderBy("v")
    want = df.withColumn("n", F.row_number().over(w)).collect()
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_positions_use_weights(spark):
    df = spark.createDataFrame([("b", 3), ("a", 2), ("c", 5)], "v string, n int")
    got = {r["v"]: r["before"] for r in positions(df, ["v"], "n").collect()}
    assert got == {"a": 0, "b": 2, "c": 5}


def test_percent_rank_plan_has_no_single_partition_sort(spark):
    df = spark.createDataFrame(values(50, 1), "k string, x int, y int")
    plan = percent_ranks(df, "k", {"r": ("x", "asc")})._jdf.queryExecution().toString()
    # the one single-partition exchange is over one row per range partition
    physical = plan.split("== Physical Plan ==")[1]
    assert physical.count("SinglePartition") <= 1
    assert "CartesianProduct" not in physical


def test_distinct_on_takes_lowest_with_nulls_last(spark):
    df = spark.createDataFrame(
        [("z", None, 1.0, "n"), ("z", 2.0, 1.0, "b"), ("z", 2.0, 1.0, "a"), ("y", None, None, "c")],
        "zip string, lat double, lng double, city string")
    got = {r["zip"]: r["city"] for r in distinct_on(df, ["zip"], ["lat", "lng"]).collect()}
    assert got == {"z": "a", "y": "c"}


def test_top_per_key_equals_row_number(spark):
    df = spark.createDataFrame(
        [("s", "a", 5, 1), ("s", "b", 5, 2), ("t", "a", 1, 3), ("t", None, 9, 4), ("u", "x", None, 5)],
        "k string, c string, v int, n int")
    w = W.partitionBy("k").orderBy(F.col("v").desc_nulls_first(), F.col("c").asc_nulls_last())
    want = df.withColumn("r", F.row_number().over(w)).filter("r=1").drop("r")
    got = top_per_key(df, "k", "v", "c")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_upsert_and_missing_parents(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    assert sorted(map(tuple, upsert(old, new, "k").collect())) == [(1, "a"), (2, "B"), (3, "c")]
    child = spark.createDataFrame([(1,), (9,), (9,), (None,)], "k int")
    got = missing_parents(child, "k", old, "k").collect()
    assert [tuple(r) for r in got] == [(9, 2)]


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning") + plan.count("Exchange rangepartitioning")


def test_number_within_deals_rows_once_unless_a_key_is_heavy(spark, monkeypatch):
    df = spark.createDataFrame(
        [(None if i % 3 == 0 else i % 7, i * 37 % 101) for i in range(300)], "g int, v int")
    want = df.select("g", "v", F.row_number().over(W.partitionBy("g").orderBy("v")).alias("n"))
    want = sorted(map(str, want.collect()))
    light = number_within(df, "g", ["v"], "n")
    assert exchanges(light) == 1
    assert sorted(map(str, light.collect())) == want
    monkeypatch.setattr(ranking, "HEAVY", 40)  # the null key only
    assert sorted(map(str, number_within(df, "g", ["v"], "n").collect())) == want
    monkeypatch.setattr(ranking, "HEAVY", 1000)
    assert number_within(df.limit(0), "g", ["v"], "n").count() == 0


def test_rows_dealt_by_a_key_are_grouped_and_joined_without_a_shuffle(spark):
    df = spark.createDataFrame([(None if i % 9 == 0 else f"o{i % 40}", i) for i in range(300)], "k string, v int")
    items = write_buckets(df, "items", "k")
    sums = write_buckets(items.groupBy("k", "v").count(), "sums", "k")
    assert sorted(map(str, items.collect())) == sorted(map(str, df.collect()))
    both = items.groupBy("k").agg(F.sum("v").alias("s")).join(sums.groupBy("k").agg(F.count("*").alias("n")), "k")
    assert exchanges(both) == 0
    want = df.filter("k is not null").groupBy("k").agg(F.sum("v").alias("s"), F.count("*").alias("n"))
    assert sorted(map(str, both.collect())) == sorted(map(str, want.collect()))


def test_sums_beside_a_distinct_count_are_not_split_by_its_values(spark):
    df = spark.createDataFrame([(i % 5, None if i % 7 == 0 else i % 3, i) for i in range(100)], "k int, v int, x int")
    got = with_distinct(df, "k", "v", "n", [F.sum("x").alias("s")])
    want = df.groupBy("k").agg(F.sum("x").alias("s"), F.count_distinct("v").alias("n"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in plan.splitlines() if "sum(x" in x and "keys=[k" in x and "v#" in x.split("functions")[0]]


def test_buckets_and_partitions_grow_with_the_input(spark):
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert spark.conf.get(initial, None) is None
    try:
        assert deal_by_size(spark, 1000) == least and spark.conf.get(initial, None) is None
        assert deal_by_size(spark, 36_000_000) == 36
        assert deal_by_size(spark, 1000) == 36  # what was dealt stays joinable
        items = write_buckets(spark.range(200).selectExpr("id % 50 as k", "id as v"), "items", "k")
        counts = items.groupBy("k").count()
        assert exchanges(counts) == 0 and "SelectedBucketsCount: 36 out of 36" in counts._jdf.queryExecution().toString()
    finally:
        spark.conf.unset(initial)
