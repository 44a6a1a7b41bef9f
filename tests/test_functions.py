from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from marketloom import functions as fn


def one(spark, expr, sql="select 1 as k"):
    return spark.sql(sql).select(expr.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "text,want",
    [
        ("santa barbara d'oeste", "Santa Barbara D'Oeste"),
        ("EMBU-GUACU", "Embu-Guacu"),
        ("são joão", "São João"),
        ("", ""),
        (None, None),
    ],
)
def test_initcap(spark, text, want):
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(fn.initcap_words("s")).first()[0] == want


def test_surrogate_key_tells_null_from_empty(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), ("a", "b")], "x string, y string")
    keys = [r[0] for r in df.select(fn.surrogate_key("x", "y")).collect()]
    assert len(set(keys)) == 3 and all(len(k) == 32 for k in keys)
    import hashlib

    assert keys[2] == hashlib.md5(b"a-b").hexdigest()


@pytest.mark.parametrize(
    "a,b,want",
    [("2017-01-03 12:00:00", "2017-01-02 00:00:00", 1),
     ("2017-01-02 00:00:00", "2017-01-03 12:00:00", -1),
     ("2017-01-02 23:59:59", "2017-01-02 00:00:00", 0)],
)
def test_day_diff_truncates_toward_zero(spark, a, b, want):
    sql = f"select timestamp_ntz'{a}' as a, timestamp_ntz'{b}' as b"
    assert one(spark, fn.day_diff("a", "b"), sql) == want


def test_epoch_diff_keeps_fractions(spark):
    sql = "select timestamp_ntz'2017-01-02 12:00:00.5' as a, timestamp_ntz'2017-01-01' as b"
    assert one(spark, fn.epoch_diff("a", "b", 3600.0), sql) == pytest.approx(36 + 0.5 / 3600)


def test_month_helpers_ignore_session_zone(spark):
    sql = "select timestamp_ntz'2017-03-26 02:30:00' as t"
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        assert str(one(spark, fn.month_start("t"), sql)) == "2017-03-01 00:00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert one(spark, fn.month_label("t"), sql) == "March    "


@pytest.mark.parametrize("num,den,want", [(1005, 1000, "1.01"), (1, 0, None), (-1, 8, "-0.13"),
                                          (2, 3, "0.67"), (None, 3, None)])
def test_ratio_rounds_half_up(spark, num, den, want):
    df = spark.createDataFrame([(num, den)], "n bigint, d bigint")
    got = df.select(fn.ratio("n", "d")).first()[0]
    assert got == (None if want is None else D(want))


def test_mean_is_order_independent_and_exact(spark):
    df = spark.createDataFrame([(D("0.01"),), (D("0.02"),), (None,)], "x decimal(10,2)")
    assert df.agg(fn.mean("x")).first()[0] == D("0.015000")


def test_weighted_means(spark):
    df = spark.createDataFrame([(2, 5, 1_500_000), (1, 2, -500_000), (4, None, None)],
                               "w bigint, x bigint, u bigint")
    assert df.agg(fn.weighted_mean("w", "x")).first()[0] == D("4.000000")
    got = df.agg(fn.weighted_mean_micros(F.col("w"), "u", 1_000_000)).first()[0]
    assert got == D("0.833333")


def test_sample_stddev_matches_builtin_and_is_null_for_one(spark):
    df = spark.createDataFrame([(1, D("1.00")), (1, D("2.50")), (2, D("7.00"))],
                               "k int, x decimal(10,2)")
    g = df.groupBy("k").agg(F.count("x").alias("n"), F.sum("x").alias("s"),
                            F.sum(F.col("x") * F.col("x")).alias("q"),
                            F.stddev("x").alias("want"))
    rows = {r["k"]: r for r in g.withColumn("got", fn.sample_stddev("n", "s", "q")).collect()}
    assert float(rows[1]["got"]) == pytest.approx(rows[1]["want"], abs=1e-6)
    assert rows[2]["got"] is None


def test_corr_without_variance_is_null(spark):
    df = spark.createDataFrame([(1, 5, 1), (1, 5, 2), (2, 1, 10), (2, 2, 20), (2, 3, 30)],
                               "k int, x int, y int")
    got = {r[0]: r[1] for r in df.groupBy("k").agg(fn.guarded_corr("x", "y")).collect()}
    assert got[1] is None and got[2] == pytest.approx(1.0)


def test_unnest_zip_keeps_common_prefix(spark):
    df = spark.createDataFrame([(1, ["a", "b", "c"], [10, 20]), (2, None, [1])],
                               "k int, x array<string>, y array<int>")
    rows = fn.unnest_zip(df, ["k"], {"x": "p", "y": "q"}).collect()
    assert [tuple(r) for r in rows] == [(1, 1, "a", 10), (1, 2, "b", 20)]


def test_ranges_have_gaps_and_ladder_falls_through(spark):
    df = spark.createDataFrame([(D("99.995"),), (D("99.99"),), (None,), (D("49.99"),)],
                               "x decimal(10,3)")
    steps = [(None, 50, "low"), (50, "99.99", "mid")]
    assert [r[0] for r in df.select(fn.ranges("x", steps, "rest")).collect()] == [
        "rest", "mid", "rest", "low"]
    assert [r[0] for r in df.select(fn.ladder("x", [("99.99", "a")], "b", "none")).collect()] == [
        "a", "a", "none", "b"]


def test_state_name_falls_back_to_code(spark):
    df = spark.createDataFrame([("SP",), ("ZZ",), (None,)], "s string")
    assert [r[0] for r in df.select(fn.state_name("s")).collect()] == ["São Paulo", "ZZ", None]
    assert len(fn.BRAZIL_STATES) == 27
