"""Golden cases G1-G26 (FIXTURES.md section 3): hand-checkable semantics."""

import datetime as dt

from pyspark.sql import functions as F

from martlet.functions import rules, text
from martlet.functions import time as tf
from martlet.operators import aggs, joins, windows

D = dt.date
T = dt.datetime


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


def test_g1_arg_max_skips_null_values(spark):
    df = spark.createDataFrame([(1, 1), (None, 2)], "x int, y int")
    assert df.agg(aggs.arg_max("x", "y").alias("v")).first()["v"] == 1


def _asof(spark, left_rows):
    left = spark.createDataFrame(left_rows, "id int, g int, ts timestamp_ntz")
    right = spark.createDataFrame([(1, D(2000, 1, 1), D(2000, 1, 31), 7, 7), (1, D(2000, 2, 1), D(2000, 2, 29), 8, 7)],
                                  "company_group_id int, date_start date, date_end date, manager_id int, first_manager_id int")
    left = left.withColumnRenamed("g", "company_group_id").withColumnRenamed("ts", "shipped_at")
    out = joins.asof_left(left, right, "company_group_id", "shipped_at", "date_end",
                          ["date_start", "manager_id", "first_manager_id"])
    return {r["id"]: r for r in joins.assigned_manager(out).collect()}


def test_g2_g3_g4_asof(spark):
    r = _asof(spark, [(1, 1, T(2000, 1, 31)), (2, 1, T(2000, 3, 5)), (3, None, T(2000, 1, 5)), (4, 1, None),
                      (5, 1, T(2000, 1, 31, 0, 0, 1))])
    assert r[1]["manager_id"] == 7  # inclusive end
    assert r[2]["manager_id"] is None and r[2]["assigned_manager_id"] == 0  # no later period
    assert r[3]["manager_id"] is None and r[4]["manager_id"] is None  # NULL key / NULL time
    assert r[5]["manager_id"] == 8  # just after midnight of the end day: next period


def test_g5_grace_period(spark):
    r = _asof(spark, [(1, 1, T(1999, 12, 22)), (2, 1, T(1999, 12, 21, 23)), (3, 1, T(2000, 1, 20))])
    assert r[1]["assigned_manager_id"] == 7  # start - 10 days, first manager
    assert r[2]["assigned_manager_id"] == 0  # before the grace
    assert r[3]["assigned_manager_id"] == 7


def test_g6_g7_retention(spark):
    data = [("a", D(2000, 1, 1)), ("a", D(2000, 1, 15)), ("b", D(2000, 1, 1)), ("b", D(2000, 1, 16)),
            ("c", D(2000, 1, 1)), ("c", D(2000, 1, 1)), ("d", D(2000, 1, 31)), ("d", D(2000, 2, 1)),
            ("e", None)]
    df = spark.createDataFrame(data, "k string, d date")
    r = {x["k"]: x for x in aggs.retention(df, "k", "d").collect()}
    assert r["a"]["ret_14d"] and not r["b"]["ret_14d"] and not r["c"]["ret_14d"]
    assert r["d"]["ret_2m"] and not r["a"]["ret_2m"]
    assert not any(r["e"][c] for c in r["e"].asDict() if c != "k")  # G6b


def test_g8_age_in_months(spark):
    df = spark.createDataFrame([("p", D(2000, 1, 31), 1.0), ("p", D(2000, 3, 1), 1.0)], "p string, d date, a double")
    assert aggs.customer_value(df, "p", "d", "a").first()["user_age_month"] == 2


def test_g9_g10_balance(spark):
    df = spark.createDataFrame([(1, 100.0, 600.0), (1, 100.0, 400.0), (2, 100.0, 600.0), (2, 50.0, 400.0),
                                (3, 100.0, 1200.0), (3, 50.0, 400.0)], "o int, paid double, total double")
    grouped = {r["o"] for r in aggs.balance_due_grouped(df, "o", "paid", "total").collect()}
    window = {r["o"] for r in windows.balance_due_window(df, "o", "paid", "total").collect()}
    assert grouped == window == {1, 2}


def test_g11_g12_calendar(spark):
    df = spark.createDataFrame([(T(2000, 1, 7, 9),), (T(2000, 1, 10, 9),)], "t timestamp_ntz")
    assert [r[0] for r in df.select(tf.next_business_day("t")).collect()] == [D(2000, 1, 10), D(2000, 1, 11)]
    df = spark.createDataFrame([(T(2000, 1, 10, 0, 2),), (T(2000, 1, 11, 0, 2),)], "t timestamp_ntz")
    got = [r[0] for r in df.select(tf.hourly_lookback("t")).collect()]
    assert got == [T(2000, 1, 7, 23, 2), T(2000, 1, 10, 23, 2)]


def test_g13_bucketize(spark):
    df = spark.createDataFrame([(0.0,), (49999.99,), (50000.0,), (-1.0,), (None,)], "x double")
    edges, labels = [0, 50000, 100000, float("inf")], ["0-50k", "50k-100k", "100k+"]
    assert [r[0] for r in df.select(rules.bucketize("x", edges, labels)).collect()] == \
        ["0-50k", "0-50k", "50k-100k", None, None]
    assert [r[0] for r in df.select(rules.bucketize("x", edges, labels, null_to_first=True)).collect()] == \
        ["0-50k", "0-50k", "50k-100k", "0-50k", "0-50k"]


def test_g14_share_half_even(spark):
    df = spark.createDataFrame([("a", 1), ("a", 7)], "g string, n int")
    r = sorted(rows(aggs.share(df, ["g"], "n"), "n", "pct_of_total"))
    assert r == [(1, 12.5), (7, 87.5)]
    assert spark.range(1).select(F.bround(F.lit(0.125), 2)).first()[0] == 0.12


def test_g15_mean_nonzero(spark):
    df = spark.createDataFrame([("a", 0.0), ("a", 10.0), ("a", 20.0), ("b", 0.0), ("b", 0.0)], "g string, x double")
    assert dict(rows(df.groupBy("g").agg(aggs.mean_nonzero("x").alias("m")), "g", "m")) == {"a": 15.0, "b": 0.0}


def test_g16_list_to_text(spark):
    df = spark.createDataFrame([("k", ""), ("k", "a")], "k string, v string")
    v = F.when(F.col("v") == "", "dflt").otherwise(F.col("v"))
    assert df.groupBy("k").agg(aggs.group_concat(v).alias("t")).first()["t"] == "a, dflt"


def test_g17_anti_join_with_null(spark):
    a = spark.createDataFrame([(1,), (2,)], "x int")
    b = spark.createDataFrame([(1,), (None,)], "x int")
    assert rows(joins.anti(a, b, "x"), "x") == [(2,)]


def test_g18_left_default(spark):
    f = spark.createDataFrame([(1,), (2,)], "k int")
    d = spark.createDataFrame([(1, 5, "x")], "k int, n int, s string")
    r = sorted(rows(joins.left_default(f, d, "k", {"n": 0, "s": ""}), "k", "n", "s"))
    assert r == [(1, 5, "x"), (2, 0, "")]


def test_g19_majority(spark):
    df = spark.createDataFrame([("u", "a"), ("u", "a"), ("u", "b"), ("u", "b")], "u string, v string")
    assert aggs.majority(df, ["u"], "v", "a").count() == 1
    assert spark.createDataFrame([(["a", "a", "b", "b"],)], "l array<string>").select(
        text.share_equal("l", "a")).first()[0] == 0.5


def test_g20_hierarchy_root(spark):
    nodes = spark.createDataFrame([(1234, 123), (123, 12), (12, 1), (1, None), (77, 1234)], "id int, parent_id int")
    assert dict(rows(joins.hierarchy_root(nodes), "id", "root_id")) == {1234: 1, 123: 1, 12: 1, 1: 1, 77: 1}


def test_g21_g22_thresholds(spark):
    df = spark.createDataFrame([(20, 20), (21, 20)], "q int, lim int")
    assert rows(df.where(F.col("q") > F.col("lim")), "q") == [(21,)]
    df = spark.createDataFrame([(100000.0, 100.0), (10.0, 200000.0), (60000.0, 60000.0)], "line double, total double")
    assert df.where(rules.big_order("line", "total", 100000, 200000, "or")).count() == 2
    assert df.where(rules.big_order("line", "total", 50000, 50000, "and")).count() == 1


def test_g23_company_type_first_match(spark):
    df = spark.createDataFrame([(1, "Government", "x", None, 10)], "m int, c string, n string, i long, e int")
    assert df.select(rules.company_type("m", "c", "n", "i", "e")).first()[0] == "TICKS"


def test_g25_prior_full_week(spark):
    df = spark.createDataFrame([(T(2000, 1, 9, 12),), (T(2000, 1, 10, 12),)], "t timestamp_ntz")
    assert [r[0] for r in df.select(tf.prior_full_week("t")).collect()] == [D(1999, 12, 27), D(2000, 1, 3)]


def test_g26_key_from_text(spark):
    df = spark.createDataFrame([("abc-12-3",), ("abc",)], "k string")
    assert [r[0] for r in df.select(text.key_from_text("k")).collect()] == ["12-3", "abc"]
