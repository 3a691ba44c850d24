"""Hot-key inputs: one key holds a third of all rows. AQE's skew thresholds
are lowered so that the skew-split paths run; results must stay exact."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from martlet.operators import aggs, joins, windows


@pytest.fixture()
def skewed(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
                                          "spark.sql.adaptive.advisoryPartitionSizeInBytes",
                                          "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "4k")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    rnd = random.Random(1)
    rows = []
    for i in range(9000):
        key = 0 if i % 3 == 0 else rnd.randrange(1, 400)
        rows.append((i, key, float(rnd.randrange(0, 1000)), dt.datetime(2000, 1, 1) + dt.timedelta(hours=rnd.randrange(0, 9000))))
    yield spark.createDataFrame(rows, "id int, k int, v double, ts timestamp_ntz"), rows
    for k, v in old.items():
        spark.conf.set(k, v)


def test_group_values_with_hot_key(spark, skewed):
    df, rows = skewed
    got = {r["id"]: r["s"] for r in windows.sum_over(df, "v", "k", "s").collect()}
    sums = {}
    for _, k, v, _ in rows:
        sums[k] = sums.get(k, 0.0) + v
    assert len(got) == len(rows)
    assert all(abs(got[i] - sums[k]) < 1e-6 for i, k, _, _ in rows)


def test_flag_dups_with_hot_key(spark, skewed):
    df, rows = skewed
    out = windows.flag_dups(df, ["k"], [("v", "desc"), ("id", "asc")])
    assert out.count() == len(rows)
    assert out.where(~F.col("is_duplicate")).count() == len({r[1] for r in rows})


def test_asof_with_hot_group(spark, skewed):
    df, rows = skewed
    periods = [(k, (dt.date(2000, 1, 1) + dt.timedelta(days=30 * m)), k * 100 + m)
               for k in (0, 1, 2) for m in range(0, 14, 1 + k)]
    right = spark.createDataFrame(periods, "k int, e date, p int")
    got = {r["id"]: r["p"] for r in joins.asof_left(df, right, "k", "ts", "e", ["p"]).collect()}
    for i, k, _, ts in rows:
        c = [(e, p) for kk, e, p in periods if kk == k and dt.datetime.combine(e, dt.time()) >= ts]
        assert got[i] == (min(c)[1] if c else None)


def test_median_with_hot_group(spark, skewed):
    import numpy as np
    df, rows = skewed
    got = {r["k"]: r["median"] for r in aggs.exact_median(df, ["k"], "v", accuracy=500).collect()}
    for k in (0, 1, 7):
        assert abs(got[k] - float(np.median([v for _, kk, v, _ in rows if kk == k]))) < 1e-9


def test_anti_with_hot_key(spark, skewed):
    df, rows = skewed
    small = df.where(F.col("id") % 97 == 0).select("id", "k")
    large = df.where(F.col("k") != 0).select("k")
    a = {r["id"] for r in joins.anti(small, large, "k").collect()}
    b = {r["id"] for r in small.join(large, "k", "left_anti").collect()}
    assert a == b and a


def test_chunk_index_with_hot_leading_value(spark, skewed):
    from martlet.sources.io import with_chunk_index
    df, rows = skewed
    out = with_chunk_index(df.select("id", "k"), ["k", "id"], 250).orderBy("k", "id").collect()
    want = sorted((k, i) for i, k, _, _ in rows)
    assert [(r["k"], r["id"]) for r in out] == want
    assert [r["row_number"] for r in out] == list(range(1, len(rows) + 1))
