"""Inputs beyond the fixtures' shapes: late slots, deep chains, cycles, absent
filters, bad casts, values that turn NULL, repeated dimension rows, tied medians,
interrupted refreshes."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from martlet.functions import rules
from martlet.functions import time as tf
from martlet.operators import aggs, joins, windows
from martlet.plans import history, mart, pulse
from martlet.sources import io as sio


def test_local_date_range_with_late_slot(spark):
    rows = [(1, dt.datetime(1997, 5, 1), dt.datetime(1997, 8, 1)), (2, None, dt.datetime(1997, 6, 30, 19)), (3, None, dt.datetime(1997, 6, 30, 20)),
            (4, dt.datetime(1997, 2, 28, 21), None), (5, dt.datetime(1997, 2, 28, 20), dt.datetime(1997, 4, 1)), (6, None, None)]
    df = spark.createDataFrame(rows, "id long, shipped_at timestamp_ntz, starts_at timestamp_ntz")
    got = df.where(tf.between_local("shipped_at", "1997-03-01", "1997-06-30", fallback="starts_at")).collect()
    assert sorted(r["id"] for r in got) == [1, 2, 4]


def test_time_functions_ignore_the_session_zone(spark):
    df = spark.createDataFrame([(dt.datetime(1997, 7, 1, 21, 30),)], "t timestamp_ntz")
    col = tf.local_ts("t")
    before = df.select(col.alias("x")).first()["x"]
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert df.select(col.alias("x")).first()["x"] == before
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_deep_hierarchy_and_cycle(spark):
    chain = [(i, i - 1 if i else None) for i in range(200)] + [(1000, 999), (2000, 2000)]
    got = {r["id"]: r["root_id"] for r in joins.hierarchy_root(spark.createDataFrame(chain, "id long, parent_id long")).collect()}
    assert got == {**{i: 0 for i in range(200)}, 1000: 999, 2000: 2000}
    with pytest.raises(ValueError, match="cycle"):
        joins.hierarchy_root(spark.createDataFrame([(1, 2), (2, 3), (3, 1), (4, None)], "id long, parent_id long")).collect()


def test_scope_without_states(spark):
    df = spark.createDataFrame([(1, 2, "resumed")], "retailer_id int, store_id int, shipment_state string")
    assert pulse._scope(df, pulse.PulseConfig("p", states=())).count() == 1
    assert pulse._scope(df, pulse.PulseConfig("p")).count() == 0


def test_scope_by_zone(spark):
    ship = spark.createDataFrame([(i, 1, i, "complete") for i in range(5)], "shipment_id long, retailer_id int, store_id int, shipment_state string")
    stores = spark.createDataFrame([(0, "north"), (1, "south"), (2, None), (3, "south"), (3, "south")], "store_id int, zone string")
    src = pulse.Sources(ship, None, None, None, None, None, None, None, stores=stores)

    def got(**kw):
        return sorted(r["shipment_id"] for r in pulse._scoped(src, pulse.PulseConfig("p", **kw)).collect())

    assert got() == [0, 1, 2, 3, 4]  # no zones named: stores are not looked at
    assert got(zones=("south",)) == [1, 3]  # a store that is listed twice keeps its shipments single
    assert got(exclude_zones=("south",)) == [0]  # unknown zones and stores are in none
    assert got(zones=("south", "north"), exclude_zones=("south",)) == [0]


@pytest.mark.parametrize("day,want", [("utc", [1, 2]), ("local", [0, 1])])
def test_next_day_slots_by_day_rule(spark, day, want):
    """Friday's slots: the zone's Friday begins at 21 hours UTC on Thursday."""
    ship = spark.createDataFrame([(i, i, 1, 1, "complete") for i in range(4)],
                                 "shipment_id long, order_id long, retailer_id int, store_id int, shipment_state string")
    at = [dt.datetime(2000, 1, 6, 22), dt.datetime(2000, 1, 7, 5), dt.datetime(2000, 1, 7, 22), dt.datetime(2000, 1, 8, 12)]
    slots = spark.createDataFrame(list(enumerate(at)), "id long, starts_at timestamp_ntz")
    orders = spark.createDataFrame([(0, 7)], "order_id long, company_id long")
    src = pulse.Sources(ship, None, None, slots, orders, None, None, None)
    rows = pulse.next_day_candidates(src, pulse.PulseConfig("p", slot_day=day), "2000-01-06 09:00:00").collect()
    assert sorted(r["shipment_id"] for r in rows) == want
    with pytest.raises(ValueError, match="slot_day"):
        pulse.next_day_candidates(src, pulse.PulseConfig("p", slot_day="zone"), "2000-01-06 09:00:00")


def test_gap_of_orders_with_missing_payments(spark):
    rows = [(1, 500.0, 800.0), (1, 500.0, 600.0),  # one payment, copied: 1400 - 500
            (2, 500.0, 900.0), (2, 600.0, 1300.0),  # two payments: 2200 - 1100
            (3, None, 700.0), (3, None, 100.0),  # none at all: no gap
            (4, None, 600.0), (4, 10.0, 400.0),  # a missing one counts as another
            (None, 1.0, 2.0)]
    df = spark.createDataFrame(rows, "order_id long, paid double, total double")
    got = {r["order_id"] for r in windows.balance_due_window(df, "order_id", "paid", "total").collect()}
    assert got == {1, 4, None}


def test_conform_reports_bad_values(spark):
    df = spark.createDataFrame([(1, 2**40, "7"), (2, None, "x")], "id long, big long, text string")
    schema = [("id", "bigint"), ("big", "int"), ("text", "int")]
    assert mart.failed_casts(df, schema).first().asDict() == {"id": 0, "big": 1, "text": 1}
    with pytest.raises(Exception, match="column big does not fit int"):
        mart.conform(df, schema[:2], {"big": 0}).collect()
    assert [tuple(r) for r in mart.conform(df.where("id = 2"), schema[:2], {"big": 0}).collect()] == [(2, 0)]


def test_history_with_values_that_turn_null(spark):
    day = lambda n: dt.date(2000, 1, n)
    df = spark.createDataFrame([(1, day(1), "a"), (1, day(2), None), (1, day(3), None), (1, day(4), "a"), (2, day(1), None), (2, day(2), "")],
                               "k long, snapshot_date date, value string")
    got = sorted((r["k"], r["valid_from"].day, r["valid_to"] and r["valid_to"].day, r["value"]) for r in history.scd2(df, "k").collect())
    assert got == [(1, 1, 1, "a"), (1, 2, 3, None), (1, 4, None, "a"), (2, 1, 1, None), (2, 2, None, "")]
    sat = history.satellite(df, "k", ["value"], "snapshot_date", "s").collect()
    assert len(sat) == 5
    parts = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), (None, ""), ("", None)], "x string, y string")
    assert parts.select(history.hash_key("x", "y")).distinct().count() == 4


def test_repeated_dimension_rows_keep_the_fact(spark):
    dim = spark.createDataFrame([(1, 5), (1, 3), (2, 7), (None, 9)], "user_id long, company_group_id long")
    fact = spark.createDataFrame([(10, 1), (11, 1), (12, 2), (13, None)], "id long, user_id long")
    got = fact.join(mart.one_per_key(dim, "user_id", "company_group_id"), "user_id", "left").collect()
    assert sorted((r["id"], r["company_group_id"]) for r in got if r["user_id"]) == [(10, 3), (11, 3), (12, 7)] and len(got) == 4


def test_asof_interval_without_end(spark):
    left = spark.createDataFrame([(1, dt.datetime(1997, 3, 5)), (1, dt.datetime(1999, 1, 1)), (2, None)], "k long, t timestamp_ntz")
    right = spark.createDataFrame([(1, dt.date(1997, 12, 31), 7), (1, dt.date(9999, 12, 31), 8)], "k long, e date, v int")
    out = joins.asof_left(left, right, "k", "t", "e", ["v"])
    assert sorted((r["k"], r["v"]) for r in out.collect() if r["t"]) == [(1, 7), (1, 8)] and out.count() == 3


def test_median_of_tied_values(spark):
    rows = [(1, float(i % 3)) for i in range(3000)] + [(2, 5.0), (2, 7.0), (3, 4.0)]
    df = spark.createDataFrame(rows, "g long, x double")
    med = aggs.exact_median(df, ["g"], "x")
    assert {r["g"]: r["median"] for r in med.collect()} == {1: 1.0, 2: 6.0, 3: 4.0}
    plan = med._jdf.queryExecution().optimizedPlan().toString()
    window = plan[plan.index("Window"):]
    assert "Aggregate" in window  # the window runs over value counts, not over rows


def test_refresh_keeps_the_old_version_on_failure(spark):
    target = sio.scratch_path(spark, "refresh")
    sio.refresh(spark.range(3), target, required=["id"])
    with pytest.raises(ValueError):
        sio.refresh(spark.range(0), target)
    assert sio.current(spark, target).count() == 3
    with pytest.raises(Exception):
        sio.refresh(spark.range(5).select(F.raise_error(F.lit("stop")).cast("long").alias("id")), target)
    assert sio.current(spark, target).count() == 3
    sio.refresh(spark.range(7), target)
    assert sio.current(spark, target).count() == 7


def test_mart_keeps_its_fact_under_repeated_rows(spark, monkeypatch):
    """Every dimension and feed holds each row twice, some with other values: the
    mart has the fact's shipments once each, and the same money."""
    sf = "/root/testdata/sf0.001"
    once = mart.b2b_mart(spark, sf).agg(F.count("*"), F.count_distinct("shipment_id"), F.round(F.sum("gmv_goods_net_promo"), 2)).first()

    class Doubled(mart.Views):
        def __call__(self, name):
            df = super().__call__(name)
            if name.startswith("v_shipment"):
                return df
            other = df.withColumn("department", F.lit("Other")) if name == "v_manager_info" else df
            if name == "v_user_group":
                other = df.withColumn("company_group_id", F.col("company_group_id") + 1)
            return df.unionByName(other)

    monkeypatch.setattr(mart, "Views", Doubled)
    assert mart.b2b_mart(spark, sf).agg(F.count("*"), F.count_distinct("shipment_id"), F.round(F.sum("gmv_goods_net_promo"), 2)).first() == once


def test_flagship_counts_a_shipment_once(spark, monkeypatch):
    """A second group for a user must not repeat the user's shipments."""
    sf = "/root/testdata/sf0.001"
    kept = mart.view
    n = mart.manager_gmv(spark, sf).agg(F.sum("n_shipments")).first()[0]
    monkeypatch.setattr(mart, "view", lambda *a: (lambda df: df.unionByName(df.withColumn("company_group_id", F.col("company_group_id") + 1)))(kept(*a)))
    assert mart.manager_gmv(spark, sf).agg(F.sum("n_shipments")).first()[0] == n


def test_quarantine_sets_misfits_apart(spark):
    df = spark.createDataFrame([(1, 2**40, "7"), (2, 5, "x"), (3, None, "8"), (4, 2**41, "y")], "id long, big long, text string")
    good, bad = mart.quarantine(df, [("id", "bigint"), ("big", "int"), ("text", "int")])
    assert [r["id"] for r in good.collect()] == [3] and good.columns == df.columns
    assert {r["id"]: r["misfits"] for r in bad.collect()} == {1: ["big"], 2: ["text"], 4: ["big", "text"]}


def test_order_channel_table(spark):
    rows = [("tenant_b2b", "web", 2, None), ("tenant_main", "web", 2, 1), ("tenant_main", "web", 2, None), ("tenant_wl", "web", 0, 1),
            ("tenant_wl", "web", 1, 0), ("tenant_x", "app", 2, 0), ("tenant_x", "web", 1, 0), (None, None, 3, None), (None, None, None, None)]
    df = spark.createDataFrame(rows, "t string, p string, m int, f int")
    got = [r[0] for r in df.select(rules.order_channel("t", "p", "m", "f")).collect()]
    assert got == ["b2b web", "for business with company b2c web", "other", "used certificates b2c", "white label", "for self with company app",
                   "other", "third-party orders", "other"]


def test_cluster_session_needs_a_shared_folder():
    from martlet.session import ensure_checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    class Session:
        conf = Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


@pytest.mark.parametrize("gate,kept", [("pay", {1, 2, 5, 6}), ("pay_no_balance", {1, 2, 5}), ("state", {1, 2, 3, 4, 5, 6, 7})])
def test_payable(spark, gate, kept):
    """1 paid, 2 deferred method, 3 paid but locked, 4 balance due with a large gap,
    5 unpaid of a postpay company, 6 small gap, 7 a sibling elsewhere makes the gap large."""
    rows = [(1, 11, "paid", 1, 1, 100.0, 0.0), (2, 12, "pending", 4, 1, 100.0, 0.0), (3, 13, "paid", 1, 1, 100.0, 0.0),
            (4, 14, "balance_due", 1, 1, 9000.0, 100.0), (5, 15, "failed", 1, 2, 100.0, 0.0), (6, 16, "balance_due", 1, 1, 1500.0, 600.0),
            (7, 17, "balance_due", 1, 1, 1500.0, 600.0)]
    schema = "shipment_id long, order_id long, payment_state string, payment_method_id int, company_id long, total double, payment_total double"
    df = spark.createDataFrame(rows, schema)
    everywhere = df.unionByName(spark.createDataFrame([(8, 17, "balance_due", 1, 1, 5000.0, 600.0)], schema))
    locked = spark.createDataFrame([(13, "locked"), (11, "free")], "order_id long, export_lock_state string")
    directory = spark.createDataFrame([(1, "another"), (2, "postpay")], "company_id long, con_flag string")
    src = pulse.Sources(everywhere, None, None, None, None, locked, None, directory)
    got = {r["shipment_id"] for r in pulse.payable(df, src, pulse.PulseConfig("p", gate=gate)).collect()}
    assert got == kept


def test_tenure_is_whole_months(spark):
    """15 January to 1 February is under a month, though a month boundary lies between."""
    from martlet.plans import audience as aud

    rows = [(1, 1, dt.datetime(2024, 1, 15)), (1, 2, dt.datetime(2024, 2, 1)), (2, 1, dt.datetime(2023, 11, 1)), (2, 2, dt.datetime(2024, 1, 31))]
    feed = spark.createDataFrame(rows, "user_id long, order_seq long, completed_at timestamp_ntz")
    spec = aud.AudienceSpec(start="2023-01-01", end="2024-12-31", funnel_as_of="2024-02-01 00:00:00")
    got = {r["user_id"]: r["use_duration"] for r in aud.funnel(feed, feed.limit(0), spec).collect()}
    assert got == {1: aud.USE_DURATION[0], 2: aud.USE_DURATION[1]}


def test_stream_logs_reported_shipments_only(spark):
    """A candidate whose lines land late stays unlogged and is reported by a later batch."""
    from martlet.streaming import stream as st

    out, ledger = st.scratch(spark, "out"), st.scratch(spark, "ledger")
    lines = [spark.createDataFrame([("a", 1)], "shipment_number string, quantity int")]
    sink = st.pulse_batch_sink(spark, out, ledger, "p", lambda fresh: fresh.join(lines[0], "shipment_number"))
    batch = spark.createDataFrame([("a",), ("b",)], "shipment_number string")
    sink(batch, 0)
    lines[0] = spark.createDataFrame([("a", 1), ("b", 2)], "shipment_number string, quantity int")
    sink(batch, 1)
    sink(batch, 1)  # a replayed batch
    got = [(r["batch_id"], r["shipment_number"]) for r in spark.read.parquet(out).collect()]
    assert sorted(got) == [(0, "a"), (1, "b")]


def test_last_segment_of_a_user(spark):
    from martlet.plans.audience import last_segment

    rows = [(1, "a", dt.datetime(2000, 1, 2)), (1, "z", dt.datetime(2000, 1, 1)), (2, "b", dt.datetime(2000, 1, 1)), (2, "c", dt.datetime(2000, 1, 1)),
            (2, "d", None), (3, None, dt.datetime(2000, 1, 1))]
    got = last_segment(spark.createDataFrame(rows, "user_id long, name string, update_date timestamp_ntz")).collect()
    assert {r["user_id"]: r["segment"] for r in got} == {1: "a", 2: "c", 3: None}


def test_typed_list():
    from martlet.plans.audience import typed_list

    assert typed_list(" Web, app,,WEB ") == ("web", "app") and typed_list(None) == typed_list(" , ") == ()
