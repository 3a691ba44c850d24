"""Registered queries: streaming re-aims of the polling jobs (section 2.9).

Each query lands the given table as files in a fresh folder under the shared
checkpoint folder, runs the streaming query to the end of the available
input (``availableNow``; a ``processingTime`` trigger in production), and
returns what the sink holds. The final sink content is deterministic in
each case, so each is compared with SQL.
"""

from __future__ import annotations

import math
from dataclasses import replace

from pyspark.sql import functions as F

from martlet.plans import pulse
from martlet.session import cut_lineage
from martlet.sources import publish
from martlet.sources.views import view, with_views
from martlet.streaming import stream as st
from martlet.suite import jobs
from martlet.suite.registry import ORACLE, register


def _events(spark, sf):
    return spark.read.parquet(f"{sf}/events.parquet").select("event_id", "ts", "user_id", "event_type", "value")


def _stage_in_order(df, path, n_files, col):
    """Land ``df`` as ``n_files`` appends in ``col`` order (one write per file,
    so file times follow event times as in a landing folder)."""
    secs = F.col(col).cast("timestamp").cast("long")
    lo_hi = df.agg(F.min(secs).alias("lo"), F.max(secs).alias("hi")).first()
    lo, hi = lo_hi["lo"], lo_hi["hi"]
    span = max(hi - lo, 1)
    bucket = F.least(F.floor((secs - lo) * n_files / span), F.lit(n_files - 1))
    for i in range(n_files):
        df.where(bucket == i).write.mode("append").parquet(path)
    return path


def _files_of(spark, path, landings, of):
    """Files of so many landings out of ``of`` that ``path`` holds. A landing has
    the more files the larger it is, so a trigger that counts files alone would run
    the more batches, each of which meets the whole tables."""
    n = sum(name.endswith(".parquet") for name in publish.children(spark, path))
    return max(1, math.ceil(n * landings / of))


@register("stream_new_only", """select event_id, ts, user_id, event_type, value from events""")
def stream_new_only(spark, sf):
    ev = _events(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    land, out, ck = st.scratch(spark, "land"), st.scratch(spark, "out"), st.scratch(spark, "ck")
    _stage_in_order(ev, land, 4, "ts")
    ev.where(F.col("event_id") % 20 == 0).write.mode("append").parquet(land)  # re-polled rows
    s = st.read_stream(spark, land, ev.schema, files_per_trigger=1)
    d = st.new_only(s, "event_id", "ts", "40 days")
    st.run_to_end(d.writeStream.format("parquet").option("path", out).outputMode("append"), ck)
    return spark.read.parquet(out).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@register("stream_late_drop", """
select date_trunc('hour', ts) as hour, event_type, count(*) as n from events
where date_trunc('hour', ts) + interval 1 hour <= (select max(ts) from events) - interval 1 hour
group by all""")
def stream_late_drop(spark, sf):
    """Hourly counts with a 1-hour watermark. The stream first runs to
    the end of the in-order files; then a file of rows far behind the
    watermark lands and the same query restarts from its checkpoint (state
    and watermark are kept), so those rows are dropped. Append mode emits
    exactly the windows that end at or before the final watermark."""
    ev = _events(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    land, out, ck = st.scratch(spark, "land"), st.scratch(spark, "out"), st.scratch(spark, "ck")
    _stage_in_order(ev, land, 4, "ts")

    def run():
        s = st.with_event_time(st.read_stream(spark, land, ev.schema), "ts").withWatermark("ts", "1 hour")
        g = s.groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"))
        g = g.select(F.col("w.start").cast("timestamp_ntz").alias("hour"), "event_type", "n")
        st.run_to_end(g.writeStream.format("parquet").option("path", out).outputMode("append"), ck)

    run()
    ev.where(F.col("event_id") % 50 == 0).withColumn("ts", F.col("ts") - F.expr("interval 20 days")) \
        .write.mode("append").parquet(land)
    run()
    return spark.read.parquet(out)


@register("stream_weekly_stats", """
select cast(date_trunc('week', ts) as date) as week_start, event_type, count(*) as n, sum(value) as value_sum
from events group by all""")
def stream_weekly_stats(spark, sf):
    ev = _events(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    land, out, ck = st.scratch(spark, "land"), st.scratch(spark, "out"), st.scratch(spark, "ck")
    _stage_in_order(ev, land, 4, "ts")
    s = st.read_stream(spark, land, ev.schema, files_per_trigger=1)
    g = st.weekly_counts(s, "ts", "event_type", "value", "40 days")
    st.run_to_end(g.writeStream.foreachBatch(st.upsert_sink(out)).outputMode("update"), ck)
    return st.latest_per_key(spark, out, ["week_start", "event_type"])


@register("stream_pulse", ORACLE["pulse_new_orders"])
def stream_pulse(spark, sf):
    """R2: the new-order pulse fed by a stream of candidate shipments that
    are re-polled (each lands twice); the ledger makes each report once."""
    cfg = jobs.NEW_ORDERS
    src = pulse.Sources.fixture(spark, sf)
    src = replace(src, directory=cut_lineage(src.directory, "directory"))  # read by every batch
    cand = cut_lineage(pulse.candidates(src, cfg), "candidates")  # read once for each landing
    land, out, ck = st.scratch(spark, "land"), st.scratch(spark, "out"), st.scratch(spark, "ck")
    ledger = st.scratch(spark, "ledger")
    (src.ledger.where(F.col("process_name") == cfg.process_name).withColumn("batch_id", F.lit(-1).cast("long"))
     .write.mode("overwrite").partitionBy("process_name").parquet(ledger))
    cand = cand.drop("shipped_at", "starts_at")
    _stage_in_order(cand, land, 3, "slot_start")
    _stage_in_order(cand, land, 2, "slot_start")
    st.run_pulse_stream(spark, cfg, src, land, out, ledger, ck, files_per_trigger=_files_of(spark, land, 2, of=5),
                        trigger={"availableNow": True})
    return spark.read.parquet(out).drop("batch_id")


@register("stream_pay_gate", with_views("""
select s.shipment_number, s.completed_at, p.paid_at
from v_shipment s join (select order_id as pay_order_id, completed_at + interval '1' hour * (shipment_id % 30) as paid_at
  from v_shipment where payment_state in ('paid', 'overpaid')) p
  on s.order_id = p.pay_order_id and p.paid_at >= s.completed_at and p.paid_at <= s.completed_at + interval 1 day""",
                                        "v_shipment"))
def stream_pay_gate(spark, sf):
    s = view(spark, sf, "v_shipment")
    orders = s.select("order_id", "shipment_number", F.col("completed_at").cast("timestamp").alias("completed_at"))
    pays = (s.where(F.col("payment_state").isin("paid", "overpaid"))
            .select(F.col("order_id").alias("pay_order_id"),
                    (F.col("completed_at") + F.expr("interval 1 hour") * (F.col("shipment_id") % 30))
                    .cast("timestamp").alias("paid_at")))
    lo, lp, out, ck = (st.scratch(spark, "orders"), st.scratch(spark, "pays"), st.scratch(spark, "out"),
                       st.scratch(spark, "ck"))
    orders.write.parquet(lo)
    pays.write.parquet(lp)
    j = st.await_payment(st.read_stream(spark, lo, orders.schema), st.read_stream(spark, lp, pays.schema),
                         "2 days", "1 day")
    j = j.select("shipment_number", F.col("completed_at").cast("timestamp_ntz").alias("completed_at"),
                 F.col("paid_at").cast("timestamp_ntz").alias("paid_at"))
    st.run_to_end(j.writeStream.format("parquet").option("path", out).outputMode("append"), ck)
    return spark.read.parquet(out)


# Orders of one or two shipments; three payments where there are as many lines, some of
# them behind the deadline, one of them twice.
_PAY_SHIPMENTS = """
select o_orderkey as order_id, concat('A', cast(o_orderkey as string)) as shipment_number, floor(o_totalprice * 60) / 100 as total,
  o_orderdate + interval '1' hour * (o_orderkey % 24) as completed_at from {orders}
union all
select o_orderkey, concat('B', cast(o_orderkey as string)), floor(o_totalprice * 40) / 100, o_orderdate + interval '1' hour * 30
from {orders} where o_orderkey % 2 = 0"""
_PAY_PARTS = """
select o.o_orderkey as pay_order_id, concat(cast(l.l_orderkey as string), '-', cast(l.l_linenumber as string)) as payment_id,
  floor(o.o_totalprice / 3 * 100) / 100 as amount,
  o.o_orderdate + interval '1' hour * (7 * l.l_linenumber * (1 + o.o_orderkey % 9)) as paid_at
from {lineitem} l join {orders} o on o.o_orderkey = l.l_orderkey where l.l_linenumber <= 3"""


def _duck(text: str) -> str:
    return text.replace("{orders}", "orders").replace("{lineitem}", "lineitem").replace(" as string)", " as varchar)")


@register("stream_pay_gate_partial", f"""
with e as (
  select distinct order_id, 0 as kind, shipment_number as item, total as amount, completed_at as ts from ({_duck(_PAY_SHIPMENTS)})
  union all select distinct pay_order_id, 1, payment_id, amount, paid_at from ({_duck(_PAY_PARTS)})),
d as (select order_id, min(ts) + interval 5 day as deadline from e group by order_id),
r as (select e.order_id, ts, deadline, kind, item,
    sum(case when kind = 0 then amount else 0 end) over w as total, sum(case when kind = 1 then amount else 0 end) over w as paid,
    count_if(kind = 0) over w as shipments, count_if(kind = 1) over w as payments
  from e join d using (order_id) where ts <= deadline
  window w as (partition by e.order_id order by ts, kind, item)),
p as (select order_id, 'paid' as status, total as order_total, paid, cast(payments as integer) as n_payments, ts as decided_at from r
      where shipments > 0 and total - paid <= 1000
      qualify row_number() over (partition by order_id order by ts, kind, item) = 1),
g as (select order_id, 'given up' as status, total as order_total, paid, cast(payments as integer) as n_payments, deadline as decided_at
      from r where order_id not in (select order_id from p) and deadline < (select max(ts) from e) - interval 2 day
      qualify row_number() over (partition by order_id order by ts desc, kind desc, item desc) = 1 and shipments > 0)
select order_id, status, round(order_total, 2) as order_total, round(paid, 2) as paid, n_payments, decided_at from p
union all select order_id, status, round(order_total, 2), round(paid, 2), n_payments, decided_at from g""")
def stream_pay_gate_partial(spark, sf):
    """Orders paid in parts, in time, too late or never. Part of the
    payments land a second time with the first, and again long after the watermark,
    when the query has been started anew from its checkpoint."""
    tables = {t: spark.read.parquet(f"{sf}/{t}.parquet") for t in ("orders", "lineitem")}
    events = st.order_events(spark.sql(_PAY_SHIPMENTS, orders=tables["orders"]), spark.sql(_PAY_PARTS, **tables))
    events = cut_lineage(events, "order-events")  # read once for each landing
    again = events.where((F.col("kind") == "payment") & (F.xxhash64("item") % 5 == 0))
    land, out, ck = st.scratch(spark, "land"), st.scratch(spark, "out"), st.scratch(spark, "ck")
    _stage_in_order(events.unionByName(again), land, 4, "at")

    def run():
        s = st.read_stream(spark, land, events.schema, files_per_trigger=None)
        paid = st.accumulate_payments(s, "2 days", "5 days")
        st.run_to_end(paid.writeStream.format("parquet").option("path", out).outputMode("append"), ck)

    run()
    again.where(F.col("at") < F.lit("1998-01-01").cast("timestamp")).write.mode("append").parquet(land)
    run()
    return spark.read.parquet(out).select(
        "order_id", "status", F.round("order_total", 2).alias("order_total"), F.round("paid", 2).alias("paid"), "n_payments",
        F.col("decided_at").cast("timestamp_ntz").alias("decided_at"))


@register("stream_pulse_late_lines", ORACLE["pulse_new_orders"])
def stream_pulse_late_lines(spark, sf):
    """R2: every candidate lands once; the lines of two thirds of the shipments
    land while the query is down for a moment, after their candidates. The sources
    are bound anew in every batch, and unreported candidates are tried again."""
    cfg = jobs.NEW_ORDERS
    src = pulse.Sources.fixture(spark, sf)
    cand = cut_lineage(pulse.candidates(src, cfg).drop("shipped_at", "starts_at"), "candidates")
    names = ("land", "out", "ck", "ledger", "lines", "pending")
    land, out, ck, ledger, lines, pending = (st.scratch(spark, n) for n in names)
    (src.ledger.where(F.col("process_name") == cfg.process_name).withColumn("batch_id", F.lit(-1).cast("long"))
     .write.mode("overwrite").partitionBy("process_name").parquet(ledger))
    third = F.col("shipment_id") % 3 == 0
    src.line_items.where(third).write.parquet(lines)
    every = pulse.Sources.fixture(spark, sf)

    def sources():
        return replace(every, line_items=spark.read.parquet(lines))

    def run():
        st.run_pulse_stream(spark, cfg, sources, land, out, ledger, ck, schema=cand.schema, files_per_trigger=per_trigger,
                            trigger={"availableNow": True}, pending=pending)

    _stage_in_order(cand, land, 3, "slot_start")
    per_trigger = _files_of(spark, land, 2, of=3)
    run()
    src.line_items.where(~third).write.mode("append").parquet(lines)
    cand.limit(1).write.mode("append").parquet(land)  # some poll, with nothing new in it
    run()
    return spark.read.parquet(out).drop("batch_id")


@register("stream_weekly_compacted", ORACLE["stream_weekly_stats"])
def stream_weekly_compacted(spark, sf):
    """As ``stream_weekly_stats``, through a sink that merges its changes
    into a published base every second batch."""
    ev = _events(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    land, out, ck = st.scratch(spark, "land"), st.scratch(spark, "out"), st.scratch(spark, "ck")
    _stage_in_order(ev, land, 5, "ts")
    keys = ["week_start", "event_type"]
    s = st.read_stream(spark, land, ev.schema, files_per_trigger=1)
    g = st.weekly_counts(s, "ts", "event_type", "value", "40 days")
    st.run_to_end(g.writeStream.foreachBatch(st.upsert_sink(out, keys, every=2)).outputMode("update"), ck)
    return st.latest_per_key(spark, out, keys)
