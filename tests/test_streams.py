"""Streams: payments in parts, sides that land late, candidates that wait."""

import datetime as dt
import random

from pyspark.sql import functions as F

from martlet.sources import publish
from martlet.streaming import stream as st

T0 = dt.datetime(2000, 1, 1)
EVENTS = "order_id long, kind string, item string, amount double, at timestamp"


def decided(events, wait, tolerance, last):
    """Brute force of one pass over all events; ``last``: the final watermark."""
    out = {}
    for order in {e[0] for e in events}:
        mine = sorted({(e[4], e[1] == "payment", e[2], e[3]) for e in events if e[0] == order})
        deadline, total, paid, seen, status = mine[0][0] + wait, 0.0, 0.0, ([], []), None
        for at, is_payment, item, amount in mine:
            if at > deadline or item in seen[is_payment] or status:
                continue
            seen[is_payment].append(item)
            total, paid = (total, paid + amount) if is_payment else (total + amount, paid)
            if seen[0] and total - paid <= tolerance:
                status = (order, "paid", total, paid, len(seen[1]), at)
        if not status and seen[0] and deadline < last:
            status = (order, "given up", total, paid, len(seen[1]), deadline)
        if status:
            out[order] = status
    return out


def test_payments_in_parts_equal_brute_force(spark):
    """Random orders over several files: parts, repeats, gaps, payments first,
    payments without an order; and late rows, which change nothing. The state is
    empty once the watermark has passed all deadlines."""
    rng = random.Random(8)
    hours = lambda h: T0 + dt.timedelta(hours=h)
    events = []
    for order in range(60):
        start, total = rng.randint(0, 300), 0
        for n in range(rng.choice([0, 1, 1, 2, 3])):
            amount = rng.randint(1, 50) * 500.0
            total += amount
            events.append((order, "shipment", f"s{order}-{n}", amount, hours(start + rng.randint(0, 20))))
        parts = rng.randint(0, 4)
        for n in range(parts):
            events.append((order, "payment", f"p{order}-{n}", total / max(1, parts - rng.randint(0, 1)) - rng.choice([0, 0, 400]), hours(start + rng.randint(0, 90))))
    events += rng.sample(events, 25)  # the same rows again
    events.append((999, "shipment", "end", 1.0, hours(600)))
    wait, delay = dt.timedelta(days=2), dt.timedelta(hours=10)
    land, out, ck = st.scratch(spark, "land"), st.scratch(spark, "out"), st.scratch(spark, "ck")
    for lo in range(0, 601, 120):
        some = [e for e in events if hours(lo) <= e[4] < hours(lo + 120)]
        spark.createDataFrame(some, EVENTS).coalesce(1).write.mode("append").parquet(land)

    def run():
        s = st.accumulate_payments(st.read_stream(spark, land, spark.read.parquet(land).schema), "10 hours", "2 days")
        q = (s.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
             .outputMode("append").trigger(availableNow=True).start())
        q.awaitTermination()
        assert q.exception() is None
        return q.recentProgress

    progress = run()
    got = {r["order_id"]: (r["order_id"], r["status"], r["order_total"], r["paid"], r["n_payments"], r["decided_at"])
           for r in spark.read.parquet(out).select("*").collect()}
    want = decided(events, wait, st.TOLERANCE, hours(600) - delay)
    assert got == want and {v[1] for v in want.values()} == {"paid", "given up"}
    assert progress[-1]["stateOperators"][0]["numRowsTotal"] == 1  # the last event's order alone
    late = [e for e in events if e[1] == "payment" and e[4] < hours(300)]
    spark.createDataFrame(late, EVENTS).coalesce(1).write.mode("append").parquet(land)
    run()
    assert spark.read.parquet(out).count() == len(want)


def test_orders_share_groups(spark):
    """However many orders there are, the operator is called for, and keeps, a
    bounded number of groups; an order's result does not depend on what shares its
    group, large and unknown numbers included."""
    rng = random.Random(5)
    hours = lambda h: T0 + dt.timedelta(hours=h)
    events = []
    for order in [*range(300), 2**53 + 1, 2**53, -7, None]:
        start = rng.randint(0, 200)
        events += [(order, "shipment", f"s{order}-{n}", 5000.0, hours(start + 5 * n)) for n in range(rng.randint(0, 2))]
        events += [(order, "payment", f"p{order}-{n}", rng.choice([2000.0, 5000.0]), hours(start + rng.randint(0, 60))) for n in range(rng.randint(0, 3))]
    events += [(None, "shipment", "s", 9.0, hours(3)), (999, "shipment", "end", 5000.0, hours(400))]
    land, out, ck = st.scratch(spark, "land"), st.scratch(spark, "out"), st.scratch(spark, "ck")
    for lo in range(0, 401, 200):
        spark.createDataFrame([e for e in events if hours(lo) <= e[4] < hours(lo + 200)], EVENTS).coalesce(1).write.mode("append").parquet(land)
    s = st.accumulate_payments(st.read_stream(spark, land, spark.read.parquet(land).schema, 1), "10 hours", "2 days", buckets=8)
    q = (s.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    assert q.exception() is None
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress]
    assert max(kept) == 8 and kept[-1] == 1
    got = {tuple(r) for r in spark.read.parquet(out).select("order_id", "status", "order_total", "paid", "n_payments", "decided_at").collect()}
    assert got == set(decided(events, dt.timedelta(days=2), st.TOLERANCE, hours(390)).values()) and {None, 2**53 + 1} <= {r[0] for r in got}


def _sink(spark, lines, **options):
    paths = {n: st.scratch(spark, n) for n in ("out", "ledger", "pending")}
    sink = st.pulse_batch_sink(spark, paths["out"], paths["ledger"], "p",
                               lambda fresh: fresh.join(spark.createDataFrame(lines, "shipment_number string, quantity int"), "shipment_number"),
                               paths["pending"], **options)
    return sink, paths


def test_candidates_wait_for_their_lines(spark):
    """Each candidate lands once; its line lands later. Batches are replayed on
    the way, and no candidate is lost or reported twice."""
    lines = [("a", 1)]
    sink, paths = _sink(spark, lines)
    some = lambda *names: spark.createDataFrame([(n,) for n in names], "shipment_number string")
    sink(some("a", "b", "c"), 0)
    sink(some("d"), 1)
    lines += [("b", 2), ("d", 4)]
    sink(some("a"), 2)
    sink(some("a"), 2)
    lines += [("c", 3)]
    sink(some(), 3)
    got = [(r["batch_id"], r["shipment_number"]) for r in spark.read.parquet(paths["out"]).collect()]
    assert sorted(got) == [(0, "a"), (2, "b"), (2, "d"), (3, "c")]
    assert len(publish.children(spark, paths["pending"])) == 2  # the last batch's and the one before


def test_waiting_ends(spark):
    """What never gets a line is tried a bounded number of times."""
    lines = [("x", 1)]
    sink, paths = _sink(spark, lines, tries=3)
    nothing = spark.createDataFrame([], "shipment_number string")
    sink(spark.createDataFrame([("a",)], "shipment_number string"), 0)
    left = []
    for batch in range(1, 4):
        sink(nothing, batch)
        left.append(spark.read.schema("shipment_number string, _tries int").parquet(f"{paths['pending']}/batch_id={batch}").count())
    assert left == [1, 0, 0]


def test_sources_are_bound_in_every_batch(spark):
    """A function that gives the sources is called anew for each batch."""
    from martlet.plans import pulse

    calls, seen = [], []
    land, out, ck, ledger = (st.scratch(spark, n) for n in ("land", "out", "ck", "ledger"))
    for n in range(3):
        spark.createDataFrame([(f"s{n}",)], "shipment_number string").coalesce(1).write.mode("append").parquet(land)
    kept = pulse.enrich_report
    try:
        pulse.enrich_report = lambda fresh, src, cfg: (seen.append(src), fresh.withColumn("n", F.lit(src)))[1]
        st.run_pulse_stream(spark, pulse.PulseConfig("p"), lambda: calls.append(1) or len(calls), land, out, ledger, ck,
                            files_per_trigger=1, trigger={"availableNow": True})
    finally:
        pulse.enrich_report = kept
    assert seen == [1, 2, 3] and sorted(r["n"] for r in spark.read.parquet(out).collect()) == [1, 2, 3]


def test_batches_do_not_grow_with_the_files_of_a_landing(spark):
    """A trigger takes so many landings, however many files each of them has."""
    from martlet.suite.streams import _files_of

    for files in (1, 4):
        land, ck, batches = st.scratch(spark, "land"), st.scratch(spark, "ck"), []
        for n in range(5):
            spark.range(100 * n, 100 * n + 40).repartition(files).write.mode("append").parquet(land)
        stream = st.read_stream(spark, land, "id long", _files_of(spark, land, 2, of=5))
        st.run_to_end(stream.writeStream.foreachBatch(lambda df, n: batches.append(df.count())), ck)
        assert len(batches) == 3 and sum(batches) == 200


def test_ticks_keep_a_schedule_going(spark):
    """On the schedule, batches run without new candidates and add no rows."""
    schema = "shipment_number string"
    land, ck = st.scratch(spark, "land"), st.scratch(spark, "ck")
    spark.createDataFrame([("a",)], schema).coalesce(1).write.parquet(land)
    batches = []
    stream = st._with_ticks(spark, st.read_stream(spark, land, spark.read.parquet(land).schema))
    q = (stream.writeStream.foreachBatch(lambda df, n: batches.append([r[0] for r in df.collect()]))
         .option("checkpointLocation", ck).trigger(processingTime="1 second").start())
    for _ in range(60):
        if len(batches) >= 3 or not q.isActive:
            break
        q.awaitTermination(1)
    q.stop()
    assert len(batches) >= 3 and sum(batches, []) == ["a"]
