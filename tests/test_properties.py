"""Properties: enrichment never changes the fact's row count, shares sum to
100, buckets partition their input, a pulse run twice emits nothing the
second time, and the custom operators equal a brute-force computation."""

import datetime as dt
import random

from pyspark.sql import functions as F

from martlet.functions.rules import bucketize
from martlet.operators import aggs, joins
from martlet.plans import mart, pulse
from martlet.sources.views import view
from martlet.suite import jobs
from martlet.suite.registry import QUERIES, load_all

SF = "/root/testdata/sf0.001"
load_all()


def test_mart_keeps_fact_rows(spark):
    assert mart.b2b_mart(spark, SF).count() == mart.shipments(spark, SF).count()


def test_shares_sum_to_100(spark):
    s = view(spark, SF, "v_shipment").groupBy("platform", "shipment_state").agg(F.count(F.lit(1)).alias("n"))
    out = aggs.share(s, ["platform"], "n")
    assert abs(out.agg(F.sum("pct_of_total")).first()[0] - 100) < 0.05
    for r in out.groupBy("platform").agg(F.sum("pct_of_group").alias("t")).collect():
        assert abs(r["t"] - 100) < 0.05


def test_buckets_partition_input(spark):
    g = view(spark, SF, "v_shipment").groupBy("user_id").agg(F.sum("total").alias("gmv"))
    edges = [0, 50_000, 500_000, float("inf")]
    b = g.select(bucketize("gmv", edges, ["a", "b", "c"], null_to_first=True).alias("k"))
    assert b.where(F.col("k").isNull()).count() == 0
    assert b.count() == g.count()


def test_pulse_second_run_is_empty(spark):
    src = pulse.Sources.fixture(spark, SF)
    cfg = jobs.NEW_ORDERS
    first = pulse.new_orders(src, cfg)
    assert first.count() > 0
    src.ledger = src.ledger.unionByName(
        pulse.ledger_rows(first, cfg).select("shipment_number", "process_name"))
    assert pulse.new_orders(src, cfg).count() == 0


def test_asof_equals_brute_force(spark):
    rnd = random.Random(7)
    base = dt.datetime(2000, 1, 1)
    right = []
    for g in range(12):
        ends = sorted({base.date() + dt.timedelta(days=rnd.randint(0, 400)) for _ in range(rnd.randint(0, 6))})
        right += [(g, e, g * 100 + i) for i, e in enumerate(ends)]
    left = [(i, rnd.choice([None] + list(range(13))),
             None if rnd.random() < 0.05 else base + dt.timedelta(hours=rnd.randint(0, 24 * 420)))
            for i in range(600)]
    ldf = spark.createDataFrame(left, "id int, g int, ts timestamp_ntz")
    rdf = spark.createDataFrame(right, "g int, e date, v int")
    got = {r["id"]: r["v"] for r in joins.asof_left(ldf, rdf, "g", "ts", "e", ["v"]).collect()}
    for i, g, ts in left:
        cands = [(e, v) for (rg, e, v) in right
                 if g is not None and ts is not None and rg == g and dt.datetime.combine(e, dt.time()) >= ts]
        want = min(cands)[1] if cands else None
        assert got[i] == want, (i, g, ts)


def test_hierarchy_root_equals_walk(spark):
    rnd = random.Random(3)
    parent = {0: None}
    for n in range(1, 300):
        parent[n] = None if rnd.random() < 0.05 else rnd.randrange(0, n)
    nodes = spark.createDataFrame(list(parent.items()), "id int, parent_id int")
    got = {r["id"]: r["root_id"] for r in joins.hierarchy_root(nodes).collect()}
    for n in parent:
        x = n
        while parent[x] is not None:
            x = parent[x]
        assert got[n] == x


def test_chunk_index_is_global_order(spark):
    from martlet.sources.io import with_chunk_index
    df = spark.range(0, 5000).withColumn("k", (F.col("id") * 7919) % 5003).repartition(7)
    out = with_chunk_index(df, ["k"], 100).select("k", "row_number", "chunk").orderBy("k").collect()
    assert [r["row_number"] for r in out] == list(range(1, 5001))
    assert all(r["chunk"] == (r["row_number"] - 1) // 100 for r in out)


def test_exact_median_equals_numpy(spark):
    import numpy as np
    rnd = np.random.default_rng(5)
    rows = []
    sizes = {"big": 20000, "odd": 7, "even": 8, "one": 1, "ties": 50}
    for g, n in sizes.items():
        vals = rnd.integers(0, 5, n) if g == "ties" else rnd.normal(100, 30, n).round(2)
        rows += [(g, float(v)) for v in vals]
    rows += [("odd", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {r["g"]: r["median"] for r in aggs.exact_median(df, ["g"], "x", accuracy=1000).collect()}
    for g in sizes:
        want = float(np.median([v for k, v in rows if k == g and v is not None]))
        assert abs(got[g] - want) < 1e-9, g
    total = aggs.exact_median(df, [], "x").first()["median"]
    assert abs(total - float(np.median([v for _, v in rows if v is not None]))) < 1e-9


def test_flag_dups_equals_brute_force(spark):
    from martlet.operators.windows import dedupe, flag_dups
    rnd = random.Random(11)
    rows = [(rnd.randrange(5), rnd.randrange(3), rnd.randrange(4)) for _ in range(300)]
    df = spark.createDataFrame(rows, "k int, a int, b int")
    flagged = flag_dups(df, ["k"], [("a", "desc"), ("b", "asc")])
    assert flagged.count() == len(rows)
    assert flagged.where(~F.col("is_duplicate")).count() == len({r[0] for r in rows})
    firsts = {r["k"]: (r["a"], r["b"]) for r in dedupe(df, ["k"], [("a", "desc"), ("b", "asc")]).collect()}
    for k in {r[0] for r in rows}:
        want = sorted([(a, b) for kk, a, b in rows if kk == k], key=lambda t: (-t[0], t[1]))[0]
        assert firsts[k] == want


def test_over_limit_scan_log_order(spark):
    src = pulse.Sources.fixture(spark, SF)
    cfg = jobs.OVER_LIMIT_2
    after = pulse.over_limit_ledgers(src, cfg).where(F.col("process_name") == "pulse_b")
    before = pulse.over_limit_ledgers(src, cfg, log_before_gate=True).where(F.col("process_name") == "pulse_b")
    a = {r[0] for r in after.select("shipment_number").collect()}
    b = {r[0] for r in before.select("shipment_number").collect()}
    assert a < b  # unpaid and locked shipments are only logged when logging precedes the gate
    locked = view(spark, SF, "v_locked_order").where(F.col("export_lock_state") == "locked").select("order_id")
    ship = view(spark, SF, "v_shipment")
    stopped = (ship.where(~F.col("payment_state").isin("paid", "overpaid")).select("shipment_number")
               .unionByName(ship.join(locked, "order_id", "left_semi").select("shipment_number")))
    assert b - a <= {r[0] for r in stopped.collect()}


def test_lines_by_order_is_superset(spark):
    import dataclasses
    src = pulse.Sources.fixture(spark, SF)
    by_ship = pulse.new_orders(src, jobs.NEW_ORDERS)
    by_order = pulse.new_orders(src, dataclasses.replace(jobs.NEW_ORDERS, lines_by="order_id"))
    assert by_ship.subtract(by_order).count() == 0
    assert by_order.count() >= by_ship.count()


def test_write_chunked_caps_rows_per_file(spark):
    from martlet.sources import io as sio
    path = sio.scratch_path(spark, "chunks")
    df = spark.read.parquet(f"{SF}/lineitem.parquet").select("l_orderkey", "l_partkey")
    sio.write_chunked(df, path, max_rows=500, fmt="csv")
    back = spark.read.option("header", True).csv(path).withColumn("_f", F.input_file_name())
    per_file = back.groupBy("_f").count().agg(F.max("count").alias("m"), F.sum("count").alias("n")).first()
    assert per_file["m"] <= 500 and per_file["n"] == df.count()


def test_append_ledger_makes_rerun_empty(spark):
    from martlet.sources import io as sio
    src = pulse.Sources.fixture(spark, SF)
    cfg = jobs.NEW_ORDERS
    ledger = sio.scratch_path(spark, "ledger")
    src.ledger.write.partitionBy("process_name").parquet(ledger)
    first = pulse.new_orders(src, cfg)
    sio.append_ledger(first, ledger, cfg.process_name, "2000-01-07 09:00:00")
    src.ledger = spark.read.parquet(ledger)
    assert pulse.new_orders(src, cfg).count() == 0


def test_sketches_are_by_store_alone(spark, tmp_path):
    """The exact count's aggregate by store and user holds no sketch a user; stores
    and users that are unknown count as before."""
    rows = [(i, i % 7 or None, "O", float(i), dt.datetime(1997, 1, 1), "5-LOW") for i in range(200)] + [(None, 3, "O", 1.0, dt.datetime(1997, 1, 1), "5-LOW"), (4, None, "O", 1.0, dt.datetime(1997, 1, 1), "5-LOW")] * 2
    cols = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
    spark.createDataFrame(rows, cols).write.parquet(f"{tmp_path}/orders.parquet")
    df = QUERIES["approx_distinct"](spark, str(tmp_path))
    want = {}
    for key, user, *_ in rows:
        want.setdefault(None if key is None else key % 50, set()).update([] if user is None else [user])
    got = {r["store_id"]: (r["n_users"], r["within_bound"]) for r in df.collect()}
    assert got == {k: (len(v), True) for k, v in want.items()}
    plan = df._jdf.queryExecution().executedPlan().toString()
    sketches = [line for line in plan.splitlines() if "approx_count_distinct" in line and "keys=" in line]
    assert sketches and not [line for line in sketches if "," in line.split("keys=[")[1].split("]")[0]]


def test_known_sides_keep_the_facts_rows(spark):
    """Sides by several keys, repeated and NULL keys among them: the same rows as
    a left join a key."""
    facts = [(i, i % 5 or None, i % 3 or None, f"wide {i}") for i in range(60)] * 2
    fact = spark.createDataFrame(facts, "id int, a int, b int, wide string").repartition(3)
    sides = {"a": spark.createDataFrame([(1, "x"), (2, None), (None, "never")], "a int, of_a string"),
             "b": spark.createDataFrame([(1, 10), (None, 9)], "b int, of_b int")}
    got = mart.with_known(fact, sides, who=fact)
    want = fact.join(sides["a"], "a", "left").join(sides["b"], "b", "left").select(got.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() == 120


def test_mart_moves_its_wide_rows_once_by_what_is_known(spark):
    """One exchange of the mart's plan has the fact's text columns by the keys of
    company, user and phone; no other has them."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        df = mart.b2b_mart(spark, SF)
        plan = df._jdf.queryExecution().executedPlan()
        wide = [x for x in exchanges(plan) if "store_name" in x[1] and "order_number" in x[1]]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    by = [x[0] for x in wide]
    assert sum("company_inn" in x and "phone" in x for x in by) == 1
    assert not [x for x in by if ("company_inn" in x) != ("phone" in x)]


def exchanges(plan):
    """(text, output columns) of the shuffles in a plan."""
    found, todo = [], [plan]
    while todo:
        p = todo.pop()
        if p.nodeName() == "AdaptiveSparkPlan":
            todo.append(p.initialPlan())
            continue
        if p.nodeName() == "Exchange":
            found.append((p.simpleString(1000).split("ENSURE")[0], p.output().mkString(",")))
        todo += [p.children().apply(i) for i in range(p.children().size())]
    return found
