"""Registered queries: sources and sinks (section 2.1). Inputs are written by
Spark from the given tables into a fresh folder under the shared checkpoint
folder, then read back through the operator under test."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.plans import pulse, runs
from martlet.session import AS_OF, cut_lineage
from martlet.suite import jobs
from martlet.sources import io
from martlet.sources.views import view, with_views
from martlet.suite.registry import ORACLE, register


def V(spark, sf, name):
    return view(spark, sf, name)


@register("reference_clean", with_views("""
select distinct retailer_sku, cast(max_qty as integer) as max_qty from v_offer_limit
where retailer_sku is not null and max_qty is not null""", "v_offer_limit"))
def reference_clean(spark, sf):
    path = io.scratch_path(spark, "offer-limits")
    lim = V(spark, sf, "v_offer_limit")
    # The sheet as users keep it: every row twice, numbers as text.
    io.write_report(lim.unionAll(lim).select("retailer_sku", F.col("max_qty").cast("string").alias("max_qty")),
                    path, fmt="csv")
    return io.read_reference(spark, path, [("retailer_sku", "string"), ("max_qty", "int")],
                             required=["retailer_sku", "max_qty"])


def _sheet_export(lines, path, header: str, files: int = 3) -> None:
    """CSV files with a junk line and the header before the data lines."""
    def with_preamble(batches):
        """Nested, so that it travels with the task."""
        first = True
        for pdf in batches:
            if first and len(pdf):
                pdf, first = pd.concat([pd.DataFrame({"value": ['exported by the "sheet tool', header]}), pdf], ignore_index=True), False
            yield pdf

    lines.repartition(files).mapInPandas(with_preamble, "value string").write.mode("overwrite").text(path)


@register("csv_skiprows", """select c_custkey, c_name as name from customer""")
def csv_skiprows(spark, sf):
    """CSV files with a junk first line, then the header; every data line
    comes back exactly once."""
    path = io.scratch_path(spark, "csv-skip")
    c = spark.read.parquet(f"{sf}/customer.parquet")
    _sheet_export(c.select(F.concat_ws(",", F.col("c_custkey").cast("string"), "c_name", F.col("c_acctbal").cast("string")).alias("value")),
                  path, "c_custkey,c_name,c_acctbal")
    schema = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
                           T.StructField("c_acctbal", T.DoubleType())])
    out = io.read_csv_skip(spark, path, schema, skip_rows=1, header=True)
    return out.withColumnRenamed("c_name", "name").drop("c_acctbal")


@register("csv_quoted_breaks", r"""
select o_orderkey, concat('"', o_orderpriority, chr(10), '",', cast(o_custkey as varchar), chr(10)) as note, o_totalprice as total
from orders""")
def csv_quoted_breaks(spark, sf):
    """Values with quotes, separators and line breaks, in files of several
    splits; the header has a line break, too."""
    path = io.scratch_path(spark, "csv-breaks")
    o = spark.read.parquet(f"{sf}/orders.parquet")
    note = F.concat(F.lit('"""'), F.col("o_orderpriority"), F.lit('\n"",'), F.col("o_custkey").cast("string"), F.lit('\n"'))
    _sheet_export(o.select(F.concat_ws(",", F.col("o_orderkey").cast("string"), note, F.col("o_totalprice").cast("string")).alias("value")),
                  path, 'key,"the\nnote",total')
    schema = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("note", T.StringType()), T.StructField("total", T.DoubleType())])
    return io.read_csv_skip(spark, path, schema, quoted_breaks=True)


@register("sink_roundtrip", with_views("""
select shipment_id, shipment_number, total, shipped_at from v_shipment""", "v_shipment"))
def sink_roundtrip(spark, sf):
    path = io.scratch_path(spark, "report")
    s = V(spark, sf, "v_shipment").select("shipment_id", "shipment_number", "total", "shipped_at")
    io.write_report(s, path)
    return spark.read.parquet(path)


@register("split_manifest", with_views("""
select s.store_id, count(*) as n_rows from v_line_item li join v_shipment s using (shipment_id)
where li.deleted_at is null group by s.store_id""", "v_line_item", "v_shipment"))
def split_manifest(spark, sf):
    path = io.scratch_path(spark, "split")
    li = V(spark, sf, "v_line_item").where(F.col("deleted_at").isNull())
    s = V(spark, sf, "v_shipment").select("shipment_id", "store_id")
    io.write_split(li.join(s, "shipment_id").select("store_id", "offer_id", "quantity"), "store_id", path)
    return spark.read.parquet(path).groupBy("store_id").agg(F.count(F.lit(1)).alias("n_rows"))


@register("chunk_index", """
select o_orderkey, cast(floor((row_number() over (order by o_orderdate, o_orderkey) - 1) / 1000) as bigint) as chunk
from orders""")
def chunk_index(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", "o_orderdate")
    return io.with_chunk_index(o, ["o_orderdate", "o_orderkey"], 1000).select("o_orderkey", "chunk")


@register("full_refresh", jobs.ORACLE_FLAGSHIP)
def full_refresh(spark, sf):
    """Stage, validate, swap; the target then holds the flagship result."""
    from martlet.plans.mart import manager_gmv
    target = io.scratch_path(spark, "mart")
    io.refresh(manager_gmv(spark, sf).limit(1), target)
    return io.refresh(manager_gmv(spark, sf), target, required=["assigned_manager_id"])


@register("partition_refresh", jobs.ORACLE_FLAGSHIP)
def partition_refresh(spark, sf):
    """The flagship parted by year. A first publication holds wrong rows in
    three years and one year too many; a second replaces those and drops it."""
    from martlet.plans.mart import manager_gmv

    target = io.scratch_path(spark, "mart-years")
    rows = cut_lineage(manager_gmv(spark, sf).withColumn("year", F.year("month")), "gmv")
    wrong = F.col("year").isin(1993, 1995, 1996)
    first = rows.withColumn("gmv", F.when(wrong, 0.0).otherwise(F.col("gmv")))
    extra = rows.where("year = 1994").withColumn("year", F.lit(1901))
    io.refresh_partitions(first.unionByName(extra), target, "year", required=["assigned_manager_id"])
    return io.refresh_partitions(rows.where(wrong), target, "year", drop=["1901"]).drop("year")


@register("ledger_append", with_views(f"""
select distinct c.shipment_number, 'pulse_b' as process_name, {jobs.ASOF} as shipment_logged_at
from c join v_line_item li on li.shipment_id = c.shipment_id and li.deleted_at is null
join v_offer o on o.id = li.offer_id""", *jobs._PULSE_VIEWS, extra=[("c", jobs._cand_sql(jobs.NEW_ORDERS))]))
def ledger_append(spark, sf):
    """The report is appended twice; the second append adds nothing."""
    path = io.scratch_path(spark, "ledger")
    report = pulse.new_orders(pulse.Sources.fixture(spark, sf), jobs.NEW_ORDERS)
    io.append_ledger(report, path, jobs.NEW_ORDERS.process_name, AS_OF)
    return io.append_ledger(report, path, jobs.NEW_ORDERS.process_name, AS_OF)


@register("pulse_runs_once", ORACLE["pulse_new_orders"])
def pulse_runs_once(spark, sf):
    """R3 + S9: two runs of one pulse that overlap, the second of which finds
    what the first could not yet; and a third behind both. All reports together
    hold each shipment once."""
    target = io.scratch_path(spark, "runs")
    cfg = jobs.NEW_ORDERS
    report = cut_lineage(pulse.new_orders(pulse.Sources.fixture(spark, sf), cfg), "report")
    early = report.where(F.crc32("shipment_number") % 3 > 0)
    one = runs.begin(early, target, cfg.process_name)
    two = runs.begin(report, target, cfg.process_name)  # sees nothing of the first
    runs.finish(one, target)
    runs.finish(two, target)
    runs.report_once(report, target, cfg.process_name)
    first, *rest = runs.reports(spark, target, cfg.process_name)
    for r in rest:
        first = first.unionByName(r)
    return first


@register("delivery_manifest", with_views(f"""
select recipient, list_sort(list_distinct(list(report))) as reports, count(distinct item) as n_items from (
  select manager_email as recipient, shipment_number as item, 'new_orders' as report from no
  union all select manager_email, shipment_number, 'big_orders' from big) t group by recipient""",
                                          *jobs._PULSE_VIEWS, "v_locked_order",
                                          extra=[("dir", jobs._DIRECTORY),
                                                 ("c", jobs._cand_sql(
                                                     jobs.NEW_ORDERS)),
                                                 ("no", """select distinct c.shipment_number,
                                                    coalesce(d.manager_email, 'support@example.org') as manager_email
                                                    from c join v_line_item li on li.shipment_id = c.shipment_id and li.deleted_at is null
                                                    join v_offer o on o.id = li.offer_id left join dir d on d.company_id = c.company_id"""),
                                                 ("c2", jobs._cand_sql(
                                                     jobs.BIG_AND, slot=False)),
                                                 ("bal", jobs._bal_sql(
                                                     "select order_id from c2 where payment_state = 'balance_due'")),
                                                 ("big", """select distinct c2.shipment_number,
                                                    coalesce(d.manager_email, 'support@example.org') as manager_email
                                                    from c2 join v_line_item li on li.shipment_id = c2.shipment_id and li.deleted_at is null
                                                    left join dir d on d.company_id = c2.company_id
                                                    where """ + jobs._gate_sql("c2", "c2.company_id")
                                                  + " and li.price * li.quantity >= 50000 and c2.total >= 50000")]))
def delivery_manifest(spark, sf):
    src = pulse.Sources.fixture(spark, sf)
    new = pulse.new_orders(src, jobs.NEW_ORDERS)
    big = pulse.big_orders(src, jobs.BIG_AND)
    d = src.directory.select("company_id", "manager_email")
    big = big.join(d, "company_id", "left").fillna({"manager_email": jobs.NEW_ORDERS.fallback.email})
    return io.manifest({"new_orders": new, "big_orders": big}, "manager_email", "shipment_number")


@register("delivery_attachments", with_views("""
select 'report' as attachment, count(*) as n_rows from v_shipment where shipment_state = 'shipped'
union all select 'big', count(*) from v_shipment where shipment_state = 'shipped' and total >= 100000""", "v_shipment"))
def delivery_attachments(spark, sf):
    """The report goes with the big orders; the empty third frame stays out."""
    s = V(spark, sf, "v_shipment").where(F.col("shipment_state") == "shipped")
    sent = io.attachments([("report", s), ("big", s.where(F.col("total") >= 100000)), ("none", s.where(F.col("total") < 0))])
    out = None
    for name, df in sent:
        part = df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("attachment"), "n_rows")
        out = part if out is None else out.unionByName(part)
    return out
