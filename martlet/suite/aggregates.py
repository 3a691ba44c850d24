"""Registered queries: aggregates, windows, sort/reshape (2.4 - 2.6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from martlet.functions import text
from martlet.functions import time as tf
from martlet.operators import aggs, reshape, windows
from martlet.session import AS_OF
from martlet.sources.views import view, with_views
from martlet.suite.registry import register
from martlet.suite.sqlbits import ASOF, ld, month


def V(spark, sf, name):
    return view(spark, sf, name)


# ---------------------------------------------------------------- A1 - A4


@register("group_agg", with_views("""
select retailer_id, count(*) as n, sum(total) as total_sum, avg(total) as total_avg,
  min(total) as total_min, max(total) as total_max from v_shipment group by retailer_id""", "v_shipment"))
def group_agg(spark, sf):
    return V(spark, sf, "v_shipment").groupBy("retailer_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("total").alias("total_sum"), F.avg("total").alias("total_avg"),
        F.min("total").alias("total_min"), F.max("total").alias("total_max"))


@register("count_distinct", with_views("""
select store_id, count(distinct user_id) as n_users, count(distinct order_id) as n_orders
from v_shipment group by store_id""", "v_shipment"))
def count_distinct(spark, sf):
    return V(spark, sf, "v_shipment").groupBy("store_id").agg(
        F.count_distinct("user_id").alias("n_users"), F.count_distinct("order_id").alias("n_orders"))


@register("approx_distinct", with_views("""
select store_id, count(distinct user_id) as n_users, true as within_bound from v_shipment group by store_id""", "v_shipment"))
def approx_distinct(spark, sf):
    """A3 ``uniq``: HyperLogLog++ sketch, mergeable partial aggregates, held
    against the exact count: within five times its relative error. The two are
    aggregates of their own: in one, the exact count's first step would make a
    sketch for each user of a store."""
    error = 0.01
    s = V(spark, sf, "v_shipment").select("store_id", "user_id")
    exact = s.distinct().groupBy("store_id").agg(F.count("user_id").alias("n_users"))
    sketch = s.groupBy(F.col("store_id").alias("_store")).agg(F.approx_count_distinct("user_id", error).alias("_approx"))
    n, approx = F.col("n_users"), F.col("_approx")
    both = exact.join(sketch, F.col("store_id").eqNullSafe(F.col("_store")))
    return both.select("store_id", "n_users", (F.abs(approx - n) <= 5 * error * n).alias("within_bound"))


@register("conditional_agg", with_views("""
select user_id, coalesce(max(total) filter (where shipment_state = 'shipped'), 0) as max_shipped_total,
  count(distinct order_id) filter (where platform = 'web') as web_orders,
  avg(total) filter (where b2b_measure = 2) as avg_b2b_total,
  count(*) filter (where b2b_measure = 2) as b2b_cnt
from v_shipment group by user_id""", "v_shipment"))
def conditional_agg(spark, sf):
    s = V(spark, sf, "v_shipment")
    return s.groupBy("user_id").agg(
        aggs.agg_if("max", "total", F.col("shipment_state") == "shipped", 0.0).alias("max_shipped_total"),
        aggs.agg_if("count_distinct", "order_id", F.col("platform") == "web").alias("web_orders"),
        aggs.agg_if("avg", "total", F.col("b2b_measure") == 2).alias("avg_b2b_total"),
        F.count_if(F.col("b2b_measure") == 2).alias("b2b_cnt"))


# ---------------------------------------------------------------- A5 arg_min / arg_max


@register("arg_min", with_views("""
select company_group_id, arg_min(manager_id, (start_period, manager_id)) as first_manager_id
from v_manager_period group by company_group_id""", "v_manager_period"))
def arg_min(spark, sf):
    return V(spark, sf, "v_manager_period").groupBy("company_group_id").agg(
        aggs.arg_min("manager_id", F.struct("start_period", "manager_id")).alias("first_manager_id"))


@register("arg_max", with_views("""
select store_id, arg_max(phone, (shipped_at, shipment_id)) filter (where phone is not null) as last_phone
from v_shipment where shipped_at is not null group by store_id""", "v_shipment"))
def arg_max(spark, sf):
    s = V(spark, sf, "v_shipment").where(F.col("shipped_at").isNotNull())
    return s.groupBy("store_id").agg(aggs.arg_max("phone", F.struct("shipped_at", "shipment_id")).alias("last_phone"))


@register("latest_price", with_views("""
select offer_id, arg_max(price, dt) as price,
  arg_max(discount, dt) filter (where discount is not null) as discount, max(dt) as price_dt
from v_offer_price group by offer_id""", "v_offer_price"))
def latest_price(spark, sf):
    p = V(spark, sf, "v_offer_price")
    return p.groupBy("offer_id").agg(aggs.arg_max("price", "dt").alias("price"),
                                     aggs.arg_max("discount", "dt").alias("discount"),
                                     F.max("dt").alias("price_dt"))


# ---------------------------------------------------------------- A6 A7 A8


@register("collect_values", with_views("""
select user_id, list_sort(list_distinct(list(retailer_id))) as retailers,
  list_sort(list_distinct(list(platform))) as platforms from v_shipment group by user_id""", "v_shipment"))
def collect_values(spark, sf):
    return V(spark, sf, "v_shipment").groupBy("user_id").agg(
        F.array_sort(F.collect_set("retailer_id")).alias("retailers"),
        F.array_sort(F.collect_set("platform")).alias("platforms"))


@register("group_concat", with_views("""
select user_id, array_to_string(list_sort(list_distinct(list(case when value = '' then '78000000000' else value end))), ', ')
  as phones from v_phone group by user_id""", "v_phone"))
def group_concat(spark, sf):
    p = V(spark, sf, "v_phone").withColumn(
        "value", F.when(F.col("value") == "", F.lit("78000000000")).otherwise(F.col("value")))
    return p.groupBy("user_id").agg(aggs.group_concat("value", ", ").alias("phones"))


@register("having_filter", with_views("""
select user_id, count(*) as n_orders, sum(total) as total from v_shipment
group by user_id having count(*) >= 15 and sum(total) > 2000000""", "v_shipment"))
def having_filter(spark, sf):
    g = V(spark, sf, "v_shipment").groupBy("user_id").agg(F.count(F.lit(1)).alias("n_orders"),
                                                          F.sum("total").alias("total"))
    return g.where((F.col("n_orders") >= 15) & (F.col("total") > 2000000))


@register("array_any", with_views("""
select user_id, list_sort(list_distinct(list(retailer_id))) as retailers from v_shipment group by user_id
having list_has_any(list(retailer_id), [1, 7])""", "v_shipment"))
def array_any(spark, sf):
    g = V(spark, sf, "v_shipment").groupBy("user_id").agg(F.array_sort(F.collect_set("retailer_id")).alias("retailers"))
    return g.where(text.any_in("retailers", [1, 7]))


@register("array_has", with_views("""
select user_id, list_contains(list(platform), 'web') as has_web,
  len(list_filter(list(total), lambda x: x > 300000)) > 0 as has_big
from v_shipment group by user_id""", "v_shipment"))
def array_has(spark, sf):
    # Each list is a per-user set bounded by its distinct values; a large
    # list is never needed: has_big is the same as max(total) > 300000.
    g = V(spark, sf, "v_shipment").groupBy("user_id").agg(
        F.collect_set("platform").alias("platforms"), F.max("total").alias("_max_total"))
    return g.select("user_id", text.has("platforms", "web").alias("has_web"),
                    (F.col("_max_total") > 300000).alias("has_big"))


# ---------------------------------------------------------------- A9 A10 A18 A19


def _ret_sql(entity, extra_where, prefix):
    flags = [f"coalesce(bool_or(d > first_dt and d <= first_dt + 14), false) as {prefix}_14d"]
    for k in range(1, 12):
        flags.append(f"coalesce(bool_or(datediff('month', first_dt, d) = {k}), false) as {prefix}_{k + 1}m")
    return f"""
select {entity}, {', '.join(flags)} from (
  select {entity}, d, min(d) over (partition by {entity}) as first_dt from (
    select distinct {entity}, {ld('shipped_at')} as d from v_shipment s
    where {extra_where}) p) q
group by {entity}"""


@register("retention_phone", with_views(_ret_sql(
    "phone", "b2b_measure in (1, 2) and shipment_state = 'shipped' and phone is not null", "ret"), "v_shipment"))
def retention_phone(spark, sf):
    s = V(spark, sf, "v_shipment")
    base = (s.where(F.col("b2b_measure").isin(1, 2) & (F.col("shipment_state") == "shipped") & F.col("phone").isNotNull())
            .withColumn("d", tf.local_date("shipped_at")))
    return aggs.retention(base, "phone", "d")


@register("retention_group", with_views(_ret_sql(
    "company_group_id", "shipment_state = 'shipped' and company_group_id is not null", "group_ret").replace(
    "from v_shipment s", "from v_shipment s join v_user_group g using (user_id)"), "v_shipment", "v_user_group"))
def retention_group(spark, sf):
    s = V(spark, sf, "v_shipment").join(V(spark, sf, "v_user_group"), "user_id")
    base = (s.where((F.col("shipment_state") == "shipped") & F.col("company_group_id").isNotNull())
            .withColumn("d", tf.local_date("shipped_at")))
    return aggs.retention(base, "company_group_id", "d", prefix="group_ret")


@register("customer_value", with_views(f"""
select phone, first_order_dt, last_order_dt, user_gmv, user_order_cnt, user_active_months_count, user_age_month,
  case when user_active_months_count = 0 then null else user_order_cnt / user_active_months_count end as user_avg_orders_per_active_month,
  user_order_cnt / user_age_month as user_avg_orders_per_month, user_gmv / user_age_month as user_avg_arpu_per_month,
  user_gmv / user_order_cnt as user_aov
from (select phone, min(d) as first_order_dt, max(d) as last_order_dt, sum(gmv_goods_net_promo) as user_gmv,
  count(*) as user_order_cnt, count(distinct {month('d')}) as user_active_months_count,
  cast(greatest(coalesce(datediff('month', min(d), max(d)), 1), 1) as integer) as user_age_month
  from (select *, {ld('shipped_at')} as d from v_shipment
        where b2b_measure in (1, 2) and shipment_state = 'shipped' and phone is not null) s
  group by phone) t""", "v_shipment"))
def customer_value(spark, sf):
    s = V(spark, sf, "v_shipment")
    base = (s.where(F.col("b2b_measure").isin(1, 2) & (F.col("shipment_state") == "shipped") & F.col("phone").isNotNull())
            .withColumn("d", tf.local_date("shipped_at")))
    return aggs.customer_value(base, "phone", "d", "gmv_goods_net_promo")


@register("first_last_date", with_views(f"""
select phone, min({ld('shipped_at')}) as first_order_dt, max({ld('shipped_at')}) as last_order_dt
from v_shipment where phone is not null group by phone""", "v_shipment"))
def first_last_date(spark, sf):
    s = V(spark, sf, "v_shipment").where(F.col("phone").isNotNull()).withColumn("d", tf.local_date("shipped_at"))
    return aggs.first_last(s, "phone", "d")


@register("first_company", with_views("""
select s.user_id, arg_min(co.company_id, (s.completed_at, co.company_id)) as first_company_id,
  min(s.completed_at) as first_company_at
from v_shipment s join v_company_order co using (order_id) group by s.user_id""", "v_shipment", "v_company_order"))
def first_company(spark, sf):
    s = V(spark, sf, "v_shipment").select("user_id", "order_id", "completed_at")
    j = s.join(V(spark, sf, "v_company_order"), "order_id")
    return j.groupBy("user_id").agg(aggs.arg_min("company_id", F.struct("completed_at", "company_id")).alias("first_company_id"),
                                    F.min("completed_at").alias("first_company_at"))


# ---------------------------------------------------------------- A11 - A17


@register("min_monthly_orders", with_views(f"""
select user_id, min(n) as min_monthly_orders, count(*) as active_months from (
  select user_id, {month('completed_at')} as m, count(distinct order_id) as n from v_shipment group by user_id, m) t
group by user_id""", "v_shipment"))
def min_monthly_orders(spark, sf):
    s = V(spark, sf, "v_shipment")
    per_month = s.groupBy("user_id", tf.month_start("completed_at").alias("m")).agg(
        F.count_distinct("order_id").alias("n"))
    return per_month.groupBy("user_id").agg(F.min("n").alias("min_monthly_orders"),
                                            F.count(F.lit(1)).alias("active_months"))


@register("two_level_agg", with_views("""
select s.retailer_id, count(*) as n_shipments, sum(l.lines_total) as lines_total, avg(l.lines_total) as avg_lines_total
from (select shipment_id, sum(line_total) as lines_total from v_line_item group by shipment_id) l
join v_shipment s using (shipment_id) group by s.retailer_id""", "v_line_item", "v_shipment"))
def two_level_agg(spark, sf):
    l = V(spark, sf, "v_line_item").groupBy("shipment_id").agg(F.sum("line_total").alias("lines_total"))
    j = l.join(V(spark, sf, "v_shipment").select("shipment_id", "retailer_id"), "shipment_id")
    return j.groupBy("retailer_id").agg(F.count(F.lit(1)).alias("n_shipments"), F.sum("lines_total").alias("lines_total"),
                                        F.avg("lines_total").alias("avg_lines_total"))


@register("mean_nonzero", with_views("""
select user_id, coalesce(sum(payment_total) / nullif(count(*) filter (where payment_total <> 0), 0), 0) as avg_paid
from v_shipment group by user_id""", "v_shipment"))
def mean_nonzero(spark, sf):
    return V(spark, sf, "v_shipment").groupBy("user_id").agg(aggs.mean_nonzero("payment_total").alias("avg_paid"))


@register("mean_median", with_views("""
select platform, avg(total) / 1000000 as mean_total_m, median(total) / 1000000 as median_total_m,
  count(distinct user_id) as n_users from v_shipment group by platform""", "v_shipment"))
def mean_median(spark, sf):
    """Exact median per group, computed without gathering a group's values
    in one task (``aggs.exact_median``)."""
    s = V(spark, sf, "v_shipment")
    g = s.groupBy("platform").agg((F.avg("total") / 1_000_000).alias("mean_total_m"),
                                  F.count_distinct("user_id").alias("n_users"))
    med = aggs.exact_median(s, ["platform"], "total", "median_total").withColumn(
        "median_total_m", F.col("median_total") / 1_000_000).drop("median_total")
    return g.join(med, "platform", "left")


@register("stats_long", with_views("""
select * from (select 'max' as statistic, max(total) as value from v_shipment
  union all select 'min', min(total) from v_shipment
  union all select 'mean', avg(total) from v_shipment
  union all select 'median', median(total) from v_shipment) t""", "v_shipment"))
def stats_long(spark, sf):
    return aggs.stats_long(V(spark, sf, "v_shipment"), "total")


_SUM_COLS = ["gmv_goods_net_promo", "gmv_service_fee_net_promo", "gross_profit"]


@register("sum_columns", with_views("""
select retailer_id, sum(gmv_goods_net_promo) as gmv_goods_net_promo,
  sum(gmv_service_fee_net_promo) as gmv_service_fee_net_promo, sum(gross_profit) as gross_profit
from v_shipment group by retailer_id""", "v_shipment"))
def sum_columns(spark, sf):
    return aggs.sum_columns(V(spark, sf, "v_shipment"), _SUM_COLS, by=["retailer_id"])


@register("column_totals", with_views("""
select 'gmv_goods_net_promo' as "column", sum(gmv_goods_net_promo) as total from v_shipment
union all select 'gmv_service_fee_net_promo', sum(gmv_service_fee_net_promo) from v_shipment
union all select 'gross_profit', sum(gross_profit) from v_shipment""", "v_shipment"))
def column_totals(spark, sf):
    return aggs.sum_columns(V(spark, sf, "v_shipment"), _SUM_COLS, long=True)


@register("share_of_group", with_views("""
select platform, shipment_state, n,
  round_even(cast(100.0 * n / sum(n) over (partition by platform) as decimal(38, 10)), 2)::double as pct_of_group,
  round_even(cast(100.0 * n / sum(n) over () as decimal(38, 10)), 2)::double as pct_of_total
from (select platform, shipment_state, count(*) as n from v_shipment group by all) t""", "v_shipment"))
def share_of_group(spark, sf):
    counts = V(spark, sf, "v_shipment").groupBy("platform", "shipment_state").agg(F.count(F.lit(1)).alias("n"))
    return aggs.share(counts, ["platform"], "n")


@register("balance_due_grouped", with_views("""
select order_id, case when count(distinct payment_total) = 1 then max(payment_total) else sum(payment_total) end
  as payment_total_corrected, sum(total) as sum_total
from v_shipment where payment_state = 'balance_due' group by order_id
having sum(total) - case when count(distinct payment_total) = 1 then max(payment_total) else sum(payment_total) end <= 1000""",
                                            "v_shipment"))
def balance_due_grouped(spark, sf):
    s = V(spark, sf, "v_shipment").where(F.col("payment_state") == "balance_due")
    return aggs.balance_due_grouped(s, "order_id", "payment_total", "total")


@register("balance_due_window", with_views("""
select distinct order_id from (
  select order_id, case when n_paid > 1 then sum_paid else payment_total end as paid, sum_total from (
    select s.order_id, s.payment_total, d.n_paid,
      sum(s.payment_total) over (partition by s.order_id) as sum_paid, sum(s.total) over (partition by s.order_id) as sum_total
    from v_shipment s join (select order_id, count(distinct payment_total) as n_paid from v_shipment
      where payment_state = 'balance_due' group by order_id) d using (order_id)
    where s.payment_state = 'balance_due') a) b
where sum_total - paid <= 1000""", "v_shipment"))
def balance_due_window(spark, sf):
    s = V(spark, sf, "v_shipment").where(F.col("payment_state") == "balance_due")
    return windows.balance_due_window(s, "order_id", "payment_total", "total")


# ---------------------------------------------------------------- A21 - A23


@register("histogram", with_views("""
select bin, count(*) as n, min(lo) as range_lo, max(hi) as range_hi from (
  select cast(case when hi = lo then 1 else least(floor((total - lo) / (hi - lo) * 70) + 1, 70) end as integer) as bin, lo, hi
  from v_shipment, (select min(total) as lo, max(total) as hi from v_shipment) r where total is not null) t
group by bin""", "v_shipment"))
def histogram(spark, sf):
    return aggs.histogram(V(spark, sf, "v_shipment"), "total", 70)


@register("net_amount", with_views("""
select shipment_id, offer_id, supplier_id, (1 - vat_rate / 100) * price * quantity as net_amount from v_line_item""",
                                   "v_line_item"))
def net_amount(spark, sf):
    li = V(spark, sf, "v_line_item")
    return li.select("shipment_id", "offer_id", "supplier_id",
                     ((1 - F.col("vat_rate") / 100) * F.col("price") * F.col("quantity")).alias("net_amount"))


@register("majority_share", with_views("""
select user_id, avg(case when platform = 'web' then 1.0 else 0.0 end) as share from v_shipment
group by user_id having avg(case when platform = 'web' then 1.0 else 0.0 end) >= 0.5""", "v_shipment"))
def majority_share(spark, sf):
    return aggs.majority(V(spark, sf, "v_shipment"), ["user_id"], "platform", "web", 0.5)


# ---------------------------------------------------------------- W1 W2 W4


@register("distinct_over_window", with_views("""
select s.shipment_id, s.order_id, d.n as n_payment_values
from v_shipment s join (select order_id, count(distinct payment_total) as n from v_shipment group by order_id) d using (order_id)""",
                                             "v_shipment"))
def distinct_over_window(spark, sf):
    s = V(spark, sf, "v_shipment")
    return windows.with_n_distinct(s, "payment_total", "order_id", "n_payment_values").select(
        "shipment_id", "order_id", "n_payment_values")


@register("window_sum", with_views("""
select shipment_id, order_id, sum(total) over (partition by order_id) as order_total from v_shipment""", "v_shipment"))
def window_sum(spark, sf):
    s = V(spark, sf, "v_shipment")
    return windows.sum_over(s, "total", "order_id", "order_total").select("shipment_id", "order_id", "order_total")


@register("group_min_per_row", with_views("""
select shipment_id, retailer_id, total, min(total) over (partition by retailer_id, store_id) as store_min_total
from v_shipment""", "v_shipment"))
def group_min_per_row(spark, sf):
    s = V(spark, sf, "v_shipment")
    return windows.agg_over(s, "min", "total", ["retailer_id", "store_id"], "store_min_total").select(
        "shipment_id", "retailer_id", "total", "store_min_total")


# ---------------------------------------------------------------- T1 - T7


@register("multi_sort", with_views("""
select retailer_id, store_id, shipment_id, total from v_shipment order by retailer_id asc, total desc, shipment_id asc""",
                                   "v_shipment"))
def multi_sort(spark, sf):
    s = V(spark, sf, "v_shipment").select("retailer_id", "store_id", "shipment_id", "total")
    return reshape.sort(s, [("retailer_id", "asc"), ("total", "desc"), ("shipment_id", "asc")])


# Declared display order of the turnover buckets.
from martlet.suite.basics import GMV_EDGES, GMV_LABELS, _bucket_sql  # noqa: E402


@register("label_order_sort", with_views(f"""
select gmv_group, label_rank, count(*) as n from (
  select {_bucket_sql('gmv')} as gmv_group,
    cast(list_position({GMV_LABELS!r}, {_bucket_sql('gmv')}) as integer) as label_rank from g) t
where gmv_group is not null group by all having count(*) > 0 order by label_rank""",
                                         "v_shipment", extra=[("g", "select user_id, sum(total) - 150000 as gmv from v_shipment group by user_id")]))
def label_order_sort(spark, sf):
    from martlet.functions.rules import bucketize
    g = V(spark, sf, "v_shipment").groupBy("user_id").agg((F.sum("total") - 150000).alias("gmv"))
    b = g.select(bucketize("gmv", GMV_EDGES, GMV_LABELS).alias("gmv_group")).where(F.col("gmv_group").isNotNull())
    c = b.groupBy("gmv_group").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 0)
    return c.withColumn("label_rank", reshape.label_rank("gmv_group", GMV_LABELS)).orderBy("label_rank")


@register("top_k_groups", with_views(f"""
select upper(concat('store_', cast(store_id as varchar))) as store, count(distinct order_id) as n_orders
from v_shipment where completed_at > {ASOF} - interval 1 month and completed_at <= {ASOF}
group by store_id order by n_orders desc, store limit 10""", "v_shipment"))
def top_k_groups(spark, sf):
    asof = tf.ts_lit(AS_OF)
    s = (V(spark, sf, "v_shipment").where(tf.lookback("completed_at", asof, "1 month") & (F.col("completed_at") <= asof))
         .withColumn("store", F.upper(F.concat(F.lit("store_"), F.col("store_id").cast("string")))))
    return reshape.top_k(s, "store", F.count_distinct("order_id"), k=10, name="n_orders")


@register("limit_n", with_views("""
select shipment_id, user_id, total from v_shipment order by user_id, shipment_id limit 100""", "v_shipment"))
def limit_n(spark, sf):
    s = V(spark, sf, "v_shipment").select("shipment_id", "user_id", "total")
    return s.orderBy("user_id", "shipment_id").limit(100)


@register("union_all", with_views("""
select user_id, order_seq as order_number, completed_at as backend_order_completed_at, 'web' as source from v_funnel_web
union all
select user_id, order_seq, completed_at, 'app' from v_funnel_app""", "v_funnel_web", "v_funnel_app"))
def union_all(spark, sf):
    ren = {"order_seq": "order_number", "completed_at": "backend_order_completed_at"}
    return reshape.union_feeds([V(spark, sf, "v_funnel_web"), V(spark, sf, "v_funnel_app")], [ren, ren],
                               tags=["web", "app"])


_TRANSPOSE_G = "select platform, cast(count(*) as double) as n, avg(total) as avg_total from v_shipment group by platform"


@register("transpose_small", with_views("""
select 'n' as key, max(n) filter (where platform = 'app') as app, max(n) filter (where platform = 'web') as web from g
union all
select 'avg_total', max(avg_total) filter (where platform = 'app'), max(avg_total) filter (where platform = 'web') from g""",
                                        "v_shipment", extra=[("g", _TRANSPOSE_G)]))
def transpose_small(spark, sf):
    """Per-platform statistics, one column per platform (the header
    values become column names, so the result must stay small)."""
    s = V(spark, sf, "v_shipment").groupBy("platform").agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.avg("total").alias("avg_total"))
    return reshape.transpose_small(s, "platform")


@register("route_split", with_views("""
select shipment_id, 'paper' as route from v_shipment where payment_method_name = 'invoice' or total_weight > 80000
union all
select shipment_id, 'regular' from v_shipment where not (payment_method_name = 'invoice' or total_weight > 80000)""",
                                    "v_shipment"))
def route_split(spark, sf):
    s = V(spark, sf, "v_shipment").select("shipment_id", "payment_method_name", "total_weight")
    paper, regular = reshape.route(s, (F.col("payment_method_name") == "invoice") | (F.col("total_weight") > 80000))
    return (paper.select("shipment_id", F.lit("paper").alias("route"))
            .unionByName(regular.select("shipment_id", F.lit("regular").alias("route"))))


