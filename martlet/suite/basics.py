"""Registered queries: projection, predicates, classification, scalar
functions (sections 2.2 and 2.7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from martlet.functions import rules, text
from martlet.functions import time as tf
from martlet.operators import windows
from martlet.session import AS_OF
from martlet.sources.tables import scan
from martlet.sources.views import view, with_views
from martlet.suite.registry import register
from martlet.suite.sqlbits import ASOF, ld, lts, month

def _asof():
    return tf.ts_lit(AS_OF)


def V(spark, sf, name):
    return view(spark, sf, name)


# ---------------------------------------------------------------- S1 / P1 / P2


@register("scan_filter_project", """
select o_orderkey, o_custkey, o_totalprice from orders
where o_orderdate >= timestamp '1997-01-01 00:00:00' and o_orderstatus = 'F'""")
def scan_filter_project(spark, sf):
    return scan(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_totalprice"],
                (F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
                & (F.col("o_orderstatus") == "F"))


@register("project_rename", with_views("""
select shipment_number as number, shipment_id, total as order_total, retailer_id from v_shipment""",
                                       "v_shipment"))
def project_rename(spark, sf):
    return (V(spark, sf, "v_shipment").select("shipment_number", "shipment_id", "total", "retailer_id")
            .withColumnsRenamed({"shipment_number": "number", "total": "order_total"}))


@register("conform_types", with_views("""
select cast(shipment_id as bigint) as shipment_id, cast(b2b_measure as smallint) as b2b_measure,
  cast(total as float) as total_f32, cast(total_weight as integer) as total_weight,
  coalesce(phone, '') as phone, cast(shipped_at as date) as shipped_date
from v_shipment""", "v_shipment"))
def conform_types(spark, sf):
    from martlet.plans.mart import conform

    schema = [("shipment_id", "bigint"), ("b2b_measure", "smallint"), ("total_f32", "float"), ("total_weight", "int"),
              ("phone", "string"), ("shipped_date", "date")]
    s = V(spark, sf, "v_shipment").withColumns({"total_f32": F.col("total"), "shipped_date": F.col("shipped_at")})
    return conform(s, schema, {"phone": ""})


# ---------------------------------------------------------------- P3 duplicates


@register("distinct_rows", with_views("""
select distinct retailer_id, store_id, platform from v_shipment""", "v_shipment"))
def distinct_rows(spark, sf):
    return V(spark, sf, "v_shipment").select("retailer_id", "store_id", "platform").distinct()


@register("dedupe_subset", with_views("""
select shipment_id, offer_id, quantity from (
  select shipment_id, offer_id, quantity,
         row_number() over (partition by shipment_id, offer_id order by quantity desc, price desc, supplier_id) as rn
  from v_line_item) t where rn = 1""", "v_line_item"))
def dedupe_subset(spark, sf):
    li = V(spark, sf, "v_line_item")
    li = li.select("shipment_id", "offer_id", "quantity", "price", "supplier_id")
    return windows.dedupe(li, ["shipment_id", "offer_id"],
                          [("quantity", "desc"), ("price", "desc"), ("supplier_id", "asc")]
                          ).select("shipment_id", "offer_id", "quantity")


@register("flag_duplicates", with_views("""
select shipment_id, offer_id, supplier_id, quantity,
  row_number() over (partition by shipment_id, offer_id order by supplier_id, quantity) > 1 as is_duplicate
from v_line_item""", "v_line_item"))
def flag_duplicates(spark, sf):
    li = V(spark, sf, "v_line_item").select("shipment_id", "offer_id", "supplier_id", "quantity")
    return windows.flag_dups(li, ["shipment_id", "offer_id"], [("supplier_id", "asc"), ("quantity", "asc")])


# ---------------------------------------------------------------- P4 P5 P6 P7


@register("active_only", with_views("""
select id, name, price from v_offer where deleted_at is null and published = 1 and status = 1""", "v_offer"))
def active_only(spark, sf):
    o = V(spark, sf, "v_offer")
    return (o.where(F.col("deleted_at").isNull() & (F.col("published") == 1) & (F.col("status") == 1))
            .select("id", "name", "price"))


@register("in_list", with_views("""
select shipment_id, retailer_id, shipment_state from v_shipment
where retailer_id in (1, 3, 5) and shipment_state not in ('canceled')""", "v_shipment"))
def in_list(spark, sf):
    s = V(spark, sf, "v_shipment")
    return (s.where(F.col("retailer_id").isin(1, 3, 5) & ~F.col("shipment_state").isin("canceled"))
            .select("shipment_id", "retailer_id", "shipment_state"))


@register("local_date_range", with_views(f"""
select shipment_id, coalesce({ld('shipped_at')}, {ld('starts_at')}) as shipped_dt from v_shipment
where coalesce({ld('shipped_at')}, {ld('starts_at')}) between date '1997-03-01' and date '1997-06-30'""",
                                         "v_shipment"))
def local_date_range(spark, sf):
    s = V(spark, sf, "v_shipment")
    return (s.where(tf.between_local("shipped_at", "1997-03-01", "1997-06-30", fallback="starts_at"))
            .select("shipment_id", tf.local_date_or("shipped_at", "starts_at").alias("shipped_dt")))


@register("like_any_flag", with_views("""
select company_id, case when lower(manager_comment) like '%test%' or lower(manager_comment) like '%fraud%'
  then 1 when manager_comment is null then null else 0 end as fraud_flg
from v_company""", "v_company"))
def like_any_flag(spark, sf):
    c = V(spark, sf, "v_company")
    return c.select("company_id", rules.like_any("manager_comment", ["%test%", "%fraud%"]).cast("int").alias("fraud_flg"))


# ---------------------------------------------------------------- P8 classification


@register("payment_type", with_views("""
select company_id, case when deposit_flg then 'Deposit' when postpay_flg then 'Postpay'
  when prepay_flg then 'Prepay (contract)' else 'Prepay (offer)' end as payment_type from v_company""",
                                     "v_company"))
def payment_type(spark, sf):
    c = V(spark, sf, "v_company")
    return c.select("company_id", rules.payment_type("deposit_flg", "postpay_flg", "prepay_flg").alias("payment_type"))


_COMPANY_TYPE_SQL = """case when s.b2b_measure = 1 then 'TICKS' when s.b2b_measure = 4 then 'B2B_CERT'
  when s.b2b_measure = 3 then 'B2B2B_RETAIL' when coalesce(c.category_type, '') = '' then 'NA'
  when c.category_type = 'Government' then 'GOVERNMENT' when c.category_type = 'Charity' then 'CHARITY'
  when lower(c.name) like '%ип %' or lower(c.name) like '%индивидуальный предприниматель%' then 'INDIVIDUAL'
  when c.finance_income is null then 'NO_FIN_DATA'
  when c.finance_income >= 2000000001 or c.employee_count >= 251 then 'LARGE'
  when c.finance_income between 800000001 and 2000000000 or c.employee_count between 101 and 250 then 'MEDIUM'
  when c.finance_income between 120000001 and 800000000 or c.employee_count between 16 and 100 then 'SMALL'
  when c.finance_income <= 120000000 or c.employee_count <= 15 then 'MICRO' else 'other' end"""


@register("company_type", with_views(f"""
select s.shipment_id, {_COMPANY_TYPE_SQL} as company_type
from v_shipment s left join v_company c on s.company_inn = c.inn""", "v_shipment", "v_company"))
def company_type(spark, sf):
    s = V(spark, sf, "v_shipment").select("shipment_id", "b2b_measure", "company_inn")
    c = V(spark, sf, "v_company").select(F.col("inn").alias("company_inn"), "name", "category_type",
                                         "finance_income", "employee_count")
    j = s.join(c, "company_inn", "left")
    return j.select("shipment_id", rules.company_type("b2b_measure", F.coalesce("category_type", F.lit("")),
                                                      "name", "finance_income", "employee_count").alias("company_type"))


# Specification of the channels: tenant, platform, measure and company flag ('*':
# any). No two rows fit the same order, so their sequence means nothing.
CHANNEL_SPEC = (
    ("*", "*", "0", "*", "used certificates b2c"), ("*", "*", "3", "*", "third-party orders"), ("*", "*", "4", "*", "certificates"),
    ("*", "app", "1", "*", "with tick app"), ("*", "app", "2", "0", "for self with company app"),
    ("*", "app", "2", "1", "for business with company app"), ("tenant_b2b", "web", "2", "*", "b2b web"),
    ("tenant_main", "web", "1", "*", "with tick b2c web"), ("tenant_main", "web", "2", "0", "for self with company b2c web"),
    ("tenant_main", "web", "2", "1", "for business with company b2c web"),
    ("tenant_wl", "web", "1", "*", "white label"), ("tenant_wl", "web", "2", "*", "white label"),
)


def channel_sql(t: str) -> str:
    """Oracle subquery: the specification's label of the order of alias ``t``."""
    rows = ", ".join(str(r) for r in CHANNEL_SPEC)
    fits = " and ".join(f"(spec.{c} = '*' or spec.{c} = cast({t}.{x} as varchar))" for c, x in (
        ("tenant", "tenant_id"), ("platform", "platform"), ("measure", "b2b_measure"), ("flag", "b2b_order_company_flg")))
    return f"coalesce((select label from (values {rows}) spec(tenant, platform, measure, flag, label) where {fits}), 'other')"


@register("order_channel", with_views(f"select shipment_id, {channel_sql('s')} as order_type from v_shipment s", "v_shipment"))
def order_channel(spark, sf):
    s = V(spark, sf, "v_shipment")
    return s.select("shipment_id", rules.order_channel("tenant_id", "platform", "b2b_measure",
                                                       "b2b_order_company_flg").alias("order_type"))


@register("new_or_repeat", with_views("""
select s.shipment_id, case when f.first_id = s.shipment_id then 'new' else 'repeat' end as new_or_repeat
from v_shipment s left join (
  select user_id, arg_min(shipment_id, (completed_at, shipment_id)) as first_id from v_shipment group by user_id
) f using (user_id)""", "v_shipment"))
def new_or_repeat(spark, sf):
    from martlet.operators.aggs import arg_min
    s = V(spark, sf, "v_shipment")
    first = s.groupBy("user_id").agg(arg_min("shipment_id", F.struct("completed_at", "shipment_id")).alias("first_id"))
    return (s.join(first, "user_id", "left")
            .select("shipment_id", rules.new_or_repeat("first_id", "shipment_id").alias("new_or_repeat")))


@register("row_label", with_views("""
select shipment_id, case when creator = owner and creator <> 0 then 'No'
  when creator <> owner and creator <> 0 then 'Yes'
  when creator = 0 and len(users) > 0 and owner <> users[1] then 'Maybe' end as label
from (select shipment_id, cast(store_id % 3 as bigint) as creator, cast(retailer_id % 3 as bigint) as owner,
  case when shipment_id % 4 = 0 then [] else [cast(user_id % 3 as bigint), cast(user_id % 5 as bigint)] end as users
  from v_shipment) t""", "v_shipment"))
def row_label(spark, sf):
    s = V(spark, sf, "v_shipment").select(
        "shipment_id", (F.col("store_id") % 3).cast("bigint").alias("creator"),
        (F.col("retailer_id") % 3).cast("bigint").alias("owner"),
        F.when(F.col("shipment_id") % 4 == 0, F.array().cast("array<bigint>"))
        .otherwise(F.array((F.col("user_id") % 3), (F.col("user_id") % 5))).alias("users"))
    return s.select("shipment_id", rules.row_label("creator", "owner", "users").alias("label"))


# ---------------------------------------------------------------- P10 P11 P12 P13


@register("fill_defaults", with_views("""
select shipment_id, coalesce(phone, '') as phone, coalesce(shipped_at, starts_at) as shipped_at,
  coalesce(c.picking_costs, 0) as picking_costs
from v_shipment s left join v_order_cost c using (shipment_id)""", "v_shipment", "v_order_cost"))
def fill_defaults(spark, sf):
    s = V(spark, sf, "v_shipment").select("shipment_id", "phone", "shipped_at", "starts_at")
    c = V(spark, sf, "v_order_cost").select("shipment_id", "picking_costs")
    j = s.join(c, "shipment_id", "left")
    j = rules.fill_defaults(j, {"phone": "", "picking_costs": 0.0})
    return j.select("shipment_id", "phone", F.coalesce("shipped_at", "starts_at").alias("shipped_at"),
                    "picking_costs")


@register("lookback_window", with_views(f"""
select shipment_id, completed_at from v_shipment
where completed_at > {ASOF} - interval 30 day and completed_at <= {ASOF}""", "v_shipment"))
def lookback_window(spark, sf):
    s = V(spark, sf, "v_shipment")
    return (s.where(tf.lookback("completed_at", _asof(), "30 days") & (F.col("completed_at") <= _asof()))
            .select("shipment_id", "completed_at"))


@register("next_business_day", with_views("""
select id, cast(starts_at as date) as slot_date,
  cast(starts_at as date) + cast(case when isodow(starts_at) - 1 = 4 then 3 else 1 end as integer) as next_day
from v_delivery_window""", "v_delivery_window"))
def next_business_day(spark, sf):
    w = V(spark, sf, "v_delivery_window")
    return w.select("id", F.to_date("starts_at").alias("slot_date"),
                    tf.next_business_day("starts_at").alias("next_day"))


@register("monday_lookback", with_views("""
select id, starts_at, case when isodow(starts_at) = 1 and hour(starts_at) = 0
  then starts_at - interval 49 hour else starts_at - interval 1 hour end as window_start
from v_delivery_window""", "v_delivery_window"))
def monday_lookback(spark, sf):
    w = V(spark, sf, "v_delivery_window")
    return w.select("id", "starts_at", tf.hourly_lookback("starts_at").alias("window_start"))


# ---------------------------------------------------------------- P14 thresholds


def _line_with_shipment(spark, sf):
    li = V(spark, sf, "v_line_item").where(F.col("deleted_at").isNull())
    s = V(spark, sf, "v_shipment").select("shipment_id", "shipment_number", "total")
    return li.join(s, "shipment_id", "inner").withColumn("sku_total", F.col("price") * F.col("quantity"))


_LINE_SQL = """select li.*, s.shipment_number, s.total, li.price * li.quantity as sku_total
  from v_line_item li join v_shipment s using (shipment_id) where li.deleted_at is null"""


@register("big_order_and", with_views("""
select shipment_number, offer_id, sku_total, total from l where sku_total >= 50000 and total >= 50000""",
                                      "v_line_item", "v_shipment", extra=[("l", _LINE_SQL)]))
def big_order_and(spark, sf):
    l = _line_with_shipment(spark, sf)
    return (l.where(rules.big_order("sku_total", "total", 50000, 50000, "and"))
            .select("shipment_number", "offer_id", "sku_total", "total"))


@register("big_order_or", with_views("""
select shipment_number, offer_id, sku_total, total from l where sku_total >= 100000 or total >= 200000""",
                                     "v_line_item", "v_shipment", extra=[("l", _LINE_SQL)]))
def big_order_or(spark, sf):
    l = _line_with_shipment(spark, sf)
    return (l.where(rules.big_order("sku_total", "total", 100000, 200000, "or"))
            .select("shipment_number", "offer_id", "sku_total", "total"))


@register("over_limit", with_views("""
select l.shipment_number, o.retailer_sku, l.quantity, lim.max_qty
from l join v_offer o on o.id = l.offer_id join v_offer_limit lim on lim.retailer_sku = o.retailer_sku
where lim.max_qty is not null and l.quantity > lim.max_qty""",
                                   "v_line_item", "v_shipment", "v_offer", "v_offer_limit", extra=[("l", _LINE_SQL)]))
def over_limit(spark, sf):
    l = _line_with_shipment(spark, sf)
    o = V(spark, sf, "v_offer").select(F.col("id").alias("offer_id"), "retailer_sku")
    lim = V(spark, sf, "v_offer_limit").dropna(subset=["max_qty"])
    return (l.join(o, "offer_id").join(lim, "retailer_sku")
            .where(F.col("quantity") > F.col("max_qty"))
            .select("shipment_number", "retailer_sku", "quantity", "max_qty"))


# ---------------------------------------------------------------- P15 P16 P17


@register("pay_gate", with_views("""
select shipment_id, (payment_state in ('paid', 'overpaid') or coalesce(payment_method_id in (4, 11, 12, 20), false)
  or (payment_state = 'balance_due' and total - payment_total <= 1000)) as pay_ok,
  payment_state not in ('not_paid', 'failed') as state_ok
from v_shipment""", "v_shipment"))
def pay_gate(spark, sf):
    s = V(spark, sf, "v_shipment")
    bal = (F.col("payment_state") == "balance_due") & (F.col("total") - F.col("payment_total") <= 1000)
    return s.select("shipment_id", rules.pay_gate("payment_state", "payment_method_id", bal).alias("pay_ok"),
                    rules.state_gate("payment_state").alias("state_ok"))


@register("remap_values", with_views("""
select shipment_id, case shipment_state when 'shipped' then 'done' when 'canceled' then 'void'
  else shipment_state end as state_label,
  case platform when 'web' then 1 when 'app' then 2 else 0 end as platform_code
from v_shipment""", "v_shipment"))
def remap_values(spark, sf):
    s = V(spark, sf, "v_shipment")
    return s.select("shipment_id",
                    rules.remap("shipment_state", {"shipped": "done", "canceled": "void"}).alias("state_label"),
                    rules.remap("platform", {"web": 1, "app": 2}, default=0, keep_unmapped=False).alias("platform_code"))


# ---------------------------------------------------------------- P19 buckets, P20, P21

# The base turnover buckets (left-closed edges) and their labels.
from martlet.plans.seller import GMV_EDGES, GMV_LABELS  # noqa: E402


def _bucket_sql(col, null_first=False):
    parts = []
    for i, lab in enumerate(GMV_LABELS):
        lo, hi = GMV_EDGES[i], GMV_EDGES[i + 1]
        up = "" if hi == float("inf") else f" and {col} < {hi}"
        if i == 0 and null_first:
            parts.append(f"when {col} is null or {col} < {hi} then '{lab}'")
        else:
            parts.append(f"when {col} >= {lo}{up} then '{lab}'")
    return "case " + " ".join(parts) + " end"


_CUST_GMV = "select user_id, sum(total) - 150000 as gmv from v_shipment group by user_id"


@register("bucketize", with_views(f"""
select user_id, gmv, {_bucket_sql('gmv')} as gmv_group from g""", "v_shipment", extra=[("g", _CUST_GMV)]))
def bucketize(spark, sf):
    g = V(spark, sf, "v_shipment").groupBy("user_id").agg((F.sum("total") - 150000).alias("gmv"))
    return g.select("user_id", "gmv", rules.bucketize("gmv", GMV_EDGES, GMV_LABELS).alias("gmv_group"))


@register("bucketize_null_first", with_views(f"""
select user_id, gmv, {_bucket_sql('gmv', True)} as gmv_group from (
  select user_id, case when user_id % 7 = 0 then null else gmv end as gmv from g) t""",
                                             "v_shipment", extra=[("g", _CUST_GMV)]))
def bucketize_null_first(spark, sf):
    g = V(spark, sf, "v_shipment").groupBy("user_id").agg((F.sum("total") - 150000).alias("gmv"))
    g = g.withColumn("gmv", F.when(F.col("user_id") % 7 == 0, None).otherwise(F.col("gmv")))
    return g.select("user_id", "gmv", rules.bucketize("gmv", GMV_EDGES, GMV_LABELS, null_to_first=True).alias("gmv_group"))


@register("safe_date", """
select o_orderkey, cast(try_cast(case when o_orderkey % 9 = 0 then 'not a date'
  else strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') end as timestamp) as date) as order_day from orders""")
def safe_date(spark, sf):
    o = scan(spark, sf, "orders", ["o_orderkey", "o_orderdate"])
    txt = F.when(F.col("o_orderkey") % 9 == 0, F.lit("not a date")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    return o.select("o_orderkey", tf.safe_date(txt).alias("order_day"))


@register("label_vs_first_rows", with_views("""
select s.shipment_id, s.retailer_id, case when s.retailer_id <> f.r1 and s.retailer_id <> f.r2
  and s.platform = 'web' then 'YES' else 'NO' end as comment
from v_shipment s, (select min_by(retailer_id, shipment_id) as r1,
  min_by(retailer_id, shipment_id) filter (where shipment_id > (select min(shipment_id) from v_shipment)) as r2
  from v_shipment) f""", "v_shipment"))
def label_vs_first_rows(spark, sf):
    from martlet.operators.aggs import with_scalars
    s = V(spark, sf, "v_shipment")
    # First two rows of the frame ordered by shipment_id, as a one-row aggregate.
    first = s.agg(F.min("shipment_id").alias("_k1"))
    tops = with_scalars(s.select("shipment_id", "retailer_id"), first).agg(
        F.min_by("retailer_id", "shipment_id").alias("r1"),
        F.min_by(F.when(F.col("shipment_id") > F.col("_k1"), F.col("retailer_id")),
                 F.when(F.col("shipment_id") > F.col("_k1"), F.col("shipment_id"))).alias("r2"))
    j = with_scalars(s, tops)
    cond = (F.col("retailer_id") != F.col("r1")) & (F.col("retailer_id") != F.col("r2")) & (F.col("platform") == "web")
    return j.select("shipment_id", "retailer_id",
                    F.when(cond, "YES").otherwise("NO").alias("comment"))


# ---------------------------------------------------------------- scalar functions (2.7)


@register("local_date", with_views(f"""
select shipment_id, {ld('shipped_at')} as local_day, {lts('completed_at')} as local_completed
from v_shipment""", "v_shipment"))
def local_date(spark, sf):
    s = V(spark, sf, "v_shipment")
    return s.select("shipment_id", tf.local_date("shipped_at").alias("local_day"),
                    tf.local_ts("completed_at").alias("local_completed"))


@register("month_start", with_views(f"""
select shipment_id, {month(ld('completed_at'))} as month_start from v_shipment""", "v_shipment"))
def month_start(spark, sf):
    s = V(spark, sf, "v_shipment")
    return s.select("shipment_id", tf.month_start(tf.local_date("completed_at")).alias("month_start"))


@register("week_start", with_views("""
select shipment_id, cast(date_trunc('week', completed_at) as date) as week_start from v_shipment""", "v_shipment"))
def week_start(spark, sf):
    return V(spark, sf, "v_shipment").select("shipment_id", tf.week_start("completed_at").alias("week_start"))


@register("prior_full_week", """
select o_orderkey, cast(date_trunc('week', o_orderdate) as date) - 7 as prior_week_start from orders""")
def prior_full_week(spark, sf):
    o = scan(spark, sf, "orders", ["o_orderkey", "o_orderdate"])
    return o.select("o_orderkey", tf.prior_full_week("o_orderdate").alias("prior_week_start"))


@register("month_number", with_views("""
select shipment_id, month(completed_at) as month_no, year(completed_at) * 100 + month(completed_at) as year_month
from v_shipment""", "v_shipment"))
def month_number(spark, sf):
    s = V(spark, sf, "v_shipment")
    return s.select("shipment_id", F.month("completed_at").alias("month_no"),
                    (F.year("completed_at") * 100 + F.month("completed_at")).alias("year_month"))


@register("months_diff", with_views(f"""
select shipment_id, cast(datediff('month', date '1995-01-31', completed_at) as integer) as months
from v_shipment""", "v_shipment"))
def months_diff(spark, sf):
    s = V(spark, sf, "v_shipment")
    return s.select("shipment_id", tf.months_diff(F.lit("1995-01-31").cast("date"), "completed_at").alias("months"))


@register("date_shift", with_views("""
select shipment_id, cast(completed_at as date) + 14 as plus_14d,
  cast(cast(completed_at as date) + interval 1 month as date) as plus_1m,
  completed_at - interval 3 hour as minus_3h
from v_shipment""", "v_shipment"))
def date_shift(spark, sf):
    s = V(spark, sf, "v_shipment")
    d = F.to_date("completed_at")
    return s.select("shipment_id", F.date_add(d, 14).alias("plus_14d"), F.add_months(d, 1).alias("plus_1m"),
                    (F.col("completed_at") - F.expr("interval 3 hours")).alias("minus_3h"))


@register("format_period", with_views("""
select shipment_id, strftime(completed_at, '%Y-%m') as ym, strftime(completed_at, '%Y-%m-%d') as ymd
from v_shipment""", "v_shipment"))
def format_period(spark, sf):
    s = V(spark, sf, "v_shipment")
    return s.select("shipment_id", tf.format_period("completed_at").alias("ym"),
                    tf.format_period("completed_at", with_day=True).alias("ymd"))


@register("delivery_slot_text", with_views("""
select id, concat(strftime(starts_at, '%d.%m.%y %H:%M'), ' - ', strftime(ends_at, '%H:%M')) as slot
from v_delivery_window""", "v_delivery_window"))
def delivery_slot_text(spark, sf):
    w = V(spark, sf, "v_delivery_window")
    return w.select("id", tf.delivery_slot_text("starts_at", "ends_at").alias("slot"))


@register("weekday_parts", with_views("""
select id, cast(isodow(starts_at) - 1 as integer) as wd, cast(dayofweek(starts_at) + 1 as integer) as dow,
  cast(hour(starts_at) as integer) as hr from v_delivery_window""", "v_delivery_window"))
def weekday_parts(spark, sf):
    w = V(spark, sf, "v_delivery_window")
    return w.select("id", F.weekday("starts_at").alias("wd"), F.dayofweek("starts_at").alias("dow"),
                    F.hour("starts_at").alias("hr"))


@register("case_fold", """select p_partkey, lower(p_name) as name_lc, upper(p_brand) as brand_uc from part""")
def case_fold(spark, sf):
    p = scan(spark, sf, "part", ["p_partkey", "p_name", "p_brand"])
    return p.select("p_partkey", F.lower("p_name").alias("name_lc"), F.upper("p_brand").alias("brand_uc"))


@register("concat_text", with_views("""
select shipment_id, '+' || phone as phone_text, shipment_number || '/' || phone as tag
from v_shipment""", "v_shipment"))
def concat_text(spark, sf):
    s = V(spark, sf, "v_shipment")
    return s.select("shipment_id", text.phone_text("phone").alias("phone_text"),
                    F.concat("shipment_number", F.lit("/"), "phone").alias("tag"))


@register("key_from_text", """
select p_partkey, substring(k, instr(k, '-') + 1, 15) as store_key from (
  select p_partkey, case when p_partkey % 2 = 0 then concat(p_brand, '-', cast(p_partkey as varchar), '-x')
    else p_type end as k from part) t""")
def key_from_text(spark, sf):
    p = scan(spark, sf, "part", ["p_partkey", "p_brand", "p_type"])
    k = F.when(F.col("p_partkey") % 2 == 0,
               F.concat("p_brand", F.lit("-"), F.col("p_partkey").cast("string"), F.lit("-x"))).otherwise(F.col("p_type"))
    return p.select("p_partkey", text.key_from_text(k).alias("store_key"))


@register("number_format", """
select o_orderkey, replace(format('{:,.2f}', o_totalprice), ',', ' ') as total_text from orders""")
def number_format(spark, sf):
    o = scan(spark, sf, "orders", ["o_orderkey", "o_totalprice"])
    return o.select("o_orderkey", text.number_format("o_totalprice", 2, " ").alias("total_text"))


@register("margin_metrics", with_views("""
select s.shipment_id, s.gmv_goods_net_promo + s.gmv_service_fee_net_promo as gmv_sales_net_promo,
  coalesce(c.drive_costs, 0) + coalesce(c.taxi_costs, 0) as delivery_cost,
  case when s.shipment_state = 'shipped' then s.gross_profit else 0 end
    - (coalesce(c.picking_costs, 0) + coalesce(c.drive_costs, 0) + coalesce(c.taxi_costs, 0)) as cp1,
  case when s.total = 0 then null else s.gross_profit / s.total end as margin_rate
from v_shipment s left join v_order_cost c using (shipment_id)""", "v_shipment", "v_order_cost"))
def margin_metrics(spark, sf):
    from martlet.plans.mart import costs_and_margin
    s = V(spark, sf, "v_shipment")
    j = costs_and_margin(s, V(spark, sf, "v_order_cost"))
    return j.select("shipment_id", "gmv_sales_net_promo", "delivery_cost", "cp1",
                    F.try_divide("gross_profit", "total").alias("margin_rate"))


@register("array_access", with_views("""
select user_id, list_sort(list_distinct(list(retailer_id)))[-1] as last_retailer,
  list_sort(list_distinct(list(retailer_id)))[1] as first_retailer,
  cast(len(list_filter(list(retailer_id), lambda x: x = 1)) as integer) as n_retailer_1
from v_shipment group by user_id""", "v_shipment"))
def array_access(spark, sf):
    s = V(spark, sf, "v_shipment")
    g = s.groupBy("user_id").agg(F.array_sort(F.collect_set("retailer_id")).alias("rs"),
                                 F.count_if(F.col("retailer_id") == 1).cast("int").alias("n_retailer_1"))
    return g.select("user_id", F.element_at("rs", -1).alias("last_retailer"), F.get("rs", 0).alias("first_retailer"),
                    "n_retailer_1")


@register("mask_pii", with_views("""
select id, md5(email) as email_hash, md5(cast(id as varchar)) as id_hash from v_user""", "v_user"))
def mask_pii(spark, sf):
    u = V(spark, sf, "v_user")
    return u.select("id", text.mask_pii("email").alias("email_hash"), text.mask_pii("id").alias("id_hash"))


