"""Registered queries: joins (section 2.3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from martlet.operators import joins
from martlet.sources.views import view, with_views
from martlet.suite.registry import register


def V(spark, sf, name):
    return view(spark, sf, name)


@register("inner_join_chain", with_views("""
select s.shipment_number, o.name as offer_name, li.quantity, w.starts_at
from v_shipment s join v_line_item li using (shipment_id) join v_offer o on o.id = li.offer_id
join v_delivery_window w on w.id = s.shipment_id
where s.shipment_state = 'shipped'""",
                                         "v_shipment", "v_line_item", "v_offer", "v_delivery_window"))
def inner_join_chain(spark, sf):
    s = V(spark, sf, "v_shipment").where(F.col("shipment_state") == "shipped").select("shipment_id", "shipment_number")
    li = V(spark, sf, "v_line_item").select("shipment_id", "offer_id", "quantity")
    o = V(spark, sf, "v_offer").select(F.col("id").alias("offer_id"), F.col("name").alias("offer_name"))
    w = V(spark, sf, "v_delivery_window").select(F.col("id").alias("shipment_id"), "starts_at")
    j = joins.inner(joins.inner(joins.inner(s, li, "shipment_id"), o, "offer_id"), w, "shipment_id")
    return j.select("shipment_number", "offer_name", "quantity", "starts_at")


@register("left_join", with_views("""
select s.shipment_id, s.order_id, co.company_id from v_shipment s left join v_company_order co using (order_id)""",
                                  "v_shipment", "v_company_order"))
def left_join(spark, sf):
    s = V(spark, sf, "v_shipment").select("shipment_id", "order_id")
    return joins.left(s, V(spark, sf, "v_company_order"), "order_id").select("shipment_id", "order_id", "company_id")


@register("left_join_default", with_views("""
select s.shipment_id, coalesce(co.company_id, 0) as company_id, coalesce(c.name, '') as company_name
from v_shipment s left join v_company_order co using (order_id) left join v_company c using (company_id)""",
                                          "v_shipment", "v_company_order", "v_company"))
def left_join_default(spark, sf):
    s = V(spark, sf, "v_shipment").select("shipment_id", "order_id")
    c = V(spark, sf, "v_company").select("company_id", F.col("name").alias("company_name"))
    j = joins.left(s, V(spark, sf, "v_company_order"), "order_id")
    j = joins.left_default(j, c, "company_id", {"company_id": 0, "company_name": ""})
    return j.select("shipment_id", "company_id", "company_name")


@register("semi_join", with_views("""
select shipment_id, total from v_shipment where shipment_id in (select shipment_id from v_line_item where quantity >= 45)""",
                                  "v_shipment", "v_line_item"))
def semi_join(spark, sf):
    s = V(spark, sf, "v_shipment").select("shipment_id", "total")
    li = V(spark, sf, "v_line_item").where(F.col("quantity") >= 45).select("shipment_id")
    return joins.semi(s, li, "shipment_id")


@register("semi_join_nested", with_views("""
select shipment_id, order_id from v_shipment where order_id in (
  select order_id from v_company_order where company_id in (select company_id from v_company where postpay_flg))""",
                                         "v_shipment", "v_company_order", "v_company"))
def semi_join_nested(spark, sf):
    s = V(spark, sf, "v_shipment").select("shipment_id", "order_id")
    post = V(spark, sf, "v_company").where("postpay_flg").select("company_id")
    orders = joins.semi(V(spark, sf, "v_company_order"), post, "company_id").select("order_id")
    return joins.semi(s, orders, "order_id")


@register("anti_join", with_views("""
select s.shipment_id, s.order_id from v_shipment s
where not exists (select 1 from v_locked_order l where l.order_id = s.order_id and l.export_lock_state = 'locked')""",
                                  "v_shipment", "v_locked_order"))
def anti_join(spark, sf):
    s = V(spark, sf, "v_shipment").select("shipment_id", "order_id")
    locked = V(spark, sf, "v_locked_order").where(F.col("export_lock_state") == "locked").select("order_id")
    return joins.anti(s, locked, "order_id")


@register("ledger_anti_join", with_views("""
select s.shipment_number, s.total from v_shipment s
where not exists (select 1 from v_ledger g where g.shipment_number = s.shipment_number and g.process_name = 'pulse_a')""",
                                         "v_shipment", "v_ledger"))
def ledger_anti_join(spark, sf):
    s = V(spark, sf, "v_shipment").select("shipment_number", "total")
    sent = V(spark, sf, "v_ledger").where(F.col("process_name") == "pulse_a").select("shipment_number")
    return joins.anti(s, sent, "shipment_number")


@register("join_on_predicate", with_views("""
select li.shipment_id, li.offer_id, o.name from v_line_item li
join v_offer o on o.id = li.offer_id and o.deleted_at is null and o.published = 1""", "v_line_item", "v_offer"))
def join_on_predicate(spark, sf):
    li = V(spark, sf, "v_line_item").select("shipment_id", "offer_id")
    o = V(spark, sf, "v_offer").select(F.col("id").alias("offer_id"), "name", "deleted_at", "published")
    j = joins.join_on_predicate(li, o, "offer_id", F.col("deleted_at").isNull() & (F.col("published") == 1))
    return j.select("shipment_id", "offer_id", "name")


@register("join_derived_key", with_views("""
select li.shipment_id, li.offer_id, lim.retailer_sku, lim.max_qty
from v_line_item li join v_offer_limit lim on lim.retailer_sku = concat('SKU', cast(li.offer_id as varchar))""",
                                         "v_line_item", "v_offer_limit"))
def join_derived_key(spark, sf):
    li = V(spark, sf, "v_line_item").select("shipment_id", "offer_id")
    lim = V(spark, sf, "v_offer_limit")
    j = joins.join_derived(li, lim, F.concat(F.lit("SKU"), F.col("offer_id").cast("string")),
                           F.col("retailer_sku"))
    return j.select("shipment_id", "offer_id", "retailer_sku", "max_qty")


@register("dictionary_lookup", with_views("""
select li.shipment_id, li.offer_id, o.brand, o.category from v_line_item li left join v_offer o on o.id = li.offer_id""",
                                          "v_line_item", "v_offer"))
def dictionary_lookup(spark, sf):
    li = V(spark, sf, "v_line_item").select("shipment_id", "offer_id")
    return joins.lookup(li, V(spark, sf, "v_offer"), "offer_id", ["brand", "category"], dict_key="id")


@register("hierarchy_root", with_views("""
select id, root_id from (
  with recursive up(id, anc, depth) as (
    select id, coalesce(parent_id, id), 0 from v_category
    union all
    select up.id, c.parent_id, up.depth + 1 from up join v_category c on c.id = up.anc
    where c.parent_id is not null)
  select id, arg_max(anc, depth) as root_id from up group by id) t""", "v_category"))
def hierarchy_root(spark, sf):
    return joins.hierarchy_root(V(spark, sf, "v_category"), "id", "parent_id")


@register("join_aggregate", with_views("""
select s.shipment_id, s.total, a.n_lines, a.lines_total
from v_shipment s join (select shipment_id, count(*) as n_lines, sum(line_total) as lines_total
  from v_line_item group by shipment_id) a using (shipment_id)""", "v_shipment", "v_line_item"))
def join_aggregate(spark, sf):
    s = V(spark, sf, "v_shipment").select("shipment_id", "total")
    li = V(spark, sf, "v_line_item")
    return joins.join_aggregate(s, li, "shipment_id",
                                [F.count(F.lit(1)).alias("n_lines"), F.sum("line_total").alias("lines_total")])


@register("join_indicator", with_views("""
select coalesce(l.id, r.id) as id,
  case when l.id is not null and r.id is not null then 'both' when l.id is not null then 'left_only'
  else 'right_only' end as _merge
from (select distinct offer_id as id from v_line_item) l
full outer join (select id from v_offer where published = 0) r on l.id = r.id""", "v_line_item", "v_offer"))
def join_indicator(spark, sf):
    l = V(spark, sf, "v_line_item").select(F.col("offer_id").alias("id")).distinct()
    r = V(spark, sf, "v_offer").where(F.col("published") == 0).select("id")
    return joins.join_indicator(l, r, "id")
