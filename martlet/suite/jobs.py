"""Registered pipeline queries (section 2.10) and the as-of family."""

from __future__ import annotations

import re
from dataclasses import replace

from pyspark.sql import functions as F

from martlet.plans import mart
from martlet.session import cut_lineage
from martlet.sources.views import view, with_views
from martlet.suite.registry import ORACLE, register
from martlet.suite.sqlbits import ASOF_DATE, ld, month

_SHIP_FILTER = f"""
  select *, coalesce({ld('shipped_at')}, {ld('starts_at')}) as shipped_dt from v_shipment
  where coalesce({ld('shipped_at')}, {ld('starts_at')}) between date '1995-01-01' and {ASOF_DATE}
    and (b2b_measure >= 1 or shipment_id in (select shipment_id from v_certificate))"""

_MANAGERS = """
  select p.company_group_id, cast(p.start_period as timestamp) as date_start,
         cast(p.end_period as timestamp) as date_end, p.end_period, p.manager_id, f.first_manager_id
  from v_manager_period p
  join (select company_group_id, arg_min(manager_id, start_period) as first_manager_id
        from v_manager_period group by company_group_id) f using (company_group_id)"""

_ASOF = """
  select s.*, m.end_period, m.date_start, m.date_end, m.manager_id, m.first_manager_id
  from (select s.*, g.company_group_id from s
        left join (select user_id, min(company_group_id) as company_group_id from v_user_group group by user_id) g using (user_id)) s
  asof left join mg m on s.company_group_id = m.company_group_id and s.shipped_at <= m.date_end"""

_ASSIGNED = """case when manager_id = first_manager_id and shipped_at >= date_start - interval 10 day
                      and shipped_at <= date_end then manager_id
                 when shipped_at >= date_start and shipped_at <= date_end then manager_id
                 else 0 end"""

_ASOF_CTES = [("s", _SHIP_FILTER), ("mg", _MANAGERS), ("a", _ASOF)]


@register("b2b_manager_gmv", with_views(f"""
select cast({_ASSIGNED} as bigint) as assigned_manager_id, {month('shipped_dt')} as month,
       count(*) as n_shipments, sum(gmv_goods_net_promo) as gmv
from a group by all""", "v_shipment", "v_certificate", "v_user_group", "v_manager_period", extra=_ASOF_CTES))
def b2b_manager_gmv(spark, sf_dir):
    return mart.manager_gmv(spark, sf_dir)


ORACLE_FLAGSHIP = ORACLE["b2b_manager_gmv"]


@register("asof_left_join", with_views("""
select shipment_id, company_group_id, shipped_at, end_period as date_end,
       cast(date_start as date) as date_start, manager_id
from a""", "v_shipment", "v_certificate", "v_user_group", "v_manager_period", extra=_ASOF_CTES))
def asof_left_join(spark, sf_dir):
    s = mart.shipments(spark, sf_dir).join(mart.user_groups(view(spark, sf_dir, "v_user_group")), "user_id", "left")
    from martlet.operators.joins import asof_left
    out = asof_left(s, mart.managers(spark, sf_dir), by="company_group_id", left_ts="shipped_at",
                    right_ts="date_end", payload=["date_start", "manager_id"], bounds=mart.shipping_months())
    return out.select("shipment_id", "company_group_id", "shipped_at", "date_end", "date_start", "manager_id")


@register("assigned_manager", with_views(f"""
select shipment_id, cast({_ASSIGNED} as bigint) as assigned_manager_id from a
""", "v_shipment", "v_certificate", "v_user_group", "v_manager_period", extra=_ASOF_CTES))
def assigned_manager(spark, sf_dir):
    s = mart.with_manager(mart.shipments(spark, sf_dir), view(spark, sf_dir, "v_user_group"),
                          mart.managers(spark, sf_dir), mart.shipping_months())
    return s.select("shipment_id", "assigned_manager_id")




# ---------------------------------------------------------------- K11 K12 directory, catalogue

from martlet.plans import directory as dirs  # noqa: E402
from martlet.plans import pulse  # noqa: E402
from martlet.suite.sqlbits import ASOF, lts  # noqa: E402

_FB = dirs.Fallback()
_DIRECTORY = f"""
  select c.company_id, c.inn, c.name, coalesce(u.user_email, '{_FB.email}') as manager_email,
    coalesce(u.user_fio, '{_FB.name}') as manager_name, c.con_flag,
    array_to_string(list_sort(list_distinct(list(case when p.value = '' then '{_FB.phone}' else p.value end))), ', ')
      as manager_phones
  from (select company_id, inn, name, case when postpay_flg or deposit_flg then 'postpay' else 'another' end as con_flag
        from v_company) c
  left join (select distinct cm.company_id, cm.user_id, u.firstname || ' ' || u.lastname as user_fio, u.email as user_email
             from v_company_manager cm join v_user u on u.id = cm.user_id where cm.deleted_at is null) u using (company_id)
  left join v_phone p on p.user_id = u.user_id
  group by all"""
_DIR_VIEWS = ("v_company", "v_company_manager", "v_user", "v_phone")


@register("manager_directory", with_views("select * from dir", *_DIR_VIEWS, extra=[("dir", _DIRECTORY)]))
def manager_directory(spark, sf):
    v = lambda n: view(spark, sf, n)
    return dirs.manager_directory(v("v_company"), v("v_company_manager"), v("v_user"), v("v_phone"))


@register("offer_catalogue", with_views("""
select o.id as offer_id, o.name, o.retailer_sku, o.category, p.last_price, p.price_dt
from v_offer o left join (select offer_id, arg_max(price, dt) filter (where price is not null) as last_price,
  max(dt) as price_dt from v_offer_price group by offer_id) p on p.offer_id = o.id
where o.deleted_at is null and o.published = 1 and o.status = 1""", "v_offer", "v_offer_price"))
def offer_catalogue(spark, sf):
    return dirs.offer_catalogue(view(spark, sf, "v_offer"), view(spark, sf, "v_offer_price"))


# ---------------------------------------------------------------- K2 - K6 pulses

NEW_ORDERS = pulse.PulseConfig("pulse_b", retailer_ids=(3,), window_days=14)
NEXT_DAY = pulse.PulseConfig("next_day", retailer_ids=tuple(range(10)), states=("complete", "shipped"))
ND_AS_OF = "1996-09-27 09:00:00"  # a Friday: the next business day is the Monday
_ND_DATE = "date '1996-09-30'"
_ND_RET = ", ".join(str(r) for r in NEXT_DAY.retailer_ids)
BIG_AND = pulse.PulseConfig("pulse_a", retailer_ids=(5,), window_days=30, window_basis="completed",
                            line_rule=("and", 50000, 50000), trigger="7 minutes")
BIG_OR = pulse.PulseConfig("pulse_b", retailer_ids=(7,), window_days=30, window_basis="completed",
                           line_rule=("or", 100000, 200000), trigger="7 minutes")
OVER_LIMIT = pulse.PulseConfig("pulse_a", retailer_ids=(2, 8), window_days=60, window_basis="completed")
HOURLY = pulse.PulseConfig("hourly", retailer_ids=(1,), states=("complete", "shipped", "canceled"))
HOURLY_AS_OF = "2000-01-10 00:30:00"  # a Monday just after midnight: 49 h look-back

_PULSE_VIEWS = ("v_shipment", "v_delivery_window", "v_company_order", "v_line_item", "v_offer", "v_ledger") + _DIR_VIEWS


def _cand_sql(cfg, slot=True):
    win = (f"{ld('w.starts_at')} >= {ASOF_DATE} - {cfg.window_days}" if slot
           else f"s.completed_at > {ASOF} - interval {cfg.window_days} day")
    rets = ", ".join(str(r) for r in cfg.retailer_ids)
    states = ", ".join(f"'{x}'" for x in cfg.states)
    names = ", ".join(f"'{x}'" for x in (cfg.ledger_names or (cfg.process_name,)))
    return f"""
  select s.*, w.starts_at as slot_start, w.ends_at as slot_end, co.company_id, {lts('s.completed_at')} as completed_local,
    {lts('w.ends_at')} as slot_end_local
  from v_shipment s join v_delivery_window w on w.id = s.shipment_id join v_company_order co using (order_id)
  where s.retailer_id in ({rets}) and s.shipment_state in ({states}) and {win}
    and not exists (select 1 from v_ledger g where g.shipment_number = s.shipment_number and g.process_name in ({names}))"""


@register("pulse_new_orders", with_views(f"""
select distinct c.completed_local, c.slot_end_local, c.shipment_number, li.quantity, li.price, o.name as offer_name,
  coalesce(d.manager_email, '{_FB.email}') as manager_email, coalesce(d.manager_phones, '{_FB.phone}') as manager_phones,
  coalesce(d.manager_name, '{_FB.name}') as manager_name
from c join v_line_item li on li.shipment_id = c.shipment_id and li.deleted_at is null
join v_offer o on o.id = li.offer_id left join dir d on d.company_id = c.company_id""",
                                         *_PULSE_VIEWS, extra=[("dir", _DIRECTORY), ("c", _cand_sql(NEW_ORDERS))]))
def pulse_new_orders(spark, sf):
    return pulse.new_orders(pulse.Sources.fixture(spark, sf), NEW_ORDERS)


@register("ledger_rows", with_views(f"""
select distinct c.shipment_number, 'pulse_b' as process_name, {ASOF} as shipment_logged_at
from c join v_line_item li on li.shipment_id = c.shipment_id and li.deleted_at is null
join v_offer o on o.id = li.offer_id""", *_PULSE_VIEWS, extra=[("c", _cand_sql(NEW_ORDERS))]))
def ledger_rows(spark, sf):
    report = pulse.new_orders(pulse.Sources.fixture(spark, sf), NEW_ORDERS)
    return pulse.ledger_rows(report, NEW_ORDERS)




def _bal_sql(due: str) -> str:
    """Orders of ``due`` whose shipments, all of them, leave a gap of 1000 at most."""
    return f"""
  select order_id from (
    select order_id, case when count(distinct payment_total) over (partition by order_id) > 1
      then sum(payment_total) over (partition by order_id) else payment_total end as paid,
      sum(total) over (partition by order_id) as sum_total
    from v_shipment where order_id in ({due})) t
  where sum_total - paid <= 1000"""


def _gate_sql(s: str, company: str) -> str:
    """The pay gate of alias ``s`` whose company is ``company``, without locked orders."""
    return f"""({s}.payment_state in ('paid', 'overpaid') or {s}.payment_method_id in (4, 11, 12, 20)
         or {s}.order_id in (select order_id from bal)
         or {company} in (select company_id from dir where con_flag = 'postpay'))
    and {s}.order_id not in (select order_id from v_locked_order where export_lock_state = 'locked')"""


_DUE_OF_C = "select order_id from c where payment_state = 'balance_due'"
_BAL_SQL = _bal_sql(f"""select s.order_id from v_shipment s join v_delivery_window w on w.id = s.shipment_id
  where s.retailer_id in ({_ND_RET}) and s.shipment_state in ('complete', 'shipped') and s.payment_state = 'balance_due'
    and cast(w.starts_at as date) = {_ND_DATE}""")
_NEXT_DAY_SQL = f"""
  select distinct s.shipment_number, {lts('s.completed_at')} as completed_local, {lts('w.starts_at')} as slot_start_local,
    o.name as offer_name, li.quantity, s.payment_method_name, s.total_weight
  from v_shipment s join v_delivery_window w on w.id = s.shipment_id
  join v_line_item li on li.shipment_id = s.shipment_id and li.deleted_at is null
  join v_offer o on o.id = li.offer_id
  left join v_company_order co on co.order_id = s.order_id
  where s.retailer_id in ({_ND_RET}) and s.shipment_state in ('complete', 'shipped')
    and cast(w.starts_at as date) = {_ND_DATE}
    and {_gate_sql('s', 'co.company_id')}"""
_ND_EXTRA = [("dir", _DIRECTORY), ("bal", _BAL_SQL), ("nd", _NEXT_DAY_SQL)]


@register("pulse_next_day", with_views("select * from nd", *_PULSE_VIEWS, "v_locked_order", extra=_ND_EXTRA))
def pulse_next_day(spark, sf):
    return pulse.next_day(pulse.Sources.fixture(spark, sf), NEXT_DAY, as_of=ND_AS_OF)


_CONSIGNEE_BASE = f"""
  select distinct s.shipment_id, s.shipment_number, s.store_id, co.company_id
  from v_shipment s join v_delivery_window w on w.id = s.shipment_id
  left join v_company_order co on co.order_id = s.order_id
  where s.retailer_id in ({_ND_RET}) and s.shipment_state in ('complete', 'shipped')
    and cast(w.starts_at as date) = {_ND_DATE}
    and {_gate_sql('s', 'co.company_id')}"""


@register("pulse_consignees", with_views("""
select distinct c.inn, c.name as company_name, b.shipment_number, o.name as offer_name, li.quantity,
  case when b.store_id = 16 then 'special_store' else 'other' end as route
from cb b join v_line_item li on li.shipment_id = b.shipment_id and li.deleted_at is null and li.quantity >= 20
join v_offer o on o.id = li.offer_id and (lower(o.category) like '%economy%' or lower(o.category) like '%standard%')
join v_company c on c.company_id = b.company_id""",
                                         *_PULSE_VIEWS, "v_locked_order",
                                         extra=[("dir", _DIRECTORY), ("bal", _BAL_SQL), ("cb", _CONSIGNEE_BASE)]))
def pulse_consignees(spark, sf):
    src = pulse.Sources.fixture(spark, sf)
    return pulse.consignees(src, NEXT_DAY, view(spark, sf, "v_company"), as_of=ND_AS_OF, min_qty=20,
                            categories=("%economy%", "%standard%"), special_store=16)


def _big_sql(cfg):
    mode, lmin, tmin = cfg.line_rule
    op = "and" if mode == "and" else "or"
    return f"""
select c.shipment_number, c.company_id, c.store_id, li.offer_id, li.price, li.quantity, li.price * li.quantity as sku_total,
  c.total, c.completed_local
from c join v_line_item li on li.shipment_id = c.shipment_id and li.deleted_at is null
where {_gate_sql('c', 'c.company_id')} and (li.price * li.quantity >= {lmin} {op} c.total >= {tmin})"""


def _gated(cfg) -> list:
    """Helper views of a gated alert: directory, candidates, small balance gaps."""
    return [("dir", _DIRECTORY), ("c", _cand_sql(cfg, slot=False)), ("bal", _bal_sql(_DUE_OF_C))]


@register("pulse_big_orders_and", with_views(_big_sql(BIG_AND), *_PULSE_VIEWS, "v_locked_order",
                                             extra=_gated(BIG_AND)))
def pulse_big_orders_and(spark, sf):
    return pulse.big_orders(pulse.Sources.fixture(spark, sf), BIG_AND)


@register("pulse_big_orders_or", with_views(_big_sql(BIG_OR), *_PULSE_VIEWS, "v_locked_order",
                                            extra=_gated(BIG_OR)))
def pulse_big_orders_or(spark, sf):
    return pulse.big_orders(pulse.Sources.fixture(spark, sf), BIG_OR)


@register("pulse_over_limit", with_views(f"""
select c.shipment_number, o.retailer_sku, li.quantity, lim.max_qty, c.completed_local
from c join v_line_item li on li.shipment_id = c.shipment_id and li.deleted_at is null
join v_offer o on o.id = li.offer_id join v_offer_limit lim on lim.retailer_sku = o.retailer_sku
where {_gate_sql('c', 'c.company_id')} and lim.max_qty is not null and li.quantity > lim.max_qty""",
                                         *_PULSE_VIEWS, "v_offer_limit", "v_locked_order", extra=_gated(OVER_LIMIT)))
def pulse_over_limit(spark, sf):
    return pulse.over_limit(pulse.Sources.fixture(spark, sf), OVER_LIMIT)


@register("pulse_hourly", with_views(f"""
select distinct s.shipment_number, s.shipment_state, {lts('s.completed_at')} as completed_local, o.name as offer_name,
  li.quantity, li.price, coalesce(d.manager_email, '{_FB.email}') as manager_email,
  coalesce(d.manager_name, '{_FB.name}') as manager_name
from v_shipment s left join v_company_order co using (order_id)
join v_line_item li on li.shipment_id = s.shipment_id and li.deleted_at is null
join v_offer o on o.id = li.offer_id left join dir d on d.company_id = co.company_id
where s.retailer_id in (1) and s.shipment_state in ('complete', 'shipped', 'canceled')
  and s.completed_at > timestamp '{HOURLY_AS_OF}' - interval 49 hour and s.completed_at <= timestamp '{HOURLY_AS_OF}'""",
                                     *_PULSE_VIEWS, extra=[("dir", _DIRECTORY)]))
def pulse_hourly(spark, sf):
    return pulse.hourly(pulse.Sources.fixture(spark, sf), HOURLY, as_of=HOURLY_AS_OF)


# ---------------------------------------------------------------- K7 weekly statistics

from martlet.plans import audience as aud  # noqa: E402
from martlet.plans import seller as sel  # noqa: E402
from martlet.plans import weekly  # noqa: E402

EXCLUDED_CATEGORIES = ("PROMO%",)
_EXCL_SQL = """select distinct li.shipment_id from v_line_item li join v_offer o on o.id = li.offer_id
  where li.deleted_at is null and o.category like 'PROMO%'"""


def _weekly_parts(spark, sf):
    v = lambda n: view(spark, sf, n)
    ship, li, offers = v("v_shipment"), v("v_line_item"), v("v_offer")
    return ship, li, offers, weekly.excluded_shipments(li, offers, EXCLUDED_CATEGORIES)


@register("store_month_stats", with_views(f"""
select strftime({month(ld('shipped_at'))}, '%Y-%m') as month, store_id, count(distinct order_id) as n_orders,
  count(distinct case when payment_method_name = 'invoice' then order_id end) as n_invoice_orders,
  sum(total) as revenue, avg(total) as avg_check,
  avg(case when payment_method_name = 'invoice' then total end) as avg_invoice_check,
  count(distinct case when total_weight > 80000 then order_id end) as n_heavy_orders,
  count(distinct case when total_weight > 80000 and payment_method_name = 'invoice' then order_id end) as n_heavy_invoice_orders
from v_shipment s
where shipment_state = 'shipped' and b2b_measure in (1, 2) and retailer_id in (2, 3)
  and shipped_at > timestamp '1995-01-01 00:00:00'
  and shipment_id not in (select shipment_id from excl)
group by all""", "v_shipment", "v_line_item", "v_offer", extra=[("excl", _EXCL_SQL)]))
def store_month_stats(spark, sf):
    ship, _li, _o, excl = _weekly_parts(spark, sf)
    return weekly.store_month_stats(ship, excl, retailer_ids=(2, 3))


_WEEK_LINES = f"""
  select s.store_id, s.shipment_id, cast(date_trunc('week', {ld('s.shipped_at')}) as date) as week,
    li.offer_id, li.quantity, li.price, li.vat_rate
  from v_shipment s join v_line_item li on li.shipment_id = s.shipment_id and li.deleted_at is null
  where s.shipment_state = 'shipped' and s.b2b_measure in (1, 2)
    and cast(date_trunc('week', {ld('s.shipped_at')}) as date) = cast(date_trunc('week', {ASOF}) as date) - 7
    and s.shipment_id not in (select shipment_id from excl)"""


@register("sku_week_stats", with_views("""
select strftime(week, '%Y-%m-%d') as week, store_id, o.retailer_sku, o.name as product_name,
  sum(wl.quantity) as quantity, sum((1 - wl.vat_rate / 100) * wl.price * wl.quantity) as net_amount
from wl join v_offer o on o.id = wl.offer_id group by all""",
                                       "v_shipment", "v_line_item", "v_offer",
                                       extra=[("excl", _EXCL_SQL), ("wl", _WEEK_LINES)]))
def sku_week_stats(spark, sf):
    ship, li, offers, excl = _weekly_parts(spark, sf)
    return weekly.sku_week_stats(ship, li, offers, excl)


@register("category_week_stats", with_views("""
select strftime(week, '%Y-%m-%d') as week, o.category, sum(quantity) as quantity,
  sum((1 - wl.vat_rate / 100) * wl.price * wl.quantity) as net_amount, count(distinct wl.shipment_id) as n_shipments
from wl join v_offer o on o.id = wl.offer_id group by all""",
                                            "v_shipment", "v_line_item", "v_offer",
                                            extra=[("excl", _EXCL_SQL), ("wl", _WEEK_LINES)]))
def category_week_stats(spark, sf):
    ship, li, offers, excl = _weekly_parts(spark, sf)
    return weekly.category_week_stats(ship, li, offers, excl)


# ---------------------------------------------------------------- K8 audience, K9 popular retailers

AUDIENCE = aud.AudienceSpec(start="1995-01-01", end="1999-12-31", funnel_as_of="2024-02-01 00:00:00",
                            min_orders_period=2, min_month_orders=1, major_shop_size="supermarket", n_users=40)
FILTERS = aud.AudienceSpec(start="1996-01-01", end="1998-12-31", funnel_as_of="2024-02-01 00:00:00",
                           platforms=("WEB",), only_b2b=True, retailer_names=("Retailer_2", "retailer_4"),
                           cancellations="without", min_orders_period=2, min_addresses=2,
                           major_shop_size="supermarket", must_buy_nonfood=True,
                           row_in=(("tenant_id", ("TENANT_MAIN", "tenant_b2b")),), collect=("tenant_id",),
                           having_any=(("tenant_id", ("tenant_b2b",)),))

_ROOTS = """select id, root_id from (
  with recursive up(id, anc, depth) as (
    select id, coalesce(parent_id, id), 0 from v_category
    union all
    select up.id, c.parent_id, up.depth + 1 from up join v_category c on c.id = up.anc where c.parent_id is not null)
  select id, arg_max(anc, depth) as root_id from up group by id) t"""

_CAT_ORDERS = """select li.order_id, bool_or(r.root_id in (1, 2)) as has_food, bool_or(r.root_id not in (1, 2)) as has_nonfood
  from v_line_item li join roots r on r.id = li.offer_id
  where li.shipped_at is not null and cast(li.shipped_at as date) between date '{start}' and date '{end}'
  group by li.order_id"""

_USER_SHIP = """
  select s.user_id, s.platform, count(distinct s.order_id) as orders_period, count(distinct s.store_id) as address_count,
    max(s.completed_at) as last_order_ts, max(cast(s.b2b_measure > 0 as integer)) as is_b2b,
    list_sort(list_distinct(list(s.shipment_state))) as shipment_states,
    list_sort(list_distinct(list('retailer_' || cast(s.retailer_id as varchar)))) as retailer_names,
    avg(case when s.retailer_id % 3 = 0 then 1.0 else 0.0 end) as major_share,
    count(distinct case when co.has_food then s.order_id end) as orders_food_category,
    count(distinct case when co.has_nonfood then s.order_id end) as orders_nonfood_category{extra}
  from v_shipment s left join co on co.order_id = s.order_id
  where cast(s.completed_at as date) between date '{start}' and date '{end}' and s.user_id is not null {where}
  group by s.user_id, s.platform"""


@register("dynamic_filters", with_views(f"""
select * from us where list_has_any(retailer_names, ['retailer_2', 'retailer_4'])
  and not list_contains(shipment_states, 'canceled') and orders_period >= 2 and address_count >= 2
  and orders_nonfood_category > 0 and list_has_any(tenant_id_set, ['tenant_b2b'])""",
                                        "v_shipment", "v_line_item", "v_category", extra=[
                                            ("roots", _ROOTS),
                                            ("co", _CAT_ORDERS.format(start="1996-01-01", end="1998-12-31")),
                                            ("us", _USER_SHIP.format(
                                                start="1996-01-01", end="1998-12-31",
                                                where="and lower(s.platform) in ('web') and s.b2b_measure > 0"
                                                      " and lower(s.tenant_id) in ('tenant_main', 'tenant_b2b')",
                                                extra=", list_sort(list_distinct(list(s.tenant_id))) as tenant_id_set"))]))
def dynamic_filters(spark, sf):
    cats = aud.category_orders(view(spark, sf, "v_line_item"), view(spark, sf, "v_category"), FILTERS)
    return aud.user_shipments(view(spark, sf, "v_shipment"), FILTERS, cats)


USES = aud.AudienceSpec(start="1996-01-01", end="1998-12-31", funnel_as_of="2024-02-01 00:00:00", major_shop_size="supermarket",
                        row_in=(("platform", aud.typed_list(" Web, app,,WEB ")),), grain=("tenant_id",),
                        uses=(("invoice_use", "payment_method_name", ("invoice",)),), having_use=(("invoice_use", "yes"),))


@register("audience_uses", with_views("select * from us where invoice_use = 'yes'", "v_shipment", "v_line_item", "v_category", extra=[
    ("roots", _ROOTS), ("co", _CAT_ORDERS.format(start="1996-01-01", end="1998-12-31")),
    ("us", _USER_SHIP.format(start="1996-01-01", end="1998-12-31", where="and lower(s.platform) in ('web', 'app')", extra=""", s.tenant_id,
    case when max(cast(s.payment_method_name = 'invoice' as integer)) = 1 then 'yes' else 'no' end as invoice_use""") + ", s.tenant_id")]))
def audience_uses(spark, sf):
    """A use flag as answer and filter, a typed list, a finer grain."""
    cats = aud.category_orders(view(spark, sf, "v_line_item"), view(spark, sf, "v_category"), USES)
    return aud.user_shipments(view(spark, sf, "v_shipment"), USES, cats)


_AUD_CTES = [
    ("roots", _ROOTS),
    ("co", _CAT_ORDERS.format(start="1995-01-01", end="1999-12-31")),
    ("us", _USER_SHIP.format(start="1995-01-01", end="1999-12-31", where="", extra="")
     + " having count(distinct s.order_id) >= 2"),
    ("fu", """select user_id, case when max(order_seq) > 7 then '>7 orders' else '1-7 orders' end as new_or_old,
       case when datesub('month', min(completed_at), max(completed_at)) < 1 then 'under 1 month'
            when datesub('month', min(completed_at), max(completed_at)) < 3 then '1-3 months'
            when datesub('month', min(completed_at), max(completed_at)) < 6 then '3-6 months'
            when datesub('month', min(completed_at), max(completed_at)) < 12 then '6-12 months' else '12+ months' end as use_duration
     from (select user_id, order_seq, completed_at from v_funnel_web union all
           select user_id, order_seq, completed_at from v_funnel_app) u
     where completed_at between timestamp '2024-02-01 00:00:00' - interval 1 year and timestamp '2024-02-01 00:00:00'
     group by user_id"""),
    ("sb", """select user_id, case when p = 0 and b = 0 then 'no bank id' when p = 1 and b = 0 then 'bank id not linked'
       when b = 1 then 'bank id linked' end as bank_id_use
     from (select user_id, coalesce(max(1) filter (where provider = 'plan'), 0) as p,
             coalesce(max(1) filter (where provider = 'bank'), 0) as b from v_user_auth group by user_id) t"""),
    ("ph", "select user_id, arg_max(value, (created_at, value)) as phone_number from v_phone group by user_id"),
    ("em", """select id as user_id, firstname as first_name, lastname as last_name,
       case when coalesce(email, '') not like '%@temp.temp%' then email else pending_email end as user_email
     from v_user where coalesce(email, '') not like '%corp.example%' and coalesce(pending_email, '') not like '%corp.example%'"""),
    ("mo", f"""select user_id, min(n) as min_month_orders from (
       select user_id, {month('completed_at')} as m, count(distinct order_id) as n from v_shipment
       where cast(completed_at as date) between date '1995-01-01' and date '1999-12-31' group by all) t
     group by user_id having min(n) >= 1"""),
]


@register("audience_extract", with_views(f"""
select us.user_id, us.platform, em.first_name, em.last_name, ph.phone_number, em.user_email, us.is_b2b,
  us.orders_period, us.address_count, mo.min_month_orders, fu.new_or_old, fu.use_duration, sb.bank_id_use,
  us.shipment_states, us.retailer_names, us.major_share, us.orders_food_category, us.orders_nonfood_category, sg.segment
from us join fu using (user_id) join sb using (user_id) join ph using (user_id) join em using (user_id)
join mo using (user_id)
left join (select user_id, arg_max(name, (update_date, name)) as segment from v_user_segment group by user_id) sg using (user_id)
where us.major_share >= 0.5
order by us.user_id, us.platform limit 40""", "v_shipment", "v_funnel_web", "v_funnel_app", "v_user_auth", "v_phone",
                                         "v_user", "v_line_item", "v_category", "v_user_segment", extra=_AUD_CTES))
def audience_extract(spark, sf):
    return aud.audience_extract(spark, sf, AUDIENCE)


@register("popular_retailers", with_views(f"""
select upper('retailer_' || cast(retailer_id as varchar)) as retailer, count(distinct order_id) as n_orders
from v_shipment where completed_at > {ASOF} - interval 1 month and completed_at <= {ASOF}
group by all order by n_orders desc, retailer limit 100""", "v_shipment"))
def popular_retailers(spark, sf):
    from martlet.session import AS_OF
    return aud.top_retailers(view(spark, sf, "v_shipment"), AS_OF, k=100)


# ---------------------------------------------------------------- K10 seller GMV

_SELLER_MONTHLY = """
  select seller_id, dt_month, count(distinct item_id) as cnt_items, sum(amount) as gmv from v_seller_month
  where dt_month between date '1996-01-01' and date '1998-12-01'
    and item_id in (select id from v_offer where deleted_at is null and published = 1)
  group by seller_id, dt_month having sum(amount) > 1000"""


@register("seller_gmv", with_views(f"""
select gmv_group, n_sellers,
  round_even(cast(100.0 * n_sellers / sum(n_sellers) over () as decimal(38, 10)), 2)::double as pct_of_total,
  cast(list_position({sel.GMV_LABELS!r}, gmv_group) as integer) as label_rank
from (select {"case " + " ".join(
    (f"when average_gmv >= {lo} and average_gmv < {hi} then '{lab}'" if hi != float("inf") else f"when average_gmv >= {lo} then '{lab}'")
    for lo, hi, lab in zip(sel.GMV_EDGES, sel.GMV_EDGES[1:], sel.GMV_LABELS)) + " end"} as gmv_group, count(*) as n_sellers
  from (select seller_id, coalesce(sum(gmv) / nullif(count(*) filter (where gmv <> 0), 0), 0) as average_gmv
        from m group by seller_id) a group by 1) t""", "v_seller_month", "v_offer", extra=[("m", _SELLER_MONTHLY)]))
def seller_gmv(spark, sf):
    v = lambda n: view(spark, sf, n)
    active = v("v_offer").where(F.col("deleted_at").isNull() & (F.col("published") == 1)).select(F.col("id").alias("item_id"))
    monthly = sel.monthly_gmv(v("v_seller_month"), active, "1996-01-01", "1998-12-01")
    return sel.seller_groups(monthly)


# ---------------------------------------------------------------- K13 - K15

from martlet.plans import history  # noqa: E402


@register("source_ready", f"""
select source, max_date, coalesce(max_date >= {ASOF_DATE} - 1, false) as ready from (
  select 'orders' as source, max(cast(o_orderdate as date)) as max_date from orders
  union all select 'lineitem', max(cast(l_shipdate as date)) from lineitem
  union all select 'events', max(cast(ts as date)) from events) t""")
def source_ready(spark, sf):
    t = lambda n: spark.read.parquet(f"{sf}/{n}.parquet")
    from martlet.session import AS_OF
    return history.source_ready({"orders": (t("orders"), "o_orderdate"), "lineitem": (t("lineitem"), "l_shipdate"),
                                 "events": (t("events"), "ts")}, AS_OF)


# Low priorities count as no value, so that values turn NULL and back.
_SNAP = """select o_custkey, cast(o_orderdate as date) as snapshot_date,
    max(case when o_orderpriority not like '5%' then o_orderpriority end) as value
  from orders group by all"""


def _snapshots(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet")
    o = o.withColumn("value", F.when(~F.col("o_orderpriority").like("5%"), F.col("o_orderpriority")))
    return history.daily_snapshot(o, "o_custkey", "o_orderdate", "value")


def _part(c: str) -> str:
    """Oracle text of one part of a hash key: length, colon, value; '-' for NULL."""
    return f"coalesce(length(cast({c} as varchar)) || ':' || cast({c} as varchar), '-')"



@register("scd2_build", with_views("""
select o_custkey, value, snapshot_date as valid_from,
  cast(lead(snapshot_date) over (partition by o_custkey order by snapshot_date) - 1 as date) as valid_to,
  lead(snapshot_date) over (partition by o_custkey order by snapshot_date) is null as is_current
from (select *, lag(value) over (partition by o_custkey order by snapshot_date) as prev,
        row_number() over (partition by o_custkey order by snapshot_date) as rn from snap) t
where rn = 1 or prev is distinct from value""", extra=[("snap", _SNAP)]))
def scd2_build(spark, sf):
    return history.scd2(_snapshots(spark, sf), "o_custkey")


@register("vault_load", with_views(f"""
select md5({_part('o_custkey')}) as hub_key, snapshot_date as load_date,
  md5({_part('value')}) as hashdiff, value, 'orders' as record_source
from (select *, lag(value) over (partition by o_custkey order by snapshot_date) as prev,
        row_number() over (partition by o_custkey order by snapshot_date) as rn from snap) t
where rn = 1 or prev is distinct from value""", extra=[("snap", _SNAP)]))
def vault_load(spark, sf):
    return history.satellite(_snapshots(spark, sf), "o_custkey", ["value"], "snapshot_date", "orders")


@register("vault_hub_link", f"""
select md5({_part('o_custkey')} || {_part('o_orderkey')}) as link_key, md5({_part('o_custkey')}) as o_custkey_hub_key,
  md5({_part('o_orderkey')}) as o_orderkey_hub_key, 'orders' as record_source
from (select distinct o_custkey, o_orderkey from orders) t""")
def vault_hub_link(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet")
    return history.link(o, ["o_custkey", "o_orderkey"], "orders")


# ---------------------------------------------------------------- K1 the B2B shipment mart


from martlet.suite.basics import _COMPANY_TYPE_SQL, channel_sql  # noqa: E402


def _ret_cte(base: str, entity: str, prefix: str) -> str:
    flags = [f"coalesce(bool_or(d > first_dt and d <= first_dt + 14), false) as {prefix}_14d"]
    flags += [f"coalesce(bool_or(datediff('month', first_dt, d) = {k}), false) as {prefix}_{k + 1}m"
              for k in range(1, 12)]
    return f"""select {entity}, {', '.join(flags)} from (
      select {entity}, d, min(d) over (partition by {entity}) as first_dt from (select distinct {entity}, d from {base}) p) q
    group by {entity}"""


_MART_CTES = _ASOF_CTES + [
    ("comp", """select inn as company_inn, company_id, finance_income, employee_count, category_type, name as company_name,
       case when deposit_flg then 'Deposit' when postpay_flg then 'Postpay' when prepay_flg then 'Prepay (contract)'
            else 'Prepay (offer)' end as payment_type,
       cast(coalesce(lower(manager_comment) like '%test%' or lower(manager_comment) like '%fraud%', false) as integer)
         as company_fraud_flg
     from v_company"""),
    ("pbase", f"""select phone, {ld('shipped_at')} as d, goods + total_cost as amount, shipment_id, shipped_at from v_shipment
     where b2b_measure in (1, 2) and shipment_state = 'shipped' and phone is not null"""),
    ("pret", _ret_cte("pbase", "phone", "ret")),
    ("fs", """select phone, arg_min(shipment_id, (shipped_at, shipment_id)) as first_order_shipment_id_phone
     from pbase where shipped_at is not null group by phone"""),
    ("pval", f"""select phone, min(d) as first_order_dt, max(d) as last_order_dt, sum(amount) as user_gmv,
       count(*) as user_order_cnt, count(distinct {month('d')}) as user_active_months_count,
       cast(greatest(coalesce(datediff('month', min(d), max(d)), 1), 1) as integer) as user_age_month
     from pbase group by phone"""),
    ("pv", """select v.*, fs.first_order_shipment_id_phone,
       case when user_active_months_count = 0 then null else user_order_cnt / user_active_months_count end
         as user_avg_orders_per_active_month,
       user_order_cnt / user_age_month as user_avg_orders_per_month, user_gmv / user_age_month as user_avg_arpu_per_month,
       user_gmv / user_order_cnt as user_aov
     from pval v left join fs using (phone)"""),
    ("gbase", f"""select company_group_id, {ld('shipped_at')} as d, shipment_id, shipped_at
     from v_shipment join v_user_group using (user_id)
     where shipment_state = 'shipped' and b2b_measure = 2 and company_group_id is not null"""),
    ("gf", """select company_group_id, arg_min(shipment_id, (shipped_at, shipment_id)) as first_id
     from gbase where shipped_at is not null group by company_group_id"""),
    ("gret", _ret_cte("gbase", "company_group_id", "group_ret")),
    ("gfl", """select company_group_id, min(d) as group_first_order_dt, max(d) as group_last_order_dt
     from gbase group by company_group_id"""),
]

_ASSIGNED_A = re.sub(r"\b(manager_id|first_manager_id|shipped_at|date_start|date_end)\b", r"a.\1", _ASSIGNED)
_EXPIRED = "case when a.b2b_measure = 2 and a.shipment_state = 'shipped' then a.b2b_certificate_profit else 0 end"
# Oracle expression per mart column (default: the column of the as-of'd fact `a`).
_MART_EXPR = {
    "company_id": "c.company_id", "company_name": "c.company_name", "finance_income": "c.finance_income",
    "employee_count": "c.employee_count", "category_type": "c.category_type", "payment_type": "c.payment_type",
    "company_fraud_flg": "c.company_fraud_flg",
    "company_type": _COMPANY_TYPE_SQL.replace("s.b2b_measure", "a.b2b_measure").replace("c.name", "c.company_name"),
    "company_group_id": "case when a.b2b_measure = 2 then a.company_group_id end",
    "date_start": "cast(a.date_start as date)", "date_end": "a.end_period",
    "assigned_manager_id": _ASSIGNED_A, "customer_total": "a.total",
    "gmv_sales_net_promo": f"a.gmv_goods_net_promo + a.gmv_service_fee_net_promo + a.bb_certificate - {_EXPIRED}",
    "gmv_expired_certificates": _EXPIRED, "promo_total_with_service": "a.service_promo_total + a.goods_promo_total",
    "direct_fulfilment": "a.packing_costs + coalesce(oc.picking_costs, 0) + a.acquiring_costs",
    "has_contract": "case when ct.company_id is not null then 'Yes' else 'No' end",
    "department": "mi.department", "subdepartment": "mi.subdepartment", "bonus_adjustment": "ad.amount",
    "initiative": "ini.initiative", "initiative_flg": "case when ini.shipment_id is not null then 1 end",
    "first_company_id": "fc.company_id", "first_company_inn": "fc.inn", "first_company_order_dt": "fo.company_first_order_dt",
    **{c: f"fi.{c}" for c in ("finance_expense", "branch_count", "activity_code")},
    **{c: f"act.{c}" for c in ("activity_name", "activity_chapter", "segment", "subsegment")}, "region": "rg.region",
    **{c: f"us.{c}" for c in ("traffic_source", "traffic_source_plus", "utm_source", "utm", "partner_flg", "group_fraud_flg")},
    "picking_costs": "coalesce(oc.picking_costs, 0)", "drive_costs": "coalesce(oc.drive_costs, 0)",
    "taxi_costs": "coalesce(oc.taxi_costs, 0)", "delivery_cost": "coalesce(oc.drive_costs, 0) + coalesce(oc.taxi_costs, 0)",
    "cp1": f"""case when a.shipment_state = 'shipped' then a.gross_profit else 0 end
      - ((coalesce(oc.picking_costs, 0) - case when a.shipment_state = 'shipped' then a.picking_fee else 0 end)
         + (coalesce(oc.drive_costs, 0) + coalesce(oc.taxi_costs, 0) - case when a.shipment_state = 'shipped' then a.delivery_fee else 0 end)
         + case when a.shipment_state = 'shipped' then a.acquiring_costs + a.packing_costs else 0 end)""",
    "order_type": channel_sql("a"),
    "new_or_repeat": "case when pv.first_order_shipment_id_phone = a.shipment_id then 'new' else 'repeat' end",
    "new_or_repeat_company": "case when cf.first_id = a.shipment_id then 'new' else 'repeat' end",
    "new_or_repeat_group": "case when gf.first_id = a.shipment_id then 'new' else 'repeat' end",
    "group_first_order_dt": "g.group_first_order_dt", "group_last_order_dt": "g.group_last_order_dt",
    "company_first_order_dt": "cf.company_first_order_dt",
}
for _n in ("first_order_dt", "last_order_dt", "first_order_shipment_id_phone", "user_gmv", "user_order_cnt",
           "user_active_months_count", "user_age_month", "user_avg_orders_per_active_month",
           "user_avg_orders_per_month", "user_avg_arpu_per_month", "user_aov"):
    _MART_EXPR[_n] = f"pv.{_n}"
for _n, _t in mart.MART_SCHEMA:
    if _n.startswith("ret_"):
        _MART_EXPR[_n] = f"cast(pr.{_n} as integer)"
    elif _n.startswith("group_ret_"):
        _MART_EXPR[_n] = f"cast(gr.{_n} as integer)"

_DUCK_TYPE = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE",
              "timestamp_ntz": "TIMESTAMP"}


def _mart_col(name: str, typ: str) -> str:
    e = f"try_cast(({_MART_EXPR.get(name, 'a.' + name)}) as {_DUCK_TYPE[typ]})"
    if name in mart.MART_DEFAULTS:
        e = f"coalesce({e}, {mart.MART_DEFAULTS[name]!r})"
    return f"{e} as {name}"


_FEED_VIEWS = ("v_adjustment", "v_initiative", "v_sales_contract", "v_manager_info", "v_group_company", "v_company_reg", "v_firm", "v_activity",
               "v_region_city", "v_employee_period", "v_company_source")
_MART_SELECT = ("select " + ",\n  ".join(_mart_col(n, t) for n, t in mart.MART_SCHEMA) + f"""
from a left join comp c on c.company_inn = a.company_inn
left join pv on pv.phone = a.phone left join pret pr on pr.phone = a.phone
left join gf on gf.company_group_id = a.company_group_id
left join gfl g on g.company_group_id = a.company_group_id left join gret gr on gr.company_group_id = a.company_group_id
left join v_order_cost oc on oc.shipment_id = a.shipment_id
left join (select c2.company_id, min({ld('a2.shipped_at')}) as company_first_order_dt,
             arg_min(a2.shipment_id, (a2.shipped_at, a2.shipment_id)) as first_id
           from a a2 join comp c2 on c2.company_inn = a2.company_inn
           where a2.shipment_state = 'shipped' and a2.shipped_at is not null and c2.company_id is not null group by c2.company_id) cf
  on cf.company_id = c.company_id
left join (select distinct company_id from v_sales_contract where archived_at is null) ct on ct.company_id = c.company_id
left join (select distinct on (manager_id) * from v_manager_info where manager_id <> 0 order by manager_id, department, subdepartment) mi
  on mi.manager_id = """ + _ASSIGNED_A + """
left join (select user_id, s.*, case when utm_source in ('partner', 'partner_story')
             or traffic_source in ('partner_site', 'partner_landing', 'partner_lead') then 1 else 0 end as partner_flg,
             utm_source || '_' || utm_medium || '_' || utm_term as utm,
             case when regexp_matches(lower(coalesce(c3.manager_comment, '')), 'test|fraud|физик|фрод|тест|ликвид') then 1 else 0 end as group_fraud_flg
           from (select p.user_id, arg_min(r.company_id, (p.created_at, r.company_id)) as company_id, arg_min(r.inn, (p.created_at, r.company_id)) as inn
                 from v_employee_period p join v_company_reg r using (company_id) group by p.user_id) f
           left join v_company_source s on s.company_inn = f.inn left join v_company c3 on c3.company_id = f.company_id) us on us.user_id = a.user_id
left join (select gc.company_group_id, arg_min(r.company_id, (r.created_at, r.company_id)) as company_id, arg_min(r.inn, (r.created_at, r.company_id)) as inn
           from v_group_company gc join v_company_reg r using (company_id) group by gc.company_group_id) fc on fc.company_group_id = a.company_group_id
left join (select c2.company_id, min(""" + ld("a2.shipped_at") + """) as company_first_order_dt
           from a a2 join comp c2 on c2.company_inn = a2.company_inn where a2.shipment_state = 'shipped' group by c2.company_id) fo on fo.company_id = fc.company_id
left join v_firm fi on fi.inn = fc.inn left join v_activity act on act.activity_code = fi.activity_code
left join v_region_city rg on rg.region_key = substr(fi.registration_no, 1, 2)
left join (select shipment_id, sum(amount) as amount from v_adjustment where adjustment_type in ('bonus_thanks', 'bonus_loyalty') group by shipment_id) ad
  on ad.shipment_id = a.shipment_id
left join (select shipment_id, min(type_of_initiative) as initiative from v_initiative group by shipment_id) ini on ini.shipment_id = a.shipment_id""")


@register("b2b_mart", with_views(_MART_SELECT, "v_shipment", "v_shipment_wide", "v_certificate", "v_user_group", "v_manager_period", "v_company",
                                 "v_order_cost", *_FEED_VIEWS, extra=[
                                     (n, q.replace("from v_shipment", "from v_shipment_wide") if n == "s" else q) for n, q in _MART_CTES]))
def b2b_mart(spark, sf):
    return mart.b2b_mart(spark, sf)


# ---------------------------------------------------------------- K4 recipients (S3 sheet, J7 key, S10)

_STORE_CONFIG = """select distinct store_id, 'R' || cast(retailer_id as varchar) || '-' || lpad(cast(store_id as varchar), 4, '0')
  as import_key from v_shipment"""
_DIRECTORS = """select distinct lpad(cast(store_id as varchar), 4, '0') as key_number,
  'Director' || cast(store_id as varchar) || '@Example.org' as director_email,
  case when store_id % 3 = 0 then null else 'deputy' || cast(store_id as varchar) || '@example.org' end as zamdirector_email
  from v_shipment"""


def _store_fixtures(spark, sf):
    """Store configs and the directors sheet, derived by Spark from the
    shipments' stores; the sheet is written as CSV and read back like the
    users' spreadsheet (text keys, required key, duplicates dropped)."""
    from martlet.sources import io as sio

    ship = view(spark, sf, "v_shipment").select("retailer_id", "store_id").distinct()
    configs = ship.select("store_id", F.concat(F.lit("R"), F.col("retailer_id").cast("string"), F.lit("-"),
                                               F.lpad(F.col("store_id").cast("string"), 4, "0")).alias("import_key"))
    sheet = ship.select(
        F.lpad(F.col("store_id").cast("string"), 4, "0").alias("key_number"),
        F.concat(F.lit("Director"), F.col("store_id").cast("string"), F.lit("@Example.org")).alias("director_email"),
        F.when(F.col("store_id") % 3 != 0, F.concat(F.lit("deputy"), F.col("store_id").cast("string"),
                                                    F.lit("@example.org"))).alias("zamdirector_email"))
    path = sio.scratch_path(spark, "directors")
    sio.write_report(sheet.unionAll(sheet), path, fmt="csv")
    directors = sio.read_reference(spark, path, [("key_number", "string"), ("director_email", "string"),
                                                 ("zamdirector_email", "string")], required=["key_number"])
    return configs, directors


@register("pulse_big_order_recipients", with_views(f"""
select shipment_number, list_sort(list_distinct(list(lower(mail)))) as recipients,
  array_to_string(list_sort(list_distinct(list(lower(mail)))), '; ') as recipients_text
from (
  select b.shipment_number, coalesce(d.manager_email, '{_FB.email}') as mail
  from (select distinct shipment_number, company_id, store_id from big) b left join dir d on d.company_id = b.company_id
  union all
  select b.shipment_number, unnest([r.director_email, r.zamdirector_email]) as mail
  from (select distinct shipment_number, company_id, store_id from big) b
  join sc on sc.store_id = b.store_id join ds r on r.key_number = substring(sc.import_key, instr(sc.import_key, '-') + 1, 15)
) t where mail is not null group by shipment_number""", *_PULSE_VIEWS, "v_locked_order", extra=[
    *_gated(BIG_OR),
    ("big", _big_sql(BIG_OR)), ("sc", _STORE_CONFIG), ("ds", _DIRECTORS)]))
def pulse_big_order_recipients(spark, sf):
    src = pulse.Sources.fixture(spark, sf)
    configs, directors = _store_fixtures(spark, sf)
    return pulse.recipients(pulse.big_orders(src, BIG_OR), src.directory, configs, directors)


# ---------------------------------------------------------------- K5 two-stage ledger

OVER_LIMIT_2 = pulse.PulseConfig("pulse_a", scan_ledger="pulse_b", retailer_ids=(2, 8), window_days=60,
                                 window_basis="completed")


@register("pulse_over_limit_ledger", with_views(f"""
select shipment_number, 'pulse_b' as process_name, {ASOF} as shipment_logged_at
from (select distinct shipment_number from c where {_gate_sql('c', 'c.company_id')}) t
union all
select distinct c.shipment_number, 'pulse_a', {ASOF}
from c join v_line_item li on li.shipment_id = c.shipment_id and li.deleted_at is null
join v_offer o on o.id = li.offer_id join v_offer_limit lim on lim.retailer_sku = o.retailer_sku
where {_gate_sql('c', 'c.company_id')} and lim.max_qty is not null and li.quantity > lim.max_qty""",
                                                *_PULSE_VIEWS, "v_offer_limit", "v_locked_order",
                                                extra=_gated(pulse.PulseConfig(
                                                    "pulse_b", retailer_ids=(2, 8), window_days=60,
                                                    window_basis="completed"))))
def pulse_over_limit_ledger(spark, sf):
    return pulse.over_limit_ledgers(pulse.Sources.fixture(spark, sf), OVER_LIMIT_2)


# ---------------------------------------------------------------- K2 two feeds with a shared ledger

FEED_STORE = pulse.PulseConfig("pulse_a", store_ids=(13,), window_days=30)
FEED_RETAILERS = pulse.PulseConfig("pulse_b", retailer_ids=(3, 5), exclude_store_ids=(13,), window_days=30)


def _feed_sql(cfg, feed: str) -> str:
    scope = (f"s.store_id in ({', '.join(map(str, cfg.store_ids))})" if cfg.store_ids else
             f"s.retailer_id in ({', '.join(map(str, cfg.retailer_ids))})"
             + (f" and s.store_id not in ({', '.join(map(str, cfg.exclude_store_ids))})" if cfg.exclude_store_ids else ""))
    return f"""
select distinct {lts('s.completed_at')} as completed_local, {lts('w.ends_at')} as slot_end_local, s.shipment_number,
  li.quantity, li.price, o.name as offer_name,
  coalesce(d.manager_email, '{_FB.email}') as manager_email, coalesce(d.manager_phones, '{_FB.phone}') as manager_phones,
  coalesce(d.manager_name, '{_FB.name}') as manager_name, '{feed}' as feed
from v_shipment s join v_delivery_window w on w.id = s.shipment_id join v_company_order co on co.order_id = s.order_id
join v_line_item li on li.shipment_id = s.shipment_id and li.deleted_at is null
join v_offer o on o.id = li.offer_id left join dir d on d.company_id = co.company_id
where {scope} and s.shipment_state in ('complete', 'shipped')
  and {ld('w.starts_at')} >= {ASOF_DATE} - {cfg.window_days}
  and not exists (select 1 from v_ledger g where g.shipment_number = s.shipment_number
                  and g.process_name in ('pulse_a', 'pulse_b'))"""


@register("pulse_two_feeds", with_views(_feed_sql(FEED_STORE, "pulse_a") + "\nunion all\n"
                                        + _feed_sql(FEED_RETAILERS, "pulse_b"),
                                        *_PULSE_VIEWS, extra=[("dir", _DIRECTORY)]))
def pulse_two_feeds(spark, sf):
    return pulse.new_orders_feeds(pulse.Sources.fixture(spark, sf), [FEED_STORE, FEED_RETAILERS])


# Scopes with every filter; the over-limit job has a ledger of scans of its own.
FILTERED_FEEDS = [replace(FEED_STORE, window_days=900, tenant_ids=("tenant_main",), platforms=("web", "app")),
                  replace(FEED_RETAILERS, window_days=900, payment_methods=(3, 4, 5), lines_by="order_id")]
FILTERED_LIMIT = pulse.PulseConfig("pulse_a", retailer_ids=(2, 8), states=("complete",), window_days=900, window_basis="completed",
                                   exclude_store_ids=(2, 22), payment_methods=(3, 4, 5, 7), tenant_ids=("tenant_main",),
                                   platforms=("web",), scan_ledger="scans")
_FILTERED_SQL = {
    "pulse_a": "s.tenant_id in ('tenant_main') and s.platform in ('web', 'app')",
    "pulse_b": "s.payment_method_id in (3, 4, 5)"}


@register("pulse_two_feeds_filtered", with_views("\nunion all\n".join(
    _feed_sql(c, c.process_name).replace("li.shipment_id = s.shipment_id", f"li.{c.lines_by} = s.{c.lines_by}")
    + f" and {_FILTERED_SQL[c.process_name]}" for c in FILTERED_FEEDS), *_PULSE_VIEWS, extra=[("dir", _DIRECTORY)]))
def pulse_two_feeds_filtered(spark, sf):
    """K2 feeds that keep their own filters and their own join of the lines."""
    return pulse.new_orders_feeds(pulse.Sources.fixture(spark, sf), FILTERED_FEEDS)


@register("pulse_over_limit_ledger_filtered", with_views(f"""
select distinct shipment_number, 'scans' as process_name, {ASOF} as shipment_logged_at
from c where {_gate_sql('c', 'c.company_id')}
union all
select distinct c.shipment_number, 'pulse_a', {ASOF}
from c join v_line_item li on li.shipment_id = c.shipment_id and li.deleted_at is null
join v_offer o on o.id = li.offer_id join v_offer_limit lim on lim.retailer_sku = o.retailer_sku
where {_gate_sql('c', 'c.company_id')} and lim.max_qty is not null and li.quantity > lim.max_qty""",
                                                         *_PULSE_VIEWS, "v_offer_limit", "v_locked_order",
                                                         extra=[("dir", _DIRECTORY), ("c", _cand_sql(replace(
                                                             FILTERED_LIMIT, process_name="scans"), slot=False) + """
    and s.store_id not in (2, 22) and s.payment_method_id in (3, 4, 5, 7) and s.tenant_id = 'tenant_main' and s.platform = 'web'"""),
                                                                ("bal", _bal_sql(_DUE_OF_C))]))
def pulse_over_limit_ledger_filtered(spark, sf):
    """K5: what is logged as scanned is what the job's filters let it check."""
    return pulse.over_limit_ledgers(pulse.Sources.fixture(spark, sf), FILTERED_LIMIT)


@register("vault_hub", f"""
select md5({_part('o_custkey')}) as hub_key, o_custkey, 'orders' as record_source
from (select distinct o_custkey from orders) t""")
def vault_hub(spark, sf):
    return history.hub(spark.read.parquet(f"{sf}/orders.parquet"), "o_custkey", "orders")


_SW_BASE = f"""select *, cast(date_trunc('week', {ld('shipped_at')}) as date) as week from v_shipment
  where shipment_state = 'shipped' and b2b_measure in (1, 2) and retailer_id in (6)
    and shipped_at > timestamp '1995-01-01 00:00:00'"""
_SW_PER_SHIPMENT = """select s.shipment_id, s.week, s.store_id, count(distinct li.offer_id) as sku_cnt
  from v_line_item li join s using (shipment_id) where li.deleted_at is null group by all"""


@register("store_week_stats", with_views("""
select strftime(p.week, '%Y-%m-%d') as week, p.store_id, p.gmv_net_promo, p.gmv, p.orders_cnt, k.sum_sku_cnt,
  cast(k.sum_sku_cnt as double) / p.orders_cnt as avg_sku_per_order
from (select week, store_id, sum(gmv_goods_net_promo + gmv_service_fee_net_promo) as gmv_net_promo,
        sum(total) as gmv, count(distinct shipment_id) as orders_cnt from s group by all) p
left join (select week, store_id, sum(sku_cnt) as sum_sku_cnt from ps group by all) k using (week, store_id)""",
                                         "v_shipment", "v_line_item", extra=[("s", _SW_BASE), ("ps", _SW_PER_SHIPMENT)]))
def store_week_stats(spark, sf):
    return weekly.store_week_stats(view(spark, sf, "v_shipment"), view(spark, sf, "v_line_item"), retailer_ids=(6,))


@register("store_sku_week_prices", with_views(f"""
select strftime(s.week, '%Y-%m-%d') as week, s.store_id, l.retailer_sku, avg(l.price) as avg_price,
  count(distinct s.shipment_id) as orders_cnt
from (select shipment_id, store_id, cast(date_trunc('week', {ld('shipped_at')}) as date) as week from v_shipment
      where shipment_state = 'shipped' and b2b_measure in (1, 2) and retailer_id in (6)
        and cast(date_trunc('week', {ld('shipped_at')}) as date) = cast(date_trunc('week', {ASOF}) as date) - 7) s
left join (select li.shipment_id, li.price, o.retailer_sku from v_line_item li join v_offer o on o.id = li.offer_id
           where li.deleted_at is null) l using (shipment_id)
group by all""", "v_shipment", "v_line_item", "v_offer"))
def store_sku_week_prices(spark, sf):
    return weekly.store_sku_week_prices(view(spark, sf, "v_shipment"), view(spark, sf, "v_line_item"),
                                        view(spark, sf, "v_offer"), retailer_ids=(6,))


# ---------------------------------------------------------------- pulse variants

FILTERED = pulse.PulseConfig("pulse_f", retailer_ids=tuple(range(10)), states=("complete",), window_days=900, window_basis="completed_date",
                             payment_methods=(3, 4, 5), tenant_ids=("tenant_main",), platforms=("web",))


@register("pulse_filtered", with_views(f"""
select distinct s.shipment_number, {lts('s.completed_at')} as completed_local, o.name as offer_name, li.quantity, li.price
from v_shipment s join v_delivery_window w on w.id = s.shipment_id join v_company_order co on co.order_id = s.order_id
join v_line_item li on li.shipment_id = s.shipment_id and li.deleted_at is null join v_offer o on o.id = li.offer_id
where s.shipment_state = 'complete' and s.payment_method_id in (3, 4, 5) and s.tenant_id = 'tenant_main' and s.platform = 'web'
  and {ld('s.completed_at')} >= {ASOF_DATE} - 900""", *_PULSE_VIEWS))
def pulse_filtered(spark, sf):
    """K2 with payment method, tenant and platform filters and a date window."""
    report = pulse.new_orders(pulse.Sources.fixture(spark, sf), FILTERED)
    return report.select("shipment_number", "completed_local", "offer_name", "quantity", "price").distinct()


NEXT_DAY_STATE = pulse.PulseConfig("next_day", retailer_ids=tuple(range(10)), states=("complete", "shipped"), gate="state")


@register("pulse_next_day_state", with_views(f"""
select distinct s.shipment_number, {lts('s.completed_at')} as completed_local, {lts('w.starts_at')} as slot_start_local,
  o.name as offer_name, li.quantity, s.payment_method_name, s.total_weight
from v_shipment s join v_delivery_window w on w.id = s.shipment_id
join v_line_item li on li.shipment_id = s.shipment_id and li.deleted_at is null join v_offer o on o.id = li.offer_id
left join v_company_order co on co.order_id = s.order_id
where s.shipment_state in ('complete', 'shipped') and cast(w.starts_at as date) = {_ND_DATE}
  and (s.payment_state not in ('not_paid', 'failed') or co.company_id in (select company_id from dir where con_flag = 'postpay'))""",
                                             *_PULSE_VIEWS, extra=[("dir", _DIRECTORY)]))
def pulse_next_day_state(spark, sf):
    """K3 behind the state gate: the payment did not fail, or a postpay company."""
    return pulse.next_day(pulse.Sources.fixture(spark, sf), NEXT_DAY_STATE, as_of=ND_AS_OF)


# The two jobs of a retailer that is split by zone, slots by the zone's day.
NEXT_DAY_ZONE = replace(NEXT_DAY, exclude_zones=("Zone 1",), slot_day="local")


def _zone_sql(body: str, zone: str, day: str) -> str:
    """A next-day text with the slot's day as ``day`` and stores whose zone fits."""
    return body.replace("cast(w.starts_at as date) =", f"{day} =").replace(
        "where s.retailer_id", f"where s.store_id in (select store_id from v_store where zone {zone}) and s.retailer_id")


_ZONED = dict(zone="<> 'Zone 1'", day=ld("w.starts_at"))


@register("pulse_next_day_zone", with_views("select * from nd", *_PULSE_VIEWS, "v_locked_order", "v_store", extra=[
    ("dir", _DIRECTORY), ("bal", _zone_sql(_BAL_SQL, **_ZONED)), ("nd", _zone_sql(_NEXT_DAY_SQL, **_ZONED))]))
def pulse_next_day_zone(spark, sf):
    """K3 for stores of a known zone but one, by the slot's day in the report zone."""
    return pulse.next_day(pulse.Sources.fixture(spark, sf), NEXT_DAY_ZONE, as_of=ND_AS_OF)


_CONTACT = "cl.firstname || ' ' || cl.lastname as contact_name, coalesce(cl.pending_email, cl.email) as contact_email"
_IN_ZONE = dict(zone="<> 'Zone 1'", day="cast(w.starts_at as date)")
_ZONE_BASE = [("dir", _DIRECTORY), ("bal", _zone_sql(_BAL_SQL, **_IN_ZONE)),
              ("cb", _zone_sql(_CONSIGNEE_BASE.replace("s.store_id, co", "s.store_id, s.order_id, s.user_id, co"), **_IN_ZONE))]


@register("pulse_consignees_filed", with_views(f"""
select distinct c.inn, c.kpp, c.name as company_name, b.shipment_number, {_CONTACT}, o.name as offer_name, li.quantity,
  case when b.store_id = 42 then 'special_store' else 'other' end as route
from cb b join v_line_item li on li.order_id = b.order_id and li.deleted_at is null and li.quantity >= 2
join v_offer_filed o on o.id = li.offer_id and o.category_id between 1 and 40
join v_company_tax c on c.company_id = b.company_id left join v_client cl on cl.user_id = b.user_id""",
                                               *_PULSE_VIEWS, "v_locked_order", "v_store", "v_company_tax", "v_offer_filed", "v_client", extra=_ZONE_BASE))
def pulse_consignees_filed(spark, sf):
    """K3's consignees of the zones but one: categories by id, the whole order's lines, contacts."""
    v = lambda n: view(spark, sf, n)
    src = replace(pulse.Sources.fixture(spark, sf), offers=v("v_offer_filed"))
    cfg = replace(NEXT_DAY, exclude_zones=("Zone 1",), lines_by="order_id")
    return pulse.consignees(src, cfg, v("v_company_tax"), as_of=ND_AS_OF, min_qty=2, special_store=42,
                            category_ids=tuple(range(1, 41)), clients=v("v_client"))


@register("pulse_consignees_promo", with_views(f"""
select distinct c.inn, c.kpp, c.name as company_name, b.shipment_number, {_CONTACT}
from (select distinct s.shipment_number, s.order_id, s.user_id, co.company_id
      from v_shipment s join v_delivery_window w on w.id = s.shipment_id left join v_company_order co on co.order_id = s.order_id
      where s.retailer_id in ({_ND_RET}) and s.shipment_state in ('complete', 'shipped') and cast(w.starts_at as date) = {_ND_DATE}
        and {_gate_sql('s', 'co.company_id')}) b
join v_company_tax c on c.company_id = b.company_id left join v_client cl on cl.user_id = b.user_id
where b.order_id in (select order_id from v_order_promo where promo_code in ('PROMO1', 'PROMO4', 'PROMO5', 'PROMO8'))""",
                                               *_PULSE_VIEWS, "v_locked_order", "v_order_promo", "v_company_tax", "v_client",
                                               extra=[("dir", _DIRECTORY), ("bal", _BAL_SQL)]))
def pulse_consignees_promo(spark, sf):
    """K3's consignees of orders with one of some promo codes."""
    v = lambda n: view(spark, sf, n)
    return pulse.promo_consignees(pulse.Sources.fixture(spark, sf), NEXT_DAY, v("v_order_promo"), v("v_company_tax"), v("v_client"),
                                  ("PROMO1", "PROMO4", "PROMO5", "PROMO8"), as_of=ND_AS_OF)


@register("manager_directory_tax", with_views("select * from dir", "v_company_tax", "v_company_manager", "v_user", "v_phone", extra=[
    ("dir", _DIRECTORY.replace("c.inn,", "c.inn, c.kpp,").replace("company_id, inn,", "company_id, inn, kpp,").replace("v_company)", "v_company_tax)"))]))
def manager_directory_tax(spark, sf):
    """K11 with the registration reason code."""
    v = lambda n: view(spark, sf, n)
    return dirs.manager_directory(v("v_company_tax"), v("v_company_manager"), v("v_user"), v("v_phone"))


@register("manager_mails", with_views(f"""
select distinct cm.company_id, coalesce(u.email, '{_FB.email}') as manager_email
from v_company_manager cm left join v_user u on u.id = cm.user_id where cm.deleted_at is null""", "v_company_manager", "v_user"))
def manager_mails(spark, sf):
    """K11, mail only."""
    return dirs.manager_mails(view(spark, sf, "v_company_manager"), view(spark, sf, "v_user"))


@register("pulse_over_limit_contacts", with_views(f"""
select distinct c.shipment_number, c.store_id, o.retailer_sku, li.quantity, lim.max_qty, ds.director_email as contact
from c join v_line_item li on li.shipment_id = c.shipment_id and li.deleted_at is null
join v_offer o on o.id = li.offer_id join v_offer_limit lim on lim.retailer_sku = o.retailer_sku
left join sc on sc.store_id = c.store_id
left join (select * from ds where zamdirector_email is not null) ds
  on ds.key_number = substring(sc.import_key, instr(sc.import_key, '-') + 1, 15)
where {_gate_sql('c', 'c.company_id')} and lim.max_qty is not null and li.quantity > lim.max_qty""",
                                                  *_PULSE_VIEWS, "v_offer_limit", "v_locked_order",
                                                  extra=[*_gated(OVER_LIMIT), ("sc", _STORE_CONFIG), ("ds", _DIRECTORS)]))
def pulse_over_limit_contacts(spark, sf):
    """K5 with store contacts (a third of the stores have none)."""
    configs, directors = _store_fixtures(spark, sf)
    contacts = directors.where(F.col("zamdirector_email").isNotNull()).select("key_number", F.col("director_email").alias("contact"))
    return pulse.over_limit_contacts(pulse.Sources.fixture(spark, sf), OVER_LIMIT, configs, contacts)


# ---------------------------------------------------------------- K14, K15 a day or a load at a time

_HISTORY = ["o_custkey", "value", "valid_from", "valid_to", "is_current"]


@register("scd2_merge", ORACLE["scd2_build"])
def scd2_merge(spark, sf):
    """The history up to the day before the last three, then those days one
    by one, the last of them twice."""
    snaps = _snapshots(spark, sf)
    days = [r[0] for r in snaps.select("snapshot_date").distinct().orderBy(F.desc("snapshot_date")).limit(3).collect()][::-1]
    state = cut_lineage(history.scd2(snaps.where(F.col("snapshot_date") < days[0]), "o_custkey"), "history")
    for day in [*days, days[-1]]:
        today = snaps.where(F.col("snapshot_date") == day).drop("snapshot_date")
        state = cut_lineage(history.scd2_merge(state, today, "o_custkey", str(day)), "history")
    return state.select(*_HISTORY)


@register("vault_increment", with_views(f"""
select 'satellite' as kind, md5({_part('o_custkey')}) as key, snapshot_date as load_date, md5({_part('value')}) as hashdiff
from (select *, lag(value) over (partition by o_custkey order by snapshot_date) as prev,
        row_number() over (partition by o_custkey order by snapshot_date) as rn from snap) t
where rn = 1 or prev is distinct from value
union all
select 'hub', md5({_part('o_custkey')}), null, null from (select distinct o_custkey from orders) t
union all
select 'link', md5({_part('o_custkey')} || {_part('o_orderkey')}), null, null
from (select distinct o_custkey, o_orderkey from orders) t""", extra=[("snap", _SNAP)]))
def vault_increment(spark, sf):
    """Two loads into an empty vault, cut at a day, and the second again."""
    orders, snaps = spark.read.parquet(f"{sf}/orders.parquet"), _snapshots(spark, sf)
    cut = F.lit("1997-06-01").cast("date")
    at = F.col("o_orderdate").cast("date")
    loads = [(orders.where(at < cut), snaps.where(F.col("snapshot_date") < cut))] + [(orders.where(at >= cut), snaps.where(F.col("snapshot_date") >= cut))] * 2
    hubs = history.hub(orders.limit(0), "o_custkey", "orders")
    links = history.link(orders.limit(0), ["o_custkey", "o_orderkey"], "orders")
    sats = history.satellite(snaps.limit(0), "o_custkey", ["value"], "snapshot_date", "orders")
    for rows, days in loads:
        hubs = cut_lineage(hubs.unionByName(history.hub_load(hubs, rows, "o_custkey", "orders")), "hub")
        links = cut_lineage(links.unionByName(history.link_load(links, rows, ["o_custkey", "o_orderkey"], "orders")), "link")
        sats = cut_lineage(sats.unionByName(history.satellite_load(sats, days, "o_custkey", ["value"], "snapshot_date", "orders")), "satellite")
    none = [F.lit(None).cast("date").alias("load_date"), F.lit(None).cast("string").alias("hashdiff")]
    return (sats.select(F.lit("satellite").alias("kind"), F.col("hub_key").alias("key"), "load_date", "hashdiff")
            .unionByName(hubs.select(F.lit("hub").alias("kind"), F.col("hub_key").alias("key"), *none))
            .unionByName(links.select(F.lit("link").alias("kind"), F.col("link_key").alias("key"), *none)))
