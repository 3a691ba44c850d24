"""Shapes of the reference's source tables, derived from the test tables.

Each view is one SQL text that runs unchanged in Spark SQL and in DuckDB
(two views have a Spark form with a generator instead of a join, see
``SPARK_VIEWS``). Base tables are written as ``{name}`` placeholders: Spark binds them to
DataFrames (``spark.sql(text, orders=df)``, nothing is registered in the
session), the oracle binds them to the pre-registered DuckDB views.

The modulo expressions only *shape* values (which rows carry a NULL, a flag,
a second feed); every view reads its whole base table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from martlet.sources.tables import table

VIEWS: dict[str, str] = {
    "v_shipment": """
select o_orderkey as shipment_id, cast(floor(o_orderkey/2) as bigint) as order_id,
  concat('H', cast(o_orderkey as string)) as shipment_number, o_custkey as user_id,
  case when o_custkey % 37 = 0 then null else concat('7', cast(o_custkey as string)) end as phone,
  case when o_orderkey % 29 = 0 then null else o_orderdate + interval '1' hour * (o_orderkey % 24) end as shipped_at,
  o_orderdate + interval '1' hour * (o_orderkey % 24 + 3) as starts_at,
  o_orderdate as completed_at,
  cast(o_orderkey % 5 as int) as b2b_measure, cast(floor(o_orderkey/5) as bigint) % 2 as b2b_order_company_flg,
  case o_orderstatus when 'F' then 'shipped' when 'O' then 'complete' else 'canceled' end as shipment_state,
  case o_orderpriority when '1-URGENT' then 'paid' when '2-HIGH' then 'overpaid' when '3-MEDIUM' then 'balance_due' when '4-NOT SPECIFIED' then 'not_paid' else 'failed' end as payment_state,
  cast(o_orderkey % 21 as int) as payment_method_id,
  case when o_orderkey % 21 = 11 then 'invoice' else 'card' end as payment_method_name,
  o_totalprice as total,
  case when o_orderkey % 3 = 0 then o_totalprice when o_orderkey % 3 = 1 then o_totalprice - 400 else 0.0 end as payment_total,
  floor((o_totalprice * 0.9) * 100) / 100 as gmv_goods_net_promo, floor((o_totalprice * 0.02) * 100) / 100 as gmv_service_fee_net_promo,
  floor((o_totalprice * 0.92) * 100) / 100 as goods, floor((o_totalprice * 0.05) * 100) / 100 as total_cost,
  floor((o_totalprice * 0.15) * 100) / 100 as gross_profit, cast((o_orderkey % 100) * 1000 as bigint) as total_weight,
  case when o_orderkey % 2 = 0 then 'web' else 'app' end as platform,
  case o_orderkey % 7 when 0 then 'tenant_b2b' when 1 then 'tenant_wl' else 'tenant_main' end as tenant_id,
  cast(o_orderkey % 10 as int) as retailer_id, cast(o_orderkey % 50 as int) as store_id,
  lpad(cast(o_custkey as string), 10, '0') as company_inn
from {orders}""",
    "v_line_item": """
select l_orderkey as shipment_id, cast(floor(l_orderkey/2) as bigint) as order_id, l_partkey as offer_id,
  l_suppkey as supplier_id, l_quantity as quantity, floor((l_extendedprice / l_quantity) * 100) / 100 as price,
  l_extendedprice as line_total, floor(l_tax * 100 + 0.5) as vat_rate, l_shipdate as shipped_at,
  case when l_returnflag = 'R' then l_shipdate end as deleted_at
from {lineitem}""",
    "v_company": """
select c_custkey as company_id, lpad(cast(c_custkey as string), 10, '0') as inn, c_name as name,
  c_custkey % 4 = 0 as postpay_flg, c_custkey % 6 = 0 as deposit_flg, c_custkey % 3 = 0 as prepay_flg,
  case c_custkey % 17 when 0 then 'TEST account' when 1 then 'Fraud check' when 2 then null else 'ok' end as manager_comment,
  case when c_custkey % 9 = 0 then null else cast(floor(c_acctbal * 300000) as bigint) end as finance_income,
  cast(c_custkey % 400 as int) as employee_count,
  case c_custkey % 13 when 0 then '' when 1 then 'Government' when 2 then 'Charity' else 'Commercial' end as category_type
from {customer}""",
    "v_company_order": """
select cast(floor(o_orderkey/2) as bigint) as order_id, o_custkey as company_id
from {orders} where o_orderkey % 2 = 0 and o_orderkey % 14 <> 0""",
    "v_user_group": """
select c_custkey as user_id, case when c_custkey % 11 = 0 then null else c_nationkey end as company_group_id
from {customer}""",
    "v_manager_period": """
select n_nationkey as company_group_id, make_date(1995 + k, 1, 1) as start_period,
  make_date(1995 + k, 12, 31) as end_period, (n_nationkey * 7 + k) % 10 as manager_id
from {nation} cross join (select 0 as k union all select 1 union all select 2 union all select 3 union all select 4 union all select 5 union all select 6) p
where (n_nationkey + k) % 5 <> 0""",
    "v_company_manager": """
select c_custkey as company_id, c_custkey % 10 as user_id,
  case when c_custkey % 8 = 0 then timestamp '1999-01-01 00:00:00' end as deleted_at
from {customer} where c_custkey % 5 <> 0""",
    "v_user": """
select s_suppkey as id, concat('F', cast(s_suppkey as string)) as firstname, concat('L', cast(s_suppkey as string)) as lastname,
  case when s_suppkey % 4 = 0 then null else concat('u', cast(s_suppkey as string), '@example.org') end as email,
  case when s_suppkey % 3 = 0 then concat('p', cast(s_suppkey as string), '@temp.temp') end as pending_email
from {supplier}""",
    "v_phone": """
select s_suppkey as user_id, case when (s_suppkey + k) % 4 = 0 then '' else concat('7000', cast(s_suppkey * 10 + k as string)) end as value,
  make_date(1999, 1 + k, 1) as created_at
from {supplier} cross join (select 0 as k union all select 1 union all select 2) p""",
    "v_offer": """
select p_partkey as id, p_name as name, concat('SKU', cast(p_partkey as string)) as retailer_sku, p_brand as brand,
  p_type as category, p_retailprice as price, case when p_partkey % 7 = 0 then 0 else 1 end as published,
  1 as status, case when p_partkey % 23 = 0 then timestamp '1999-01-01 00:00:00' end as deleted_at
from {part}""",
    "v_offer_price": """
select l_partkey as offer_id, l_shipdate as dt, max(floor((l_extendedprice / l_quantity) * 100) / 100) as price,
  nullif(max(l_discount), 0.0) as discount
from {lineitem} group by l_partkey, l_shipdate""",
    "v_certificate": """
select o_orderkey as shipment_id from {orders} where o_orderkey % 15 = 0 and o_orderstatus = 'F'""",
    "v_delivery_window": """
select o_orderkey as id, o_orderdate + interval '1' hour * (o_orderkey % 24) as starts_at,
  o_orderdate + interval '1' hour * (o_orderkey % 24 + 2) as ends_at
from {orders}""",
    "v_locked_order": """
select cast(floor(o_orderkey/2) as bigint) as order_id, case when o_orderkey % 38 = 0 then 'locked' else 'free' end as export_lock_state
from {orders} where o_orderkey % 2 = 0""",
    "v_ledger": """
select concat('H', cast(o_orderkey as string)) as shipment_number,
  case when o_orderkey % 8 = 0 then 'pulse_a' else 'pulse_b' end as process_name
from {orders} where o_orderkey % 4 = 0""",
    "v_order_cost": """
select o_orderkey as shipment_id, floor((o_totalprice * 0.01) * 100) / 100 as picking_costs,
  floor((o_totalprice * 0.02) * 100) / 100 as drive_costs, floor((o_totalprice * 0.005) * 100) / 100 as taxi_costs
from {orders} where o_orderkey % 3 <> 0""",
    "v_offer_limit": """
select concat('SKU', cast(p_partkey as string)) as retailer_sku, case when p_partkey % 10 = 0 then null else cast(20 + p_partkey % 25 as int) end as max_qty
from {part} where p_partkey % 3 = 0""",
    "v_category": """
select p_partkey as id, case when p_partkey < 10 then null else cast(floor(p_partkey/10) as bigint) end as parent_id
from {part}""",
    "v_user_auth": """
select c_custkey as user_id, case when c_custkey % 3 = 0 then 'plan' when c_custkey % 3 = 1 then 'bank' else 'other' end as provider
from {customer}""",
    "v_funnel_web": """
select user_id, cast(event_id % 12 as int) as order_seq, ts as completed_at from {events} where event_type = 'purchase' and event_id % 2 = 0""",
    "v_funnel_app": """
select user_id, cast(event_id % 12 as int) as order_seq, ts as completed_at from {events} where event_type = 'purchase' and event_id % 2 = 1""",
    "v_seller_month": """
select l_suppkey as seller_id, l_partkey as item_id, cast(date_trunc('month', l_shipdate) as date) as dt_month, l_extendedprice as amount
from {lineitem}""",
}

# The mart's fact: a shipment with all that the mart passes on or adds up.
_WIDE = """,
  o_orderdate - interval '1' hour * (o_orderkey % 5) as created_at,
  concat('R', cast(cast(floor(o_orderkey/2) as bigint) as string)) as order_number,
  case o_orderkey % 4 when 0 then 'none' when 1 then 'gold' else 'silver' end as prime_lvl,
  o_custkey % 1000 as ship_address_id,
  case when o_orderkey % 3 = 0 then 'pickup' else 'courier' end as type_delivery,
  cast(o_custkey % 25 as int) as city_id, concat('City ', cast(o_custkey % 25 as string)) as city_name,
  concat('Retailer ', cast(o_orderkey % 10 as string)) as retailer_name, concat('Store ', cast(o_orderkey % 50 as string)) as store_name,
  case o_orderkey % 6 when 1 then 'ios' when 3 then 'android' when 5 then 'android' end as os,
  case when o_orderkey % 15 = 0 then floor(o_totalprice * 10) / 100 else 0.0 end as b2b_certificates,
  case when o_orderkey % 9 = 0 then floor(o_totalprice * 3) / 100 else 0.0 end as b2b_certificate_profit,
  cast(o_orderkey % 4 * 100 as bigint) as bb_certificate, floor(o_totalprice * 80) / 100 as goods_house,
  floor(o_totalprice * 95) / 100 as gmv_goods, floor(o_totalprice * 4) / 100 as goods_promo, floor(o_totalprice * 5) / 100 as goods_promo_total,
  floor(o_totalprice) / 100 as service_promo_total, floor(o_totalprice * 2) / 100 as gmv_advertising, floor(o_totalprice * 3) / 100 as gmv_service_fee,
  floor(o_totalprice * 1.5) / 100 as acquiring_costs, floor(o_totalprice * 0.7) / 100 as packing_costs,
  floor(o_totalprice * 0.9) / 100 as picking_fee, floor(o_totalprice * 1.1) / 100 as delivery_fee,
  case when o_orderkey % 8 = 0 then concat('PROMO', cast(o_custkey % 12 as string)) end as promo_code,
  floor(o_totalprice * 0.3) / 100 as bonus_promo, floor(o_totalprice * 6) / 100 as promo_total, cast(o_orderkey % 3 * 50 as int) as surge_sum,
  cast(1 + o_orderkey % 60 as int) as item_count, cast(o_orderkey % 5 as int) as replaced_items_cnt, cast(o_orderkey % 4 as int) as canceled_items_cnt,
  o_orderkey % 500 as total_quantity
from {orders}"""

# The mart's feeds. Several rows per key are the rule.
VIEWS |= {
    "v_shipment_wide": VIEWS["v_shipment"].replace("\nfrom {orders}", _WIDE),
    "v_user_segment": """
select o_custkey as user_id, concat('Segment ', cast(o_orderkey % 6 as string)) as name, o_orderdate as update_date
from {orders} where o_orderkey % 3 <> 1""",
    "v_adjustment": """
select l_orderkey as shipment_id, case l_linenumber when 1 then 'bonus_thanks' when 2 then 'bonus_loyalty' when 3 then 'bonus_thanks' else 'coupon' end as adjustment_type,
  cast(floor(l_discount * 1000) as bigint) as amount
from {lineitem}""",
    "v_initiative": """
select l_orderkey as shipment_id, concat('Initiative ', cast(l_linenumber as string)) as type_of_initiative
from {lineitem} where l_orderkey % 35 = 0 and l_linenumber > 1""",
    "v_sales_contract": """
select o_custkey as company_id, case when o_orderkey % 48 = 0 then o_orderdate end as archived_at
from {orders} where o_orderkey % 16 = 0""",
    "v_manager_info": """
select s_suppkey % 10 as manager_id, concat('Department ', cast(s_nationkey % 3 as string)) as department,
  concat('Unit ', cast(s_nationkey % 7 as string)) as subdepartment
from {supplier}""",
    "v_group_company": """
select c_nationkey as company_group_id, c_custkey as company_id from {customer}""",
    "v_company_reg": """
select c_custkey as company_id, lpad(cast(c_custkey as string), 10, '0') as inn,
  timestamp '1992-01-01 00:00:00' + interval '1' day * (c_custkey * 37 % 90) as created_at
from {customer}""",
    "v_firm": """
select lpad(cast(c_custkey as string), 10, '0') as inn, concat(lpad(cast(c_custkey % 7 as string), 2, '0'), cast(c_custkey as string)) as registration_no,
  cast(floor(c_acctbal * 200000) as bigint) as finance_expense, cast(c_custkey % 6 as int) as branch_count,
  case when c_custkey % 19 = 0 then null else cast(c_custkey % 30 as int) end as activity_code
from {customer}""",
    "v_activity": """
select n_nationkey as activity_code, concat('Activity ', n_name) as activity_name, concat('Chapter ', cast(n_regionkey as string)) as activity_chapter,
  concat('Segment ', cast(n_nationkey % 4 as string)) as segment, case when n_nationkey % 3 = 0 then null else concat('Part ', cast(n_nationkey % 8 as string)) end as subsegment
from {nation}""",
    "v_region_city": """
select lpad(cast(r_regionkey as string), 2, '0') as region_key, r_name as region from {region}""",
    "v_employee_period": """
select o_custkey as user_id, o_custkey + o_orderkey % 3 as company_id, o_orderdate as created_at from {orders}""",
    "v_company_source": """
select lpad(cast(c_custkey as string), 10, '0') as company_inn,
  case c_custkey % 5 when 0 then 'partner_site' when 1 then 'search' when 2 then 'partner_lead' else 'direct' end as traffic_source,
  case when c_custkey % 10 = 0 then null else concat('plus', cast(c_custkey % 5 as string)) end as traffic_source_plus,
  case c_custkey % 8 when 0 then 'partner' when 1 then 'partner_story' when 2 then null else 'other' end as utm_source,
  concat('m', cast(c_custkey % 3 as string)) as utm_medium, case when c_custkey % 9 = 0 then null else concat('t', cast(c_custkey % 4 as string)) end as utm_term
from {customer}""",
}

# What the next-day jobs read besides: stores' zones, orders' promo codes, clients.
VIEWS |= {
    "v_store": """
select distinct cast(o_orderkey % 50 as int) as store_id,
  case when o_orderkey % 50 % 11 = 10 then null else concat('Zone ', cast(o_orderkey % 50 % 4 as string)) end as zone
from {orders}""",
    "v_order_promo": """
select cast(floor(o_orderkey/2) as bigint) as order_id, concat('PROMO', cast(o_custkey % 12 as string)) as promo_code
from {orders} where o_orderkey % 3 <> 0""",
    "v_client": """
select c_custkey as user_id, concat('N', cast(c_custkey as string)) as firstname, concat('S', cast(c_nationkey as string)) as lastname,
  concat('c', cast(c_custkey as string), '@example.org') as email,
  case when c_custkey % 5 = 0 then concat('n', cast(c_custkey as string), '@example.org') end as pending_email
from {customer}""",
    "v_company_tax": VIEWS["v_company"].replace("c_name as name,", "lpad(cast(c_nationkey as string), 9, '7') as kpp, c_name as name,"),
    "v_offer_filed": VIEWS["v_offer"].replace("p_type as category,", "p_type as category, p_size as category_id,"),
}

# Spark forms of the views that repeat each row k times: a generator
# (``explode(sequence(..))``) instead of a join with a constant list, so no
# nested-loop join appears in the plans. Same rows as the texts above.
SPARK_VIEWS: dict[str, str] = {
    "v_manager_period": """
select n_nationkey as company_group_id, make_date(1995 + k, 1, 1) as start_period,
  make_date(1995 + k, 12, 31) as end_period, (n_nationkey * 7 + k) % 10 as manager_id
from (select n_nationkey, explode(sequence(0, 6)) as k from {nation}) p
where (n_nationkey + k) % 5 <> 0""",
    "v_phone": """
select s_suppkey as user_id, case when (s_suppkey + k) % 4 = 0 then '' else concat('7000', cast(s_suppkey * 10 + k as string)) end as value,
  make_date(1999, 1 + k, 1) as created_at
from (select s_suppkey, explode(sequence(0, 2)) as k from {supplier}) p""",
}

_PLACEHOLDER = re.compile(r"\{(\w+)\}")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Build one view as a DataFrame over the base tables of ``sf_dir``."""
    text = SPARK_VIEWS.get(name, VIEWS[name])
    tables = {t: table(spark, sf_dir, t) for t in set(_PLACEHOLDER.findall(text))}
    return spark.sql(text, **tables)


class Views:
    """The views of one job: a base table is opened once, however many views of
    the job read it (its file list is that of the job's start)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._tables: dict[str, DataFrame] = {}

    def __call__(self, name: str) -> DataFrame:
        text = SPARK_VIEWS.get(name, VIEWS[name])
        for t in set(_PLACEHOLDER.findall(text)) - set(self._tables):
            self._tables[t] = table(self.spark, self.sf_dir, t)
        return self.spark.sql(text, **{t: self._tables[t] for t in _PLACEHOLDER.findall(text)})


def duck_text(name: str) -> str:
    """The same view for DuckDB: placeholders become the registered tables."""
    return _PLACEHOLDER.sub(lambda m: m.group(1), VIEWS[name])


def with_views(body: str, *names: str, extra: list[tuple[str, str]] | None = None) -> str:
    """Oracle SQL: ``WITH <views>, <extra ctes> <body>``."""
    ctes = [f"{n} AS ({duck_text(n)})" for n in names]
    ctes += [f"{n} AS ({sql})" for n, sql in (extra or [])]
    if not ctes:
        return body
    return "WITH " + ",\n".join(ctes) + "\n" + body
