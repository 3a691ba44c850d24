"""K1: the B2B shipment mart, one function per enrichment.

Each enrichment is keyed by shipment, phone, company or group and joins back
onto the fact with a left join on a key that is unique on the enrichment side,
so the fact's row count never changes (asserted in the tests).
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.functions import rules
from martlet.functions.time import between_local, local_date, local_date_or, month_start, months_diff
from martlet.operators import aggs, joins
from martlet.plans import feeds
from martlet.plans.feeds import FRAUD_PATTERNS, one_per_key
from martlet.session import AS_OF
from martlet.sources.views import Views, view

HISTORY_START = "1995-01-01"


def shipments(spark: SparkSession, sf_dir: str, start: str = HISTORY_START,
              as_of: str = AS_OF, v: Views | None = None, fact: str = "v_shipment") -> DataFrame:
    """Fact filter: local shipping day (fallback: slot start) within the
    history, and a B2B order or one paid with a gift certificate. ``shipped_dt``
    is kept for later steps."""
    v = v or Views(spark, sf_dir)
    s = v(fact).where(between_local("shipped_at", start, as_of[:10], fallback="starts_at"))
    cert = v("v_certificate").select(F.col("shipment_id").alias("certificate_shipment"))
    return (s.where((F.col("b2b_measure") >= 1) | F.col("shipment_id").isin(cert))
            .withColumn("shipped_dt", local_date_or("shipped_at", "starts_at")))


def managers(spark: SparkSession, sf_dir: str, v: Views | None = None) -> DataFrame:
    """Manager periods of each company group plus the group's first manager
    (``argMin(manager_id, start_period)``)."""
    p = (v or Views(spark, sf_dir))("v_manager_period")
    first = p.groupBy("company_group_id").agg(
        aggs.arg_min("manager_id", F.struct("start_period", "manager_id")).alias("first_manager_id"))
    return (p.join(first, "company_group_id", "inner")
            .select("company_group_id", F.col("start_period").alias("date_start"),
                    F.col("end_period").alias("date_end"), "manager_id", "first_manager_id"))


def shipping_months(start: str = HISTORY_START, as_of: str = AS_OF) -> tuple[str, str]:
    """First and last day that a shipping time in the mart's period can have; the
    report zone is at most a day away from the stored times."""
    from datetime import date, timedelta

    day = timedelta(days=1)
    return str(date.fromisoformat(start) - day), str(date.fromisoformat(as_of[:10]) + day)


def with_manager(ship: DataFrame, user_group: DataFrame, mgr: DataFrame, bounds: tuple[str, str] | None = None) -> DataFrame:
    """Group of the ordering user (left, one per user), then the as-of manager
    period whose end is the first at or after shipping, then the grace rule
    (J8 + J9)."""
    s = ship.join(user_groups(user_group), "user_id", "left")
    a = joins.asof_left(s, mgr, by="company_group_id", left_ts="shipped_at",
                        right_ts="date_end", payload=["date_start", "manager_id", "first_manager_id"], bounds=bounds)
    return joins.assigned_manager(a)


def manager_gmv(spark: SparkSession, sf_dir: str, as_of: str = AS_OF) -> DataFrame:
    """Flagship slice: GMV and shipments per assigned manager and month."""
    s = with_manager(shipments(spark, sf_dir, as_of=as_of),
                     view(spark, sf_dir, "v_user_group"), managers(spark, sf_dir), shipping_months(as_of=as_of))
    return (s.groupBy("assigned_manager_id", month_start("shipped_dt").alias("month"))
            .agg(F.count(F.lit(1)).alias("n_shipments"),
                 F.sum("gmv_goods_net_promo").alias("gmv")))


def companies(spark: SparkSession, sf_dir: str, v: Views | None = None) -> DataFrame:
    """Company dimension, one row per company: payment type, comment list,
    fraud flag, firmographics."""
    c = (v or Views(spark, sf_dir))("v_company")
    return c.select(
        "company_id", "inn", "name", "finance_income", "employee_count", "category_type",
        rules.payment_type("deposit_flg", "postpay_flg", "prepay_flg").alias("payment_type"),
        F.lower(F.coalesce("manager_comment", F.lit(""))).alias("manager_comment_list"),
        F.coalesce(rules.like_any("manager_comment", FRAUD_PATTERNS), F.lit(False))
        .cast("int").alias("company_fraud_flg"),
    )


def user_groups(user_group: DataFrame) -> DataFrame:
    """The group of every user: the least of those that a user has, so that a
    join on it keeps the fact's rows."""
    return user_group.groupBy("user_id").agg(F.min("company_group_id").alias("company_group_id"))


def phone_metrics(ship: DataFrame) -> DataFrame:
    """Per phone over all shipped B2B orders (the whole shipment table, not
    only the mart's period): retention flags, value metrics and the first
    shipment, from one aggregate per (phone, day)."""
    base = (ship.where(F.col("b2b_measure").isin(1, 2) & (F.col("shipment_state") == "shipped"))
            .select("phone", "shipped_at", "shipment_id", (F.col("goods") + F.col("total_cost")).alias("amount"),
                    local_date("shipped_at").alias("ship_day")))
    m = aggs.entity_metrics(base, "phone", "ship_day", "shipped_at", "shipment_id", "amount")
    m = m.withColumnsRenamed({"first_dt": "first_order_dt", "last_dt": "last_order_dt", "first_id": "first_order_shipment_id_phone",
                              "gmv": "user_gmv", "n": "user_order_cnt", "active_months": "user_active_months_count"})
    cnt, gmv = F.col("user_order_cnt").cast("double"), F.col("user_gmv")
    m = m.withColumn("user_age_month", F.greatest(months_diff("first_order_dt", "last_order_dt"), F.lit(1)))
    age = F.col("user_age_month").cast("double")
    return m.withColumns({
        "user_avg_orders_per_active_month": F.try_divide(cnt, F.col("user_active_months_count").cast("double")),
        "user_avg_orders_per_month": F.try_divide(cnt, age), "user_avg_arpu_per_month": F.try_divide(gmv, age),
        "user_aov": F.try_divide(gmv, cnt)})


def group_metrics(ship: DataFrame, user_group: DataFrame) -> DataFrame:
    """Retention, first and last order per company group, over all shipped
    company orders (measure 2) of the whole shipment table."""
    base = (ship.where((F.col("shipment_state") == "shipped") & (F.col("b2b_measure") == 2))
            .select("user_id", "shipped_at", "shipment_id", local_date("shipped_at").alias("ship_day"))
            .join(user_group, "user_id"))
    m = aggs.entity_metrics(base, "company_group_id", "ship_day", "shipped_at", "shipment_id").drop("n", "active_months")
    return m.withColumnsRenamed({"first_dt": "group_first_order_dt", "last_dt": "group_last_order_dt",
                                 "first_id": "first_order_shipment_id_group",
                                 **{c: f"group_{c}" for c in m.columns if c.startswith("ret_")}})


def costs_and_margin(df: DataFrame, costs: DataFrame) -> DataFrame:
    """Fulfilment costs (NULL -> 0 first, the alias order of the reference is
    not reproduced) and contribution ``cp1``."""
    j = df.join(costs, "shipment_id", "left")
    for c in ("picking_costs", "drive_costs", "taxi_costs"):
        j = j.withColumn(c, F.coalesce(F.col(c), F.lit(0.0)))
    shipped = F.col("shipment_state") == "shipped"
    j = j.withColumn("delivery_cost", F.col("drive_costs") + F.col("taxi_costs"))
    j = j.withColumn("gmv_sales_net_promo", F.col("gmv_goods_net_promo") + F.col("gmv_service_fee_net_promo"))
    cp1 = F.when(shipped, F.col("gross_profit")).otherwise(0.0) - (F.col("picking_costs") + F.col("delivery_cost"))
    return j.withColumn("cp1", cp1)


def with_known(fact: DataFrame, sides: dict[str, DataFrame], who: DataFrame) -> DataFrame:
    """The fact with what is known by each of several keys (``sides``: a frame
    unique on its key). The sides meet the distinct combinations of the keys in
    ``who``, a few narrow columns, and what comes of that meets the fact: the wide
    rows move once, not once a key (sort-merge at scale, AQE splits what a hot
    combination holds). A NULL key is part of a combination and knows nothing."""
    known = who.select(*sides).distinct()
    for key, side in sides.items():
        known = known.join(side, key, "left")
    known = known.withColumnsRenamed({key: f"_known_{key}" for key in sides})
    same = functools.reduce(operator.and_, [fact[key].eqNullSafe(known[f"_known_{key}"]) for key in sides])
    return fact.join(known, same, "left").drop(*[f"_known_{key}" for key in sides])


def b2b_mart(spark: SparkSession, sf_dir: str, as_of: str = AS_OF) -> DataFrame:
    """The wide table: fact + company + manager + first orders + retention x2
    + value metrics + feeds + money + classification, conformed to a typed schema.
    Every side is unique on its key by an aggregate, so the fact's rows stay."""
    v = Views(spark, sf_dir)
    ship = shipments(spark, sf_dir, as_of=as_of, v=v, fact="v_shipment_wide")
    comp = one_per_key(companies(spark, sf_dir, v).select(
        F.col("inn").alias("company_inn"), "company_id", "payment_type", "finance_income", "employee_count",
        "category_type", F.col("name").alias("company_name"), "company_fraud_flg"), "company_inn", "company_id")
    user_group = user_groups(v("v_user_group"))
    # First shipped order per company (A18 by company), from the fact's few columns.
    company_first = (ship.select("company_inn", "shipment_state", "shipped_at", "shipment_id").join(comp.select("company_inn", "company_id"), "company_inn")
                     .where((F.col("shipment_state") == "shipped") & F.col("company_id").isNotNull() & F.col("shipped_at").isNotNull())
                     .groupBy("company_id").agg(F.min(F.struct("shipped_at", "shipment_id")).alias("_f"))
                     .select("company_id", local_date("_f.shipped_at").alias("company_first_order_dt"),
                             F.col("_f.shipment_id").alias("first_order_shipment_id_company")))
    # Feeds meet each other before the fact: what is known of a company, of a user
    # (and the user's group) and of a shipment are one table each.
    company = feeds.contracts(v).onto(comp.join(company_first, "company_id", "left"))
    group = feeds.firms(v).onto(feeds.first_companies(v, company_first).frame, "first_company_inn")
    group = group.join(group_metrics(v("v_shipment"), user_group), "company_group_id", "full_outer")
    user = user_group.join(group, "company_group_id", "left").join(feeds.user_sources(v).frame, "user_id", "full_outer")
    s = with_known(feeds.per_shipment(v).onto(ship), {"company_inn": company, "user_id": user, "phone": phone_metrics(v("v_shipment"))},
                   who=ship)
    a = joins.asof_left(s, managers(spark, sf_dir, v), by="company_group_id", left_ts="shipped_at",
                        right_ts="date_end", payload=["date_start", "manager_id", "first_manager_id"],
                        bounds=shipping_months(as_of=as_of))
    s = feeds.with_money(feeds.departments(v).onto(joins.assigned_manager(a), "assigned_manager_id"))
    s = s.withColumns({
        "company_type": rules.company_type("b2b_measure", F.coalesce("category_type", F.lit("")), "company_name", "finance_income", "employee_count"),
        "order_type": rules.order_channel("tenant_id", "platform", "b2b_measure", "b2b_order_company_flg"),
        "new_or_repeat": rules.new_or_repeat("first_order_shipment_id_phone", "shipment_id"),
        "new_or_repeat_company": rules.new_or_repeat("first_order_shipment_id_company", "shipment_id"),
        "new_or_repeat_group": rules.new_or_repeat("first_order_shipment_id_group", "shipment_id"),
        # The output group is the user's group for company orders only (the as-of,
        # the group metrics and feeds above use the user's group as is).
        "company_group_id": F.when(F.col("b2b_measure") == 2, F.col("company_group_id"))})
    return conform(s.withColumnRenamed("total", "customer_total"))


RET_MONTHS = [f"{k}m" for k in range(2, 13)]

# The typed output: (name, Spark type). NULL in a column of MART_DEFAULTS
# becomes the type default at the sink (non-Nullable target columns).
MART_SCHEMA = [
    # shipment
    ("shipment_id", "bigint"), ("order_id", "bigint"), ("shipment_number", "string"),
    ("user_id", "bigint"), ("phone", "string"), ("shipped_at", "timestamp_ntz"),
    ("starts_at", "timestamp_ntz"), ("completed_at", "timestamp_ntz"), ("shipped_dt", "date"),
    ("shipment_state", "string"), ("payment_state", "string"), ("payment_method_name", "string"),
    ("b2b_measure", "int"), ("b2b_order_company_flg", "int"), ("platform", "string"), ("tenant_id", "string"),
    ("retailer_id", "int"), ("store_id", "int"), ("total_weight", "bigint"),
    ("created_at", "timestamp_ntz"), ("order_number", "string"), ("prime_lvl", "string"), ("ship_address_id", "bigint"),
    ("type_delivery", "string"), ("city_id", "int"), ("city_name", "string"), ("retailer_name", "string"), ("store_name", "string"),
    ("os", "string"), ("item_count", "int"), ("replaced_items_cnt", "int"), ("canceled_items_cnt", "int"), ("total_quantity", "bigint"),
    ("surge_sum", "int"), ("initiative_flg", "int"), ("initiative", "string"),
    # company and group
    ("company_id", "bigint"), ("company_inn", "string"), ("company_name", "string"),
    ("finance_income", "bigint"), ("employee_count", "int"), ("category_type", "string"),
    ("payment_type", "string"), ("company_fraud_flg", "int"), ("company_type", "string"),
    ("company_first_order_dt", "date"), ("company_group_id", "int"), ("has_contract", "string"),
    ("first_company_id", "bigint"), ("first_company_inn", "string"), ("first_company_order_dt", "date"),
    ("finance_expense", "bigint"), ("branch_count", "int"), ("activity_code", "int"), ("activity_name", "string"),
    ("activity_chapter", "string"), ("segment", "string"), ("subsegment", "string"), ("region", "string"),
    # where the user's company came from
    ("traffic_source", "string"), ("traffic_source_plus", "string"), ("utm_source", "string"), ("utm", "string"),
    ("partner_flg", "int"), ("group_fraud_flg", "int"),
    # manager
    ("manager_id", "bigint"), ("first_manager_id", "bigint"), ("date_start", "date"), ("date_end", "date"),
    ("assigned_manager_id", "bigint"), ("department", "string"), ("subdepartment", "string"),
    # money
    ("customer_total", "double"), ("payment_total", "double"),
    ("gmv_goods_net_promo", "double"), ("gmv_service_fee_net_promo", "double"),
    ("gmv_sales_net_promo", "double"), ("gross_profit", "double"),
    ("picking_costs", "double"), ("drive_costs", "double"), ("taxi_costs", "double"),
    ("delivery_cost", "double"), ("cp1", "double"),
    ("acquiring_costs", "double"), ("packing_costs", "double"), ("direct_fulfilment", "double"), ("gmv_expired_certificates", "double"),
    ("b2b_certificates", "double"), ("b2b_certificate_profit", "double"), ("bb_certificate", "bigint"), ("goods_house", "double"),
    ("gmv_goods", "double"), ("gmv_service_fee", "double"), ("gmv_advertising", "double"),
    # promo
    ("goods_promo", "double"), ("goods_promo_total", "double"), ("service_promo_total", "double"), ("promo_total_with_service", "double"),
    ("promo_total", "double"), ("promo_code", "string"), ("bonus_promo", "double"), ("bonus_adjustment", "bigint"),
    # classification
    ("order_type", "string"), ("new_or_repeat", "string"), ("new_or_repeat_company", "string"),
    ("new_or_repeat_group", "string"),
    # per phone
    ("first_order_dt", "date"), ("last_order_dt", "date"), ("first_order_shipment_id_phone", "bigint"),
    ("user_gmv", "double"), ("user_order_cnt", "bigint"), ("user_active_months_count", "bigint"),
    ("user_age_month", "int"), ("user_avg_orders_per_active_month", "double"),
    ("user_avg_orders_per_month", "double"), ("user_avg_arpu_per_month", "double"), ("user_aov", "double"),
    ("ret_14d", "int"), *[(f"ret_{m}", "int") for m in RET_MONTHS],
    # per company group
    ("group_first_order_dt", "date"), ("group_last_order_dt", "date"),
    ("group_ret_14d", "int"), *[(f"group_ret_{m}", "int") for m in RET_MONTHS],
]

MART_DEFAULTS = {"company_group_id": 0, "company_fraud_flg": 0, "assigned_manager_id": 0, "has_contract": "No", "partner_flg": 0,
                 "group_fraud_flg": 0, "initiative_flg": 0, "bonus_adjustment": 0,
                 **{n: 0 for n, _ in MART_SCHEMA if n.startswith(("ret_", "group_ret_"))}}


def conform(df: DataFrame, schema=MART_SCHEMA, defaults=MART_DEFAULTS) -> DataFrame:
    """Cast, order and default the output columns. A value that its column's
    type cannot hold stops the refresh with an error that names the column
    (``failed_casts`` counts them all, ``quarantine`` sets their rows apart); it never
    becomes a default. Columns that have their type already are passed on, so the plan
    holds a test for those alone that need one."""
    types = dict(df.dtypes)
    return df.selectExpr(*[f"{_conformed(name, types[name], typ, defaults)} AS `{name}`" for name, typ in schema])


def _conformed(name: str, has: str, typ: str, defaults) -> str:
    text = f"`{name}`"
    if has == "boolean" and typ == "int":
        text = f"CAST({text} AS INT)"
    elif has != typ:
        cast = f"TRY_CAST({text} AS {typ})"
        message = f"concat('column {name} does not fit {typ}: ', CAST({text} AS STRING))"
        text = f"CASE WHEN {text} IS NOT NULL AND {cast} IS NULL THEN CAST(raise_error({message}) AS {typ}) ELSE {cast} END"
    return f"coalesce({text}, CAST({defaults[name]!r} AS {typ}))" if name in defaults else text


def quarantine(df: DataFrame, schema=MART_SCHEMA) -> tuple[DataFrame, DataFrame]:
    """Rows that ``conform`` takes, and those that it would stop at, with the
    names of the columns that do not fit (``misfits``)."""
    types = dict(df.dtypes)
    tests = [f"CASE WHEN `{n}` IS NOT NULL AND TRY_CAST(`{n}` AS {t}) IS NULL THEN '{n}' END" for n, t in schema if n in types and types[n] != t]
    marked = df.withColumn("misfits", F.expr(f"array_compact(array({', '.join(tests)}))") if tests else F.array().cast("array<string>"))
    return marked.where(F.size("misfits") == 0).drop("misfits"), marked.where(F.size("misfits") > 0)


def failed_casts(df: DataFrame, schema=MART_SCHEMA) -> DataFrame:
    """One row with the number of values per column that its type cannot hold."""
    return df.agg(*[F.count_if(F.col(n).isNotNull() & F.col(n).try_cast(t).isNull()).alias(n) for n, t in schema if n in df.columns])
