"""The mart's feeds, each reduced to one row per declared key.

A feed may hold several rows per key (adjustments, archived and live contracts,
managers listed twice, companies of a group, work periods of a user). Each function
here reduces one to its key by an aggregate, so a left join on that key keeps the
fact's rows whatever the feed holds; ``Feed`` carries the key with the frame.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.functions import rules

# Adjustment types that are loyalty bonuses, and where a partner's leads
# come from (names as the fixtures use them).
BONUS_TYPES = ("bonus_thanks", "bonus_loyalty")
PARTNER_UTM, PARTNER_TRAFFIC = ("partner", "partner_story"), ("partner_site", "partner_landing", "partner_lead")
# Comment patterns of companies that do not count, with the English
# renderings that the fixtures use.
FRAUD_PATTERNS = ("%физик%", "%фрод%", "%тест%", "%ликвид%", "%test%", "%fraud%")
#: Fulfilment costs; without a row they are 0.
COSTS = ("picking_costs", "drive_costs", "taxi_costs")
#: Characters of a registration number that name its region.
REGION_CHARS = 2

View = Callable[[str], DataFrame]


@dataclass(frozen=True)
class Feed:
    """A frame with one row per ``key``."""

    frame: DataFrame
    key: str

    def onto(self, fact: DataFrame, on: str | None = None) -> DataFrame:
        """The fact with the feed's columns (left join)."""
        dim = self.frame if on in (None, self.key) else self.frame.withColumnRenamed(self.key, on)
        return fact.join(dim, on or self.key, "left")


def one_per_key(dim: DataFrame, key: str, least: str) -> DataFrame:
    """A dimension reduced to one row per key, the one with the least ``least``
    (then the least other columns), so that a join on it keeps the fact's rows."""
    rest = [least, *[c for c in dim.columns if c not in (key, least)]]
    first = dim.groupBy(key).agg(F.min(F.struct(*rest)).alias("_r"))
    return first.select(key, "_r.*").select(*dim.columns)


def per_shipment(v: View) -> Feed:
    """What the feeds hold of a shipment, from one aggregate over all of them:
    fulfilment costs and loyalty bonuses added up, and the sales initiative (of
    several the first by name)."""
    costs = v("v_order_cost").select("shipment_id", *COSTS)
    bonus = (v("v_adjustment").where(F.col("adjustment_type").isin(*BONUS_TYPES))
             .select("shipment_id", F.col("amount").alias("bonus_adjustment")))
    initiative = v("v_initiative").select("shipment_id", F.col("type_of_initiative").alias("initiative"))
    rows = costs.unionByName(bonus, allowMissingColumns=True).unionByName(initiative, allowMissingColumns=True)
    sums = [F.sum(c).alias(c) for c in (*COSTS, "bonus_adjustment")]
    rows = rows.groupBy("shipment_id").agg(*sums, F.min("initiative").alias("initiative"))
    return Feed(rows.withColumn("initiative_flg", F.col("initiative").isNotNull().cast("int")), "shipment_id")


def contracts(v: View) -> Feed:
    """Companies with a sales contract that is not archived."""
    live = v("v_sales_contract").where(F.col("archived_at").isNull() & F.col("company_id").isNotNull())
    return Feed(live.select("company_id").distinct().withColumn("has_contract", F.lit("Yes")), "company_id")


def departments(v: View) -> Feed:
    """Department of a manager (0 is no manager)."""
    rows = v("v_manager_info").where(F.col("manager_id") != 0).select("manager_id", "department", "subdepartment")
    return Feed(one_per_key(rows, "manager_id", "department"), "manager_id")


def first_companies(v: View, first_orders: DataFrame) -> Feed:
    """First registered company of a group, with its first order day
    (``first_orders``: company_id, company_first_order_dt)."""
    rows = v("v_group_company").select("company_group_id", "company_id").join(v("v_company_reg"), "company_id")
    first = (rows.groupBy("company_group_id").agg(F.min(F.struct("created_at", "company_id", "inn")).alias("_f"))
             .select("company_group_id", F.col("_f.company_id").alias("first_company_id"), F.col("_f.inn").alias("first_company_inn")))
    days = first_orders.select(F.col("company_id").alias("first_company_id"), F.col("company_first_order_dt").alias("first_company_order_dt"))
    return Feed(first.join(days, "first_company_id", "left"), "company_group_id")


def firms(v: View) -> Feed:
    """What is known of a firm: money, branches, activity by its code, and the
    region by the first characters of its registration number (F17, J7)."""
    activity = one_per_key(v("v_activity"), "activity_code", "activity_name")
    region = one_per_key(v("v_region_city"), "region_key", "region")
    firm = one_per_key(v("v_firm"), "inn", "registration_no").withColumn("region_key", F.substring("registration_no", 1, REGION_CHARS))
    out = firm.join(activity, "activity_code", "left").join(region, "region_key", "left")
    return Feed(out.drop("region_key", "registration_no"), "inn")


def user_sources(v: View) -> Feed:
    """Where a user's first registered company came from, whether a partner
    brought it, and whether its comments say that it does not count."""
    periods = v("v_employee_period").join(v("v_company_reg").select("company_id", "inn"), "company_id")
    first = (periods.groupBy("user_id").agg(F.min(F.struct("created_at", "company_id", "inn")).alias("_f"))
             .select("user_id", F.col("_f.company_id").alias("_company"), F.col("_f.inn").alias("company_inn")))
    sources = one_per_key(v("v_company_source"), "company_inn", "traffic_source")
    comments = v("v_company").groupBy(F.col("company_id").alias("_company")).agg(
        F.max(F.coalesce(rules.like_any("manager_comment", FRAUD_PATTERNS), F.lit(False)).cast("int")).alias("group_fraud_flg"))
    out = first.join(sources, "company_inn", "left").join(comments, "_company", "left")
    partner = F.coalesce(F.col("utm_source").isin(*PARTNER_UTM), F.lit(False)) | F.coalesce(F.col("traffic_source").isin(*PARTNER_TRAFFIC), F.lit(False))
    return Feed(out.select("user_id", "traffic_source", "traffic_source_plus", "utm_source",
                           F.concat("utm_source", F.lit("_"), "utm_medium", F.lit("_"), "utm_term").alias("utm"),
                           partner.cast("int").alias("partner_flg"), "group_fraud_flg"), "user_id")


# Money of a shipment (F23). Costs without a row are 0 before they enter a formula;
# fees and the shipment's own costs count once it is shipped.
_SHIPPED = "shipment_state = 'shipped'"
MONEY = {
    "promo_total_with_service": "service_promo_total + goods_promo_total",
    "gmv_expired_certificates": f"CASE WHEN b2b_measure = 2 AND {_SHIPPED} THEN b2b_certificate_profit ELSE 0 END",
    "delivery_cost": "drive_costs + taxi_costs",
    "direct_fulfilment": "packing_costs + picking_costs + acquiring_costs",
}
RESULT = {
    "gmv_sales_net_promo": "gmv_goods_net_promo + gmv_service_fee_net_promo + bb_certificate - gmv_expired_certificates",
    "cp1": f"CASE WHEN {_SHIPPED} THEN gross_profit + picking_fee + delivery_fee - acquiring_costs - packing_costs ELSE 0 END"
           " - (picking_costs + delivery_cost)",
}


def with_money(fact: DataFrame) -> DataFrame:
    """The fact, which carries its costs, with the sums made of its money."""
    j = fact.withColumns({c: F.coalesce(F.col(c), F.lit(0.0)) for c in COSTS})
    return j.withColumns({c: F.expr(t) for c, t in MONEY.items()}).withColumns({c: F.expr(t) for c, t in RESULT.items()})
