"""K7: weekly retailer statistics (monthly per store; prior full week per
store x SKU and per category), excluding shipments that hold excluded
categories (alcohol in the reference)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.functions import time as tf
from martlet.functions.rules import like_any
from martlet.operators import joins
from martlet.session import AS_OF

HEAVY_GRAMS = 80_000


def excluded_shipments(line_items: DataFrame, offers: DataFrame, category_patterns: Sequence[str]) -> DataFrame:
    """Distinct shipments with a live line in an excluded category."""
    bad = offers.where(like_any("category", category_patterns, fold_case=False)).select(F.col("id").alias("offer_id"))
    return (line_items.where(F.col("deleted_at").isNull()).join(bad, "offer_id", "left_semi")
            .select("shipment_id").distinct())


def b2b_shipped(shipments: DataFrame, retailer_ids: Sequence[int] = ()) -> DataFrame:
    s = shipments.where((F.col("shipment_state") == "shipped") & F.col("b2b_measure").isin(1, 2))
    return s.where(F.col("retailer_id").isin(*retailer_ids)) if retailer_ids else s


def store_month_stats(shipments: DataFrame, excluded: DataFrame, retailer_ids: Sequence[int] = (),
                      since: str = "1995-01-01 00:00:00", invoice: str = "invoice") -> DataFrame:
    """Per month and store: orders, invoice orders, revenue, average check
    (all and invoice), heavy orders (all and invoice). Newest month first."""
    s = b2b_shipped(shipments, retailer_ids).where(F.col("shipped_at") > tf.ts_lit(since))
    s = joins.anti(s, excluded, "shipment_id")
    inv = F.col("payment_method_name") == invoice
    heavy = F.col("total_weight") > HEAVY_GRAMS
    month = tf.format_period(tf.month_start(tf.local_date("shipped_at"))).alias("month")
    inv_total = F.when(inv, F.col("total"))
    # One row per order first: its flags, sums and counts. The four order counts
    # are then plain sums, without a row expansion for several distinct counts.
    orders = s.groupBy(month, "store_id", "order_id").agg(
        F.max(inv).alias("inv"), F.max(heavy).alias("heavy"), F.max(heavy & inv).alias("heavy_inv"),
        F.sum("total").alias("sum"), F.count("total").alias("n"), F.sum(inv_total).alias("inv_sum"), F.count(inv_total).alias("inv_n"))
    known = F.col("order_id").isNotNull()
    return (orders.groupBy("month", "store_id")
            .agg(F.count("order_id").alias("n_orders"), F.count_if(known & F.col("inv")).alias("n_invoice_orders"),
                 F.sum("sum").alias("revenue"), F.try_divide(F.sum("sum"), F.sum("n")).alias("avg_check"),
                 F.try_divide(F.sum("inv_sum"), F.sum("inv_n")).alias("avg_invoice_check"),
                 F.count_if(known & F.col("heavy")).alias("n_heavy_orders"),
                 F.count_if(known & F.col("heavy_inv")).alias("n_heavy_invoice_orders"))
            .orderBy(F.col("month").desc(), F.col("store_id").asc()))


def net_amount(price: Column, qty: Column, vat: Column) -> Column:
    """Amount net of VAT as the reference defines it, ``(1 - vat/100) * price * qty``."""
    return (1 - vat / 100) * price * qty


def _prior_week_lines(shipments: DataFrame, line_items: DataFrame, excluded: DataFrame,
                      retailer_ids: Sequence[int], as_of: str) -> DataFrame:
    """Live lines of B2B shipments shipped in the last full week before
    ``as_of``, joined by shipment (not by order: sibling shipments' items
    would leak in). A coarse UTC bound on the raw timestamp reaches the scan."""
    week = tf.prior_full_week(tf.ts_lit(as_of))
    s = b2b_shipped(shipments, retailer_ids)
    s = s.where((F.col("shipped_at") >= F.date_sub(week, 1).cast("timestamp_ntz"))
                & (F.col("shipped_at") < F.date_add(week, 8).cast("timestamp_ntz")))
    s = s.withColumn("week", tf.week_start(tf.local_date("shipped_at"))).where(F.col("week") == week)
    s = joins.anti(s.select("shipment_id", "store_id", "week"), excluded, "shipment_id")
    li = line_items.where(F.col("deleted_at").isNull()).select("shipment_id", "offer_id", "quantity", "price", "vat_rate")
    return s.join(li, "shipment_id")


def sku_week_stats(shipments: DataFrame, line_items: DataFrame, offers: DataFrame, excluded: DataFrame,
                   retailer_ids: Sequence[int] = (), as_of: str = AS_OF) -> DataFrame:
    """Per week, store and SKU: quantity sold and amount net of VAT."""
    j = _prior_week_lines(shipments, line_items, excluded, retailer_ids, as_of)
    o = offers.select(F.col("id").alias("offer_id"), "retailer_sku", F.col("name").alias("product_name"))
    j = j.join(o, "offer_id")
    return (j.groupBy(tf.format_period("week", with_day=True).alias("week"), "store_id", "retailer_sku", "product_name")
            .agg(F.sum("quantity").alias("quantity"),
                 F.sum(net_amount(F.col("price"), F.col("quantity"), F.col("vat_rate"))).alias("net_amount")))


def category_week_stats(shipments: DataFrame, line_items: DataFrame, offers: DataFrame, excluded: DataFrame,
                        retailer_ids: Sequence[int] = (), as_of: str = AS_OF) -> DataFrame:
    """Per week and category: quantity, net amount, shipments."""
    j = _prior_week_lines(shipments, line_items, excluded, retailer_ids, as_of)
    j = j.join(offers.select(F.col("id").alias("offer_id"), "category"), "offer_id")
    return (j.groupBy(tf.format_period("week", with_day=True).alias("week"), "category")
            .agg(F.sum("quantity").alias("quantity"),
                 F.sum(net_amount(F.col("price"), F.col("quantity"), F.col("vat_rate"))).alias("net_amount"),
                 F.count_distinct("shipment_id").alias("n_shipments")))


def store_week_stats(shipments: DataFrame, line_items: DataFrame, retailer_ids: Sequence[int] = (),
                     since: str = "1995-01-01 00:00:00") -> DataFrame:
    """Per ISO week and store: net and gross GMV, orders, and the number of
    distinct SKUs per order summed over the week (A11: per shipment, then
    per store-week) with its average per order."""
    s = (b2b_shipped(shipments, retailer_ids).where(F.col("shipped_at") > tf.ts_lit(since))
         .withColumn("week", tf.week_start(tf.local_date("shipped_at"))))
    per_store = s.groupBy("week", "store_id").agg(
        F.sum(F.col("gmv_goods_net_promo") + F.col("gmv_service_fee_net_promo")).alias("gmv_net_promo"),
        F.sum("total").alias("gmv"),
        F.count_distinct("shipment_id").alias("orders_cnt"))
    li = line_items.where(F.col("deleted_at").isNull()).select("shipment_id", "offer_id")
    per_shipment = (li.join(s.select("shipment_id", "week", "store_id"), "shipment_id")
                    .groupBy("shipment_id", "week", "store_id").agg(F.count_distinct("offer_id").alias("sku_cnt")))
    skus = per_shipment.groupBy("week", "store_id").agg(F.sum("sku_cnt").alias("sum_sku_cnt"))
    out = per_store.join(skus, ["week", "store_id"], "left")
    return out.select(tf.format_period("week", with_day=True).alias("week"), "store_id", "gmv_net_promo", "gmv",
                      "orders_cnt", "sum_sku_cnt",
                      F.try_divide(F.col("sum_sku_cnt").cast("double"), F.col("orders_cnt").cast("double"))
                      .alias("avg_sku_per_order"))


def store_sku_week_prices(shipments: DataFrame, line_items: DataFrame, offers: DataFrame,
                          retailer_ids: Sequence[int] = (), as_of: str = AS_OF) -> DataFrame:
    """Per store and SKU in the last full week: average price and the number
    of orders with the SKU. Shipments without live lines stay as a row with
    no SKU (left join, as the reference does)."""
    week = tf.prior_full_week(tf.ts_lit(as_of))
    s = b2b_shipped(shipments, retailer_ids)
    s = s.where((F.col("shipped_at") >= F.date_sub(week, 1).cast("timestamp_ntz"))
                & (F.col("shipped_at") < F.date_add(week, 8).cast("timestamp_ntz")))
    s = s.withColumn("week", tf.week_start(tf.local_date("shipped_at"))).where(F.col("week") == week)
    li = (line_items.where(F.col("deleted_at").isNull()).select("shipment_id", "offer_id", "price")
          .join(offers.select(F.col("id").alias("offer_id"), "retailer_sku"), "offer_id"))
    j = s.select("shipment_id", "week", "store_id").join(li, "shipment_id", "left")
    return (j.groupBy(tf.format_period("week", with_day=True).alias("week"), "store_id", "retailer_sku")
            .agg(F.avg("price").alias("avg_price"), F.count_distinct("shipment_id").alias("orders_cnt")))
