"""Seller GMV by month from active cards, then averages without empty
months, turnover buckets and shares."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.functions.rules import bucketize
from martlet.operators import aggs, joins
from martlet.operators.reshape import label_rank

# The base turnover buckets (left-closed edges) and their labels.
GMV_EDGES = [0, 50_000, 100_000, 500_000, 1_000_000, 5_000_000, 10_000_000, float("inf")]
GMV_LABELS = ["up to 50k", "50k - 100k", "100k - 500k", "500k - 1m", "1m - 5m", "5m - 10m", "10m +"]


def monthly_gmv(sales: DataFrame, active_items: DataFrame, start: str, end: str,
                min_gmv: float = 1000.0) -> DataFrame:
    """Per seller and month within [start, end]: distinct active items sold
    and GMV, months at or below ``min_gmv`` dropped (HAVING)."""
    s = sales.where(F.col("dt_month").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    s = joins.semi(s, active_items, "item_id")
    g = s.groupBy("seller_id", "dt_month").agg(F.count_distinct("item_id").alias("cnt_items"),
                                              F.sum("amount").alias("gmv"))
    return g.where(F.col("gmv") > min_gmv)


def seller_groups(monthly: DataFrame) -> DataFrame:
    """Average monthly GMV per seller (zero months ignored), bucketed, then
    sellers per bucket with the share of all sellers, in label order."""
    avg = monthly.groupBy("seller_id").agg(aggs.mean_nonzero("gmv").alias("average_gmv"))
    b = avg.select(bucketize("average_gmv", GMV_EDGES, GMV_LABELS).alias("gmv_group"))
    counts = b.groupBy("gmv_group").agg(F.count(F.lit(1)).alias("n_sellers"))
    out = aggs.share(counts, ["gmv_group"], "n_sellers", name_total="pct_of_total").drop("pct_of_group")
    return out.withColumn("label_rank", label_rank("gmv_group", GMV_LABELS)).orderBy("label_rank")
