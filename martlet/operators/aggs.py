"""Aggregation operators (section 2.4).

Everything is a ``groupBy().agg()`` with built-in aggregate functions, so the
map side combines partial results before the shuffle. Per-entity sets
(retention) are never collected: they are computed from distinct
(entity, day) pairs, whose count per entity is bounded by the calendar, not by
the number of orders.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlet.functions.time import months_diff


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def with_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the values of a global aggregate (exactly one row, so its size
    is proven) to every row as literals: one small job computes the row, no
    join (a constant-key join would be planned as a nested-loop cross join)
    and no shuffle of ``df``."""
    row = one_row.first()
    return df.withColumns({c: F.lit(row[c]).cast(one_row.schema[c].dataType) for c in one_row.columns})


def arg_max(value, order) -> Column:
    """A5 ``argMax``: value at the largest ``order``, NULL values skipped (the
    columnar store's aggregate ignores them; Spark's ``max_by`` would return a
    NULL value). Pass ``order`` as a struct (ts, id) for a deterministic tie-break."""
    v = _c(value)
    return F.max_by(v, F.when(v.isNotNull(), _c(order)))


def arg_min(value, order) -> Column:
    """A5 ``argMin`` with NULL values skipped."""
    v = _c(value)
    return F.min_by(v, F.when(v.isNotNull(), _c(order)))


def agg_if(fn: str, col, cond: Column, default=None) -> Column:
    """A4 ``maxIf``/``sumIf``/``uniqIf``...: aggregate over rows meeting ``cond``;
    ``default`` for a group without such rows (``maxIf`` gives 0 there)."""
    masked = F.when(cond, _c(col))
    if fn == "count_distinct":
        out = F.count_distinct(masked)
    else:
        out = getattr(F, fn)(masked)
    return out if default is None else F.coalesce(out, F.lit(default))


def mean_nonzero(col) -> Column:
    """Sum / number of non-zero values; 0 when there is none."""
    c = _c(col)
    return F.coalesce(F.try_divide(F.sum(c), F.count_if(c != 0).cast("double")), F.lit(0.0))


def group_concat(col, sep: str = ", ", null_as: str = "") -> Column:
    """Distinct values as sorted text, NULL read as ``null_as``."""
    return F.array_join(F.array_sort(F.collect_set(F.coalesce(_c(col), F.lit(null_as)))), sep)


def retention(df: DataFrame, entity: str, day: str, days: int = 14,
              months: int = 11, prefix: str = "ret") -> DataFrame:
    """Per entity, returned within ``days`` after the first day
    (``first < d <= first + days``), and active in calendar month +1..+months
    after the first month (flags ``ret_2m`` .. ``ret_{months+1}m``).

    Distinct (entity, day) pairs are built with a map-side combine; the first
    day comes from a window over those pairs (bounded per entity by the
    calendar), and the flags from one more aggregate on the same partitioning.
    """
    pairs = df.select(entity, day).where(F.col(entity).isNotNull()).distinct()
    w = Window.partitionBy(entity)
    pairs = pairs.withColumn("_first", F.min(day).over(w))
    d, first = F.col(day), F.col("_first")
    offset = months_diff(first, d)
    aggs = [F.coalesce(F.max((d > first) & (d <= F.date_add(first, days))), F.lit(False))
            .alias(f"{prefix}_{days}d")]
    for k in range(1, months + 1):
        aggs.append(F.coalesce(F.max(offset == k), F.lit(False)).alias(f"{prefix}_{k + 1}m"))
    return pairs.groupBy(entity).agg(*aggs)


def customer_value(df: DataFrame, entity: str, day: str, amount: str,
                   prefix: str = "user") -> DataFrame:
    """A10: GMV, orders, active months, age in months (at least 1), orders per
    active month and per month, ARPU per month, AOV. ``day`` is the local date."""
    m = F.trunc(F.col(day), "MM")
    base = df.groupBy(entity).agg(
        F.min(day).alias("first_order_dt"),
        F.max(day).alias("last_order_dt"),
        F.sum(amount).alias(f"{prefix}_gmv"),
        F.count(F.lit(1)).alias(f"{prefix}_order_cnt"),
        F.count_distinct(m).alias(f"{prefix}_active_months_count"),
    )
    age = F.greatest(months_diff("first_order_dt", "last_order_dt"), F.lit(1))
    cnt = F.col(f"{prefix}_order_cnt").cast("double")
    gmv = F.col(f"{prefix}_gmv")
    return (base.withColumn(f"{prefix}_age_month", age)
            .withColumn(f"{prefix}_avg_orders_per_active_month",
                        F.try_divide(cnt, F.col(f"{prefix}_active_months_count").cast("double")))
            .withColumn(f"{prefix}_avg_orders_per_month", F.try_divide(cnt, F.col(f"{prefix}_age_month").cast("double")))
            .withColumn(f"{prefix}_avg_arpu_per_month", F.try_divide(gmv, F.col(f"{prefix}_age_month").cast("double")))
            .withColumn(f"{prefix}_aov", F.try_divide(gmv, cnt)))


def entity_metrics(df: DataFrame, entity: str, day: str, ts: str, row_id: str, amount: str | None = None,
                   days: int = 14, months: int = 11) -> DataFrame:
    """A9, A10, A18 and the first order in one pass: everything comes from one
    partial aggregate per (entity, day), whose rows per entity are bounded by
    the calendar, so the rows are shuffled once. Columns: first_dt, last_dt,
    first_id (of the earliest ``ts``), n, active_months, gmv (with ``amount``),
    ret_{days}d and ret_2m to ret_{months + 1}m."""
    sums = [F.sum(amount).alias("gmv")] if amount else []
    start = F.when(F.col(ts).isNotNull(), F.struct(ts, row_id))
    daily = (df.where(F.col(entity).isNotNull()).groupBy(entity, day)
             .agg(F.count(F.lit(1)).alias("n"), F.min(start).alias("_start"), *sums))
    daily = daily.withColumn("_first", F.min(day).over(Window.partitionBy(entity)))
    d, first = F.col(day), F.col("_first")
    offset = months_diff(first, d)
    flags = [F.coalesce(F.max((d > first) & (d <= F.date_add(first, days))), F.lit(False)).alias(f"ret_{days}d")]
    flags += [F.coalesce(F.max(offset == k), F.lit(False)).alias(f"ret_{k + 1}m") for k in range(1, months + 1)]
    return daily.groupBy(entity).agg(
        F.min(day).alias("first_dt"), F.max(day).alias("last_dt"), F.min("_start")[row_id].alias("first_id"),
        F.sum("n").alias("n"), F.size(F.collect_set(F.trunc(day, "MM"))).cast("bigint").alias("active_months"),
        *([F.sum("gmv").alias("gmv")] if amount else []), *flags)


def first_last(df: DataFrame, by: str, day: str) -> DataFrame:
    """First and last (local) order date per entity."""
    return df.groupBy(by).agg(F.min(day).alias("first_order_dt"), F.max(day).alias("last_order_dt"))


def balance_due_grouped(df: DataFrame, by: str, paid: str, total: str,
                        tol: float = 1000.0) -> DataFrame:
    """Per order, payments are copies when there is one distinct value
    (take it once), else they add up; keep orders whose total minus paid is
    at most ``tol``."""
    g = df.groupBy(by).agg(
        F.count_distinct(paid).alias("_n_paid"),
        F.max(paid).alias("_one_paid"),
        F.sum(paid).alias("_sum_paid"),
        F.sum(total).alias("sum_total"),
    )
    corrected = F.when(F.col("_n_paid") == 1, F.col("_one_paid")).otherwise(F.col("_sum_paid"))
    return (g.withColumn("payment_total_corrected", corrected)
            .where(F.col("sum_total") - F.col("payment_total_corrected") <= tol)
            .select(by, "payment_total_corrected", "sum_total"))


def share(df: DataFrame, by: Sequence[str], col: str, name_group: str = "pct_of_group",
          name_total: str = "pct_of_total", digits: int = 2) -> DataFrame:
    """Percent of the group and of the grand total, rounded half-even.
    The grand total is a one-row aggregate (``sum() over ()`` would pull every
    row into one task); the group sum is an aggregate joined back on the key."""
    total = df.agg(F.sum(col).alias("_grand"))
    gsum = df.groupBy(*by).agg(F.sum(col).alias("_gsum"))
    out = with_scalars(df.join(gsum, list(by), "left"), total)
    v = F.col(col).cast("double")
    return (out.withColumn(name_group, F.bround(F.try_divide(100 * v, F.col("_gsum")), digits))
            .withColumn(name_total, F.bround(F.try_divide(100 * v, F.col("_grand")), digits))
            .drop("_gsum", "_grand"))


def exact_median(df: DataFrame, by: Sequence[str], col: str, name: str = "median",
                 accuracy: int = 100_000) -> DataFrame:
    """Exact median per group (mean of the two middle values for an even
    count, NULLs ignored) without holding a group's rows in one task.

    Rows are first reduced to (group, value) counts. An approximate quantile
    sketch brackets the middle ranks: its rank error is at most n/accuracy, so
    the values in [lo, hi] contain both middle ranks. Only the distinct values
    of that band get running counts, so equal values, however many, are one
    row; the rows below ``lo`` are just counted. If the bracket misses (tiny
    groups), all distinct values of that group are the band."""
    keys = list(by) or ["_all"]
    base = df.select(*by, col).where(F.col(col).isNotNull())
    if not by:
        base = base.withColumn("_all", F.lit(1))
    x = F.col(col)
    values = base.groupBy(*keys, col).agg(F.count(F.lit(1)).alias("_c"))
    d = 2.0 / accuracy
    stats = base.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        F.percentile_approx(col, max(0.0, 0.5 - d), accuracy).alias("_lo"),
        F.percentile_approx(col, min(1.0, 0.5 + d), accuracy).alias("_hi"))
    counts = (values.join(stats, keys).groupBy(*keys)
              .agg(F.sum(F.when(x < F.col("_lo"), F.col("_c")).otherwise(0)).alias("_below"),
                   F.sum(F.when(x.between(F.col("_lo"), F.col("_hi")), F.col("_c")).otherwise(0)).alias("_band")))
    k1 = F.floor((F.col("_n") + 1) / 2)
    k2 = F.floor(F.col("_n") / 2) + 1
    ok = (F.col("_below") < k1) & (F.col("_below") + F.col("_band") >= k2)
    bracket = (stats.join(counts, keys)
               .select(*keys, k1.alias("_k1"), k2.alias("_k2"),
                       F.when(ok, F.col("_lo")).alias("_lo"), F.when(ok, F.col("_hi")).alias("_hi"),
                       F.when(ok, F.col("_below")).otherwise(0).alias("_below")))
    band = (values.join(bracket, keys)
            .where(F.col("_lo").isNull() | ((x >= F.col("_lo")) & (x <= F.col("_hi")))))
    w = Window.partitionBy(*keys).orderBy(x).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = band.withColumn("_r", F.col("_below") + F.sum("_c").over(w))
    # The value at rank k is the least one whose running count reaches k.
    med = (upto.groupBy(*keys)
           .agg(((F.min(F.when(F.col("_r") >= F.col("_k1"), x)) + F.min(F.when(F.col("_r") >= F.col("_k2"), x))) / 2).alias(name)))
    return med.drop("_all") if not by else med


def stats_long(df: DataFrame, col: str, stats: Sequence[str] = ("max", "min", "mean", "median"),
               name_stat: str = "statistic", name_value: str = "value") -> DataFrame:
    """Several statistics in one pass, as (statistic, value) rows."""
    fns = {"max": F.max, "min": F.min, "mean": F.avg, "sum": F.sum, "count": F.count, "std": F.stddev}
    wide = df.agg(*[fns[s](col).cast("double").alias(s) for s in stats if s != "median"])
    if "median" in stats:
        wide = with_scalars(wide, exact_median(df, [], col, "median"))
    return wide.select(*stats).unpivot([], list(stats), name_stat, name_value)


def sum_columns(df: DataFrame, cols: Sequence[str], by: Sequence[str] | None = None,
                long: bool = False, name_col: str = "column", name_total: str = "total") -> DataFrame:
    """Sums of many columns, optionally per group, optionally as
    (column, total) rows."""
    aggs = [F.sum(c).alias(c) for c in cols]
    wide = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    if not long:
        return wide
    return wide.unpivot(list(by or []), list(cols), name_col, name_total)


def histogram(df: DataFrame, col: str, bins: int = 70) -> DataFrame:
    """Equal-width histogram counts. The range is a one-row aggregate
    attached to every row; the bin is ``floor((x - lo) / (hi - lo) * bins) + 1``
    with the maximum in the last bin, so one pass and one small shuffle."""
    rng = df.agg(F.min(col).alias("_lo"), F.max(col).alias("_hi"))
    j = with_scalars(df.select(col).where(F.col(col).isNotNull()), rng)
    width = F.col("_hi") - F.col("_lo")
    raw = F.floor((F.col(col) - F.col("_lo")) / width * bins) + 1
    b = F.when(width == 0, F.lit(1)).otherwise(F.least(raw, F.lit(bins)))
    return (j.withColumn("bin", b.cast("int"))
            .groupBy("bin").agg(F.count(F.lit(1)).alias("n"),
                                F.min("_lo").alias("range_lo"), F.max("_hi").alias("range_hi")))


def majority(df: DataFrame, by: Sequence[str], col: str, value, min_share: float = 0.5,
             name: str = "share") -> DataFrame:
    """Groups where at least ``min_share`` of the values equal ``value``
    (computed as an average of a 0/1 flag, no lists collected)."""
    hit = F.when(F.col(col) == F.lit(value), 1.0).otherwise(0.0)
    return (df.groupBy(*by).agg(F.avg(hit).alias(name))
            .where(F.col(name) >= min_share))
