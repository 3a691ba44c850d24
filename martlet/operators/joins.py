"""Join operators (section 2.3).

No side carries a broadcast hint: Spark's size statistics and AQE's runtime
sizes (``autoBroadcastJoinThreshold``, in bytes) decide. Big sides stay
sort-merge joins whose skewed partitions AQE splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(on) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def inner(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """J1."""
    return left.join(right, on, "inner")


def left(fact: DataFrame, dim: DataFrame, on) -> DataFrame:
    """Keeps every fact row (the dimension must be unique on ``on``)."""
    return fact.join(dim, on, "left")


def left_default(fact: DataFrame, dim: DataFrame, on, defaults: dict) -> DataFrame:
    """Left join, then the type default for unmatched dimension columns
    (the columnar store's non-Nullable fill: 0, '')."""
    out = fact.join(dim, on, "left")
    return out.select(*[
        F.coalesce(F.col(c), F.lit(defaults[c])).alias(c) if c in defaults else F.col(c)
        for c in out.columns
    ])


def semi(left_df: DataFrame, right: DataFrame, on) -> DataFrame:
    """``IN (subquery)``."""
    return left_df.join(right, on, "left_semi")


def anti(left_df: DataFrame, right: DataFrame, on) -> DataFrame:
    """Rows without a partner. Always ``left_anti`` (NOT EXISTS): a NULL
    in a ``NOT IN`` list would empty the whole result."""
    return left_df.join(right, on, "left_anti")


def join_on_predicate(left_df: DataFrame, right: DataFrame, on, pred: Column,
                      how: str = "inner") -> DataFrame:
    """Dimension filtered inside the join; the filter is applied to the
    side first, so it reaches that side's scan."""
    return left_df.join(right.filter(pred), on, how)


def join_derived(left_df: DataFrame, right: DataFrame, left_key: Column,
                 right_key: Column, how: str = "inner", name: str = "_k") -> DataFrame:
    """Equi join on computed keys (both sides as text)."""
    l2 = left_df.withColumn(name, left_key.cast("string"))
    r2 = right.withColumn(name, right_key.cast("string"))
    return l2.join(r2, name, how)


def lookup(df: DataFrame, dictionary: DataFrame, key: str, attrs: Sequence[str],
           dict_key: str | None = None) -> DataFrame:
    """Several attributes by id from a key-value dictionary."""
    d = dictionary.select(F.col(dict_key or key).alias(key), *attrs)
    return df.join(d, key, "left")


def join_indicator(left_df: DataFrame, right: DataFrame, on,
                   labels=("both", "left_only", "right_only"),
                   name: str = "_merge") -> DataFrame:
    """Full outer join with a match indicator (pandas ``indicator=True``)."""
    keys = _cols(on)
    lm = left_df.withColumn("_in_l", F.lit(True))
    rm = right.withColumn("_in_r", F.lit(True))
    out = lm.join(rm, keys, "full_outer")
    ind = (F.when(F.col("_in_l") & F.col("_in_r"), labels[0])
           .when(F.col("_in_l"), labels[1]).otherwise(labels[2]))
    return out.withColumn(name, ind).drop("_in_l", "_in_r")


def join_aggregate(left_df: DataFrame, right: DataFrame, on, aggs: Sequence[Column],
                   how: str = "inner") -> DataFrame:
    """Aggregate the right side to one row per key, then join."""
    keys = _cols(on)
    return left_df.join(right.groupBy(*keys).agg(*aggs), keys, how)


def asof_left(left_df: DataFrame, right: DataFrame, by: str, left_ts: str,
              right_ts: str, payload: Sequence[str], bounds: tuple[str, str] | None = None) -> DataFrame:
    """For each left row the right row of the same ``by`` key with the
    smallest ``right_ts >= left_ts`` (both inclusive); unmatched rows keep
    NULLs. Rows with a NULL key or NULL time never match.

    Plan: each right row owns the half-open interval (previous right_ts,
    right_ts] of its key, cut to ``bounds``, the first and last month that the
    left side can hold. An interval is exploded into the months it touches, and
    the left side joins on (key, month of left_ts) plus the range test. Every
    left row meets at most one interval per candidate, so there is no pair
    explosion, and a hot key is spread over its months (AQE splits what is
    still skewed). Jobs that know their period pass ``bounds``; otherwise one
    aggregate over the left times finds them.
    """
    r = (right.select(by, right_ts, *payload)
         .where(F.col(by).isNotNull() & F.col(right_ts).isNotNull()))
    # One row per (key, time): ties resolved deterministically by the payload.
    r = (r.groupBy(by, right_ts)
         .agg(F.min(F.struct(*payload)).alias("_p"))
         .select(by, right_ts, "_p.*"))
    w = Window.partitionBy(by).orderBy(right_ts)
    r = r.withColumn("_end", F.col(right_ts).cast("timestamp_ntz")).withColumn("_prev", F.lag("_end").over(w))

    if bounds is None:
        t = F.col(left_ts).cast("date")
        bounds = tuple(left_df.agg(F.min(t), F.max(t)).first())
    first, last = (F.trunc(F.lit(x).cast("date"), "MM") for x in bounds)
    begin = F.greatest(F.trunc("_prev", "MM"), first)  # NULL (no previous end) leaves the first month
    end = F.least(F.trunc("_end", "MM"), last)
    r = r.where((begin <= end) & (F.col("_end") >= first.cast("timestamp_ntz")))
    r = r.withColumn("_bucket", F.explode(F.sequence(begin, end, F.expr("interval 1 month"))))
    r = r.select(F.col(by).alias("_rk"), "_bucket", "_end", "_prev",
                 F.col(right_ts).alias("_rts"), *[F.col(p).alias(f"_r_{p}") for p in payload])

    lb = left_df.withColumn("_lbucket", F.trunc(F.col(left_ts), "MM"))
    cond = ((lb[by] == r["_rk"]) & (lb["_lbucket"] == r["_bucket"])
            & (lb[left_ts] <= r["_end"])
            & (r["_prev"].isNull() | (lb[left_ts] > r["_prev"])))
    out = lb.join(r, cond, "left")
    return out.select(*[lb[c] for c in left_df.columns],
                      F.col("_rts").alias(right_ts),
                      *[F.col(f"_r_{p}").alias(p) for p in payload])


def assigned_manager(df: DataFrame, ts: str = "shipped_at", start: str = "date_start",
                     end: str = "date_end", manager: str = "manager_id",
                     first_manager: str = "first_manager_id", grace_days: int = 10,
                     name: str = "assigned_manager_id") -> DataFrame:
    """After the as-of, keep the manager only if the time lies in the
    period; the first manager of a group also gets ``grace_days`` before the
    start. Otherwise 0."""
    t = F.col(ts)
    s = F.col(start).cast("timestamp_ntz")
    e = F.col(end).cast("timestamp_ntz")
    m = F.col(manager)
    first = (m == F.col(first_manager)) & (t >= s - F.expr(f"interval {grace_days} days")) & (t <= e)
    inside = (t >= s) & (t <= e)
    return df.withColumn(name, F.when(first, m).when(inside, m).otherwise(F.lit(0)).cast("bigint"))


def hierarchy_root(nodes: DataFrame, id_col: str = "id", parent_col: str = "parent_id", step: int = 4) -> DataFrame:
    """The top ancestor of every node of a parent/child dictionary.

    ``step`` levels are first walked lazily, one equi join with the dictionary
    each. If some ancestor still has a parent, the ancestor table is joined to
    itself (pointer doubling: the depth doubles each round, with the round's
    table in the shared checkpoint folder), so a chain of any depth ends after
    log2(depth) rounds. A parent missing from the dictionary, or a node that is
    its own parent, counts as a root; a cycle is an error."""
    from martlet.session import cut_lineage

    parent = (nodes.where(F.col(parent_col).isNotNull() & (F.col(parent_col) != F.col(id_col)))
              .select(F.col(id_col).alias("_pid"), F.col(parent_col).alias("_pparent")))
    cur = nodes.select(F.col(id_col).alias("node"), F.coalesce(F.col(parent_col), F.col(id_col)).alias("anc"))
    for _ in range(step):
        cur = (cur.join(parent, cur["anc"] == parent["_pid"], "left")
               .select("node", F.coalesce(F.col("_pparent"), F.col("anc")).alias("anc")))

    def unfinished(df: DataFrame) -> DataFrame:
        return df.join(parent.select("_pid"), F.col("anc") == F.col("_pid"), "left_semi")

    reached, size = step + 1, None
    while not unfinished(cur).isEmpty():
        size = nodes.count() if size is None else size
        if reached > size:
            raise ValueError("the hierarchy has a cycle")
        cur = cut_lineage(cur, "hierarchy")
        upper = cur.select(F.col("node").alias("_n"), F.col("anc").alias("_a")).distinct()
        cur = (cur.join(upper, F.col("anc") == F.col("_n"), "left")
               .select("node", F.coalesce("_a", "anc").alias("anc")))
        reached *= 2
    return cur.select(F.col("node").alias(id_col), F.col("anc").alias("root_id"))
