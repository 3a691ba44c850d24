"""Per-group values next to each row (section 2.5) and duplicate handling.

The reference writes these as window functions. A window partitioned by a key
puts every row of that key into one task, so a key holding a large share of
the rows would stall the job. Here each per-key value is a partial aggregate
(map-side combined, one row per key) joined back on the key; AQE splits a
hot key's partition on the row side, and the key side holds one row for it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _keys(by) -> list[str]:
    return [by] if isinstance(by, str) else list(by)


def with_group_values(df: DataFrame, by, aggs: Sequence[Column]) -> DataFrame:
    """Attach per-group aggregates (``sum() over (partition by ..)``,
    ``transform('min')``) to every row. Rows with a NULL key get the values
    of the NULL group, as a window would."""
    keys = _keys(by)
    g = df.groupBy(*keys).agg(*aggs)
    return df.join(g, [df[k].eqNullSafe(g[k]) for k in keys], "left").drop(*[g[k] for k in keys])


def with_n_distinct(df: DataFrame, col: str, by, name: str = "n_distinct") -> DataFrame:
    """Number of distinct values of ``col`` in the row's group, NULL
    counted as a value (the ``dense_rank`` asc + desc - 1 form of the
    reference). ``count_distinct`` plans as a two-level aggregate."""
    n = F.count_distinct(col) + F.max(F.col(col).isNull().cast("int"))
    return with_group_values(df, by, [n.alias(name)])


def sum_over(df: DataFrame, col: str, by, name: str) -> DataFrame:
    """W2."""
    return with_group_values(df, by, [F.sum(col).alias(name)])


def agg_over(df: DataFrame, fn: str, col: str, by, name: str) -> DataFrame:
    """``fn`` is an aggregate function name of ``pyspark.sql.functions``."""
    return with_group_values(df, by, [getattr(F, fn)(col).alias(name)])


def balance_due_window(df: DataFrame, by: str, paid: str, total: str,
                       tol: float = 1000.0) -> DataFrame:
    """Orders whose shipments' total minus the corrected payment is at most
    ``tol``. Equal payment values on several shipments are copies of one
    payment; distinct values (NULL counts as one) add up. Returns the keys
    with a qualifying row, like the window form."""
    several = (F.min(paid) != F.max(paid)) | (F.count_if(F.col(paid).isNull()) > 0)
    # One value on all shipments needs no row of its own: it is the least one. An
    # order without any payment value has no gap, as NULL minus anything has none.
    g = df.groupBy(by).agg(F.when(several, F.sum(paid)).otherwise(F.min(paid)).alias("_paid"), F.sum(total).alias("_total"))
    return g.where(F.col("_total") - F.col("_paid") <= tol).select(by)


def _sort_key(order: Sequence[tuple[str, str]]) -> list[Column]:
    """Ascending sort key: a descending numeric column is negated."""
    out = []
    for c, direction in order:
        out.append(-F.col(c) if direction == "desc" else F.col(c))
    return out


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[tuple[str, str]] | None = None) -> DataFrame:
    """One row per key; with ``order`` (numeric columns may be 'desc') the
    first row in that order, deterministically (the remaining columns break
    ties). A partial ``min`` over a struct: no window, no hot task."""
    if order is None:
        return df.dropDuplicates(list(keys))
    cols = [c for c in df.columns if c not in keys]
    key = F.struct(*[k.alias(f"_o{i}") for i, k in enumerate(_sort_key(order))], *[F.col(c) for c in cols])
    g = df.groupBy(*keys).agg(F.min(key).alias("_first"))
    return g.select(*keys, *[F.col(f"_first.{c}").alias(c) for c in cols]).select(*df.columns)


def flag_dups(df: DataFrame, keys: Sequence[str], order: Sequence[tuple[str, str]],
              name: str = "is_duplicate") -> DataFrame:
    """Every row after the first of its key (explicit order, all
    columns as the final tie-break) is a duplicate. Exact copies of the first
    row: one is kept, the others are flagged. Rows get a stable id (the frame is
    written once to the shared checkpoint folder), the first id per key is a
    partial aggregate, and the flag compares against it."""
    from martlet.session import cut_lineage

    ided = cut_lineage(df.withColumn("_row_id", F.monotonically_increasing_id()), "dups")
    cols = [c for c in df.columns if c not in keys]
    key = F.struct(*[k.alias(f"_o{i}") for i, k in enumerate(_sort_key(order))],
                   *[F.col(c) for c in cols], F.col("_row_id"))
    first = ided.groupBy(*keys).agg(F.min(key)["_row_id"].alias("_first_id"))
    out = ided.join(first, [ided[k].eqNullSafe(first[k]) for k in keys], "left").drop(*[first[k] for k in keys])
    return out.withColumn(name, F.col("_row_id") != F.col("_first_id")).drop("_row_id", "_first_id")
