"""Sort, top-k, unions and reshaping (section 2.6)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sort(df: DataFrame, keys: Sequence[tuple[str, str]]) -> DataFrame:
    """Multi-key sort with per-key direction ('asc' / 'desc')."""
    return df.orderBy(*[F.col(k).asc() if d == "asc" else F.col(k).desc() for k, d in keys])


def label_rank(col, order: Sequence[str]) -> Column:
    """Position of a label in a declared order (0 if unknown)."""
    return F.array_position(F.array(*[F.lit(x) for x in order]), F.col(col) if isinstance(col, str) else col)


def top_k(df: DataFrame, by: str, metric: Column, k: int = 100, name: str = "metric") -> DataFrame:
    """The k largest groups by a metric (ties by key). ``orderBy + limit``
    plans as TakeOrderedAndProject: each partition keeps its own top k, only
    k rows per partition reach the final merge."""
    return (df.groupBy(by).agg(metric.alias(name))
            .orderBy(F.col(name).desc(), F.col(by).asc()).limit(k))


def union_feeds(feeds: Sequence[DataFrame], renames: Sequence[Mapping[str, str]] | None = None,
                tags: Sequence[str] | None = None, tag_col: str = "source") -> DataFrame:
    """T5: UNION ALL of feeds whose columns are renamed to one schema."""
    out = None
    for i, f in enumerate(feeds):
        if renames and renames[i]:
            f = f.withColumnsRenamed(dict(renames[i]))
        if tags:
            f = f.withColumn(tag_col, F.lit(tags[i]))
        out = f if out is None else out.unionByName(f)
    return out


def route(df: DataFrame, pred: Column) -> tuple[DataFrame, DataFrame]:
    """Rows meeting the predicate, and the rest (a NULL predicate goes to
    the rest)."""
    return df.where(pred), df.where(~F.coalesce(pred, F.lit(False)))


def transpose_small(df: DataFrame, header: str) -> DataFrame:
    """Transpose a small result (bounded by ``spark.sql.transposeMaxValues``)."""
    return df.transpose(F.col(header))
