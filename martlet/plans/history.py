"""K13 source readiness, K14 SCD2 history from daily snapshots, K15 data
vault split (hub, link, satellite): built from scratch, and loaded a day or a
batch at a time against what is there."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlet.functions.time import ts_lit


def source_ready(sources: dict[str, tuple[DataFrame, str]], as_of: str, max_lag_days: int = 1) -> DataFrame:
    """Per source, the newest date it holds and whether it covers the
    day before ``as_of`` (one aggregate row per source, no driver loop)."""
    parts = []
    for name, (df, col) in sources.items():
        parts.append(df.agg(F.max(F.to_date(col)).alias("max_date")).withColumn("source", F.lit(name)))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    need = F.date_sub(F.to_date(ts_lit(as_of)), max_lag_days)
    return u.select("source", "max_date", F.coalesce(F.col("max_date") >= need, F.lit(False)).alias("ready"))


def daily_snapshot(df: DataFrame, key: str, day: str, value: str) -> DataFrame:
    """One value per key and day (the largest, so the snapshot is deterministic)."""
    return df.groupBy(key, F.to_date(day).alias("snapshot_date")).agg(F.max(value).alias("value"))


def scd2(snapshots: DataFrame, key: str, day: str = "snapshot_date", value: str = "value") -> DataFrame:
    """Keep the days on which the value changed; each such row is valid
    from that day to the day before the next change (open-ended: NULL). A value
    that turns NULL, or back, is a change like any other.
    Windows are per key over distinct days, so a partition is bounded by the
    calendar, not by the number of source rows."""
    w = Window.partitionBy(key).orderBy(day)
    changed = (snapshots.withColumn("_first", F.row_number().over(w) == 1).withColumn("_prev", F.lag(value).over(w))
               .where(F.col("_first") | ~F.col("_prev").eqNullSafe(F.col(value))))
    return (changed.withColumn("valid_to", F.date_sub(F.lead(day).over(w), 1))
            .select(key, value, F.col(day).alias("valid_from"), "valid_to",
                    F.col("valid_to").isNull().alias("is_current")))


def scd2_merge(history: DataFrame, snapshot: DataFrame, key: str, day: str, value: str = "value",
               deletions: bool = False) -> DataFrame:
    """K14, one day at a time: the history (as ``scd2`` gives it) after the
    snapshot (key, value) of ``day``, a date not before any that it has seen. An
    open row whose value changed is closed the day before and a new one opened;
    with ``deletions`` a key that the snapshot lacks is closed, too, and opened
    again when it comes back. What an earlier merge of the same day did is undone
    first, so merging a day twice, or again with a corrected snapshot, gives the
    result of the last snapshot alone. Keys and values are compared null-safe; a key
    that the snapshot holds more than once counts with its largest value.

    Only open rows meet the snapshot, one row per key on both sides; closed ones
    pass by without a shuffle."""
    at = F.lit(day).cast("date")
    before = scd2_undo(history, day)
    closed, opened = before.where(~F.col("is_current")), before.where("is_current")
    today = (snapshot.groupBy(F.col(key).alias("_key")).agg(F.max(value).alias("_value"))
             .withColumn("_here", F.lit(True)))
    met = opened.withColumn("_open", F.lit(True)).join(today, F.col(key).eqNullSafe(F.col("_key")), "full_outer")
    was, here = F.coalesce("_open", F.lit(False)), F.coalesce("_here", F.lit(False))
    same = F.col(value).eqNullSafe(F.col("_value")) if deletions else ~here | F.col(value).eqNullSafe(F.col("_value"))
    stays = was & same & (here | F.lit(not deletions))

    def row(k, v, start, end):
        return F.struct(k.alias(key), v.alias(value), start.alias("valid_from"), end.cast("date").alias("valid_to"), end.isNull().alias("is_current"))

    old, new = F.col("valid_from"), row(F.col("_key"), F.col("_value"), at, F.lit(None))
    rows = (F.when(stays, F.array(row(F.col(key), F.col(value), old, F.lit(None))))
            .when(was & here, F.array(row(F.col(key), F.col(value), old, F.date_sub(at, 1)), new))
            .when(was, F.array(row(F.col(key), F.col(value), old, F.date_sub(at, 1)))).otherwise(F.array(new)))
    return closed.unionByName(met.select(F.inline(rows)))


def scd2_undo(history: DataFrame, day: str) -> DataFrame:
    """The history before the merge of ``day``, its newest: rows that the day
    opened go, rows that it closed are open again. A later day is an error, since
    its rows would have to go, too."""
    at = F.lit(day).cast("date")
    later = F.raise_error(F.concat(F.lit(f"the history holds days after {day}: "), F.col("valid_from").cast("string"))).cast("boolean")
    kept = history.where(F.when(F.col("valid_from") > at, later).otherwise(F.col("valid_from") < at))
    end = F.when(F.col("valid_to") < F.date_sub(at, 1), F.col("valid_to"))
    return kept.withColumn("valid_to", end).withColumn("is_current", F.col("valid_to").isNull())


def hash_key(*cols: str) -> F.Column:
    """Vault hash key: md5 over the parts, each with its length before it ('-'
    for NULL), so that no two different lists of parts give the same text."""
    parts = [F.col(c).cast("string") for c in cols]
    return F.md5(F.concat(*[F.coalesce(F.concat(F.length(p).cast("string"), F.lit(":"), p), F.lit("-")) for p in parts]))


def hub(df: DataFrame, business_key: str, source: str) -> DataFrame:
    return (df.select(business_key).distinct()
            .select(hash_key(business_key).alias("hub_key"), business_key, F.lit(source).alias("record_source")))


def link(df: DataFrame, keys: Sequence[str], source: str) -> DataFrame:
    return (df.select(*keys).distinct()
            .select(hash_key(*keys).alias("link_key"), *[hash_key(k).alias(f"{k}_hub_key") for k in keys],
                    F.lit(source).alias("record_source")))


def satellite(snapshots: DataFrame, business_key: str, attrs: Sequence[str], day: str, source: str) -> DataFrame:
    """Satellite rows where the attribute hash differs from the key's
    previous row (change rows only)."""
    w = Window.partitionBy(business_key).orderBy(day)
    s = snapshots.withColumn("hashdiff", hash_key(*attrs))
    s = s.withColumn("_prev", F.lag("hashdiff").over(w))
    return (s.where(~F.col("_prev").eqNullSafe(F.col("hashdiff")))
            .select(hash_key(business_key).alias("hub_key"), F.col(day).alias("load_date"), "hashdiff", *attrs,
                    F.lit(source).alias("record_source")))


# ---------------------------------------------------------------- K15 against an existing vault


def hub_load(existing: DataFrame, df: DataFrame, business_key: str, source: str) -> DataFrame:
    """Hub rows to append: keys that the hub does not hold, whatever source
    brought them first."""
    return hub(df, business_key, source).join(existing.select("hub_key"), "hub_key", "left_anti")


def link_load(existing: DataFrame, df: DataFrame, keys: Sequence[str], source: str) -> DataFrame:
    """Link rows to append. A link holds rows of several sources, so one is
    missing where this source has not brought it."""
    own = existing.where(F.col("record_source") == source).select("link_key")
    return link(df, keys, source).join(own, "link_key", "left_anti")


def satellite_load(existing: DataFrame, snapshots: DataFrame, business_key: str, attrs: Sequence[str], day: str, source: str) -> DataFrame:
    """Satellite rows to append: those of the load's days whose attribute hash
    differs from the key's row before, the newest stored one of this source
    first. Days up to a key's newest stored one are not loaded again, so a replay
    adds nothing. Of the stored rows, one per key is read on (an aggregate); the
    window holds the load's days of a key."""
    newest = (existing.where(F.col("record_source") == source).groupBy(F.col("hub_key").alias("_hub"))
              .agg(F.max(F.struct("load_date", "hashdiff")).alias("_last")))
    s = snapshots.withColumn("hub_key", hash_key(business_key)).withColumn("hashdiff", hash_key(*attrs))
    s = s.join(newest, F.col("hub_key") == F.col("_hub"), "left").where(F.col("_last").isNull() | (F.col(day) > F.col("_last.load_date")))
    before = F.lag("hashdiff").over(Window.partitionBy("hub_key").orderBy(day))
    s = s.withColumn("_prev", F.coalesce(before, F.col("_last.hashdiff")))
    return (s.where(~F.col("_prev").eqNullSafe(F.col("hashdiff")))
            .select("hub_key", F.col(day).alias("load_date"), "hashdiff", *attrs, F.lit(source).alias("record_source")))
