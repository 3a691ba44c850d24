"""Readers and writers.

Everything writes under a folder the caller names; jobs that need a scratch
folder take it from ``spark.checkpoint.dir`` (shared storage on a cluster),
never from a machine-local temp folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.session import cut_lineage, ensure_checkpoint_dir
from martlet.sources.publish import current, refresh, refresh_partitions  # noqa: F401 - S8


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def read_reference(spark: SparkSession, path: str, schema: Sequence[tuple[str, str]],
                   required: Sequence[str], fmt: str = "csv") -> DataFrame:
    """S3: reference sheet with every column read as text (keys keep leading
    zeros), rows missing a required value dropped, duplicates dropped, then
    cast to the declared types (``try_cast``: a bad cell becomes NULL and is
    dropped by the required check)."""
    text_schema = T.StructType([T.StructField(n, T.StringType()) for n, _ in schema])
    raw = spark.read.schema(text_schema).option("header", True).format(fmt).load(path)
    typed = raw.select(*[F.trim(F.col(n)).try_cast(t).alias(n) for n, t in schema])
    return typed.dropna(subset=list(required)).dropDuplicates()


#: Lines before a CSV header lie within so many bytes of a file's start.
HEAD_BYTES = 1 << 20


def read_csv_skip(spark: SparkSession, path: str, schema: T.StructType, skip_rows: int = 1, header: bool = True, sep: str = ",",
                  quoted_breaks: bool = False) -> DataFrame:
    """CSV files whose first ``skip_rows`` lines are junk before the header.

    Files are read as lines, split by split. A line's place among those of its split
    is the order of ``monotonically_increasing_id``, so the lines of a file's first
    splits (those that begin within ``HEAD_BYTES``: one split, but for small ones) are
    numbered, and the first ones dropped; all other splits pass by. Nothing is
    written, and ids are compared inside one scan only.

    ``quoted_breaks``: quoted values may hold line breaks, anywhere in a file and
    across splits. A line begins a record if the quotes before it are even in
    number; the quotes inside a split are counted there, those of the splits before
    it come from a table with a row per split, and so do the records' numbers. Lines
    of one record are joined again; no split or file passes through one task."""
    lines = (spark.read.option("lineSep", "\n").text(path)
             .select(F.regexp_replace("value", "\r$", "").alias("value"), F.col("_metadata.file_path").alias("file"),
                     F.col("_metadata.file_block_start").alias("block"))
             .withColumn("id", F.monotonically_increasing_id()))
    near = F.col("block") < HEAD_BYTES
    number = F.row_number().over(Window.partitionBy("file").orderBy("block", "id"))
    drop_n = skip_rows + (1 if header and not quoted_breaks else 0)
    first = lines.where(near).withColumn("_n", number).where(F.col("_n") > drop_n).drop("_n")
    body = first.unionByName(lines.where(~near))
    if quoted_breaks:
        body = _joined_records(body)
        if header:
            body = body.where("record > 1")
    # A doubled quote stands for one, as in the sheets that write such files.
    parsed = body.where("value <> ''").select(F.from_csv("value", schema.simpleString(), {"sep": sep, "escape": '"'}).alias("r"))
    return parsed.select("r.*")


def _joined_records(lines: DataFrame) -> DataFrame:
    """(file, record, value): lines joined to records, numbered from 1 in their file."""
    so_far = Window.partitionBy("file", "block").orderBy("id")
    before = so_far.rowsBetween(Window.unboundedPreceding, -1)
    quotes = F.char_length("value") - F.char_length(F.replace(F.col("value"), F.lit('"')))
    lines = lines.withColumn("odd", F.coalesce(F.sum(quotes).over(before), F.lit(0)) % 2).withColumn("quotes", quotes)
    # One row per split: parity of the quotes before it, then the records begun before it.
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = lines.groupBy("file", "block").agg(F.sum("quotes").alias("q"), F.count_if(F.col("odd") == 0).alias("n0"), F.count_if(F.col("odd") == 1).alias("n1"))
    splits = splits.withColumn("inside", F.coalesce(F.sum("q").over(earlier), F.lit(0)) % 2)
    begun = F.when(F.col("inside") == 0, F.col("n0")).otherwise(F.col("n1"))
    splits = splits.withColumn("begun", F.coalesce(F.sum(begun).over(earlier), F.lit(0))).select("file", "block", "inside", "begun")
    placed = lines.join(splits, ["file", "block"])
    record = F.col("begun") + F.sum(F.when(F.col("odd") == F.col("inside"), 1).otherwise(0)).over(so_far)
    parts = F.sort_array(F.collect_list(F.struct("block", "id", "value")))
    return (placed.withColumn("record", record).groupBy("file", "record").agg(parts.alias("parts"))
            .select("file", "record", F.array_join(F.col("parts.value"), "\n").alias("value")))


def write_report(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> str:
    """Result file(s); CSV gets a header."""
    w = df.write.mode(mode)
    if fmt == "csv":
        w = w.option("header", True)
    w.format(fmt).save(path)
    return path


def write_split(df: DataFrame, key: str, path: str, fmt: str = "parquet", max_rows: int = 1_000_000) -> str:
    """One folder per entity (``partitionBy``), written by all tasks in
    parallel; no driver loop over keys. A key's rows go to as many tasks as
    its count needs at ``max_rows`` each, spread by a deterministic hash (a
    retried task rebuilds the same rows, unlike a random salt)."""
    parts = df.groupBy(F.col(key).alias("_key")).agg(F.ceil(F.count(F.lit(1)) / max_rows).alias("_parts"))
    salted = F.pmod(F.xxhash64(*df.columns), F.col("_parts"))
    (df.join(parts, F.col(key).eqNullSafe(F.col("_key"))).withColumn("_salt", salted).repartition(F.col(key), F.col("_salt"))
     .select(*df.columns).write.mode("overwrite").option("maxRecordsPerFile", max_rows)
     .partitionBy(key).format(fmt).save(path))
    return path


def with_chunk_index(df: DataFrame, order: Sequence[str], rows_per_chunk: int,
                     name: str = "chunk") -> DataFrame:
    """Global row number in ``order`` and chunk = (row_number - 1) // n.

    Distributed: a range-partitioned sort, per-partition counts (one row per
    partition), their running offsets, and the local index inside each
    partition. The sorted frame is checkpointed so that every use sees the
    same partitioning. ``order`` must be a total order (end it with a unique
    key): the range partitioner can then split a hot leading value across
    partitions, and the numbering is deterministic."""
    sorted_df = df.orderBy(*order).withColumn("_pid", F.spark_partition_id()).withColumn(
        "_mid", F.monotonically_increasing_id())
    sorted_df = cut_lineage(sorted_df)
    per = sorted_df.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_base"))
    # One row per partition: the running sum is over a table of that size.
    per = per.withColumn("_offset", F.sum("_n").over(Window.orderBy("_pid").rowsBetween(
        Window.unboundedPreceding, -1))).fillna({"_offset": 0})
    out = sorted_df.join(F.broadcast(per.select("_pid", "_offset", "_base")), "_pid")
    rn = F.col("_offset") + (F.col("_mid") - F.col("_base")) + 1
    return (out.withColumn("row_number", rn)
            .withColumn(name, F.floor((F.col("row_number") - 1) / rows_per_chunk).cast("long"))
            .drop("_pid", "_mid", "_offset", "_base"))


def write_chunked(df: DataFrame, path: str, max_rows: int = 1_000_000, fmt: str = "csv") -> str:
    """Files of at most ``max_rows`` rows each (sheet-size cap)."""
    w = df.write.mode("overwrite").option("maxRecordsPerFile", max_rows)
    if fmt == "csv":
        w = w.option("header", True)
    w.format(fmt).save(path)
    return path


LEDGER = "shipment_number string, shipment_logged_at timestamp_ntz, process_name string"


def open_ledger(spark: SparkSession, path: str, schema: str = LEDGER) -> DataFrame:
    """The sent ledger, created empty where it does not exist (appending no
    rows creates the folder and changes nothing else)."""
    spark.createDataFrame([], schema).write.mode("append").partitionBy("process_name").parquet(path)
    return spark.read.schema(schema).parquet(path)


def append_ledger(report: DataFrame, path: str, process: str, as_of: str) -> DataFrame:
    """Append the distinct reported shipments that the process has not
    logged yet, and read its rows back. The report is stored first, so the
    append neither recomputes it nor sees its own rows; appending the same
    report again adds nothing."""
    spark = report.sparkSession
    stored = cut_lineage(report.select("shipment_number").distinct(), "ledger-rows")
    logged = open_ledger(spark, path).where(F.col("process_name") == process)
    rows = (stored.join(logged.select("shipment_number"), "shipment_number", "left_anti")
            .withColumn("process_name", F.lit(process))
            .withColumn("shipment_logged_at", F.lit(as_of).cast("timestamp_ntz")))
    cut_lineage(rows, "ledger-new").write.mode("append").partitionBy("process_name").parquet(path)
    return spark.read.schema(LEDGER).parquet(path).where(F.col("process_name") == process)


def attachments(frames: Sequence[tuple[str, DataFrame]]) -> list[tuple[str, DataFrame]]:
    """What one mail carries. The first frame is the report: without rows
    nothing is sent. Each further frame goes along only if it has rows too."""
    first, *rest = frames
    if first[1].isEmpty():
        return []
    return [first, *[(name, df) for name, df in rest if not df.isEmpty()]]


def manifest(frames: dict[str, DataFrame], recipient: str, item: str) -> DataFrame:
    """Per recipient, the reports that have rows for them and the items
    inside; a recipient appears only with at least one non-empty report."""
    parts = [f.select(F.col(recipient).alias("recipient"), F.col(item).alias("item"),
                      F.lit(name).alias("report")) for name, f in frames.items()]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.groupBy("recipient").agg(F.array_sort(F.collect_set("report")).alias("reports"),
                                      F.count_distinct("item").alias("n_items"))
