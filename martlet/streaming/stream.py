"""Structured Streaming form of the polling jobs (section 2.9).

The reference re-reads a look-back window every few minutes and drops what
the ledger already has. Here a file (or Kafka) source feeds micro-batches;
the look-back becomes a watermark, the ledger check an anti join inside
``foreachBatch``, and the schedule a trigger. Event times must be
``TIMESTAMP`` for watermarks, so NTZ source columns are cast first (the
session zone is UTC, so the instant does not move).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.session import cut_lineage
from martlet.sources import publish
from martlet.sources.io import open_ledger, scratch_path


def stage_files(df: DataFrame, path: str, n_files: int, order_col: str) -> str:
    """Write a table as ``n_files`` parquet files cut along ``order_col``
    (range partitioned), the shape of a landing folder a stream reads."""
    df.repartitionByRange(n_files, order_col).write.mode("append").parquet(path)
    return path


def read_stream(spark: SparkSession, path: str, schema, files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", files_per_trigger)
    return r.parquet(path)


def with_event_time(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, F.col(col).cast("timestamp"))


def run_to_end(writer, checkpoint: str, trigger: dict | None = None) -> None:
    """Start the query, process everything available, stop. On a cluster the
    same writer runs with ``trigger(processingTime=cfg.trigger)``."""
    q = writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
    q.awaitTermination()
    exc = q.exception()
    if exc is not None:
        raise RuntimeError(str(exc))


def new_only(stream: DataFrame, key: str, ts: str, delay: str) -> DataFrame:
    """Each key once; state is kept for ``delay`` past the event time."""
    return with_event_time(stream, ts).withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def weekly_counts(stream: DataFrame, ts: str, by: str, value: str, delay: str) -> DataFrame:
    """Monday-aligned weekly windows (epoch day 0 is a Thursday, so the
    window start is shifted by 4 days)."""
    s = with_event_time(stream, ts).withWatermark(ts, delay)
    g = s.groupBy(F.window(ts, "7 days", startTime="4 days").alias("w"), by).agg(
        F.count(F.lit(1)).alias("n"), F.sum(value).alias("value_sum"))
    return g.select(F.to_date(F.col("w.start")).alias("week_start"), by, "n", "value_sum")


def upsert_sink(path: str, keys: list[str] | None = None, every: int = 20) -> Callable[[DataFrame, int], None]:
    """foreachBatch sink for update-mode output: each batch's rows land as a
    change of their own (overwritten when a batch is replayed, so a retry is
    idempotent); readers take the latest row per key. With ``keys``, every so many
    batches the changes are merged into a new base, so that neither the files nor
    a reader's work grow with the number of batches."""

    def write(batch: DataFrame, batch_id: int) -> None:
        publish.write_delta(batch, path, batch_id)
        if keys and (batch_id + 1) % every == 0:
            publish.compact(batch.sparkSession, path, keys, batch_id)

    return write


def latest_per_key(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Read an upsert sink: the row of the highest batch per key."""
    return publish.latest(spark, path, keys).drop("batch_id")


STREAM_LEDGER = "shipment_number string, batch_id long, process_name string"


def pulse_batch_sink(spark: SparkSession, out: str, ledger: str, process: str, enrich: Callable[[DataFrame], DataFrame],
                     pending: str | None = None, tries: int = 1000) -> Callable[[DataFrame, int], None]:
    """R2: per micro-batch, drop what the ledger has, enrich, write the report
    for this batch id (overwrite: a replayed batch rewrites the same folder),
    then log the shipments that the stored report holds. Ledger rows carry the
    batch id, and rows of the replayed batch id are ignored when reading, so a
    crash between the two writes cannot lose or double a report.

    A candidate whose lines or offers are not there yet is not in the report and
    stays unlogged. With ``pending``, a folder, it is kept there and tried again
    with every later batch, ``tries`` times at most; batch N reads what batch N - 1
    left and writes a folder of its own, so a replay finds the same candidates.
    Without it, the candidate is reported by a later batch that brings it again."""
    open_ledger(spark, ledger, STREAM_LEDGER)

    def write(batch: DataFrame, batch_id: int) -> None:
        sent = (spark.read.schema(STREAM_LEDGER).parquet(ledger)
                .where((F.col("process_name") == process) & (F.col("batch_id") < batch_id)).select("shipment_number"))
        found = batch.dropDuplicates(["shipment_number"])
        if pending:
            found = found.withColumn("_tries", F.lit(0))
            waiting = f"{pending}/batch_id={batch_id - 1}"
            if publish.exists(spark, f"{waiting}/_SUCCESS"):
                held = spark.read.schema(found.schema).parquet(waiting)
                again = found.select("shipment_number")
                found = found.unionByName(held.join(again, "shipment_number", "left_anti"))
            found = cut_lineage(found.join(sent, "shipment_number", "left_anti"), "candidates")
            fresh = found.drop("_tries")
        else:
            fresh = found.join(sent, "shipment_number", "left_anti")
        report = enrich(fresh)
        path = f"{out}/batch_id={batch_id}"
        report.write.mode("overwrite").parquet(path)
        reported = spark.read.schema(report.schema).parquet(path).select("shipment_number").distinct()
        if pending:
            left = found.join(reported, "shipment_number", "left_anti").withColumn("_tries", F.col("_tries") + 1)
            left.where(F.col("_tries") < tries).write.mode("overwrite").parquet(f"{pending}/batch_id={batch_id}")
            publish.remove(spark, f"{pending}/batch_id={batch_id - 2}")
        (reported.withColumn("process_name", F.lit(process)).withColumn("batch_id", F.lit(batch_id).cast("long"))
         .write.mode("append").partitionBy("process_name").parquet(ledger))

    return write


def await_payment(orders: DataFrame, payments: DataFrame, delay: str, max_wait: str) -> DataFrame:
    """Orders wait for their payment; a stream-stream inner join inside
    the watermark emits an order once its payment arrives within ``max_wait``."""
    o = with_event_time(orders, "completed_at").withWatermark("completed_at", delay).alias("o")
    p = with_event_time(payments, "paid_at").withWatermark("paid_at", delay).alias("p")
    cond = ((F.col("o.order_id") == F.col("p.pay_order_id"))
            & (F.col("p.paid_at") >= F.col("o.completed_at"))
            & (F.col("p.paid_at") <= F.col("o.completed_at") + F.expr(f"interval {max_wait}")))
    return o.join(p, cond, "inner")


def scratch(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, name)


def run_pulse_stream(spark: SparkSession, cfg, src, landing: str, out: str, ledger: str, checkpoint: str,
                     schema=None, files_per_trigger: int | None = None, trigger: dict | None = None,
                     pending: str | None = None) -> None:
    """R2 + R3: the pulse as a streaming query. Candidate shipments land as
    files in ``landing``; every trigger (``cfg.trigger``, e.g. every
    7 or 12 minutes, one run at a time) drops what the ledger has, writes the
    enriched report for the batch and appends the ledger. ``src`` is a ``Sources``,
    or a function that gives one: it is called in every batch, so that lines,
    offers and contacts that landed since the query started are seen (a parquet
    frame keeps the files of the moment it was made). ``pending`` keeps candidates
    whose lines are not there yet for later batches. ``trigger`` replaces the
    schedule (tests use ``{"availableNow": True}``); on the schedule a batch runs at
    every trigger, new candidates or not, so that kept ones are tried again."""
    from martlet.plans import pulse

    sources = src if callable(src) else lambda: src

    def enrich(fresh: DataFrame) -> DataFrame:
        return pulse.enrich_report(fresh, sources(), cfg)

    s = read_stream(spark, landing, schema or spark.read.parquet(landing).schema, files_per_trigger)
    trigger = trigger or {"processingTime": cfg.trigger}
    if pending and "processingTime" in trigger:
        s = _with_ticks(spark, s)
    writer = s.writeStream.foreachBatch(pulse_batch_sink(spark, out, ledger, cfg.process_name, enrich, pending))
    run_to_end(writer, checkpoint, trigger)


def _with_ticks(spark: SparkSession, stream: DataFrame) -> DataFrame:
    """The stream with a source beside it that has a row every second and adds
    none of them: a trigger always finds something new."""
    nothing = spark.readStream.format("rate").option("rowsPerSecond", 1).load().where("value < 0")
    return stream.unionByName(nothing.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in stream.schema]))


# ---------------------------------------------------------------- R6 with payments in parts

# Fixed value: an order whose open rest is this small counts as paid.
TOLERANCE = 1000.0

#: Orders are dealt to so many groups of the stateful operator, whatever their number.
ORDER_BUCKETS = 4096
ORDER_STATE = "orders binary"
PAY_RESULT = "order_id long, status string, order_total double, paid double, n_payments int, decided_ms long"


def order_events(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """One stream of both kinds. ``orders``: a row per shipment (order_id,
    shipment_number, total, completed_at); ``payments``: a row per payment
    (pay_order_id, payment_id, amount, paid_at). Rows without a number or a time
    are no events."""
    def event(df: DataFrame, order: str, kind: str, item: str, amount: str, at: str) -> DataFrame:
        return df.select(F.col(order).cast("long").alias("order_id"), F.lit(kind).alias("kind"), F.col(item).cast("string").alias("item"),
                         F.coalesce(F.col(amount).cast("double"), F.lit(0.0)).alias("amount"), F.col(at).cast("timestamp").alias("at"))

    both = event(orders, "order_id", "shipment", "shipment_number", "total", "completed_at").unionByName(
        event(payments, "pay_order_id", "payment", "payment_id", "amount", "paid_at"))
    return both.where("item is not null and at is not null")


def accumulate_payments(events: DataFrame, delay: str, max_wait: str, tolerance: float = TOLERANCE,
                        buckets: int = ORDER_BUCKETS) -> DataFrame:
    """R6 + P15 + A17 with payments in parts: an order waits until its distinct
    payments reach the sum of its shipments but for ``tolerance``. Events
    (``order_events``) change the order's state in the order of their times, the gate
    is tested after each, and the order is reported once, as ``paid`` with the sum
    and the time at which it passed. ``max_wait`` after its first event a timer gives
    the order up (``given up``); events behind that deadline do not count. A payment
    or a shipment that comes twice counts once; payments alone are no order. Rows
    later than the watermark are dropped.

    A call of the operator costs some milliseconds whatever it holds, so an order is
    not a group of its own: orders are dealt to ``buckets`` groups by a hash of their
    number. A group's state holds its open orders, packed, each with its own
    shipments' and payments' numbers, a handful, and its timer is that of the order
    that ends first. What is kept is bounded by the orders of ``max_wait`` and
    ``delay``, and a group without open orders is not kept. A checkpoint keeps the
    number of ``buckets`` that it was begun with: go on from it with the same."""
    import json
    import zlib

    import pandas as pd

    wait = int(pd.Timedelta(max_wait).total_seconds() * 1000)
    names = [c.split()[0] for c in PAY_RESULT.split(", ")]

    def by_order(frames):
        rows = {}
        for f in frames:
            for order, *event in zip(f["order"].tolist(), f["ms"].tolist(), (f["kind"] == "payment").tolist(), f["item"].tolist(), f["amount"].tolist()):
                rows.setdefault(order, []).append(event)
        return rows

    def decide(_, frames, state):
        told = []

        def tell(order, status, at):
            total, paid, _, payments, _, _ = opened[order]
            told.append((None if order == "" else int(order), status, total, paid, len(payments), at))

        opened = json.loads(zlib.decompress(state.get[0])) if state.exists else {}
        for order, rows in ({} if state.hasTimedOut else by_order(frames)).items():
            rows.sort()
            now = opened.setdefault(order, [0.0, 0.0, [], [], rows[0][0] + wait, False])
            for at, is_payment, item, amount in rows:
                seen = now[3] if is_payment else now[2]
                if now[5] or at > now[4] or item in seen:
                    continue
                seen.append(item)
                now[1 if is_payment else 0] += amount
                if now[2] and now[0] - now[1] <= tolerance:
                    now[5] = True
                    tell(order, "paid", at)
        watermark = state.getCurrentWatermarkMs()
        for order in [o for o, now in opened.items() if now[4] < watermark]:
            if opened[order][2] and not opened[order][5]:
                tell(order, "given up", opened[order][4])
            del opened[order]
        if opened:
            state.update((zlib.compress(json.dumps(opened).encode(), 1),))
            state.setTimeoutTimestamp(min(now[4] for now in opened.values()) + 1)
        elif state.exists:
            state.remove()
        if told:
            yield pd.DataFrame({n: pd.Series(c, dtype=object) if n == "order_id" else c for n, c in zip(names, zip(*told))})

    # Numbers go as text, an unknown one as an empty text: a column of numbers with gaps would lose digits.
    keyed = events.withWatermark("at", delay).select(
        F.pmod(F.xxhash64("order_id"), F.lit(buckets)).alias("bucket"), F.coalesce(F.col("order_id").cast("string"), F.lit("")).alias("order"),
        "kind", "item", "amount", "at", F.unix_millis("at").alias("ms"))
    out = keyed.groupBy("bucket").applyInPandasWithState(decide, PAY_RESULT, ORDER_STATE, "append", "EventTimeTimeout")
    return out.withColumn("decided_at", F.timestamp_millis("decided_ms")).drop("decided_ms")
