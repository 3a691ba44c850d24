"""R3 + S9: runs of one pulse that overlap report a shipment once.

A schedule may start a run before the last one has ended, and two drivers may run
the same pulse. Each run holds its report against the ledger that it sees, and
stages it; one publication then makes report and ledger rows visible together. A
publication takes the number behind the ledger that the run has seen. If another
run took it meanwhile, the report is held against the ledger anew, so that what the
other has reported drops out, and the next number is tried. A run that dies before
its publication has reported nothing; its shipments are a later run's.

The ledger of a process is a base (keys of old runs) and the last runs' reports;
old runs are merged into the base, so files and list stay bounded.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.session import cut_lineage
from martlet.sources import publish

KEY = "shipment_number"
#: Runs of a process whose reports stay listed.
RUNS = 200


@dataclass
class Run:
    """A report that is staged against the ledger of publication ``number`` - 1."""

    process: str
    report: DataFrame
    number: int
    folder: str | None = None
    n_rows: int = 0


def _base(process: str) -> str:
    return f"base of {process}"


def _read(spark: SparkSession, target: str, rows: list) -> list[DataFrame]:
    return [spark.read.schema(T.StructType.fromJson(json.loads(r["layout"]))).parquet(f"{target}/{r['folder']}") for r in rows]


def ledger_keys(spark: SparkSession, target: str, process: str) -> DataFrame | None:
    """Shipments that the process has reported; None before its first run."""
    rows = [r for r in publish.listed(spark, target) if r["part"] in (process, _base(process))]
    if not rows:
        return None
    frames = [f.select(KEY) for f in _read(spark, target, rows)]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def reports(spark: SparkSession, target: str, process: str) -> list[DataFrame]:
    """The reports of the process's last runs, oldest first."""
    return _read(spark, target, [r for r in publish.listed(spark, target) if r["part"] == process])


def begin(report: DataFrame, target: str, process: str) -> Run:
    """Stage what the ledger does not have of ``report``, which is stored first
    so that a second look at the ledger needs no second computation."""
    run = Run(process, cut_lineage(report, "report"), 0)
    _stage(run, target)
    return run


def _stage(run: Run, target: str) -> None:
    spark = run.report.sparkSession
    run.number = publish.next_number(spark, target)  # read before the ledger: what comes later takes it
    sent = ledger_keys(spark, target, run.process)
    fresh = run.report if sent is None else run.report.join(sent, KEY, "left_anti").select(*run.report.columns)
    run.folder = publish.stage(fresh, target)
    run.n_rows = spark.read.schema(run.report.schema).parquet(f"{target}/{run.folder}").count()


def finish(run: Run, target: str, runs: int = RUNS) -> DataFrame:
    """Publish the run's report and return it: the rows that no other run has
    reported, which may be none."""
    spark = run.report.sparkSession
    layout = json.dumps(run.report.schema.jsonValue())
    while run.n_rows:
        listed = [tuple(r) for r in publish.listed(spark, target)]
        if publish.take(spark, target, run.number, [*listed, (run.process, run.folder, run.n_rows, None, layout)]):
            break
        _stage(run, target)
    if run.n_rows:
        _merge_old(spark, target, run.process, runs)
        publish.clear(spark, target)
    return spark.read.schema(run.report.schema).parquet(f"{target}/{run.folder}")


def _merge_old(spark: SparkSession, target: str, process: str, runs: int) -> None:
    """Once twice as many runs are listed, the older half moves into the base."""
    mine = [r for r in publish.listed(spark, target) if r["part"] == process]
    if len(mine) < 2 * runs:
        return
    old = mine[:-runs]
    gone = {r["folder"] for r in old}
    keys = None
    for f in _read(spark, target, [*old, *[r for r in publish.listed(spark, target) if r["part"] == _base(process)]]):
        keys = f.select(KEY) if keys is None else keys.unionByName(f.select(KEY))
    keys = keys.distinct()
    folder = publish.stage(keys, target)
    n = spark.read.schema(keys.schema).parquet(f"{target}/{folder}").count()
    base = (_base(process), folder, n, None, json.dumps(keys.schema.jsonValue()))

    def change(listed: list[tuple]) -> list[tuple]:
        if not gone <= {r[1] for r in listed}:  # another run has merged them
            return listed
        return [base, *[r for r in listed if r[0] != base[0] and r[1] not in gone]]

    publish.publish(spark, target, change)


def report_once(report: DataFrame, target: str, process: str, runs: int = RUNS) -> DataFrame:
    """One run from its report to its publication."""
    return finish(begin(report, target, process), target, runs)


def logged(spark: SparkSession, target: str, process: str, as_of: str) -> DataFrame:
    """The process's ledger in the form of the other ledgers."""
    keys = ledger_keys(spark, target, process)
    if keys is None:
        keys = spark.createDataFrame([], f"{KEY} string")
    return keys.distinct().withColumn("process_name", F.lit(process)).withColumn("shipment_logged_at", F.lit(as_of).cast("timestamp_ntz"))
