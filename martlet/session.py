"""Spark session defaults and the shared checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# The report zone and the pinned "now" of every compared query.
REPORT_TZ = "Europe/Moscow"
AS_OF = "2000-01-07 09:00:00"


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "martlet") -> SparkSession:
    """Session for tests and local runs. On a cluster the submit config wins
    (getOrCreate keeps an existing session's settings)."""
    spark = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.codegen.maxFields", "300")  # the mart has more than the default's 100 columns
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("MARTLET_DRIVER_MEM", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting points at shared storage and is left alone; a
    cluster session without it is an error, because a machine-local folder
    would be a different one on every executor. Only a ``local`` master (tests)
    gets a fresh scratch folder.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError(f"set spark.checkpoint.dir to a shared folder (master {master or 'unknown'})")
        path = tempfile.mkdtemp(prefix="martlet-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    try:  # RDD checkpoints are not used here; set it for callers that do
        spark.sparkContext.setCheckpointDir(path)
    except Exception:  # noqa: BLE001 - e.g. a Spark Connect session has no SparkContext
        pass
    return path


def cut_lineage(df, name: str = "stage"):
    """Materialise ``df`` as a parquet table in the shared checkpoint folder
    and read it back: the plan is computed once, later uses read fixed files
    (so ids and sorts do not change on recomputation), lineage is cut, and a
    lost executor only costs a re-read. The read-back also carries real file
    sizes for the optimizer's broadcast decisions."""
    import uuid

    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
