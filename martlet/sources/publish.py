"""Publication of tables in place (S8): whole, or partition by partition.

A table's folder holds ``data`` (a folder per staged version) and ``versions`` (a
folder per publication, named by its number). A publication lists, one row a
partition, the data folder that is current for it; a table without partitions has
one row. Replacing some partitions publishes a new list that differs in their rows
only, so several partitions change in one step, and a reader that has read a list
reads one consistent state.

Nothing is ever changed in place: data is staged and checked first, and one write of
the next number makes it current. A crash before that leaves the former state; a
number that someone else has written meanwhile is an error of the write, and the
list is then made again from theirs. Numbers, not clocks, tell which is newest.

The last ``keep`` publications stay readable. Older ones go, with the data that only
they name, and so do stages that were begun that long ago and never published.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LIST = "part string, folder string, n_rows long, upto long, layout string"
KEEP = 3
_WIDTH = 12  # digits of a number in a folder's name, so that names sort as numbers do


# ---------------------------------------------------------------- folders


def _located(spark: SparkSession, path: str):
    """(file system, path) of Hadoop for any store that Spark reads."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _located(spark, path)
    return fs.exists(at)


def children(spark: SparkSession, path: str) -> list[str]:
    """Sorted names in a folder; none if it is not there."""
    fs, at = _located(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library made, with all that it holds."""
    fs, at = _located(spark, path)
    fs.delete(at, True)


def complete(spark: SparkSession, path: str) -> list[str]:
    """Sorted names of the folders in ``path`` whose write has ended."""
    return [name for name in children(spark, path) if exists(spark, f"{path}/{name}/_SUCCESS")]


# ---------------------------------------------------------------- publications


def _number(name: str) -> int:
    return int(name.partition("=")[2][:_WIDTH])


def publications(spark: SparkSession, target: str) -> list[str]:
    """Names of the table's publications, oldest first."""
    return complete(spark, f"{target}/versions")


def listed(spark: SparkSession, target: str, name: str | None = None) -> list:
    """Rows of a publication (the newest by default): one per partition."""
    names = publications(spark, target)
    if not names:
        return []
    return spark.read.schema(LIST).parquet(f"{target}/versions/{name or names[-1]}").collect()


def stage(df: DataFrame, target: str, key: str | None = None) -> str:
    """Write ``df`` as a version that nobody reads yet; returns its folder,
    relative to the table. ``key`` parts it."""
    spark = df.sparkSession
    folder = f"data/version={next_number(spark, target):0{_WIDTH}d}-{uuid.uuid4().hex[:8]}"
    writer = df.write
    if key:
        writer = writer.partitionBy(key)
    writer.parquet(f"{target}/{folder}")
    return folder


def publish(spark: SparkSession, target: str, change: Callable[[list[tuple]], list[tuple]], keep: int = KEEP) -> None:
    """Make ``change`` of the newest list's rows the next publication. Where
    another run has taken its number, the change is made on that run's list."""
    while not take(spark, target, next_number(spark, target), change([tuple(r) for r in listed(spark, target)])):
        pass
    clear(spark, target, keep)


def next_number(spark: SparkSession, target: str) -> int:
    """The number that the next publication takes, if no one else does before."""
    names = children(spark, f"{target}/versions")
    return (_number(names[-1]) if names else 0) + 1


def take(spark: SparkSession, target: str, number: int, rows: list[tuple]) -> bool:
    """Write ``rows`` as publication ``number``; False if it is taken."""
    try:
        spark.createDataFrame(rows, LIST).coalesce(1).write.mode("errorifexists").parquet(f"{target}/versions/number={number:0{_WIDTH}d}")
        return True
    except AnalysisException as e:
        if e.getCondition() != "PATH_ALREADY_EXISTS":
            raise
        return False


def clear(spark: SparkSession, target: str, keep: int = KEEP) -> None:
    """Drop what the last ``keep`` publications do not name: older lists, the
    data of those alone, and stages begun before the oldest that stays."""
    names = publications(spark, target)
    stay, old = names[-keep:], names[:-keep]
    if not old:
        return
    used = {r["folder"] for name in stay for r in listed(spark, target, name)}
    oldest = _number(stay[0])
    for name in old:  # first the lists, so that none names what is gone
        remove(spark, f"{target}/versions/{name}")
    for version in children(spark, f"{target}/data"):
        folder = f"data/{version}"
        if folder in used or _number(version) >= oldest:
            continue
        mine = {f.split("/")[2] for f in used if f.startswith(f"{folder}/")}
        if not mine:
            remove(spark, f"{target}/{folder}")
            continue
        for part in children(spark, f"{target}/{folder}"):  # partitions of it may live on
            if "=" in part and part not in mine:
                remove(spark, f"{target}/{folder}/{part}")


# ---------------------------------------------------------------- tables


def refresh(df: DataFrame, target: str, required: Sequence[str] = (), upto: int | None = None, keep: int = KEEP) -> DataFrame:
    """Full refresh with a swap: staged, checked there (not empty, required
    columns without NULLs), published; the table's new state is returned."""
    spark = df.sparkSession
    folder = stage(df, target)
    n = _checked(spark.read.parquet(f"{target}/{folder}"), folder, required)
    publish(spark, target, lambda rows: [(None, folder, n, upto, json.dumps(df.schema.jsonValue()))], keep)
    return current(spark, target)


def refresh_partitions(df: DataFrame, target: str, key: str, required: Sequence[str] = (), drop: Sequence[str] = (),
                       keep: int = KEEP) -> DataFrame:
    """Replace the partitions of ``key`` that ``df`` holds, add those that
    are new, and leave out those whose value (as text) is in ``drop``, all in one
    publication; the other partitions' data is not touched or read. The table's
    new state is returned. One row a partition passes through the driver."""
    spark = df.sparkSession
    folder = stage(df, target, key)
    # The schema parts as Spark names the folders; values come from the data itself.
    staged = spark.read.schema(df.schema).parquet(f"{target}/{folder}")
    _checked(staged, folder, required)
    at = F.regexp_extract(F.col("_metadata.file_path"), f"(version=[^/]+/{key}=[^/]+)/[^/]+$", 1)
    parts = staged.groupBy(F.col(key).cast("string").alias("part"), at.alias("at")).agg(F.count(F.lit(1)).alias("n")).collect()
    layout = json.dumps(df.schema.jsonValue())
    names = set(children(spark, f"{target}/{folder}"))
    new = {r["part"]: (r["part"], f"data/{_plain(r['at'], names)}", r["n"], None, layout) for r in parts}

    def change(rows: list[tuple]) -> list[tuple]:
        stay = [(*r[:4], layout) for r in rows if r[0] not in new and r[0] not in drop]
        return stay + list(new.values())

    publish(spark, target, change, keep)
    return current(spark, target)


def _plain(at: str, names: set[str]) -> str:
    """A version's partition folder by its own name: file paths come with escapes
    on top of the names'."""
    version, name = at.split("/")
    return f"{version}/{name if name in names else unquote(name)}"


def _checked(staged: DataFrame, folder: str, required: Sequence[str]) -> int:
    checks = [F.count(F.lit(1)).alias("_rows")] + [F.count_if(F.col(c).isNull()).alias(c) for c in required]
    stats = staged.agg(*checks).first()
    if stats["_rows"] == 0 or any(stats[c] for c in required):
        raise ValueError(f"stage {folder} failed validation: {stats.asDict()}")
    return stats["_rows"]


def current(spark: SparkSession, target: str, name: str | None = None) -> DataFrame:
    """The table's newest state, or the one of the publication ``name``."""
    rows = listed(spark, target, name)
    if not rows:
        raise ValueError(f"nothing is published at {target}")
    schema = T.StructType.fromJson(json.loads(rows[0]["layout"]))
    folders = [f"{target}/{r['folder']}" for r in rows]
    if all(r["part"] is None and r["folder"].count("/") == 1 for r in rows):
        return spark.read.schema(schema).parquet(*folders)
    return spark.read.schema(schema).option("basePath", f"{target}/data").parquet(*folders).select(*schema.names)


# ---------------------------------------------------------------- changes on top


def write_delta(df: DataFrame, target: str, number: int) -> None:
    """The rows of change ``number``; a replay writes the same folder again."""
    df.write.mode("overwrite").parquet(f"{target}/deltas/batch_id={number}")


def _deltas(spark: SparkSession, target: str, after: int | None) -> list[str]:
    numbers = sorted(int(name.partition("=")[2]) for name in complete(spark, f"{target}/deltas"))
    return [f"{target}/deltas/batch_id={n}" for n in numbers if after is None or n > after]


def latest(spark: SparkSession, target: str, keys: Sequence[str]) -> DataFrame:
    """The newest row per key of the published base and the changes behind it,
    with the number of its change as ``batch_id``. NULL keys are keys."""
    base = listed(spark, target)
    paths = _deltas(spark, target, base[0]["upto"] if base else None)
    frames = [current(spark, target)] if base else []
    if paths:
        read = spark.read.option("basePath", f"{target}/deltas").parquet(*paths)
        frames.append(read.withColumn("batch_id", F.col("batch_id").cast("long")))
    if not frames:
        raise ValueError(f"nothing is stored at {target}")
    rows = frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])
    values = [c for c in rows.columns if c not in keys and c != "batch_id"]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*values, "batch_id"), "batch_id").alias("_r"))
    return newest.select(*keys, "_r.*")


def compact(spark: SparkSession, target: str, keys: Sequence[str], upto: int, keep: int = KEEP) -> None:
    """Merge the base and the changes up to number ``upto`` by key into a new
    published base; changes go once no publication that stays needs them. A
    reader meets either the old base with all changes or the new one with those
    behind it. Done again for the same number (a replayed batch), it publishes the
    same rows."""
    base = listed(spark, target)
    if base and base[0]["upto"] >= upto:
        return
    refresh(latest(spark, target, keys).where(F.col("batch_id") <= upto), target, upto=upto, keep=keep)
    reach = min(listed(spark, target, name)[0]["upto"] for name in publications(spark, target))
    for path in _deltas(spark, target, None):
        if int(path.rpartition("=")[2]) <= reach:
            remove(spark, path)
