"""Table scans.

Production reads a catalog table or JDBC; tests read one parquet file per
table. Column lists and predicates are handed to Spark so that Catalyst pushes
them into the scan (``PushedFilters`` / ``ReadSchema`` in the plan).
"""

from __future__ import annotations

import os
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
               "lineitem", "events", "documents", "embeddings", "pages",
               "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = os.path.join(sf_dir, f"{name}.parquet")
    return spark.read.parquet(path)


def scan(spark: SparkSession, sf_dir: str, name: str,
         columns: Iterable[str] | None = None,
         where: Column | str | None = None) -> DataFrame:
    """Project and filter at the source; both reach the parquet reader."""
    df = table(spark, sf_dir, name)
    if where is not None:
        df = df.filter(where)
    if columns is not None:
        df = df.select(*columns)
    return df


def read_jdbc(spark: SparkSession, url: str, query: str, props: dict,
              partition_column: str | None = None, lower: int | None = None,
              upper: int | None = None, num_partitions: int = 64) -> DataFrame:
    """Operational-table scan (S2). Split by a numeric key so that the read is
    parallel instead of one connection pulling the whole table."""
    reader = spark.read.format("jdbc").option("url", url).options(**props)
    if partition_column is not None:
        reader = (reader.option("dbtable", f"({query}) t")
                  .option("partitionColumn", partition_column)
                  .option("lowerBound", lower).option("upperBound", upper)
                  .option("numPartitions", num_partitions))
    else:
        reader = reader.option("query", query)
    return reader.load()
