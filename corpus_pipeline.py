"""Corpus pipeline: quality rules, near-dedup, decontamination, secrets, mixing.

Each stage takes (spark, docs, sf_dir) and works on all documents that its
predecessor kept; its result is written as Parquet into the shared folder that
``spark.checkpoint.dir`` names, and read again as the next stage's documents.
All stages but the last return the columns of ``documents``.

Defined results: documents that fail the quality rules go (null, empty and short
texts among them); one document of each near-duplicate group stays; documents
that hold a benchmark passage go; secrets are replaced by a mark and ``n_chars``
follows; the mix returns the documents that it takes at least once, with their
size, target, rate, copies and taken words. An empty table passes through. Extra
columns of any name pass through all stages; the mix's own columns replace
columns of their names.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from martlet.llm import decontam, entropy_mix, golay_simhash, profile_rules, secret_crf
from martlet.llm.registry import read_table
from martlet.session import cut_lineage


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
CORE = ("doc_id", "text", "lang", "source", "n_chars")


def set_apart(stage: Stage) -> Stage:
    """The stage with extra columns out of its way: they take other names while
    it runs, so that none can clash with a column that it makes."""
    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = {c: f"extra_column_{i}" for i, c in enumerate(docs.columns) if c not in CORE}
        out = stage(spark, docs.withColumnsRenamed(names), sf_dir)
        made = {c.lower() for c in out.columns}
        gone = [x for c, x in names.items() if c.lower() in made]
        return out.drop(*gone).withColumnsRenamed({x: c for c, x in names.items() if x not in gone})

    return run_stage


@set_apart
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return profile_rules.judge(docs).filter("kept").select(*docs.columns)


@set_apart
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return golay_simhash.one_of_each(docs)


@set_apart
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontam.clean_documents(docs, read_table(spark, sf_dir, "benchmark"))


@set_apart
def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced in their texts."""
    out = secret_crf.redact(docs)
    if "n_chars" not in docs.columns:
        return out
    length = F.when(F.col("text").isNotNull(), F.char_length("text")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


@set_apart
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with their copies."""
    return entropy_mix.mix_sources(docs).filter("copies > 0")


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("secret scans", redact_secrets),
    ("source mixing", mix),
]

#: Fingerprints, banded alignment and the field are beyond SQL: tests hold the
#: pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each from its predecessor's table."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
