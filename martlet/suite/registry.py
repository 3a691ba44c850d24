"""Registered queries: key -> (Spark callable, oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    """Decorator: add a (spark, sf_dir) -> DataFrame callable under ``key``;
    ``sql`` is the independent DuckDB text it must equal (None: rows-only)."""

    def wrap(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn

    return wrap


def load_all() -> None:
    """Import every suite module so that their decorators run."""
    from martlet.suite import (  # noqa: F401
        basics, joins, aggregates, jobs, streams, io_checks,
    )
