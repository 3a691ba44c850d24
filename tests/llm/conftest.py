"""Small fixtures for the training-data operators."""

import pandas as pd
import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def texts():
    return pd.read_parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows,
    and extra columns with names that the operators make themselves."""
    long = "word" * 40_000 + " " + "alpha beta gamma delta. " * 9_000
    rows = [(1, None, None, None), (2, "", "en", "a"), (3, " \t\n ", "en", "a"), (4, long, "en", "b"), (5, "x", "de", None),
            (6, "x", "de", None), (6, "x", "de", None), (None, "no id here", "en", "a"), (7, "Él niño 日本語 𝄞 ñ", "es", "b")]
    rows = [(*r, "kept", 1.0, 7, "s") for r in rows]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, kept string, score double, size int, spans string")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string")
