"""The queries that SQL can express, against DuckDB."""

import pytest

from martlet.llm import registry
from tools.oracle_check import close, digest, duck

SF = "/root/testdata/sf0.001"
registry.load_all()


def test_operators_are_registered():
    numbers = {int(k[2:].split("_")[0]) for k in registry.QUERIES}
    assert numbers == set(range(1, 14))


@pytest.mark.parametrize("key", sorted(registry.ORACLE))
def test_matches_oracle(spark, key):
    df = registry.QUERIES[key](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = duck(SF).execute(registry.ORACLE[key])
    names = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(names) and len(rows) == len(want)
    got, low = digest(df.columns, rows)
    exp, high = digest(names, want)
    assert got == exp or close(low, high)
