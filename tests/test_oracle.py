"""Every registered query against its DuckDB oracle (sf0.001), the same
check the correctness gate runs at sf0.01."""

import pytest

import __spark_entry__ as entry
from martlet.suite.registry import ORACLE, QUERIES, load_all
from tools.oracle_check import close, digest, duck

SF = "/root/testdata/sf0.001"
load_all()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_oracle(spark, con, key):
    sdf = QUERIES[key](spark, SF)
    srows = [tuple(r) for r in sdf.collect()]
    res = con.execute(ORACLE[key])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    hs, ls = digest(sdf.columns, srows)
    hd, ld = digest(dcols, drows)
    assert hs == hd or close(ls, ld)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["assigned_manager_id", "month", "n_shipments", "gmv"]
