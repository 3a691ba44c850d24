"""The scale properties of the plans, checked on the final adaptive plans."""

import re

import pytest

from martlet.suite.registry import QUERIES, load_all
from tools.plan_report import summarise

SF = "/root/testdata/sf0.01"
load_all()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_cross_join_no_python(spark, key):
    s = summarise(QUERIES[key](spark, SF))
    assert s["bnlj"] == 0, "nested-loop (cross) join in the plan"
    assert s["python"] == 0, "Python evaluation in the plan"


def test_flagship_shuffles_the_fact_once(spark):
    """One exchange for the final group-by; one each for the first manager of a
    group and the one group of a user, which are dimensions."""
    s = summarise(QUERIES["b2b_manager_gmv"](spark, SF))
    assert s["shuffles"] <= 3 and s["smj"] == 0


def test_scan_pushdown_and_pruning(spark):
    import contextlib
    import io

    df = QUERIES["scan_filter_project"](spark, SF)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    plan = buf.getvalue()
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(o_orderstatus,F\)", plan)
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(o_orderdate", plan)
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    # Only the projected and filtered columns are read (not o_orderpriority).
    assert sorted(f.split(":")[0] for f in schema.split(",")) == ["o_custkey", "o_orderdate", "o_orderkey",
                                                                   "o_orderstatus", "o_totalprice"]
