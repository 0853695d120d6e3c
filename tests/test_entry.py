"""Driver contract: entry runs; every query matches its SQL oracle (sf0.001)."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as E  # noqa: E402
from namewright.plans.registry import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["curve_id", "curve_name", "short_curve_name", "curve_description",
                          "load_set_id", "is_valid"]
    assert df.count() > 0


def test_every_query_has_an_oracle_or_is_rows_only():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(QUERIES) <= set(E.oracle_sql())


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_queries_match_oracle(spark):
    from compare import compare
    res = compare(spark, SF, verbose=False)
    bad = {k: v for k, v in res.items() if "values_match" in v and not v["values_match"]}
    assert not bad, bad
