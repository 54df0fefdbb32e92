"""Every registered query against its DuckDB oracle on the smallest tables."""

import os
import sys

import __spark_entry__ as E
from conftest import ROOT, SF_SMALL
from parley.plans.registry import QUERIES

sys.path.insert(0, os.path.join(ROOT, "tools"))
from oracle_check import compare  # noqa: E402


def test_every_query_has_an_oracle_or_is_approximate():
    missing = set(QUERIES) - set(E.oracle_sql())
    assert missing == {"active_users_approx", "latency_stats_approx"}


def test_queries_match_oracle(spark):
    res = compare(spark, SF_SMALL, list(QUERIES))
    bad = {k: v for k, v in res.items() if v[0] in ("BAD", "ERROR")}
    assert not bad, bad


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:2] == ["conversation_id", "user_id"]
    assert 0 < df.count() <= 20
