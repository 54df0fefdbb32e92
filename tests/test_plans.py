"""Physical-plan properties that matter at scale."""

import pytest

import __spark_entry__ as E
from parley.operators import lookups as P
from parley.operators import topk as T
from parley.plans.registry import QUERIES
from parley.sources import fixtures as fx
from conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    df = P.search_messages(fx.messages(spark, SF_SMALL), role="assistant").select("conversation_id")
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(role), EqualTo(role,assistant)]" in plan
    assert "ReadSchema: struct<conv_id:bigint,role:string>" in plan


def test_top_k_limits_before_the_shuffle(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(T.recent_conversations(fx.chats(spark, SF_SMALL), 3))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "WindowGroupLimit" in plan and "Partial" in plan


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_products(spark, name):
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def _explained(spark, name):
    """The plan a large table would get: no broadcast by size, no adaptive changes."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        return E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_fan_out_is_a_few_passes(spark):
    for name in ("fan_out", "typing_fan_out"):
        plan = _explained(spark, name)
        assert plan.count("FileScan") <= 3 and plan.count("Exchange hashpartitioning") <= 8, plan


def test_statistics_and_exchanges_read_their_table_once(spark):
    for name in ("latency_stats", "response_delay_by_model", "exchanges", "message_history"):
        plan = _explained(spark, name)
        assert plan.count("FileScan") == 1 and "Join" not in plan, plan


def test_caller_tables_are_broadcast_by_size_only(spark):
    for name in ("entitlement_violations", "with_catalogue", "usage_bill", "lookup_users"):
        assert "BroadcastExchange" not in _explained(spark, name), name
