"""Window operators (W1-W3): history order, exchange pairs, response delay.

Positions and the "next message" of W2 come from ``plans.skew``, one pass each, so a
single huge conversation is split across tasks instead of landing in one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.plans.skew import ordinal, running
from parley.operators.stats import exact_percentiles


def message_history(m: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Messages with ``ordinal`` = position in (created_at, message_id) order."""
    return ordinal(m, ["conversation_id"], ["created_at", "message_id"], out="ordinal", max_rows=max_rows)


def exchanges(m: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Each user message with the assistant message directly after it (or nulls)."""
    after = running(m.select("conversation_id", "message_id", "role", "ai_model", "created_at"),
                    ["conversation_id"], ["created_at", "message_id"],
                    {"_next": ("next", F.struct("role", "message_id", "created_at", "ai_model"))}, max_rows=max_rows)
    reply = F.when(F.col("_next.role") == "assistant", F.col("_next"))
    return (after.filter(F.col("role") == "user")
                 .select("conversation_id", F.col("message_id").alias("user_message_id"),
                         F.col("created_at").alias("user_at"), reply.alias("_reply"))
                 .select("conversation_id", "user_message_id", "user_at",
                         F.col("_reply.message_id").alias("reply_message_id"),
                         F.col("_reply.created_at").alias("reply_at"), F.col("_reply.ai_model").alias("reply_model")))


def response_delay(m: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Seconds from each user message to its reply (answered exchanges only)."""
    x = exchanges(m, max_rows=max_rows).filter(F.col("reply_message_id").isNotNull())
    return x.select(
        "conversation_id", "user_message_id", "reply_message_id", "reply_model",
        (F.timestamp_diff("MICROSECOND", F.col("user_at"), F.col("reply_at")) / F.lit(1e6)).alias("delay_s"))


def response_delay_by_model(m: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Count, mean and exact p50/p95 of the reply delay per model."""
    d = response_delay(m, max_rows=max_rows)
    out = exact_percentiles(d, ["reply_model"], "delay_s",
                            {"p50_s": 0.5, "p95_s": 0.95}, max_rows=max_rows,
                            extra={"exchanges": F.sum("_c"),
                                   "mean_s": F.round(F.sum(F.col("_v") * F.col("_c")) / F.sum("_c"), 6)})
    return out.select("reply_model", "exchanges", "mean_s",
                      F.round("p50_s", 6).alias("p50_s"), F.round("p95_s", 6).alias("p95_s"))
