"""Views that turn the driver tables into the product's tables.

``conversations`` (conv_id, turn, role, text), ``events`` and ``customer`` are
the only inputs; owner, title, model, tier, membership and change sets are
derived by fixed arithmetic (see FIXTURES.md and README), so results on them
show that operators are right, not facts about real data. Every view is a lazy
DataFrame over the Parquet scan, so filters and column pruning reach the files.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: fixture model assignment (index = key % 8 + 1) --------
FIXTURE_MODELS = [
    "gpt-4",
    "gpt-3.5-turbo",
    "claude-3-sonnet",
    "claude-3-haiku",
    "mistral-7b-instruct",
    "mistral-medium",
    "llama-2",
    None,
]
EPOCH = "2024-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _model_at(index: Column) -> Column:
    models = F.array(*[F.lit(m).cast("string") for m in FIXTURE_MODELS])
    return F.element_at(models, index.cast("int"))


def _at_seconds(seconds: Column) -> Column:
    """EPOCH + seconds as TIMESTAMP_NTZ, zone-free."""
    return F.expr(f"TIMESTAMP_NTZ '{EPOCH}'") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), seconds.cast("bigint").cast("decimal(18,6)"))


def _message_seconds() -> Column:
    return F.col("conv_id") * 3600 + F.col("turn") * 60 + F.length("text") % 50


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    return c.select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("message_id"),
        F.col("conv_id").alias("conversation_id"),
        (F.col("conv_id") % 37).alias("user_id"),
        F.col("role"),
        F.col("text").alias("content"),
        F.when(F.col("role") == "assistant", _model_at(F.col("conv_id") % 8 + 1)).alias("ai_model"),
        _at_seconds(_message_seconds()).alias("created_at"),
        F.size(F.filter(F.split("text", r"[ \n\t]+"), lambda x: x != "")).cast("int").alias("token_count"),
    )


def chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    last = F.max(F.when(F.col("role") == "assistant", _at_seconds(_message_seconds())))
    per_conv = c.groupBy("conv_id").agg(last.alias("last_message_at"))
    k = F.col("conv_id")
    return per_conv.select(
        k.alias("conversation_id"),
        (k % 37).alias("user_id"),
        F.when(k % 3 == 0, F.lit("New Conversation"))
         .when(k % 3 == 1, F.lit(""))
         .otherwise(F.concat(F.lit("Topic "), k.cast("string"))).alias("title"),
        _model_at(k % 8 + 1).alias("ai_model"),
        (k % 7 != 0).alias("is_active"),
        _at_seconds(k * 3600).alias("created_at"),
        F.col("last_message_at"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    seg = F.col("c_mktsegment")
    paid = seg.isin("MACHINERY", "BUILDING", "AUTOMOBILE")
    prefs = F.concat(
        F.lit('{"theme":"'), F.when(k % 2 == 0, "dark").otherwise("light"),
        F.lit('","notifications":'), F.when(k % 5 == 0, "false").otherwise("true"), F.lit("}"))
    return c.select(
        k.alias("id"),
        F.lower(F.concat(F.replace(F.col("c_name"), F.lit("#"), F.lit("")), F.lit("@example.com"))).alias("email"),
        F.col("c_name").alias("name"),
        F.when(k % 3 == 0, "email").when(k % 3 == 1, "google").otherwise("apple").alias("provider"),
        F.when(seg == "MACHINERY", "enterprise")
         .when(seg.isin("BUILDING", "AUTOMOBILE"), "premium").otherwise("free").alias("subscription_tier"),
        F.when(paid, _at_seconds((k % 60) * 86400)).alias("subscription_expires_at"),
        _model_at(k % 6 + 1).alias("default_model"),
        F.when(k % 4 != 0, prefs).alias("preferences"),
        (k % 11 != 0).alias("is_active"),
        _at_seconds(k * 60).alias("created_at"),
    )


def room_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    t = F.col("event_type")
    return e.select(
        "event_id",
        (F.col("event_id") % 20).alias("conversation_id"),
        F.col("user_id").alias("client_id"),
        F.when(t == "view", "join").when(t == "error", "leave").when(t == "click", "typing_on")
         .when(t == "purchase", "typing_off").otherwise("message").alias("kind"),
        "ts",
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("request_id"),
        (F.col("user_id") % 50).alias("client_ip"),
        "user_id",
        F.when(F.col("event_type") == "signup", "login").otherwise("call").alias("kind"),
        "ts",
        F.col("value").alias("response_ms"),
    )


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from parley.catalog import OUTCOME_TEXTS
    m = messages(spark, sf_dir).filter(F.col("role") == "assistant")
    k = F.col("conversation_id") % 10
    content = F.col("content")
    for i, (text, _) in reversed(list(enumerate(OUTCOME_TEXTS))):
        content = F.when(k == i, F.lit(text)).otherwise(content)
    return m.select("message_id", "conversation_id", "user_id", "ai_model", "created_at",
                    content.alias("content"))


# --- change sets (ours): derived from ``events`` by fixed arithmetic ------

def _existing_email(uid: Column) -> Column:
    return F.concat(F.lit("customer"), F.lpad(uid.cast("string"), 9, "0"), F.lit("@example.com"))


def registrations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sign-up attempts: known emails, in-batch repeats, other case, bad form."""
    e = table(spark, sf_dir, "events").filter(F.col("event_type") == "signup")
    i, u = F.col("event_id"), F.col("user_id")
    return e.select(
        (F.lit(10_000_000) + i).alias("reg_id"),
        F.when(i % 5 == 0, F.lit("X")).otherwise(F.concat(F.lit("User "), u.cast("string"))).alias("name"),
        F.when(i % 4 == 0, _existing_email(u))
         .when(i % 4 == 1, F.concat(F.lit("new"), u.cast("string"), F.lit("@example.com")))
         .when(i % 4 == 2, F.upper(_existing_email(u)))
         .otherwise(F.concat(F.lit("user"), u.cast("string"), F.lit(".example.com"))).alias("email"),
        F.repeat(F.lit("p"), (F.lit(3) + i % 9).cast("int")).alias("password"),
        F.lit("email").alias("provider"),
        "ts",
    )


def profile_patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile changes: listed fields, explicit nulls, forbidden, malformed, taken and colliding values."""
    e = table(spark, sf_dir, "events").filter(F.col("event_type") == "click")
    i, u = F.col("event_id"), F.col("user_id")
    arr = lambda *names: F.array(*[F.lit(n) for n in names])
    return e.select(
        i.alias("patch_id"),
        u.alias("user_id"),
        F.when(i % 6 == 0, arr("name")).when(i % 6 == 1, arr("default_model"))
         .when(i % 6 == 2, arr("preferences")).when(i % 6 == 3, arr("name", "email"))
         .when(i % 6 == 4, arr("password")).otherwise(arr("default_model", "preferences")).alias("fields"),
        F.when(i % 18 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("Renamed "), i.cast("string"))).alias("name"),
        F.when(i % 12 == 3, _existing_email(u + 1))
         .when(i % 36 == 9, F.concat(F.lit("same"), (u % 7).cast("string"), F.lit("@example.com")))
         .when(i % 36 == 21, F.lit("not-an-email")).when(i % 72 == 33, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("moved"), i.cast("string"), F.lit("@example.com"))).alias("email"),
        F.when(i % 4 == 1, F.lit(None).cast("string")).otherwise(F.lit("gpt-4")).alias("default_model"),
        F.when(i % 4 == 0, F.lit('{"theme":"dark","notifications":{"email":true,"push":false}}'))
         .otherwise(F.lit('{"theme":"light","notifications":true}')).alias("preferences"),
        F.lit("secret123").alias("password"),
        "ts",
    )


def user_deletions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").filter(F.col("event_type") == "purchase")
    i, u = F.col("event_id"), F.col("user_id")
    return e.select(F.when(i % 3 == 0, u + 1_000_000).otherwise(u).alias("id"), "ts")


def conversation_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").filter(F.col("event_type") == "view")
    i = F.col("event_id")
    return e.select(
        (F.lit(1_000_000) + i).alias("conversation_id"),
        "user_id",
        F.when(i % 10 != 0, F.concat(F.lit("Chat "), i.cast("string"))).alias("title"),
        F.when(i % 3 == 0, F.lit(None).cast("string")).when(i % 3 == 1, F.lit("claude-3-haiku"))
         .otherwise(F.lit("gpt-4")).alias("ai_model"),
        F.col("ts").alias("created_at"),
    )


def delete_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").filter(F.col("event_type") == "error")
    return e.select((F.col("event_id") % 120).alias("conversation_id"),
                    (F.col("user_id") % 37).alias("user_id"), "ts")
