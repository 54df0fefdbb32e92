"""Joins (J1-J6, J9-J10). The room fan-outs J7/J8 live in ``rooms``.

Join strategy is left to Catalyst/AQE: a side is broadcast when runtime
statistics show it is small, and AQE's skew-join splits a hot conversation or
user on the big side. No join here carries a broadcast hint.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley import catalog as K
from parley.functions.scalars import effective_model, provider_of
from parley.plans.skew import running


def catalogue(spark: SparkSession) -> DataFrame:
    """The listed models: model, provider, premium flag, listing position (6 rows)."""
    rows = []
    for i, m in enumerate(K.AVAILABLE_MODELS):
        provider = next(p for needle, p in K.PROVIDER_ROUTES if needle in m)
        rows.append((m, provider, m in K.PREMIUM_MODELS, i + 1))
    return spark.createDataFrame(rows, "model string, provider string, premium boolean, listing int")


def visible_messages(m: DataFrame, c: DataFrame, user_id=None) -> DataFrame:
    """Messages of conversations the owner can open, with ``owner_id``.

    Ownership is checked, ``is_active`` is not (soft-deleted conversations stay
    readable). With ``user_id`` only that owner's messages are returned.
    """
    owners = c.select("conversation_id", F.col("user_id").alias("owner_id"))
    if user_id is not None:
        owners = owners.filter(F.col("owner_id") == F.lit(user_id))
    out = m.join(owners, "conversation_id", "inner")
    # one owner's messages in time order; for all owners the order is the reader's choice
    return out if user_id is None else out.orderBy("created_at", "message_id")


def orphan_messages(m: DataFrame, c: DataFrame) -> DataFrame:
    """Messages whose conversation is missing or not owned by their sender."""
    return m.join(c.select("conversation_id", "user_id"), ["conversation_id", "user_id"], "left_anti")


def with_conversation_model(m: DataFrame, c: DataFrame) -> DataFrame:
    """Messages with the conversation's model, the model sent and its provider."""
    conv = c.select("conversation_id", F.col("ai_model").alias("conversation_model"))
    out = m.join(conv, "conversation_id", "inner")
    sent = effective_model(F.col("conversation_model"))
    return out.withColumn("sent_model", sent).withColumn("provider", provider_of(sent))


def new_registrations(reg: DataFrame, u: DataFrame) -> DataFrame:
    """Registrations whose email (exact, case-sensitive) is not taken yet."""
    return reg.join(u.select("email"), "email", "left_anti")


def known_requests(r: DataFrame, u: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(requests of existing users, requests of unknown users)."""
    ids = u.select(F.col("id").alias("user_id"))
    return r.join(ids, "user_id", "left_semi"), r.join(ids, "user_id", "left_anti")


def valid_token_requests(r: DataFrame, ttl_seconds: int = K.TOKEN_TTL_SECONDS, max_rows: int | None = None,
                         issuing: Sequence[str] = ("login",)) -> tuple[DataFrame, DataFrame]:
    """(calls inside some token's life, all other calls).

    A call at ``ts`` is valid when a request of an ``issuing`` kind (login, and
    registration where the log has it) of the same user has ``issued <= ts < issued
    + ttl``. The latest one at or before the call decides (an earlier one expires no
    later), so this is an as-of lookup: a running ``max`` of issue times per user in
    time order, issues sorted before calls at the same instant. The skew-safe
    ``running`` splits a hot user, and no pairs are ever formed. A call without a
    user or a time is never valid; every call is in exactly one half.
    """
    is_issue = F.col("kind").isin(*issuing)
    marked = (r.filter(F.col("kind").isin("call", *issuing))
               .withColumn("_issued", F.when(is_issue, F.col("ts")))
               .withColumn("_rank", F.when(is_issue, F.lit(0)).otherwise(F.lit(1))))
    latest = running(marked, ["user_id"], ["ts", "_rank", "request_id"], {"_last": ("max", "_issued")}, max_rows=max_rows)
    life = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(ttl_seconds).cast("decimal(18,6)"))
    calls = latest.filter(F.col("kind") == "call")
    ok = F.coalesce(F.col("user_id").isNotNull() & (F.col("ts") < F.col("_last") + life), F.lit(False))
    return calls.filter(ok).select(*r.columns), calls.filter(~ok).select(*r.columns)


def login_attempts(logins: DataFrame, u: DataFrame) -> tuple[DataFrame, DataFrame]:
    """J4's counterpart: (logins whose email, exact and case-sensitive, belongs to a user; the unknown ones)."""
    emails = u.select("email")
    return logins.join(emails, "email", "left_semi"), logins.join(emails, "email", "left_anti")


def effective_tier(as_of) -> F.Column:
    """Paid tiers whose subscription ended at or before ``as_of`` count as free (ours)."""
    as_of = F.lit(as_of).cast("timestamp_ntz") if isinstance(as_of, str) else as_of
    expired = F.col("subscription_expires_at").isNotNull() & (F.col("subscription_expires_at") <= as_of)
    return (F.when(F.col("subscription_tier").isin("premium", "enterprise") & expired, F.lit("free"))
             .otherwise(F.col("subscription_tier")))


def entitlement_violations(c: DataFrame, u: DataFrame, models: DataFrame, as_of) -> DataFrame:
    """Conversations on a premium model whose owner is (effectively) free."""
    premium = models.filter(F.col("premium")).select(F.col("model").alias("ai_model"))
    on_premium = c.join(premium, "ai_model", "left_semi")
    owners = u.select(F.col("id").alias("user_id"), "subscription_tier", "subscription_expires_at")
    return (on_premium.join(owners, "user_id", "inner")
                      .withColumn("effective_tier", effective_tier(as_of))
                      .filter(F.col("effective_tier") == "free")
                      .select("conversation_id", "user_id", "ai_model", "subscription_tier",
                              "subscription_expires_at", "effective_tier"))


def with_catalogue(df: DataFrame, models: DataFrame, model_col: str = "ai_model") -> DataFrame:
    """Routing provider, listing status and premium flag of each row's model."""
    cat = models.select(F.col("model").alias("_model"), F.col("premium").alias("_premium"))
    out = df.join(cat, df[model_col] == cat["_model"], "left")
    return (out.withColumn("provider", provider_of(F.col(model_col)))
               .withColumn("listed", F.col("_model").isNotNull())
               .withColumn("premium", F.coalesce(F.col("_premium"), F.lit(False)))
               .drop("_model", "_premium"))
