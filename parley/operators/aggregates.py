"""Aggregation and sequence building (A1-A10).

Per-conversation "first"/"last" values use ``min_by``/``max_by``, which Spark
aggregates partially on the map side: a conversation with a billion messages
leaves each map task as one row. Prompt contexts are built from the skew-safe
message ordinals with an equi-join on (conversation, ordinal), never from one
unbounded list per conversation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley import catalog as K
from parley.functions.scalars import effective_model, outcome_of, provider_of, title_of
from parley.operators.stats import exact_percentiles
from parley.operators.windows import message_history

_OUTCOMES = ["error", "unconfigured", "mock", "empty", "ok"]


def prompt_context_rows(m: DataFrame, max_turns: int | None = None,
                        max_rows: int | None = None) -> DataFrame:
    """A1 (exploded): for every user turn, one row per context message.

    Columns: conversation_id, message_id (the user turn), pos (0-based within
    the context), role, content. The context is all turns up to and including
    the user turn, or the last ``max_turns`` of them.
    """
    h = message_history(m.select("conversation_id", "message_id", "role", "content", "created_at"),
                        max_rows=max_rows)
    turns = h.filter(F.col("role") == "user").select(
        "conversation_id", "message_id", F.col("ordinal").alias("_n"))
    lo = F.lit(1) if max_turns is None else F.greatest(F.lit(1), F.col("_n") - (max_turns - 1))
    spans = turns.select("conversation_id", "message_id", lo.cast("long").alias("_lo"),
                         F.explode(F.sequence(lo.cast("long"), F.col("_n"))).alias("ordinal"))
    ctx = h.select("conversation_id", "ordinal", "role", "content")
    return (spans.join(ctx, ["conversation_id", "ordinal"])
                 .select("conversation_id", "message_id", (F.col("ordinal") - F.col("_lo")).alias("pos"),
                         "role", "content"))


def prompt_ranges(m: DataFrame, max_turns: int | None = None, max_rows: int | None = None) -> DataFrame:
    """A1 (stored form): for every user turn the first and last ordinal of its context.

    One row a turn, whatever the conversation's length; expand a turn by reading the
    ordinals of ``windows.message_history`` in that range.
    """
    h = message_history(m.select("conversation_id", "message_id", "role", "created_at"), max_rows=max_rows)
    first = F.lit(1) if max_turns is None else F.greatest(F.lit(1), F.col("ordinal") - (max_turns - 1))
    return h.filter(F.col("role") == "user").select(
        "conversation_id", "message_id", first.cast("long").alias("first_ordinal"), F.col("ordinal").alias("last_ordinal"))


def prompt_context(m: DataFrame, max_turns: int | None = None, max_rows: int | None = None) -> DataFrame:
    """A1: per user turn, the ordered ``array<struct<role, content>>`` sent to the model."""
    rows = prompt_context_rows(m, max_turns, max_rows)
    packed = rows.groupBy("conversation_id", "message_id").agg(
        F.array_sort(F.collect_list(F.struct("pos", "role", "content"))).alias("_ctx"))
    return packed.select("conversation_id", "message_id",
                         F.transform("_ctx", lambda x: F.struct(x["role"].alias("role"),
                                                                 x["content"].alias("content"))).alias("context"))


def prompt_chunks(m: DataFrame, chunk: int = 64, max_rows: int | None = None) -> tuple[DataFrame, DataFrame]:
    """A1 (packed, stored form): (chunks, turns) whose size is linear in the messages.

    The contexts of a conversation's turns are prefixes of one list, so each message is stored once: ``chunks`` has
    conversation_id, chunk (from 0) and ``messages``, at most ``chunk`` of them in order; ``turns`` has, for every user
    turn, the number of whole chunks that its context begins with and the messages that it
    takes from the next one (``tail``). ``expand_prompt_chunks`` gives the contexts' rows, ``read_prompt`` packed ones.
    No group holds more than ``chunk`` messages, whatever the conversation's length.
    """
    h = message_history(m.select("conversation_id", "message_id", "role", "content", "created_at"), max_rows=max_rows)
    number = F.floor((F.col("ordinal") - 1) / chunk).cast("long")
    packed = h.groupBy("conversation_id", number.alias("chunk")).agg(
        F.array_sort(F.collect_list(F.struct("ordinal", "role", "content"))).alias("_m"))
    chunks = packed.select("conversation_id", "chunk", F.transform(
        "_m", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("messages"))
    turns = h.filter(F.col("role") == "user").select(
        "conversation_id", "message_id", F.floor(F.col("ordinal") / chunk).cast("long").alias("whole_chunks"),
        (F.col("ordinal") % chunk).cast("long").alias("tail"))
    return chunks, turns


def _chunk_parts(chunks: DataFrame, turns: DataFrame) -> DataFrame:
    """One row for each chunk of each turn's context, with the messages that the turn takes from it."""
    need = turns.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("whole_chunks"))))
    need = need.filter((F.col("chunk") < F.col("whole_chunks")) | (F.col("tail") > 0))
    part = F.when(F.col("chunk") < F.col("whole_chunks"), F.col("messages")).otherwise(
        F.slice("messages", F.lit(1), F.col("tail").cast("int")))
    return need.join(chunks, ["conversation_id", "chunk"]).select("conversation_id", "message_id", "chunk", part.alias("part"))


def expand_prompt_chunks(chunks: DataFrame, turns: DataFrame) -> DataFrame:
    """A1: the rows of ``prompt_context_rows`` for the given ``turns`` (all, or some of them) from stored chunks."""
    size = chunks.agg(F.max(F.size("messages"))).first()[0] or 1
    parts = _chunk_parts(chunks, turns).select("conversation_id", "message_id", "chunk", F.posexplode("part").alias("_at", "_m"))
    return parts.select("conversation_id", "message_id", (F.col("chunk") * size + F.col("_at")).alias("pos"), "_m.role", "_m.content")


def read_prompt(chunks: DataFrame, turns: DataFrame) -> DataFrame:
    """A1: per given turn the ordered ``array<struct<role, content>>`` sent to the model."""
    parts = _chunk_parts(chunks, turns).groupBy("conversation_id", "message_id").agg(
        F.array_sort(F.collect_list(F.struct("chunk", "part"))).alias("_parts"))
    return parts.select("conversation_id", "message_id", F.flatten(F.transform("_parts", lambda x: x["part"])).alias("context"))


def first_titles(m: DataFrame) -> DataFrame:
    """Title candidate per conversation: F1 of the first user message that would set it."""
    usable = (F.col("role") == "user") & (F.col("content") != K.DEFAULT_TITLE) & (F.col("content") != "")
    return (m.filter(usable).groupBy("conversation_id")
             .agg(F.min_by("content", F.struct("created_at", "message_id")).alias("_first"))
             .select("conversation_id", title_of(F.col("_first")).alias("_candidate")))


def title_open(title) -> F.Column:
    t = F.col(title) if isinstance(title, str) else title
    return t.isNull() | (t == "") | (t == K.DEFAULT_TITLE)


def derive_titles(c: DataFrame, m: DataFrame) -> DataFrame:
    """A2: stored title unless open (null, empty, 'New Conversation'); else the
    cut first user message that is not 'New Conversation' or empty; else stored."""
    out = c.join(first_titles(m), "conversation_id", "left")
    new = F.when(title_open("title") & F.col("_candidate").isNotNull(), F.col("_candidate")).otherwise(F.col("title"))
    return out.withColumn("title", new).drop("_candidate")


def last_activity(m: DataFrame) -> DataFrame:
    """A3: time of the latest completed exchange (assistant message) per conversation."""
    return (m.filter(F.col("role") == "assistant").groupBy("conversation_id")
             .agg(F.max("created_at").alias("last_message_at")))


def last_preview(m: DataFrame) -> DataFrame:
    """A4: text, role and time of the latest message per conversation."""
    last = F.max_by(F.struct("content", "role", "created_at"), F.struct("created_at", "message_id"))
    return (m.groupBy("conversation_id").agg(last.alias("_l"))
             .select("conversation_id", F.col("_l.content").alias("last_message"),
                     F.col("_l.role").alias("last_role"), F.col("_l.created_at").alias("last_message_at")))


def conversation_summary(m: DataFrame) -> DataFrame:
    """A2 + A3 + A4 in one aggregation over the messages (one scan, one shuffle).

    Columns: conversation_id, title_candidate (cut first usable user message),
    last_message_at (latest reply), last_message, last_role (latest message).
    """
    usable = (F.col("role") == "user") & (F.col("content") != K.DEFAULT_TITLE) & (F.col("content") != "")
    order = F.struct("created_at", "message_id")
    agg = m.groupBy("conversation_id").agg(
        F.min_by(F.col("content"), F.when(usable, order)).alias("_first"),
        F.max(F.when(F.col("role") == "assistant", F.col("created_at"))).alias("last_message_at"),
        F.max_by(F.struct("content", "role"), order).alias("_last"))
    return agg.select("conversation_id", title_of(F.col("_first")).alias("title_candidate"), "last_message_at",
                      F.col("_last.content").alias("last_message"), F.col("_last.role").alias("last_role"))


def outcome_rates(responses: DataFrame) -> DataFrame:
    """A5: replies per sent model and provider by outcome, plus the share of 'ok'."""
    r = responses.select(effective_model(F.col("ai_model")).alias("model"), outcome_of(F.col("content")).alias("_o"))
    r = r.withColumn("provider", provider_of(F.col("model")))
    aggs = [F.count(F.lit(1)).alias("replies")]
    aggs += [F.count_if(F.col("_o") == o).alias(o) for o in _OUTCOMES]
    return (r.groupBy("model", "provider").agg(*aggs)
             .withColumn("ok_rate", F.round(F.col("ok") / F.col("replies"), 6)))


def usage_daily(m: DataFrame) -> DataFrame:
    """Messages, distinct conversations and tokens per user, model and day."""
    return (m.groupBy("user_id", "ai_model", F.to_date("created_at").alias("day"))
             .agg(F.count(F.lit(1)).alias("messages"),
                  F.count_distinct("conversation_id").alias("conversations"),
                  F.sum("token_count").cast("long").alias("tokens")))


def usage_bill(usage: DataFrame, users: DataFrame, prices: DataFrame) -> DataFrame:
    """Per user, tokens times the caller's price per million tokens for (model, tier).

    ``prices`` (model, tier, usd_per_1m) is the caller's price list; Spark
    broadcasts it when its size allows. Unpriced tokens are counted but
    not billed. Sums are exact decimals; the amount is ``decimal(18,6)``.
    """
    tiers = users.select(F.col("id").alias("user_id"), F.col("subscription_tier").alias("tier"))
    priced = prices.select(F.col("model").alias("ai_model"), "tier", F.col("usd_per_1m").cast("decimal(18,6)").alias("_p"))
    u = usage.join(tiers, "user_id", "left").join(priced, ["ai_model", "tier"], "left")
    micro = F.col("tokens").cast("decimal(18,0)") * F.col("_p")
    per_token = F.lit(0.000001).cast("decimal(18,6)")
    return (u.groupBy("user_id", "tier")
             .agg(F.sum("tokens").cast("long").alias("tokens"),
                  F.sum(F.when(F.col("_p").isNotNull(), F.col("tokens")).otherwise(0)).cast("long").alias("billed_tokens"),
                  F.coalesce(F.sum(micro), F.lit(0).cast("decimal(18,0)")).alias("_micro"))
             .withColumn("amount_usd", (F.col("_micro") * per_token).cast("decimal(18,6)"))
             .drop("_micro"))


def active_users(m: DataFrame, approx: bool = False) -> DataFrame:
    """Distinct users with a message per day (exact or HyperLogLog++)."""
    agg = F.approx_count_distinct("user_id") if approx else F.count_distinct("user_id")
    return m.groupBy(F.to_date("created_at").alias("day")).agg(agg.alias("active_users"))


def user_breakdown(u: DataFrame) -> DataFrame:
    """Users over provider x tier with every subtotal (CUBE) and grouping flags."""
    return (u.cube("provider", "subscription_tier")
             .agg(F.count(F.lit(1)).alias("users"),
                  F.grouping("provider").cast("int").alias("g_provider"),
                  F.grouping("subscription_tier").cast("int").alias("g_tier")))


def latency_stats(r: DataFrame, limit_ms: float = K.LATENCY_TARGET_MS, by: Sequence[str] = ("kind",),
                  approx: bool = False, max_rows: int | None = None) -> DataFrame:
    """A10: count, mean, p50/p95/p99 and share under ``limit_ms`` of response times.

    Exact percentiles are computed by distributed ranking (no single task holds
    a group's values); ``approx=True`` uses the bounded-memory
    ``percentile_approx`` sketch instead.
    """
    by = list(by)
    ms = F.col("response_ms")
    ps = {"p50_ms": 0.5, "p95_ms": 0.95, "p99_ms": 0.99}
    if approx:
        counts = {"requests": F.count(ms),
                  "mean_ms": F.round(F.avg(ms), 6),
                  "share_under_limit": F.round(F.try_divide(F.count_if(ms < F.lit(limit_ms)), F.count(ms)), 6)}
        out = r.groupBy(*by).agg(*[c.alias(n) for n, c in counts.items()],
                                 *[F.percentile_approx(ms, p, 10000).alias(n) for n, p in ps.items()])
    else:
        # the same statistics over the value histogram (_v value, _c rows)
        v, c = F.col("_v"), F.col("_c")
        seen = F.sum(F.when(v.isNotNull(), c).otherwise(0))
        counts = {"requests": seen,
                  "mean_ms": F.round(F.try_divide(F.sum(v * c), seen), 6),
                  "share_under_limit": F.round(F.try_divide(F.sum(F.when(v < F.lit(limit_ms), c).otherwise(0)), seen), 6)}
        out = exact_percentiles(r, by, "response_ms", ps, max_rows=max_rows, extra=counts)
    return out.select(*by, *counts, *[F.round(F.col(n), 6).alias(n) for n in ps])


#: Sketch sizes: HyperLogLog with 2**14 registers (relative standard error 0.8 %), KLL with k = 800 (rank error below 0.5 %).
HLL_LOG_SIZE, KLL_SIZE = 14, 800


def user_sketches(m: DataFrame) -> DataFrame:
    """A8 (stored form): day and a mergeable sketch of its distinct users, one small row a day."""
    return m.groupBy(F.to_date("created_at").alias("day")).agg(F.hll_sketch_agg("user_id", HLL_LOG_SIZE).alias("users"))


def active_users_rollup(sketches: DataFrame, period: str = "month") -> DataFrame:
    """Distinct users of whole periods from the days' sketches; the messages are not read again."""
    return (sketches.groupBy(F.trunc("day", period).alias("period"))
            .agg(F.count(F.lit(1)).alias("days"), F.hll_sketch_estimate(F.hll_union_agg("users")).alias("active_users")))


def latency_sketches(r: DataFrame, limit_ms: float = K.LATENCY_TARGET_MS, by: Sequence[str] = ("kind",)) -> DataFrame:
    """A10 (stored form): per day and group the count, sum, requests under the limit and a mergeable quantile sketch."""
    ms = F.col("response_ms").cast("double")
    return r.groupBy(F.to_date("ts").alias("day"), *by).agg(
        F.count(ms).alias("requests"), F.sum(ms).alias("total_ms"), F.count_if(ms < F.lit(limit_ms)).alias("under"),
        F.kll_sketch_agg_double(ms, KLL_SIZE).alias("sketch"))


def latency_rollup(sketches: DataFrame, by: Sequence[str] = ("kind",)) -> DataFrame:
    """A10 over any days from their sketches: exact count, mean and share, percentiles within the sketch's rank error."""
    merged = sketches.groupBy(*by).agg(F.sum("requests").alias("requests"), F.sum("total_ms").alias("_total"),
                                       F.sum("under").alias("_under"), F.kll_merge_agg_double("sketch").alias("_sketch"))
    ps = {"p50_ms": 0.5, "p95_ms": 0.95, "p99_ms": 0.99}
    some = F.col("requests") > 0
    return merged.select(*by, "requests", F.round(F.try_divide("_total", "requests"), 6).alias("mean_ms"),
                         F.round(F.try_divide("_under", "requests"), 6).alias("share_under_limit"),
                         *[F.when(some, F.kll_sketch_get_quantile_double("_sketch", F.lit(p))).alias(n) for n, p in ps.items()])


def active_users_rollup_check(m: DataFrame, period: str = "month", bound: float = 0.03) -> DataFrame:
    """The roll-up beside the exact number: ``close`` where they differ by at most ``bound`` (over three standard errors)."""
    exact = m.groupBy(F.trunc(F.to_date("created_at"), period).alias("_period")).agg(F.count_distinct("user_id").alias("exact"))
    rolled = active_users_rollup(user_sketches(m), period).join(exact, F.col("period").eqNullSafe(F.col("_period")))
    return rolled.select("period", "days", "exact", (F.abs(F.col("active_users") - F.col("exact")) <= F.ceil(F.col("exact") * bound)).alias("close"))


def latency_rollup_check(r: DataFrame, by: Sequence[str] = ("kind",), bound: float = 0.01) -> DataFrame:
    """The roll-up's counts, and for each percentile whether its exact rank is within ``bound`` of the one asked for."""
    ps = {"p50_ms": 0.5, "p95_ms": 0.95, "p99_ms": 0.99}
    rolled = latency_rollup(latency_sketches(r, by=by), by)
    estimates = rolled.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(by)], *ps)
    same = [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(by)]
    ms = F.col("response_ms").cast("double")
    ranks = r.filter(ms.isNotNull()).join(estimates, same).groupBy(*by).agg(*[
        ((F.count_if(ms < F.col(n)) <= (p + bound) * F.count(ms)) & (F.count_if(ms <= F.col(n)) >= (p - bound) * F.count(ms))).alias(n.replace("_ms", "_close"))
        for n, p in ps.items()])
    kept = [F.col(f"r.{c}").eqNullSafe(F.col(f"x.{c}")) for c in by]
    return rolled.alias("r").join(ranks.alias("x"), kept, "left").select(
        *[F.col(f"r.{c}") for c in by], "r.requests", "r.mean_ms", "r.share_under_limit", *[f"x.{n.replace('_ms', '_close')}" for n in ps])
