"""Registered queries: one per operator of the inventory, over whole tables.

Each query takes (spark, sf_dir), reads the driver tables through the fixture
views and returns a DataFrame. Parameters (as-of times, cursors, limits) are
fixed here so the Spark result and its oracle SQL (``plans.oracle``) agree.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.functions import scalars as fn
from parley.operators import aggregates as A
from parley.operators import changes as M
from parley.operators import joins as J
from parley.operators import lookups as P
from parley.operators import rooms as R
from parley.operators import topk as T
from parley.operators import validation as V
from parley.operators import windows as W
from parley.schemas import MESSAGES
from parley.sources import fixtures as fx
from parley.sources import tables as S

# --- query parameters --------------------------------------------------------
AGE_AS_OF = "2024-01-03 00:00:00"
RETENTION_AS_OF, RETENTION_DAYS = "2024-01-04 00:00:00", 2
SYNC_CURSOR = "2024-01-02 12:00:00"
SEARCH = dict(text="ai", since="2024-01-02 00:00:00", until="2024-01-04 00:00:00")
ENTITLEMENT_AS_OF = "2024-01-20 00:00:00"
CHANGE_AS_OF = "2024-02-01 00:00:00"
RATE = dict(limit=2, window="1 hour")   # 100/minute never trips on the fixtures
RECENT_K = 3
PROMPT_TURNS = 4
PROMPT_CHUNK = 4
EXPORT_PART = 3
ONE_USER = 5
CURSOR_AT, CURSOR_ID = "2024-01-02 12:00:00", 20
STEP_AT = "2024-01-03 00:00:00"
ADMIT_AT = "2024-01-03 00:25:00"   # inside a window
# Price list (ours; the product names none): USD per million tokens by model,
# scaled by tier. A caller argument, not data.
BASE_USD_PER_1M = {"gpt-4": 30.0, "gpt-3.5-turbo": 1.5, "claude-3-sonnet": 15.0,
                   "claude-3-haiku": 1.25, "mistral-7b-instruct": 0.25, "mistral-medium": 2.7}
TIER_FACTOR = {"free": 1.0, "premium": 0.8, "enterprise": 0.6}


def price_rows() -> list[tuple[str, str, float]]:
    return [(m, t, round(p * f, 2)) for m, p in BASE_USD_PER_1M.items() for t, f in TIER_FACTOR.items()]


def prices(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(price_rows(), "model string, tier string, usd_per_1m double")


# --- inputs --------------------------------------------------------------------
def _users(s, d):
    return S.normalize_users(fx.users(s, d))


def _chats(s, d):
    return S.normalize_conversations(fx.chats(s, d))


def _msgs(s, d):
    return fx.messages(s, d)


def _portable(df: DataFrame) -> DataFrame:
    """Dates as ISO text and decimals as double, so both engines' results hash alike."""
    out = df
    for name, dtype in df.dtypes:
        if dtype == "date":
            out = out.withColumn(name, F.date_format(name, "yyyy-MM-dd"))
        elif dtype.startswith("decimal"):
            out = out.withColumn(name, F.col(name).cast("double"))
    return out


def _reasons_text(df: DataFrame) -> DataFrame:
    return df.withColumn("reasons", F.array_join("reasons", ";"))


def _with_registrations(r: DataFrame) -> DataFrame:
    """The request log with some calls taken as registrations, which issue a token too."""
    return r.withColumn("kind", F.when((F.col("kind") == "call") & (F.col("request_id") % 17 == 0), F.lit("register"))
                        .otherwise(F.col("kind")))


def _second_half(e: DataFrame) -> tuple[DataFrame, DataFrame]:
    """R5's step: the members present at ``STEP_AT`` meet the events from then on."""
    at = F.lit(STEP_AT).cast("timestamp_ntz")
    present = R.presence(e.filter(F.col("ts") < at))
    return R.fan_out_step(present, e.filter(F.col("ts") >= at), like=e)


# --- the flagship: one screen of the chat list -----------------------------------
def chat_list(spark: SparkSession, sf_dir: str, page: int = 1) -> DataFrame:
    """Titles (A2), activity (A3) and preview (A4) -> active list (P4) -> page."""
    summary = A.conversation_summary(_msgs(spark, sf_dir))
    c = fx.chats(spark, sf_dir).drop("last_message_at").join(summary, "conversation_id", "left")
    c = c.withColumn("title", F.when(A.title_open("title") & F.col("title_candidate").isNotNull(),
                                     F.col("title_candidate")).otherwise(F.col("title"))).drop("title_candidate")
    active = c.filter(F.col("is_active"))
    return T.paginate(active, page=page, limit=20, sort="last_message_at", order="desc",
                      key="conversation_id")


def _admission(r: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Decisions on the requests from ``ADMIT_AT`` on, after the counts that the earlier ones leave; and those counts."""
    cut = F.lit(ADMIT_AT).cast("timestamp_ntz")
    none = r.select("client_ip", F.col("ts").alias("window_start"), F.lit(0).cast("long").alias("requests")).limit(0)
    _, counts = R.admit(none, r.filter(F.col("ts") < cut), cut, **RATE)
    decided, _ = R.admit(counts, r.filter(F.col("ts") >= cut), cut, **RATE)
    return decided.select("request_id", "client_ip", "ts", "window_start", "position", "accepted"), counts


def _q(**kw) -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return kw


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = _q(
    # flagship
    chat_list=chat_list,
    # 2.1 sources and sinks
    load_users=lambda s, d: _users(s, d),
    load_conversations=lambda s, d: _chats(s, d),
    load_messages=lambda s, d: S.normalize_messages(_msgs(s, d)),
    export_conversations=lambda s, d: S.export_conversations(fx.chats(s, d), _msgs(s, d)),
    export_conversations_parts=lambda s, d: S.export_conversations(fx.chats(s, d), _msgs(s, d), part_size=EXPORT_PART),
    export_pieces=lambda s, d: S.export_pieces(fx.chats(s, d), _msgs(s, d)),
    # 2.2 projections, filters, lookups
    public_profile=lambda s, d: P.public_profile(fx.users(s, d)),
    lookup_users=lambda s, d: P.lookup_users(fx.users(s, d), fx.requests(s, d).select(F.col("user_id").alias("id")), on="id"),
    lookup_users_by_email=lambda s, d: P.lookup_users(fx.users(s, d), fx.registrations(s, d), on="email"),
    owned_conversations=lambda s, d: P.owned_conversations(
        fx.chats(s, d), fx.room_events(s, d).select("conversation_id", (F.col("client_id") % 37).alias("user_id"))),
    active_conversations=lambda s, d: P.active_conversations(fx.chats(s, d)),
    active_conversations_of_user=lambda s, d: P.active_conversations(fx.chats(s, d), user_id=ONE_USER),
    conversation_list=lambda s, d: P.conversation_list(fx.chats(s, d)),
    history_view=lambda s, d: P.history_view(_msgs(s, d)),
    search_messages=lambda s, d: P.search_messages(_msgs(s, d), **SEARCH),
    retention_keep=lambda s, d: P.retention(_msgs(s, d), RETENTION_DAYS, RETENTION_AS_OF)[0],
    retention_drop=lambda s, d: P.retention(_msgs(s, d), RETENTION_DAYS, RETENTION_AS_OF)[1],
    changes_since=lambda s, d: P.changes_since(_msgs(s, d), "conversation_id", SYNC_CURSOR,
                                               ts="created_at", tiebreak=["message_id"]),
    # 2.3 validation and defaults
    validate_registrations=lambda s, d: _reasons_text(V.check(fx.registrations(s, d), "registration"))
        .select("reg_id", "email", (F.col("reasons") == "").alias("is_valid"), "reasons"),
    validate_logins=lambda s, d: _reasons_text(V.check(fx.registrations(s, d), "login")).select("reg_id", "reasons"),
    validate_messages=lambda s, d: _reasons_text(V.check(_msgs(s, d), "message"))
        .select("message_id", "reasons"),
    apply_defaults=lambda s, d: V.apply_defaults(fx.chats(s, d), "conversations"),
    clean_input=lambda s, d: V.clean_input(_msgs(s, d).select("message_id", "content")),
    conform=lambda s, d: V.conform(_msgs(s, d).select(
        *[F.col(c).cast("string").alias(c) for c in ("token_count", "message_id", "created_at", "content", "role")],
        F.when(F.col("user_id") % 5 == 0, F.lit("none")).otherwise(F.col("user_id").cast("string")).alias("user_id")), MESSAGES),
    # 2.9 scalar functions
    title_of=lambda s, d: _msgs(s, d).filter(F.col("role") == "user").select(
        "message_id", fn.title_of("content").alias("title")),
    effective_model=lambda s, d: fx.chats(s, d).select(
        "conversation_id", "ai_model", fn.effective_model("ai_model").alias("effective_model")),
    provider_of=lambda s, d: fx.chats(s, d).select(
        "conversation_id", "ai_model", fn.provider_of("ai_model").alias("provider")),
    outcome_of=lambda s, d: fx.responses(s, d).select("message_id", fn.outcome_of("content").alias("outcome")),
    relative_age=lambda s, d: _msgs(s, d).select("message_id", fn.relative_age("created_at", AGE_AS_OF).alias("age")),
    initial_of=lambda s, d: fx.chats(s, d).select("conversation_id", fn.initial_of("ai_model").alias("initial")),
    preference=lambda s, d: fx.users(s, d).select(
        "id", fn.preference("preferences", "theme", "string").alias("theme"),
        fn.preference("preferences", "notifications", "boolean").alias("notifications")),
    # 2.4 joins
    visible_messages=lambda s, d: J.visible_messages(_msgs(s, d), fx.chats(s, d)),
    visible_messages_of_user=lambda s, d: J.visible_messages(_msgs(s, d), fx.chats(s, d), user_id=ONE_USER),
    orphan_messages=lambda s, d: J.orphan_messages(_msgs(s, d), fx.chats(s, d)),
    orphan_sends=lambda s, d: J.orphan_messages(
        fx.room_events(s, d).filter(F.col("kind") == "message").select(
            F.col("event_id").alias("message_id"), "conversation_id",
            F.col("client_id").alias("user_id"), F.col("ts").alias("created_at")),
        fx.chats(s, d)),
    with_conversation_model=lambda s, d: J.with_conversation_model(_msgs(s, d), fx.chats(s, d)),
    new_registrations=lambda s, d: J.new_registrations(fx.registrations(s, d), fx.users(s, d)),
    known_logins=lambda s, d: J.login_attempts(fx.registrations(s, d).select("reg_id", "email", "ts"), fx.users(s, d))[0],
    unknown_logins=lambda s, d: J.login_attempts(fx.registrations(s, d).select("reg_id", "email", "ts"), fx.users(s, d))[1],
    known_requests=lambda s, d: J.known_requests(fx.requests(s, d), fx.users(s, d))[0],
    unknown_requests=lambda s, d: J.known_requests(fx.requests(s, d), fx.users(s, d))[1],
    valid_token_requests=lambda s, d: J.valid_token_requests(fx.requests(s, d))[0],
    expired_token_requests=lambda s, d: J.valid_token_requests(fx.requests(s, d))[1],
    valid_token_requests_registered=lambda s, d: J.valid_token_requests(
        _with_registrations(fx.requests(s, d)), issuing=("login", "register"))[0],
    fan_out=lambda s, d: R.fan_out(fx.room_events(s, d)),
    typing_fan_out=lambda s, d: R.typing_fan_out(fx.room_events(s, d)),
    entitlement_violations=lambda s, d: J.entitlement_violations(
        fx.chats(s, d), fx.users(s, d), J.catalogue(s), ENTITLEMENT_AS_OF),
    with_catalogue=lambda s, d: J.with_catalogue(fx.chats(s, d), J.catalogue(s)),
    # 2.5 aggregation and sequence building
    prompt_context=lambda s, d: A.prompt_context_rows(_msgs(s, d)),
    prompt_context_window=lambda s, d: A.prompt_context_rows(_msgs(s, d), max_turns=PROMPT_TURNS),
    prompt_chunks=lambda s, d: A.prompt_chunks(_msgs(s, d), PROMPT_CHUNK)[0].select(
        "conversation_id", "chunk", F.size("messages").cast("long").alias("n_messages"),
        F.to_json("messages", {"ignoreNullFields": "false"}).alias("messages")),
    prompt_chunk_turns=lambda s, d: A.prompt_chunks(_msgs(s, d), PROMPT_CHUNK)[1],
    prompt_context_expanded=lambda s, d: A.expand_prompt_chunks(*A.prompt_chunks(_msgs(s, d), PROMPT_CHUNK)),
    prompt_ranges=lambda s, d: A.prompt_ranges(_msgs(s, d), max_turns=PROMPT_TURNS),
    derive_titles=lambda s, d: A.derive_titles(fx.chats(s, d), _msgs(s, d)),
    last_activity=lambda s, d: A.last_activity(_msgs(s, d)),
    last_preview=lambda s, d: A.last_preview(_msgs(s, d)),
    outcome_rates=lambda s, d: A.outcome_rates(fx.responses(s, d)),
    usage_daily=lambda s, d: _portable(A.usage_daily(_msgs(s, d))),
    usage_bill=lambda s, d: _portable(A.usage_bill(A.usage_daily(_msgs(s, d)), fx.users(s, d), prices(s))),
    active_users=lambda s, d: _portable(A.active_users(_msgs(s, d))),
    active_users_approx=lambda s, d: _portable(A.active_users(_msgs(s, d), approx=True)),
    user_breakdown=lambda s, d: A.user_breakdown(fx.users(s, d)),
    latency_stats=lambda s, d: A.latency_stats(fx.requests(s, d)),
    latency_stats_approx=lambda s, d: A.latency_stats(fx.requests(s, d), approx=True),
    active_users_rollup_check=lambda s, d: _portable(A.active_users_rollup_check(_msgs(s, d))),
    latency_rollup_check=lambda s, d: A.latency_rollup_check(fx.requests(s, d)),
    # 2.6 windows
    message_history=lambda s, d: W.message_history(_msgs(s, d)),
    exchanges=lambda s, d: W.exchanges(_msgs(s, d)),
    response_delay=lambda s, d: W.response_delay(_msgs(s, d)),
    response_delay_by_model=lambda s, d: W.response_delay_by_model(_msgs(s, d)),
    # 2.7 sort, page, top-k
    paginate=lambda s, d: T.paginate(fx.chats(s, d).filter("is_active"), page=1, limit=20),
    paginate_page2=lambda s, d: T.paginate(fx.chats(s, d).filter("is_active"), page=2, limit=20),
    paginate_cursor=lambda s, d: T.paginate(fx.chats(s, d).filter("is_active"), limit=20, sort="last_message_at",
                                            after=(F.lit(CURSOR_AT).cast("timestamp_ntz"), CURSOR_ID)),
    recent_conversations=lambda s, d: T.recent_conversations(fx.chats(s, d), RECENT_K),
    # 2.10 changes to tables
    register_users=lambda s, d: M.register_users(_users(s, d), fx.registrations(s, d))[0],
    register_users_rejected=lambda s, d: _reasons_text(M.register_users(_users(s, d), fx.registrations(s, d))[1]),
    patch_users=lambda s, d: M.patch_users(_users(s, d), fx.profile_patches(s, d), CHANGE_AS_OF)[0],
    patch_users_rejected=lambda s, d: _reasons_text(
        M.patch_users(_users(s, d), fx.profile_patches(s, d), CHANGE_AS_OF)[1]),
    delete_users=lambda s, d: M.delete_users(_users(s, d), fx.user_deletions(s, d))[0],
    delete_users_unknown=lambda s, d: M.delete_users(_users(s, d), fx.user_deletions(s, d))[1],
    create_conversations=lambda s, d: M.create_conversations(_chats(s, d), fx.conversation_requests(s, d))[0],
    create_conversations_rejected=lambda s, d: _reasons_text(
        M.create_conversations(_chats(s, d), fx.conversation_requests(s, d))[1].select("conversation_id", "user_id", "reasons")),
    soft_delete=lambda s, d: M.soft_delete(_chats(s, d), fx.delete_requests(s, d), CHANGE_AS_OF)[0],
    soft_delete_misses=lambda s, d: M.soft_delete(_chats(s, d), fx.delete_requests(s, d), CHANGE_AS_OF)[1],
    refresh_conversations=lambda s, d: M.refresh_conversations(_chats(s, d), _msgs(s, d), CHANGE_AS_OF),
    conversation_updates=lambda s, d: M.conversation_updates(_msgs(s, d)).select(
        "conversation_id", "first_content", F.col("first_at.message_id").alias("first_message_id"), "last_reply_at"),
    # 2.11 streaming operators, batch twins
    room_members=lambda s, d: R.room_members(fx.room_events(s, d)),
    room_member_counts=lambda s, d: R.room_member_counts(fx.room_events(s, d)),
    typing_now=lambda s, d: R.typing_now(fx.room_events(s, d)),
    fan_out_step=lambda s, d: _second_half(fx.room_events(s, d))[0],
    fan_out_step_members=lambda s, d: _second_half(fx.room_events(s, d))[1].select("conversation_id", "client_id", "since"),
    rate_limit=lambda s, d: R.rate_limit(fx.requests(s, d), **RATE),
    admission_step=lambda s, d: _admission(fx.requests(s, d))[0],
    admission_step_counts=lambda s, d: _admission(fx.requests(s, d))[1],
    rate_limited_requests=lambda s, d: R.rate_limited_requests(fx.requests(s, d), **RATE),
)
