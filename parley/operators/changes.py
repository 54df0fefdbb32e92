"""Changes to tables (M1-M7): current snapshot + change set -> next snapshot.

Plain Parquet has no in-place update, so each operator returns the next
snapshot as a DataFrame (write it with ``sources.tables.snapshot``). "First per
email" and "last per field" use ``min_by``/``max_by`` (map-side partial
aggregation), never a window over a possibly hot key. ``updated_at`` is set to
``as_of`` on every row an operation touched, even when no value changed, as the
store's update trigger does (M7).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley import catalog as K
from parley.operators.aggregates import title_open
from parley.functions.scalars import title_of
from parley.operators.validation import apply_defaults, check, email_rule, enum_rule, length_rule
from parley.schemas import CONVERSATIONS, USERS

PATCHABLE = ["name", "email", "default_model", "preferences", "provider", "provider_id"]


def _ts(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v).cast("timestamp_ntz")


def register_users(u: DataFrame, reg: DataFrame, id_col: str = "reg_id", everyone: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """M1: validate, keep the first registration per email in the batch, refuse
    emails already present (exact match), add the rest with store defaults.

    Returns (next users snapshot, rejected registrations with ``reasons``).
    The new user's id is the registration's ``id_col``. ``everyone``: all users, where ``u`` is a part of
    them (``sources.buckets``).
    """
    checked = check(reg, "registration")
    first = (checked.filter(F.size("reasons") == 0).groupBy("email")
                    .agg(F.min_by(F.col(id_col), F.struct("ts", id_col)).alias("_first")))
    known = (u if everyone is None else everyone).select("email").distinct().withColumn("_known", F.lit(True))
    judged = checked.join(first, "email", "left").join(known, "email", "left").withColumn(
        "reasons", F.when(F.size("reasons") > 0, F.col("reasons"))
        .when(F.col(id_col) != F.col("_first"), F.array(F.lit("email repeated in batch")))
        .when(F.col("_known"), F.array(F.lit("email already registered"))).otherwise(F.col("reasons")))
    fresh = judged.filter(F.size("reasons") == 0)
    new_users = fresh.select(
        F.col(id_col).cast("long").alias("id"), "email", "name",
        F.lit(K.DEFAULT_PROVIDER).alias("provider"), F.lit(None).cast("string").alias("provider_id"),
        F.lit(None).cast("string").alias("subscription_tier"),
        F.lit(None).cast("timestamp_ntz").alias("subscription_expires_at"),
        F.lit(None).cast("string").alias("default_model"), F.lit(None).cast("string").alias("preferences"),
        F.lit(None).cast("boolean").alias("is_active"),
        F.col("ts").alias("created_at"), F.col("ts").alias("updated_at"))
    new_users = apply_defaults(new_users, "users")
    users = u.unionByName(new_users.select(*[f.name for f in USERS.fields]), allowMissingColumns=True)
    rejected = judged.filter(F.size("reasons") > 0).select(id_col, "email", "reasons")
    return users, rejected


def patch_users(u: DataFrame, patches: DataFrame, as_of, everyone: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """M2: partial profile updates.

    ``patches`` has patch_id, user_id, ts, ``fields`` (names being set) and one
    column per field. Listed fields are written (an explicit null included),
    absent ones kept, ``preferences`` replaced whole. Refused: fields outside
    the patchable set (password, tier, active flag...), unknown users, values
    that break the user rules (email form, name and email never null, provider one
    of the known ones), an email held by another user, and an email that an
    earlier acceptable patch of the batch claims for another user (ours: first
    by time, then patch_id). The accepted patches of a user take effect one after the
    other, by time, then patch_id: each field ends with the value of the last patch that lists it.
    All fields merge in one map-side combined aggregation, so a user with very many patches is not one task's list.
    ``everyone``: all users, where ``u`` is the part of them that the patches touch (``sources.buckets``).
    Returns (next users snapshot, rejected patches with ``reasons``).
    """
    owners = (u if everyone is None else everyone).select(F.col("id").alias("_owner"), F.col("email").alias("_email"))
    known = u.select(F.col("id").alias("user_id"), F.lit(True).alias("_known"))
    p = patches.join(known, "user_id", "left")
    p = p.join(owners, p["email"] == owners["_email"], "left")
    allowed = F.array(*[F.lit(f) for f in PATCHABLE])
    forbidden = F.exists("fields", lambda f: ~F.array_contains(allowed, f))
    taken = (F.array_contains("fields", "email") & F.col("_owner").isNotNull()
             & (F.col("_owner") != F.col("user_id")))
    reasons = [F.when(forbidden, F.lit("field not patchable")), F.when(F.col("_known").isNull(), F.lit("user not found"))]
    # the rules of the user record, each for patches that list its field
    for field, rule in (("email", email_rule()), ("name", length_rule("name", None, None)),
                        ("provider", enum_rule("provider", K.AUTH_PROVIDERS, optional=True))):
        if field in patches.columns:
            reasons += [F.when(F.array_contains("fields", field) & F.coalesce(bad, F.lit(False)), F.lit(reason))
                        for reason, bad in rule]
    reasons.append(F.when(taken, F.lit("email taken")))
    p = p.withColumn("reasons", F.array_compact(F.array(*reasons))).drop("_known", "_owner", "_email")
    # of the patches that are otherwise fine, the first one claims its email for its user
    claims = (p.filter((F.size("reasons") == 0) & F.array_contains("fields", "email")).groupBy(F.col("email").alias("_email"))
               .agg(F.min_by("user_id", F.struct("ts", "patch_id")).alias("_claimer")))
    p = p.join(claims, p["email"] == claims["_email"], "left")
    repeated = F.array_contains("fields", "email") & (F.size("reasons") == 0) & (F.col("_claimer") != F.col("user_id"))
    p = p.withColumn("reasons", F.when(repeated, F.array(F.lit("email repeated in batch"))).otherwise(F.col("reasons"))
                     ).drop("_email", "_claimer")
    accepted = p.filter(F.size("reasons") == 0)
    rejected = p.filter(F.size("reasons") > 0).select("patch_id", "user_id", "reasons")

    # last writer wins per field: the value of the newest accepted patch that lists it, an explicit null included
    carried = [c for c in PATCHABLE if c in patches.columns]
    newest = [F.max_by(F.struct(F.col(c).alias("v")), F.when(F.array_contains("fields", c), F.struct("ts", "patch_id"))).alias(f"_new_{c}")
              for c in carried]
    merged = accepted.groupBy(F.col("user_id").alias("_uid")).agg(F.count(F.lit(1)).alias("_patches"), *newest)
    out = u.join(merged, u["id"] == merged["_uid"], "left")
    cols = []
    for f in USERS.fields:
        c = F.col(f.name)
        if f.name in carried:
            new = F.col(f"_new_{f.name}")
            c = F.when(new.isNotNull(), new["v"]).otherwise(c)
        elif f.name == "updated_at":
            c = F.when(F.col("_uid").isNotNull(), _ts(as_of)).otherwise(c)
        cols.append(c.cast(f.dataType).alias(f.name))
    return out.select(*cols), rejected


def delete_users(u: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """M3: hard delete by id. Returns (remaining users, unknown ids)."""
    keys = ids.select("id")
    unknown = keys.distinct().join(u.select("id"), "id", "left_anti")
    return u.join(keys, "id", "left_anti"), unknown


def _conv_shape(df: DataFrame) -> DataFrame:
    cols = []
    for f in CONVERSATIONS.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        elif f.name == "updated_at":
            cols.append(F.col("created_at").alias("updated_at"))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def create_conversations(c: DataFrame, reqs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """M4: add conversations (owner from the caller, store defaults).

    ``reqs`` carries conversation_id, user_id, title, ai_model?, created_at.
    Returns (next snapshot, rejected requests with ``reasons``).
    """
    checked = check(reqs, "conversation")
    ok = F.size("reasons") == 0
    new = apply_defaults(_conv_shape(checked.filter(ok).drop("reasons")), "conversations")
    return c.unionByName(_conv_shape(new)), checked.filter(~ok)


def soft_delete(c: DataFrame, reqs: DataFrame, as_of) -> tuple[DataFrame, DataFrame]:
    """M5: deactivate by (conversation_id, owner). Returns (next snapshot, unmatched requests)."""
    keys = reqs.select("conversation_id", "user_id").distinct().withColumn("_hit", F.lit(True))
    out = c.join(keys, ["conversation_id", "user_id"], "left")
    hit = F.col("_hit").isNotNull()
    out = (out.withColumn("is_active", F.when(hit, F.lit(False)).otherwise(F.col("is_active")))
              .withColumn("updated_at", F.when(hit, _ts(as_of)).otherwise(F.col("updated_at"))))
    misses = reqs.join(c.select("conversation_id", "user_id"), ["conversation_id", "user_id"], "left_anti")
    return out.select(*c.columns), misses


def conversation_updates(m: DataFrame) -> DataFrame:
    """Per conversation: first usable user message and latest reply time.

    One aggregation with conditional ``min_by``/``max`` (map-side partial); the
    same expression runs as a streaming aggregation in ``streaming.conversation_state``.
    """
    usable = (F.col("role") == "user") & (F.col("content") != K.DEFAULT_TITLE) & (F.col("content") != "")
    return m.groupBy("conversation_id").agg(
        F.min_by(F.col("content"), F.when(usable, F.struct("created_at", "message_id"))).alias("first_content"),
        F.min(F.when(usable, F.struct("created_at", "message_id"))).alias("first_at"),
        F.max(F.when(F.col("role") == "assistant", F.col("created_at"))).alias("last_reply_at"))


def apply_conversation_updates(c: DataFrame, updates: DataFrame, as_of) -> DataFrame:
    """M6 core: fold per-conversation updates into the snapshot.

    A conversation with a completed exchange (a reply) gets ``last_message_at``
    = latest reply time (never moved back), an open title replaced by the cut
    first usable user message (A2 rule), and ``updated_at`` = ``as_of``.
    """
    u = updates.select("conversation_id", F.col("first_content").alias("_first"),
                       F.col("last_reply_at").alias("_last"))
    out = c.join(u, "conversation_id", "left")
    hit = F.col("_last").isNotNull()
    new_title = F.when(hit & title_open("title") & F.col("_first").isNotNull(), title_of(F.col("_first")))
    out = (out.withColumn("title", F.coalesce(new_title, F.col("title")))
              .withColumn("last_message_at", F.when(hit, F.greatest("last_message_at", "_last"))
                          .otherwise(F.col("last_message_at")))
              .withColumn("updated_at", F.when(hit, _ts(as_of)).otherwise(F.col("updated_at"))))
    return out.select(*c.columns)


def refresh_conversations(c: DataFrame, m: DataFrame, as_of) -> DataFrame:
    """M6: apply sent messages to their conversations (A2 title, A3 activity, M7)."""
    return apply_conversation_updates(c, conversation_updates(m), as_of)
