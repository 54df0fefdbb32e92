"""Projections, filters and lookups.

Lookups take their keys as a DataFrame (or a Python list, which is turned into
a bounded DataFrame) and run as semi joins, so one call answers any number of
keys. Caller DataFrames are not broadcast blindly: Spark/AQE choose broadcast
from runtime statistics, and AQE's skew-join splits a hot key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PUBLIC_PROFILE = ["id", "email", "name", "subscription_tier", "default_model", "preferences", "created_at"]


def _keys(df: DataFrame, keys, columns: Sequence[str]) -> DataFrame:
    """Keys as a DataFrame (Spark broadcasts it when its size allows)."""
    if isinstance(keys, DataFrame):
        return keys.select(*columns)
    rows = [k if isinstance(k, (tuple, list)) else (k,) for k in keys]
    schema = df.select(*columns).schema
    return df.sparkSession.createDataFrame(rows, schema)


#: Listed keys up to which Parquet compares each with a row group's Bloom filter (Spark's default threshold).
FEW_KEYS = 10


def _few(df: DataFrame, keys, on: str, at: int | None = None) -> DataFrame:
    """``df`` less row groups that cannot hold the keys, where these are a short list: a filter that reaches the scan."""
    if isinstance(keys, DataFrame) or len(keys) > FEW_KEYS:
        return df
    values = {(k[at] if at is not None else k[0] if isinstance(k, (tuple, list)) else k) for k in keys}
    return df.filter(F.col(on).isin([v for v in values if v is not None]))


def public_profile(u: DataFrame) -> DataFrame:
    """The documented public profile, never the password hash."""
    return u.select(*PUBLIC_PROFILE)


def lookup_users(u: DataFrame, keys, on: str = "id") -> DataFrame:
    """Users by id or by exact, case-sensitive email."""
    if on not in ("id", "email"):
        raise ValueError("on must be 'id' or 'email'")
    return _few(u, keys, on).join(_keys(u, keys, [on]), on, "left_semi")


def owned_conversations(c: DataFrame, keys) -> DataFrame:
    """Conversations matching (conversation_id, user_id); ``is_active`` ignored."""
    few = _few(c, keys, "conversation_id", 0)
    return few.join(_keys(c, keys, ["conversation_id", "user_id"]), ["conversation_id", "user_id"], "left_semi")


def active_conversations(c: DataFrame, user_id=None) -> DataFrame:
    """Active conversations, newest ``last_message_at`` first, missing last, ties by id."""
    out = c.filter(F.col("is_active"))
    if user_id is not None:
        out = out.filter(F.col("user_id") == F.lit(user_id))
    return out.orderBy(F.col("last_message_at").desc_nulls_last(), F.col("conversation_id"))


def conversation_list(c: DataFrame) -> DataFrame:
    """P5: the list projection {id, title, model, last_message}."""
    return c.select(F.col("conversation_id").alias("id"), "title",
                    F.col("ai_model").alias("model"), F.col("last_message_at").alias("last_message"))


def history_view(m: DataFrame) -> DataFrame:
    """The history projection {role, content, timestamp} (plus its conversation)."""
    return m.select("conversation_id", "role", "content", F.col("created_at").alias("timestamp"))


def _ts(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v).cast("timestamp_ntz")


def search_messages(m: DataFrame, text: str | None = None, role: str | None = None,
                    model: str | None = None, since=None, until=None) -> DataFrame:
    """Case-insensitive text search plus pushed-down role/model/time predicates.

    ``since`` is inclusive, ``until`` exclusive. Role, model and time filters
    reach the Parquet scan; ``created_date`` (if present) prunes partitions.
    """
    out = m
    if role is not None:
        out = out.filter(F.col("role") == role)
    if model is not None:
        out = out.filter(F.col("ai_model") == model)
    if since is not None:
        out = out.filter(F.col("created_at") >= _ts(since))
        if "created_date" in m.columns:
            out = out.filter(F.col("created_date") >= F.to_date(_ts(since)))
    if until is not None:
        out = out.filter(F.col("created_at") < _ts(until))
        if "created_date" in m.columns:
            out = out.filter(F.col("created_date") <= F.to_date(_ts(until)))
    if text is not None:
        out = out.filter(F.lower(F.col("content")).contains(text.lower()))
    return out


def retention(m: DataFrame, days: int, as_of) -> tuple[DataFrame, DataFrame]:
    """(keep, drop) where drop = rows created before ``as_of - days``."""
    cutoff = _ts(as_of) - F.make_dt_interval(F.lit(days), F.lit(0), F.lit(0), F.lit(0))
    old = F.coalesce(F.col("created_at") < cutoff, F.lit(False))   # a row without a time is kept
    return m.filter(~old), m.filter(old)


def changes_since(df: DataFrame, key: Sequence[str] | str, cursor, ts: str = "updated_at",
                  tiebreak: Sequence[str] = ()) -> DataFrame:
    """Rows changed after ``cursor``, latest version per key.

    ``max_by`` over a struct keeps one row per key with a partial (map-side)
    aggregation, so a key with millions of versions is reduced before the shuffle.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    order = F.struct(F.col(ts), *[F.col(t) for t in tiebreak])
    latest = (df.filter(F.col(ts) > _ts(cursor))
                .groupBy(*keys)
                .agg(F.max_by(F.struct(*[F.col(c) for c in rest]), order).alias("_v")))
    return latest.select(*keys, *[F.col(f"_v.{c}").alias(c) for c in rest])
