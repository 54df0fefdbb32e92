"""Structured Streaming operators.

Each stream has a batch twin in ``parley.operators`` computing the same rows
over a closed table; tests run both on the fixtures.

* Event times are stored as TIMESTAMP_NTZ; watermarks need TIMESTAMP, so
  ``event_time`` adds a zoned copy (same wall clock under the session zone).
* Presence (R1/R2) and conversation state (R4) are keyed ``max_by``/``min_by``
  aggregations in update mode: the state holds one row per key, never a list.
* Rate limits (R3) are tumbling-window counts with a watermark; append mode
  emits each window once it is closed.
  ``admission_batch`` decides every single request (accepted or rejected).
* Fan-out (R5) and admissions run the batch steps (``rooms.fan_out_step``, ``rooms.admit``) inside
  ``foreachBatch`` on the state of the previous micro-batch, so a hot room or client is handled
  by the same skew-safe batch plan. Rows out of order by up to the stated
  lateness are held back until they can be ordered. States and outputs are
  written per batch id: a retried batch rewrites its own folders only.
* Keyed state is a log of deltas with versioned bases (``state.KeyedState``).
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley import catalog as K
from parley.operators import changes as M
from parley.operators import rooms as R
from parley.streaming.state import KeyedState, drop_folder


def stream_events(spark: SparkSession, path: str, schema: T.StructType,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Room-event or request stream from Parquet files arriving in ``path``."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path)


def event_time(df: DataFrame, col: str = "ts", out: str = "event_time") -> DataFrame:
    """Zoned copy of an NTZ event time, usable by ``withWatermark``."""
    return df.withColumn(out, F.col(col).cast("timestamp"))


def _presence(e: DataFrame, kinds) -> DataFrame:
    return (e.filter(F.col("kind").isin(*kinds))
             .groupBy("conversation_id", "client_id")
             .agg(F.max_by(F.struct("kind", "ts", "event_id"), F.struct("ts", "event_id")).alias("_l"))
             .select("conversation_id", "client_id", F.col("_l.kind").alias("kind"),
                     F.col("_l.ts").alias("since"), F.col("_l.event_id").alias("since_id")))


def room_presence_stream(e_stream: DataFrame) -> DataFrame:
    """Latest join/leave per (room, client); members are the rows with kind 'join'.

    Run in update mode and upsert by key (a leave replaces the earlier join).
    """
    return _presence(e_stream, R.MEMBERSHIP)


def typing_stream(e_stream: DataFrame) -> DataFrame:
    """R2: latest typing flag per (room, client); typing when kind is 'typing_on'."""
    return _presence(e_stream, R.TYPING)


def rate_limit_stream(r_stream: DataFrame, limit: int = K.RATE_LIMIT, window: str = K.RATE_WINDOW,
                      watermark: str = "1 minute", key: str = "client_ip") -> DataFrame:
    """Per client and tumbling window: requests, remaining quota, reset time.

    With append mode a window is emitted once the watermark passes its end.
    A request is dropped as late when it is older than the watermark in force
    for the previous micro-batch (Spark's rule for late rows), so a window's
    count is final when it is emitted.
    """
    w = (event_time(r_stream).withWatermark("event_time", watermark)
         .groupBy(key, F.window("event_time", window).alias("w"))
         .agg(F.count(F.lit(1)).alias("requests")))
    return w.select(
        key, F.col("w.start").cast("timestamp_ntz").alias("window_start"),
        F.col("w.end").cast("timestamp_ntz").alias("reset_at"), "requests",
        F.greatest(F.lit(limit) - F.col("requests"), F.lit(0)).alias("remaining"),
        (F.col("requests") > limit).alias("limited"))


def conversation_state_stream(m_stream: DataFrame) -> DataFrame:
    """Running first usable user message and latest reply per conversation.

    Same aggregation as the batch M6 (``changes.conversation_updates``); run in
    update mode, keep the rows with ``conversation_state(...).sink()`` and fold its ``read()``
    into the snapshot with ``apply_conversation_updates``.
    """
    return M.conversation_updates(m_stream)


def conversation_state(spark: SparkSession, path: str, buckets: int = 64) -> KeyedState:
    """R4's stored state: one row a conversation, compacted while the stream runs."""
    return KeyedState(spark, path, "conversation_id long, first_content string, "
                      "first_at struct<created_at: timestamp_ntz, message_id: bigint>, last_reply_at timestamp_ntz",
                      ["conversation_id"], buckets=buckets)


def write_state_batches(path: str):
    """``foreachBatch`` sink: each micro-batch's updated rows under ``batch_id=N``.

    Dynamic partition overwrite makes a retried batch replace only itself.
    """
    def sink(df: DataFrame, batch_id: int) -> None:
        (df.withColumn("batch_id", F.lit(batch_id).cast("long"))
           .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy("batch_id").parquet(path))
    return sink


def latest_state(spark: SparkSession, path: str, keys, order: str = "batch_id") -> DataFrame:
    """Latest row per key over all written batches (``max_by``, map-side partial)."""
    df = spark.read.parquet(path)
    keys = [keys] if isinstance(keys, str) else list(keys)
    rest = [c for c in df.columns if c not in keys and c != order]
    return (df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(order)).alias("_v"))
              .select(*keys, *[F.col(f"_v.{c}").alias(c) for c in rest]))


def compact_state(spark: SparkSession, path: str, into: str, keys) -> None:
    """The latest row of every key of a state folder as batch 0 of a new folder ``into``.

    A keyed state folder grows by one delta a batch; a scheduled compaction
    followed by writing on to ``into`` keeps what ``latest_state`` reads near one row a key.
    """
    write_state_batches(into)(latest_state(spark, path, keys), 0)


#: Batches whose events and times are kept (the last one is read; one more serves a retry).
KEPT_STATES = 3
_EVENT = "event_id long, conversation_id long, client_id long, kind string, ts timestamp_ntz"
_MEMBER = "conversation_id long, client_id long, kind string, since timestamp_ntz, since_id long"


def _folder(state_dir: str, batch_id: int, name: str) -> str:
    return os.path.join(state_dir, f"batch_id={batch_id}", name)


def _in_order(spark: SparkSession, state_dir: str, batch: DataFrame, batch_id: int, lateness: str) -> tuple[DataFrame, Column]:
    """The rows that are ready after this micro-batch, and the time up to which rows are ready (null: none yet).

    A row is held back until the latest time seen is ``lateness`` ahead of it. Rows that come later than
    that, or without a time, are written to ``state_dir/late``. ``state_dir/batch_id=N`` holds what batch N
    leaves: ``rows`` (its own, so the source is read once), ``held`` and ``seen`` (one row: the latest
    time). Batch 0 starts from nothing; for any other batch the state of batch N-1 must be there,
    or the read fails. A retried batch rewrites its own folders only.
    """
    schema = batch.schema
    mine = lambda name: _folder(state_dir, batch_id, name)
    before = lambda name, s: spark.read.schema(s).parquet(_folder(state_dir, batch_id - 1, name))
    held = before("held", schema) if batch_id else spark.createDataFrame([], schema)
    seen = before("seen", "ts timestamp_ntz").first()["ts"] if batch_id else None
    batch.write.mode("overwrite").parquet(mine("rows"))
    rows = spark.read.schema(schema).parquet(mine("rows"))
    latest = max((t for t in (seen, rows.agg(F.max("ts")).first()[0]) if t is not None), default=None)
    cut = lambda t: F.lit(t).cast("timestamp_ntz") - F.expr(f"INTERVAL {lateness}")
    too_late = F.col("ts").isNull() | (F.col("ts") < cut(seen) if seen is not None else F.lit(False))
    rows.filter(too_late).write.mode("overwrite").parquet(os.path.join(state_dir, "late", f"batch_id={batch_id}"))
    waiting = held.unionByName(rows.filter(~too_late))
    until = cut(latest) if latest is not None else F.lit(None).cast("timestamp_ntz")
    is_ready = F.coalesce(F.col("ts") <= until, F.lit(False))
    waiting.filter(~is_ready).write.mode("overwrite").parquet(mine("held"))
    spark.createDataFrame([(latest,)], "ts timestamp_ntz").coalesce(1).write.mode("overwrite").parquet(mine("seen"))
    return waiting.filter(is_ready), until


def _output(df: DataFrame, out_dir: str, batch_id: int) -> None:
    (df.withColumn("batch_id", F.lit(batch_id).cast("long"))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(out_dir))


def members_state(spark: SparkSession, state_dir: str, buckets: int = 64) -> KeyedState:
    """R5's presence state: the latest join or leave of every (room, client)."""
    return KeyedState(spark, os.path.join(state_dir, "members"), _MEMBER, ["conversation_id", "client_id"],
                      order=["since", "since_id"], buckets=buckets)


def fan_out_batch(spark: SparkSession, state_dir: str, out_dir: str, lateness: str = "0 seconds",
                  buckets: int = 64, compact_every: int = 20):
    """``foreachBatch`` function delivering each micro-batch's messages.

    Events may come out of order by up to ``lateness``: a join that arrives after the message it precedes
    still counts (``_in_order``). Events that come later than that, or without a time, are not
    delivered; they are written to ``state_dir/late``. Who is present is a ``KeyedState``
    (``state_dir/members``): a batch reads the buckets of the rooms it touches and writes the memberships it
    changes, whatever the number of members elsewhere. Deliveries go to ``out_dir/batch_id=N``;
    states older than ``KEPT_STATES`` batches are removed.
    """
    state = members_state(spark, state_dir, buckets)

    def run(batch: DataFrame, batch_id: int) -> None:
        events = batch.select("event_id", "conversation_id", "client_id", "kind", "ts")
        ready, _ = _in_order(spark, state_dir, events, batch_id, lateness)
        there = state.read(batch_id - 1, ready.select("conversation_id")).filter(F.col("kind") == "join").drop("kind")
        _output(R.fan_out_step(there, ready)[0], out_dir, batch_id)
        state.append(_presence(ready, R.MEMBERSHIP), batch_id)
        if batch_id and batch_id % compact_every == 0:
            state.compact(batch_id - 1)
        if batch_id >= KEPT_STATES:
            drop_folder(spark, os.path.join(state_dir, f"batch_id={batch_id - KEPT_STATES}"))

    return run


def admission_batch(spark: SparkSession, state_dir: str, out_dir: str, limit: int = K.RATE_LIMIT,
                    window: str = K.RATE_WINDOW, lateness: str = "1 minute", key: str = "client_ip"):
    """``foreachBatch`` function that accepts or rejects every request.

    Writes each decided request with window_start, position and ``accepted`` to ``out_dir/batch_id=N``. Requests are
    decided in time order, once the latest time seen is ``lateness`` ahead (``_in_order``), so the
    rejected ones are those of ``rooms.rate_limited_requests`` over the same rows; later ones and
    those without a time go to ``state_dir/late``: accepted + rejected + late + held = input. The state
    (``counts``) is one number for each client and open window; a window leaves it when no further request can fall into it.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        ready, until = _in_order(spark, state_dir, batch, batch_id, lateness)
        counted = T.StructType([batch.schema[key], T.StructField("window_start", T.TimestampNTZType()),
                                T.StructField("requests", T.LongType())])
        counts = (spark.read.schema(counted).parquet(_folder(state_dir, batch_id - 1, "counts")) if batch_id
                  else spark.createDataFrame([], counted))
        decided, after = R.admit(counts, ready, F.coalesce(until, F.lit("0001-01-01").cast("timestamp_ntz")), limit, window, key)
        _output(decided, out_dir, batch_id)
        after.write.mode("overwrite").parquet(_folder(state_dir, batch_id, "counts"))
        if batch_id >= KEPT_STATES:
            drop_folder(spark, os.path.join(state_dir, f"batch_id={batch_id - KEPT_STATES}"))

    return run
