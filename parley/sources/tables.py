"""Sources and sinks (S1-S4, S6-S7); the streams S5 are in ``parley.streaming``.

Loaders read Parquet with column pruning and pushed filters, and normalise the
two spellings of each table (snake_case DDL, camelCase entity/documents).
Messages are stored partitioned by ``created_date`` so time filters prune
whole directories.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley import schemas as S


def _normalise(df: DataFrame, schema: T.StructType, id_name: str, keep: tuple[str, ...] = ()) -> DataFrame:
    renames = {k: v for k, v in S.CAMEL_TO_SNAKE.items() if k in df.columns and v and v not in df.columns}
    if "_id" in df.columns and id_name not in df.columns:
        renames["_id"] = id_name
    out = df.withColumnsRenamed(renames) if renames else df
    cols = []
    for f in schema.fields:
        if f.name in out.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        elif f.name == "updated_at" and "created_at" in out.columns:
            cols.append(F.col("created_at").cast(f.dataType).alias("updated_at"))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    cols += [F.col(k) for k in keep if k in out.columns]
    return out.select(*cols)


def normalize_users(df: DataFrame) -> DataFrame:
    """Declared user columns in snake_case; ``password`` is never carried."""
    if "password" in df.columns:
        df = df.drop("password")
    return _normalise(df, S.USERS, "id")


def normalize_conversations(df: DataFrame) -> DataFrame:
    return _normalise(df, S.CONVERSATIONS, "conversation_id")


def normalize_messages(df: DataFrame) -> DataFrame:
    return _normalise(df, S.MESSAGES, "message_id", keep=("created_date",))


def load_users(spark: SparkSession, path: str) -> DataFrame:
    """Users table, either spelling, without the password column."""
    raw = spark.read.parquet(path)
    return normalize_users(raw.drop("password") if "password" in raw.columns else raw)


def load_conversations(spark: SparkSession, path: str) -> DataFrame:
    """Conversations table."""
    return normalize_conversations(spark.read.parquet(path))


def load_messages(spark: SparkSession, path: str, since=None) -> DataFrame:
    """S3: messages; ``since`` prunes ``created_date`` partitions and filters rows."""
    m = normalize_messages(spark.read.parquet(path))
    if since is not None:
        ts = F.lit(since).cast("timestamp_ntz")
        if "created_date" in m.columns:
            m = m.filter(F.col("created_date") >= F.to_date(ts))
        m = m.filter(F.col("created_at") >= ts)
    return m


def append_messages(m: DataFrame, path: str, load_id: str | None = None) -> None:
    """Append messages, partitioned by ``created_date`` (one directory per day).

    Rows are first dealt by day (a large day over several tasks), so a day gets few files.
    ``load_id`` names the load: its rows go to a partition of their own inside each day and replace what
    an earlier run of the same load left there, so a load that is run again (with the same
    rows) adds nothing. Without it a second run adds its rows again. A table takes loads of one form only.
    """
    t = normalize_messages(m).withColumn("created_date", F.to_date("created_at")).hint("rebalance", "created_date")
    if load_id is None:
        t.write.mode("append").partitionBy("created_date").parquet(path)
    else:
        (t.withColumn("load_id", F.lit(load_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
          .partitionBy("created_date", "load_id").parquet(path))


def snapshot(df: DataFrame, path: str, day) -> None:
    """Write ``df`` as the ``snapshot_date = day`` partition, replacing only that day."""
    (df.withColumn("snapshot_date", F.lit(day).cast("date"))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("snapshot_date").parquet(path))


_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS"


def export_conversations(c: DataFrame, m: DataFrame, part_size: int | None = None,
                         max_rows: int | None = None) -> DataFrame:
    """JSON documents of conversations with their ordered messages.

    Columns: conversation_id, part, json. One document per conversation (``part``
    0), with an empty list if it has no messages; a document is one row, so it is
    as long as its conversation. With ``part_size`` the messages are cut into
    parts of at most that many (by position from the skew-safe ``ordinal``), one
    document each. Write with ``write.text`` after selecting ``json``.
    """
    from parley.plans.skew import ordinal
    pos = m.select("conversation_id", "message_id", "role", "content", "created_at")
    part = F.lit(0).cast("long")
    if part_size is not None:
        pos = ordinal(pos, ["conversation_id"], ["created_at", "message_id"], out="_pos", max_rows=max_rows)
        part = F.floor((F.col("_pos") - 1) / part_size).cast("long")
    items = pos.select("conversation_id", part.alias("part"),
                       F.struct("created_at", "message_id", "role", "content",
                                F.date_format("created_at", _TS_FORMAT).alias("timestamp")).alias("_m"))
    per = items.groupBy("conversation_id", "part").agg(F.array_sort(F.collect_list("_m")).alias("_ms"))
    msgs = F.transform("_ms", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"),
                                                 x["timestamp"].alias("timestamp")))
    doc = (c.select("conversation_id", "title", F.col("ai_model").alias("model"))
             .join(per, "conversation_id", "left")
             .withColumn("part", F.coalesce(F.col("part"), F.lit(0).cast("long"))))
    body = F.struct(
        F.col("conversation_id").alias("id"), "title", "model",
        F.coalesce(msgs, F.array().cast("array<struct<role:string,content:string,timestamp:string>>")).alias("messages"))
    return doc.select("conversation_id", "part", F.to_json(body, {"ignoreNullFields": "false"}).alias("json"))


def export_pieces(c: DataFrame, m: DataFrame, max_rows: int | None = None) -> DataFrame:
    """S7 as a stream of text pieces: conversation_id, section, pos, text.

    A document is its pieces in (section, pos) order, joined without separator: section 0 opens it, section 1
    has one piece a message (numbered by the skew-safe ``ordinal``), section 2 closes it. The text equals
    ``export_conversations``'; no row, group or task holds a whole conversation.
    """
    from parley.plans.skew import ordinal
    keep = {"ignoreNullFields": "false"}
    head = F.to_json(F.struct(F.col("conversation_id").alias("id"), "title", F.col("ai_model").alias("model")), keep)
    zero = F.lit(0).cast("long").alias("pos")
    opening = c.select("conversation_id", F.lit(0).alias("section"), zero, F.concat(
        F.substring(head, 1, F.length(head) - 1), F.lit(',"messages":[')).alias("text"))
    closing = c.select("conversation_id", F.lit(2).alias("section"), zero, F.lit("]}").alias("text"))
    own = m.join(c.select("conversation_id"), "conversation_id", "left_semi").select(
        "conversation_id", "message_id", "role", "content", "created_at")
    numbered = ordinal(own, ["conversation_id"], ["created_at", "message_id"], out="pos", max_rows=max_rows)
    one = F.to_json(F.struct("role", "content", F.date_format("created_at", _TS_FORMAT).alias("timestamp")), keep)
    messages = numbered.select("conversation_id", F.lit(1).alias("section"), "pos", F.concat(
        F.when(F.col("pos") > 1, F.lit(",")).otherwise(F.lit("")), one).alias("text"))
    return opening.unionByName(messages).unionByName(closing)


def write_export(c: DataFrame, m: DataFrame, path: str, max_rows: int | None = None) -> None:
    """Writes the documents as JSON text files, one line a piece.

    Pieces are range-partitioned by (conversation, section, position), so a long conversation goes on in the
    next file; the files in name order hold the documents one after the other. (White space between
    JSON tokens has no meaning, and a message's text holds no line break.)
    """
    n = int(c.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["conversation_id", "section", "pos"]
    pieces = export_pieces(c, m, max_rows).repartitionByRange(n, *order).sortWithinPartitions(*order)
    pieces.select("text").write.text(path)
