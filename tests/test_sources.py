import json
import os
from datetime import date, datetime

from pyspark.sql import functions as F

from parley import schemas
from parley.sources import fixtures as fx
from parley.sources import tables as S
from conftest import SF_SMALL, rows

T0 = datetime(2024, 1, 1)


def test_users_camel_case_and_no_password(spark, scratch):
    path = os.path.join(scratch, "users")
    spark.createDataFrame([(1, "a@x.io", "hash", "Ann", "free", "gpt-4", True, T0, T0)],
                          "id long, email string, password string, name string, subscriptionTier string, "
                          "defaultModel string, isActive boolean, createdAt timestamp_ntz, updatedAt timestamp_ntz"
                          ).write.parquet(path)
    u = S.load_users(spark, path)
    assert "password" not in u.columns
    assert rows(u.select("id", "subscription_tier", "default_model", "is_active", "provider_id")) == [
        (1, "free", "gpt-4", True, None)]


def test_append_and_load_messages_prunes_days(spark, scratch):
    path = os.path.join(scratch, "messages")
    m = fx.messages(spark, SF_SMALL)
    S.append_messages(m.filter("role = 'user'"), path)
    S.append_messages(m.filter("role <> 'user'"), path)       # second append, same layout
    days = sorted(d for d in os.listdir(path) if d.startswith("created_date="))
    assert days[0] == "created_date=2024-01-01"
    back = S.load_messages(spark, path, since="2024-01-01 12:00:00")
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(created_date" in plan
    want = m.filter(F.col("created_at") >= F.lit("2024-01-01 12:00:00").cast("timestamp_ntz"))
    assert rows(back.drop("created_date")) == rows(want)


def test_snapshot_replaces_only_its_day(spark, scratch):
    path = os.path.join(scratch, "snap")
    df = spark.createDataFrame([(1,), (2,)], "id long")
    S.snapshot(df, path, "2024-01-01")
    S.snapshot(df.filter("id = 1"), path, "2024-01-02")
    S.snapshot(df.filter("id = 2"), path, "2024-01-02")    # rerun of a day replaces it
    back = spark.read.parquet(path)
    assert rows(back) == [(1, date(2024, 1, 1)), (2, date(2024, 1, 1)), (2, date(2024, 1, 2))]


def test_export_document_shape(spark):
    out = S.export_conversations(fx.chats(spark, SF_SMALL), fx.messages(spark, SF_SMALL))
    docs = [json.loads(r.json) for r in out.collect()]
    assert len(docs) == fx.chats(spark, SF_SMALL).count()
    d = next(x for x in docs if x["messages"])
    assert set(d) == {"id", "title", "model", "messages"}
    assert set(d["messages"][0]) == {"role", "content", "timestamp"}
    stamps = [x["timestamp"] for x in d["messages"]]
    assert stamps == sorted(stamps)


def test_export_parts_are_bounded(spark):
    m = fx.messages(spark, SF_SMALL)
    whole = {r.conversation_id: json.loads(r.json)["messages"]
             for r in S.export_conversations(fx.chats(spark, SF_SMALL), m).collect()}
    parts = {}
    for r in S.export_conversations(fx.chats(spark, SF_SMALL), m, part_size=2, max_rows=3).collect():
        msgs = json.loads(r.json)["messages"]
        assert len(msgs) <= 2
        parts.setdefault(r.conversation_id, {})[r.part] = msgs
    for cid, by_part in parts.items():
        joined = [x for p in sorted(by_part) for x in by_part[p]]
        assert joined == whole[cid]


def test_load_conversations_of_both_spellings(spark, scratch):
    t = datetime(2024, 1, 1)
    camel = spark.createDataFrame([(7, 1, "t", "gpt-4", True, t)],
                                  "_id long, userId long, title string, aiModel string, isActive boolean, createdAt timestamp_ntz")
    camel.write.parquet(os.path.join(scratch, "c"))
    got = S.load_conversations(spark, os.path.join(scratch, "c"))
    assert [f.name for f in got.schema] == [f.name for f in schemas.CONVERSATIONS]
    assert rows(got.select("conversation_id", "user_id", "ai_model", "created_at")) == [(7, 1, "gpt-4", t)]
