"""Keyed stream state, per-request admission, exports as pieces, shared prompt chunks, loads with an id, merged patches."""

import json
import os
import re
from collections import Counter
from datetime import datetime, timedelta

from conftest import SF_SMALL, rows
from pyspark.sql import functions as F

from parley import schemas
from parley.operators import aggregates as A
from parley.operators import changes as M
from parley.operators import rooms as R
from parley.operators import validation as V
from parley.plans.registry import QUERIES
from parley.sources import fixtures as fx
from parley.sources import tables as S
from parley.streaming import streams as ST
from parley.streaming.state import KeyedState

T0 = datetime(2024, 1, 1)
AT = lambda s: T0 + timedelta(seconds=s)
EVENT = "event_id long, conversation_id long, client_id long, kind string, ts timestamp_ntz"
REQUEST = "request_id long, client_ip long, ts timestamp_ntz"


# --- keyed state (R4, R5) ---

def numbers(spark, path, **options):
    return KeyedState(spark, path, "k long, v long", ["k"], **options)


def batches(spark, state, first, last):
    for i in range(first, last):
        state.append(spark.createDataFrame([(1, i), (100 + i, 0)], "k long, v long"), i)


def test_state_is_the_latest_row_of_every_key(spark, scratch):
    state = numbers(spark, scratch, buckets=4)
    assert rows(state.read()) == []
    batches(spark, state, 0, 5)
    want = [(1, 4), *[(100 + i, 0) for i in range(5)]]
    assert rows(state.read()) == want
    assert rows(state.read(upto=2)) == [(1, 2), (100, 0), (101, 0), (102, 0)]
    batches(spark, state, 4, 5)                                 # a retried batch replaces itself
    assert rows(state.read()) == want
    touched = spark.createDataFrame([(1,), (1,), (999,)], "k long")
    assert rows(state.read(touched=touched)) == [(1, 4)]


def test_compaction_is_seen_whole_or_not_at_all(spark, scratch):
    state = numbers(spark, scratch, buckets=4)
    batches(spark, state, 0, 6)
    before, reader = rows(state.read()), state.read()            # a reader that begins before the compaction
    half = f"{scratch}/base/upto=5"
    spark.createDataFrame([(1, -1, 0)], "k long, v long, bucket int").write.partitionBy("bucket").parquet(half)
    os.remove(f"{half}/_SUCCESS")                                # a compaction that has not committed
    assert state.versions() == [] and rows(state.read()) == before
    state.compact(5)
    assert state.versions() == [5] and rows(state.read()) == before == rows(reader)
    batches(spark, state, 6, 8)                                  # the stream goes on
    assert rows(state.read()) == [(1, 7), *[(100 + i, 0) for i in range(8)]]
    again = state.read()
    state.compact(7)
    assert state.versions() == [5, 7] and rows(again) == rows(state.read())
    assert sorted(os.listdir(f"{scratch}/delta")) == ["batch_id=6", "batch_id=7"]


def test_compacted_state_holds_near_one_row_a_key(spark, scratch):
    state = numbers(spark, scratch, buckets=2)
    write = state.sink(compact_every=4)
    for i in range(17):
        write(spark.createDataFrame([(k, i) for k in range(10)], "k long, v long"), i)
    stored = sum(spark.read.schema("k long, v long").parquet(f"{scratch}/delta/batch_id={b}").count() for b in state._deltas()
                 if b > state.versions()[-1]) + spark.read.schema("k long, v long").parquet(f"{scratch}/base/upto={state.versions()[-1]}").count()
    assert rows(state.read()) == [(k, 16) for k in range(10)] and stored <= 30
    assert len(state.versions()) <= 2 and len(state._deltas()) <= 9


def test_conversation_state_of_a_stream(spark, scratch):
    m = fx.messages(spark, SF_SMALL)
    src, state = os.path.join(scratch, "src"), ST.conversation_state(spark, os.path.join(scratch, "state"))
    for i in range(3):
        m.filter(F.col("message_id") % 3 == i).coalesce(1).write.mode("append").parquet(src)
    stream = ST.stream_events(spark, src, spark.read.parquet(src).schema, max_files_per_trigger=1)
    q = (ST.conversation_state_stream(stream).writeStream.outputMode("update").foreachBatch(state.sink(compact_every=2))
         .option("checkpointLocation", os.path.join(scratch, "check")).trigger(availableNow=True).start())
    q.awaitTermination(120)
    assert state.versions() == [1]
    assert rows(state.read()) == rows(M.conversation_updates(m))


def test_fan_out_reads_and_writes_what_a_batch_touches(spark, scratch):
    state, out = os.path.join(scratch, "state"), os.path.join(scratch, "out")
    step = ST.fan_out_batch(spark, state, out, buckets=64)
    joins = [(i, i % 500, i, "join", AT(0)) for i in range(1, 5001)]
    step(spark.createDataFrame(joins, EVENT), 0)
    small = [(6001, 7, 7, "message", AT(10)), (6002, 7, 507, "leave", AT(11)), (6003, 7, 7, "message", AT(12))]
    step(spark.createDataFrame(small, EVENT), 1)
    first = rows(spark.read.parquet(out))
    step(spark.createDataFrame(small, EVENT), 1)                 # a retry leaves the same
    assert rows(spark.read.parquet(out)) == first
    members = ST.members_state(spark, state)
    wrote = lambda b: spark.read.parquet(f"{members.path}/delta/batch_id={b}").count()
    assert (wrote(0), wrote(1)) == (5000, 1)
    rooms = spark.createDataFrame([(7,)], "conversation_id long")
    read = members.read(1, rooms)
    assert read.filter("kind = 'join'").count() == 9
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"PartitionFilters: \[[^\]]*bucket", plan)) == 2     # of both deltas, only the room's bucket is read
    everything = spark.createDataFrame(joins + small, EVENT)
    assert rows(spark.read.parquet(out).drop("batch_id")) == rows(R.fan_out(everything))
    assert rows(members.read().filter("kind = 'join'").select("conversation_id", "client_id")) == rows(
        R.room_members(everything).select("conversation_id", "client_id"))


# --- admission (R3) ---

def test_every_request_of_a_stream_is_decided(spark, scratch):
    state, out = os.path.join(scratch, "state"), os.path.join(scratch, "out")
    data = [(1, 1, AT(0)), (2, 1, AT(40)), (3, None, AT(41)), (4, 1, AT(20)), (5, 1, AT(50)), (6, None, AT(42)), (7, None, AT(43)),
            (8, 1, AT(70)), (9, 2, AT(61)), (10, 1, None), (11, 1, AT(59)), (12, 1, AT(300)), (13, 1, AT(30)), (14, 1, AT(301))]
    step = ST.admission_batch(spark, state, out, limit=2, window="1 minute", lateness="60 seconds")
    for i in range(0, len(data), 3):
        step(spark.createDataFrame(data[i:i + 3], REQUEST), i // 3)
    step(spark.createDataFrame(data[12:], REQUEST), 4)           # the last batch once more
    got = spark.read.parquet(out)
    late = [r[0] for r in rows(spark.read.parquet(os.path.join(state, "late")).select("request_id"))]
    held = [r[0] for r in rows(spark.read.parquet(os.path.join(state, "batch_id=4", "held")).select("request_id"))]
    decided = [r[0] for r in rows(got.select("request_id"))]
    assert late == [10, 13] and sorted(decided + late + held) == list(range(1, 15)) and held == [12, 14]
    on_time = spark.createDataFrame([r for r in data if r[0] in decided], REQUEST)
    want = R.rate_limited_requests(on_time, 2, "1 minute")
    assert rows(got.filter("not accepted").select("request_id", "position")) == rows(want.select("request_id", "position"))
    open_windows = spark.read.parquet(os.path.join(state, "batch_id=4", "counts"))
    assert open_windows.count() == 0                             # closed windows left the state


def test_admission_of_a_hot_client_in_slices(spark):
    data = [(i, 1, AT(i % 90)) for i in range(300)] + [(1000 + i, 2 + i, AT(i)) for i in range(50)]
    r = spark.createDataFrame(data, REQUEST)
    none = spark.createDataFrame([], "client_ip long, window_start timestamp_ntz, requests long")
    first, counts = R.admit(none, r.filter(F.col("ts") < AT(45)), F.lit(AT(45)).cast("timestamp_ntz"), 5, "1 minute", max_rows=7)
    second, _ = R.admit(counts, r.filter(F.col("ts") >= AT(45)), F.lit(AT(100)).cast("timestamp_ntz"), 5, "1 minute", max_rows=7)
    got = first.unionByName(second)
    assert got.count() == 350
    assert rows(got.filter("not accepted").select("request_id", "position")) == rows(
        R.rate_limited_requests(r, 5, "1 minute").select("request_id", "position"))


def test_requests_without_a_time_are_returned_apart(spark):
    r = spark.createDataFrame([(1, 1, None), (2, 1, AT(0))], REQUEST)
    assert rows(R.untimed_requests(r).select("request_id")) == [(1,)]
    assert R.rate_limit(r).agg(F.sum("requests")).first()[0] == 1 and R.rate_limited_requests(r).count() == 0


def test_typing_without_a_sender_reaches_all(spark):
    e = spark.createDataFrame([(1, 1, 5, "join", AT(0)), (2, 1, 6, "join", AT(1)), (3, 1, None, "typing_on", AT(2)),
                               (4, 1, 5, "typing_on", AT(3))], EVENT)
    assert rows(R.typing_fan_out(e).select("event_id", "recipient_id")) == [(3, 5), (3, 6), (4, 6)]


# --- exports (S7), loads (S4) ---

def joined(pieces):
    out = {}
    for r in pieces.orderBy("conversation_id", "section", "pos").collect():
        out[r.conversation_id] = out.get(r.conversation_id, "") + r.text
    return out


def test_pieces_join_to_the_documents(spark):
    c, m = fx.chats(spark, SF_SMALL), fx.messages(spark, SF_SMALL)
    want = {r.conversation_id: r.json for r in S.export_conversations(c, m).collect()}
    for max_rows in (None, 3):
        assert joined(S.export_pieces(c, m, max_rows=max_rows)) == want
    plan = S.export_pieces(c, m)._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan


def test_written_export_of_a_hot_conversation(spark, scratch):
    c = spark.createDataFrame([(1, "hot \"title\"", "gpt-4"), (2, None, None), (3, "x", "m")], "conversation_id long, title string, ai_model string")
    hot = [(i, 1, "user", f"line {i}\nsecond é \"quoted\"", AT(i // 3)) for i in range(900)]
    other = [(2000 + i, 3, "assistant", None, AT(i)) for i in range(5)] + [(3000, 9, "user", "orphan", AT(0))]
    m = spark.createDataFrame(hot + other, "message_id long, conversation_id long, role string, content string, created_at timestamp_ntz")
    S.write_export(c, m, f"{scratch}/export", max_rows=50)
    files = sorted(f for f in os.listdir(f"{scratch}/export") if f.startswith("part-"))
    assert sum(os.path.getsize(f"{scratch}/export/{f}") > 0 for f in files) > 3       # one conversation, several files
    text = "".join(open(f"{scratch}/export/{f}", encoding="utf-8").read() for f in files)
    decoder, at, documents = json.JSONDecoder(), 0, {}
    while at < len(text.rstrip()):
        d, at = decoder.raw_decode(text, at)
        documents[d["id"]] = d
        at += text[at:].startswith("\n")
    want = {r.conversation_id: json.loads(r.json) for r in S.export_conversations(c, m).collect()}
    assert documents == want and len(documents[1]["messages"]) == 900


def test_a_load_that_is_run_again_adds_nothing(spark, scratch):
    m, path = fx.messages(spark, SF_SMALL), os.path.join(scratch, "m")
    half = lambda i: m.filter(F.col("message_id") % 2 == i)
    for load in ("a", "b", "a"):
        S.append_messages(half("ab".index(load)), path, load_id=load)
    back = S.load_messages(spark, path)
    S.append_messages(m, path + "-plain")
    assert back.columns == S.load_messages(spark, path + "-plain").columns
    names = [f.name for f in schemas.MESSAGES]
    back = back.select(*names)
    assert rows(back) == rows(S.normalize_messages(m))
    some = S.load_messages(spark, path, since="2024-01-03 00:00:00").select(*names)
    assert rows(some) == rows(S.normalize_messages(m).filter("created_at >= timestamp_ntz'2024-01-03 00:00:00'"))


# --- prompt chunks (A1) ---

def test_chunks_hold_each_message_once_and_give_every_context(spark):
    m = fx.messages(spark, SF_SMALL)
    hot = spark.createDataFrame([(10_000_000 + i, 77_777, 1, "user" if i % 2 else "assistant", f"m{i}", AT(i)) for i in range(150)],
                                "message_id long, conversation_id long, user_id long, role string, content string, created_at timestamp_ntz")
    m = m.select(*hot.columns).unionByName(hot)
    for chunk, max_rows in ((4, None), (7, 20), (1000, None)):
        chunks, turns = A.prompt_chunks(m, chunk, max_rows=max_rows)
        assert chunks.agg(F.sum(F.size("messages"))).first()[0] == m.count()
        assert chunks.agg(F.max(F.size("messages"))).first()[0] <= chunk
        assert turns.count() == m.filter("role = 'user'").count()
        assert rows(A.expand_prompt_chunks(chunks, turns)) == rows(A.prompt_context_rows(m))
    some = turns.filter("conversation_id < 20")
    want = A.prompt_context(m.filter("conversation_id < 20"))
    key = lambda df: Counter((r.conversation_id, r.message_id, tuple(map(tuple, r.context))) for r in df.collect())
    chunks, turns = A.prompt_chunks(m, 4)
    assert key(A.read_prompt(chunks, turns.filter("conversation_id < 20"))) == key(want) and some.count()


# --- patches (M2), logins (V1) ---

def test_patches_of_one_user_all_take_effect(spark):
    users = "id long, email string, name string, provider string, subscription_tier string, default_model string, preferences string, created_at timestamp_ntz"
    u = S.normalize_users(spark.createDataFrame([(1, "a@x.io", "Ann", "email", "free", "gpt-4", "{}", T0), (2, "b@x.io", "Bo", "email", "free", "gpt-4", None, T0)], users))
    patches = spark.createDataFrame([
        (1, 1, ["name"], "Anna", None, None, None, AT(0)),
        (2, 1, ["preferences", "default_model"], None, None, None, '{"t":1}', AT(60)),        # an hour later: the name stays
        (3, 1, ["name", "email"], "Anne", "new@x.io", None, None, AT(30)),
        (4, 1, ["name"], "Lost", None, None, None, None),                                       # no time: before all others
        (5, 1, ["email"], None, "b@x.io", None, None, AT(90)),                                  # taken: changes nothing
        (6, 2, ["name"], "Tie 6", None, None, None, AT(5)), (7, 2, ["name"], "Tie 7", None, None, None, AT(5))],
        "patch_id long, user_id long, fields array<string>, name string, email string, default_model string, preferences string, ts timestamp_ntz")
    out, rejected = M.patch_users(u, patches, "2024-02-01 00:00:00")
    assert rows(out.select("id", "name", "email", "default_model", "preferences")) == [
        (1, "Anne", "new@x.io", None, '{"t":1}'), (2, "Tie 7", "b@x.io", "gpt-4", None)]
    assert rows(rejected.select("patch_id")) == [(5,)]


def test_the_fixtures_hold_users_with_patches_of_different_fields(spark):
    p = fx.profile_patches(spark, SF_SMALL).join(fx.users(spark, SF_SMALL).select(F.col("id").alias("user_id")), "user_id")
    assert p.groupBy("user_id").agg(F.count_distinct("fields").alias("n")).filter("n > 1").count() > 10


def test_login_rules(spark):
    df = spark.createDataFrame([(1, "a@x.io", "secret"), (2, "a@x", "short"), (3, None, None)], "reg_id long, email string, password string")
    got = {r.reg_id: r.reasons for r in V.check(df, "login").collect()}
    assert got == {1: [], 2: ["email malformed", "password shorter than 6"], 3: ["email missing", "password missing"]}
    assert QUERIES["validate_logins"](spark, SF_SMALL).filter("reasons <> ''").count() > 0
