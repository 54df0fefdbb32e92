from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from parley.operators import aggregates as A
from parley.operators import changes as M
from parley.operators import topk as T
from parley.sources import tables as S
from conftest import rows

T0 = datetime(2024, 1, 1)
USERS = ("id long, email string, name string, provider string, subscription_tier string, "
         "subscription_expires_at timestamp_ntz, default_model string, preferences string, is_active boolean, created_at timestamp_ntz")


@pytest.fixture()
def users(spark):
    return S.normalize_users(spark.createDataFrame([
        (1, "a@x.io", "Ann", "email", "free", None, "gpt-4", '{"theme":"dark"}', True, T0),
        (2, "b@x.io", "Bo", "google", "premium", T0, "gpt-4", None, True, T0)], USERS))


def test_register_users(spark, users):
    reg = spark.createDataFrame([
        (10, "Cy", "c@x.io", "secret1", T0), (11, "Cy2", "c@x.io", "secret2", T0 + timedelta(seconds=1)),  # repeat
        (12, "Ann", "a@x.io", "secret3", T0), (13, "Ann", "A@X.IO", "secret4", T0),   # taken / other case
        (14, "D", "d@x.io", "secret5", T0)],                                          # name too short
        "reg_id long, name string, email string, password string, ts timestamp_ntz")
    out, rejected = M.register_users(users, reg)
    assert rows(out.select("id", "email", "provider", "subscription_tier", "default_model", "is_active")) == [
        (1, "a@x.io", "email", "free", "gpt-4", True), (2, "b@x.io", "google", "premium", "gpt-4", True),
        (10, "c@x.io", "email", "free", "gpt-3.5-turbo", True), (13, "A@X.IO", "email", "free", "gpt-3.5-turbo", True)]
    assert "password" not in out.columns
    got = {r.reg_id: r.reasons for r in rejected.collect()}
    assert got == {11: ["email repeated in batch"], 12: ["email already registered"], 14: ["name shorter than 2"]}


def test_patch_users(spark, users):
    patches = spark.createDataFrame([
        (1, 1, ["name", "preferences"], "Anna", None, None, '{"theme":"light","n":{"a":1}}', None, T0),
        (2, 1, ["default_model"], None, None, None, None, None, T0 + timedelta(seconds=1)),   # explicit null; the rest stays
        (3, 2, ["password"], None, None, None, None, "x", T0),
        (4, 2, ["email"], None, "a@x.io", None, None, None, T0),
        (5, 9, ["name"], "Ghost", None, None, None, None, T0)],
        "patch_id long, user_id long, fields array<string>, name string, email string, default_model string, "
        "preferences string, password string, ts timestamp_ntz")
    out, rejected = M.patch_users(users, patches, "2024-02-01 00:00:00")
    got = {r.id: (r.name, r.default_model, r.preferences, r.updated_at) for r in out.collect()}
    assert got[1] == ("Anna", None, '{"theme":"light","n":{"a":1}}', datetime(2024, 2, 1))
    assert got[2] == ("Bo", "gpt-4", None, T0)
    assert {r.patch_id: r.reasons for r in rejected.collect()} == {
        3: ["field not patchable"], 4: ["email taken"], 5: ["user not found"]}


def test_delete_and_soft_delete(spark, users):
    remaining, unknown = M.delete_users(users, spark.createDataFrame([(2,), (7,), (7,)], "id long"))
    assert rows(remaining.select("id")) == [(1,)] and rows(unknown) == [(7,)]
    c = S.normalize_conversations(spark.createDataFrame(
        [(1, 1, "t", True, T0), (2, 2, "u", False, T0)],
        "conversation_id long, user_id long, title string, is_active boolean, created_at timestamp_ntz"))
    reqs = spark.createDataFrame([(1, 1), (1, 1), (2, 2), (2, 1), (5, 1)], "conversation_id long, user_id long")
    out, misses = M.soft_delete(c, reqs, "2024-03-01 00:00:00")
    assert rows(out.select("conversation_id", "is_active", "updated_at")) == [
        (1, False, datetime(2024, 3, 1)), (2, False, datetime(2024, 3, 1))]  # a no-op update still touches
    assert rows(misses) == [(2, 1), (5, 1)]


def test_titles_and_refresh(spark):
    c = S.normalize_conversations(spark.createDataFrame(
        [(1, 1, "New Conversation", T0), (2, 1, "Kept", T0), (3, 1, None, T0), (4, 1, "", T0)],
        "conversation_id long, user_id long, title string, created_at timestamp_ntz"))
    t = lambda s: T0 + timedelta(seconds=s)
    long51 = "x" * 51
    m = spark.createDataFrame([
        (1, 1, 1, "user", "New Conversation", t(1)), (2, 1, 1, "user", long51, t(2)), (3, 1, 1, "assistant", "r", t(3)),
        (4, 2, 1, "user", "hello", t(1)), (5, 2, 1, "assistant", "r", t(2)),
        (6, 4, 1, "user", "first", t(1))],   # no reply
        "message_id long, conversation_id long, user_id long, role string, content string, created_at timestamp_ntz")
    titles = {r.conversation_id: r.title for r in A.derive_titles(c, m).collect()}
    assert titles == {1: "x" * 47 + "...", 2: "Kept", 3: None, 4: "first"}
    out = {r.conversation_id: (r.title, r.last_message_at, r.updated_at)
           for r in M.refresh_conversations(c, m, "2024-02-01 00:00:00").collect()}
    assert out[1] == ("x" * 47 + "...", t(3), datetime(2024, 2, 1))
    assert out[2] == ("Kept", t(2), datetime(2024, 2, 1))
    assert out[4] == ("", None, T0)  # no completed exchange: untouched


def test_paginate_edges(spark):
    df = spark.createDataFrame([(i, T0 + timedelta(hours=i)) for i in range(45)], "conversation_id long, created_at timestamp_ntz")
    p1 = df.transform(lambda d: T.paginate(d, page=1, limit=20)).collect()
    assert [r.conversation_id for r in p1] == list(range(44, 24, -1)) and p1[0].total == 45 and p1[0].pages == 3
    assert T.paginate(df, page=9).count() == 0                       # beyond the end
    for limit in (0, 101, 500):                                       # outside 1..100
        with pytest.raises(ValueError):
            T.paginate(df, limit=limit)
    assert T.paginate(df.filter("false")).count() == 0                # empty table
    last = p1[-1]
    nxt = T.paginate(df, limit=20, after=(last.created_at, last.conversation_id)).collect()
    assert [r.conversation_id for r in nxt] == list(range(24, 4, -1))  # keyset cursor = page 2


def test_recent_conversations(spark):
    c = spark.createDataFrame([(i, i % 2, T0 + timedelta(hours=i) if i != 4 else None) for i in range(8)],
                              "conversation_id long, user_id long, last_message_at timestamp_ntz")
    got = rows(T.recent_conversations(c, 2).select("user_id", "conversation_id", "rank"))
    assert got == [(0, 2, 2), (0, 6, 1), (1, 5, 2), (1, 7, 1)]


def test_create_conversations_defaults_and_rejects(spark):
    c = S.normalize_conversations(spark.createDataFrame([(1, 1, "t", T0)],
                                  "conversation_id long, user_id long, title string, created_at timestamp_ntz"))
    reqs = spark.createDataFrame([(5, 2, "hello", None, T0), (6, 2, None, "gpt-4", T0)],
                                 "conversation_id long, user_id long, title string, ai_model string, created_at timestamp_ntz")
    out, rejected = M.create_conversations(c, reqs)
    got = {r.conversation_id: (r.ai_model, r.metadata, r.is_active, r.updated_at) for r in out.collect()}
    assert got[5] == ("gpt-3.5-turbo", "{}", True, T0) and 6 not in got and 1 in got
    assert [r.reasons for r in rejected.collect()] == [["title missing"]]


def test_paginate_accepts_documented_sort_name(spark):
    df = spark.createDataFrame([(i, T0 + timedelta(hours=i)) for i in range(5)], "conversation_id long, created_at timestamp_ntz")
    assert [r.conversation_id for r in T.paginate(df, sort="createdAt", order="asc", limit=2).collect()] == [0, 1]


def test_cursor_walks_over_missing_sort_values(spark):
    """Following the cursor visits every row once, in both directions, missing values included."""
    df = spark.createDataFrame([(i, T0 + timedelta(hours=i // 2) if i % 3 else None) for i in range(20)],
                               "conversation_id long, created_at timestamp_ntz")
    for order in ("asc", "desc"):
        seen, after = [], None
        for _ in range(20):
            page = T.paginate(df, limit=3, order=order, after=after).collect()
            if not page:
                break
            seen += [r.conversation_id for r in page]
            after = (page[-1].created_at, page[-1].conversation_id)
        assert sorted(seen) == list(range(20)), order
        missing = [i for i in seen if i % 3 == 0]
        assert (seen[:len(missing)] if order == "asc" else seen[-len(missing):]) == missing  # missing sorts lowest


def test_patch_values_follow_the_user_rules(spark, users):
    patches = spark.createDataFrame([
        (1, 1, ["email"], None, "not-an-email", None, T0), (2, 1, ["email"], None, None, None, T0),
        (3, 1, ["provider"], None, None, "myspace", T0), (4, 1, ["name"], None, None, None, T0),
        (5, 1, ["email"], None, "new@x.io", None, T0 + timedelta(seconds=5)),
        (6, 2, ["email"], None, "new@x.io", None, T0 + timedelta(seconds=4)),          # the earlier claim
        (7, 2, ["provider"], None, None, "google", T0)],
        "patch_id long, user_id long, fields array<string>, name string, email string, provider string, ts timestamp_ntz")
    out, rejected = M.patch_users(users, patches, "2024-02-01 00:00:00")
    assert {r.patch_id: r.reasons for r in rejected.collect()} == {
        1: ["email malformed"], 2: ["email missing"], 3: ["provider not one of email,google,apple"], 4: ["name missing"],
        5: ["email repeated in batch"]}
    emails = [r.email for r in out.collect()]
    assert sorted(emails) == ["a@x.io", "new@x.io"] and len(set(emails)) == len(emails)
