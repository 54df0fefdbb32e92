"""Key lookups that skip row groups, snapshots changed bucket by bucket, roll-ups from daily sketches."""

import os
from datetime import datetime, timedelta

import pytest
from conftest import SF_SMALL, rows
from pyspark.sql import functions as F

from parley.operators import aggregates as A
from parley.operators import changes as M
from parley.operators import lookups as P
from parley.sources import buckets as B
from parley.sources import fixtures as fx
from parley.sources import tables as S

T0 = datetime(2024, 1, 1)


def scanned(df):
    """Rows that came out of the Parquet scan of a collected query."""
    plan = df._jdf.queryExecution().executedPlan()
    found, todo = [], [plan]
    while todo:
        p = todo.pop()
        if p.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            todo.append(p.executedPlan())
            continue
        if "QueryStageExec" in p.getClass().getSimpleName():
            todo.append(p.plan())
        if p.getClass().getSimpleName() == "FileSourceScanExec":
            found.append(p.metrics().apply("numOutputRows").value())
        kids = p.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return sum(found)


@pytest.fixture(scope="module")
def many(spark):
    n = 200_000
    u = spark.range(n).select(F.col("id"), F.concat(F.sha2(F.col("id").cast("string"), 256), F.lit("@x.io")).alias("email"),
                              F.lit("n").alias("name"))
    import tempfile
    path = tempfile.mkdtemp(prefix="parley-lookup-") + "/u"
    B.write_lookup(u, path, "id", blooms=["email"], files=8, group_bytes=256 << 10, distinct=10_000)
    return u, path


def test_ten_keys_read_few_row_groups(spark, many):
    u, path = many
    table = spark.read.parquet(path)
    ids = [5, 77, 5000, 5001, 60_000, 60_001, 60_002, 199_999, 1_000_000, 5]
    got = P.lookup_users(table, ids)
    assert rows(got.select("id")) == [(5,), (77,), (5000,), (5001,), (60_000,), (60_001,), (60_002,), (199_999,)]
    assert scanned(got) < 80_000
    emails = [r.email for r in u.filter("id in (3, 150000)").collect()] + [f"nobody{i}@x.io" for i in range(8)]
    found = P.lookup_users(table, emails, on="email")
    assert rows(found.select("id")) == [(3,), (150_000,)]
    assert scanned(found) < 80_000                      # emails are not sorted: the Bloom filters tell
    unsorted = P.lookup_users(table, emails + [f"more{i}@x.io" for i in range(30)], on="email")
    assert rows(unsorted.select("id")) == [(3,), (150_000,)]


def test_short_and_long_key_lists_give_the_same(spark):
    c = fx.chats(spark, SF_SMALL)
    keys = [(r.conversation_id, r.user_id) for r in c.limit(8).collect()] + [(1, None), (None, 2)]
    wide = spark.createDataFrame(keys, "conversation_id long, user_id long")
    assert rows(P.owned_conversations(c, keys)) == rows(P.owned_conversations(c, wide)) and len(rows(P.owned_conversations(c, keys))) == 8


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_ten_patches_rewrite_at_most_ten_buckets(spark, scratch):
    u = S.normalize_users(fx.users(spark, SF_SMALL))
    path = f"{scratch}/users"
    B.write_buckets(u, path, "id", buckets=64)
    before = files(path)
    ids = [r.id for r in u.limit(9).collect()]
    email = u.filter(f"id not in ({','.join(map(str, ids))})").first().email      # of a user in another bucket
    patches = spark.createDataFrame([(i, d, ["name"], f"New {d}", None, T0 + timedelta(seconds=i)) for i, d in enumerate(ids)]
                                    + [(50, ids[0], ["email"], None, email, T0), (51, 10 ** 9, ["name"], "x", None, T0)],
                                    "patch_id long, user_id long, fields array<string>, name string, email string, ts timestamp_ntz")
    want = M.patch_users(u, patches, "2024-02-01 00:00:00")[0]
    names = B.change_buckets(spark, path, "id", patches.select(F.col("user_id").alias("id")),
                             lambda part, everyone: M.patch_users(part, patches, "2024-02-01 00:00:00", everyone)[0], buckets=64)
    after = files(path)
    kept = [f for f in before if int(f.split("bucket=")[1].split("/")[0]) not in names]
    assert len(names) <= 10 and kept and all(after.get(f) == before[f] for f in kept)
    assert rows(B.load_buckets(spark, path)) == rows(want)


def test_registrations_deletions_and_emptied_buckets(spark, scratch):
    u = S.normalize_users(fx.users(spark, SF_SMALL)).limit(60)
    u.write.parquet(f"{scratch}/u")
    u, path = spark.read.parquet(f"{scratch}/u"), f"{scratch}/users"
    B.write_buckets(u, path, "id", buckets=64)
    known = u.first()
    reg = spark.createDataFrame([(900_001, "Cyd", "c@x.io", "secret1", T0), (900_002, "Dee", known.email, "secret1", T0)],
                                "reg_id long, name string, email string, password string, ts timestamp_ntz")
    B.change_buckets(spark, path, "id", reg.select(F.col("reg_id").alias("id")),
                     lambda part, everyone: M.register_users(part, reg, everyone=everyone)[0], buckets=64)
    assert rows(B.load_buckets(spark, path)) == rows(M.register_users(u, reg)[0])
    gone = spark.createDataFrame([(known.id,), (900_001,), (5_000_000,)], "id long")
    B.change_buckets(spark, path, "id", gone, lambda part, _: M.delete_users(part, gone)[0], buckets=64)
    assert rows(B.load_buckets(spark, path)) == rows(u.filter(F.col("id") != known.id))
    assert B.change_buckets(spark, path, "id", gone.limit(0), lambda part, _: part, buckets=64) == []


def test_active_users_from_daily_sketches(spark, scratch):
    m = spark.range(200_000).select((F.col("id") % 40_000).alias("user_id"),
                                    (F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(F.col("id") % 59)).alias("created_at"))
    A.user_sketches(m).write.parquet(f"{scratch}/s")
    s = spark.read.parquet(f"{scratch}/s")
    assert s.count() == 59
    got = {r.period.month: (r.days, r.active_users) for r in A.active_users_rollup(s).collect()}
    exact = {r.m: r.n for r in m.groupBy(F.month("created_at").alias("m")).agg(F.count_distinct("user_id").alias("n")).collect()}
    assert got[1][0] == 31 and all(abs(got[k][1] - exact[k]) <= 0.03 * exact[k] for k in exact)
    assert all(r.close for r in A.active_users_rollup_check(m).collect())


def test_latency_from_daily_sketches(spark):
    r = spark.range(100_000).select(F.when(F.col("id") % 3 == 0, "login").otherwise("call").alias("kind"),
                                    (F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(F.col("id") % 20)).alias("ts"),
                                    (F.pmod(F.xxhash64("id"), F.lit(100_000)) / 100).alias("response_ms"))
    r = r.unionByName(spark.createDataFrame([("none", T0, None)], "kind string, ts timestamp_ntz, response_ms double"))
    got = {x.kind: x for x in A.latency_rollup(A.latency_sketches(r)).collect()}
    exact = {x.kind: x for x in A.latency_stats(r).collect()}
    for k in ("login", "call"):
        assert (got[k].requests, got[k].mean_ms, got[k].share_under_limit) == (exact[k].requests, exact[k].mean_ms, exact[k].share_under_limit)
        for p in ("p50_ms", "p95_ms", "p99_ms"):
            assert abs(got[k][p] - exact[k][p]) <= 10          # 1 % of the range
    assert got["none"].requests == 0 and got["none"].p50_ms is None
    checked = {x.kind: (x.p50_close, x.p95_close, x.p99_close) for x in A.latency_rollup_check(r).collect()}
    assert checked["login"] == checked["call"] == (True, True, True)
