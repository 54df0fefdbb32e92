from datetime import datetime, timedelta

from pyspark.sql import functions as F

from parley.operators import joins as J
from parley.operators import rooms as R
from parley.operators import windows as W
from parley.operators import lookups as P
from parley.sources import fixtures as fx
from conftest import rows

T0 = datetime(2024, 1, 1)
MSG = "message_id long, conversation_id long, user_id long, role string, content string, ai_model string, created_at timestamp_ntz"


def _m(spark, data):
    return spark.createDataFrame(data, MSG)


def test_exchanges_edge_rows(spark):
    t = lambda s: T0 + timedelta(seconds=s)
    m = _m(spark, [
        (1, 1, 1, "user", "a", None, t(0)), (2, 1, 1, "user", "b", None, t(1)),   # two user turns in a row
        (3, 1, 1, "assistant", "r", "gpt-4", t(6)), (4, 1, 1, "user", "c", None, t(7)),  # trailing user turn
        (5, 2, 1, "user", "x", None, t(0)), (6, 2, 1, "assistant", "y", "gpt-4", t(0)),  # equal timestamps, id order
    ])
    got = rows(W.exchanges(m).select("user_message_id", "reply_message_id"))
    assert got == [(1, None), (2, 3), (4, None), (5, 6)]
    d = rows(W.response_delay(m).select("user_message_id", "delay_s"))
    assert d == [(2, 5.0), (5, 0.0)]
    hist = rows(W.message_history(m, max_rows=1).select("message_id", "ordinal"))
    assert hist == [(1, 1), (2, 2), (3, 3), (4, 4), (5, 1), (6, 2)]


def test_visible_messages_ignores_soft_delete(spark):
    c = spark.createDataFrame([(1, 7, False), (2, 8, True)], "conversation_id long, user_id long, is_active boolean")
    m = _m(spark, [(10, 1, 7, "user", "hi", None, T0), (11, 2, 8, "user", "yo", None, T0),
                   (12, 3, 7, "user", "lost", None, T0)])
    assert rows(J.visible_messages(m, c, user_id=7).select("message_id")) == [(10,)]
    assert rows(P.owned_conversations(c, [(1, 7), (2, 7)]).select("conversation_id")) == [(1,)]
    assert rows(J.orphan_messages(m, c).select("message_id")) == [(12,)]


def test_token_life(spark):
    day = 86400
    r = spark.createDataFrame([
        (1, 5, "login", T0), (2, 5, "call", T0), (3, 5, "call", T0 + timedelta(seconds=7 * day)),
        (4, 5, "call", T0 + timedelta(seconds=7 * day - 1)), (5, 6, "call", T0),
        (6, 5, "login", T0 + timedelta(seconds=10 * day)), (7, 5, "call", T0 + timedelta(seconds=16 * day))],
        "request_id long, user_id long, kind string, ts timestamp_ntz")
    valid, invalid = J.valid_token_requests(r)
    assert rows(valid.select("request_id")) == [(2,), (4,), (7,)]
    assert rows(invalid.select("request_id")) == [(3,), (5,)]


EV = "event_id long, conversation_id long, client_id long, kind string, ts timestamp_ntz"


def test_fan_out_join_leave_join(spark):
    t = lambda s: T0 + timedelta(seconds=s)
    e = spark.createDataFrame([
        (1, 1, 10, "join", t(0)), (2, 1, 11, "join", t(0)),
        (3, 1, 10, "message", t(0)),              # same instant, after both joins (id order)
        (4, 1, 11, "leave", t(5)), (5, 1, 10, "message", t(6)),
        (6, 1, 11, "join", t(7)), (7, 1, 12, "message", t(8)),  # sender not a member
        (8, 1, 10, "typing_on", t(9)),
        (9, 1, 13, "message", t(9)), (10, 1, 13, "join", t(9)),  # join right after the message
    ], EV)
    got = rows(R.fan_out(e, block=2, max_rows=2).select("event_id", "recipient_id"))
    assert got == [(3, 10), (3, 11), (5, 10), (7, 10), (7, 11), (9, 10), (9, 11)]
    typing = rows(R.typing_fan_out(e).select("event_id", "recipient_id", "is_typing"))
    assert typing == [(8, 11, True)]  # 13 joins after the typing event (same instant, later id)
    assert rows(R.room_members(e).select("client_id")) == [(10,), (11,), (13,)]


def test_rate_limit_batch(spark):
    t = lambda s: T0 + timedelta(seconds=s)
    r = spark.createDataFrame([(i, 1, 1, "call", t(i), 1.0) for i in range(1, 103)] + [(200, 1, 1, "call", t(61), 1.0)],
                              "request_id long, client_ip long, user_id long, kind string, ts timestamp_ntz, response_ms double")
    counts = rows(R.rate_limit(r).select("window_start", "requests", "remaining", "limited"))
    assert counts == [(t(0), 59, 41, False), (t(60), 44, 56, False)]
    r2 = r.filter("request_id < 60 OR request_id = 200").withColumn("ts", F.lit(t(1)).cast("timestamp_ntz"))
    extra = spark.createDataFrame([(300 + i, 1, 1, "call", t(2), 1.0) for i in range(50)], r.schema)
    rejected = R.rate_limited_requests(r2.unionByName(extra), max_rows=10)
    # 110 requests in one minute: the 10 latest (by ts, id) are past the limit of 100
    assert rejected.count() == 10
    assert rows(rejected.select("position")) == [(p,) for p in range(101, 111)]


def test_membership_intervals(spark):
    t = lambda s: T0 + timedelta(seconds=s)
    e = spark.createDataFrame([(1, 1, 10, "join", t(0)), (2, 1, 10, "leave", t(5)), (3, 1, 10, "join", t(7)),
                               (4, 1, 10, "join", t(9)), (5, 1, 11, "leave", t(1))], EV)
    got = rows(R.membership_intervals(e, max_rows=1).select("client_id", "start_id", "end_id"))
    assert got == [(10, 1, 2), (10, 3, 4), (10, 4, None)]


def test_no_row_is_lost_between_the_halves(spark):
    """Retention and token life put every row, nulls included, into exactly one half."""
    from parley.operators import aggregates as A
    from parley.operators import lookups as P
    t = datetime(2024, 1, 1)
    m = spark.createDataFrame([(1, t), (2, None), (3, datetime(2023, 1, 1))], "id long, created_at timestamp_ntz")
    keep, drop = P.retention(m, 2, "2024-01-02 00:00:00")
    assert rows(keep.select("id")) == [(1,), (2,)] and rows(drop.select("id")) == [(3,)]
    r = spark.createDataFrame([(1, None, "login", t, 1.0), (2, None, "call", t, 1.0), (3, 5, "login", t, 1.0),
                               (4, 5, "call", None, 1.0), (5, 5, "call", t, 1.0), (6, 5, "login", None, None)],
                              "request_id long, user_id long, kind string, ts timestamp_ntz, response_ms double")
    valid, expired = J.valid_token_requests(r)
    assert rows(valid.select("request_id")) == [(5,)]                      # an anonymous login vouches for nobody
    assert rows(expired.select("request_id")) == [(2,), (4,)]
    nothing = r.withColumn("response_ms", F.lit(None).cast("double"))
    for approx in (False, True):
        got = A.latency_stats(nothing, approx=approx).collect()
        assert len(got) == 2 and all(x.requests == 0 and x.mean_ms is None and x.p50_ms is None for x in got)


def test_email_form_is_the_whole_value(spark):
    from parley.operators import validation as V
    df = spark.createDataFrame([("a@b.co",), ("a@b.co\n",), ("\na@b.co",)], "email string")
    assert [r.reasons for r in V.check(df, V.email_rule()).collect()] == [[], ["email malformed"], ["email malformed"]]


def test_prompt_ranges_expand_to_the_context(spark):
    from parley.operators import aggregates as A
    from conftest import SF_SMALL
    m = fx.messages(spark, SF_SMALL)
    h = W.message_history(m).select("conversation_id", "ordinal", "role", "content")
    ranges = A.prompt_ranges(m, max_turns=3)
    got = ranges.select("*", F.explode(F.sequence("first_ordinal", "last_ordinal")).alias("ordinal")).join(
        h, ["conversation_id", "ordinal"]).select(
        "conversation_id", "message_id", (F.col("ordinal") - F.col("first_ordinal")).alias("pos"), "role", "content")
    assert rows(got) == rows(A.prompt_context_rows(m, max_turns=3))


def test_login_attempts_of_known_and_unknown_emails(spark):
    u = spark.createDataFrame([("a@x.io",)], "email string")
    logins = spark.createDataFrame([(1, "a@x.io"), (2, "A@x.io"), (3, None)], "id long, email string")
    known, unknown = J.login_attempts(logins, u)
    assert rows(known.select("id")) == [(1,)] and rows(unknown.select("id")) == [(2,), (3,)]


def test_packed_prompt_contexts_hold_the_rows(spark):
    from parley.operators import aggregates as A
    from conftest import SF_SMALL
    m = fx.messages(spark, SF_SMALL)
    for turns in (None, 2):
        packed = A.prompt_context(m, max_turns=turns).select(
            "conversation_id", "message_id", F.posexplode("context").alias("pos", "c")).select(
            "conversation_id", "message_id", "pos", "c.role", "c.content")
        assert rows(packed) == rows(A.prompt_context_rows(m, max_turns=turns))


def _members_by_brute_force(events, kinds, include_sender):
    """(event_id, recipient_id) pairs, walking each room's events in (ts, event_id) order."""
    here, pairs = {}, []
    for i, room, who, kind, _ in sorted(events, key=lambda x: (x[4], x[0])):
        if kind == "join":
            here.setdefault(room, set()).add(who)
        elif kind == "leave":
            here.get(room, set()).discard(who)
        elif kind in kinds:
            pairs += [(i, m) for m in here.get(room, ()) if include_sender or m != who]
    return sorted(pairs)


def _churn(n):
    """Rooms of very different length: members who stay, come and go, or are there for one message."""
    import random
    rng, out = random.Random(7), []
    for i in range(n):
        room = rng.choice([1, 1, 1, 1, 1, 1, 2, 2, 3])
        who = rng.choice([rng.randrange(6), rng.randrange(6, 40)])
        kind = rng.choice(["message"] * 4 + ["typing_on", "typing_off", "join"] + (["leave"] if who >= 3 else []))
        out.append((i, room, who, kind, T0 + timedelta(seconds=i // 3)))
    return out


def _copied(df):
    """Rows that the plan's Generate nodes (the copies into blocks) made while ``df`` was collected."""
    df.collect()
    todo, total = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        if node.nodeName() == "Generate":
            total += node.metrics().apply("numOutputRows").value()
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return total


def _stayers(n, members, kind="message"):
    """``members`` clients join a room before its ``n`` events and stay."""
    joins = [(i, 1, i, "join", T0) for i in range(members)]
    return joins + [(members + i, 1, 0, kind, T0 + timedelta(seconds=1 + i)) for i in range(n)]


def _without_aqe(spark, make):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return _copied(make())
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_fan_out_equals_brute_force_at_any_block(spark):
    data = _churn(3000)
    e = spark.createDataFrame(data, EV)
    want = _members_by_brute_force(data, {"message"}, True)
    for block, most in ((1, None), (2, 50), (5, None), (512, None)):
        assert rows(R.fan_out(e, block=block, max_rows=most).select("event_id", "recipient_id")) == want, block


def test_fan_out_copies_grow_with_the_input(spark):
    """Members who stay were copied into every block of the room: members x messages / block rows."""
    for n in (1000, 4000):
        e = spark.createDataFrame(_stayers(n, 50), EV)
        assert _without_aqe(spark, lambda: R.fan_out(e, block=n // 250)) <= 2 * n + 18 * 50


def test_typing_fan_out_equals_brute_force_at_any_block(spark):
    data = _churn(3000)
    e = spark.createDataFrame(data, EV)
    want = _members_by_brute_force(data, {"typing_on", "typing_off"}, False)
    for block, most in ((1, None), (2, 50), (512, None)):
        assert rows(R.typing_fan_out(e, block=block, max_rows=most).select("event_id", "recipient_id")) == want, block


def test_typing_fan_out_copies_grow_with_the_input(spark):
    e = spark.createDataFrame(_stayers(1000, 50, "typing_on"), EV)
    assert _without_aqe(spark, lambda: R.typing_fan_out(e, block=4)) <= 2 * 1000 + 18 * 50


def _shuffled(df):
    """Bytes that the plan's Exchange nodes wrote while ``df`` was collected (AQE off)."""
    df.collect()
    todo, total = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        if node.nodeName() == "Exchange":
            total += node.metrics().apply("shuffleBytesWritten").value()
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return total


def test_typing_fan_out_shuffles_short_rows(spark):
    """A copied interval is cut to its block: copies of one block differ by the recipient alone, and kinds travel as numbers."""
    import random

    rng, n, members = random.Random(11), 16 * 512, 20_000
    data = [(i, 1, rng.randrange(1 << 40), "join", T0 + timedelta(microseconds=rng.randrange(1 << 33))) for i in range(members)]
    data += [(members + i, 1, 1, rng.choice(["typing_on", "typing_off"]), T0 + timedelta(microseconds=rng.randrange(1 << 33))) for i in range(n)]
    e = spark.createDataFrame(data, EV).coalesce(1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        wrote = _shuffled(R.typing_fan_out(e).groupBy().count())
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert wrote < 2_000_000      # 1.83 million; 2.17 with whole intervals and kinds as text


def test_fan_out_step_equals_brute_force(spark):
    data = _churn(3000)
    e = spark.createDataFrame(data, EV)
    for cut in (0, 300, 700):     # seconds: three events each
        at = F.lit(T0 + timedelta(seconds=cut)).cast("timestamp_ntz")
        out, members = R.fan_out_step(R.presence(e.filter(F.col("ts") < at)), e.filter(F.col("ts") >= at))
        late = {x[0] for x in data if x[4] >= T0 + timedelta(seconds=cut)}
        want = [p for p in _members_by_brute_force(data, {"message"}, True) if p[0] in late]
        assert rows(out.select("event_id", "recipient_id")) == want, cut
        assert rows(members) == rows(R.presence(e)), cut


def test_fan_out_step_copies_grow_with_the_input(spark):
    n = 40 * 512                  # the step has the default block
    e = spark.createDataFrame(_stayers(n, 2500), EV)
    at = F.lit(T0 + timedelta(seconds=1)).cast("timestamp_ntz")
    step = lambda: R.fan_out_step(R.presence(e.filter(F.col("ts") < at)), e.filter(F.col("ts") >= at))[0].groupBy().count()
    assert _without_aqe(spark, step) <= 2 * n + 18 * 2500


def test_fan_out_step_query_places_cuts_without_the_members(spark, monkeypatch):
    """Both running passes computed the members before the step to count them and to place their cuts."""
    from parley.plans import registry
    rows_made, plain = spark.sparkContext.accumulator(0), R.presence
    made = F.udf(lambda x: rows_made.add(1) is None, "boolean")
    monkeypatch.setattr(R, "presence", lambda e: plain(e).filter(made("since_id")))
    data = _churn(3000)
    e = spark.createDataFrame(data, EV)
    at = T0 + timedelta(seconds=300)
    monkeypatch.setattr(registry, "STEP_AT", str(at))
    out = registry._second_half(e)[0].select("event_id", "recipient_id")
    assert rows_made.value == 0
    late = {x[0] for x in data if x[4] >= at}
    assert rows(out) == [p for p in _members_by_brute_force(data, {"message"}, True) if p[0] in late]


def test_fan_out_step_takes_any_rows_to_place_the_cuts(spark):
    data = _churn(1500)
    e = spark.createDataFrame(data, EV)
    at = F.lit(T0 + timedelta(seconds=200)).cast("timestamp_ntz")
    before, after = R.presence(e.filter(F.col("ts") < at)), e.filter(F.col("ts") >= at)
    want = rows(R.fan_out_step(before, after)[0])
    for like in (e, after, e.limit(200), e.limit(0)):
        assert rows(R.fan_out_step(before, after, max_rows=50, like=like)[0]) == want
