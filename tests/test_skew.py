"""The hot-key split must give exactly the numbers a plain window gives."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from parley.operators.stats import exact_percentiles
from parley.plans import skew
from parley.plans.skew import ordinal, running
from parley.sources import fixtures as fx
from conftest import SF_CHECK, rows


def _hot_messages(spark):
    """Messages plus one conversation holding about a third of all rows."""
    m = fx.messages(spark, SF_CHECK)
    hot = m.select(
        (F.col("message_id") + 10_000_000).alias("message_id"), F.lit(-1).cast("long").alias("conversation_id"),
        "user_id", "role", "content", "ai_model", "created_at", "token_count")
    return m.unionByName(hot.unionByName(hot.withColumn("message_id", F.col("message_id") + 5_000_000)))


def test_ordinal_matches_row_number_with_hot_key(spark):
    m = _hot_messages(spark)
    w = Window.partitionBy("conversation_id").orderBy("created_at", "message_id")
    want = rows(m.select("message_id", F.row_number().over(w).alias("o")))
    for limit in (5, 50, 1_000_000):
        got = rows(ordinal(m, ["conversation_id"], ["created_at", "message_id"], out="o", max_rows=limit)
                   .select("message_id", "o"))
        assert got == want, limit


def test_ordinal_spreads_hot_key_over_slices(spark):
    m = _hot_messages(spark)
    sliced = ordinal(m, ["conversation_id"], ["created_at", "message_id"], out="o", max_rows=100)
    # the hot conversation (1,072 rows) must not be numbered in one window partition
    plan = sliced._jdf.queryExecution().optimizedPlan().toString()
    assert "_slice" in plan
    assert sliced.filter("conversation_id = -1").count() == 1072


def test_ordinal_with_null_keys_and_ties(spark):
    df = spark.createDataFrame([(None, 1, 1), (None, 1, 2), (1, 5, 3), (1, 5, 4), (1, 2, 5)],
                               "k long, t long, id long")
    got = rows(ordinal(df, ["k"], ["t", "id"], out="o", max_rows=1).select("id", "o"))
    assert got == [(1, 1), (2, 2), (3, 2), (4, 3), (5, 1)]


def test_exact_percentiles_match_builtin(spark):
    r = fx.requests(spark, SF_CHECK)
    want = {row.kind: (round(row.p50, 9), round(row.p95, 9)) for row in
            r.groupBy("kind").agg(F.percentile("response_ms", 0.5).alias("p50"),
                                  F.percentile("response_ms", 0.95).alias("p95")).collect()}
    for limit in (100, 1_000_000):
        got = exact_percentiles(r, ["kind"], "response_ms", {"p50": 0.5, "p95": 0.95}, max_rows=limit)
        assert {row.kind: (round(row.p50, 9), round(row.p95, 9)) for row in got.collect()} == want


def test_exact_percentiles_global(spark):
    df = spark.createDataFrame([(i, None if v is None else float(v)) for i, v in enumerate([5, 1, 4, 2, 3, None])], "id long, v double")
    got = exact_percentiles(df, [], "v", {"p25": 0.25, "p50": 0.5, "p90": 0.9}, max_rows=2).collect()[0]
    assert (got.p25, got.p50, round(got.p90, 9)) == (2.0, 3.0, 4.6)


def test_exact_percentiles_heavy_ties(spark):
    # a third of the rows share one value: ties collapse before ranking
    vals = [7.0] * 300 + [float(i) for i in range(600)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id long, v double")
    want = df.agg(F.percentile("v", 0.5).alias("a"), F.percentile("v", 0.99).alias("b")).collect()[0]
    got = exact_percentiles(df, [], "v", {"a": 0.5, "b": 0.99}, max_rows=50).collect()[0]
    assert (round(got.a, 9), round(got.b, 9)) == (round(want.a, 9), round(want.b, 9))


def test_running_max_matches_window(spark):
    from parley.plans.skew import running
    m = _hot_messages(spark)
    w = (Window.partitionBy("conversation_id").orderBy("created_at", "message_id")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    tok = F.col("token_count")
    want = rows(m.select("message_id", F.max(tok).over(w), F.sum(tok).over(w)))
    got = running(m, ["conversation_id"], ["created_at", "message_id"],
                  {"mx": ("max", "token_count"), "sm": ("sum", "token_count")}, max_rows=40)
    assert rows(got.select("message_id", "mx", "sm")) == want


def test_hot_key_with_one_shared_timestamp_is_still_split(spark):
    """Bulk-loaded rows: a third of the rows in one key, all at the same instant."""
    m = fx.messages(spark, SF_CHECK)
    bulk = (m.withColumn("message_id", F.col("message_id") + 20_000_000)
             .withColumn("conversation_id", F.lit(-7).cast("long"))
             .withColumn("created_at", F.lit("2024-01-09 00:00:00").cast("timestamp_ntz")))
    data = m.unionByName(bulk)
    w = Window.partitionBy("conversation_id").orderBy("created_at", "message_id")
    want = rows(data.select("message_id", F.row_number().over(w).alias("o")))
    got = ordinal(data, ["conversation_id"], ["created_at", "message_id"], out="o", max_rows=50)
    assert rows(got.select("message_id", "o")) == want


def _cases(spark):
    big = 1 << 60
    return {
        "null lead": ([(1, None, 1, 5), (1, None, 2, 7), (1, 10, 3, 1), (1, 20, 4, 2), (1, 30, 5, 3)], "k long, t long, id long, v long"),
        "null and one value": ([(1, None, 2, 5), (1, 9, 1, 7), (1, 9, 3, 1), (1, 9, 4, 2)], "k long, t long, id long, v long"),
        "above 2^53": ([(1, big + i, 9 - i, i) for i in range(4)], "k long, t long, id long, v long"),
        "null summands": ([(1, 1, 1, 4), (1, 2, 2, 4), (1, 3, 3, None), (1, 4, 4, None), (1, 5, 5, 5), (2, 1, 6, None)],
                          "k long, t long, id long, v long"),
        "null key": ([(None, i, i, i) for i in range(40)] + [(1, 1, 100, 1)], "k long, t long, id long, v long"),
        "strings": ([("a", f"t{i % 3}", i, i) for i in range(30)], "k string, t string, id long, v long"),
        "doubles": ([(1, x, i, i) for i, x in enumerate([float("nan"), 0.0, -1.5, None, 2.0, float("inf")])],
                    "k long, t double, id long, v long"),
    }


def test_slices_never_change_a_result(spark):
    """Nulls in the lead, in the key and in the summands, large integers, strings, NaN; one, two or three rows a slice."""
    for name, (data, schema) in _cases(spark).items():
        df = spark.createDataFrame(data, schema).repartition(3)
        w = Window.partitionBy("k").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        v = F.col("v")
        want = rows(df.select("id", F.count(F.lit(1)).over(w), F.sum(v).over(w), F.max(v).over(w), F.min(v).over(w), F.count(v).over(w)))
        for limit in (1, 2, 3, 1_000_000):
            got = running(df, ["k"], ["t", "id"], {"n": ("count", F.lit(1)), "s": ("sum", "v"), "hi": ("max", "v"),
                                                   "lo": ("min", "v"), "c": ("count", "v")}, max_rows=limit)
            assert rows(got.select("id", "n", "s", "hi", "lo", "c")) == want, (name, limit)


def test_three_order_columns(spark):
    df = spark.createDataFrame([(1, i % 2, i % 3, i) for i in range(50)], "k long, a long, b long, id long")
    w = Window.partitionBy("k").orderBy("a", "b", "id")
    want = rows(df.select("id", F.row_number().over(w)))
    for limit in (1, 4, 1_000_000):
        assert rows(ordinal(df, ["k"], ["a", "b", "id"], out="o", max_rows=limit).select("id", "o")) == want


def test_a_burst_is_cut(spark):
    """99 % of one key's rows at one instant: no slice holds more than twice the limit."""
    df = spark.range(10_000).select(F.lit(1).alias("k"), F.when(F.col("id") < 100, F.col("id")).otherwise(5_000).alias("t"), "id")
    cuts = skew._cuts(df, ["k"], ["t", "id"], 100)
    most = cuts.agg(F.max(F.size("_cuts"))).first()[0]
    sliced = df.join(F.broadcast(cuts), F.col("k") == F.col("_k0")).withColumn(
        "s", skew._slice(F.col("_cuts"), F.struct("t", "id"), most))
    assert sliced.groupBy("s").count().agg(F.max("count")).first()[0] <= 200


def test_history_plan_reads_its_table_once_or_twice(spark):
    m = _hot_messages(spark)
    scans = lambda df: df._jdf.queryExecution().executedPlan().toString().count("FileScan")
    for limit, times in ((1_000_000, 1), (50, 2)):
        assert scans(ordinal(m, ["conversation_id"], ["created_at", "message_id"], max_rows=limit)) == times * scans(m)
