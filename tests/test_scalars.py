from datetime import datetime

from pyspark.sql import functions as F

from parley.functions import scalars as fn


def _one(spark, col, values, schema="v string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(col).collect()]


def test_title_cut_at_fifty(spark):
    s50, s51 = "a" * 50, "b" * 51
    out = _one(spark, fn.title_of("v"), [s50, s51, None])
    assert out == [s50, "b" * 47 + "...", None]


def test_effective_model_and_provider(spark):
    vals = [None, "", "GPT-4", "gpt-claude", "llama-2", "claude-3-haiku", "mistral-medium", "gpt-4"]
    eff = _one(spark, fn.effective_model("v"), vals)
    assert eff == ["gpt-3.5-turbo", "gpt-3.5-turbo", "gpt-3.5-turbo", "gpt-claude", "gpt-3.5-turbo",
                   "claude-3-haiku", "mistral-medium", "gpt-4"]
    prov = _one(spark, fn.provider_of("v"), vals)
    # first match wins: gpt before claude; unmatched (and null) route to openai
    assert prov == ["openai", "openai", "openai", "openai", "openai", "anthropic", "mistral", "openai"]


def test_outcome_of(spark):
    vals = ["No response generated.", "OpenAI is not configured. Please check your API key.",
            "Claude integration is not yet implemented. This is a mock response from Claude.",
            "I apologize, but I encountered an error processing your request. Please try again.",
            "no response generated.", "hello"]
    assert _one(spark, fn.outcome_of("v"), vals) == ["empty", "unconfigured", "mock", "error", "ok", "ok"]


def test_relative_age_boundaries(spark):
    as_of = datetime(2024, 1, 10, 0, 0, 0)
    secs = [59, 60, 3599, 3600, 86399, 86400, -30]
    df = spark.createDataFrame([(s,) for s in secs], "s long").select(
        (F.lit(as_of).cast("timestamp_ntz") - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("s").cast("decimal(18,6)"))).alias("ts"))
    out = [r[0] for r in df.select(fn.relative_age("ts", "2024-01-10 00:00:00")).collect()]
    assert out == ["Just now", "1m ago", "59m ago", "1h ago", "23h ago", "1d ago", "Just now"]


def test_initial_of(spark):
    assert _one(spark, fn.initial_of("v"), ["gpt-4", None, "claude"]) == ["g", "AI", "c"]


def test_preference_lookup(spark):
    vals = ['{"theme":"dark","notifications":true}', '{"theme":"light","notifications":{"email":true}}',
            "not json", None]
    assert _one(spark, fn.preference("v", "theme"), vals) == ["dark", "light", None, None]
    assert _one(spark, fn.preference("v", "notifications", "boolean"), vals) == [True, None, None, None]


def test_trim_unicode_whitespace(spark):
    vals = ["  hi  ", " 　x\t\n", " ", "a b"]
    assert _one(spark, fn.trimmed("v"), vals) == ["hi", "x", "", "a b"]
