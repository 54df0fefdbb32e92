"""Column -> Column functions (F1-F7). Built-in expressions only, no UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parley import catalog as K


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def title_of(content) -> Column:
    """text longer than 50 characters keeps 47 and gets '...'.

    Length counts code points; the product counts UTF-16 units, which differs
    only for characters outside the basic plane.
    """
    content = _c(content)
    return (F.when(F.length(content) > K.TITLE_MAX,
                   F.concat(F.substring(content, 1, K.TITLE_KEEP), F.lit(K.TITLE_ELLIPSIS)))
            .otherwise(content))


def _routed(model: Column) -> Column:
    cond = None
    for needle, _ in K.PROVIDER_ROUTES:
        hit = model.contains(needle)
        cond = hit if cond is None else (cond | hit)
    return F.coalesce(cond, F.lit(False))


def effective_model(model) -> Column:
    """model actually sent: null or empty -> default; unroutable -> default."""
    m = F.coalesce(F.nullif(_c(model), F.lit("")), F.lit(K.DEFAULT_MODEL))
    return F.when(_routed(m), m).otherwise(F.lit(K.DEFAULT_MODEL))


def provider_of(model) -> Column:
    """case-sensitive substring routing, first match wins."""
    model = _c(model)
    out = F.lit(K.FALLBACK_PROVIDER)
    for needle, provider in reversed(K.PROVIDER_ROUTES):
        out = F.when(F.coalesce(model.contains(needle), F.lit(False)), F.lit(provider)).otherwise(out)
    return out


def outcome_of(content) -> Column:
    """response outcome by exact reply text."""
    content = _c(content)
    out = F.lit(K.OUTCOME_OK)
    for text, label in reversed(K.OUTCOME_TEXTS):
        out = F.when(content == F.lit(text), F.lit(label)).otherwise(out)
    return out


def seconds_between(start, end) -> Column:
    """Whole seconds from ``start`` to ``end`` (truncated), zone-free for NTZ."""
    return F.timestamp_diff("SECOND", _c(start), _c(end))


def relative_age(ts, as_of) -> Column:
    """'Nd ago' / 'Nh ago' / 'Nm ago' / 'Just now' relative to ``as_of``."""
    if isinstance(as_of, str):
        as_of = F.lit(as_of).cast("timestamp_ntz")
    secs = seconds_between(ts, as_of)
    days, hours, mins = F.floor(secs / 86400), F.floor(secs / 3600), F.floor(secs / 60)
    return (F.when(secs.isNull(), F.lit(None).cast("string"))
            .when(days > 0, F.concat(days.cast("string"), F.lit("d ago")))
            .when(hours > 0, F.concat(hours.cast("string"), F.lit("h ago")))
            .when(mins > 0, F.concat(mins.cast("string"), F.lit("m ago")))
            .otherwise(F.lit("Just now")))


def initial_of(model) -> Column:
    """first character of the model name, 'AI' when there is none."""
    return F.coalesce(F.substring(_c(model), 1, 1), F.lit("AI"))


def preference(prefs, key: str, type_: str = "string") -> Column:
    """one typed value of the JSON preferences; null when absent or malformed."""
    return F.try_variant_get(F.try_parse_json(_c(prefs)), f"$.{key}", type_)


# --- fixed values: characters Dart's String.trim removes -----------------
TRIM_CHARS = (r"\t\n\x{0B}\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
              r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}")
TRIM_PATTERN = rf"\A[{TRIM_CHARS}]+|[{TRIM_CHARS}]+\z"


def trimmed(text) -> Column:
    """Unicode-whitespace trim (Spark's ``trim`` strips spaces only)."""
    return F.regexp_replace(_c(text), TRIM_PATTERN, "")
