"""Validation and defaults (V1-V4).

``validate`` evaluates every rule as a column expression and collects the
failing rule names with ``array_compact``, so rows are checked in one pass
without UDFs and valid/rejected come from one plan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley import catalog as K
from parley.functions.scalars import trimmed

# Email form: something@something.tld, no spaces (ours; the DTOs use a library check).
EMAIL_PATTERN = r"\A[^\s@]+@[^\s@]+\.[^\s@]+\z"

Rule = tuple[str, Column]  # (reason, condition that marks the row as FAILING)


def length_rule(col: str, lo: int | None, hi: int | None) -> list[Rule]:
    c = F.col(col)
    rules: list[Rule] = [(f"{col} missing", c.isNull())]
    if lo is not None:
        rules.append((f"{col} shorter than {lo}", F.length(c) < lo))
    if hi is not None:
        rules.append((f"{col} longer than {hi}", F.length(c) > hi))
    return rules


def email_rule(col: str = "email") -> list[Rule]:
    c = F.col(col)
    return [(f"{col} missing", c.isNull()), (f"{col} malformed", ~c.rlike(EMAIL_PATTERN))]


def enum_rule(col: str, allowed: Sequence[str], optional: bool = False) -> list[Rule]:
    c = F.col(col)
    bad = ~c.isin(*allowed)
    return [(f"{col} not one of {','.join(allowed)}", bad if optional else (bad | c.isNull()))]


def rule_set(name: str) -> list[Rule]:
    """Named rule sets of the product's request bodies and stored documents."""
    if name == "registration":
        return (length_rule("name", K.NAME_MIN, K.NAME_MAX) + email_rule()
                + length_rule("password", K.PASSWORD_MIN, K.PASSWORD_MAX))
    if name == "login":
        return email_rule() + length_rule("password", K.LOGIN_PASSWORD_MIN, None)
    if name == "create_user":
        return email_rule() + length_rule("name", None, None) + enum_rule("provider", K.AUTH_PROVIDERS)
    if name == "conversation":
        return length_rule("title", None, None)
    if name == "message":
        return (length_rule("content", 1, None) + enum_rule("role", K.MESSAGE_ROLES)
                + [("conversation_id missing", F.col("conversation_id").isNull()),
                   ("user_id missing", F.col("user_id").isNull())])
    raise ValueError(f"unknown rule set {name!r}")


def check(df: DataFrame, rules: Sequence[Rule] | str, out: str = "reasons") -> DataFrame:
    """``df`` plus ``out``: array of failed rule names (empty when valid)."""
    rules = rule_set(rules) if isinstance(rules, str) else list(rules)
    failed = [F.when(F.coalesce(cond, F.lit(False)), F.lit(reason)) for reason, cond in rules]
    return df.withColumn(out, F.array_compact(F.array(*failed)))


def validate(df: DataFrame, rules: Sequence[Rule] | str) -> tuple[DataFrame, DataFrame]:
    """V1: (valid rows, rejected rows with ``reasons``)."""
    checked = check(df, rules)
    ok = F.size("reasons") == 0
    return checked.filter(ok).drop("reasons"), checked.filter(~ok)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """V2: unknown columns are an error; known ones are converted to the declared type.

    Values that do not convert become null (``try_cast``); declared columns the
    input lacks are added as nulls.
    """
    declared = {f.name: f.dataType for f in schema.fields}
    unknown = [c for c in df.columns if c not in declared]
    if unknown:
        raise ValueError(f"unknown columns: {', '.join(unknown)}")
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).try_cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


# --- fixed values: store defaults per table --------------------------------
DEFAULTS: Mapping[str, Mapping[str, object]] = {
    "users": {"provider": K.DEFAULT_PROVIDER, "subscription_tier": K.DEFAULT_TIER,
              "default_model": K.DEFAULT_MODEL, "is_active": True},
    "conversations": {"ai_model": K.DEFAULT_MODEL, "metadata": "{}", "is_active": True},
    "messages": {"metadata": "{}", "token_count": 0},
}


def apply_defaults(df: DataFrame, table: str) -> DataFrame:
    """V3: fill defaults; a missing column is added with its default.

    Spark cannot tell an explicit null from an absent value, so both are filled.
    """
    out = df
    for col, value in DEFAULTS[table].items():
        lit = F.lit(value)
        out = out.withColumn(col, F.coalesce(F.col(col), lit) if col in df.columns else lit)
    return out


def clean_input(df: DataFrame, col: str = "content") -> DataFrame:
    """V4: trim Unicode whitespace at both ends and drop rows left empty."""
    return df.withColumn(col, trimmed(col)).filter(F.length(F.col(col)) > 0)
