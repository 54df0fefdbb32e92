"""Distributed statistics shared by several operators.

Spark's exact ``percentile`` keeps every distinct value of a group in one
aggregation buffer, so a global or hot-group percentile lands in one task.
``exact_percentiles`` instead ranks the distinct values with the skew-safe
``running`` and picks those that hold the two neighbouring ranks of each requested
percentile.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.plans.skew import running


def exact_percentiles(df: DataFrame, groups: Sequence[str], value: str,
                      ps: Mapping[str, float], max_rows: int | None = None,
                      extra: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per group with one column per entry of ``ps`` (name -> fraction).

    Linear interpolation between the two neighbouring ranks, as ``percentile``
    and SQL ``quantile_cont``. Null values are ignored (a group of nulls alone has null
    percentiles). ``extra`` aggregates (name -> Column) are evaluated over the value
    histogram of each group, whose columns are ``_v`` (a value, null included)
    and ``_c`` (its row count); e.g. ``F.sum("_c")`` counts rows and
    ``F.sum(F.col("_v") * F.col("_c"))`` sums values.

    Plan: (1) count rows per (group, value): ties collapse in the map-side
    partial aggregation; (2) one skew-safe pass in value order gives each
    distinct value its rank range and the group's size; (3) an aggregation keeps the
    values whose range holds a wanted rank. The input is read once, and no join is made.
    """
    groups = list(groups)
    keys = groups or ["_all"]
    hist = (df.withColumn("_all", F.lit(0)).groupBy(*keys, F.col(value).alias("_v"))
              .agg(F.count(F.lit(1)).alias("_c"))
              .withColumn("_w", F.when(F.col("_v").isNotNull(), F.col("_c")).otherwise(0)))
    ranked = running(hist, keys, ["_v"], {"_upto": ("sum", "_w"), "_n": ("total", "_w")}, max_rows=max_rows)
    picks, values = [], []
    for name, q in ps.items():
        h = (F.col("_n") - 1) * F.lit(float(q))
        for end, rank in (("lo", F.floor(h) + 1), ("hi", F.ceil(h) + 1)):
            holds = (F.col("_upto") - F.col("_w") < rank) & (rank <= F.col("_upto"))
            picks.append(F.max(F.when(holds, F.col("_v"))).alias(f"_{end}_{name}"))
        picks.append(F.max(h - F.floor(h)).alias(f"_f_{name}"))
        lo, hi = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        values.append((lo + (hi - lo) * F.col(f"_f_{name}")).alias(name))
    out = ranked.groupBy(*keys).agg(*picks, *[c.alias(n) for n, c in (extra or {}).items()])
    return out.select(*groups, *(extra or {}).keys(), *values)
