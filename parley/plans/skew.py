"""Skew-safe running aggregates.

A window ``partitionBy(key)`` sends every row of one key to one task. When a
single conversation, user or room holds a third of all rows, that task holds a
third of the data. ``running`` gives the same running count/sum/max/min as a
window ``partitionBy(keys).orderBy(order)`` frame up to the current row, and
``ordinal`` the same numbers as ``row_number()``, but cuts a heavy key into
slices of its order:

1. **Cuts.** Without a key that can hold two slices' worth of rows (the row count
   tells) the plan is the plain window. Otherwise a hash sample of the key and order
   columns, ``SAMPLES`` rows a slice, is ranked: a key with two or more slices' worth of
   sample rows is heavy and every slice's worth gives one cut. Cuts are whole order
   tuples in their own types, so ties, bursts at one instant, nulls and large
   integers are cut like anything else, and a null key is a key. There is at most
   one cut a slice, at most ``MAX_SLICES``, whatever the data's size; they are fixed in the
   plan, so a retried task cuts at the same places. The sample only places
   the cuts: any cuts give the same result.
2. **Slices.** A row's slice is the number of its key's cuts at or before it (a
   binary search). The window runs per (keys, slice): one hash shuffle, and no
   slice holds much more than total / ranges rows.
3. **Carries.** Totals per (heavy key, slice), combined over the earlier slices,
   are added to the slice's running values: at most two rows a cut. (``next``
   looks the other way: a slice's last row receives the first row of a later slice.)

The result does not depend on the slices. Nothing but the cuts reaches the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Sample rows a slice, and the most slices that heavy keys are cut into (bounds what the driver holds).
SAMPLES, MAX_SLICES = 20, 20_000
#: Rows a slice holds at least, unless the caller or ``parley.skew.maxGroupRows`` names another number.
MIN_SLICE_ROWS = 100_000
_CONF = "parley.skew.maxGroupRows"


def _cuts(df: DataFrame, keys: Sequence[str], order: Sequence[str], max_rows: int | None) -> DataFrame | None:
    """_k0.. (the keys), ``_cuts``: the sorted order tuples at which heavy keys are cut; None without a heavy key."""
    spark = df.sparkSession
    n = df.count()
    share = -(-n // int(spark.conf.get("spark.sql.shuffle.partitions")))
    target = max_rows or int(spark.conf.get(_CONF, "0")) or max(MIN_SLICE_ROWS, share)
    target = max(target, -(-n // MAX_SLICES))
    if n < 2 * target:
        return None
    part = min(1.0, SAMPLES / target)
    per = max(1, int(target * part))
    at = df.select(F.struct(*keys).alias("_key"), F.struct(*order).alias("_cut"))
    if part < 1:
        at = at.filter(F.pmod(F.xxhash64("_key", "_cut"), F.lit(1 << 40)) < int(part * (1 << 40)))
    # a bounded table from here on
    w = Window.partitionBy("_key")
    ranked = at.select("_key", "_cut", F.row_number().over(w.orderBy("_cut")).alias("_r"),
                       F.count(F.lit(1)).over(w).alias("_n"))
    cuts = (ranked.filter((F.col("_n") >= 2 * per) & (F.col("_r") > 1) & ((F.col("_r") - 1) % per == 0))
            .groupBy("_key").agg(F.array_sort(F.collect_set("_cut")).alias("_cuts")))
    rows = cuts.collect()
    if not rows:
        return None
    return spark.createDataFrame(rows, cuts.schema).select(
        *[F.col("_key")[c].alias(f"_k{i}") for i, c in enumerate(keys)], "_cuts")


def _slice(cuts: Column, row: Column, most: int) -> Column:
    """How many of the sorted ``cuts`` are at or before ``row``, by binary search; null without cuts."""
    steps = [1 << b for b in reversed(range(most.bit_length()))]
    return F.when(cuts.isNotNull(), F.aggregate(
        F.array(*[F.lit(s) for s in steps]), F.lit(0),
        lambda at, step: F.when(F.coalesce(F.get(cuts, at + step - 1) <= row, F.lit(False)), at + step).otherwise(at)))


def _frame(part: Sequence[str], order: Sequence[str], first: int, last: int):
    return Window.partitionBy(*part).orderBy(*order).rowsBetween(first, last)


class _Kind:
    """One running result: its value inside a slice, a slice's summary, what a slice receives, and the sum of both."""

    agg = {"count": F.count, "sum": F.sum, "max": F.max, "min": F.min, "total": F.sum}

    def __init__(self, fn: str, column: Column | str, order: Sequence[str]) -> None:
        self.fn, self.order = fn, order
        self.column = F.col(column) if isinstance(column, str) else column

    def own(self, part: Sequence[str]) -> Column:
        if self.fn == "next":       # in a struct, so that a null value differs from no next row
            return F.lead(F.struct(self.column.alias("v"))).over(Window.partitionBy(*part).orderBy(*self.order))
        if self.fn == "total":
            return F.sum(self.column).over(Window.partitionBy(*part))
        return self.agg[self.fn](self.column).over(_frame(part, self.order, Window.unboundedPreceding, Window.currentRow))

    def summary(self) -> Column:
        if self.fn == "next":
            return F.min_by(F.struct(self.column.alias("v")), F.struct(*self.order))
        return self.agg[self.fn](self.column)

    def received(self, summary: Column, keys: Sequence[str]) -> Column:
        if self.fn == "next":
            return F.first(summary, ignorenulls=True).over(_frame(keys, ["_slice"], 1, Window.unboundedFollowing))
        if self.fn == "total":
            return F.sum(summary).over(Window.partitionBy(*keys))
        combine = F.sum if self.fn == "count" else self.agg[self.fn]
        return combine(summary).over(_frame(keys, ["_slice"], Window.unboundedPreceding, -1))

    def both(self, own: Column, received: Column) -> Column:
        if self.fn == "next":
            return F.coalesce(own, received)["v"]
        if self.fn == "total":
            return F.coalesce(received, own)
        if self.fn in ("max", "min"):
            return (F.greatest if self.fn == "max" else F.least)(own, received)
        zero = F.lit(0)
        return F.when(own.isNotNull() | received.isNotNull(), F.coalesce(own, zero) + F.coalesce(received, zero))


def running(df: DataFrame, keys: Sequence[str], order: Sequence[str],
            aggs: Mapping[str, tuple[str, Column | str]], max_rows: int | None = None,
            like: DataFrame | None = None) -> DataFrame:
    """``df`` plus running results per key in ``order``.

    ``aggs`` maps an output name to (kind, column). ``count``, ``sum``, ``max`` and ``min`` equal
    ``agg(col).over(partitionBy(keys).orderBy(order).rowsBetween(unboundedPreceding,
    currentRow))``; ``total`` is the sum over the whole key, ``next`` the column's value in the
    next row (null in the last). ``order`` names columns that make rows unique within
    a key. ``max_rows``: rows a slice should hold at most (default: total / shuffle
    partitions, and at least ``MIN_SLICE_ROWS``). ``like``: cheaper rows with about the same
    keys and order to place the cuts by.
    """
    keys, order = list(keys), list(order)
    kinds = {name: _Kind(fn, c, order) for name, (fn, c) in aggs.items()}
    cols = [*df.columns, *[n for n in kinds if n not in df.columns]]
    cuts = _cuts(df if like is None else like, keys, order, max_rows)
    if cuts is None:
        for name, k in kinds.items():
            df = df.withColumn(name, k.own(keys)["v"] if k.fn == "next" else k.own(keys))
        return df.select(*cols)

    most = cuts.agg(F.max(F.size("_cuts"))).first()[0]
    same = [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(keys)]
    sliced = (df.join(F.broadcast(cuts), same, "left")     # at most ``MAX_SLICES`` cuts in all
                .withColumn("_slice", _slice(F.col("_cuts"), F.struct(*order), most))
                .drop("_cuts", *[f"_k{i}" for i in range(len(keys))]))
    own = sliced
    for name, k in kinds.items():
        own = own.withColumn(f"_own_{name}", k.own([*keys, "_slice"]))
    totals = (sliced.filter(F.col("_slice").isNotNull()).groupBy(*keys, "_slice")
                    .agg(*[k.summary().alias(f"_sum_{name}") for name, k in kinds.items()]))
    received = totals.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)], F.col("_slice").alias("_s"),
                             *[k.received(F.col(f"_sum_{name}"), keys).alias(f"_got_{name}") for name, k in kinds.items()])
    # at most two rows a cut
    out = own.join(F.broadcast(received), [*same, F.col("_slice") == F.col("_s")], "left")
    for name, k in kinds.items():
        out = out.withColumn(name, k.both(F.col(f"_own_{name}"), F.col(f"_got_{name}")))
    return out.select(*cols)


def ordinal(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "ordinal",
            max_rows: int | None = None) -> DataFrame:
    """``df`` plus ``out`` = 1-based position of each row within its key (skew-safe row_number)."""
    r = running(df, keys, order, {out: ("count", F.lit(1))}, max_rows=max_rows)
    return r.withColumn(out, F.col(out).cast("long"))
