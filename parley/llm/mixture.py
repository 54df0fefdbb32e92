"""Mixing sources to target weights by pivotal dependent rounding.

1. ``targets``: words wanted of every source. Weights repeat over the sources in code
   point order; a source gives at most ``max_copies`` times its words and the excess is
   shared again by weight until no target is above (each round an aggregate over
   the sources table).
2. Every document of a source wants the same expected copies, target / source size: a
   whole part, which it gets, and a fraction. ``m`` rows alike in doc_id, source and size together want
   ``m`` times the fraction: so many of them get one more copy (``extra``), and only the
   remainder, less than one document, is rounded to 0 or 1.
3. ``round_group``: pivotal rounding in one group. The largest undecided document and the
   pool of the smaller ones form the pair; mass (probability times words) moves between
   the two in a random direction, with odds that keep every expectation, until one side
   is integral. So the sum of the words is kept at every step, and what stays
   fractional at the end is one small document.
4. ``rounded``: groups are hash slices of a source with a bounded number of
   documents, so a source with a third of all rows is many groups. The one residual of
   each group goes on to the next level, ``FAN`` groups to one, until a source has one
   residual, which goes to the nearer side. Each level is a written table.

Draws come from a hash of seed, source, doc_id and size, so reruns agree.

Defined results: null or empty text has size 0, is never taken and weighs nothing; a null
source is a source of its own, last in order; of rows that repeat doc_id, source
and size, ``extra`` ones get one copy more than the others (in ``mixed`` those first by
the text's hash; which of several equal rows is not defined); a source of size 0 has target 0;
an empty table gives no rows; extra columns stay in ``mixed``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.llm.common import as_row, from_row, numbered, space_words, text_of, written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_COPIES = 2
#: Documents in a group of the first level, about; residuals that meet in a group of the next.
GROUP_ROWS = 50_000
FAN = 1024
SEED = 42


def size_of(text: Column) -> Column:
    return F.size(space_words(text)).cast("long")


def targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, max_copies: int = MAX_COPIES) -> DataFrame:
    """source, source_size, n_units, target, from the rows (doc_id, source, size, m)."""
    spark = sized.sparkSession
    sources = sized.groupBy("source").agg(F.sum(F.col("size") * F.col("m")).alias("source_size"),
                                          F.count(F.lit(1)).alias("n_units"))
    # position in code point order (UTF-8 order is the same), numbered partition by partition
    numbered = sources.orderBy(F.col("source").asc_nulls_last()).rdd.zipWithIndex().map(
        lambda x: (x[0]["source"], x[0]["source_size"], x[0]["n_units"], x[1]))
    t = spark.createDataFrame(numbered, T.StructType([
        T.StructField("source", sized.schema["source"].dataType), T.StructField("source_size", T.LongType()),
        T.StructField("n_units", T.LongType()), T.StructField("at", T.LongType())]))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("at") % len(weights) + 1).cast("int"))
    cap = (F.col("source_size") * max_copies).cast("double")
    t = written(t.select("source", "source_size", "n_units", w.alias("weight"), cap.alias("cap")), "mix-sources")
    total = share * (t.agg(F.sum("source_size")).first()[0] or 0)
    level, n_capped = 0.0, -1
    while True:
        over = F.col("weight") * level > F.col("cap")
        r = t.agg(F.count_if(over).alias("n"), F.sum(F.when(over, F.col("cap"))).alias("capped"),
                  F.sum(F.when(~over, F.col("weight"))).alias("free")).first()
        if r["n"] == n_capped or not r["free"]:
            break
        n_capped, level = r["n"], (total - (r["capped"] or 0.0)) / r["free"]
    return t.select("source", "source_size", "n_units", F.least("cap", F.col("weight") * level).alias("target"))


def round_group(mass: np.ndarray, p: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Pivotal rounding of one group, sorted by mass descending. Returns 0 or 1 for all but at most one entry.

    ``mass`` are words, ``p`` probabilities and ``u`` uniform draws. The pool's probabilities are
    kept as ``a * p + b``, so a transfer changes two numbers, whatever the pool's size.
    """
    out = np.array(p, dtype=float)
    n = len(out)
    pool_mass = np.concatenate([np.cumsum(mass[::-1])[::-1][1:], [0.0]])           # of the entries after i
    pool_start = np.concatenate([np.cumsum((mass * p)[::-1])[::-1][1:], [0.0]])
    a, b, eps = 1.0, 0.0, 1e-9
    for i in range(n):
        x, s = min(1.0, max(0.0, a * p[i] + b)), mass[i]
        if s <= 0:
            out[i] = 0.0
            continue
        if eps < x < 1 - eps:
            has = max(0.0, a * pool_start[i] + b * pool_mass[i])                   # words the pool can give
            room = max(0.0, pool_mass[i] - has)                                    # words the pool can take
            up, down = min(s * (1 - x), has), min(s * x, room)
            if up + down <= eps:
                out[i:] = np.where(mass[i:] > 0, np.round(np.clip(a * p[i:] + b, 0, 1)), 0.0)
                out[i] = x                                                         # nothing is left to pair with
                break
            if u[i] * (up + down) < down:
                x += up / s
                k = (has - up) / has if has > 0 else 1.0
                a, b = a * k, b * k
            else:
                x -= down / s
                k = (room - down) / room if room > 0 else 1.0
                a, b = a * k, 1 - (1 - b) * k
            if eps < x < 1 - eps:                                                  # the pool became integral instead
                full = 1.0 if pool_mass[i] > 0 and a * pool_start[i] + b * pool_mass[i] > pool_mass[i] / 2 else 0.0
                out[i + 1:] = np.where(mass[i + 1:] > 0, full, 0.0)
                out[i] = x
                break
        out[i] = x if eps < x < 1 - eps else round(x)
    return out


def _round_level(units: DataFrame, name: str) -> DataFrame:
    """One level: every (source, chunk) of ``units`` is rounded; ``p`` becomes 0, 1 or a residual."""
    fields = units.schema
    cols = units.columns
    dealt = units.repartition("source", "chunk").sortWithinPartitions(
        "source", "chunk", F.desc("size"), "doc_id")
    at = {c: cols.index(c) for c in cols}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None

        def rows():
            nonlocal schema
            for batch in batches:
                schema = batch.schema
                yield from zip(*(c.to_pylist() for c in batch.columns))

        for _, group in groupby(rows(), key=lambda r: (r[at["source"]], r[at["chunk"]])):
            group = list(zip(*group))
            mass = np.array(group[at["size"]], dtype=float)
            group[at["p"]] = round_group(mass, np.array(group[at["p"]]), np.array(group[at["u"]])).tolist()
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(group, schema)], schema=schema)

    return written(dealt.mapInArrow(run, fields), name)


def rounded(units: DataFrame, group_rows: int = GROUP_ROWS, fan: int = FAN) -> DataFrame:
    """``units`` (doc_id, source, size, n_units, p, u) with every fraction ``p``, of one document each, rounded to 0 or 1."""
    undecided = (F.col("p") > 0) & (F.col("p") < 1)
    chunks = F.greatest(F.lit(1), F.ceil(F.col("n_units") / group_rows)).cast("long")
    level = units.withColumn("chunk", F.pmod(F.xxhash64(F.col("u"), F.col("doc_id")), chunks))
    done = [level.filter(~undecided)]
    level, depth = level.filter(undecided), 0
    most = units.agg(F.max(chunks)).first()[0] or 1
    while True:
        depth += 1
        level = _round_level(level, f"mix-level-{depth}")
        done.append(level.filter(~undecided))
        level = level.filter(undecided)
        if most <= 1:
            break
        most = -(-most // fan)
        level = level.withColumn("chunk", F.floor(F.col("chunk") / fan))
    # one residual a source: to the nearer side, so the source ends within half a document of its target
    done.append(level.withColumn("p", F.round("p")))
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.drop("chunk")


def copies(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, max_copies: int = MAX_COPIES, seed: int = SEED,
           group_rows: int = GROUP_ROWS, fan: int = FAN) -> DataFrame:
    """doc_id, source, size, m (rows alike), source_size, target, whole (copies of each of the m rows), extra (how many
    of them get one more) and copies (their mean)."""
    sized = docs.select("doc_id", "source", size_of(text_of()).alias("size"))
    units = written(sized.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("m")), "mix-units")
    goal = targets(units, weights, share, max_copies).withColumnRenamed("source", "of_source")
    t = units.join(goal, units["source"].eqNullSafe(goal["of_source"])).drop("of_source")
    want = F.when(F.col("source_size") > 0, F.least(F.lit(float(max_copies)), F.col("target") / F.col("source_size"))
                  ).otherwise(0.0)
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "source", "doc_id", "size"), 11) / F.lit(float(1 << 53))
    t = t.withColumn("want", want).withColumn("whole", F.floor("want"))
    t = t.withColumn("share", F.col("m") * (F.col("want") - F.col("whole"))).withColumn("sure", F.floor("share"))
    t = t.withColumn("p", F.col("share") - F.col("sure")).withColumn("u", draw).drop("want", "share")
    done = rounded(t, group_rows, fan)
    taken = lambda c: F.when(F.col("size") > 0, c).otherwise(F.lit(0)).cast("long")
    done = done.withColumns({"whole": taken(F.col("whole")), "extra": taken(F.col("sure") + F.round("p"))})
    return done.select("doc_id", "source", "size", "m", "source_size", "target", "whole", "extra",
                       (F.col("whole") + F.col("extra") / F.col("m")).alias("copies"))


def rows_of(c: DataFrame, *names: str) -> DataFrame:
    """One row for each of the ``m`` rows of a unit, with its copies (``taken``). Units of many rows are dealt out first."""
    block = 10_000
    many = c.filter(F.col("m") > block).withColumn("first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1, F.lit(block).cast("long"))))
    many = many.repartition(int(c.sparkSession.conf.get("spark.sql.shuffle.partitions")), "doc_id", "source", "size", "first")
    both = c.filter(F.col("m") <= block).withColumn("first", F.lit(0).cast("long")).unionByName(many)
    row = F.explode(F.sequence(F.col("first") + 1, F.least(F.col("first") + block, F.col("m"))))
    return both.withColumn("row", row).select(*names, (F.col("whole") + (F.col("row") <= F.col("extra")).cast("long")).alias("taken"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """``docs`` (all columns), every row as often as the mix takes it."""
    c = copies(docs, **options).filter("copies > 0").select(
        F.col("doc_id").alias("k_id"), F.col("source").alias("k_source"), F.col("size").alias("k_size"), "whole", "extra", "m")
    t = docs.select(as_row(docs), size_of(text_of()).alias("size"))
    t = t.join(c, t["row"]["doc_id"].eqNullSafe(c["k_id"]) & t["row"]["source"].eqNullSafe(c["k_source"])
               & (t["size"] == c["k_size"]))
    cols = ["row", "whole"]
    alike = t.filter((F.col("extra") < F.col("m")) & (F.col("extra") > 0))
    t = t.filter((F.col("extra") == F.col("m")) | (F.col("extra") == 0)).select(
        *cols, (F.col("whole") + (F.col("extra") > 0).cast("long")).alias("taken"))
    if not c.filter((F.col("extra") < F.col("m")) & (F.col("extra") > 0)).isEmpty():
        # some, not all, of the rows alike get one more copy: they are numbered, range by range
        alike = alike.select(*cols, "extra", "k_id", "k_source", "k_size", F.xxhash64("row.text").alias("_text"),
                             F.xxhash64(F.monotonically_increasing_id()).alias("_salt"))
        alike = numbered(alike, ["k_id", "k_source", "k_size"], [F.col("_text")], salt="_salt", out="_at")
        t = t.unionByName(alike.select(*cols, (F.col("whole") + (F.col("_at") < F.col("extra")).cast("long")).alias("taken")))
    return t.filter("taken > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("taken").cast("int"))).alias("copy")).select(
        *from_row(docs.columns))
