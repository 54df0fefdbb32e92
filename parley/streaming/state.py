"""Keyed state of a stream as a log of deltas and versions of a base.

``KeyedState`` stores one row a key without rewriting what a batch did not touch:

=============================== ==============================================================
folder                          content
=============================== ==============================================================
``delta/batch_id=N/bucket=B``   the rows of the keys that batch N changed
``base/upto=N/bucket=B``        one row a key: the state after batch N
=============================== ==============================================================

A base counts once Spark has committed it (its ``_SUCCESS`` file, written last): readers take the newest
committed base and the deltas behind it, so while ``compact`` runs, or after it failed halfway, they see the old
version, then the new one, never a mixture. What a base replaces stays for one more compaction,
for readers that began before it. A retried batch replaces its own delta folder. ``bucket`` is a hash
of the leading keys, so a batch that touches few of them reads few partitions.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern, on any file system."""
    at = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at)
    return [str(s.getPath().toString()) for s in found or []]


def drop_folder(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


class KeyedState:
    """The latest row of every key, by ``order`` (default: the batch that wrote it)."""

    def __init__(self, spark: SparkSession, path: str, schema: str | T.StructType, keys: Sequence[str],
                 order: Sequence[str] = (), buckets: int = 64, bucket_keys: Sequence[str] = ()) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.schema = spark.createDataFrame([], schema).schema
        self.keys, self.order, self.buckets = list(keys), list(order), buckets
        self.bucket_keys = list(bucket_keys) or self.keys[:1]

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.bucket_keys), F.lit(self.buckets)).cast("int")

    def append(self, rows: DataFrame, batch_id: int) -> None:
        """The rows (one a key) that batch ``batch_id`` leaves for the keys it touched."""
        (rows.select(*self.schema.names).withColumn("bucket", self.bucket())
             .write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/delta/batch_id={batch_id}"))

    def versions(self) -> list[int]:
        """Batches up to which a committed base exists, in order."""
        found = folders(self.spark, f"{self.path}/base/upto=*/_SUCCESS")
        return sorted(int(p.split("upto=")[1].split("/")[0]) for p in found)

    def _deltas(self) -> list[int]:
        return sorted(int(p.rsplit("=", 1)[1]) for p in folders(self.spark, f"{self.path}/delta/batch_id=*"))

    def read(self, upto: int | None = None, touched: DataFrame | None = None) -> DataFrame:
        """One row a key after batch ``upto`` (default: the last one); ``touched``: rows with the bucket keys
        that are of interest (only their buckets are read, and only their keys returned)."""
        parts = []
        only = None
        if touched is not None:
            only = [r[0] for r in touched.select(self.bucket()).distinct().collect()]   # at most ``buckets`` numbers
        wide = T.StructType([*self.schema.fields, T.StructField("bucket", T.IntegerType())])
        base = max((v for v in self.versions() if upto is None or v <= upto), default=-1)
        at = [(f"{self.path}/base/upto={base}", base)] if base >= 0 else []
        at += [(f"{self.path}/delta/batch_id={b}", b) for b in self._deltas() if b > base and (upto is None or b <= upto)]
        for folder, batch in at:
            t = self.spark.read.schema(wide).parquet(folder)
            if only is not None:
                t = t.filter(F.col("bucket").isin(only))
            parts.append(t.drop("bucket").withColumn("_batch", F.lit(batch).cast("long")))
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        rows = parts[0]
        for p in parts[1:]:
            rows = rows.unionByName(p)
        rest = [c for c in self.schema.names if c not in self.keys]
        latest = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*rest), F.struct(*self.order, "_batch")).alias("_v"))
        out = latest.select(*self.keys, *[F.col(f"_v.{c}").alias(c) for c in rest]).select(*self.schema.names)
        if touched is not None:
            named = touched.select(*[F.col(k).alias(f"_t{i}") for i, k in enumerate(self.bucket_keys)]).distinct()
            same = [F.col(k).eqNullSafe(F.col(f"_t{i}")) for i, k in enumerate(self.bucket_keys)]
            out = out.join(named, same, "left_semi")
        return out

    def compact(self, upto: int) -> None:
        """Writes the state after batch ``upto`` as a new base. Batches up to ``upto`` must be finished."""
        versions = self.versions()
        if upto in versions:
            return
        (self.read(upto).withColumn("bucket", self.bucket()).repartition("bucket")
             .write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/base/upto={upto}"))
        kept = max((v for v in versions if v < upto), default=None)     # older readers may still need this one
        if kept is not None:
            for v in versions:
                if v < kept:
                    drop_folder(self.spark, f"{self.path}/base/upto={v}")
            for b in self._deltas():
                if b <= kept:
                    drop_folder(self.spark, f"{self.path}/delta/batch_id={b}")

    def sink(self, compact_every: int = 20) -> Callable[[DataFrame, int], None]:
        """``foreachBatch`` function: stores each micro-batch's updated rows, and a base every so many batches."""
        def run(df: DataFrame, batch_id: int) -> None:
            self.append(df, batch_id)
            if batch_id and batch_id % compact_every == 0:
                self.compact(batch_id - 1)      # the batch before this one cannot be retried any more
        return run
