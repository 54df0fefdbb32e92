"""Tables laid out for key lookups and for changes of a few keys.

``write_lookup`` sorts a table by one key over its files and adds Parquet Bloom filters for others, so a
lookup of a few keys (P2, P3) skips the row groups that cannot hold them.

``write_buckets`` keeps a snapshot in hash buckets of its key (one folder each). ``change_buckets`` runs
an operator of M1-M6 on the buckets that a change set touches, and rewrites those only; the other folders stay as
they are.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.streaming.state import drop_folder


def write_lookup(df: DataFrame, path: str, sort: str, blooms: Sequence[str] = (), files: int | None = None,
                 group_bytes: int = 128 << 20, distinct: int = 1_000_000) -> None:
    """Writes ``df`` sorted by ``sort`` across files, with Bloom filters on ``blooms``.

    ``distinct``: different values that a filter is sized for in a row group of ``group_bytes``.
    """
    n = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    w = df.repartitionByRange(n, sort).sortWithinPartitions(sort).write.option("parquet.block.size", str(group_bytes))
    for c in blooms:
        w = w.option(f"parquet.bloom.filter.enabled#{c}", "true").option(f"parquet.bloom.filter.expected.ndv#{c}", str(distinct))
    w.parquet(path)


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def write_buckets(df: DataFrame, path: str, key: str, buckets: int = 256) -> None:
    """Writes a whole snapshot as ``path/bucket=B`` folders."""
    (df.withColumn("bucket", bucket_of(key, buckets)).repartition("bucket")
       .write.mode("overwrite").partitionBy("bucket").parquet(path))


def load_buckets(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("bucket")


def change_buckets(spark: SparkSession, path: str, key: str, touched: DataFrame,
                   change: Callable[[DataFrame, DataFrame], DataFrame], buckets: int = 256) -> list[int]:
    """Replaces the buckets of the keys in ``touched`` (its column ``key``) by ``change(rows, everyone)``.

    ``rows`` are the touched buckets' rows, ``everyone`` the whole table (read where an operator compares with all, as
    for taken emails). The result may hold new keys, which must be among ``touched``. Returns the rewritten buckets,
    at most ``buckets`` numbers. Spark replaces the folders when all their files are written; a run
    that failed is run again with the same change set.
    """
    names = sorted(r[0] for r in touched.select(bucket_of(key, buckets)).distinct().collect())
    if not names:
        return []
    table = spark.read.parquet(path)
    rows = table.filter(F.col("bucket").isin(names)).drop("bucket")
    after = change(rows, table.drop("bucket")).withColumn("bucket", bucket_of(key, buckets))
    # which buckets keep rows is asked before the folders change
    left = {r[0] for r in after.select("bucket").distinct().collect()}
    (after.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
          .partitionBy("bucket").parquet(path))
    for b in set(names) - left:            # every row went: nothing replaced the folder
        drop_folder(spark, f"{path.rstrip('/')}/bucket={b}")
    return names
