"""Helpers shared by the corpus operators: the shared folder, written tables, word classes."""

from __future__ import annotations

import ctypes
import sys
import tempfile
import types
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: White space as the contracts count it (space and the five control characters).
SPACE = r"[\x20\x09-\x0D]+"
#: Everything that is not a word character once A-Z is lower-cased.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Byte table for the same class on UTF-8: A-Z lower-cased, other non-word bytes become a space.
#: Bytes of 0x80 and above only occur inside non-ASCII characters, which are all word characters.
WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256))


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder under the cluster's shared folder (``spark.checkpoint.dir``).

    The setting is read from the session. Only a local master without it (tests)
    gets a temporary folder; on a cluster an unset value is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="parley-llm-")
    return f"{base.rstrip('/')}/parley-llm/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, lineage cut, safe against lost executors."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, groups: Sequence[str], order: Sequence[Column], salt: str | None = None,
             out: str = "rank") -> DataFrame:
    """``df`` plus 0-based positions per group, as a written table.

    Rows are range-partitioned by group and order, so a hot group lies in many partitions; a
    row's position is its place in its partition plus one number a (partition, group).
    ``salt`` names a column that may part rows equal in ``order`` between partitions.
    """
    by = [*[F.col(g) for g in groups], *order]
    dealt = [*by, F.col(salt)] if salt else by
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(n, *dealt).sortWithinPartitions(*dealt)
    t = written(placed.withColumns({"_part": F.spark_partition_id(),
                                    "_place": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}), "numbered")
    runs = t.groupBy("_part", *groups).agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(F.col("_part").alias("_p"), *[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)],
                       (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"))
    same = [F.col("_part") == F.col("_p"), *[F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(groups)]]
    return t.join(runs, same).select(*df.columns, (F.col("_place") + F.col("_shift")).alias(out))


def text_of(name: str = "text") -> Column:
    """The text, null taken as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def space_words(text: Column) -> Column:
    """Words between white space."""
    return F.array_remove(F.split(text, SPACE), "")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def give_back() -> None:
    """Returns the freed memory of this Python worker to the system.

    Workers wait for further tasks, and would keep the most they ever used.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def process_cache(name: str) -> dict:
    """A dictionary that lives as long as this Python worker, for all its tasks.

    Functions travel to the workers by value, so a module's own globals are new in every task.
    """
    home = sys.modules.setdefault("parley_llm_process_cache", types.ModuleType("parley_llm_process_cache"))
    return vars(home).setdefault(name, {})


def tokenizer_path(name: str) -> str:
    """The file of a public tokenizer installed beside Python."""
    import public_tokenizers
    return str(public_tokenizers.path(name))


def as_row(df: DataFrame) -> Column:
    """All columns as one struct named ``row``, so no name in it can clash with a name of ours."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")


def from_row(names: list[str]) -> list[Column]:
    """The columns of ``row`` again."""
    return [F.col("row").getField(c).alias(c) for c in names]
