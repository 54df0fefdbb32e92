"""The corpus pipeline over ``documents``: judge, deduplicate, decontaminate, mix, tokenize.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame, which is written as Parquet and reread as the next one's docs. All
but the last return the columns of ``documents``. Edge cases (nulls, empty and very long
texts, ties, repeated rows, empty tables, extra columns) have the results
that the operators' modules define; extra columns pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.llm import decontamination, mixture, quality, simhash, token_files
from parley.llm.common import from_row, shared_dir, table, tokenizer_path

#: SQL has neither XXH64 nor a tokenizer; ``tests/llm`` holds a brute-force version.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject (score of at least 0.5)."""
    return quality.scored(docs, table(spark, sf_dir, "labels")).filter(F.col("score") >= 0.5).select(
        *from_row(docs.columns))


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest doc_id."""
    return simhash.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark")).filter("leak.n_hit = 0").select(
        *from_row(docs.columns))


def mixture_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the source mixture takes them."""
    return mixture.mixed(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The corpus as token files, and every document's place in them."""
    return token_files.read_index(spark, token_files.write_tokens(docs, tokenizer_path("byte_bpe_50k.json")))


STAGES = [
    ("quality classifier", quality_stage),
    ("simhash near-dedup", simhash_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing sources to target weights", mixture_stage),
    ("token-id output", token_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies every stage to ``documents`` of ``sf_dir``; returns the last stage's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_dir(spark, "pipeline-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
