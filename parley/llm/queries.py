"""Registered queries of the corpus operators: thin digests over whole tables."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.llm import (decontamination, host_rules, licences, line_dedup, lm_score, merkle, mixture, packing, quality, secrets,
                        simhash, spelling, token_files)
from parley.llm.common import table, tokenizer_path


def op1_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence places and labels of every document."""
    return licences.scan_licences(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component per document."""
    near = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return near.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digests of the secrets of every document."""
    s = secrets.scan_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda x: x["kind"].isin([r.kind for r in secrets.BASE_RULES]))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    def number(kind):
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return s.select("doc_id", *[number(r.kind) for r in secrets.BASE_RULES],
                    F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines before dropping, lines dropped and the hash of the remaining text per document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs)).select(
        "row.doc_id", "row.text", "n_dropped", "keep_bitmap")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            done = [line_dedup.kept_text(t.as_py(), m.as_py()) for t, m in zip(b.column("text"), b.column("keep_bitmap"))]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([n for n, _ in done], pa.int64()),
                 b.column("n_dropped"),
                 pa.array([hashlib.sha256(x.encode()).hexdigest() for _, x in done], pa.string())],
                names=["doc_id", "n_lines", "n_dropped", "kept_sha256"])

    return kept.mapInArrow(digest, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hit words and matched items per document."""
    d = decontamination.decontaminate(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                      table(spark, sf_dir, "benchmark"))
    leak = F.col("leak")
    return d.select("row.doc_id", leak["n_words"].alias("n_words"), leak["n_hit"].alias("n_hit"),
                    F.size(leak["items"]).cast("long").alias("n_items"),
                    F.sha2(F.array_join(leak["items"], ","), 256).alias("items_sha256"),
                    (leak["n_hit"] > 0).alias("contaminated"))


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stupid-backoff score of every document under the corpus' own counts."""
    s = lm_score.score(table(spark, sf_dir, "documents"))
    return s.select("doc_id", "n_words", "n_backoff", F.round("score", 6).alias("score"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibrated quality score of every document, learnt from the rows that are not held out."""
    f = quality.features(table(spark, sf_dir, "documents"))
    model = quality.train(f, table(spark, sf_dir, "labels"))
    t = f.select("doc_id", quality.is_held_out(F.col("doc_id")).alias("held_out"),
                 quality.score_column(model, F.col("f")).alias("score"))
    return t.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op8_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base verdict and final verdict per document."""
    return host_rules.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.coalesce("host_kept", F.lit(True)).alias("host_kept"))


def op9_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken of every document, beside its source's size and target."""
    c = mixture.rows_of(mixture.copies(table(spark, sf_dir, "documents")), "doc_id", "size", "source_size", "target")
    return c.withColumn("taken", F.col("taken") * F.col("size"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and checksum of every document's ids, read back from the files."""
    path = token_files.write_tokens(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
    return token_files.read_index(spark, path)


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document: its ids' checksum, its sequence and place there, read back from the files."""
    path = packing.write_sequences(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
    return packing.read_pieces(spark, path)


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frequent word with its near words, its more frequent form and the last form of its chain."""
    words = spelling.word_counts(table(spark, sf_dir, "documents"), lose_every=199)
    return spelling.groups(words.filter(F.col("n") >= spelling.LEAST_COUNT)).select("word", "form", "root", "n", "n_near", "form_n")


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots, proof and the root folded from the (sometimes tampered) leaf of every document."""
    return merkle.verify(table(spark, sf_dir, "documents"), F.crc32(F.col("doc_id").cast("string")) % 5 == 0)


QUERIES = {
    "op6_lm_score": op6_lm_score,
    "op1_licences": op1_licences,
    "op3_secrets": op3_secrets,
    "op7_quality": op7_quality,
    "op9_mixture": op9_mixture,
    "op10_token_files": op10_token_files,
    "op2_simhash": op2_simhash,
    "op4_line_dedup": op4_line_dedup,
    "op5_decontamination": op5_decontamination,
    "op8_host_rules": op8_host_rules,
    "op11_packing": op11_packing,
    "op12_spelling": op12_spelling,
    "op13_merkle": op13_merkle,
}
