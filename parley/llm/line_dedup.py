"""Line deduplication over the whole corpus by sorted line hashes.

1. ``line_table``: one row (h1, h2, doc_id, row_key, pos) per line whose key is long
   enough; h1, h2 are the 128 bits of XXH3 of the key. Written to the shared folder.
2. ``decide``: the table is range-partitioned by (hash, doc_id) and sorted by hash,
   doc_id descending, position. Each task streams its sorted rows once. The
   first document of a hash is the largest and keeps its lines. Rows of the next
   ones wait until the hash has shown ``min_docs`` documents (so at most
   ``min_docs`` documents wait), then they and all later rows are dropped.
   A hash that reaches a partition's edge may go on in the next partition:
   its rows are handed on undecided and settled from the (at most two)
   edge totals each partition contributes. So a line that a third of all
   documents share is spread over many tasks.
3. ``keep_bitmaps``: the dropped positions of each document as a compressed bitmap
   (bit 1: the line stays). Documents that lose nothing have no bitmap, and no
   text is shuffled up to here.
4. ``apply_bitmaps``: joins the bitmaps back and cuts the lines out.

Defined results: null or empty text is one empty line; a null doc_id counts as one
document and as the smallest; rows repeating a doc_id count as one document and
keep or lose the same lines, each by its own text (``row_key``); a key with
fewer documents than ``min_docs`` loses nothing; an empty table gives no rows;
extra columns stay in ``row`` of ``apply_bitmaps``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.common import as_row, text_of, written

STRIP = " \t\n\x0b\x0c\r"
MIN_CHARS = 40
MIN_DOCS = 5
LINES = "h1 long, h2 long, doc_id long, row_key long, pos int"


def line_key(line: str) -> str:
    """The line without white space at both ends; A-Z are lower-cased when it is hashed."""
    return line.strip(STRIP)


def _hashes(text: str, min_chars: int) -> tuple[list[int], list[bytes]]:
    at, keys = [], []
    for i, line in enumerate(text.split("\n")):
        if len(line) >= min_chars and len(key := line_key(line)) >= min_chars:
            at.append(i)
            keys.append(xxhash.xxh3_128_digest(key.encode().lower()))  # bytes.lower is ASCII only
    return at, keys


def with_row_key(docs: DataFrame) -> DataFrame:
    """doc_id, text (null as empty) and ``row_key``, the text's 64-bit hash."""
    return docs.select("doc_id", text_of().alias("text")).withColumn("row_key", F.xxhash64("text"))


def line_table(keyed: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """The rows of ``LINES`` for all lines with a key of at least ``min_chars`` code points."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, key, pos, h = [], [], [], []
            ids, keys = batch.column("doc_id").to_pylist(), batch.column("row_key").to_pylist()
            for d, k, text in zip(ids, keys, batch.column("text")):
                at, found = _hashes(text.as_py(), min_chars)
                doc += [d] * len(at)
                key += [k] * len(at)
                pos += at
                h += found
            pair = np.frombuffer(b"".join(h), dtype="<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(pair[:, 0]), pa.array(pair[:, 1]), pa.array(doc, pa.int64()), pa.array(key, pa.int64()),
                 pa.array(pos, pa.int32())], names=["h1", "h2", "doc_id", "row_key", "pos"])

    return keyed.select("doc_id", "row_key", "text").mapInArrow(scan, LINES)


def _stream(min_docs: int):
    """Over rows sorted by (h1, h2, doc_id descending, pos): the dropped rows, and the undecided rows of
    edge hashes. ``docs`` sums to the documents that the undecided rows of a partition stand for."""
    names = ["h1", "h2", "doc_id", "row_key", "pos", "edge", "docs"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.int32()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def flush() -> pa.RecordBatch:
            cols = list(zip(*out)) or [[]] * len(names)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

        hash_, doc, n_docs, left_edge = None, None, 0, False
        keeper: list[tuple] = []    # lines of the largest document
        waiting: list[tuple] = []   # lines of the next documents, until there are min_docs
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                new = (row[0], row[1]) != hash_
                if new:
                    left_edge = hash_ is None  # only the partition's first hash may have begun before
                    hash_, n_docs, keeper, waiting = (row[0], row[1]), 0, [], []
                new = new or row[2] != doc
                doc, n_docs = row[2], n_docs + new
                if left_edge:
                    out.append((*row, True, int(new)))
                elif n_docs == 1:
                    keeper.append(row)
                else:
                    waiting.append((*row, int(new)))
                    if n_docs >= min_docs:
                        out.extend((*w[:5], False, 0) for w in waiting)
                        waiting = []
            if len(out) >= 65536:
                yield flush()
        # the last hash may go on in the next partition
        if not left_edge:
            stands_for = n_docs if n_docs >= min_docs else 1
            out.extend((*r, True, stands_for if i == 0 else 0) for i, r in enumerate(keeper))
            out.extend((*w[:5], True, w[5]) for w in waiting)
        yield flush()

    return run


def decide(lines: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """The (doc_id, row_key, pos) of ``lines`` that are dropped."""
    n = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = (lines.repartitionByRange(n, "h1", "h2", F.col("doc_id").desc_nulls_last())
             .sortWithinPartitions("h1", "h2", F.col("doc_id").desc_nulls_last(), "row_key", "pos"))
    seen = written(dealt.mapInArrow(_stream(min_docs), LINES + ", edge boolean, docs int"), "line-decisions")
    edge = seen.filter("edge")
    # at most two hashes a partition reach an edge
    totals = (edge.groupBy("h1", "h2").agg(F.sum("docs").alias("n_docs"), F.max("doc_id").alias("last_doc"))
              .filter(F.col("n_docs") >= min_docs))
    settled = (edge.join(F.broadcast(totals), ["h1", "h2"])
               .filter(~F.col("doc_id").eqNullSafe(F.col("last_doc"))))
    return seen.filter("not edge").select("doc_id", "row_key", "pos").unionByName(
        settled.select("doc_id", "row_key", "pos"))


def encode_bitmap(dropped: np.ndarray) -> bytes:
    """Keep bits up to the last dropped line, packed and deflated; lines beyond stay."""
    bits = np.ones(int(dropped.max()) + 1, dtype=np.uint8)
    bits[dropped] = 0
    return zlib.compress(len(bits).to_bytes(4, "little") + np.packbits(bits).tobytes())


def decode_bitmap(data: bytes | None, n_lines: int) -> np.ndarray:
    keep = np.ones(n_lines, dtype=bool)
    if data is not None:
        raw = zlib.decompress(data)
        n = int.from_bytes(raw[:4], "little")
        keep[:n] = np.unpackbits(np.frombuffer(raw, dtype=np.uint8, offset=4), count=n).astype(bool)
    return keep


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """doc_id, row_key, n_dropped and the compressed keep bitmap of every document that loses lines."""
    dropped = decide(written(line_table(with_row_key(docs), min_chars), "lines"), min_docs)
    # positions of one document: bounded by its length (a repeated row names them again)
    grouped = dropped.groupBy("doc_id", "row_key").agg(F.collect_set("pos").alias("pos"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pos = [np.asarray(x, dtype=np.int64) for x in b.column("pos").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("row_key"), pa.array([len(x) for x in pos], pa.int64()),
                 pa.array([encode_bitmap(x) for x in pos], pa.binary())],
                names=["doc_id", "row_key", "n_dropped", "keep_bitmap"])

    return grouped.mapInArrow(pack, "doc_id long, row_key long, n_dropped long, keep_bitmap binary")


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``row`` (all columns of ``docs``), ``n_dropped`` and ``keep_bitmap`` (null: all lines stay)."""
    t = docs.select(as_row(docs))
    t = t.withColumn("key", F.xxhash64(F.coalesce(F.col("row")["text"], F.lit(""))))
    joined = t.join(bitmaps, t["row"]["doc_id"].eqNullSafe(bitmaps["doc_id"]) & (t["key"] == bitmaps["row_key"]), "left")
    return joined.select("row", F.coalesce("n_dropped", F.lit(0)).alias("n_dropped"), "keep_bitmap")


def kept_text(text: str | None, bitmap: bytes | None) -> tuple[int, str]:
    """Lines before dropping, and the lines that stay, joined."""
    lines = (text or "").split("\n")
    if bitmap is None:
        return len(lines), text or ""
    keep = decode_bitmap(bitmap, len(lines))
    return len(lines), "\n".join(x for x, k in zip(lines, keep) if k)
