"""Token ids as binary segments with Elias-Fano document boundaries.

``write_tokens`` deals the documents into ranges of doc_id, encodes them and writes
segments; ``read_index`` and ``read_documents`` give them back. A file is a Parquet file
of segment rows (part, ordinal, before, n_docs, n_ids, data), so it is written
and committed by Spark on any store and a lost executor's range is simply
written again. ``data`` is one binary segment:

=========== ==========================================================================
bytes       content
=========== ==========================================================================
16          ``PTOK``, version u16, id width in bytes u16, documents u32, null doc_ids u32
8           number of ids u64
variable    Elias-Fano list of doc_ids less the first one (i64 first), null ids excluded
variable    Elias-Fano list of document ends, counted in ids from the segment's start
rest        the ids, little-endian, every document followed by the end id
=========== ==========================================================================

An Elias-Fano list of n values below u keeps ``log2(u / n)`` low bits of each value packed
and the high parts in unary (one set bit a value): about ``2 + log2(u / n)`` bits a
value. Every ``SAMPLE``-th set bit's place is kept as u32, so ``select`` reads a
few bytes for one offset; no table of 64-bit offsets exists.

Within a part, ``before`` is the number of ids in its earlier segments; a part's
own start is the sum of the parts before it, at most one number a partition.

Defined results: null or empty text is only its end id; null doc_ids come last;
rows that repeat a doc_id stand together, ordered by text hash; an empty table
writes no segment; extra columns are ignored.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.llm.common import give_back, process_cache, shared_dir, text_of

END_ID = 0
SAMPLE = 256
#: Ids after which a segment is closed (a longer document makes a longer segment).
SEGMENT_IDS = 1 << 20
#: Pieces that a worker remembers (twice as many at most), and characters encoded in one call.
MEMO_PIECES, CALL_CHARS = 400_000, 1 << 20
SEGMENTS = "part int, ordinal int, before long, n_docs long, n_ids long, data binary"


class EliasFano:
    """A non-decreasing list of integers from 0 on, in about 2 + log2(u / n) bits each."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray) -> None:
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        v = np.asarray(values, dtype=np.uint64)
        n, u = len(v), int(v[-1]) + 1 if len(v) else 0
        bits = max(0, (u // n).bit_length() - 1) if n else 0
        low = np.zeros(0, dtype=np.uint8)
        if bits:
            planes = (v[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
            low = np.packbits(planes.astype(np.uint8).ravel(), bitorder="little")
        ones = (v >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        flags = np.zeros(int(ones[-1]) + 1 if n else 0, dtype=np.uint8)
        flags[ones] = 1
        return cls(n, bits, low, np.packbits(flags, bitorder="little"), ones[::SAMPLE].astype("<u4"))

    def select(self, i: int) -> int:
        """Value i, from its low bits and the place of the i-th set bit."""
        at = int(self.samples[i // SAMPLE])
        todo, byte = i % SAMPLE, at // 8
        word = int(self.high[byte]) >> (at % 8) << (at % 8)
        while (ones := word.bit_count()) <= todo:
            todo, byte = todo - ones, byte + 1
            word = int(self.high[byte])
        for _ in range(todo):
            word &= word - 1
        place = byte * 8 + (word & -word).bit_length() - 1
        low = 0
        for b in range(i * self.low_bits, (i + 1) * self.low_bits):
            low |= (int(self.low[b >> 3]) >> (b & 7) & 1) << (b - i * self.low_bits)
        return (place - i) << self.low_bits | low

    def values(self) -> np.ndarray:
        """All values at once."""
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[:self.n]
        out = (ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)
        if self.low_bits and self.n:
            planes = np.unpackbits(self.low, bitorder="little", count=self.n * self.low_bits).reshape(self.n, -1)
            out |= (planes.astype(np.uint64) << np.arange(self.low_bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
        return out.astype(np.int64)

    def to_bytes(self) -> bytes:
        return struct.pack("<IIQ", self.n, self.low_bits, len(self.high)) + b"".join(
            x.tobytes() for x in (self.low, self.high, self.samples))

    @classmethod
    def from_bytes(cls, data: bytes, at: int) -> tuple[EliasFano, int]:
        n, bits, n_high = struct.unpack_from("<IIQ", data, at)
        at += 16
        parts = []
        for count, kind in (((n * bits + 7) // 8, "u1"), (n_high, "u1"), (-(-n // SAMPLE), "<u4")):
            parts.append(np.frombuffer(data, dtype=kind, count=count, offset=at))
            at += parts[-1].nbytes
        return cls(n, bits, *parts), at


class Segment:
    """Reads one binary segment."""

    def __init__(self, data: bytes) -> None:
        magic, _, width, self.n_docs, self.n_null, n_ids = struct.unpack_from("<4sHHIIQ", data)
        if magic != b"PTOK":
            raise ValueError("not a token segment")
        (self.first,) = struct.unpack_from("<q", data, 24)
        names, at = EliasFano.from_bytes(data, 32)
        self.ends, at = EliasFano.from_bytes(data, at)
        self.doc_ids: list[int | None] = (names.values() + self.first).tolist() + [None] * self.n_null
        self.ids = np.frombuffer(data, dtype=f"<u{width}", count=n_ids, offset=at)

    def document(self, i: int) -> np.ndarray:
        """The ids of document i, end id included."""
        return self.ids[self.ends.select(i - 1) if i else 0:self.ends.select(i)]

    @staticmethod
    def build(doc_ids: list[int | None], ids: list[bytes], width: int) -> bytes:
        known = [d for d in doc_ids if d is not None]
        first = known[0] if known else 0
        ends = np.cumsum([len(x) // width for x in ids])
        return b"".join([
            struct.pack("<4sHHIIQ", b"PTOK", 1, width, len(doc_ids), len(doc_ids) - len(known), int(ends[-1])),
            struct.pack("<q", first), EliasFano.encode(np.array(known, dtype=np.int64) - first).to_bytes(),
            EliasFano.encode(ends).to_bytes(), *ids])


class Encoder:
    """Encodes whole texts with a ``tokenizers`` file; remembers the ids of pieces.

    A byte-level tokenizer never joins what stands on both sides of a single space
    between two non-space characters, the space going with the right side; nor a
    letter and a comma or full stop behind it. So a text is cut before its spaces, each
    new piece is encoded once, and the bytes of its ids are joined. New pieces are encoded
    many at a time, as one text that is cut again at the ids that begin with a space.
    Tokenizers that cut elsewhere get ``pieces=False``: whole texts.
    """

    SAFE_CUT = re.compile(r"(?<=\S)(?= \S)")

    def __init__(self, path: str, pieces: bool = True) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        vocabulary = self.tok.get_vocab()
        self.width = 2 if max(vocabulary.values()) < 1 << 16 else 4
        self.spaced = np.zeros(max(vocabulary.values()) + 1, dtype=bool)  # ids that begin with a space
        self.spaced[[i for t, i in vocabulary.items() if t.startswith("\u0120")]] = True
        self.pieces = pieces
        self.memo: dict[str, bytes | bool] = {}   # a piece less its space; False: its text must be cut with more care
        self.before: dict[str, bytes | bool] = {}
        self.marks = {c: self._alone(c) for c in ",."} if pieces else {}

    def _alone(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, dtype=f"<u{self.width}").tobytes()

    def _encode_new(self, new: list[str]) -> None:
        """Ids of pieces that neither begin nor end in white space, each behind one space."""
        done = self.tok.encode_batch_fast([" " + " ".join(new[i:i + 1000]) for i in range(0, len(new), 1000)],
                                          add_special_tokens=False)
        ids = np.concatenate([np.array(e.ids, dtype=f"<u{self.width}") for e in done])
        begins = np.flatnonzero(self.spaced[ids])
        if len(begins) != len(new):  # a piece that looks like a special token, say
            self.memo.update((p, self._alone(" " + p)) for p in new)
            return
        data, cuts = ids.tobytes(), [*(begins * self.width).tolist(), ids.nbytes]
        self.memo.update(zip(new, [data[a:b] for a, b in zip(cuts, cuts[1:])]))

    def _learn(self, new: set[str]) -> None:
        before, plain, marked, memo = self.before, [], [], self.memo
        for p in new:
            if p in before:
                memo[p] = before[p]
            elif p.isalpha():
                plain.append(p)
            elif not p or p[0].isspace() or p[-1].isspace():
                memo[p] = False  # white space in a row must stay together
            elif p[-1] in ",." and len(p) > 1 and p[-2].isalpha():
                marked.append(p)
            else:
                plain.append(p)
        plain += {p[:-1] for p in marked}.difference(plain).difference(memo)
        if plain:
            self._encode_new(plain)
        memo.update((p, memo[p[:-1]] + self.marks[p[-1]]) for p in marked)

    def _carefully(self, text: str) -> bytes:
        return b"".join(p[:1] == " " and self.memo.get(p[1:]) or self._alone(p) for p in self.SAFE_CUT.split(text))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian bytes, without an end id."""
        if not self.pieces:
            return [self._alone(t) for t in texts]
        if len(self.memo) > MEMO_PIECES:  # the older generation goes; what is still in use moves over
            self.before, self.memo = self.memo, {}
        cut = [t.split(" ") for t in texts]
        first = [c.pop(0) for c in cut]   # stands behind no space
        if new := set().union(*cut).difference(self.memo):
            self._learn(new)
        ids, out = self.memo.__getitem__, []
        for t, f, c in zip(texts, first, cut):
            try:
                out.append(self._carefully(t) if f[-1:].isspace() else self._alone(f) + b"".join(map(ids, c)))
            except TypeError:
                out.append(self._carefully(t))
        return out


def _encoder(path: str, pieces: bool) -> Encoder:
    cache = process_cache("token_files")
    if (path, pieces) not in cache:
        cache[path, pieces] = Encoder(path, pieces)
    return cache[path, pieces]


def write_tokens(docs: DataFrame, tokenizer: str, path: str | None = None, end_id: int = END_ID,
                 pieces: bool = True, segment_ids: int = SEGMENT_IDS) -> str:
    """Writes the ids of all documents in ascending doc_id order; returns the folder.

    ``tokenizer`` is the path of a tokenizer file that every executor has.
    """
    spark = docs.sparkSession
    path = path or shared_dir(spark, "token-files")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    t = docs.select("doc_id", text_of().alias("text"), F.xxhash64(F.monotonically_increasing_id()).alias("salt"))
    # cut inside a doc_id too: rows without an id, or with one id, may be a third of all
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text"), F.col("salt")]
    dealt = t.repartitionByRange(n, *order).sortWithinPartitions(*order).drop("salt")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, enc = TaskContext.get().partitionId(), _encoder(tokenizer, pieces)
        end = end_id.to_bytes(enc.width, "little")
        doc_ids, ids, size, ordinal, before = [], [], 0, 0, 0

        def segment() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(
                [{"part": part, "ordinal": ordinal, "before": before, "n_docs": len(doc_ids), "n_ids": size,
                  "data": Segment.build(doc_ids, ids, enc.width)}], schema=pa.schema(
                    [("part", pa.int32()), ("ordinal", pa.int32()), ("before", pa.int64()), ("n_docs", pa.int64()),
                     ("n_ids", pa.int64()), ("data", pa.binary())]))

        for batch in batches:
            names, at = batch.column("doc_id").to_pylist(), 0
            while at < len(names):
                texts, chars = [], 0
                while at + len(texts) < len(names) and chars < CALL_CHARS:
                    texts.append(batch.column("text")[at + len(texts)].as_py())
                    chars += len(texts[-1])
                for d, x in zip(names[at:], enc.encode(texts)):
                    doc_ids.append(d)
                    ids.append(x + end)
                    size += len(x) // enc.width + 1
                    if size >= segment_ids:
                        yield segment()
                        doc_ids, ids, size, ordinal, before = [], [], 0, ordinal + 1, before + size
                at += len(texts)
        if doc_ids:
            yield segment()
        doc_ids, ids = [], []
        give_back()

    (dealt.mapInArrow(encode, SEGMENTS).write.option("compression", "none")
     .option("parquet.enable.dictionary", "false").option("parquet.block.size", str(16 << 20)).parquet(path))
    return path


def _segments(spark: SparkSession, path: str) -> tuple[DataFrame, dict[int, int]]:
    """The segments, and each part's first place among all ids (one number a partition)."""
    seg = spark.read.schema(SEGMENTS).parquet(path)
    starts, total = {}, 0
    for r in sorted(seg.groupBy("part").agg(F.sum("n_ids").alias("n")).collect(), key=lambda r: r["part"]):
        starts[r["part"]] = total
        total += r["n"]
    return seg, starts


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and the CRC-32 of the ids as u32, from the files."""
    seg, starts = _segments(spark, path)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, before, data in zip(batch.column("part").to_pylist(), batch.column("before").to_pylist(),
                                          batch.column("data")):
                s = Segment(data.as_py())
                ends = np.array([s.ends.select(i) for i in range(s.n_docs)], dtype=np.int64)
                begins = np.concatenate([[0], ends[:-1]])
                wide = s.ids.astype("<u4")
                crc = [zlib.crc32(wide[a:b]) for a, b in zip(begins.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(s.doc_ids, pa.int64()), pa.array(begins + (starts[part] + before), pa.int64()),
                     pa.array(ends - begins, pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return seg.select("part", "before", "data").mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id and the ids of every document, from the files."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("data"):
                s = Segment(data.as_py())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(s.doc_ids, pa.int64()),
                     pa.array([s.document(i).astype(np.int32) for i in range(s.n_docs)], pa.list_(pa.int32()))],
                    names=["doc_id", "ids"])

    return _segments(spark, path)[0].select("data").mapInArrow(read, "doc_id long, ids array<int>")
