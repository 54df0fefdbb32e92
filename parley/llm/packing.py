"""Cost-balanced packing of token ids into sequences of a fixed size.

A document of n ids costs ``linear * n + quadratic * n**2``: the work on every token
and, as attention stays inside a document, the work on every pair of its tokens.
The documents of one input partition are taken in bounded groups. In a group

1. every document gives as many whole sequences as it fills, and one rest;
2. the rests together need ``total // size`` sequences of ``size`` ids, and the remainder as
   powers of two (binary digits), so nothing is padded;
3. the rests, longest first, go to the lowest-cost sequence that has room for them
   (``assign``); where none has, the rest is cut at the largest room and what is
   left of it takes its turn by its new length.

No row is shuffled: a group holds at most ``group_ids`` ids or ``group_docs`` documents
more than its last document, whatever source or key they share, and a lost
executor's partition is packed again in the same way. ``write_sequences`` writes one row a
sequence (part, ordinal, width, n_ids, cost, ids, members); ``read_pieces`` and
``read_sequences`` number the sequences over all parts and read them back.

Defined results: null or empty text is only its end id; every row is a document of its
own, also where rows repeat or share a doc_id; a null doc_id stays null; a very
long text fills whole sequences and leaves one rest; an empty table writes no
sequence; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.llm.common import give_back, shared_dir, text_of
from parley.llm.token_files import CALL_CHARS, _encoder

SIZE = 2048
END_ID = 1
#: Ids and documents after which a group is packed, and ids written in one batch of rows.
GROUP_IDS, GROUP_DOCS, BATCH_IDS = 1 << 21, 200_000, 1 << 19
#: A transformer layer of width d spends about 24 d**2 on a token and 4 d on a pair: 6 d n + n**2, here d = 1024.
LINEAR, QUADRATIC = 6144.0, 1.0
SEQUENCES = ("part int, ordinal int, width int, n_ids int, cost double, ids binary, "
             "members array<struct<doc_id: bigint, start: bigint, length: int, doc_tokens: bigint>>")


def assign(lengths: Sequence[int], size: int = SIZE, linear: float = LINEAR,
           quadratic: float = QUADRATIC) -> list[list[tuple[int, int, int]]]:
    """The sequences of one group, each a list of pieces (document number, start, length)."""
    out: list[list[tuple[int, int, int]]] = []
    rests = []
    for d, n in enumerate(lengths):
        out += [[(d, at, size)] for at in range(0, n - size + 1, size)]
        if n % size:
            rests.append((-(n % size), d, n - n % size))
    heapify(rests)
    total = -sum(r[0] for r in rests)
    rooms = [size] * (total // size) + [1 << b for b in reversed(range(size.bit_length())) if total % size >> b & 1]
    first = len(out)
    out += [[] for _ in rooms]
    full = [(-room, 0.0, q) for q, room in enumerate(rooms)]   # sequences too full for the longest rest, roomiest first
    heapify(full)
    ready: list[tuple[float, int]] = []                        # those with room for it, cheapest first
    while rests:
        n, d, at = heappop(rests)
        n = -n
        while full and -full[0][0] >= n:
            _, cost, q = heappop(full)
            heappush(ready, (cost, q))
        if ready:
            cost, q = heappop(ready)
            take = n
        else:
            room, cost, q = heappop(full)
            take = -room
            heappush(rests, (take - n, d, at + take))
        out[first + q].append((d, at, take))
        rooms[q] -= take
        if rooms[q]:
            heappush(full, (-rooms[q], cost + linear * take + quadratic * take * take, q))
    return out


class _Group:
    """Documents of one group until they are packed."""

    def __init__(self) -> None:
        self.doc_ids: list[int | None] = []
        self.ids: list[bytes] = []
        self.n_ids = 0

    def add(self, doc_id: int | None, ids: bytes, n: int) -> None:
        self.doc_ids.append(doc_id)
        self.ids.append(ids)
        self.n_ids += n

    def rows(self, part: int, ordinal: int, width: int, size: int, linear: float, quadratic: float) -> Iterator[pa.RecordBatch]:
        lengths = [len(x) // width for x in self.ids]
        sequences = assign(lengths, size, linear, quadratic)
        step = max(1, BATCH_IDS // size)
        for i in range(0, len(sequences), step):
            some = sequences[i:i + step]
            pieces = [p for s in some for p in s]
            counts = [len(s) for s in some]
            sizes = [sum(n for _, _, n in s) for s in some]
            cost = [sum(linear * n + quadratic * n * n for _, _, n in s) for s in some]
            data = [b"".join([self.ids[d][at * width:(at + n) * width] for d, at, n in s]) for s in some]
            members = pa.StructArray.from_arrays(
                [pa.array([self.doc_ids[d] for d, _, _ in pieces], pa.int64()), pa.array([at for _, at, _ in pieces], pa.int64()),
                 pa.array([n for _, _, n in pieces], pa.int32()), pa.array([lengths[d] for d, _, _ in pieces], pa.int64())],
                names=["doc_id", "start", "length", "doc_tokens"])
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * len(some), pa.int32()), pa.array(range(ordinal + i, ordinal + i + len(some)), pa.int32()),
                 pa.array([width] * len(some), pa.int32()), pa.array(sizes, pa.int32()), pa.array(cost, pa.float64()),
                 pa.array(data, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(np.cumsum([0, *counts]), pa.int32()), members)],
                names=["part", "ordinal", "width", "n_ids", "cost", "ids", "members"])


def write_sequences(docs: DataFrame, tokenizer: str, path: str | None = None, size: int = SIZE, end_id: int = END_ID,
                    linear: float = LINEAR, quadratic: float = QUADRATIC, pieces: bool = True,
                    group_ids: int = GROUP_IDS, group_docs: int = GROUP_DOCS) -> str:
    """Packs all documents into sequences of at most ``size`` ids; returns the folder they are written to.

    ``tokenizer`` is the path of a tokenizer file that every executor has; ``pieces`` as in
    ``token_files.Encoder``.
    """
    path = path or shared_dir(docs.sparkSession, "sequences")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, enc = TaskContext.get().partitionId(), _encoder(tokenizer, pieces)
        end = end_id.to_bytes(enc.width, "little")
        group, ordinal = _Group(), 0
        for batch in batches:
            names, at = batch.column("doc_id").to_pylist(), 0
            while at < len(names):
                texts, chars = [], 0
                while at + len(texts) < len(names) and chars < CALL_CHARS:
                    texts.append(batch.column("text")[at + len(texts)].as_py())
                    chars += len(texts[-1])
                for d, x in zip(names[at:], enc.encode(texts)):
                    group.add(d, x + end, len(x) // enc.width + 1)
                    if group.n_ids >= group_ids or len(group.ids) >= group_docs:
                        for rows in group.rows(part, ordinal, enc.width, size, linear, quadratic):
                            yield rows
                            ordinal += rows.num_rows
                        group = _Group()
                at += len(texts)
        yield from group.rows(part, ordinal, enc.width, size, linear, quadratic)
        del group
        give_back()

    (docs.select("doc_id", text_of().alias("text")).mapInArrow(pack, SEQUENCES).write.option("compression", "none")
     .option("parquet.enable.dictionary", "false").option("parquet.block.size", str(16 << 20)).parquet(path))
    return path


def _sequences(spark: SparkSession, path: str) -> tuple[DataFrame, dict[int, int]]:
    """The sequences, and the number of each part's first one (one number a partition)."""
    t = spark.read.schema(SEQUENCES).parquet(path)
    starts, total = {}, 0
    for r in sorted(t.groupBy("part").count().collect(), key=lambda r: r["part"]):
        starts[r["part"]] = total
        total += r["count"]
    return t, starts


def read_pieces(spark: SparkSession, path: str) -> DataFrame:
    """One row a piece: its document and place in it, the CRC-32 of its ids as u32, its sequence and place there."""
    t, starts = _sequences(spark, path)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            members = b.column("members")
            counts = np.diff(members.offsets.to_numpy())
            flat = members.flatten()
            lengths = flat.field("length").to_numpy().astype(np.int64)
            ends = np.cumsum(lengths)
            first = np.repeat(np.cumsum([0, *counts[:-1]]), counts)   # a piece's sequence begins at this piece
            offsets = ends - lengths - np.append(0, ends)[first]
            crc, k = [], 0
            for data, width, n in zip(b.column("ids"), b.column("width").to_pylist(), counts.tolist()):
                wide = memoryview(np.frombuffer(data.as_buffer(), dtype=f"<u{width}").astype("<u4").view("u1"))
                for at, length in zip(offsets[k:k + n].tolist(), lengths[k:k + n].tolist()):
                    crc.append(zlib.crc32(wide[4 * at:4 * (at + length)]))
                k += n
            number = np.array([starts[p] for p in b.column("part").to_pylist()], dtype=np.int64) + b.column("ordinal").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [flat.field("doc_id"), flat.field("start"), pa.array(lengths), pa.array(crc, pa.int64()),
                 flat.field("doc_tokens"), pa.array(np.repeat(number, counts)), pa.array(offsets)],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    return t.select("part", "ordinal", "width", "ids", "members").mapInArrow(
        read, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def read_sequences(spark: SparkSession, path: str) -> DataFrame:
    """sequence_id, cost and the ids of every sequence, from the files."""
    t, starts = _sequences(spark, path)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            number = [starts[p] + o for p, o in zip(b.column("part").to_pylist(), b.column("ordinal").to_pylist())]
            ids = [np.frombuffer(x.as_buffer(), dtype=f"<u{w}").astype(np.int32)
                   for x, w in zip(b.column("ids"), b.column("width").to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(number, pa.int64()), b.column("cost"), pa.array(ids, pa.list_(pa.int32()))],
                                             names=["sequence_id", "cost", "ids"])

    return t.select("part", "ordinal", "width", "cost", "ids").mapInArrow(
        read, "sequence_id long, cost double, ids array<int>")
