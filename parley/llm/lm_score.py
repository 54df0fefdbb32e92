"""Language-model scores by stupid backoff, computed relationally.

The model is the corpus itself: counts of all n-grams up to ``order`` over all documents.
``S(w | context)`` is ``count(context w) / count(context)`` where the n-gram was seen at
least ``min_count`` times, else ``alpha`` times the score under the context less its first
word; at one word ``count(w) / words``. A document's score is its mean log score.

1. Rows are dealt into batches by a hash of their place in the input, so rows that repeat are spread;
   their texts travel compressed. A batch explodes its texts into n-gram hashes and keeps
   each distinct one with its count (so a word or pair that is everywhere leaves a batch once).
2. The distinct n-grams go to ``parts`` by the top bits of their hash, packed as one block
   for each (batch, part): about six bytes a hash (sorted, so only the gaps) and its count.
   A part is one hash partition of the count table: it adds up the counts of equal hashes.
3. The table joins back: each block is answered with the corpus counts of its n-grams.
4. A batch receives its answers beside its texts (the exchange of step 1 is reused),
   scores every word and sums per document.

Packed blocks stand for rows because one row per (batch, n-gram) costs about three times
the bytes. A batch is cut into at most ``fan`` blocks. With more batches than that, step 2 goes on in levels
(``answered``): the blocks that ``fan`` batches sent to one part are merged into what is one batch for the next, finer level,
and its answers come back the same way. So blocks grow with the input, not with its square, and
neither batches nor parts get larger; any ``fan`` gives the same scores. A level writes and moves all blocks once more,
so ``fan`` is as large as blocks of a few kilobytes allow.
A worker holds eight bytes for each n-gram of its batch or part: equal hashes are put together range by
range (``runs``), texts are hashed and scored chunk by chunk, and freed memory goes back to the system.
Hashes have at least 56 bits plus the part's; two n-grams that share one are counted together.

Defined results: words are lower-cased (A-Z); null or empty text has no words, log score 0 and
a null score; repeated rows count as often as they occur; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.common import WORD_BYTES, give_back, text_of, written

#: Words of an n-gram, discount of a backoff step, and the least count of an n-gram that is used.
ORDER, ALPHA, MIN_COUNT = 3, 0.4, 2
#: Blocks a batch is cut into, at most; a level of merging more for each further factor.
FAN = 8192
#: Words of the texts that are hashed or scored at once, and n-grams that are sorted at once, about.
CHUNK, RUN = 1 << 16, 1 << 19
_LOW = np.uint64((1 << 56) - 1)
_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _K2
    return x ^ (x >> np.uint64(29))


def word_hashes(text: str | None) -> np.ndarray:
    words = (text or "").encode().translate(WORD_BYTES).split()
    return np.array([xxhash.xxh64_intdigest(w) for w in words], dtype=np.uint64)


def chunked(texts: list[str]) -> Iterator[list[np.ndarray]]:
    """The words of the texts, so many texts together that they have ``CHUNK`` words."""
    docs, size = [], 0
    for text in texts:
        docs.append(word_hashes(text))
        size += len(docs[-1])
        if size >= CHUNK:
            yield docs
            docs, size = [], 0
    yield docs


def ends_of(n: np.ndarray, order: int) -> list[np.ndarray]:
    """For every order the words, of texts of ``n`` words, at which an n-gram ends."""
    place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)    # of a word in its text
    return [np.flatnonzero(place >= k) for k in range(order)]


def exploded(texts: list[str], order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The batch's n-grams: words of each text, by chunk; hashes of a chunk's words, then of its pairs and so on, chunk after chunk."""
    sizes, used = [], 0
    grams = np.empty(order * sum((len(t) + 1) // 2 for t in texts), dtype=np.uint64)    # at most; only what is filled takes memory
    for docs in chunked(texts):
        n = np.array([len(d) for d in docs], dtype=np.int64)
        words = np.concatenate([*docs, np.zeros(0, dtype=np.uint64)])
        h = words
        for k, ends in enumerate(ends_of(n, order), 1):
            if k > 1:
                h = np.concatenate([np.zeros(1, dtype=np.uint64), _mix(h[:-1] * _K1 + words[1:] + np.uint64(k))]) if len(h) else h
            grams[used:used + len(ends)] = _mix(h[ends] + np.uint64(k))
            used += len(ends)
        sizes.append(n)
    return sizes, grams[:used]


def runs(values: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """The values in ranges of about ``RUN``, in ascending order: the places of a range's values, its distinct values, sorted,
    the index there of each, and their counts. Places of earlier ranges may be overwritten meanwhile."""
    n = min(255, 1 + len(values) // RUN)
    sample = np.sort(values[::max(1, len(values) // (256 * n))])
    cuts = sample[np.arange(1, n) * len(sample) // n]
    run = np.empty(len(values), dtype=np.uint8)
    for a in range(0, len(values), RUN):
        run[a:a + RUN] = np.searchsorted(cuts, values[a:a + RUN], side="right")
    for r in range(n):
        at = np.flatnonzero(run == r)
        if len(at):
            yield at, *np.unique(values[at], return_inverse=True, return_counts=True)


def part_of(distinct: np.ndarray, parts: int, level: int = 0) -> np.ndarray:
    """The hash partition of each n-gram: by its top bits (sorted hashes give sorted parts), or by a hash of its own at finer levels."""
    bits = (_mix(distinct * _K1 + np.uint64(level)) if level else distinct) >> np.uint64(40)
    return (bits * np.uint64(parts) >> np.uint64(24)).astype(np.int64)


def pack(distinct: np.ndarray) -> bytes:
    """Sorted hashes by the gaps between them, modulo 2^56: the two high bytes of the gaps, mostly small, are compressed."""
    planes = (np.diff(distinct.astype("<u8"), prepend=np.uint64(0)) & _LOW).view(np.uint8).reshape(-1, 8).T
    return zlib.compress(planes[5:7].tobytes(), 1) + planes[:5].tobytes()


def unpack(data: bytes) -> np.ndarray:
    z = zlib.decompressobj()
    high = np.frombuffer(z.decompress(data), dtype=np.uint8).reshape(2, -1)
    gaps = np.zeros((high.shape[1], 8), dtype=np.uint8)
    gaps[:, 5:7], gaps[:, :5] = high.T, np.frombuffer(z.unused_data, dtype=np.uint8).reshape(5, -1).T
    return np.cumsum(gaps.view("<u8").ravel()) & _LOW


def squeeze(count: np.ndarray) -> bytes:
    """Counts of 64 bits, all first bytes before all second ones and so on: the high bytes, mostly zero, take next to nothing."""
    return zlib.compress(count.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def unsqueeze(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), dtype=np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<i8").ravel()


def log_scores(n: np.ndarray, counts: np.ndarray, alpha: float, min_count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per document: the sum of log scores without the corpus size, the words scored by their own
    count alone (each owes one log of the corpus size), and the backoff steps."""
    order, words = counts.shape
    total, level, steps = np.zeros(words), np.zeros(words, dtype=np.int64), np.zeros(words, dtype=np.int64)
    with np.errstate(divide="ignore"):
        logs = np.log(counts)
    for k in range(order, 1, -1):
        open_ = level == 0
        seen = open_ & (counts[k - 1] >= min_count)
        before = np.concatenate([[0.0], logs[k - 2][:-1]]) if words else logs[k - 2]   # of the context, one word back
        total[seen] = logs[k - 1][seen] - before[seen]
        level[seen] = k
        steps[open_ & ~seen & (counts[k - 1] > 0)] += 1
    single = level == 0
    total[single] = logs[0][single]
    total += steps * np.log(alpha)
    doc = np.repeat(np.arange(len(n)), n)
    return tuple(np.bincount(doc, weights=x, minlength=len(n)) for x in (total, single, steps))


BLOCKS, TOTALS = "part long, batch int, grams binary, counts binary", "batch int, part long, totals binary"


def unpacked(group: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The n-grams and counts of a group's blocks one after the other, and where each block begins and ends."""
    packed = [x.as_buffer() for x in group.column("grams")]
    grams, cuts = np.empty(sum(map(len, packed)) // 5, dtype=np.uint64), [0]    # an n-gram takes more than five bytes
    for x in packed:
        block = unpack(x)
        cuts.append(cuts[-1] + len(block))
        grams[cuts[-2]:cuts[-1]] = block
    counts = np.empty(cuts[-1], dtype=np.int64)
    for a, b, x in zip(cuts, cuts[1:], group.column("counts")):
        counts[a:b] = unsqueeze(x.as_buffer())
    return grams[:cuts[-1]], counts, np.array(cuts)


def totals_of(inverse: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
    total = np.zeros(n, dtype=np.int64)
    np.add.at(total, inverse, counts)
    return total


def added_up(group: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The blocks of a group together: distinct n-grams, sorted, with their counts; the place there of every
    n-gram of the blocks one after the other, and where each block begins and ends."""
    grams, counts, cuts = unpacked(group)
    distinct, total, place, n = [grams[:0]], [counts[:0]], counts, 0
    for at, values, inverse, _ in runs(grams):
        distinct.append(values)
        total.append(totals_of(inverse, counts[at], len(values)))
        place[at] = n + inverse    # these counts have been used
        n += len(values)
    return np.concatenate(distinct), np.concatenate(total), place, cuts


def cut_up(distinct: np.ndarray, count: np.ndarray, part: np.ndarray, parts: int, batch: int, first: int = 0) -> pa.Table:
    """Blocks of n-grams that lie in the order of their parts; part 0 is named ``first``."""
    cuts = np.searchsorted(part, np.arange(parts + 1))
    rows = [(p, a, b) for p, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
    return pa.table({"part": pa.array([first + p for p, _, _ in rows], pa.int64()),
                     "batch": pa.array([batch] * len(rows), pa.int32()),
                     "grams": pa.array([pack(distinct[a:b]) for _, a, b in rows], pa.binary()),
                     "counts": pa.array([squeeze(count[a:b]) for _, a, b in rows], pa.binary())})


def replies(group: pa.Table, total: np.ndarray, cuts: np.ndarray) -> pa.Table:
    """The totals of every block of a group; ``total``: of all its n-grams."""
    give_back()
    return pa.table({"batch": group.column("batch"), "part": group.column("part"),
                     "totals": pa.array([squeeze(total[a:b]) for a, b in zip(cuts, cuts[1:])], pa.binary())})


def answered(asked: DataFrame, batches: int, fan: int, level: int = 1) -> DataFrame:
    """batch, part, totals: the corpus counts of every block of ``asked``, whose parts each have blocks of up to ``batches`` batches."""
    if batches <= fan:
        def answers(group: pa.Table) -> pa.Table:
            """One hash partition of the count table: total counts, handed back block by block."""
            grams, counts, cuts = unpacked(group)
            for at, distinct, inverse, _ in runs(grams):
                counts[at] = totals_of(inverse, counts[at], len(distinct))[inverse]
            del grams
            return replies(group, counts, cuts)

        return asked.groupBy("part").applyInArrow(answers, TOTALS)

    teams = -(-batches // fan)
    parts = min(teams, fan)

    def merge(key: tuple, group: pa.Table) -> pa.Table:
        distinct, total, _, _ = added_up(group)
        part = part_of(distinct, parts, level)
        order = np.argsort(part, kind="stable")
        give_back()
        return cut_up(distinct[order], total[order], part[order], parts, key[1].as_py(), key[0].as_py() * fan)

    def hand_back(group: pa.Table, told: pa.Table) -> pa.Table:
        distinct, total, inverse, cuts = added_up(group)
        by_part = sorted(zip(told.column("finer").to_pylist(), told.column("totals").to_pylist()))
        total[np.argsort(part_of(distinct, parts, level), kind="stable")] = np.concatenate([unsqueeze(x) for _, x in by_part])
        return replies(group, total[inverse], cuts)

    asked = written(asked, "lm-blocks").withColumn("team", F.expr(f"cast(batch div {fan} as int)"))
    told = answered(asked.groupBy("part", "team").applyInArrow(merge, BLOCKS), teams, fan, level + 1)
    told = told.select(F.expr(f"part div {fan}").alias("part"), F.col("batch").alias("team"), F.col("part").alias("finer"), "totals")
    return asked.groupBy("part", "team").cogroup(told.groupBy("part", "team")).applyInArrow(hand_back, TOTALS)


def score(docs: DataFrame, order: int = ORDER, alpha: float = ALPHA, min_count: int = MIN_COUNT, fan: int = FAN) -> DataFrame:
    """doc_id, n_words, n_backoff (steps taken), log_score (sum of natural logs) and score (mean, null without words)."""
    n_batches = max(8, order * docs.rdd.getNumPartitions())    # a batch's n-grams are as many at any order
    parts = min(n_batches, fan)

    def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([zlib.compress(x.as_buffer(), 1) for x in b.column("text")], pa.binary()),
                                              b.column("batch")], names=["doc_id", "text", "batch"])

    at = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n_batches)).cast("int")
    t = (docs.select("doc_id", text_of().alias("text"), at.alias("batch")).mapInArrow(small, "doc_id long, text binary, batch int")
         .repartition(n_batches, "batch"))

    def texts_of(group: pa.Table) -> list[str]:
        return [zlib.decompress(x.as_buffer()).decode() for x in group.column("text")]

    def blocks(key: tuple, group: pa.Table) -> pa.Table:
        found = [(distinct, count) for _, distinct, _, count in runs(exploded(texts_of(group), order)[1])]
        distinct, count = (np.concatenate([np.zeros(0, dtype=t), *x]) for t, x in zip((np.uint64, np.int64), [*zip(*found)] or [(), ()]))
        del found
        give_back()
        return cut_up(distinct, count, part_of(distinct, parts), parts, key[0].as_py())

    def scores(texts: pa.Table, told: pa.Table) -> pa.Table:
        by_part = sorted(zip(told.column("part").to_pylist(), told.column("totals")), key=lambda x: x[0])
        totals = np.concatenate([np.zeros(0, dtype="<i8"), *(unsqueeze(x.as_buffer()) for _, x in by_part)])
        sizes, grams = exploded(texts_of(texts), order)
        counts, begin = grams.view(np.int64), 0
        for at, distinct, inverse, _ in runs(grams):
            counts[at] = totals[begin:begin + len(distinct)][inverse]
            begin += len(distinct)
        del totals
        done, begin = [], 0
        for n in sizes:
            by_order = np.zeros((order, n.sum()), dtype=np.int64)
            for k, ends in enumerate(ends_of(n, order)):
                by_order[k, ends] = counts[begin:begin + len(ends)]
                begin += len(ends)
            done.append(log_scores(n, by_order, alpha, min_count))
        n, base, singles, steps = (np.concatenate(x) for x in (sizes, *zip(*done)))
        del grams, counts
        give_back()
        return pa.table({"doc_id": texts.column("doc_id"), "n_words": pa.array(n, pa.int64()),
                         "n_backoff": pa.array(steps.astype(np.int64)), "base": pa.array(base, pa.float64()),
                         "n_single": pa.array(singles.astype(np.int64))})

    told = answered(t.groupBy("batch").applyInArrow(blocks, BLOCKS), n_batches, fan)
    done = written(t.groupBy("batch").cogroup(told.groupBy("batch")).applyInArrow(
        scores, "doc_id long, n_words long, n_backoff long, base double, n_single long"), "lm-scores")
    words = done.agg(F.sum("n_words")).first()[0] or 1
    log_score = F.col("base") - F.col("n_single") * F.log(F.lit(float(words)))
    return done.select("doc_id", "n_words", "n_backoff", log_score.alias("log_score"),
                       F.when(F.col("n_words") > 0, log_score / F.col("n_words")).alias("score"))
