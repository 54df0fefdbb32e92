"""Quality classifier: random Fourier features, ridge scores, isotonic calibration.

1. ``features``: a few statistics of every whole text (shares of words, bytes and
   lines). Ids, languages, sources and labels are never among them.
2. ``fit``: the statistics are standardised and mapped to ``cos(xW + b)``, whose inner
   products approximate a Gaussian kernel (Rahimi and Recht 2007). Each partition sums its
   normal equations; a tree of partitions adds the sums up, so the driver gets
   one D x D matrix a fold at any number of rows. One matrix per fold: the whole
   fit uses their sum, and scoring each fold with the other's fit gives
   out-of-fold scores.
3. Isotonic calibration (pool adjacent violators) of the out-of-fold scores, which are first
   counted in ``BINS`` score bins.
4. ``score_column``: calibrated scores for any texts.

All labelled rows given to ``fit`` are used; there is no sample.

Defined results: null or empty text has all-zero statistics and is scored like any
other; labels that are null or have no document are ignored, repeated labels count as
often as they occur; without any label every score is 0.5 (predicted 1); ties score
alike; an empty table gives no rows; extra columns stay in ``scored``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.common import as_row, give_back, text_of, written

#: Random features, kernel width (in standard deviations), ridge penalty per row, calibration bins.
DIM, WIDTH, RIDGE, BINS = 256, 3.0, 1e-4, 2000
SEED = 7
#: Labelled rows whose normal equations one task sums, and partial sums that one task adds up.
ROWS_PER_TASK, FAN = 20_000, 16
N_STATS = 13


def statistics(text: str | None) -> list[float]:
    """The document statistics: lengths, repetition, and shares of byte classes."""
    data = (text or "").encode()
    words = data.split()
    n = len(words)
    if not n:
        return [0.0] * N_STATS
    count = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    lines = [x for x in data.split(b"\n") if x.strip()]
    repeats = sum(map(bytes.__eq__, words, words[1:]))
    size, letters = len(data), int(count[65:91].sum() + count[97:123].sum()) + 1
    of = lambda chars: int(count[list(chars)].sum())
    return [np.log1p(n), min(20.0, size / n), len(set(words)) / n ** 0.9, repeats / n,
            np.sqrt(of(b"#*$%&<>") / n), np.sqrt(of(b"|") / n), np.sqrt(of(b"!") / n), of(range(65, 91)) / letters,
            np.sqrt(of(range(48, 58)) / size), 1 - len(set(lines)) / max(1, len(lines)),
            int(count[128:].sum()) / size, of(b".,;:?") / n, np.log1p(len(lines)) / np.log1p(n)]


def statistics_column(text: Column) -> Column:
    @F.arrow_udf("array<float>")
    def stats(texts: pa.Array) -> pa.Array:
        out = pa.array([statistics(t.as_py()) for t in texts], pa.list_(pa.float32()))
        give_back()
        return out

    return stats(text)


@dataclass
class Model:
    """Everything scoring needs; a few thousand numbers."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray      # of the ridge fit
    knots: np.ndarray        # raw scores and their calibrated values
    values: np.ndarray
    seed: int = SEED

    def lift(self, x: np.ndarray) -> np.ndarray:
        return _lift(x, self.mean, self.scale, self.seed)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated scores; the raw score breaks ties inside a flat step."""
        if not len(self.knots):
            return np.full(len(x), 0.5)
        raw = self.lift(x) @ self.weights
        return (np.interp(raw, self.knots, self.values) + 1e-3 * np.clip(raw, 0, 1)) / (1 + 1e-3)


def _lift(x: np.ndarray, mean: np.ndarray, scale: np.ndarray, seed: int) -> np.ndarray:
    """Random Fourier features of the standardised statistics, and a constant."""
    rng = np.random.default_rng(seed)
    w, b = rng.normal(0, 1 / WIDTH, (len(mean), DIM)), rng.uniform(0, 2 * np.pi, DIM)
    z = np.clip((x - mean) / scale, -6, 6)
    return np.hstack([np.sqrt(2 / DIM) * np.cos(z @ w + b), np.ones((len(x), 1))])


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators; returns each block's mean x and value."""
    blocks: list[list[float]] = []   # weight, sum of w*x, sum of w*y
    for a, b, c in zip(x, y, w):
        blocks.append([c, a * c, b * c])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][0] >= blocks[-1][2] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last)]
    b = np.array(blocks)
    return b[:, 1] / b[:, 0], b[:, 2] / b[:, 0]


def _matrix(batch: pa.RecordBatch, name: str = "f") -> np.ndarray:
    flat = batch.column(name).flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(batch.num_rows, N_STATS)


def _sum_partitions(parts: DataFrame, n: int) -> list[np.ndarray]:
    """Adds up the (fold, data) rows of ``n`` partitions in a tree; one matrix per fold reaches the driver."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for fold, data in zip(batch.column("fold").to_pylist(), batch.column("data")):
                total[fold] = total.get(fold, 0) + np.frombuffer(data.as_py())
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(
            [x.tobytes() for x in total.values()], pa.binary())], names=["fold", "data"])

    while n > 1:
        n = -(-n // FAN)
        parts = parts.repartition(n).mapInArrow(add, "fold int, data binary")
    out = [np.zeros((DIM + 1) * (DIM + 2)) for _ in range(2)]
    for r in parts.collect():
        out[r["fold"]] += np.frombuffer(r["data"])
    return [x.reshape(DIM + 1, DIM + 2) for x in out]


def fit(rows: DataFrame, seed: int = SEED) -> Model:
    """The model of labelled rows (doc_id, f, label 0 or 1)."""
    rows = written(rows.select("doc_id", "f", F.col("label").cast("double").alias("label"),
                               F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int").alias("fold")), "quality-rows")
    stats = [f(F.get("f", F.lit(i))) for i in range(N_STATS) for f in (F.avg, F.stddev_pop)]
    n, *moments = rows.agg(F.count(F.lit(1)), *stats).first()
    empty = np.zeros(0)
    if not n:
        return Model(np.zeros(N_STATS), np.ones(N_STATS), empty, empty, empty, seed)
    mean = np.array(moments[::2], dtype=float)
    scale = np.maximum(np.array(moments[1::2], dtype=float), 1e-3)

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, DIM + 1, DIM + 2))
        for batch in batches:
            z, y = _lift(_matrix(batch), mean, scale, seed), batch.column("label").to_numpy()
            fold = batch.column("fold").to_numpy()
            for k in (0, 1):
                total[k] += z[fold == k].T @ np.column_stack([z[fold == k], y[fold == k]])
        yield pa.RecordBatch.from_arrays([pa.array([0, 1], pa.int32()), pa.array([x.tobytes() for x in total])],
                                         names=["fold", "data"])

    tasks = max(1, -(-n // ROWS_PER_TASK))
    sums = _sum_partitions(rows.repartition(tasks).mapInArrow(equations, "fold int, data binary"), tasks)

    def solve(s: np.ndarray) -> np.ndarray:
        return np.linalg.solve(s[:, :-1] + np.eye(DIM + 1) * max(1e-2, RIDGE * n), s[:, -1])

    other = [solve(sums[1]), solve(sums[0])]  # each fold is scored by the other's fit

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z, fold = _lift(_matrix(batch), mean, scale, seed), batch.column("fold").to_numpy()
            raw = np.where(fold == 0, z @ other[0], z @ other[1])
            bins = np.round(np.clip(raw, -0.5, 1.5) * BINS / 2).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(bins), batch.column("label")], names=["bin", "label"])

    bins = sorted(rows.mapInArrow(binned, "bin long, label double").groupBy("bin").agg(
        F.count(F.lit(1)).alias("n"), F.avg("label").alias("y")).collect())          # at most BINS + 1 rows
    x, w, y = (np.array(c, dtype=float) for c in zip(*bins))
    knots, values = isotonic(x / BINS * 2, y, w)
    return Model(mean, scale, solve(sums[0] + sums[1]), knots, values, seed)


def score_column(model: Model, f: Column) -> Column:
    """Scores of a statistics column."""
    @F.arrow_udf("double")
    def score(x: pa.Array) -> pa.Array:
        flat = x.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(x), N_STATS)
        return pa.array(model.score(flat))

    return score(f)


def is_held_out(doc_id: Column) -> Column:
    """Rows kept out of every fit: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def train(prints: DataFrame, labels: DataFrame) -> Model:
    """The model of the documents (doc_id, f) that have a quality label and are not held out."""
    marked = labels.filter(F.col("quality").isin(0, 1)).select(F.col("doc_id").alias("of"), F.col("quality").alias("label"))
    return fit(prints.join(marked, F.col("doc_id") == F.col("of")).filter(~is_held_out(F.col("doc_id"))))


def features(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics f of every row, as a written table (the text is read once)."""
    return written(docs.select("doc_id", statistics_column(text_of()).alias("f")), "quality-features")


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` (all columns) in a struct ``row``, beside their ``score``. Rows and statistics are written once, for the fit and the scores."""
    t = written(docs.select(as_row(docs), statistics_column(text_of()).alias("f")), "quality-rows-scored")
    model = train(t.select("row.doc_id", "f"), labels)
    return t.select("row", score_column(model, F.col("f")).alias("score"))
