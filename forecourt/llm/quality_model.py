"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

Each text becomes a vector of document statistics (sizes, character classes, repetition), scaled by
the corpus mean and deviation. ``cos(W x + b)`` with normal W and uniform b approximates a Gaussian
kernel over these vectors. Ridge scores solve ``(Z'Z + ridge) w = Z'y``; Z'Z and Z'y are summed by
partition, then over a few tasks, so the driver gets a fixed number of small matrices. The scores of a
third of the labelled rows, kept out of that fit, are made probabilities by pool-adjacent-violators
over a histogram of scores, interpolated between the pooled levels.

All sums over documents are sums of integers (statistics in steps of 1 / UNIT for mean and deviation, features
in steps of 1 / STEPS for the matrices), so the scores do not depend on how rows are dealt or ordered.

Defined results: a null text is empty; an empty text has statistics like any other and gets a
score; repeated rows and labels count as often as they stand in their tables, rows without id or
label teach nothing; without labels of both kinds every score is the share of label 1 (0.5 without
labels). Extra columns are carried or ignored and never read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from forecourt.llm.common import byte_sized, materialise, texts

STATISTICS = ("log_words", "log_bytes", "word_bytes", "distinct_words", "top_word", "repeated_windows", "echoes",
              "upper", "digits", "symbols", "marks", "lines", "repeated_lines", "high_bytes", "entropy")
#: Fourier features, kernel width in (scaled) statistics, ridge, and seed of W and b.
FEATURES = 256
WIDTH = 4.0
RIDGE = 1e-3
SEED = 7
#: Scaled statistics are cut here, so that one wild text doesn't leave the kernel's range.
REACH = 6.0
#: Bins of the score histogram that the calibration pools.
BINS = 2000
SCORE_RANGE = (-1.0, 2.0)
THRESHOLD = 0.7
SUMMING_TASKS = 8
#: Text bytes and rows that a worker takes at a time: a row's features are 2 kB, several times over.
SLICE_BYTES, SLICE_ROWS = 1_000_000, 1000
UNIT = 1 << 16
#: Steps of a Fourier feature (at most 1/11 in size), and of the constant and the label: products stay below
#: 2**30, so a 64-bit sum holds 8 billion rows a task.
STEPS = (1 << 18, 1 << 15)

_CLASSES = {"upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digits": b"0123456789", "symbols": b"#*$%&|<>",
            "marks": b"!\"'()+,-./:;=?@[\\]^_`{}~"}


def statistics(text: bytes) -> list[float]:
    """The STATISTICS of one text."""
    words = text.split()
    n, size = max(len(words), 1), max(len(text), 1)
    counted = Counter(words)
    windows = len(words) - 2
    repeated = 1 - len(set(zip(words, words[1:], words[2:]))) / windows if windows > 0 else 0.0
    echoes = sum(map(bytes.__eq__, words, words[1:])) / n
    lines = [line for line in text.split(b"\n") if line.strip()]
    share = np.bincount(np.frombuffer(text, np.uint8), minlength=256) / size
    some = share[share > 0]
    bytes_of = {name: sum(share[b] for b in members) * size for name, members in _CLASSES.items()}
    return [np.log1p(len(words)), np.log1p(len(text)), sum(map(len, words)) / n, len(counted) / n,
            max(counted.values(), default=0) / n, repeated, echoes, bytes_of["upper"] / size, bytes_of["digits"] / size,
            bytes_of["symbols"] / n, bytes_of["marks"] / n, len(lines) / n, 1 - len(set(lines)) / max(len(lines), 1),
            float(share[128:].sum()), float(-(some * np.log2(some)).sum())]


def with_statistics(docs: DataFrame, carry: Sequence[str], text: str = "text") -> DataFrame:
    """row (struct of the ``carry`` columns, if any), doc_id, x (array of statistics)."""
    row = (F.struct(*[F.col(f"`{c}`") for c in carry]) if carry else F.lit(True)).alias("row")
    step = docs.select(row, F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("t"))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in byte_sized(batches, "t", SLICE_BYTES):
            x = [statistics(t) for t in texts(b.column(2))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(x, pa.list_(pa.float64()))],
                                             names=["row", "doc_id", "x"])

    return step.mapInArrow(add, step.select("row", "doc_id").schema.add("x", ArrayType(DoubleType())))


class Features:
    """Scaling and the fixed random map."""

    def __init__(self, mean: np.ndarray, deviation: np.ndarray):
        self.mean, self.scale = mean, np.where(deviation > 0, deviation, 1.0)
        rng = np.random.default_rng(SEED)
        self.w = rng.normal(0, 1 / WIDTH, (len(mean), FEATURES))
        self.b = rng.uniform(0, 2 * np.pi, FEATURES)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        x = np.clip((x - self.mean) / self.scale, -REACH, REACH)
        angle = np.tile(self.b, (len(x), 1))
        for column, w in zip(x.T, self.w):  # one by one: a matrix product may round by the number of rows
            angle += column[:, None] * w
        return np.hstack([np.sqrt(2 / FEATURES) * np.cos(angle), np.ones((len(x), 1))])


def row_sized(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``most`` rows; none is empty."""
    for b in batches:
        for lo in range(0, b.num_rows, most):
            yield b.slice(lo, most)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), -1)


def scaling(stats: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of every statistic over all documents."""
    names = range(len(STATISTICS))
    steps = [F.round(F.col("x")[i] * UNIT).cast("decimal(19,0)") for i in names]
    row = stats.agg(F.count(F.lit(1)).alias("n"), *[F.sum(q).alias(f"m{i}") for i, q in enumerate(steps)],
                    *[F.sum(q * q).alias(f"s{i}") for i, q in enumerate(steps)]).first()
    n = max(row["n"], 1)
    sums, squares = ([int(row[f"{c}{i}"] or 0) for i in names] for c in "ms")
    return (np.array([m / n / UNIT for m in sums]),
            np.array([np.sqrt(float(n * q - m * m)) / n / UNIT for m, q in zip(sums, squares)]))


def ridge(rows: DataFrame, features: Features) -> np.ndarray | None:
    """Weights from the rows (x, y); None unless both labels occur."""
    size = FEATURES + 1
    steps = np.array([STEPS[0]] * FEATURES + [STEPS[1]] * 2, np.float64)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size + 1, size + 1), np.int64)  # of [Z y]'[Z y], in steps
        for b in row_sized(batches, SLICE_ROWS):
            z = np.hstack([features(_matrix(b.column(0))), np.asarray(b.column(1), np.float64)[:, None]])
            z = np.rint(z * steps)
            total += (z.T @ z).astype(np.int64)  # a slice's sums are whole numbers below 2**53
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["m"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size + 1) ** 2, np.int64)
        for b in batches:
            for m in b.column(0):
                total += np.frombuffer(m.as_buffer(), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["m"])

    few = rows.select("x", "y").mapInArrow(sums, "m binary").repartition(SUMMING_TASKS).mapInArrow(add, "m binary")
    parts = [np.frombuffer(r["m"], np.int64).astype(object) for r in few.collect()]
    total = sum(parts).astype(np.float64).reshape(size + 1, size + 1) / np.outer(steps, steps)
    n, ones = total[size - 1, size - 1], total[size - 1, size]
    if not 0 < ones < n:
        return None
    return np.linalg.solve(total[:size, :size] + RIDGE * n * np.eye(size) / size, total[:size, size])


def raw_bin(score: np.ndarray) -> np.ndarray:
    low, high = SCORE_RANGE
    return np.clip((score - low) / (high - low) * BINS, 0, BINS - 1)


def isotonic(counts: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions, values): pool adjacent violators over the bins; positions are the pools' mean bins."""
    pools: list[list[float]] = []  # [weight, ones, weighted bin]
    for i in np.flatnonzero(counts).tolist():
        pools.append([counts[i], ones[i], counts[i] * (i + 0.5)])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    w, s, p = np.array(pools).T
    return p / w, s / w


class Classifier:
    """Statistics to calibrated scores."""

    def __init__(self, features: Features, weights: np.ndarray | None, positions: np.ndarray, values: np.ndarray):
        self.features, self.weights, self.positions, self.values = features, weights, positions, values

    def raw(self, x: np.ndarray) -> np.ndarray:
        return (self.features(x) * self.weights).sum(axis=1)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), self.values[0])
        return np.clip(np.interp(raw_bin(self.raw(x)), self.positions, self.values), 0.0, 1.0)


def train(stats: DataFrame, labels: DataFrame) -> Classifier:
    """Learn from the documents (doc_id, x) that ``labels`` (doc_id, y, part) name; rows with part 0 are
    for the calibration, the others for the fit. If either has one label only, all rows serve both."""
    features = Features(*scaling(stats))
    rows = materialise(stats.select("doc_id", "x").join(labels.where("y IS NOT NULL"), "doc_id").select("x", "y", "part"),
                       "labelled")
    seen = {(r["part"] == 0, int(r["y"])): r["n"] for r in rows.groupBy("part", "y").agg(F.count(F.lit(1)).alias("n")).collect()}
    split = all((p, y) in seen for p in (True, False) for y in (0, 1))
    weights = ridge(rows.where("part <> 0") if split else rows, features)
    if weights is None:
        total = sum(seen.values())
        share = sum(n for (_, y), n in seen.items() if y) / total if total else 0.5
        return Classifier(features, None, np.zeros(1), np.array([share]))
    model = Classifier(features, weights, np.zeros(1), np.zeros(1))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, ones = np.zeros(BINS, np.int64), np.zeros(BINS, np.int64)
        for b in row_sized(batches, SLICE_ROWS):
            at = raw_bin(model.raw(_matrix(b.column(0)))).astype(np.int64)
            np.add.at(counts, at, 1)
            np.add.at(ones, at, np.asarray(b.column(1), np.int64))
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(counts[some]), pa.array(ones[some])],
                                         names=["bin", "n", "ones"])

    held = rows.where("part = 0") if split else rows
    counts, ones = np.zeros(BINS), np.zeros(BINS)
    for r in (held.select("x", "y").mapInArrow(score, "bin int, n long, ones long").groupBy("bin")
              .agg(F.sum("n").alias("n"), F.sum("ones").alias("ones")).collect()):  # BINS rows at most
        counts[r["bin"]], ones[r["bin"]] = r["n"], r["ones"]
    return Classifier(features, weights, *isotonic(counts, ones))


def classify(docs: DataFrame, labels: DataFrame, carry: Sequence[str], threshold: float = THRESHOLD) -> DataFrame:
    """row, doc_id, score, predicted for every row of ``docs``; ``labels`` as in :func:`train`."""
    stats = materialise(with_statistics(docs, carry), "statistics")
    model = train(stats, labels)
    schema = stats.select("row", "doc_id").schema.add("score", "double").add("predicted", "integer")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in row_sized(batches, SLICE_ROWS):
            s = model(_matrix(b.column(2)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                                             names=["row", "doc_id", "score", "predicted"])

    return stats.mapInArrow(score, schema)


def quality_labels(labels: DataFrame) -> DataFrame:
    """doc_id, y, part of the label rows that may teach: crc32 of the id as text, modulo 4, is not 2.
    Those with remainder 3 are for the calibration."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    return (labels.where(fold != 2).where(F.col("quality").isin(0, 1))
            .select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y"),
                    (3 - fold).cast("int").alias("part")))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` scored at least ``threshold``, with all their columns. Only the statistics are
    written for the training; the verdict takes them a second time in one pass over the texts."""
    model = train(materialise(with_statistics(docs, []).drop("row"), "statistics"), quality_labels(labels))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in byte_sized(batches, "text", SLICE_BYTES):
            x = np.array([statistics(t) for t in texts(b.column("text"))])
            yield b.filter(pa.array(model(x) >= threshold))

    return docs.mapInArrow(keep, docs.schema)
