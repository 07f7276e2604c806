"""Quality rules and a calibrated n-gram classifier.

The base rules count over the whole text. A logistic regression over hashed word and character
n-grams is trained on a bounded sample of the labelled rows, its scores are turned into probabilities
on rows held out from the training, and every document is scored in Arrow batches against a fixed
threshold. The model is a vector of fixed length, so what goes to the executors does not grow.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftlake.llm.common import ASCII_SPACE, small_batches

SYMBOLS = "#*$%&|<>"
WORD_BUCKETS = 1 << 13
CHAR_BUCKETS = 1 << 12
BUCKETS = WORD_BUCKETS + CHAR_BUCKETS
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def count(text: str, words: list[bytes]) -> tuple[int, int, int, int, int]:
    """The base counts, in the order of ``COUNTS``."""
    seen: set[str] = set()
    repeated_lines = 0
    for line in text.split("\n"):
        if line in seen:
            repeated_lines += 1
        elif line.strip(ASCII_SPACE):
            seen.add(line)
    windows = list(zip(words, words[1:], words[2:], strict=False))
    times = Counter(windows)
    repeated_words = 0
    if len(times) < len(windows):
        covered = np.zeros(len(words) + 2, bool)
        starts = np.fromiter((times[w] > 1 for w in windows), bool, len(windows))
        for shift in range(3):
            covered[shift : shift + len(windows)] |= starts
        repeated_words = int(covered.sum())
    chars = len(text) - sum(text.count(c) for c in ASCII_SPACE)
    return len(words), chars, sum(text.count(c) for c in SYMBOLS), repeated_lines, repeated_words


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < 50 or 100 * n_repeat_words > 50 * n_words


def _counted(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Counts of the top bits of 32-bit hashes."""
    return np.bincount(hashes >> np.uint32(32 - bits), minlength=1 << bits)


def features(text: str, words: list[bytes]) -> np.ndarray:
    """Hashed counts of words, word pairs and windows of four characters, damped and of unit length."""
    out = np.zeros(BUCKETS, np.float32)
    if words:
        hashes = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
        pairs = (hashes[:-1] * np.uint32(2654435761)) ^ (hashes[1:] * np.uint32(2246822519))
        out[:WORD_BUCKETS] = _counted(np.concatenate([hashes, pairs]), 13)
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    if len(points) > 3:
        grams = points[:-3]
        for shift, factor in ((1, 2654435761), (2, 2246822519), (3, 3266489917)):
            grams = grams * np.uint32(668265263) + points[shift : len(points) - 3 + shift] * np.uint32(factor)
        out[WORD_BUCKETS:] = _counted((grams ^ (grams >> np.uint32(15))) * np.uint32(2654435761), 12)
    np.log1p(out, out)
    norm = float(np.sqrt(out @ out))
    return out / norm if norm else out


@dataclass
class Rows:
    """Sparse feature rows: ``spots`` and ``values`` of row ``i`` lie between ``ends[i]`` and ``ends[i + 1]``."""

    spots: np.ndarray
    values: np.ndarray
    ends: np.ndarray

    def __len__(self) -> int:
        return len(self.ends) - 1

    def part(self, first: int, last: int) -> Rows:
        a, b = self.ends[first], self.ends[last]
        return Rows(self.spots[a:b], self.values[a:b], self.ends[first : last + 1] - a)

    def blocks(self, rows: int = 256) -> Iterator[tuple[int, Rows]]:
        for at in range(0, len(self), rows):
            yield at, self.part(at, min(at + rows, len(self)))

    def times(self, weights: np.ndarray) -> np.ndarray:
        """The product of each row with the weights."""
        out = np.zeros(len(self))
        for at, x in self.blocks():
            sums = np.concatenate([np.zeros(1), np.cumsum(x.values * weights[x.spots], dtype=np.float64)])
            out[at : at + len(x)] = sums[x.ends[1:]] - sums[x.ends[:-1]]
        return out

    def weighted(self, of_row: np.ndarray) -> np.ndarray:
        """The sum of the rows, each times its weight."""
        out = np.zeros(BUCKETS)
        for at, x in self.blocks():
            out += np.bincount(x.spots, x.values * np.repeat(of_row[at : at + len(x)], np.diff(x.ends)), BUCKETS)
        return out


def sparse(vector: np.ndarray) -> bytes:
    """The spots of the entries that are not zero, and the entries, two bytes each."""
    spots = np.flatnonzero(vector)
    return spots.astype("<u2").tobytes() + vector[spots].astype("<f2").tobytes()


def rows_of(packed: list[bytes]) -> Rows:
    """The rows that :func:`sparse` packed."""
    sizes = [len(p) // 4 for p in packed]
    ends = np.cumsum([0, *sizes])
    spots, values = np.empty(ends[-1], np.uint16), np.empty(ends[-1], np.float16)
    for p, n, a in zip(packed, sizes, ends[:-1], strict=True):
        spots[a : a + n], values[a : a + n] = np.frombuffer(p, "<u2", n), np.frombuffer(p, "<f2", n, 2 * n)
    return Rows(spots, values, ends)


@dataclass
class Model:
    """``probability`` of a good document; without both labels to learn from, every document is good."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def probability(self, vector: np.ndarray) -> float:
        return _sigmoid(self.slope * (float(vector @ self.weights) + self.bias) + self.shift)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def _descend(gradient, size: int, rounds: int, rate: float) -> np.ndarray:
    at, mean, square = np.zeros(size), np.zeros(size), np.zeros(size)
    for i in range(1, rounds + 1):
        g = gradient(at)
        mean, square = 0.9 * mean + 0.1 * g, 0.99 * square + 0.01 * g * g
        at = at - rate * (mean / (1 - 0.9**i)) / (np.sqrt(square / (1 - 0.99**i)) + 1e-8)
    return at


def fit(rows: Rows, good: np.ndarray) -> Model:
    """Train on the first two thirds of the rows and calibrate on the others."""
    cut = len(good) - len(good) // 3
    if len(set(good[:cut].tolist())) < 2:
        return Model(np.zeros(BUCKETS, np.float32), 0.0, 0.0, 50.0)
    x, y = rows.part(0, cut), good[:cut].astype(float)
    weight = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean()))

    def gradient(p: np.ndarray) -> np.ndarray:
        error = weight * (_sigmoid(x.times(p[:-1]) + p[-1]) - y) / len(y)
        return np.append(x.weighted(error) + 1e-6 * p[:-1], error.sum())

    found = _descend(gradient, BUCKETS + 1, 150, 0.2)
    weights, bias = found[:-1].astype(np.float32), float(found[-1])
    scores, truth = rows.part(cut, len(rows)).times(weights) + bias, good[cut:].astype(float)
    # Platt's targets keep the slope finite when the scores separate the labels
    truth = np.where(truth > 0, (truth.sum() + 1) / (truth.sum() + 2), 1 / ((1 - truth).sum() + 2))

    def calibration(p: np.ndarray) -> np.ndarray:
        error = (_sigmoid(p[0] * scores + p[1]) - truth) / len(truth)
        return np.array([error @ scores, error.sum()])

    slope, shift = _descend(calibration, 2, 500, 0.1) if len(truth) else (1.0, 0.0)
    return Model(weights, bias, float(slope), float(shift))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 2000) -> Model:
    """Fit on at most ``max_rows`` labelled documents, the first by a hash of their id.

    Rows without an id, a label of 0 or 1 or a document teach nothing; of several labels of an id the least counts, of
    several texts one; a null text counts as empty. Without both labels, as in an empty table, every document is good.
    """
    small_batches(docs.sparkSession)
    known = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int").alias("good")).where("doc_id IS NOT NULL AND good IN (0, 1)")
    sample = known.groupBy("doc_id").agg(F.min("good").alias("good")).orderBy(F.xxhash64("doc_id", F.lit(5)), "doc_id").limit(max_rows)
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = texts.join(F.broadcast(sample), "doc_id").select("doc_id", "good", "text")  # at most max_rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [sparse(features(t or "", (t or "").encode().split())) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(vectors, pa.binary())], ["doc_id", "good", "vector"])

    got = rows.mapInArrow(run, "doc_id long, good int, vector binary")
    last = Window.partitionBy("doc_id").orderBy("vector")
    found = got.withColumn("n", F.row_number().over(last)).where("n = 1").orderBy(F.xxhash64("doc_id", F.lit(6)), "doc_id").limit(max_rows).toArrow()
    return fit(rows_of(found["vector"].to_pylist()), found["good"].to_numpy() > 0)


SCORED = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, kept boolean, probability double"


def score(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The counts and verdict of every row; ``kept`` needs the base rules and a probability of ``threshold``.

    A null or empty text has no words and fails. Repeated rows are judged alike. Only ``doc_id`` and
    ``text`` are read; an empty table gives an empty result.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, failed, kept, chance = [], [], [], []
            for text in batch.column(1).to_pylist():
                text = text or ""
                words = text.encode().split()
                counts.append(count(text, words))
                failed.append(base_failed(counts[-1][0], counts[-1][4]))
                chance.append(float(model.probability(features(text, words))))
                kept.append(not failed[-1] and chance[-1] >= threshold)
            columns = [pa.array([c[i] for c in counts], pa.int64()) for i in range(len(COUNTS))]
            rest = [pa.array(failed, pa.bool_()), pa.array(kept, pa.bool_()), pa.array(chance, pa.float64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns, *rest], ["doc_id", *COUNTS, "base_failed", "kept", "probability"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, SCORED)


def keep_good(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns, whatever their names, without a join.

    A null or empty text has no words and goes; repeated rows are judged alike; an empty table gives an empty result.
    """
    small_batches(docs.sparkSession)

    @F.pandas_udf("boolean")
    def passes(texts):
        import pandas as pd

        out = []
        for text in texts:
            text = text if isinstance(text, str) else ""
            words = text.encode().split()
            counts = count(text, words)
            out.append(not base_failed(counts[0], counts[4]) and float(model.probability(features(text, words))) >= threshold)
        return pd.Series(out, dtype=bool)

    return docs.where(passes(F.col("text").cast("string")))
