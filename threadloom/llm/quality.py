"""Quality scores: random Fourier features of document statistics, ridge regression, isotonic calibration.

Statistics of whole texts are scaled, mapped to random Fourier features (a Gaussian kernel in
the limit), and fitted to labels by ridge regression from normal equations that every partition sums up.
A fold that the regression does not see turns its output into a probability that never falls as it rises.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField

from threadloom.llm.arrow import add_columns, raw
from threadloom.llm.sums import summed
from threadloom.session import stored

FEATURES = 256
RIDGE = 1e-3
SEED = 7
#: Bins of the regression output between LOW and HIGH, from which the calibration is fitted.
BINS, LOW, HIGH = 4096, -0.5, 1.5

CLASSES = [
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    b"abcdefghijklmnopqrstuvwxyz",
    b"0123456789",
    b" \t\n\r\x0b\x0c",
    b".,;:?'\"-()",
    b"!",
    b"|",
    b"#$%&*+<=>@[]^_`{}~/\\",
    bytes(range(128, 256)),
]
CLASS_OF = np.array([[b in c for c in CLASSES] for b in range(256)], float)
STATISTICS = len(CLASSES) + 13


def statistics(text: bytes) -> list[float]:
    """Shares and sizes of a whole text; all 0 for an empty one."""
    words = text.split()
    if not words:
        return [0.0] * STATISTICS
    histogram = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    shares = histogram[histogram > 0] / len(text)
    lines = [x for x in text.split(b"\n") if x.strip()]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    counts = Counter(words)
    n = len(words)
    return [
        *(histogram @ CLASS_OF / len(text)),
        float(np.log1p(len(text))),
        float(np.log1p(n)),
        float(sizes.mean()),
        float(sizes.std()),
        float(np.log1p(sizes.max())),
        float(-(shares * np.log2(shares)).sum()),
        len(counts) / n,
        max(counts.values()) / n,
        sum(map(eq, words, words[1:])) / n,
        float(np.log1p(len(lines))),
        len(set(lines)) / len(lines),
        sum(x.rstrip()[-1:] in b".!?" for x in lines) / len(lines),
        sum(w[:1].isupper() for w in words) / n,
    ]


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    levels: np.ndarray

    def features(self, rows: np.ndarray) -> np.ndarray:
        random = np.random.default_rng(SEED)
        width = STATISTICS**0.5
        directions = random.standard_normal((STATISTICS, FEATURES)) / width
        phases = random.uniform(0, 2 * np.pi, FEATURES)
        waves = np.cos((rows - self.mean) / self.scale @ directions + phases) * (2 / FEATURES) ** 0.5
        return np.hstack([waves, np.ones((len(rows), 1))])

    def output(self, rows: np.ndarray) -> np.ndarray:
        return self.features(rows) @ self.weights

    def score(self, rows: np.ndarray) -> np.ndarray:
        return self.levels[bin_of(self.output(rows))]


def bin_of(output: np.ndarray) -> np.ndarray:
    return np.clip((output - LOW) / (HIGH - LOW) * BINS, 0, BINS - 1).astype(int)


def isotonic(counts: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Pooled means that never fall, for every bin; empty bins lie on the line between their neighbours."""
    pools: list[list[float]] = []
    for i in np.flatnonzero(counts):
        pools.append([counts[i], sums[i], i, i])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            n, s, _, last = pools.pop()
            pools[-1] = [pools[-1][0] + n, pools[-1][1] + s, pools[-1][2], last]
    if not pools:
        return np.full(len(counts), 0.5)
    at = [x for p in pools for x in (p[2], p[3])]
    levels = [p[1] / p[0] for p in pools for _ in range(2)]
    return np.clip(np.interp(np.arange(len(counts)), at, levels), 0, 1)


def with_statistics(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    def make():
        def block(values: pa.Array) -> list[pa.Array]:
            return [pa.array([statistics(t) for t in raw(values)], pa.list_(pa.float64()))]

        return block

    return add_columns(docs, text, [StructField("statistics", ArrayType(DoubleType()))], make, keep=keep)


def _rows(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return (
        batch.column(0).flatten().to_numpy().reshape(-1, STATISTICS),
        batch.column(1).to_numpy(),
    )


def fit(docs: DataFrame, text: str = "text", label: str = "label", calibration: str = "calibration") -> Model:
    """A model from the rows of ``docs`` whose ``label`` is 0 to 1 (null: not used).

    ``calibration`` marks the rows that fit the calibration only. All labelled rows count; what
    meets in the driver are sums of fixed size. Without labels every score is 0.5; without a calibration
    fold the other rows calibrate.
    """
    named = docs.select(
        F.col(label).cast("double").alias("y"), F.col(calibration).alias("later"), F.col(text).alias("text")
    )
    found = stored(
        with_statistics(named.filter("y IS NOT NULL"), "text", ["y", "later"]).select("statistics", "y", "later"),
        "statistics",
    )
    return fit_statistics(found)


def fit_statistics(found: DataFrame) -> Model:
    """As ``fit``, from the columns (statistics, y, later)."""
    first = found.filter("NOT coalesce(later, false)").select("statistics", "y")
    later = found.filter("later").select("statistics", "y")

    def moments(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros((3, STATISTICS))
        for batch in batches:
            x, _ = _rows(batch)
            total += [np.full(STATISTICS, len(x)), x.sum(0), (x * x).sum(0)]
        return total.ravel()

    n, total, squares = summed(first, 3 * STATISTICS, moments).reshape(3, STATISTICS)
    n = np.maximum(n, 1)
    mean = total / n
    deviation = np.sqrt(np.maximum(squares / n - mean**2, 0))
    blank = Model(mean, np.where(deviation > 1e-9, deviation, 1.0), np.zeros(FEATURES + 1), np.full(BINS, 0.5))
    width = FEATURES + 1

    def equations(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros((width, width + 1))
        for batch in batches:
            x, y = _rows(batch)
            z = blank.features(x)
            total += z.T @ np.column_stack([z, y])
        return total.ravel()

    system = summed(first, width * (width + 1), equations).reshape(width, width + 1)
    rows = system[-1, -2]
    if not rows:
        return blank
    weights = np.linalg.solve(system[:, :-1] + RIDGE * rows * np.eye(width) / FEATURES, system[:, -1])
    raw_model = Model(blank.mean, blank.scale, weights, blank.levels)

    def bins(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros((2, BINS))
        for batch in batches:
            x, y = _rows(batch)
            at = bin_of(raw_model.output(x))
            total += [np.bincount(at, minlength=BINS), np.bincount(at, y, BINS)]
        return total.ravel()

    counts, sums = summed(later, 2 * BINS, bins).reshape(2, BINS)
    if not counts.any():
        counts, sums = summed(first, 2 * BINS, bins).reshape(2, BINS)
    return Model(blank.mean, blank.scale, weights, isotonic(counts, sums))


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text (double, 0 to 1); null counts as empty. A column of
    that name is replaced; equal texts get equal scores."""

    def make():
        def block(values: pa.Array) -> list[pa.Array]:
            rows = np.array([statistics(t) for t in raw(values)]).reshape(-1, STATISTICS)
            return [pa.array(model.score(rows))]

        return block

    return add_columns(docs, text, [StructField(out, DoubleType())], make)
