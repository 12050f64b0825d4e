"""Quality classifier: ordinal cumulative-link regression on graded ratings.

P(grade <= k) = logistic(threshold_k - w . x), with one weight vector for all
grades and thresholds in ascending order. x holds hashed counts of a text's words
and of their shapes (runs of capitals, small letters, digits and other characters),
each part at unit length. A document has an expected grade and a tail probability,
P(grade >= wanted), by which it is selected.

The model is fitted on a documented bound of labelled documents; their sparse rows
come to the driver, whose solver sees nothing else. Scoring covers whole texts.
Null and empty texts have no features and get the grades' base rates. Without
labels, or with one grade only, the weights are zero. Repeated rows are scored each.
"""

from __future__ import annotations

import dataclasses
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.llm.common import labelled_sample

HALF = 1 << 15  # buckets of words; as many of shapes follow
RUN = re.compile(r"([A-ZÀ-ÖØ-Þ]+)|([^\W\d_]+)|(\d+)|(.)\4*", re.S)


def shape(word: str) -> str:
    return RUN.sub(lambda m: "X" if m[1] else "x" if m[2] else "9" if m[3] else m[4], word)


class Buckets(dict):
    """Word to its two buckets; remembers short words within a bound, for one task."""

    def __missing__(self, word: str) -> tuple[int, int]:
        found = xxhash.xxh32_intdigest(word) % HALF, HALF + xxhash.xxh32_intdigest(shape(word)) % HALF
        if len(word) <= 40:
            if len(self) >= 150_000:
                self.clear()
            self[word] = found
        return found


def features(text: str, known: Buckets | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers and values of the whole text; ``known`` remembers words between texts."""
    known = Buckets() if known is None else known
    counts = Counter(text.split())
    if not counts:
        return np.zeros(0, np.int64), np.zeros(0)
    times = np.fromiter(counts.values(), np.float64, len(counts))
    buckets = np.array([known[w] for w in counts], np.int64)
    shapes, which = np.unique(buckets[:, 1], return_inverse=True)
    shaped = np.bincount(which, times)
    return np.concatenate([buckets[:, 0], shapes]), np.concatenate([times / np.linalg.norm(times), shaped / np.linalg.norm(shaped)])


@dataclasses.dataclass
class Ordinal:
    """Grades in ascending order, shared weights and one threshold between neighbouring grades."""

    grades: list[float]
    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, x: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """P(grade >= g) for every grade but the lowest."""
        return 1 / (1 + np.exp(np.clip(self.thresholds - self.weights[x[0]] @ x[1], -500, 500)))

    def expected(self, above: np.ndarray) -> float:
        return float(self.grades[0] + np.diff(self.grades) @ above) if self.grades else 0.0


def fit(rows: list[tuple[np.ndarray, np.ndarray]], grades: list[float], rounds: int = 200, rate: float = 0.1, decay: float = 1e-5) -> Ordinal:
    """Maximum likelihood with a penalty on the weights, by Adam over all rows at once."""
    levels = sorted(set(grades))
    k = len(levels) - 1
    y = np.searchsorted(levels, grades)
    if k < 1:
        return Ordinal(levels, np.zeros(2 * HALF), np.zeros(0))
    share = np.cumsum(np.bincount(y, minlength=k + 1))[:-1] / len(y)
    thresholds = np.log(share / (1 - share))
    steps = np.concatenate([thresholds[:1], np.log(np.maximum(np.diff(thresholds), 1e-3))])
    index, value = (np.concatenate([r[j] for r in rows]) for j in (0, 1))
    owner = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    point = np.concatenate([np.zeros(2 * HALF), steps])
    first, second = np.zeros_like(point), np.zeros_like(point)
    for t in range(1, rounds + 1):
        weights, steps = point[:2 * HALF], point[2 * HALF:]
        thresholds = np.cumsum(np.concatenate([steps[:1], np.exp(steps[1:])]))
        score = np.bincount(owner, weights[index] * value, len(rows))
        edges = np.concatenate([[-np.inf], thresholds, [np.inf]])
        with np.errstate(over="ignore"):
            high, low = (1 / (1 + np.exp(-(edges[y + j] - score))) for j in (1, 0))
        mass = np.maximum(high - low, 1e-12)
        g_score = 1 - high - low
        g_edges = np.bincount(y + 1, -high * (1 - high) / mass, k + 2) + np.bincount(y, low * (1 - low) / mass, k + 2)
        tails = np.cumsum(g_edges[1:-1][::-1])[::-1]  # a step moves its own threshold and all above it
        gradient = np.concatenate([np.bincount(index, value * g_score[owner], 2 * HALF), tails * np.concatenate([[1], np.exp(steps[1:])])]) / len(rows)
        gradient[:2 * HALF] += decay * weights
        first, second = 0.9 * first + 0.1 * gradient, 0.999 * second + 0.001 * gradient**2
        point = point - rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    return Ordinal(levels, point[:2 * HALF], np.cumsum(np.concatenate([point[2 * HALF:][:1], np.exp(point[2 * HALF + 1:])])))


def train(docs: DataFrame, labels: DataFrame, grade: str = "quality", bound: int = 8000, keep=None) -> Ordinal:
    """The model of at most ``bound`` labelled documents; ``keep`` is a condition on the labels' doc_id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Buckets()
        for batch in batches:
            rows = [features(t, known) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("grade").cast(pa.float64()), pa.array([r[0].astype(np.int32).tobytes() for r in rows], pa.binary()),
                 pa.array([r[1].astype(np.float32).tobytes() for r in rows], pa.binary())], ["doc_id", "grade", "index", "value"])

    sample = labelled_sample(docs, labels, grade, bound, keep).withColumn("grade", F.col("grade").cast("double"))
    kind = sample.schema["doc_id"].dataType.simpleString()
    held = sample.mapInArrow(run, f"doc_id {kind}, grade double, index binary, value binary").toArrow().sort_by([("doc_id", "ascending")])
    rows = [(np.frombuffer(i.as_py(), np.int32).astype(np.int64), np.frombuffer(v.as_py(), np.float32).astype(np.float64))
            for i, v in zip(held["index"], held["value"])]
    return fit(rows, held["grade"].to_pylist())


def score(docs: DataFrame, model: Ordinal, wanted: float = 1.0, name: str = "rating") -> DataFrame:
    """``docs`` and the struct ``name``: expected (grade) and tail, the probability of grade ``wanted`` or better."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<expected: double, tail: double>")
    def rate(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m, known = shared.value, Buckets()
        at = np.searchsorted(m.grades, wanted) - 1
        for texts in batches:
            above = [m.above(features(t.as_py() or "", known)) for t in texts]
            tails = [1.0 if at < 0 else 0.0 if at >= len(a) else float(a[at]) for a in above]
            yield pa.StructArray.from_arrays([pa.array([m.expected(a) for a in above], pa.float64()), pa.array(tails, pa.float64())], ["expected", "tail"])

    kept = [c for c in docs.columns if c.lower() != name]
    # Not deterministic for the optimiser: a filter on the result then doesn't evaluate it a second time.
    return docs.select(*kept).withColumn(name, rate.asNondeterministic()("text"))
