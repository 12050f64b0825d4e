"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

A lexicon of words and word beginnings is learned from the labelled training
documents by their document counts (log-likelihood ratio and odds). A text's
features are densities of lexicon hits (plain, by beginning, and only after
undoing look-alike characters), the nearness of second-person words, capitals,
punctuation, repeated characters and tokens that mix letters with other signs.
Trees are trained on seven tenths of a bounded sample, which also gives the lexicon;
the rest calibrates their scores.

Null and empty texts have zero features and a score like any other. Without labels
of both kinds every score is the share of toxic labels (0 without any). Repeated
rows are scored each. Only the text is an input of a score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.llm.common import labelled_sample
from tillwright.session import durable

# Second-person words of the corpus' languages, and characters that stand for letters.
SECOND = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta tes vous votre vos tú ti tus usted ustedes".split())
LOOKALIKES = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})
BARE = re.compile(r"^[\W_]+|[\W_]+$")
INNER = re.compile(r"[\W_]+")
REPEATED = re.compile(r"(.)\1\1", re.S)
STEMS = (5, 6, 7)
NEAR = 3


def terms(token: str) -> list[str]:
    """The word of a token and its beginnings (marked by a star)."""
    word = BARE.sub("", token).lower()
    return [word, *(f"{word[:k]}*" for k in STEMS if len(word) > k)] if len(word) > 1 else []


class Tokens(dict):
    """Token to its numbers: lexicon weights (word, beginning, after undoing look-alikes), second person, and counts of characters."""

    def __init__(self, lexicon: dict[str, float]):
        super().__init__()
        self.lexicon = lexicon
        self.common = [(0.0, 0.0, 0.0, 0.0, n, 0, 0.0, 0, 0, 0.0, 0.0) for n in range(41)]

    def __missing__(self, token: str) -> tuple[float, ...]:
        found = self.plain(token) if token.isalpha() and token.islower() else self.measured(token)
        if len(token) <= 40:
            if len(self) >= 150_000:
                self.clear()
            self[token] = found
        return found

    def plain(self, token: str) -> tuple[float, ...]:
        """What ``measured`` gives for small letters only, in fewer steps; most such tokens share one row per length."""
        get, n, repeated = self.lexicon.get, len(token), REPEATED.search(token)
        if n < 2:
            return self.common[n]
        word, second = get(token, 0.0), token in SECOND
        stem = max((get(f"{token[:k]}*", 0.0) for k in STEMS if n > k), default=0.0)
        if not (word or stem or second or repeated) and n < len(self.common):
            return self.common[n]
        return word, stem, 0.0, float(second), n, 0, 0.0, 0, 0, float(bool(repeated)), 0.0

    def measured(self, token: str) -> tuple[float, ...]:
        own = terms(token)
        word = max((self.lexicon.get(t, 0.0) for t in own[:1]), default=0.0)
        stem = max((self.lexicon.get(t, 0.0) for t in own[1:]), default=0.0)
        plain = INNER.sub("", token.translate(LOOKALIKES)).lower()
        hidden = 0.0 if word or stem else self.lexicon.get(plain, 0.0)
        core = BARE.sub("", token)
        letters = sum(map(str.isalpha, token))
        return (
            word, stem, hidden, float(bool(own) and own[0] in SECOND), letters, sum(map(str.isupper, token)), float(len(core) > 2 and core.isupper()),
            len(token) - letters, token.count("!") + token.count("?"), float(bool(REPEATED.search(token))), float(0 < sum(map(str.isalpha, core)) < len(core)))


def dense(text: str, tokens: Tokens) -> list[float]:
    """The features of the whole text."""
    order = text.split()
    counts = Counter(order)
    if not counts:
        return [0.0] * 16
    times = np.fromiter(counts.values(), np.float64, len(counts))
    rows = np.array([tokens[t] for t in counts])
    n = len(order)
    hits = rows[:, :3] > 0
    word, stem, hidden = times @ hits
    second, letters, capitals, shouted, signs, marks, repeated, mixed = times @ rows[:, 3:]
    weight = rows[:, :3].max(1)
    near = 0
    if weight.any() and second:
        hot = {t for t, w in zip(counts, weight) if w > 0}
        you = {t for t, s in zip(counts, rows[:, 3]) if s}
        at = np.array([i for i, t in enumerate(order) if t in you])
        places = np.array([i for i, t in enumerate(order) if t in hot])
        after = np.searchsorted(at, places)
        gaps = np.minimum(np.abs(at[np.minimum(after, len(at) - 1)] - places), np.abs(at[np.maximum(after - 1, 0)] - places))
        near = int((gaps <= NEAR).sum())
    total = letters + signs
    return [
        word / n, stem / n, hidden / n, times @ weight / n, float(weight.max()), math.log1p(times @ (weight > 0)), float((weight > 0).sum()),
        near / n, second / n, capitals / max(letters, 1), shouted / n, signs / max(total, 1), marks / max(total, 1), repeated / n, mixed / n, math.log1p(n)]


def lexicon(sample: DataFrame, most: int = 500, least: int = 3, gain: float = 14.0) -> dict[str, float]:
    """At most ``most`` words and beginnings to their log odds, from (text, grade 0/1) rows; the counts come from all rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [Counter(), Counter()]
            for text, grade in zip(batch.column("text").to_pylist(), batch.column("grade").to_pylist()):
                counts[int(grade > 0)].update({x for t in set(text.split()) for x in terms(t)})
            names = sorted(counts[0].keys() | counts[1].keys())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *(pa.array([c[t] for t in names], pa.int64()) for c in counts)],
                                             ["term", "clean", "toxic"])

    n0, n1 = sample.agg(F.count_if(F.col("grade") <= 0), F.count_if(F.col("grade") > 0)).first()
    if not n0 or not n1:
        return {}
    summed = sample.select("text", "grade").mapInArrow(run, "term string, clean long, toxic long").groupBy("term").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    share = (F.col("clean") + F.col("toxic")) / (n0 + n1)
    ratio = F.when(F.col("clean") > 0, F.col("clean") * F.ln(F.col("clean") / (n0 * share))).otherwise(0.0)
    g2 = 2 * (F.col("toxic") * F.ln(F.col("toxic") / (n1 * share)) + ratio)
    odds = F.ln((F.col("toxic") + 0.5) / (n1 + 1)) - F.ln((F.col("clean") + 0.5) / (n0 + 1))
    chosen = summed.where(F.col("toxic") >= least).select("term", g2.alias("g2"), odds.alias("odds")).where((F.col("g2") >= gain) & (F.col("odds") > 1.5))
    return {r["term"]: r["odds"] for r in chosen.orderBy(F.desc("g2"), "term").limit(most).collect()}


def with_features(docs: DataFrame, words: dict[str, float], name: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(words)

    @F.arrow_udf("array<double>")
    def measure(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens = Tokens(shared.value)
        for texts in batches:
            rows = np.array([dense(t.as_py() or "", tokens) for t in texts], np.float64).reshape(-1, 16)
            yield pa.ListArray.from_arrays(np.arange(0, rows.size + 1, 16, dtype=np.int32), rows.ravel())

    return docs.withColumn(name, measure("text"))


class Model:
    """Lexicon, trees and calibration; ``base`` stands in where the labels allow no trees."""

    def __init__(self, docs: DataFrame, labels: DataFrame, label: str = "toxic", bound: int = 12000, keep: Column | None = None):
        sample = labelled_sample(docs, labels, label, bound, keep)
        sample = durable(sample.withColumn("grade", (F.col("grade") > 0).cast("double")).withColumn("learns", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(10)) < 7))
        learning = sample.where("learns")
        self.words = lexicon(learning)
        ready = durable(with_features(sample, self.words, "x").select("doc_id", "grade", "learns", array_to_vector("x").alias("x")).repartition(4, "doc_id").sortWithinPartitions("doc_id"))
        shares = {r["learns"]: (r["n"], r["mean"]) for r in ready.groupBy("learns").agg(F.count(F.lit(1)).alias("n"), F.avg("grade").alias("mean")).collect()}
        n = sum(s[0] for s in shares.values())
        self.base = sum(s[0] * s[1] for s in shares.values()) / n if n else 0.0
        self.trees = self.steps = None
        if all(0 < shares.get(part, (0, 0))[1] < 1 for part in (True, False)):
            self.trees = GBTClassifier(featuresCol="x", labelCol="grade", maxIter=20, maxDepth=3, stepSize=0.2, seed=7).fit(ready.where("learns"))
            judged = self._raw(ready.where("NOT learns")).select("grade", "raw")
            self.steps = IsotonicRegression(featuresCol="raw", labelCol="grade").fit(judged)

    def _raw(self, df: DataFrame) -> DataFrame:
        return self.trees.transform(df).withColumn("raw", vector_to_array("probability")[1]).drop("prediction")

    def score(self, docs: DataFrame) -> DataFrame:
        """doc_id and score per row of ``docs``."""
        rows = docs.select("doc_id", "text")
        if self.trees is None:
            return rows.select("doc_id", F.lit(float(self.base)).alias("score"))
        rows = with_features(rows, self.words, "x").select("doc_id", array_to_vector("x").alias("x"))
        return self.steps.transform(self._raw(rows)).select("doc_id", F.col("prediction").alias("score"))
