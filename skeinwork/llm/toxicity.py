"""Severity of toxic language, by a cumulative-link ordinal regression on sparse text features.

Features are chosen by the likelihood-ratio statistic of their presence in toxic and other rows, copies of a text
counted once: of rows with one label and the same features, the one with the least doc_id is fitted, and no other is left out.
A document's features are its distinct lower-case words and their first four and five letters.  Severity has the grades 0 to 3.  The labels only tell toxic rows from others; the grade of a toxic row follows from how many of its words are
markers, words that at least ``MARKER_ODDS`` times as large a share of toxic as of other sample rows hold.  The model is
P(grade > k) = sigmoid(w.x - theta_k) with one vector of weights for all thresholds and ordered thresholds; a document's
expected severity is the sum of these probabilities, and it is toxic where P(grade > 0) is over one half.

The model is fitted on at most ``sample_rows`` labelled rows, those with the smallest hashes of doc_id, and has at most
``features`` weights; both bounds hold at every input size.  Scoring covers every document and its whole text.

Defined results: a null text has no features and scores like an empty one; labels that are null are left out; without
rows of both kinds nothing is toxic and the severity is 0; repeated rows are scored each; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeinwork.llm.common import Scratch, text_of

SAMPLE_ROWS, FEATURES, GRADES = 20_000, 4096, 3
MARKER_ODDS, RARE, LEAST_G = 20.0, 5, 9.0
_WORD = re.compile(r"[^\W\d_]+")
_MEMORY = 200_000


def word_features(word: str) -> list[str]:
    return [word] + [f"{word[:n]}*" for n in (4, 5) if len(word) > n]


def text_features(text: str) -> set[str]:
    return {f for w in set(_WORD.findall(text.lower())) for f in word_features(w)}


class Model:
    """Weights by feature, and the ordered thresholds."""

    def __init__(self, weights: dict[str, float], thresholds: list[float]) -> None:
        self.weights, self.thresholds = weights, thresholds
        self.memory: dict[str, tuple[str, ...]] = {}

    def score(self, text: str) -> tuple[float, int, bool, int]:
        """Expected severity, likeliest count of passed thresholds, whether toxic, and the number of features met."""
        if not self.thresholds:
            return 0.0, 0, False, 0
        memory, weights, met = self.memory, self.weights, set()
        if len(memory) > _MEMORY:
            memory.clear()
        for word in set(_WORD.findall(text.lower())):
            if (own := memory.get(word)) is None:
                own = memory[word] = tuple(f for f in word_features(word) if f in weights)
            met.update(own)
        x = sum(sorted(weights[f] for f in met))
        over = [1 / (1 + np.exp(min(max(t - x, -700), 700))) for t in self.thresholds]
        return float(sum(over)), sum(p > 0.5 for p in over), bool(over[0] > 0.5), len(met)


def fit_ordinal(rows: list[np.ndarray], grades: np.ndarray, features: int, top: int = GRADES, steps: int = 400, rate: float = 0.05, shrink: float = 3e-4) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of the cumulative-link model, by Adam on the penalised mean log-likelihood."""
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    col = np.concatenate(rows).astype(int) if len(at) else np.zeros(0, int)
    p = np.concatenate([np.zeros(features), [1.0], np.zeros(top - 1)])  # weights, the first threshold, logs of the gaps
    m, v = np.zeros_like(p), np.zeros_like(p)
    sigmoid = lambda x: 1 / (1 + np.exp(-np.clip(x, -50, 50)))
    each = np.arange(len(rows))
    for step in range(1, steps + 1):
        theta = np.cumsum(np.concatenate([p[features : features + 1], np.exp(p[features + 1 :])]))
        x = np.bincount(at, p[col], len(rows))
        over = np.concatenate([np.ones((len(rows), 1)), sigmoid(x[:, None] - theta), np.zeros((len(rows), 1))], axis=1)  # P(grade >= k)
        slope = over * (1 - over)
        mass = np.maximum(over[each, grades] - over[each, grades + 1], 1e-12)
        by_x = -(slope[each, grades] - slope[each, grades + 1]) / mass / len(rows)
        by_theta = np.zeros(top)
        for k in range(top):
            by_theta[k] = ((slope[:, k + 1] / mass) * ((grades == k + 1).astype(float) - (grades == k))).sum() / len(rows)
        tail = np.cumsum(by_theta[::-1])[::-1]
        g = np.concatenate([np.bincount(col, by_x[at], features) + shrink * p[:features], tail[:1], tail[1:] * np.exp(p[features + 1 :])])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return p[:features], np.cumsum(np.concatenate([p[features : features + 1], np.exp(p[features + 1 :])]))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, features: int = FEATURES) -> Model:
    """Fits the model on a bounded sample of labelled rows."""
    scratch = Scratch(docs.sparkSession, "toxicity")
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", (F.col("toxic") != 0).cast("int").alias("toxic"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(sample_rows)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([sorted(text_features(t)) for t in batch.column(2).to_pylist()], pa.list_(pa.string()))], names=["doc_id", "toxic", "found"])

    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("doc_id", "toxic", text_of().alias("text"))  # at most sample_rows rows of two numbers
    rows = rows.mapInArrow(extract, "doc_id long, toxic int, found array<string>")
    rows = scratch.keep(rows.groupBy("toxic", "found").agg(F.min("doc_id").alias("doc_id")))  # a copied text counts once; whole lists are compared
    totals = {r[0]: r[1] for r in rows.groupBy("toxic").count().collect()}
    bad, good = totals.get(1, 0), totals.get(0, 0)
    if not bad or not good:
        return Model({}, [])
    counts = rows.select("toxic", F.explode("found").alias("f")).groupBy("f").agg(F.sum("toxic").alias("a"), F.count_if(F.col("toxic") == 0).alias("b")).filter(F.col("a") + F.col("b") >= RARE)
    a, b, n = F.col("a"), F.col("b"), bad + good
    part = lambda x, e: F.when(x > 0, x * F.ln(x / e)).otherwise(0.0)
    g = part(a, (a + b) * (bad / n)) + part(b, (a + b) * (good / n)) + part(bad - a, (n - a - b) * (bad / n)) + part(good - b, (n - a - b) * (good / n))
    chosen = counts.withColumn("g", F.round(g, 6)).filter(F.col("g") >= LEAST_G).orderBy(F.desc("g"), "f").limit(features).collect()
    names = sorted(r.f for r in chosen)
    index = {f: i for i, f in enumerate(names)}
    markers = {r.f for r in chosen if not r.f.endswith("*") and (r.a + 0.5) / (bad + 1) >= MARKER_ODDS * (r.b + 0.5) / (good + 1)}
    kept = rows.select("doc_id", "toxic", F.array_intersect("found", F.split(F.lit(" ".join(names)), " ")).alias("found"))
    sampled = sorted(kept.collect(), key=lambda r: (r.doc_id, r.toxic, r.found))  # at most sample_rows rows of at most `features` names
    grades = np.array([r.toxic and (1 + sum(len(markers.intersection(r.found)) >= c for c in (3, 6))) for r in sampled])
    weights, thresholds = fit_ordinal([np.array(sorted(index[f] for f in r.found), int) for r in sampled], grades, len(names))
    return Model({f: float(w) for f, w in zip(names, weights, strict=True) if w}, thresholds.tolist())


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, expected_severity, grade, toxic and n_features of every document."""
    weights, thresholds = model.weights, model.thresholds

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(weights, thresholds)
        for batch in batches:
            found = list(zip(*map(own.score, batch.column(1).to_pylist()), strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, t) for x, t in zip(found, (pa.float64(), pa.int32(), pa.bool_(), pa.int32()), strict=True))], names=["doc_id", "expected_severity", "grade", "toxic", "n_features"])

    return docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).mapInArrow(run, "doc_id long, expected_severity double, grade int, toxic boolean, n_features int")


def toxic_rows_removed(docs: DataFrame, model: Model) -> DataFrame:
    """The documents, whole rows, that are not toxic."""
    weights, thresholds = model.weights, model.thresholds

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(weights, thresholds)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            yield batch.filter(pa.array([not own.score(t or "")[2] for t in texts], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
