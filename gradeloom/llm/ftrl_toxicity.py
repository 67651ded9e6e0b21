"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams.

A text's features are its words, pairs of words in a row, and pairs with one or two words
between them (skip-grams), each present or absent and hashed to ``BUCKETS`` places. Words are
runs of letters and digits, lower-cased. The regression follows the regularised leader: each
place has its own rate, which falls with the gradients it has met, and an L1 bound that
keeps a place at zero until its gradients agree. So the model is a few thousand
weights, sent to every task.

Fitted on at most ``SAMPLE`` labelled documents, those with the smallest hash of their id: the
features are made in parallel, one task reads them in that order ``EPOCHS`` times. Every
document is scored, over its whole text.

A null text, or one without words, has no features and gets the score of the intercept. Rows
without id are scored, not learned from. A label that is null is none; of several labels
of an id the largest counts, of several texts of an id the first in byte order is learned
from. Equal texts get equal scores. Without any label every score is 0; without documents
there are no rows. Other columns of either table are not read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeloom.llm.common import mixed, sized, span_hashes, stored

# The regression is fitted on at most so many documents.
SAMPLE = 12_000
EPOCHS = 6
BUCKETS = 1 << 24
THRESHOLD = 0.3
# Rate, its offset, and the bound on the sum of weights.
ALPHA, BETA, L1 = 1.0, 1.0, 8.0
_CHUNK = 1 << 20

_APART = np.ones(256, bool)
_APART[128:] = False
for _first, _last in (b"09", b"az", b"AZ"):
    _APART[_first : _last + 1] = False


def _words(text: str) -> np.ndarray:
    """Hashes of the lower-cased words of a text, in order."""
    raw = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8)
    inside = ~_APART[raw]
    edges = np.flatnonzero(np.diff(np.r_[False, inside, False].view(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    found, first = [], 0
    # In stretches that start and end with whole words.
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + _CHUNK)))
        at = starts[first]
        found.append(span_hashes(raw[at : ends[last - 1]], starts[first:last] - at, ends[first:last] - at))
        first = last
    return np.concatenate(found) if found else np.empty(0, np.uint64)


def features(text: str) -> np.ndarray:
    """Places of the n-grams and skip-grams of a text, repeats included."""
    words = _words(text)
    parts = [words]
    for skip in (1, 2, 3):
        later = words[skip:]
        parts.append(mixed(words[: len(later)] * np.uint64(2 * skip + 1) + mixed(later)))
    return (np.concatenate(parts) & np.uint64(BUCKETS - 1)).astype(np.int32)


class Regression:
    """Follow-the-regularised-leader over places; place ``BUCKETS`` is the intercept."""

    def __init__(self) -> None:
        self.z = np.zeros(BUCKETS + 1, np.float32)
        self.n = np.zeros(BUCKETS + 1, np.float32)

    def weights(self, places: np.ndarray) -> np.ndarray:
        z, n = self.z[places], self.n[places]
        # The intercept is not held back.
        bound = np.where(places == BUCKETS, 0.0, L1)
        pulled = np.sign(z) * np.maximum(np.abs(z) - bound, 0.0)
        return -pulled * ALPHA / (BETA + np.sqrt(n))

    def learn(self, places: np.ndarray, label: float) -> None:
        """One step on distinct places, the intercept added."""
        places = np.append(places, BUCKETS)
        w = self.weights(places)
        gradient = sigmoid(w.sum()) - label
        before = self.n[places]
        after = before + gradient * gradient
        self.z[places] += gradient - (np.sqrt(after) - np.sqrt(before)) / ALPHA * w
        self.n[places] = after

    def kept(self) -> tuple[np.ndarray, np.ndarray]:
        """Places with a weight, and the weights."""
        places = np.flatnonzero((np.abs(self.z) > L1) | (np.arange(BUCKETS + 1) == BUCKETS))
        return places, self.weights(places)


def sigmoid(x: float) -> float:
    return float(1.0 / (1.0 + np.exp(-np.clip(x, -40.0, 40.0))))


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            places = np.unique(features(batch.column(2)[row].as_py() or ""))
            made = [batch.column(0).slice(row, 1), batch.column(1).slice(row, 1), pa.array([places.tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(made, ["turn", "label", "places"])


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    model, any_row = Regression(), False
    for batch in batches:
        for label, places in zip(batch.column("label").to_pylist(), batch.column("places")):
            any_row = True
            model.learn(np.frombuffer(places.as_py(), np.int32), float(label))
    if any_row:
        places, weights = model.kept()
        made = [pa.array(places, pa.int64()), pa.array(weights.astype(np.float64))]
        yield pa.RecordBatch.from_arrays(made, ["place", "weight"])


def fit(
    docs: DataFrame, labels: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE
) -> tuple[np.ndarray, np.ndarray]:
    """Places with a weight, and the weights, from the labelled rows where ``train`` holds.

    ``train`` is an expression over the id column.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & train)
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("double").alias("label"))
    # Decided by the ids alone, so the labels outside are never looked at.
    turn = F.xxhash64(F.col("id").cast("string"))
    chosen = stored(known.withColumn("turn", turn).orderBy("turn", "id").limit(sample), "toxicity-sample")
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text"))
    met = texts.join(sized(chosen), F.col("__id") == F.col("id"))
    one = met.groupBy("id", "turn", "label").agg(F.min("text").alias("text"))
    made = one.select("turn", "label", "text").mapInArrow(_featured, "turn long, label double, places binary")
    # Bounded by the sample: one task reads it, epoch after epoch.
    ordered = stored(made.repartition(1).sortWithinPartitions("turn", "label", "places"), "toxicity-features")
    epochs = functools.reduce(DataFrame.union, [ordered.select("label", "places")] * EPOCHS)
    rows = epochs.coalesce(1).mapInArrow(_fit, "place long, weight double").collect()
    rows.sort()
    return np.array([r["place"] for r in rows], np.int64), np.array([r["weight"] for r in rows], np.float64)


def score_texts(places: np.ndarray, weights: np.ndarray, texts: Iterator[str]) -> list[float]:
    """Scores of texts under a model of sorted places, the intercept last."""
    if not len(places):
        return [0.0 for _ in texts]
    weighty = np.zeros(BUCKETS, bool)
    weighty[places[:-1]] = True
    scores = []
    for text in texts:
        found = features(text)
        met = np.unique(found[weighty[found]])
        total = weights[-1] + weights[np.searchsorted(places, met)].sum()
        scores.append(sigmoid(total))
    return scores


def _scored(places: np.ndarray, weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = score_texts(places, weights, (text.as_py() or "" for text in batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return run


def score_toxicity(
    docs: DataFrame, labels: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"
) -> DataFrame:
    """doc_id, held_out, score and predicted of every row.

    ``held_out`` is an expression over the id column, true for the rows whose labels are not
    to be learned.
    """
    places, weights = fit(docs, labels, ~held_out, id_col, text_col, label_col)
    kind = docs.schema[id_col].dataType
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    scored = rows.mapInArrow(_scored(places, weights), f"doc_id {kind.simpleString()}, score double")
    predicted = F.when(F.col("score") >= THRESHOLD, 1).otherwise(0)
    named = scored.withColumnRenamed("doc_id", id_col).withColumn("held_out", held_out)
    return named.select(F.col(id_col).alias("doc_id"), "held_out", "score", predicted.alias("predicted"))
