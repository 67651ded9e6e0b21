"""Quality classifier from weak labels.

Eight heuristics look at a document and vote good, bad or nothing. Their votes overlap
and some are often wrong; expectation-maximisation estimates, over all documents, how
likely each gives each vote for good documents and for each kind of bad ones, and with
that the chance that a document is good. No accuracy is fixed. As only the pattern of the eight votes matters, it works on counts
of at most 3**8 patterns. These chances are then the labels of a hashed linear scorer: a
logistic function of hashed word shapes, pairs of shapes and repetitions, fitted on at
most ``SAMPLE`` documents chosen by a hash of their id. The scorer decides.

A null text, or one without words, gets no votes, score 0 and is not kept. Rows without
id are labelled and scored like others. Equal texts get equal results. Texts of any
length are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeloom.llm.common import mixed, sized, stored, word_hashes

# The scorer is fitted on at most so many documents.
SAMPLE = 20_000
BUCKETS = 1 << 14
KEEP_LEAST = 0.45
# Beta priors as votes seen beforehand: (right, wrong) of a heuristic with a kind of its own
# on good documents, worth 1000 of them, and either vote of the others on a kind of junk. They
# decide only where a lone bad vote may as well be an error as a kind of junk.
GOOD_PRIOR, KIND_PRIOR = (999.0, 1.0), 0.1
GOOD, BAD, NONE = 1, 0, 2
LABELLERS = ("symbols", "capitals", "same_word", "variety", "sentences", "word_length", "same_line", "bare_signs")
# Heuristics that look for a sort of junk of their own. How lines end tells no sort by itself.
KINDS = tuple(name for name in LABELLERS if name != "sentences")
_ROUNDS, _STEPS = 200, 300
# What may follow the end of a sentence, and ends in other scripts.
_CLOSERS = "\"'”’»›)]}」』】）"
_ENDS = tuple(c.encode() for c in ".!?…。！？．｡؟۔।॥։።")


def _classes() -> np.ndarray:
    """Shape of each byte: small, capital, digit, or the sign itself."""
    shape = np.arange(256, dtype=np.uint8)
    shape[ord("a") : ord("z") + 1] = ord("a")
    shape[128:] = ord("a")
    shape[ord("A") : ord("Z") + 1] = ord("A")
    shape[ord("0") : ord("9") + 1] = ord("9")
    return shape


_SHAPE = _classes()
_PLAIN = np.zeros(256, bool)
_PLAIN[[*b" \t\n\r.,;:'\"-()?!"]] = True
_PLAIN |= np.isin(_SHAPE, [*b"aA9"])


def _vote(value: float, good: bool, bad: bool) -> int:
    return GOOD if good else BAD if bad else NONE


def _ends_sentence(line: bytes) -> bool:
    """True if a line ends as a sentence does, closing quotes and brackets aside."""
    return line[-200:].decode("utf-8", "ignore").rstrip().rstrip(_CLOSERS).rstrip().encode().endswith(_ENDS)


def votes(data: bytes, words: np.ndarray) -> list[int]:
    """The heuristics' votes on an encoded text with the hashes of its words."""
    n = len(words)
    if n == 0:
        return [NONE] * len(LABELLERS)
    raw = np.frombuffer(data, np.uint8)
    shape = _SHAPE[raw]
    letters = np.count_nonzero((shape == ord("a")) | (shape == ord("A")))
    odd = 1 - np.count_nonzero(_PLAIN[raw]) / len(raw)
    capital = np.count_nonzero(shape == ord("A")) / max(letters, 1)
    again = np.count_nonzero(words[1:] == words[:-1]) / n
    variety = len(np.unique(words)) / n
    lines = [line for line in data.split(b"\n") if line.strip()]
    ended = sum(map(_ends_sentence, lines)) / max(len(lines), 1)
    length = letters / n
    same_line = 1 - len(set(lines)) / max(len(lines), 1)
    bare = sum(data.count(sign) for sign in (b" | ", b" - ", b" * ")) / n
    many = n >= 20
    return [
        _vote(odd, odd < 0.01, odd > 0.05),
        _vote(capital, capital < 0.2, capital > 0.6 and n > 3),
        _vote(again, again < 0.05, again > 0.2 and n > 3),
        _vote(variety, many and variety > 0.4, many and variety < 0.15),
        _vote(ended, ended >= 0.8, ended < 0.3 and many),
        _vote(length, 2 <= length <= 11, length < 1 or length > 20),
        _vote(same_line, len(lines) > 2 and same_line < 0.1, len(lines) > 2 and same_line > 0.4),
        _vote(bare, many and bare < 0.02, bare > 0.1),
    ]


def pattern_of(data: bytes, words: np.ndarray) -> int:
    """The votes as digits of one number to base 3."""
    code = 0
    for vote in votes(data, words):
        code = 3 * code + vote
    return code


def features(data: bytes, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features and values: shares of word shapes, shape pairs and repetitions."""
    if len(words) == 0:
        return np.empty(0, np.int32), np.empty(0, np.float32)
    shape = _SHAPE[np.frombuffer(data, np.uint8)]
    runs = np.r_[True, shape[1:] != shape[:-1]]
    shapes = word_hashes(shape[runs].tobytes())
    again = np.r_[False, words[1:] == words[:-1]].astype(np.uint64)
    pairs = mixed(shapes[:-1] * np.uint64(3) + mixed(shapes[1:]))
    hashed = np.concatenate([shapes, pairs, mixed(again + np.uint64(11))])
    buckets, counts = np.unique((hashed % np.uint64(BUCKETS)).astype(np.int32), return_counts=True)
    return buckets, (counts / len(words)).astype(np.float32)


def _texts(column: pa.Array) -> Iterator[tuple[bytes, np.ndarray]]:
    for value in column.cast(pa.large_binary() if column.type == pa.large_string() else pa.binary()):
        data = value.as_py() or b""
        yield data, word_hashes(data)


def _patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        codes = [pattern_of(*text) for text in _texts(batch.column(1))]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(codes, pa.int32())], ["doc_id", "pattern"])


def _digits(patterns: np.ndarray) -> np.ndarray:
    """Votes of each pattern, (patterns, labellers)."""
    n = len(LABELLERS)
    return np.stack([patterns // 3 ** (n - 1 - i) % 3 for i in range(n)], axis=1)


def estimate_labels(
    patterns: np.ndarray, counts: np.ndarray, kinds: tuple[str, ...] = (), good_prior: tuple[float, float] = (1.0, 1.0)
) -> tuple[np.ndarray, np.ndarray, float]:
    """Chance of good per pattern, accuracies (labeller, class) and share of good.

    The accuracy of a labeller for a class is the chance that its vote, if it votes, is
    right. A missing vote says nothing: heuristics pass over short documents, which are
    not worse for it. Expectation-maximisation starts from the belief that a document
    with any bad vote is bad. One pseudo-count each keeps unseen votes possible.

    Kinds of bad documents differ and each labeller sees few of them. So with ``kinds`` there
    is a class of bad documents for each of these labellers: the junk that it votes bad,
    whatever the others say. A document without such a vote is good, one with several is
    shared among their classes and the good one. All other chances are estimated, for the
    good class from ``good_prior``; the accuracy on bad documents is that over all kinds.
    """
    given = _digits(patterns)
    said_good, said_bad = (given == GOOD).astype(float), (given == BAD).astype(float)
    own = [LABELLERS.index(name) for name in kinds]
    # Where each class of bad documents is possible.
    open_to = said_bad[:, own] if kinds else np.ones((len(patterns), 1))
    suspect = said_bad[:, own].any(1) if kinds else said_bad.any(1)
    good = np.where(suspect, 0.05, 1.0 if kinds else 0.95)
    belief = np.column_stack([good, (1 - good)[:, None] * open_to / np.maximum(open_to.sum(1, keepdims=True), 1)])
    classes = belief.shape[1]
    prior_good = np.full((classes, len(LABELLERS)), KIND_PRIOR if kinds else 1.0)
    prior_bad = prior_good.copy()
    prior_good[0], prior_bad[0] = 1.0, 1.0
    prior_good[0, own], prior_bad[0, own] = good_prior
    with np.errstate(divide="ignore"):
        possible = np.column_stack([np.zeros(len(patterns)), np.log(open_to)])
    for _ in range(_ROUNDS):
        weight = belief * counts[:, None]
        share = (weight.sum(0) + 1) / (counts.sum() + classes)
        votes_good, votes_bad = weight.T @ said_good + prior_good, weight.T @ said_bad + prior_bad
        says_good = votes_good / (votes_good + votes_bad)
        log_good, log_bad = np.log(says_good), np.log(votes_bad / (votes_good + votes_bad))
        # The vote that defines a kind is no evidence within it.
        log_good[np.arange(1, len(own) + 1), own] = log_bad[np.arange(1, len(own) + 1), own] = 0
        log = np.log(share) + said_good @ log_good.T + said_bad @ log_bad.T + possible
        new = np.exp(log - log.max(1, initial=-np.inf, keepdims=True))
        new /= new.sum(1, keepdims=True)
        moved, belief = np.abs(new - belief).max(initial=0), new
        if moved < 1e-6:
            break
    of_bad = share[1:] / share[1:].sum()
    return belief[:, 0], np.column_stack([of_bad @ (1 - says_good[1:]), says_good[0]]), float(share[0])


def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found, codes = [], []
        for text in _texts(batch.column(1)):
            found.append(features(text[0], text[1]))
            codes.append(pattern_of(*text))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(codes, pa.int32()), pa.array([f[0] for f in found], pa.list_(pa.int32())), pa.array([f[1] for f in found], pa.list_(pa.float32()))],
            ["doc_id", "pattern", "buckets", "shares"],
        )


def fit_scorer(buckets: list[np.ndarray], shares: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Weights, the last one constant: logistic loss against chances, by adaptive steps.

    Both classes weigh the same in total, so that rare bad documents count.
    """
    rows = np.repeat(np.arange(len(buckets)), [len(b) for b in buckets])
    cols, values = np.concatenate([*buckets, []]).astype(np.int64), np.concatenate([*shares, []]).astype(np.float64)
    good, bad = max(labels.sum(), 1e-9), max((1 - labels).sum(), 1e-9)
    pull_good, pull_bad = labels / (2 * good), (1 - labels) / (2 * bad)
    weights, seen = np.zeros(BUCKETS + 1), np.full(BUCKETS + 1, 1e-12)
    for _ in range(_STEPS):
        raw = np.bincount(rows, values * weights[cols], len(buckets)) + weights[-1]
        p = 1 / (1 + np.exp(-np.clip(raw, -30, 30)))
        error = pull_good * (1 - p) - pull_bad * p
        slope = np.append(np.bincount(cols, error[rows] * values, BUCKETS), error.sum()) - 1e-6 * weights
        seen += slope**2
        weights += 0.5 * slope / np.sqrt(seen)
    return weights


def _fit(chances: dict[int, float]):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(frames)).sort_values("h")
        labels = rows["pattern"].map(chances).to_numpy(np.float64)
        yield pd.DataFrame({"weights": [fit_scorer(list(rows["buckets"]), list(rows["shares"]), labels)]})

    return run


def _score(weights: np.ndarray, chances: dict[int, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            posterior, scores, n_votes = [], [], []
            for data, words in _texts(batch.column(1)):
                code = pattern_of(data, words)
                buckets, shares = features(data, words)
                raw = float(shares.astype(np.float64) @ weights[buckets] + weights[-1])
                scores.append(1 / (1 + np.exp(-np.clip(raw, -30, 30))) if len(words) else 0.0)
                posterior.append(chances.get(code))
                n_votes.append(int((_digits(np.array([code]))[0] != NONE).sum()))
            columns = [pa.array(n_votes, pa.int64()), pa.array(posterior, pa.float64()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "n_votes", "posterior", "score"])

    return run


def classify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """doc_id, n_votes, posterior, score, kept for every row."""
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    patterns = stored(texts.mapInArrow(_patterns, f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, pattern int"), "labels-patterns")
    # At most 3**8 rows.
    counted = patterns.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).orderBy("pattern").toPandas()
    good, _, _ = estimate_labels(counted["pattern"].to_numpy(np.int64), counted["n"].to_numpy(np.float64), KINDS, GOOD_PRIOR)
    chances = {int(p): float(g) for p, g in zip(counted["pattern"], good)}

    draw = F.xxhash64(F.lit(17), "doc_id").alias("h")
    chosen = patterns.where(F.col("doc_id").isNotNull()).select("doc_id", draw).distinct().orderBy("h", "doc_id").limit(sample)
    chosen = stored(chosen, "labels-sample")
    # One row of each id, whichever order they come in: a repeated id is one draw.
    sampled = texts.join(sized(chosen.select("doc_id"), sample), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    found = sampled.select("doc_id", "text").mapInArrow(_sample_features, f"doc_id {kind}, pattern int, buckets array<int>, shares array<float>")
    # Features are made where the texts are; the sample's size bounds the one task that fits.
    fitted = found.withColumn("h", F.xxhash64(F.lit(17), "doc_id")).drop("doc_id").repartition(1).mapInPandas(_fit(chances), "weights array<double>")
    row = fitted.first() if chances else None
    weights = np.array(row["weights"]) if row else np.zeros(BUCKETS + 1)
    scored = texts.mapInArrow(_score(weights, chances), f"doc_id {kind}, n_votes long, posterior double, score double")
    return scored.withColumn("kept", F.col("score") >= KEEP_LEAST)
