import numpy as np
import pytest
from pyspark.sql import functions as F

from gradeloom.llm import ftrl_toxicity as tox
from gradeloom.llm.common import crc_mod

WORDS = np.array([f"w{i}" for i in range(300)])
BAD = ["zorg", "blick", "fump"]


def made(n, seed=1):
    """Rows of words, every fifth with bad ones, and their labels."""
    rng = np.random.default_rng(seed)
    docs, labels = [], []
    for i in range(n):
        words = list(rng.choice(WORDS, int(rng.integers(5, 60))))
        if i % 5 == 0:
            for word in rng.choice(BAD, 3):
                words.insert(int(rng.integers(len(words))), str(word).capitalize() + ",")
        docs.append((i, " ".join(words)))
        labels.append((i, int(i % 5 == 0)))
    return docs, labels


def scored(spark, docs, labels, schema="doc_id long, text string", **options):
    d, y = spark.createDataFrame(docs, schema), spark.createDataFrame(labels, "doc_id long, toxic int")
    return tox.score_toxicity(d, y, crc_mod("doc_id", 4) == 2, **options)


def test_held_out_rows_are_told_apart(spark):
    docs, labels = made(1500)
    rows = [r for r in scored(spark, docs, labels).collect() if r.held_out]
    assert len(rows) > 250
    caught = [r.predicted for r in rows if r.doc_id % 5 == 0]
    clean = [r.predicted for r in rows if r.doc_id % 5]
    assert np.mean(caught) > 0.95 and np.mean(clean) < 0.01
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_held_out_labels_are_never_read(spark):
    docs, labels = made(300)
    held = {r.doc_id for r in spark.createDataFrame(docs, "doc_id long, text string").where(crc_mod("doc_id", 4) == 2).collect()}
    turned = [(i, 1 - y if i in held else y) for i, y in labels]
    assert scored(spark, docs, labels).collect() == scored(spark, docs, turned).collect()


def test_regression_equals_the_formulas():
    """Each step against plain numbers, place by place."""
    rng = np.random.default_rng(2)
    model, z, n = tox.Regression(), {}, {}

    def weight(i):
        bound = 0 if i == tox.BUCKETS else tox.L1
        if abs(z.get(i, 0)) <= bound:
            return 0.0
        return -(z[i] - np.sign(z[i]) * bound) * tox.ALPHA / (tox.BETA + n[i] ** 0.5)

    for step in range(400):
        places = np.unique(rng.integers(0, 12, 5)).astype(np.int32)
        label = float(places[0] == 0)
        both = [*places.tolist(), tox.BUCKETS]
        w = {i: weight(i) for i in both}
        gradient = 1 / (1 + np.exp(-sum(w.values()))) - label
        for i in both:
            before = n.get(i, 0.0)
            n[i] = before + gradient**2
            z[i] = z.get(i, 0.0) + gradient - (n[i] ** 0.5 - before**0.5) / tox.ALPHA * w[i]
        model.learn(places, label)
    places, weights = model.kept()
    assert dict(zip(places.tolist(), weights)) == pytest.approx({i: weight(i) for i in z if abs(z[i]) > tox.L1 or i == tox.BUCKETS}, rel=1e-3)
    assert 0 < len(places) - 1 < 12


def test_odd_rows(spark):
    docs, labels = made(200)
    docs = [(i, t, None) for i, t in docs] + [(1000, None, 1), (1001, "", 2), (None, "zorg", 3), (7, docs[0][1], 4), (1002, "...", 5)]
    labels += [(5000, 1), (1000, None), (None, 1), (0, 0)]
    rows = scored(spark, docs, labels, "doc_id long, text string, label long").collect()
    assert len(rows) == len(docs)
    empty = {r.score for r in rows if r.doc_id in (1000, 1001, 1002)}
    assert len(empty) == 1
    (same,) = {r.score for r in rows if r.doc_id == 7 and r.score != 0} & {r.score for r in rows if r.doc_id == 0}
    assert same is not None
    (no_id,) = [r for r in rows if r.doc_id is None]
    assert no_id.held_out is False


def test_no_labels_and_no_rows(spark):
    docs, _ = made(10)
    assert {(r.score, r.predicted) for r in scored(spark, docs, []).collect()} == {(0.0, 0)}
    assert scored(spark, [], [(1, 1)]).collect() == []


def test_sample_is_bounded_and_reruns_agree(spark):
    docs, labels = made(200)
    d, y = (spark.createDataFrame(x, s) for x, s in ((docs, "doc_id long, text string"), (labels, "doc_id long, toxic int")))
    one = tox.fit(d, y, F.lit(True), sample=50)
    other = tox.fit(d.repartition(7), y.repartition(5), F.lit(True), sample=50)
    assert one[0].tolist() == other[0].tolist() and one[1].tolist() == other[1].tolist()
    assert one[0].tolist() != tox.fit(d, y, F.lit(True))[0].tolist()


def test_long_text_in_stretches(monkeypatch):
    text = "Alpha béta " * 3000 + "end"
    whole = tox.features(text)
    monkeypatch.setattr(tox, "_CHUNK", 64)
    assert tox.features(text).tolist() == whole.tolist() and len(whole) == 4 * 6001 - 6
