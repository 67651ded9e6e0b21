import random

import numpy as np

from gradeloom.llm.common import word_hashes
from gradeloom.llm.weak_labels import BAD, BUCKETS, LABELLERS, NONE, classify, estimate_labels, features, fit_scorer, votes

SCHEMA = "doc_id long, text string, score string, kept int"


def prose(pick, n):
    words = ["".join(pick.choice("abcdefghijklmnoprstuvw") for _ in range(pick.randint(2, 9))) for _ in range(n)]
    return "\n".join(" ".join(words[i : i + 12]).capitalize() + "." for i in range(0, n, 12))


def junk(pick, n):
    kind = pick.randrange(4)
    words = prose(pick, n).split()
    if kind == 0:
        return " ".join(w + pick.choice(["***", "###", "%%%"]) for w in words)
    if kind == 1:
        return " ".join(w.upper() + "!!" for w in words)
    if kind == 2:
        return " ".join(w for w in words[: n // 10 + 1] for _ in range(10))
    return " | ".join(words)


def test_expectation_maximisation_finds_accuracies():
    """Votes drawn with known accuracies, a third of them missing."""
    pick = np.random.default_rng(1)
    truth = pick.random(40_000) < 0.8
    accuracy = np.linspace(0.6, 0.95, len(LABELLERS))
    given = np.where(pick.random((len(truth), len(LABELLERS))) < accuracy, truth[:, None], ~truth[:, None]).astype(int)
    given[pick.random(given.shape) < 0.3] = NONE
    codes, counts = np.unique(given @ 3 ** np.arange(len(LABELLERS))[::-1], return_counts=True)
    good, found, share = estimate_labels(codes, counts.astype(float))
    assert abs(share - 0.8) < 0.03
    assert np.abs(found - accuracy[:, None]).max() < 0.08
    assert ((good >= 0) & (good <= 1)).all()


def test_scorer_learns_shapes():
    pick = random.Random(2)
    texts = [(prose(pick, 60), 1.0) for _ in range(60)] + [(junk(pick, 60), 0.0) for _ in range(30)]
    found = [features(t.encode(), word_hashes(t.encode())) for t, _ in texts]
    weights = fit_scorer([f[0] for f in found], [f[1] for f in found], np.array([y for _, y in texts]))
    assert len(weights) == BUCKETS + 1
    raw = np.array([f[1] @ weights[f[0]] + weights[-1] for f in found])
    assert ((raw > 0) == (np.arange(90) < 60)).mean() > 0.97


def test_keeps_clean_and_drops_junk(spark):
    pick = random.Random(3)
    rows = [(i, junk(pick, 80) if i % 5 == 0 else prose(pick, 80), "clash", 0) for i in range(400)]
    rows += [(900, None, "", 0), (901, " ", "", 0), (None, prose(pick, 50), "", 0), (902, rows[1][1], "", 0), (902, rows[1][1], "", 0), (903, "word " * 50_000, "", 0)]
    found = classify(spark.createDataFrame(rows, SCHEMA), sample=300).collect()
    assert len(found) == len(rows)
    own = [r for r in found if r["doc_id"] is not None and r["doc_id"] < 400]
    clean, bad = [r for r in own if r["doc_id"] % 5], [r for r in own if r["doc_id"] % 5 == 0]
    assert all(r["kept"] for r in clean)
    assert sum(not r["kept"] for r in bad) >= 0.9 * len(bad)
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[900]["score"] == by_id[901]["score"] == 0 and not by_id[900]["kept"]
    assert by_id[902]["score"] == by_id[1]["score"] and by_id[None]["kept"]


def test_empty_table_and_missing_votes(spark):
    assert classify(spark.createDataFrame([], SCHEMA)).collect() == []
    assert votes(b"", word_hashes(b"")) == [NONE] * len(LABELLERS)
    text = b"LOUD WORDS EVERYWHERE NOW"
    assert BAD in votes(text, word_hashes(text))


def test_expectation_maximisation_as_classify_uses_it():
    """Junk of several sorts; on good documents 'sentences' errs in a tenth, all others rarely."""
    from gradeloom.llm.weak_labels import GOOD_PRIOR, KINDS

    pick, n = np.random.default_rng(5), 40_000
    truth, sort = pick.random(n) < 0.8, pick.integers(0, 4, n)
    ending = LABELLERS.index("sentences")
    wrong = np.where(np.arange(len(LABELLERS)) == ending, 0.1, 0.004)
    sees = np.full((4, len(LABELLERS)), 0.02)
    for i, name in enumerate(("symbols", "capitals", "same_word", "bare_signs")):
        sees[i, LABELLERS.index(name)] = 0.95
    sees[:, ending] = 0.6
    bad_vote = pick.random((n, len(LABELLERS))) < np.where(truth[:, None], wrong, sees[sort])
    codes, inverse, counts = np.unique((~bad_vote).astype(int) @ 3 ** np.arange(len(LABELLERS))[::-1], return_inverse=True, return_counts=True)
    good, found, share = estimate_labels(codes, counts.astype(float), KINDS, GOOD_PRIOR)
    assert abs(share - 0.8) < 0.05 and abs(found[ending, 1] - 0.9) < 0.02
    by_code = dict(zip(codes, good))
    assert by_code[sum(3**i for i in range(8)) - 3 ** (7 - ending)] > 0.9
    assert ((good[inverse] > 0.5) == truth).mean() > 0.95


def test_ends_in_quotes_brackets_and_other_scripts():
    ending = LABELLERS.index("sentences")
    body = "some plain words that stand in one line " * 4
    for end in ('said so."', "said so.)", "said so.\u201d", "said so\u3002", "said so\u0964", "said so\u2026"):
        text = (body + end).encode()
        assert votes(text, word_hashes(text))[ending] == 1, end
    text = (body + "said so").encode()
    assert votes(text, word_hashes(text))[ending] == BAD


def test_repeated_ids_are_fitted_once(spark):
    """One id a hundred times is one document of the sample, whatever else stands there."""
    pick = random.Random(6)
    rows = [(i, junk(pick, 80) if i % 4 == 0 else prose(pick, 80), "", 0) for i in range(80)]
    once = {r["doc_id"]: r["posterior"] is not None and r["score"] for r in classify(spark.createDataFrame(rows, SCHEMA), sample=60).collect()}
    import gradeloom.llm.weak_labels as W

    seen = []
    fit = W._fit

    def counting(chances):
        inner = fit(chances)

        def run(frames):
            frames = list(frames)
            assert sum(map(len, frames)) <= 60
            yield from inner(iter(frames))

        seen.append(1)
        return run

    W._fit = counting
    try:
        found = classify(spark.createDataFrame(rows + [rows[1]] * 100, SCHEMA), sample=60).collect()
    finally:
        W._fit = fit
    assert seen and len(found) == 180 and len(once) == 80
