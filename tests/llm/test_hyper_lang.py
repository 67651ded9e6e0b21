import numpy as np
from pyspark.sql import functions as F

from gradeloom.llm.hyper_lang import DIMENSIONS, _letters, identify, ngram_codes, text_vectors

SCHEMA = "doc_id long, text string, lang string, score string, lang_pred int"
SAMPLES = {
    "en": "the quick brown fox jumps over the lazy dog and then the weather was nice with them",
    "de": "der schnelle braune Fuchs springt über den faulen Hund und dann war das Wetter schön mit ihnen",
    "fr": "le renard brun rapide saute par dessus le chien paresseux et puis il faisait beau avec eux",
}


def brute_vector(text):
    """One letter after the other, straight from the definition."""
    letters, total = _letters(DIMENSIONS).astype(int), np.zeros(DIMENSIONS, int)
    cleaned = " " + "".join(c if c.isalpha() else " " for c in text.lower()) + " "
    cleaned = " ".join(cleaned.split())
    if not cleaned:
        return total
    cleaned = f" {cleaned} "
    slot = [0 if c == " " else ord(c) - 96 if "a" <= c <= "z" else 27 + ord(c) % 101 for c in cleaned]
    for a, b, c in zip(slot, slot[1:], slot[2:]):
        total += np.roll(letters[a], 2) * np.roll(letters[b], 1) * letters[c]
    return total


def test_vectors_equal_brute_force():
    texts = [*SAMPLES.values(), "", "12 !", "é", "a-b  c\n\nД東", "x" * 5000]
    found = text_vectors([ngram_codes(t) for t in texts])
    for text, vector in zip(texts, found):
        assert (vector == brute_vector(text)).all(), text


def test_learns_and_leaves_unknown(spark):
    rows = [(i, " ".join(t.split()[i % 5 :]), lang, "", 0) for lang, t in SAMPLES.items() for i in range(10)]
    rows += [(50, None, "en", "", 0), (51, "", "en", "", 0), (52, "123 --", "de", "", 0), (53, "x", None, "", 0), (None, "the dog", None, "", 0)]
    rows += [(99, "the lazy dog was nice", "fr", "wrong label, not learned", 0)] * 2
    docs = spark.createDataFrame(rows, SCHEMA)
    found = [r.asDict(True) for r in identify(docs, F.coalesce(F.col("doc_id") < 50, F.lit(False))).collect()]
    assert len(found) == len(rows) and set(found[0]["row"]) == set(docs.columns)
    for r in found:
        assert 0 <= r["score"] <= 1
        if r["row"]["doc_id"] in (50, 51, 52):
            assert (r["lang_pred"], r["score"]) == ("und", 0)
        elif r["row"]["doc_id"] is not None and r["row"]["doc_id"] < 50:
            assert r["lang_pred"] == r["row"]["lang"]
    assert {r["lang_pred"] for r in found if r["row"]["doc_id"] in (99, None)} == {"en"}


def test_nothing_to_learn_and_empty(spark):
    docs = spark.createDataFrame([(1, "some text", None, "", 0)], SCHEMA)
    assert identify(docs, F.lit(True)).first()["lang_pred"] == "und"
    assert identify(spark.createDataFrame([], SCHEMA), F.lit(True)).collect() == []
