import re
from collections import Counter

import numpy as np
import pytest

from gradeloom.llm import collocations
from gradeloom.llm.collocations import Bits, Stretch, bit_table, collocations as mine, stretches

SCHEMA = "doc_id long, text string, lang string"


def brute(rows, least, top=2000):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\n-\r]", lowered):
            words = re.findall(r"[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    found = {}
    for (lang, p), a in f.items():
        if len(p) < 2 or a < least:
            continue
        longer = [x for (other, x), c in f.items() if other == lang and len(x) > len(p) and c >= least and 100 * c >= 80 * a]
        if any(x[i : i + len(p)] == p for x in longer for i in range(len(x) - len(p) + 1)):
            continue
        cuts = [(2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        found.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    out = set()
    for lang, each in found.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(each)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return out


def rows_of(df):
    return {(r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect()}


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(5)
    words = ["Red", "fox", "é", "a", "b", "c|d", "runs", "far", "x" * 300]
    rows = []
    for i in range(120):
        picked = rng.choice(words, 40, p=[0.2, 0.2, 0.1, 0.1, 0.1, 0.1, 0.1, 0.09, 0.01])
        signs = rng.choice([" ", "\t ", ". ", "\n", ", "], 40, p=[0.7, 0.1, 0.1, 0.05, 0.05])
        rows.append((i, "".join(w + s for w, s in zip(picked, signs)), ["en", "fr", None, "und"][i % 4]))
    rows += [(500, None, "en"), (501, "", None), (502, " .,\n", "zz"), (None, "red fox far " * 40, "en"), (7, "red fox far " * 40, "en")]
    return rows


def test_equals_brute_force(spark, texts):
    rows = [(t, lang) for _, t, lang in texts]
    got = rows_of(mine(spark.createDataFrame(texts, SCHEMA), least=8))
    assert got == brute(rows, 8) and len({r[0] for r in got}) == 3


def test_ties_go_by_phrase_and_top_counts(spark):
    text = "b a. d c. f e. " * 31
    got = sorted(rows_of(mine(spark.createDataFrame([(1, text, "en")], SCHEMA), top=2)), key=lambda r: r[1])
    assert [(r[1], r[2]) for r in got] == [(1, "b a"), (2, "d c")]


def test_small_bit_tables_change_nothing(spark, texts, monkeypatch):
    """With a table of too few bits nearly all bits are set, and more windows are counted whole."""
    monkeypatch.setattr(collocations, "bits_for", lambda count: 64)
    rows = [(t, lang) for _, t, lang in texts]
    assert rows_of(mine(spark.createDataFrame(texts, SCHEMA), least=8)) == brute(rows, 8)


def test_no_rows_and_clashing_columns(spark):
    schema = SCHEMA + ", n long, w1 string, a long, h long"
    assert rows_of(mine(spark.createDataFrame([], schema))) == set()
    rows = [(1, "w1 a " * 40, "en", 5, "x", 6, 7)]
    assert rows_of(mine(spark.createDataFrame(rows, schema))) == brute([(rows[0][1], "en")], 30)


def test_long_text_is_cut_behind_pieces():
    import pyarrow as pa

    text = ("one two, " * 400 + "x" * 900 + ". end ") * 3
    batch = pa.RecordBatch.from_arrays([pa.array([text, "q"]), pa.array(["en", "en"])], ["text", "lang"])
    parts = list(stretches([batch], size=500))
    assert len(parts) > 5
    words = Counter(w for _, part in parts for s in [Stretch(part)] for w in np.array(s.words, object)[s.numbers])
    assert words == Counter(w.encode() for w in re.findall(r"[^ \t.,]+", text) + ["q"])


def test_bit_table_holds_its_slots(spark):
    slots = [0, 1, 7, 8, 32767, 32768, 65535]
    bits = bit_table(spark.createDataFrame([(s,) for s in slots], "slot long"), 1 << 16)
    assert isinstance(bits, Bits)
    assert np.flatnonzero(bits.of(np.arange(1 << 16, dtype=np.uint64))).tolist() == slots


def test_scores_beyond_64_bits(spark):
    big = 9_000_000_000_000_000
    rows = [("en", 1, 1, 0, 0, 0, big), ("en", 1, 2, 0, 0, 0, big + 2), ("en", 2, 1, 2, 0, 0, big - 1)]
    counts = spark.createDataFrame(rows, "lang string, level int, w1 long, w2 long, w3 long, w4 long, a long")
    (row,) = collocations.scored_phrases(counts).collect()
    assert row.score == 2_000_000 * (big - 1) // (2 * big + 2) and (row.l, row.r) == (big, big + 2)
