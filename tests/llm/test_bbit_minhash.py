import random
import re

import numpy as np
import pytest

from gradeloom.llm import bbit_minhash
from gradeloom.llm.bbit_minhash import _MULTIPLY_FINE, FINE_HASHES, FINE_LEAST, HASHES, band_keys, minima, near_duplicates, packed_bits
from gradeloom.llm.common import shingle_hashes, word_hashes
from gradeloom.llm.components import components

SCHEMA = "doc_id long, text string, n_shingles string, kept int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    lower = (text or "").translate({i: i + 32 for i in range(65, 91)})
    words = WORD.findall(lower)
    if not words:
        return frozenset()
    span = min(5, len(words))
    return frozenset(tuple(words[i : i + span]) for i in range(len(words) - span + 1))


def brute(rows):
    sets = {i: shingles(t) for i, t, *_ in rows}
    owner = {i: i for i in sets}

    def find(i):
        while owner[i] != i:
            i = owner[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 75 * len(sets[a] | sets[b]):
                low, high = sorted((find(a), find(b)))
                owner[high] = low
    return sorted((i, len(sets[i]), find(i), find(i) == i) for i in ids)


def run(spark, rows):
    return sorted(tuple(r) for r in near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect())


def corpus():
    """Copies, near copies in chains, groups and short and blank texts."""
    pick = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, texts = [], []
    for base in range(25):
        words = [pick.choice(vocabulary) for _ in range(pick.choice([6, 30, 80, 200]))]
        texts.append(" ".join(words))
        for _ in range(pick.choice([0, 1, 4, 25])):
            changed = list(words)
            for _ in range(pick.choice([0, 1, 1, 2, 3])):
                changed[pick.randrange(len(words))] = pick.choice(vocabulary)
            texts.append((" \t" if pick.random() < 0.3 else " ").join(changed).upper() if pick.random() < 0.3 else " ".join(changed))
    texts += ["", " \n", None, "one", "ONE", "a b c", "a b c d e", "a b c d e f"]
    pick.shuffle(texts)
    for i, text in enumerate(texts):
        rows.append((i, text, "clash", 1))
    return rows


def test_matches_brute_force(spark):
    rows = corpus()
    assert run(spark, rows) == brute(rows)


def test_null_ids_and_repeated_rows(spark):
    rows = [(None, "a b c d e f", "", 0), (5, "a b c d e f", "", 0), (5, "a b c d e f", "", 0), (9, "A B C D E F", "", 0)]
    found = near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    by_id = sorted([(r["doc_id"], r["component_id"], r["kept"]) for r in found], key=str)
    assert by_id == [(5, 5, True), (5, 5, True), (9, 5, False), (None, None, True)]


def test_empty(spark):
    assert run(spark, []) == []


def test_estimate_and_bands_follow_similarity():
    pick = np.random.default_rng(5)
    base = pick.integers(0, 2**63, 400).astype(np.uint64)
    shared = []
    for keep in (400, 360, 300, 0):
        other = np.concatenate([base[:keep], pick.integers(0, 2**63, 400 - keep).astype(np.uint64)])
        a, b = minima(base), minima(other)
        same = keep / (800 - keep)
        assert np.mean(a == b) == pytest.approx(same, abs=0.12)
        x = packed_bits(a) ^ packed_bits(b)
        differing = sum(int((int(v) | int(v) >> 1) & 0x5555555555555555).bit_count() for v in x)
        assert ((1 - differing / HASHES) - 0.25) / 0.75 == pytest.approx(same, abs=0.14)
        shared.append(int((band_keys(a) == band_keys(b)).sum()))
    assert shared[0] == 40 and shared[0] > shared[1] > shared[2] > shared[3] == 0


def test_word_hashes_are_of_words():
    one = word_hashes("é a\tab  a\x0bé x".encode())
    assert len(one) == 5 and one[1] == one[3] and one[0] != one[4]
    long = word_hashes(("word " * 300_000).encode())
    assert len(long) == 300_000 and len(np.unique(long)) == 1
    assert len(shingle_hashes(long)) == 1


def test_components_of_a_long_chain_and_a_hub(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(5, 5)]
    found = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert all(found[i] == 100 for i in range(100, 161))
    assert all(found[i] == 7 for i in range(200, 260)) and 5 not in found


def test_mutual_near_copies_of_one_text(spark):
    """Many texts of one origin: most pairs share bands, lie just below or above 0.75, in several components."""
    pick = random.Random(11)
    vocabulary = [f"w{i}" for i in range(500)]
    origin = [pick.choice(vocabulary) for _ in range(120)]
    rows = []
    for i in range(160):
        words = list(origin)
        for _ in range(pick.choice([1, 2, 3, 4])):
            words[pick.randrange(len(words))] = pick.choice(vocabulary)
        rows.append((i, " ".join(words), "clash", 1))
    # The same id with another text joins what either text is close to.
    rows += [(7, rows[3][1], "clash", 1)]
    found = run(spark, rows)
    want = {i: c for i, _, c, _ in brute(rows[:-1])}
    assert len(set(want.values())) > 1
    assert [(i, c) for i, _, c, _ in found if i not in (3, 7)] == [(i, c) for i, c in sorted(want.items()) if i not in (3, 7)]


def test_second_signature_keeps_links():
    pick = np.random.default_rng(2)
    for n in (20, 60, 400):
        for _ in range(60):
            sets = pick.integers(0, 2**63, 2 * n).astype(np.uint64)
            shared = -(-6 * n // 7)  # similarity 0.75 or more
            a, b = (packed_bits(minima(x, _MULTIPLY_FINE)) for x in (sets[:n], sets[n - shared : 2 * n - shared]))
            differing = sum(int((int(v) | int(v) >> 1) & 0x5555555555555555).bit_count() for v in a ^ b)
            assert ((1 - differing / FINE_HASHES) - 0.25) / 0.75 >= FINE_LEAST


def test_pairs_below_the_least_similarity_do_not_leave_the_join(spark, monkeypatch):
    """Mutual near copies around 0.7 give no table of pairs; the links between them stay."""
    pick = random.Random(12)
    vocabulary = [f"w{i}" for i in range(900)]
    origin = [pick.choice(vocabulary) for _ in range(230)]
    rows = []
    for i in range(30):
        words = list(origin)
        for at in pick.sample(range(4, 226, 5), 4):
            words[at] = f"x{i}"
        rows.append((i, " ".join(words), "clash", 1))
    sizes, kept = [], bbit_minhash.stored

    def counted(df, label):
        out = kept(df, label)
        if label in ("minhash-pairs", "minhash-links"):
            sizes.append((label, out.count()))
        return out

    monkeypatch.setattr(bbit_minhash, "stored", counted)
    assert run(spark, rows) == brute(rows)
    # Of the second pass every pair is a link.
    (_, pairs), (_, links) = sizes[2:]
    assert pairs == links
