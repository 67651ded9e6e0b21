import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from gradeloom.llm import token_align
from gradeloom.llm.token_align import Vocabulary, align, cut_places

FILES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def words():
    return Vocabulary(*FILES)


def aligned(words, text):
    """Groups of whole texts, token by token."""
    if not text:
        return None
    a, b = words.a.encode(" " + text, add_special_tokens=False).ids, words.b.encode(text)
    full = (" " + text).encode()
    if b"".join(words.bytes_a[i] for i in a) != full or b"".join(words.bytes_b[i] for i in b) != full:
        return None
    groups, mine, theirs, at_a, at_b = [], [], [], 0, 0
    i = j = 0
    while i < len(a) or j < len(b):
        if at_a <= at_b:
            mine.append(a[i])
            at_a, i = at_a + len(words.bytes_a[a[i]]), i + 1
        else:
            theirs.append(b[j])
            at_b, j = at_b + len(words.bytes_b[b[j]]), j + 1
        if at_a == at_b:
            groups.append((mine, theirs))
            mine, theirs = [], []
    return groups


def brute(words, rows):
    found = [(key, aligned(words, text)) for key, text in rows]
    links = [[(x, y) for p, q in groups or [] for x in p for y in q] for _, groups in found]
    count, best = Counter(), defaultdict(int)
    for each in links:
        count.update(set(each))
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    out = []
    for (key, groups), each in zip(found, links):
        spelled = ";".join(f"{','.join(map(str, p))}|{','.join(map(str, q))}" for p, q in groups or [])
        sizes = [sum(len(g[side]) for g in groups or []) for side in (0, 1)]
        n_best, total = sum(count[x] == best[x[0]] for x in each), sum(count[x] for x in each)
        digest = "" if groups is None else hashlib.sha256(spelled.encode()).hexdigest()
        out.append((key, *sizes, len(groups or []), len(each), n_best, total, digest))
    return Counter(out)


TEXTS = [
    "The quick brown fox, naïve café — 東京 12345 'tis \t two  spaces\n\n and  more ",
    " leading and   many    blanks ",
    "<|endoftext|> is <s> plain </s> text <unk>",
    "not▁spelled by the other side",
    "x" * 2000 + " " + "=" * 500 + " end",
    "\x00\x01 \x7f odd blanks　here and \u0085there a\r\n b",
    "ﬁ Ⅳ é é 😀😀 🏳️‍🌈 ok",
    "", None, " ", "\n", "a", "aé", "the the the the", "the the the the", "the the the the",
]


def result(df):
    return Counter(tuple(r) for r in df.collect())


def test_equals_brute_force(spark, words):
    rows = list(enumerate(TEXTS)) + [(None, "rows without id"), (3, "repeated id"), (3, "repeated id")]
    got = result(align(spark.createDataFrame(rows, "doc_id long, text string"), *FILES))
    assert got == brute(words, rows)
    assert sum(r[1] == 0 for r in got) == 3  # empty, null and not spelled


def test_blocks_do_not_matter(spark, words, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(rng.choice(["alpha", "Beta-gamma", "δ", "12.5", "the", "ofthe"], 30))) for i in range(40)]
    rows += rows[:5]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    whole = result(align(df, *FILES))
    small = token_align.align_block([t.encode() for _, t in rows[:3]], [1, 1, 1], words)
    monkeypatch.setattr(token_align, "_PART", 8)
    parts = token_align.align_block([t.encode() for _, t in rows[:3]], [1, 1, 1], words)
    assert small["pair_docs"][0].tolist() == parts["pair_docs"][0].tolist()
    assert whole == brute(words, rows)


def test_large_groups_are_linked_by_distinct_ids(words, monkeypatch):
    cuts = [(" " + t).encode() for t in ("thanedble", "x" * 60, "1234567890" * 4)]
    listed = token_align.Aligned(cuts, words)
    monkeypatch.setattr(token_align, "_MANY", 0)
    distinct = token_align.Aligned(cuts, words)
    for name in ("pairs", "links", "pair_at", "pair_n", "n_links"):
        assert getattr(listed, name).tolist() == getattr(distinct, name).tolist(), name


def test_cuts_keep_the_tokens(words):
    text = " A  b　 c,d e  f\n g .h   i▁ j"
    raw = np.frombuffer(text.encode(), np.uint8)
    edges = [0, *cut_places(raw).tolist(), len(raw)]
    cuts = [text.encode()[i:j] for i, j in zip(edges, edges[1:])]
    parts = words.tokens(cuts)
    assert len(cuts) > 5
    assert sum(parts[0], []) == words.a.encode(text, add_special_tokens=False).ids
    assert sum(parts[1], []) == words.b.encode(text[1:])


def test_no_rows_and_clashing_columns(spark, words):
    schema = "doc_id long, text string, weight long, block long, pair long, digest string"
    assert result(align(spark.createDataFrame([], schema), *FILES)) == Counter()
    rows = [(1, "one text", 1, 2, 3, "x"), (2, "one text", 4, 5, 6, "y")]
    assert result(align(spark.createDataFrame(rows, schema), *FILES)) == brute(words, [r[:2] for r in rows])
    assert result(align(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string"), *FILES)) == brute(words, [(1, None), (2, "")])
