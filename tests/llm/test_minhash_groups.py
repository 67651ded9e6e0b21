"""Sketches of texts hashed side by side, and the generated code of the join that compares them."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gradeloom.llm import bbit_minhash
from gradeloom.llm.bbit_minhash import FINE_HASHES, FINE_LEAST, HASHES, band_keys, estimate, minima, near_duplicates, packed_bits
from gradeloom.llm.common import lower_ascii, mixed, shingle_hashes, shingle_sets, word_hashes

# The Java VM only interprets a method above this size, which costs several times the CPU time.
LARGEST_COMPILED = 8000


def odd_texts():
    rng = random.Random(3)
    fixed = [None, "", " \t\n", "a", "one two three four", "a b c d e", "A b C d E f", "x\x1cy z\x85w q r s t", " é ü a b c ", "w " * 5000, "end"]
    return fixed + ["".join(rng.choices("abC \n\x0b\x1fé　", k=rng.randint(0, 90))) for _ in range(400)]


def one_by_one(text):
    return shingle_hashes(word_hashes(lower_ascii((text or "").encode())))


@pytest.mark.parametrize("step", [1, 2, 7, 500])
def test_sets_of_many_texts_are_those_of_each(step):
    texts = odd_texts()
    encoded = [lower_ascii((text or "").encode()) for text in texts]
    found = [x for at in range(0, len(texts), step) for x in shingle_sets(encoded[at : at + step])]
    assert len(found) == len(texts)
    for text, x in zip(texts, found):
        assert x.dtype == np.uint64 and np.array_equal(x, one_by_one(text))
        assert np.array_equal(x, np.unique(x))


def test_words_and_runs_are_hashed_for_many_texts_at_once(monkeypatch):
    sizes = []
    hashed = bbit_minhash.shingle_sets
    monkeypatch.setattr(bbit_minhash, "shingle_sets", lambda texts: sizes.append((len(texts), sum(map(len, texts)))) or hashed(texts))
    texts = ["a b c d e f g"] * 300 + ["w " * 50_000, "", None, "x"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    assert sum(out.num_rows for out in bbit_minhash._sketch(iter([batch]))) == len(texts)
    assert sum(n for n, _ in sizes) == len(texts) and len(sizes) < 10
    assert all(n <= bbit_minhash._GROUP_TEXTS and (n == 1 or size <= bbit_minhash._GROUP_BYTES) for n, size in sizes)


def test_sketch_of_every_row():
    texts = odd_texts()
    ids = [None if i % 50 == 7 else i // 2 for i in range(len(texts))]
    batch = pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts)], ["doc_id", "text"])
    rows = pa.Table.from_batches(bbit_minhash._sketch(iter([batch, batch.slice(0, 0)]))).to_pylist()
    fine = pa.Table.from_batches(bbit_minhash._fine(iter([batch]))).to_pylist()
    for row, exact, id_, text in zip(rows, fine, ids, texts, strict=True):
        found = one_by_one(text)
        assert (row["doc_id"], row["n_shingles"]) == (id_, len(found))
        assert row["set_1"] == exact["set_1"] == found.sum(dtype=np.uint64).astype(np.int64)
        assert row["set_2"] == mixed(found).sum(dtype=np.uint64).astype(np.int64)
        least = minima(found)
        assert row["bands"] == (band_keys(least).view(np.int64).tolist() if len(found) else None)
        assert row["packed"] == (packed_bits(least).view(np.int64).tolist() if len(found) else None)
        assert exact["fine"] == packed_bits(minima(found, bbit_minhash._MULTIPLY_FINE)).view(np.int64).tolist()
        assert exact["whole"] == (found.view(np.int64).tolist() if len(found) <= bbit_minhash.WHOLE_SET else None)


@pytest.mark.parametrize("hashes", [HASHES, FINE_HASHES])
def test_estimate_counts_differing_pairs_of_bits(spark, hashes):
    rng = np.random.default_rng(1)
    words = -(-hashes // 32)
    a = rng.integers(-(2**63), 2**63, (20, words))
    b = np.where(rng.random((20, words)) < 0.5, a, rng.integers(-(2**63), 2**63, (20, words)))
    df = spark.createDataFrame([(i, x.tolist(), y.tolist()) for i, (x, y) in enumerate(zip(a, b))], "id int, l array<long>, r array<long>")
    got = [row.e for row in df.select("id", estimate("l", "r", hashes).alias("e")).orderBy("id").collect()]
    x = (a ^ b).astype(np.uint64)
    differing = np.bitwise_count((x | (x >> np.uint64(1))) & np.uint64(0x5555555555555555)).sum(1, dtype=int)
    assert got == [(1.0 - n / float(hashes) - 0.25) / 0.75 for n in differing.tolist()]


def test_long_signatures_are_compared_in_compiled_code(spark):
    session = spark.newSession()
    session.conf.set("spark.sql.adaptive.enabled", "false")
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    sides = [session.createDataFrame([], f"key long, {c} long, fine_{c} array<long>") for c in "ab"]
    alike = estimate("fine_a", "fine_b", FINE_HASHES) >= FINE_LEAST
    met = sides[0].join(sides[1], "key").where(alike & (F.col("a") < F.col("b"))).select("a", "b")
    module = getattr(session._jvm.org.apache.spark.sql.execution.debug, "package$")
    code = getattr(module, "MODULE$").codegenString(met._jdf.queryExecution().executedPlan())
    assert all(int(size) < LARGEST_COMPILED for size in re.findall(r"maxMethodCodeSize:(\d+)", code))


def test_null_and_repeated_rows_keep_their_groups(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text), (2, text + " end"), (2, text + " end"), (3, None), (4, ""), (4, ""), (None, text), (5, "other words here"), (5, None)]
    out = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in out.collect()), key=str)
    assert got == sorted(
        [(1, 56, 1, True), (2, 57, 1, False), (2, 57, 1, False), (3, 0, 3, True), (4, 0, 4, True), (4, 0, 4, True), (None, 56, None, True), (5, 1, 5, True), (5, 0, 5, True)],
        key=str,
    )
