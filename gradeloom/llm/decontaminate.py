"""Benchmark decontamination: short test items inside long documents.

Containment search by MinHash, partitioned by size. Each test item keeps the smallest
hashes of its five-word shingles as its sketch; the size class of the item, a power of
two, sets how many: ``8 * (class + 1)``, which is all of them up to about 50 shingles. A
sketch shingle lies in a document with a chance equal to the containment, whatever the
document's length, so long documents need no sketch of their own: all their shingles are
looked up among the sketches, and a document that holds a quarter of an item's sketch is
a candidate (at containment 0.75 the chance of fewer is below 1e-5). Candidates are
confirmed by exact containment of the shingles as text.

Texts are lower-cased; an item of fewer than five words is one shingle of all of them,
looked for among the documents' runs of so many words. Items without words are in no
document; a null or blank document holds nothing. Rows without document id are checked
and reported with a null id; repeated rows are reported once. Equal items under
different ids are all reported.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeloom.llm.common import GAP, SHINGLE_WORDS, SIMILAR, sized, stored

PERCENT = int(100 * SIMILAR)
SKETCH_STEP = 8
CANDIDATE_SHARE = 0.25
# Rows of (hash, item) that may be broadcast: 2 MB.
BROADCAST_SKETCH = 100_000
BROADCAST_PAIRS = 20_000


def words_of(text: Column) -> Column:
    """Lower-cased words; empty for null."""
    pieces = F.split(F.lower(F.coalesce(text, F.lit(""))), GAP)
    return F.filter(pieces, lambda w: w != "")


def _runs(words: Column, lengths: Sequence[int], of) -> Column:
    """``of(words, position, length)`` for all runs of words of the given lengths.

    The words come in as a lambda variable: as an expression they would be cut out of the
    text again for each run.
    """

    def listed(w: Column, n: int) -> Column:
        last = F.size(w) - n
        return F.transform(F.filter(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: i <= last), lambda i: of(w, i, n))

    return F.flatten(F.transform(F.array(words), lambda w: F.concat(*[listed(w, n) for n in lengths])))


def _hash_run(words: Column, i: Column, length: int) -> Column:
    return F.xxhash64(*[F.get(words, i + j) for j in range(length)])


def _text_run(words: Column, i: Column, length: int) -> Column:
    return F.array_join(F.slice(words, i + 1, F.lit(length)), " ")


def item_sketches(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """item_id, n_words, texts (all shingles), need (hits of a candidate), sketch."""
    rows = items.select(F.col(id_col).alias("item_id"), words_of(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    rows = stored(rows.distinct(), "leaks-words")

    def shingles(of) -> Column:
        found = _runs(F.col("w"), [SHINGLE_WORDS], of)
        for n in range(1, SHINGLE_WORDS):
            found = F.when(F.size("w") == n, _runs(F.col("w"), [n], of)).otherwise(found)
        return F.array_distinct(found)

    hashed = rows.select("item_id", F.size("w").alias("n_words"), shingles(_text_run).alias("texts"), shingles(_hash_run).alias("hashes"))
    size_class = F.floor(F.log2(F.size("hashes").cast("double"))).cast("int")
    kept = F.least(F.size("hashes"), SKETCH_STEP * (size_class + 1))
    sketch = F.slice(F.array_sort("hashes"), F.lit(1), kept)
    return hashed.withColumn("sketch", sketch).withColumn("need", F.ceil(F.size("sketch") * CANDIDATE_SHARE).cast("int")).drop("hashes")


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """doc_id, item_id, n_item, n_shared, containment of every pair at 0.75 or more."""
    sketched = stored(item_sketches(items, item_id_col, item_text_col), "leaks-items")
    short = [n for n in range(1, SHINGLE_WORDS) if not sketched.where(F.col("n_words") == n).isEmpty()]
    lengths = [*short, SHINGLE_WORDS]
    probes = stored(sketched.select("item_id", "need", F.explode("sketch").alias("h")), "leaks-sketch")

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    runs = source.select("doc_id", words_of(F.col("text")).alias("w"))
    hashed = runs.select("doc_id", F.explode(_runs(F.col("w"), lengths, _hash_run)).alias("h"))
    hits = hashed.join(sized(probes, BROADCAST_SKETCH), "h").distinct()
    counted = hits.groupBy("doc_id", "item_id", "need").agg(F.count(F.lit(1)).alias("hits"))
    candidates = stored(counted.where(F.col("hits") >= F.col("need")).select("doc_id", "item_id"), "leaks-candidates")

    wanted = candidates.withColumnRenamed("doc_id", "__doc_id")
    paired = source.join(sized(wanted, BROADCAST_PAIRS), F.col("doc_id").eqNullSafe(F.col("__doc_id"))).drop("__doc_id")
    checked = paired.join(sketched.select("item_id", "texts"), "item_id")
    held = _runs(words_of(F.col("text")), lengths, _text_run)
    exact = checked.select(
        "doc_id", "item_id", F.size("texts").cast("long").alias("n_item"), F.size(F.array_intersect("texts", held)).cast("long").alias("n_shared")
    )
    result = exact.where(100 * F.col("n_shared") >= PERCENT * F.col("n_item"))
    return result.withColumn("containment", F.col("n_shared") / F.col("n_item")).distinct()


def without_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **columns: str) -> DataFrame:
    """The rows that hold no item; all columns as they are."""
    leaks = stored(find_leaks(docs, items, id_col, **columns).select(F.col("doc_id").alias("__leak")).distinct(), "leaks-found")
    return docs.join(sized(leaks, BROADCAST_PAIRS), docs[id_col].eqNullSafe(leaks["__leak"]), "left_anti")
