"""Near-duplicate documents by b-bit MinHash.

A document is the set of its distinct five-word shingles. 200 hash functions give 200
minima; five of them at a time make 40 band keys, and the two low bits of each minimum,
packed into seven words, are kept as its signature. Equal sets are one class from the
start, so copies never meet as pairs.

Candidates of a band bucket are first the pairs with its smallest class. A pair whose
signatures, by counts of equal bit pairs corrected for chance, show a similarity below
0.55 is dropped (five standard deviations under 0.75); the others are confirmed on full
sets. Members linked to the smallest class are in one component, so what is left of a
bucket are pairs with at least one member not linked to it. The classes of such buckets
get a second signature, two bits of 2048 minima, and a pair below 0.68 by that one is
dropped too (five standard deviations again). Two sets of at most 1024 shingles then are
compared as they are, so of mutual near copies just below 0.75 no pair leaves the join.
All that is compared inside the join, which gives a pair once, in the first bucket that it
shares, and the rest is confirmed alike. No other pair can change a component: no partner
is capped. The chance that a pair at similarity 0.75 shares no band is 2e-5, at 0.8 it is
1e-7.

Full sets are 64-bit shingle hashes; two shingles of one pair of documents share a hash
with a chance below 1e-9 for 100,000 words. Null, blank and empty texts have no shingles
and are linked with nothing. Rows without id take no part: component null, kept. Rows
that repeat an id are one document. Other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeloom.llm.common import SIMILAR, lower_ascii, mixed, shingle_sets, slices, stored
from gradeloom.llm.components import components

BANDS, ROWS, BITS = 40, 5, 2
HASHES = BANDS * ROWS
ESTIMATE_LEAST = 0.55
# The longer signature of classes in buckets of several components.
FINE_HASHES, FINE_LEAST = 2048, 0.68
# Sets up to this size (8 kB) travel to their buckets whole; pairs of larger ones are confirmed apart.
WHOLE_SET = 1024
PERCENT = int(100 * SIMILAR)
# Ids of documents whose full sets are needed: so many longs may be broadcast (4 MB).
BROADCAST_IDS = 500_000
_LANES = 64 // BITS
_CHUNK = 1024
# At most so many texts, of so many bytes together, are hashed at once, in a few MB.
_GROUP_TEXTS, _GROUP_BYTES = 64, 1 << 16
# Words of a signature that a join compares one by one in generated code.
_SPELT_OUT = 8

_SKETCH = "doc_id long, n_shingles long, set_1 long, set_2 long, bands array<long>, packed array<long>"


def _multipliers(first: int, count: int) -> np.ndarray:
    return (mixed(np.arange(first, first + count, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


_MULTIPLY = _multipliers(1, HASHES)
_MULTIPLY_FINE = _multipliers(HASHES + 1, FINE_HASHES)


def minima(shingles: np.ndarray, multiply: np.ndarray = _MULTIPLY) -> np.ndarray:
    """The least value of every hash function over a set."""
    base = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(multiply), np.uint32(0xFFFFFFFF))
    step = max(1, _CHUNK * HASHES // len(multiply))
    for at in range(0, len(base), step):
        np.minimum(least, (base[at : at + step, None] * multiply).min(0), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    """One key per band of minima, different for each band; for one document or a row for each."""
    wide = least.astype(np.uint64).reshape(*least.shape[:-1], BANDS, ROWS)
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    for i in range(ROWS):
        keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + wide[..., i])
    return keys


def packed_bits(least: np.ndarray) -> np.ndarray:
    """The low bits of all minima side by side in 64-bit words; for one document or a row for each."""
    # The multiplier is odd, so plain low bits would be low bits of the shingle hash.
    low = (mixed(least.astype(np.uint64)) & np.uint64((1 << BITS) - 1)) << (
        np.arange(least.shape[-1], dtype=np.uint64) % np.uint64(_LANES) * np.uint64(BITS)
    )
    words = -(-least.shape[-1] // _LANES)
    padded = np.zeros((*least.shape[:-1], words * _LANES), np.uint64)
    padded[..., : least.shape[-1]] = low
    return np.bitwise_or.reduce(padded.reshape(*least.shape[:-1], words, _LANES), axis=-1)


def _encoded(column: pa.Array) -> Iterator[bytes]:
    for value in column.cast(pa.binary() if column.type != pa.large_string() else pa.large_binary()):
        yield value.as_py() or b""


def _set_groups(column: pa.Array) -> Iterator[list[np.ndarray]]:
    """The shingle sets of all texts in order, in groups hashed at once."""
    group, size = [], 0
    for text in _encoded(column):
        if group and (len(group) == _GROUP_TEXTS or size + len(text) > _GROUP_BYTES):
            yield shingle_sets(group)
            group, size = [], 0
        group.append(lower_ascii(text))
        size += len(text)
    if group:
        yield shingle_sets(group)


def _sums(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The sum of every set and of its values mixed, modulo 2**64."""
    ends = np.cumsum([len(found) for found in sets])
    values = np.concatenate(sets)

    def each(values: np.ndarray) -> np.ndarray:
        running = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values, out=running[1:])
        return np.diff(running[ends], prepend=np.uint64(0)).view(np.int64)

    return each(values), each(mixed(values))


def _least(sets: list[np.ndarray], multiply: np.ndarray = _MULTIPLY) -> np.ndarray:
    return np.stack([minima(found, multiply) for found in sets])


def _lists(rows: list[np.ndarray], filled: np.ndarray) -> pa.Array:
    """Lists of whole numbers from blocks of rows; null where not ``filled``."""
    every = np.concatenate(rows).view(np.int64)
    offsets = np.r_[0, np.cumsum(filled * every.shape[1])].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(every[filled].ravel()), mask=pa.array(~filled))


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        sizes, first, second, bands, packed = [], [], [], [], []
        for sets in _set_groups(batch.column(1)):
            sizes += [len(found) for found in sets]
            plain, spread = _sums(sets)
            first.append(plain)
            second.append(spread)
            least = _least(sets)
            bands.append(band_keys(least))
            packed.append(packed_bits(least))
        filled = np.array(sizes) > 0
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(sizes, pa.int64()),
                pa.array(np.concatenate(first)),
                pa.array(np.concatenate(second)),
                _lists(bands, filled),
                _lists(packed, filled),
            ],
            ["doc_id", "n_shingles", "set_1", "set_2", "bands", "packed"],
        )


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        sets = [found.view(np.int64) for group in _set_groups(batch.column(1)) for found in group]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], ["class_id", "shingles"])


def _fine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        sums, fine, whole = [], [], []
        for sets in _set_groups(batch.column(1)):
            sums.append(_sums(sets)[0])
            fine.append(packed_bits(_least(sets, _MULTIPLY_FINE)))
            whole += [found.view(np.int64) if len(found) <= WHOLE_SET else None for found in sets]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.concatenate(sums)), _lists(fine, np.ones(batch.num_rows, bool)), pa.array(whole, pa.list_(pa.int64()))],
            ["class_id", "set_1", "fine", "whole"],
        )


def estimate(left: str, right: str, hashes: int = HASHES) -> Column:
    """Similarity from two packed signatures, corrected for chance agreement of low bits."""

    def lanes(a: Column, b: Column) -> Column:
        x = a.bitwiseXOR(b)
        return F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x5555555555555555)))

    words = -(-hashes // _LANES)
    if words <= _SPELT_OUT:
        differing = F.lit(0)
        for i in range(words):
            differing = differing + lanes(F.col(left)[i], F.col(right)[i])
    else:
        # Spelt out, these would make a method that the Java VM only interprets.
        differing = F.aggregate(F.zip_with(left, right, lanes), F.lit(0), lambda total, more: total + more)
    chance = 1 / (1 << BITS)
    return (F.lit(1.0) - differing / F.lit(float(hashes)) - F.lit(chance)) / F.lit(1 - chance)


def _may_match(a: str = "a", b: str = "b") -> Column:
    """Sizes and signatures that do not exclude a link."""
    small, large = F.least(f"n_{a}", f"n_{b}"), F.greatest(f"n_{a}", f"n_{b}")
    return (100 * small >= PERCENT * large) & (estimate(f"packed_{a}", f"packed_{b}") >= ESTIMATE_LEAST)


def _linked(a: str, b: str) -> Column:
    """Whether two full sets are similar enough; null if one is not there."""
    # 100 * shared >= PERCENT * union, the intersection being made once.
    return (100 + PERCENT) * F.size(F.array_intersect(a, b)) >= PERCENT * (F.size(a) + F.size(b))


def _with_class(pairs: DataFrame, classes: DataFrame, side: str, *columns: str) -> DataFrame:
    other = classes.select(F.col("class_id").alias(side), *[F.col(c).alias(f"{'n' if c == 'n_shingles' else c}_{side}") for c in columns])
    return pairs.join(other, side)


def _with_component(rows: DataFrame, found: DataFrame, node: str, output: str) -> DataFrame:
    """Add the component of a class; a class without links is its own."""
    other = found.select(F.col("node").alias(node), F.col("component").alias(output))
    return rows.join(other, node, "left").withColumn(output, F.coalesce(output, node))


class _Confirm:
    """Checks candidate pairs on full sets, read again from the texts that are needed."""

    def __init__(self, docs: DataFrame) -> None:
        self.docs = docs

    def texts(self, ids: DataFrame) -> DataFrame:
        """The texts of stored ids, given as ``doc_id``."""
        few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
        return self.docs.join(F.broadcast(ids) if few else ids, "doc_id", "left_semi")

    def __call__(self, pairs: DataFrame) -> DataFrame:
        pairs = stored(pairs, "minhash-pairs")
        needed = stored(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "minhash-needed")
        sets = stored(self.texts(needed).mapInArrow(_full_sets, "class_id long, shingles array<long>"), "minhash-sets")
        both = _with_class(_with_class(pairs.select("a", "b"), sets, "a", "shingles"), sets, "b", "shingles")
        return stored(both.where(_linked("shingles_a", "shingles_b")).select("a", "b").distinct(), "minhash-links")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sketches = stored(texts.mapInArrow(_sketch, _SKETCH), "minhash-sketches")
    same = ["set_1", "set_2", "n_shingles"]
    usable = sketches.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    classes = stored(
        usable.groupBy(*same).agg(F.min("doc_id").alias("class_id"), F.first("bands").alias("bands"), F.first("packed").alias("packed")),
        "minhash-classes",
    )

    banded = classes.select("class_id", F.explode("bands").alias("key"))
    buckets = banded.groupBy("key").agg(F.min("class_id").alias("pivot"), F.count(F.lit(1)).alias("members"))
    members = banded.join(buckets.where(F.col("members") > 1), "key").where(F.col("class_id") != F.col("pivot"))
    members = stored(members, "minhash-members")

    confirm = _Confirm(texts)
    first = members.select(F.col("pivot").alias("a"), F.col("class_id").alias("b")).distinct()
    first = _with_class(_with_class(first, classes, "a", "n_shingles", "packed"), classes, "b", "n_shingles", "packed")
    links = confirm(first.where(_may_match()).select("a", "b"))

    # A pair inside one component cannot change anything any more. Of a pair between two
    # components at least one is not in that of the bucket's smallest class.
    found = stored(components(links).select("node", "component"), "minhash-found")
    crowded = members.where(F.col("members") > 2)
    placed = _with_component(_with_component(crowded, found, "class_id", "own"), found, "pivot", "first")
    placed = stored(placed.withColumn("apart", F.col("own") != F.col("first")), "minhash-placed")
    mixed_keys = stored(placed.where("apart").select("key").distinct(), "minhash-mixed")
    placed = stored(placed.join(mixed_keys, "key", "left_semi").select("key", "class_id", "own", "apart"), "minhash-crowded")
    ids = stored(placed.select(F.col("class_id").alias("doc_id")).distinct(), "minhash-ids")
    fine = confirm.texts(ids).mapInArrow(_fine, "class_id long, set_1 long, fine array<long>, whole array<long>")
    # An id may be repeated, with the same text or another.
    fine = fine.groupBy("class_id", "set_1").agg(F.first("fine").alias("fine"), F.first("whole").alias("whole"))
    signed = stored(classes.join(fine, ["class_id", "set_1"]), "minhash-signed")
    columns = ("n_shingles", "packed", "fine", "whole", "bands")
    left = placed.where("apart").select("key", F.col("class_id").alias("a"), F.col("own").alias("own_a"))
    right = placed.select("key", F.col("class_id").alias("b"), F.col("own").alias("own_b"), "apart")
    left, right = _with_class(left, signed, "a", *columns), _with_class(right, signed, "b", *columns)
    once = (~F.col("apart") | (F.col("a") < F.col("b"))) & (F.col("own_a") != F.col("own_b"))
    alike = estimate("fine_a", "fine_b", FINE_HASHES) >= FINE_LEAST
    first_shared = F.array_intersect("bands_a", "bands_b")[0] == F.col("key")
    whole = F.col("whole_a").isNull() | F.col("whole_b").isNull() | _linked("whole_a", "whole_b")
    # A pair meets in every bucket that it shares: the costlier comparisons are made in one of them.
    met = left.join(right, "key").where(once & _may_match() & first_shared & alike & whole)
    second = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    found = components(links.union(confirm(second)))

    owner = classes.select(*same, "class_id").join(found.withColumnRenamed("node", "class_id"), "class_id", "left")
    owner = owner.select(*same, F.coalesce("component", "class_id").alias("owner"))
    joined = sketches.select("doc_id", *same).join(owner, same, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("owner", "doc_id"))
    kept = F.coalesce(F.col("doc_id") == component, F.lit(True))
    return joined.select("doc_id", "n_shingles", component.alias("component_id"), kept.alias("kept"))
