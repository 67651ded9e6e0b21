"""Phrase collocations by marginalising the longest windows.

Words are lower-cased (A-Z) runs between blanks inside pieces, which end at ``.,;:!?`` and line
ends. Each word opens one window of the four words from it on, padded where the piece
ends. Only these windows are counted; Spark's ROLLUP over their columns sums them to the counts
of all shorter phrases, of single words and of a language's words.

A phrase of at least ``LEAST`` occurrences has no rarer run of words in it. So windows are
padded from the first word on that is rarer, or completes a rarer run, and no wanted
count changes. Which those are is told by bit tables over hashes:
the words' from the exact vocabulary, the others' from sums over hash slots that are
never below a run's own count. A table has at most ``MOST_BITS`` bits; where that is too
few, fewer windows are padded and no result changes.

Words travel as 64-bit hashes of language and word. The vocabulary is checked for words that
share one, and hashed anew if there are; equal words of one stretch of text meet as text.

A null language counts as ``und``, a null text as empty. Repeated rows count each. Texts of
any length are read in whole pieces. Rows without words, and empty tables, give no phrases.
Columns other than text and language are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeloom.llm.common import mixed, sized, stored

LEAST, TOP = 30, 2000
WIDTH = 4
SCALE = 2_000_000
# A candidate goes if a longer one around it has at least this share of its occurrences.
COVERED = 0.8
UNKNOWN = "und"
MOST_BITS, LEAST_BITS = 1 << 28, 1 << 16
# Text counted at once, and groups that are ranked apart before they meet.
_STRETCH, _SALTS = 8 << 20, 64

_WORD, _GAP, _BREAK = 0, 1, 2
_KIND = np.full(256, _WORD, np.uint8)
_KIND[[0x20, 0x09]] = _GAP
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = _BREAK
_ENDS = _KIND == _BREAK
_WINDOW = [f"w{i + 1}" for i in range(WIDTH)]


class Stretch:
    """The words of some text: distinct ones, and the number of each word in order.

    Words stay text until equal ones have met, so no hash decides on equality here.
    """

    def __init__(self, data: bytes) -> None:
        raw = np.frombuffer(data.lower(), np.uint8)  # bytes.lower() touches A-Z only
        kind = _KIND[raw]
        inside = kind == _WORD
        edges = np.flatnonzero(np.diff(np.r_[False, inside, False].view(np.int8)))
        starts, ends = edges[::2], edges[1::2]
        self.piece = np.cumsum(kind == _BREAK, dtype=np.int32)[starts]
        offsets = np.r_[0, np.cumsum(ends - starts)].astype(np.int64)
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(raw[inside])]
        listed = pa.Array.from_buffers(pa.large_binary(), len(starts), buffers).dictionary_encode()
        self.words = listed.dictionary.to_pylist()
        self.numbers = listed.indices.to_numpy()

    def hashes(self, lang: str, seed: int) -> np.ndarray:
        """Hashes of the distinct words, never 0."""
        own = xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"), seed)
        found = np.fromiter((xxhash.xxh64_intdigest(w, own) for w in self.words), np.uint64, len(self.words))
        return np.where(found == 0, np.uint64(1), found)


class Bits:
    """A table of bits over hashes."""

    def __init__(self, size: int, packed: np.ndarray) -> None:
        self.size, self.packed = size, packed

    def of(self, hashes: np.ndarray) -> np.ndarray:
        slots = (hashes & np.uint64(self.size - 1)).astype(np.int64)
        return (self.packed[slots >> 3] >> (slots & 7).astype(np.uint8) & 1).astype(bool)


def pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mixed(first * np.uint64(3) + mixed(second))


def bits_for(count: int) -> int:
    """Size of a table for so many entries: a power of two within the bounds."""
    return min(max(1 << max(count - 1, 0).bit_length(), LEAST_BITS), MOST_BITS)


def bit_table(slots: DataFrame, size: int) -> Bits:
    """Bits of the slots named by a table's only column, at most ``MOST_BITS`` / 8 bytes."""
    at = F.col(slots.columns[0]) + 1
    parts = slots.select(F.bitmap_bucket_number(at).alias("part"), F.bitmap_bit_position(at).alias("bit"))
    packed = np.zeros(max(size // 8, 4096), np.uint8)
    for part, bits in parts.groupBy("part").agg(F.bitmap_construct_agg("bit")).toLocalIterator():
        packed[(part - 1) * 4096 : part * 4096] = np.frombuffer(bits, np.uint8)
    return Bits(size, packed)


def stretches(batches: Iterator[pa.RecordBatch], size: int = _STRETCH) -> Iterator[tuple[str, bytes]]:
    """(language, text) stretches of about ``size`` bytes, cut behind whole pieces."""
    for batch in batches:
        texts, langs = batch.column(0).cast(pa.large_binary()), batch.column(1).dictionary_encode()
        numbers = langs.indices.to_numpy()
        for number, lang in enumerate(langs.dictionary.to_pylist()):
            held, total = [], 0
            for row in np.flatnonzero(numbers == number):
                text = texts[int(row)].as_py()
                while len(text) > 2 * size:
                    cut = _piece_end(text, size)
                    if cut == len(text):
                        break
                    yield lang, text[:cut]
                    text = text[cut:]
                held.append(text)
                total += len(text)
                if total >= size:
                    yield lang, b"\n".join(held)
                    held, total = [], 0
            if held:
                yield lang, b"\n".join(held)


def _piece_end(text: bytes, start: int) -> int:
    """Place behind the first piece end at or after ``start``; the text's end without one."""
    for at in range(start, len(text), 1 << 16):
        found = np.flatnonzero(_ENDS[np.frombuffer(text[at : at + (1 << 16)], np.uint8)])
        if len(found):
            return at + int(found[0]) + 1
    return len(text)


def _counted(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, data in stretches(batches):
            s = Stretch(data)
            n = np.bincount(s.numbers, minlength=len(s.words)).astype(np.int64)
            texts = pa.array(s.words, pa.binary()).cast(pa.string())
            made = [pa.array([lang] * len(n), pa.string()), texts, pa.array(s.hashes(lang, seed).view(np.int64)), pa.array(n)]
            yield pa.RecordBatch.from_arrays(made, ["lang", "word", "h", "n"])

    return run


def frequent_runs(s: Stretch, hashes: np.ndarray, tables: Sequence[Bits]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For runs of 1, 2, ... words: where all shorter ones in them are frequent, and their hashes.

    ``tables`` tell it for words, pairs and so on; the runs of one word more come last.
    """
    known = np.flatnonzero(tables[0].of(hashes)[s.numbers])
    found = [(known, hashes[s.numbers[known]])]
    for length, table in enumerate([*tables[1:], None], start=2):
        at, own = found[-1]
        if length == 2:
            ok = np.r_[(np.diff(at) == 1) & (np.diff(s.piece[at]) == 0), False] if len(at) else np.empty(0, bool)
        else:
            # Both runs of one word less are frequent.
            ok = np.r_[np.diff(at) == 1, False] if len(at) else np.empty(0, bool)
        first = np.flatnonzero(ok)
        runs = pair_hashes(own[first], hashes[s.numbers[at[first] + length - 1]])
        at = at[first]
        if table is not None:
            kept = table.of(runs)
            at, runs = at[kept], runs[kept]
        found.append((at, runs))
    return found


def _runs(seed: int, tables: Sequence[Bits], size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, data in stretches(batches):
            s = Stretch(data)
            runs = frequent_runs(s, s.hashes(lang, seed), tables)[-1][1] & np.uint64(size - 1)
            slots, n = np.unique(runs, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(slots.astype(np.int32)), pa.array(n.astype(np.int64))], ["slot", "n"])

    return run


def lead_windows(s: Stretch, hashes: np.ndarray, tables: Sequence[Bits]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct padded windows of a stretch, (windows, WIDTH) hashes, and their counts.

    A word that is itself rarer gives a window of padding only.
    """
    runs = frequent_runs(s, hashes, tables)
    # Local numbers, 0 for padding.
    numbers = s.numbers.astype(np.int64) + 1
    columns = []
    for lead, (at, _) in enumerate(runs[:WIDTH]):
        column = np.zeros(len(numbers), np.int64)
        column[at] = numbers[at + lead]
        columns.append(column)
    hashed = np.r_[np.uint64(0), hashes]
    alone = np.bincount(columns[0][columns[1] == 0], minlength=len(hashed))
    first = np.flatnonzero(alone)
    single = np.zeros((len(first), WIDTH), np.int64)
    single[:, 0] = first

    columns = [column[columns[1] > 0] for column in columns]
    # Equal windows meet one column after another.
    group = columns[0]
    for column in columns[1:]:
        group = np.unique(group * len(hashed) + column, return_inverse=True)[1]
    _, at, n = np.unique(group, return_index=True, return_counts=True)
    longer = np.stack([column[at] for column in columns], axis=1)
    return hashed[np.concatenate([single, longer])], np.concatenate([alone[first], n])


def _windows(seed: int, tables: Sequence[Bits]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, data in stretches(batches):
            s = Stretch(data)
            found, n = lead_windows(s, s.hashes(lang, seed), tables)
            made = [pa.array([lang] * len(n), pa.string()), *[pa.array(np.ascontiguousarray(c).view(np.int64)) for c in found.T], pa.array(n.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(made, ["lang", *_WINDOW, "n"])

    return run


def vocabulary(rows: DataFrame) -> tuple[int, DataFrame]:
    """Seed and (lang, word, h, n) of all words, no two of which share a hash."""
    for seed in range(8):
        counted = rows.mapInArrow(_counted(seed), "lang string, word string, h long, n long")
        words = stored(counted.groupBy("h", "lang", "word").agg(F.sum("n").alias("n")), "phrases-words")
        if words.groupBy("h").count().where("count > 1").isEmpty():
            return seed, words
    raise RuntimeError("words share hashes under every seed")


def phrase_counts(rows: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """Counts of phrases of one to four words, and the words that occur in them.

    ``rows`` has text and language, without nulls. The counts are (lang, level, w1 to w4, a):
    level 0 is a language with all its words, level k phrases of k words, padded with 0; those of
    fewer than ``least`` occurrences are left out.
    """
    seed, words = vocabulary(rows)
    frequent = words.where(F.col("n") >= least)
    found, positions = frequent.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    size = bits_for(32 * found)
    tables = [bit_table(frequent.select(F.col("h").bitwiseAND(F.lit(size - 1))), size)]
    for length in range(2, WIDTH + 1):
        size = bits_for(positions // 2)
        slots = rows.mapInArrow(_runs(seed, tables, size), "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n"))
        met = stored(slots.where(F.col("n") >= least), f"phrases-runs-{length}")
        positions = met.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        tables.append(bit_table(met.select(F.col("slot").cast("long")), size))

    windows = rows.mapInArrow(_windows(seed, tables), f"lang string, {', '.join(f'{w} long' for w in _WINDOW)}, n long")
    summed = windows.rollup("lang", *_WINDOW).agg(F.sum("n").alias("a"), F.grouping_id().alias("rolled"))
    # The bits of what was rolled up, from the right.
    level = F.coalesce(*[F.when(F.col("rolled") == (1 << WIDTH - k) - 1, k) for k in range(WIDTH, -1, -1)])
    padded = [F.coalesce(w, F.lit(0).cast("long")).alias(w) for w in _WINDOW]
    counts = summed.select("lang", level.alias("level"), *padded, "a").where(F.col("level").isNotNull())
    last = F.element_at(F.array(F.lit(1).cast("long"), *_WINDOW), F.col("level") + 1)
    counts = counts.where((last != 0) & ((F.col("level") == 0) | (F.col("a") >= least)))
    return stored(counts, "phrases-counts"), frequent


def _part(first: int, length: int) -> list[Column]:
    """The key of ``length`` words from the ``first`` on, padded to three."""
    return [F.col(_WINDOW[first + i]) if i < length else F.lit(0).cast("long") for i in range(WIDTH - 1)]


def _parts(make: Callable[[int], list[Column]], first: int) -> Column:
    """Structs that a phrase of each level from ``first`` on gives, as one array."""
    return F.coalesce(*[F.when(F.col("level") == level, F.array(*make(level))) for level in range(first, WIDTH + 1)])


def scored_phrases(counts: DataFrame) -> DataFrame:
    """Candidates with a, l, r and score of their lowest-scoring cut, covered ones left out."""
    phrases = counts.where(F.col("level") >= 2)
    keys = ["k1", "k2", "k3"]
    lookup = counts.where(F.col("level").between(1, WIDTH - 1))

    def side(name: str) -> DataFrame:
        renamed = lookup.select(*[F.col(w).alias(f"{name}{i + 1}") for i, w in enumerate(_WINDOW[:-1])], F.col("a").alias(name))
        return sized(renamed)

    def cut(level: int, at: int) -> Column:
        left, right = _part(0, at), _part(at, level - at)
        named = [c.alias(f"{side}{i + 1}") for side, part in (("l", left), ("r", right)) for i, c in enumerate(part)]
        return F.struct(F.lit(at).alias("at"), *named)

    cuts = phrases.select("lang", "level", *_WINDOW, "a", F.explode(_parts(lambda level: [cut(level, at) for at in range(1, level)], 2)).alias("c"))
    cuts = cuts.select("lang", "level", *_WINDOW, "a", "c.*")
    both = cuts.join(side("l"), [f"l{i}" for i in (1, 2, 3)]).join(side("r"), [f"r{i}" for i in (1, 2, 3)])
    # Decimals hold the product exactly.
    product = F.col("a").cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(7,0)")
    both = both.withColumn("product", product).withColumn("parts", F.col("l").cast("decimal(20,0)") + F.col("r").cast("decimal(20,0)"))
    best = both.groupBy("lang", "level", *_WINDOW, "a").agg(F.min(F.struct(F.expr("product div parts").alias("score"), "at", "l", "r")).alias("best"))

    def inner(level: int) -> list[Column]:
        spans = [(first, length) for length in range(2, level) for first in range(level - length + 1)]
        return [F.struct(*[c.alias(k) for k, c in zip(keys, _part(first, length))]) for first, length in spans]

    longer = phrases.where(F.col("level") >= 3).select("a", F.explode(_parts(inner, 3)).alias("k"))
    around = longer.groupBy("k.k1", "k.k2", "k.k3").agg(F.max("a").alias("around"))
    shorter = [F.col(w) == F.col(k) for w, k in zip(_WINDOW, keys)]
    placed = best.join(around, [*shorter, F.col("w4") == 0], "left")
    # 100 * around >= 80 * a, without leaving 64 bits.
    covered = F.coalesce(F.col("around"), F.lit(0)) * F.lit(5) >= F.col("a") * F.lit(round(5 * COVERED))
    return placed.where(~covered).select("lang", *_WINDOW, "a", "best.l", "best.r", "best.score")


def _top(df: DataFrame, top: int, *groups: str) -> DataFrame:
    """Rows that ``top`` rows of their group do not beat; ties stay."""
    window = Window.partitionBy(*groups).orderBy(F.col("score").desc(), F.col("a").desc())
    return df.withColumn("__rank", F.rank().over(window)).where(F.col("__rank") <= top).drop("__rank")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's best phrases."""
    text, lang = F.coalesce(F.col(text_col), F.lit("")), F.coalesce(F.col(lang_col), F.lit(UNKNOWN))
    rows = docs.select(text.alias("text"), lang.alias("lang"))
    counts, frequent = phrase_counts(rows, least)
    # A language's best stand among the best of each of its salted parts.
    salted = scored_phrases(counts).withColumn("salt", F.pmod(F.xxhash64(*_WINDOW), F.lit(_SALTS)))
    best = stored(_top(_top(salted, top, "lang", "salt"), top, "lang").drop("salt"), "phrases-best")

    spelled = best.select(*_WINDOW, F.posexplode(F.array(*_WINDOW)).alias("at", "h")).where(F.col("h") != 0)
    spelled = sized(spelled).join(frequent.select("h", "word"), "h")
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"])
    phrases = spelled.groupBy(*_WINDOW).agg(F.array_join(in_order, " ").alias("phrase"))
    totals = counts.where(F.col("level") == 0).select("lang", F.col("a").alias("n"))
    named = best.join(phrases, _WINDOW).join(totals, "lang")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = named.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
