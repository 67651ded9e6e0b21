"""Language identification by hyperdimensional profiles.

Every letter has a random vector of 1024 signs. Three letters in a row are bound into one
vector: the first permuted twice, times the second permuted once, times the third. A
text is the sum of its three-letter vectors, a language the sum over its training texts,
and a text is given the language of the highest cosine.

Letters are lower-cased; what lies between letters counts as one blank. The alphabet has
128 slots: a to z, the blank, and 101 slots that all other letters share by code point,
so that neighbours of a script stay apart. A null text, or one without letters, is
``und`` with score 0. The score is the cosine, at least 0. Equal cosines go to the
language first by code point. Rows without language are not learned from; without any
training row every text is ``und``.
Texts of any length are counted in full.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from gradeloom.llm.common import slices

UNKNOWN = "und"
DIMENSIONS = 1024
SLOTS = 128
_SHARED = SLOTS - 27
_DOCS, _CHARS, _CODES = 256, 1_000_000, 4096


@functools.cache
def _slots() -> np.ndarray:
    """Slot of each code point: 0 for all but letters."""
    letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    slots = np.where(letter, 27 + np.arange(0x110000) % _SHARED, 0).astype(np.uint32)
    slots[ord("a") : ord("z") + 1] = np.arange(1, 27)
    return slots


@functools.cache
def _letters(dimensions: int) -> np.ndarray:
    return np.random.default_rng(7).choice(np.array([-1, 1], np.int8), (SLOTS, dimensions))


def ngram_vectors(codes: np.ndarray, dimensions: int = DIMENSIONS) -> np.ndarray:
    """Bound vectors of three-letter codes."""
    letters = _letters(dimensions)
    first, second = np.roll(letters, 2, axis=1), np.roll(letters, 1, axis=1)
    return first[codes >> 14] * second[codes >> 7 & 127] * letters[codes & 127]


def ngram_codes(text: str) -> np.ndarray:
    """Codes of all three-letter runs of a text; empty without letters."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    slots = _slots()[points]
    # A blank before, after and for each run of other characters.
    slots = np.concatenate([[np.uint32(0)], slots, [np.uint32(0)]])
    keep = slots > 0
    keep[1:] |= keep[:-1]
    keep[0] = True
    slots = slots[keep]
    if len(slots) < 3:
        return slots[:0]
    return slots[:-2] << np.uint32(14) | slots[1:-1] << np.uint32(7) | slots[2:]


def _groups(texts: pa.Array) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, codes) of groups of rows of bounded size."""
    first, found, size = 0, [], 0
    for i, text in enumerate(texts):
        found.append(ngram_codes(text.as_py() or ""))
        size += len(found[-1])
        if len(found) >= _DOCS or size >= _CHARS:
            yield first, found
            first, found, size = i + 1, [], 0
    if found:
        yield first, found


def text_vectors(found: list[np.ndarray], dimensions: int = DIMENSIONS) -> np.ndarray:
    """Summed vectors of texts given as codes: counts times bound vectors."""
    joined = np.concatenate(found)
    used = np.zeros(SLOTS**3, bool)
    used[joined] = True
    codes = np.flatnonzero(used)
    place = np.zeros(SLOTS**3, np.int32)
    place[codes] = np.arange(len(codes), dtype=np.int32)
    rows = np.repeat(np.arange(len(found)), [len(f) for f in found])
    counts = np.bincount(rows * max(len(codes), 1) + place[joined], minlength=len(found) * len(codes))
    counts = counts.reshape(len(found), len(codes))
    total = np.zeros((len(found), dimensions), np.float32)
    for at in range(0, len(codes), _CODES):
        part = slice(at, at + _CODES)
        total += counts[:, part].astype(np.float32) @ ngram_vectors(codes[part], dimensions).astype(np.float32)
    return total


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's sums: one vector per language seen."""
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch.column(1).to_pylist()
        for first, found in _groups(batch.column(0)):
            by_lang: dict[str, list[np.ndarray]] = {}
            for i, codes in enumerate(found):
                by_lang.setdefault(langs[first + i], []).append(codes)
            for lang, parts in by_lang.items():
                new = np.bincount(np.concatenate(parts), minlength=SLOTS**3).astype(np.int32)
                counts[lang] = counts[lang] + new if lang in counts else new
    names, sums = [], []
    for lang, each in counts.items():
        codes = np.flatnonzero(each)
        total = np.zeros(DIMENSIONS, np.int64)
        for at in range(0, len(codes), 4096):
            part = codes[at : at + 4096]
            total += each[part].astype(np.int64) @ ngram_vectors(part).astype(np.int64)
        names.append(lang)
        sums.append(total)
    yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(sums, pa.list_(pa.int64()))], ["lang", "sums"])


def learn_languages(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """Language names and unit vectors, from all given rows with a language."""
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    parts = rows.select(F.col(text_col).alias("t"), F.col(lang_col).alias("l")).mapInArrow(_learn, "lang string, sums array<long>")
    summed = parts.select("lang", F.posexplode("sums")).groupBy("lang", "pos").agg(F.sum("col").alias("s"))
    # One row per language, of DIMENSIONS numbers.
    profiles = summed.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("pos", "s"))).alias("v"))
    known = sorted((r["lang"], [x["s"] for x in r["v"]]) for r in profiles.collect())
    known = [(lang, v) for lang, v in known if any(v)]
    if not known:
        return [], np.zeros((0, DIMENSIONS), np.float32)
    vectors = np.array([v for _, v in known], np.float64)
    return [lang for lang, _ in known], (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float32)


def _predict(names: list[str], profiles: np.ndarray, field: str | None = None):
    """Predictions from the last column, or from a field of the first, the kept row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            langs, scores = [], []
            row = batch.column(0)
            for _, found in _groups(batch.column(1) if field is None else row.field(field)):
                vectors = text_vectors(found)
                norms = np.linalg.norm(vectors, axis=1)
                cosines = (vectors @ profiles.T) / np.maximum(norms, 1e-9)[:, None] if names else np.zeros((len(found), 1))
                best = cosines.argmax(1)
                for i, codes in enumerate(found):
                    known = len(codes) > 0 and bool(names)
                    langs.append(names[best[i]] if known else UNKNOWN)
                    scores.append(float(min(max(cosines[i, best[i]], 0.0), 1.0)) if known else 0.0)
            yield pa.RecordBatch.from_arrays(
                [row, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["row", "lang_pred", "score"]
            )

    return run


def identify(
    docs: DataFrame, train: Column, text_col: str = "text", lang_col: str = "lang", keep: Sequence[str] | None = None
) -> DataFrame:
    """row (a struct of the kept columns, all by default), lang_pred and score of every row.

    Learns from the rows where ``train`` holds; predicts from the text alone.
    """
    names, profiles = learn_languages(docs.where(train), text_col, lang_col)
    kept = docs.columns if keep is None else keep
    row = F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row")
    # A text that is kept travels once.
    field = text_col if list(kept).count(text_col) == 1 else None
    rows = docs.select(row) if field else docs.select(row, F.col(text_col).alias("t"))
    schema = StructType([rows.schema["row"], StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return rows.mapInArrow(_predict(names, profiles, field), schema)
