"""What several operators share: words, stored tables, size checks and word hashes."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextvars import ContextVar
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeloom.runtime import delete_path, scratch_path

WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
SHINGLE_WORDS = 5
SIMILAR = 0.75

# A side of at most so many rows may be broadcast; a row of such a table is below 1 kB.
BROADCAST_ROWS = 20_000

# Paths of the tables stored since ``stored_alone`` began.
_PASSING: ContextVar[list[str] | None] = ContextVar("passing tables", default=None)

_MIX_1, _MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_STEP = 0x100000001B3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Cuts the lineage, survives lost executors and gives the planner true sizes. The
    files go when the session ends. ``options`` are those of the Parquet writer.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.options(**options).parquet(path)
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(jvm_path)
    if (passing := _PASSING.get()) is not None:
        passing.append(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_alone(make: Callable[[], DataFrame], label: str) -> DataFrame:
    """Store what ``make`` gives; the tables that it stored on the way go at once."""
    passing: list[str] = []
    mark = _PASSING.set(passing)
    try:
        made = make()
    finally:
        _PASSING.reset(mark)
    out = stored(made, label)
    for path in passing:
        delete_path(made.sparkSession, path)
    return out


def sized(small: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a stored table for broadcast if it has at most ``rows`` rows.

    Beyond that the caller's join stays an ordinary shuffled join.
    """
    return F.broadcast(small) if small.limit(rows + 1).count() <= rows else small


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """The same rows in small batches, so that what is made of one stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def crc_mod(column: str, parts: int) -> Column:
    """crc32 of a key as text, modulo ``parts``; a null key counts as 0."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    remainder = F.crc32(text.cast("binary")) % parts
    return F.when(F.col(column).isNull(), F.lit(0)).otherwise(remainder).cast("int")


def lower_ascii(text: bytes) -> bytes:
    """A-Z to lower case, all other characters as they are."""
    return text.lower()  # bytes.lower() touches ASCII letters only


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * _MIX_1
    x = (x ^ (x >> np.uint64(27))) * _MIX_2
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of an odd number modulo 2**64 and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, 1 << 20)
            inverse = pow(_STEP, -1, 1 << 64)
            self.up = np.cumprod(np.r_[np.uint64(1), np.full(n - 1, _STEP, np.uint64)], dtype=np.uint64)
            self.down = np.cumprod(np.r_[np.uint64(1), np.full(n - 1, inverse, np.uint64)], dtype=np.uint64)
        return self.up, self.down


_POWERS = Powers()
_IS_GAP = np.zeros(256, bool)
_IS_GAP[[0x20, *range(0x09, 0x0E)]] = True


def word_hashes(data: bytes) -> np.ndarray:
    """64-bit hashes of the words of an encoded text, in order.

    A word's hash is a polynomial in its bytes, read off running sums, then mixed with
    its length.
    """
    if not data:
        return np.empty(0, np.uint64)
    raw = np.frombuffer(data, np.uint8)
    starts, ends = word_spans(raw)
    if not len(starts):
        return np.empty(0, np.uint64)
    return span_hashes(raw, starts, ends)


def word_spans(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a byte array."""
    inside = ~_IS_GAP[raw]
    edges = np.flatnonzero(np.diff(np.r_[False, inside, False].view(np.int8)))
    return edges[::2], edges[1::2]


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of stretches of a byte array."""
    up, down = _POWERS.to(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=sums[1:])
    poly = (sums[ends] - sums[starts]) * down[starts]
    return mixed(poly ^ ((ends - starts).astype(np.uint64) * _GOLDEN))


def _runs(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words, in order."""
    count = len(words) - width + 1
    out = np.full(count, np.uint64(width), np.uint64)
    for i in range(width):
        out = mixed(out * _GOLDEN + words[i : count + i])
    return out


def _distinct(hashes: np.ndarray) -> np.ndarray:
    """Sorted, each value once: ``np.unique`` takes several times as long on short arrays."""
    hashes = np.sort(hashes)
    new = np.ones(len(hashes), bool)
    np.not_equal(hashes[1:], hashes[:-1], out=new[1:])
    return hashes[new]


def shingle_hashes(words: np.ndarray, width: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``width`` words.

    Fewer words make one shingle of all of them; no words make none.
    """
    return _distinct(_runs(words, min(len(words), width))) if len(words) else words


def shingle_sets(texts: Sequence[bytes], width: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """:func:`shingle_hashes` of every text. The words and runs of all texts are hashed at once."""
    words = word_hashes(b" ".join(texts))
    runs = _runs(words, width) if len(words) >= width else words[:0]
    # bytes.split() parts words at the bytes of GAP; the last text has the rest.
    ends = [*accumulate(len(text.split()) for text in texts[:-1]), len(words)]
    sets = []
    for start, end in zip([0, *ends], ends):
        if end - start < width:
            sets.append(shingle_hashes(words[start:end], width))
        else:  # runs that reach into the next text stay out
            sets.append(_distinct(runs[start : end - width + 1]))
    return sets
