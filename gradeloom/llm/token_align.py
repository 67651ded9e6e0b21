"""Alignment of two tokenizers' tokens over whole texts.

Documents are first shuffled by their full text: each distinct text is tokenised and aligned
once and weighs as many documents as hold it. A text is read with a space before it, by a
byte-level tokenizer (A) and a sentencepiece model (B), which adds that space itself. Where
tokens of both end, groups of tokens end; within a group every A token is linked with every B
token. An id pair counts the documents that hold it linked. Each document gets the sizes of
its alignment, the sum of its links' counts and how many of them are the best of their A id.

Texts are cut before spaces between other characters, where no token of either kind may
reach across: the byte-level rule starts a token with such a space, and no piece of the model
has a space behind another character, which is checked. Equal cuts of a block are tokenised once.
A group of very many tokens is linked by distinct ids, so its links are counted without
listing them.

A block of about ``BLOCK`` bytes of text keeps its cuts, and asks a table of all pairs for its
own pairs' counts: that table grows with the corpus and is joined, never held by one task.
Measures meet their documents by the SHA-256 of the text.

A text that is null or empty, or whose tokens do not spell it again, has no tokens: zeros and an
empty digest. Rows without id, or that repeat one, count and are returned like all others.
Empty tables give no rows. Texts of any length are aligned whole.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gradeloom.llm.common import stored

BLOCK = 4 << 20
# Groups with more links are linked by distinct ids.
_MANY = 4096
# Cut texts tokenised at once.
_BATCH = 10_000
# Pairs of texts brought together at once.
_PART = 1 << 20

# What a cut's space may not stand before: blanks, and first bytes of characters among which blanks are.
_PLAIN = np.ones(256, bool)
_PLAIN[:0x21] = False
_PLAIN[[0x7F, 0xC2, 0xE1, 0xE2, 0xE3]] = False
# Nor behind: another space, or the last byte of the sign that the model takes for one.
_BEFORE = np.ones(256, bool)
_BEFORE[[0x20, 0x81]] = False


def _byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Both tokenizers, with the bytes of each of their tokens."""

    def __init__(self, file_a: str, file_b: str) -> None:
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(file_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=file_b)
        letters = _byte_letters()
        entries = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(entries.values()) + 1)
        for entry, number in entries.items():
            self.bytes_a[number] = bytes(letters[c] for c in entry) if all(c in letters for c in entry) else entry.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        if any("▁" in piece.lstrip("▁") for piece in pieces):
            raise ValueError(f"{file_b}: a piece reaches across a space, so texts cannot be cut there")
        self.bytes_b = [
            bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode() for i, piece in enumerate(pieces)
        ]
        self.text_a, self.text_b = (list(map(str, range(len(x)))) for x in (self.bytes_a, self.bytes_b))
        self.size_a, self.size_b = (np.array([len(x) for x in each], np.int64) for each in (self.bytes_a, self.bytes_b))

    def tokens(self, cuts: list[bytes]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of A and B of cuts, each of which starts with a space."""
        texts = [cut.decode("utf-8", "replace") for cut in cuts]
        found_a = [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        return found_a, self.b.encode([t[1:] for t in texts], num_threads=1)

    def spelled(self, cuts: list[bytes], *ids: list[list[int]]) -> np.ndarray:
        """Whether the tokens of both sides spell each cut again."""
        sides = [([names[i] for i in itertools.chain.from_iterable(found)], [len(x) for x in found]) for names, found in zip((self.bytes_a, self.bytes_b), ids)]
        good = np.ones(len(cuts), bool)
        for tokens, sizes in sides:
            # All at once first: mostly everything fits.
            ends = np.r_[0, np.cumsum([len(x) for x in tokens])][np.cumsum(sizes)]
            if not np.array_equal(ends, np.cumsum([len(x) for x in cuts])) or b"".join(tokens) != b"".join(cuts):
                last = np.cumsum(sizes).tolist()
                good &= np.array([b"".join(tokens[i:j]) == cut for i, j, cut in zip([0, *last[:-1]], last, cuts)], bool)
        return good


@functools.lru_cache(1)
def vocabulary(file_a: str, file_b: str) -> Vocabulary:
    return Vocabulary(file_a, file_b)


def cut_places(raw: np.ndarray) -> np.ndarray:
    """Places before which texts may be cut."""
    if len(raw) < 3:
        return np.empty(0, np.int64)
    return np.flatnonzero((raw[1:-1] == 0x20) & _BEFORE[raw[:-2]] & _PLAIN[raw[2:]]) + 1


class Aligned:
    """Distinct cuts with their tokens, groups and links.

    ``pairs`` are distinct id pairs, the A id in the upper half. ``pair_at`` and ``links`` list
    the pairs of each cut and how many links of the cut each has, ``pair_n`` how many pairs.
    """

    def __init__(self, cuts: list[bytes], words: Vocabulary) -> None:
        n = len(cuts)
        good, flat, sizes = [], ([], []), ([], [])
        for at in range(0, n, _BATCH):
            some = cuts[at : at + _BATCH]
            ids = words.tokens(some)
            good.append(words.spelled(some, *ids))
            for side, found in enumerate(ids):
                kept = found if good[-1].all() else [x if ok else [] for x, ok in zip(found, good[-1])]
                sizes[side].append(np.array([len(x) for x in kept], np.int64))
                flat[side].append(np.fromiter(itertools.chain.from_iterable(kept), np.int64, int(sizes[side][-1].sum())))
        self.good = np.concatenate(good)
        self.n_a, self.n_b = map(np.concatenate, sizes)
        a, b = map(np.concatenate, flat)
        ends_a, ends_b = np.cumsum(words.size_a[a]), np.cumsum(words.size_b[b])
        ends = np.intersect1d(ends_a, ends_b, assume_unique=True)
        to_a, to_b = np.searchsorted(ends_a, ends) + 1, np.searchsorted(ends_b, ends) + 1
        from_a, from_b = np.r_[0, to_a[:-1]][: len(ends)], np.r_[0, to_b[:-1]][: len(ends)]
        # Cuts are ends of both sides, so each group lies in one.
        owner = np.repeat(np.arange(n), self.n_a)[from_a] if len(ends) else from_a
        self.n_groups = np.bincount(owner, minlength=n)
        per_group = (to_a - from_a) * (to_b - from_b)
        self.n_links = np.bincount(owner, per_group, minlength=n).astype(np.int64)
        text_a, text_b = ([names[i] for i in ids] for names, ids in ((words.text_a, a), (words.text_b, b)))
        spans = zip(*(x.tolist() for x in (from_a, to_a, from_b, to_b)))
        groups = [f"{','.join(text_a[i:j])}|{','.join(text_b[k:m])}" for i, j, k, m in spans]
        last = np.cumsum(self.n_groups).tolist()
        self.texts = [";".join(groups[i:j]) for i, j in zip([0, *last[:-1]], last)]
        del text_a, text_b, groups

        few = per_group <= _MANY
        at = np.repeat(np.flatnonzero(few), per_group[few])
        step = np.arange(len(at)) - np.repeat(np.cumsum(per_group[few]) - per_group[few], per_group[few])
        width = (to_b - from_b)[at]
        keys = [a[from_a[at] + step // width] << 32 | b[from_b[at] + step % width]] if len(at) else []
        owners, counts = [owner[at]], [np.ones(len(at), np.int64)]
        for g in np.flatnonzero(~few):
            each_a, m_a = np.unique(a[from_a[g] : to_a[g]], return_counts=True)
            each_b, m_b = np.unique(b[from_b[g] : to_b[g]], return_counts=True)
            keys.append((each_a[:, None] << 32 | each_b[None, :]).ravel())
            counts.append(np.outer(m_a, m_b).ravel())
            owners.append(np.full(len(keys[-1]), owner[g]))
        self.pairs, local = np.unique(np.concatenate(keys) if keys else np.empty(0, np.int64), return_inverse=True)
        rows, each = np.unique(np.concatenate(owners) * max(len(self.pairs), 1) + local, return_inverse=True)
        self.links = np.bincount(each, np.concatenate(counts), minlength=len(rows)).astype(np.int64)
        self.pair_at = rows % max(len(self.pairs), 1)
        self.pair_n = np.bincount(rows // max(len(self.pairs), 1), minlength=n)


def expanded(rows: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows of a list of lists of ``counts`` items: which row, and which item of all."""
    starts = np.cumsum(counts) - counts
    n = counts[rows]
    which = np.repeat(np.arange(len(rows)), n)
    return which, np.repeat(starts[rows] - (np.cumsum(n) - n), n) + np.arange(len(which))


def _text_ends(held: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Where to split rows of texts, ``held`` each, so that whole texts of about ``_PART`` items stay."""
    ends = np.cumsum(held)
    items = np.r_[0, np.cumsum(sizes)][ends]
    return ends[:-1][np.diff(items // _PART) > 0]


_MEASURES = ("n_a", "n_b", "n_groups", "n_links")
_LONGS = pa.list_(pa.int64())
_BLOCK = pa.schema(
    [("block", pa.int64()), ("digests", pa.list_(pa.binary())), *[(m, _LONGS) for m in _MEASURES], ("groups", pa.list_(pa.string()))]
    + [("cuts", pa.binary()), ("cut_links", pa.binary()), ("pairs", _LONGS), ("pair_docs", _LONGS)]
)
_BLOCK_DDL = (
    "block long, digests array<binary>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
    "groups array<string>, cuts binary, cut_links binary, pairs array<long>, pair_docs array<long>"
)
_OWN = ("digests", *_MEASURES, "groups", "cuts", "cut_links")


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays of small numbers as one compressed piece, their lengths in front."""
    head = np.array([len(x) for x in arrays], "<u4").tobytes()
    return zstandard.compress(len(arrays).to_bytes(4, "little") + head + b"".join(x.astype("<u4").tobytes() for x in arrays), 3)


def _unpacked(data: bytes) -> list[np.ndarray]:
    found = np.frombuffer(zstandard.decompress(data), "<u4")
    n = int(found[0])
    return [x.astype(np.int64) for x in np.split(found[n + 1 :], np.cumsum(found[1 : n + 1].astype(np.int64))[:-1])]


def align_block(texts: list[bytes], weights: list[int], words: Vocabulary) -> dict:
    """Measures, cuts and pairs of some distinct texts."""
    joined = b"".join(b" " + t for t in texts)
    raw = np.frombuffer(joined, np.uint8)
    starts = np.cumsum([0, *[len(t) + 1 for t in texts[:-1]]])
    first = np.zeros(len(raw), bool)
    first[starts] = True
    first[cut_places(raw)] = True
    cuts = np.flatnonzero(first)
    buffers = [None, pa.py_buffer(np.r_[cuts, len(raw)].astype(np.int64)), pa.py_buffer(joined)]
    encoded = pa.Array.from_buffers(pa.large_binary(), len(cuts), buffers).dictionary_encode()
    numbers, found = encoded.indices.to_numpy(), Aligned(encoded.dictionary.to_pylist(), words)
    n = len(texts)
    per_text = np.diff(np.r_[np.searchsorted(cuts, starts), len(cuts)])
    owner = np.repeat(np.arange(n), per_text)
    spelled = np.bincount(owner, ~found.good[numbers], minlength=n) == 0

    def summed(of: np.ndarray) -> np.ndarray:
        return np.where(spelled, np.bincount(owner, of[numbers], minlength=n).astype(np.int64), 0)

    k = len(found.good)
    rows, each = np.unique((owner * k + numbers)[spelled[owner]], return_counts=True)
    held = np.bincount(rows // k, minlength=n)
    pair_docs = np.zeros(len(found.pairs), np.int64)
    # Some texts at a time.
    for some in np.split(rows, _text_ends(held, found.pair_n[rows % k])):
        which, item = expanded(some % k, found.pair_n)
        pairs = np.unique((some // k)[which] * max(len(found.pairs), 1) + found.pair_at[item])
        docs = np.array(weights, np.int64)[pairs // max(len(found.pairs), 1)]
        np.add.at(pair_docs, pairs % max(len(found.pairs), 1), docs)
    digests = []
    for ok, end, size in zip(spelled.tolist(), np.cumsum(per_text).tolist(), per_text.tolist()):
        text = ";".join([found.texts[c] for c in numbers[end - size : end]]) if ok else ""
        digests.append(hashlib.sha256(text.encode()).hexdigest() if ok else "")
    return {
        "digests": [[hashlib.sha256(t).digest() for t in texts]],
        **{m: [summed(getattr(found, m))] for m in _MEASURES},
        "groups": [digests],
        "cuts": [_packed(held, rows % k, each)],
        "cut_links": [_packed(found.pair_n, found.pair_at, found.links)],
        # Pairs of texts that are not spelled stand here with no documents.
        "pairs": [found.pairs],
        "pair_docs": [pair_docs],
    }


def _aligned(file_a: str, file_b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = itertools.count(TaskContext.get().partitionId() << 24)
        words = vocabulary(file_a, file_b)

        def block(texts: list[bytes], weights: list[int]) -> pa.RecordBatch:
            values = {"block": [next(numbers)], **align_block(texts, weights, words)}
            return pa.RecordBatch.from_arrays([pa.array(values[f.name], f.type) for f in _BLOCK], schema=_BLOCK)

        texts, weights, size = [], [], 0
        for batch in batches:
            for text, weight in zip(batch.column(0).cast(pa.large_binary()), batch.column(1).to_pylist()):
                texts.append(text.as_py())
                weights.append(weight)
                size += len(texts[-1])
                if size >= BLOCK:
                    yield block(texts, weights)
                    texts, weights, size = [], [], 0
        if texts:
            yield block(texts, weights)

    return run


_RESULT = "digest binary, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _measured(own: pa.Table, asked: pa.Table) -> pa.Table:
    """Measures of one block's texts from its own row and the counts of its pairs."""
    row = {name: own.column(name).combine_chunks()[0] for name in own.column_names}
    held, cuts, each = _unpacked(row["cuts"].as_py())
    pair_n, pair_at, links = _unpacked(row["cut_links"].as_py())
    place = asked.column("place").to_numpy()
    owner = np.repeat(np.arange(len(pair_n)), pair_n)
    text = np.repeat(np.arange(len(held)), held)

    def summed(name: str) -> pa.Array:
        values = np.zeros(int(place.max()) + 1 if len(place) else 1, np.int64)
        values[place] = asked.column(name).to_numpy()
        per_cut, out = np.zeros(len(pair_n), np.int64), np.zeros(len(held), np.int64)
        np.add.at(per_cut, owner, values[pair_at] * links)
        np.add.at(out, text, per_cut[cuts] * each)
        return pa.array(out)

    made = [row[name].values for name in ("digests", *_MEASURES)]
    made += [summed("best"), summed("count"), row["groups"].values]
    return pa.Table.from_arrays(made, ["digest", *_MEASURES, "n_best", "count_sum", "groups_sha256"])


def pair_counts(blocks: DataFrame) -> DataFrame:
    """pair, count, best: documents that hold an id pair linked, and whether none of its A id has more."""
    each = blocks.select(F.explode(F.arrays_zip("pairs", "pair_docs")).alias("p"))
    counted = each.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.pair_docs").alias("count"))
    # An A id has at most as many pairs as B has ids.
    first = Window.partitionBy(F.shiftright("pair", 32))
    return counted.withColumn("best", (F.col("count") == F.max("count").over(first)).cast("int"))


def align(docs: DataFrame, file_a: str, file_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    texts = rows.where(F.col("text") != "").groupBy("text").agg(F.count(F.lit(1)).alias("weight"))
    blocks = stored(texts.mapInArrow(_aligned(file_a, file_b), _BLOCK_DDL), "align-blocks")
    counts = stored(pair_counts(blocks), "align-pairs")

    asked = blocks.select("block", F.posexplode("pairs").alias("place", "pair")).join(counts, "pair")
    # A block asks for its own pairs only, so one group is bounded by its text.
    own = blocks.select(F.col("block").alias("own_block"), *_OWN).groupBy("own_block")
    measures = own.cogroup(asked.select("block", "place", "count", "best").groupBy("block")).applyInArrow(_measured, _RESULT)

    digest = F.when(F.col("text") != "", F.unhex(F.sha2(F.col("text").cast("binary"), 256))).alias("digest")
    found = rows.select("doc_id", digest).join(measures, "digest", "left")
    numbers = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in (*_MEASURES, "n_best", "count_sum")]
    return found.select("doc_id", *numbers, F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
