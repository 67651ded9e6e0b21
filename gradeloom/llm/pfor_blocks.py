"""Token ids as binary files of patched frame-of-reference blocks.

Documents are spread by id ranges, tokenised and written in id order, one file a task.

A file holds blocks of 512 ids. Each block stores its minimum, the width that at least 90 of
100 of its differences fit in, the differences' low bits at that width, and an exception
list of positions and high bits for the rest. Sixteen ids lie side by side in 32-bit
words, so packing and reading are a few whole-array shifts per row of sixteen.

    "PFOR" version block_size                      header, 32-bit little-endian
    minimum width n_exceptions words positions highs   each block
    block starts                                   64-bit, from the file's first byte
    ids, id flags, lengths of the documents        64-bit, 8-bit, 64-bit
    blocks documents ids index_at crc32 "PFOR"     trailer

A manifest table, written by Spark and so free of failed attempts, names the files that
count with their numbers of documents and ids. A null text counts as empty; each document
ends with id 0. Documents without id come first; rows that repeat an id follow each other
in input order.
"""

from __future__ import annotations

import functools
import os
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gradeloom.llm.common import span_hashes, stored
from gradeloom.runtime import scratch_path

BLOCK, LANES = 512, 16
FIT_PERCENT = 90
END_ID = 0
# Pieces whose ids a worker remembers of late, and as many from before that.
CACHE_PIECES = 300_000
_CHUNK_BLOCKS = 2048
_CHUNK_BYTES = 1_000_000
_HEADER, _TRAILER = struct.Struct("<4sII"), struct.Struct("<QQQQI4s")
_BLOCK_HEAD = struct.Struct("<IHH")
_MANIFEST = "part long, path string, n_docs long, n_ids long"
_RESULT = "doc_id long, start long, n_tokens long, ids_crc32 long"

# How the vocabulary spells a blank.
_BLANK, _JOINED = "\u0120", 2000


# ---------------------------------------------------------------- blocks


def pack(values: np.ndarray, width: int) -> np.ndarray:
    """Blocks of differences, (n, 512), to words (n, width, 16)."""
    rows = values.reshape(-1, BLOCK // LANES, LANES)
    words = np.zeros((len(rows), width, LANES), np.uint32)
    for r in range(BLOCK // LANES if width else 0):
        word, shift = divmod(r * width, 32)
        words[:, word] |= rows[:, r] << np.uint32(shift)
        if shift + width > 32:
            words[:, word + 1] |= rows[:, r] >> np.uint32(32 - shift)
    return words


def unpack(words: np.ndarray, width: int) -> np.ndarray:
    """The inverse of ``pack``."""
    rows = np.zeros((len(words), BLOCK // LANES, LANES), np.uint32)
    mask = np.uint32((1 << width) - 1 if width < 32 else 0xFFFFFFFF)
    for r in range(BLOCK // LANES if width else 0):
        word, shift = divmod(r * width, 32)
        value = words[:, word] >> np.uint32(shift)
        if shift + width > 32:
            value = value | words[:, word + 1] << np.uint32(32 - shift)
        rows[:, r] = value & mask
    return rows.reshape(-1, BLOCK)


def encode_blocks(ids: np.ndarray) -> list[bytes]:
    """Encoded blocks of ids; the last one is filled up with its first id."""
    short = -len(ids) % BLOCK
    if short:
        ids = np.concatenate([ids, np.full(short, ids[-(len(ids) % BLOCK)], np.uint32)])
    blocks = ids.reshape(-1, BLOCK)
    least = blocks.min(1)
    above = blocks - least[:, None]
    at = -(-BLOCK * FIT_PERCENT // 100) - 1
    fitting = np.partition(above, at, axis=1)[:, at]
    widths = np.ceil(np.log2(fitting.astype(np.float64) + 1)).astype(np.int64)
    out: list[bytes] = [b""] * len(blocks)
    for width in np.unique(widths):
        chosen = np.flatnonzero(widths == width)
        values = above[chosen]
        high = values >> np.uint32(width) if width < 32 else np.zeros_like(values)
        low = values & np.uint32((1 << int(width)) - 1) if width < 32 else values
        words = pack(low, int(width))
        for i, b in enumerate(chosen):
            where = np.flatnonzero(high[i])
            head = _BLOCK_HEAD.pack(int(least[b]), int(width), len(where))
            out[b] = head + words[i].tobytes() + where.astype("<u2").tobytes() + high[i][where].astype("<u4").tobytes()
    return out


def decode_blocks(data: bytes | memoryview, starts: np.ndarray, base: int = 0) -> np.ndarray:
    """Ids of the blocks that begin at ``starts``, of which ``data`` begins at ``base``."""
    heads = [_BLOCK_HEAD.unpack_from(data, int(s) - base) for s in starts]
    least = np.array([h[0] for h in heads], np.uint32)
    widths = np.array([h[1] for h in heads])
    out = np.empty((len(starts), BLOCK), np.uint32)
    for width in np.unique(widths):
        chosen = np.flatnonzero(widths == width)
        n = int(width) * LANES
        words = [np.frombuffer(data, "<u4", n, int(starts[b]) - base + _BLOCK_HEAD.size) for b in chosen]
        out[chosen] = unpack(np.stack(words).reshape(len(chosen), int(width), LANES), int(width))
    for b, (_, width, n) in enumerate(heads):
        if n:
            at = int(starts[b]) - base + _BLOCK_HEAD.size + width * LANES * 4
            where = np.frombuffer(data, "<u2", n, at)
            out[b, where] |= np.frombuffer(data, "<u4", n, at + 2 * n) << np.uint32(width)
    return (out + least[:, None]).reshape(-1)


# ---------------------------------------------------------------- files


class BlockWriter:
    """Writes documents' ids to one file, holding a few blocks at a time."""

    def __init__(self, stream) -> None:
        self.stream = stream
        self.at = stream.write(_HEADER.pack(b"PFOR", 1, BLOCK))
        self.starts: list[int] = []
        self.doc_ids: list[int | None] = []
        self.lengths: list[int] = []
        self.waiting: list[bytes] = []
        self.waiting_bytes = 0
        self.n_ids = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        """``ids`` are 32-bit little-endian, with the end id."""
        self.doc_ids.append(doc_id)
        self.lengths.append(len(ids) // 4)
        self.waiting.append(ids)
        self.waiting_bytes += len(ids)
        self.n_ids += len(ids) // 4
        if self.waiting_bytes >= 4 * BLOCK * _CHUNK_BLOCKS:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.frombuffer(b"".join(self.waiting), "<u4")
        whole = len(ids) if last else len(ids) // BLOCK * BLOCK
        for at in range(0, whole, BLOCK * _CHUNK_BLOCKS):
            blocks = encode_blocks(ids[at : min(at + BLOCK * _CHUNK_BLOCKS, whole)])
            for block in blocks:
                self.starts.append(self.at)
                self.at += len(block)
            self.stream.write(b"".join(blocks))
        self.waiting = [ids[whole:].tobytes()]
        self.waiting_bytes = 4 * (len(ids) - whole)

    def close(self) -> None:
        if self.waiting_bytes:
            self._flush(True)
        known = np.array([d is not None for d in self.doc_ids], np.uint8)
        numbers = np.array([d or 0 for d in self.doc_ids], "<i8")
        index = np.array(self.starts + [self.at], "<u8").tobytes() + numbers.tobytes() + known.tobytes() + np.array(self.lengths, "<u8").tobytes()
        self.stream.write(index)
        self.stream.write(_TRAILER.pack(len(self.starts), len(self.doc_ids), self.n_ids, self.at, zlib.crc32(index), b"PFOR"))


class BlockReader:
    """Reads one file: its documents in turn, or any block by the index."""

    def __init__(self, source) -> None:
        self.source = source
        size = source.size()
        source.seek(size - _TRAILER.size)
        blocks, docs, self.n_ids, index_at, crc, magic = _TRAILER.unpack(source.read(_TRAILER.size))
        source.seek(index_at)
        index = source.read(size - _TRAILER.size - index_at)
        if magic != b"PFOR" or zlib.crc32(index) != crc:
            raise ValueError("the file is not whole")
        self.starts = np.frombuffer(index, "<u8", blocks + 1)
        at = 8 * (blocks + 1)
        numbers, known = np.frombuffer(index, "<i8", docs, at), np.frombuffer(index, np.uint8, docs, at + 8 * docs)
        self.lengths = np.frombuffer(index, "<u8", docs, at + 9 * docs)
        self.doc_ids = [int(n) if k else None for n, k in zip(numbers, known)]

    def blocks(self, first: int, last: int) -> np.ndarray:
        """Ids of blocks ``first`` to ``last``, end exclusive."""
        begin, end = int(self.starts[first]), int(self.starts[last])
        self.source.seek(begin)
        return decode_blocks(self.source.read(end - begin), self.starts[first:last], begin)

    def documents(self) -> Iterator[tuple[int | None, np.ndarray]]:
        """Each document's id and ids in file order."""
        at, have, left = 0, np.empty(0, np.uint32), self.n_ids
        blocks = len(self.starts) - 1
        for doc_id, length in zip(self.doc_ids, self.lengths):
            parts, need = [], int(length)
            while need:
                if not len(have):
                    upto = min(at + _CHUNK_BLOCKS, blocks)
                    have = self.blocks(at, upto)[:left]
                    left, at = left - len(have), upto
                taken, have = have[:need], have[need:]
                parts.append(taken)
                need -= len(taken)
            yield doc_id, parts[0] if len(parts) == 1 else np.concatenate(parts or [have[:0]])


# ---------------------------------------------------------------- tokens


def cut_places(raw: np.ndarray) -> np.ndarray:
    """Where encoded text may be cut without changing its ids, as flags before each byte.

    Before a single blank, before and after a single line break, both between other
    characters, and before a full stop or comma after a letter or digit: there the
    vocabulary's own rules always begin a new piece. Next to characters that might be
    white space nothing is cut.
    """
    ascii_sign = (raw > 0x20) & (raw < 0x7F)
    two_byte = (raw >= 0xC3) & (raw <= 0xCF)  # begins a letter, never white space
    solid_after = ascii_sign | two_byte
    solid_before = ascii_sign.copy()
    solid_before[1:] |= two_byte[:-1]
    before = np.zeros(len(raw), bool)
    before[1:] = solid_before[:-1]
    after = np.zeros(len(raw), bool)
    after[:-1] = solid_after[1:]
    single = before & after
    line = (raw == 0x0A) & single
    cuts = line | ((raw == 0x20) & single)
    cuts[1:] |= line[:-1]
    small = raw | 0x20
    plain = ((raw >= 0x30) & (raw <= 0x39)) | ((small >= 0x61) & (small <= 0x7A))
    sign = (raw == 0x2E) | (raw == 0x2C)
    cuts[1:] |= sign[1:] & plain[:-1]
    return cuts


class PieceTokens:
    """Ids of whole texts, tokenising each different piece once.

    Equal pieces of a group of texts are found by hash; the ids of earlier pieces are
    remembered. New pieces are tokenised many at a time: a token that begins with a blank
    begins a piece, a line break stands between pieces without one.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.begins = np.zeros(max(vocabulary.values()) + 1, bool)
        self.begins[[i for token, i in vocabulary.items() if token.startswith(_BLANK)]] = True
        self.line = self._encode(["\n"])[0]
        self.pieces: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _encode_joined(self, pieces: list[bytes], between: bytes) -> list[bytes]:
        """Ids of pieces that all begin with a blank, or of ones set apart by ``between``."""
        out: list[bytes] = []
        for at in range(0, len(pieces), _JOINED):
            chosen = pieces[at : at + _JOINED]
            raw = self._encode([between.join(chosen).decode()])[0]
            ids = np.frombuffer(raw, "<u4")
            if between:
                ends = 4 * np.flatnonzero(ids == int.from_bytes(self.line, "little"))
                starts = [0, *(ends + 4).tolist()]
                ends = [*ends.tolist(), len(raw)]
            else:
                starts = (4 * np.flatnonzero(self.begins[ids])).tolist()
                ends = [*starts[1:], len(raw)]
            if len(starts) == len(chosen):
                out += [raw[s:e] for s, e in zip(starts, ends)]
            else:
                out += self._encode([p.decode() for p in chosen])
        return out

    def _learn(self, missing: list[bytes]) -> None:
        """Pieces with other white space than a first blank go to the tokenizer alone."""
        spaced = [p for p in missing if p[0] == 0x20 and _plain(p[1:])]
        rest = [p for p in missing if p[0] != 0x20 and _plain(p)]
        alone = set(missing).difference(spaced, rest)
        self.pieces.update(zip(spaced, self._encode_joined(spaced, b"")))
        self.pieces.update(zip(rest, self._encode_joined(rest, b"\n")))
        self.pieces.update(zip(alone, self._encode([p.decode() for p in alone])))

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        if len(self.pieces) > CACHE_PIECES:
            self.older, self.pieces = self.pieces, {}
        sizes = np.array([len(t) for t in texts])
        if not sizes.any():
            return [b""] * len(texts)
        # A zero byte between texts: nothing is cut next to it.
        data = b"\0".join(texts) + b"\0"
        raw = np.frombuffer(data, np.uint8)
        ends = np.cumsum(sizes + 1) - 1
        begins = cut_places(raw)
        begins[ends - sizes] = True
        begins[ends] = True
        starts = np.flatnonzero(begins)
        stops = np.append(starts[1:], len(raw))
        is_piece = np.ones(len(starts), bool)
        is_piece[np.searchsorted(starts, ends)] = False
        starts, stops = starts[is_piece], stops[is_piece]
        _, first, number = np.unique(span_hashes(raw, starts, stops), return_index=True, return_inverse=True)
        names = [data[s:e] for s, e in zip(starts[first].tolist(), stops[first].tolist())]
        known = list(map(self.pieces.get, names))
        if None in known:
            missing = []
            for name in [name for name, ids in zip(names, known) if ids is None]:
                ids = self.older.get(name)
                if ids is None:
                    missing.append(name)
                else:
                    self.pieces[name] = ids
            self._learn(missing)
            known = list(map(self.pieces.__getitem__, names))
        ids = np.frombuffer(b"".join(known), "<u4")
        lengths = np.fromiter(map(len, known), np.int64, len(known)) // 4
        offsets = np.cumsum(lengths) - lengths
        each = lengths[number]
        upto = np.cumsum(each)
        joined = ids[np.repeat(offsets[number] - upto + each, each) + np.arange(upto[-1])].tobytes()
        bounds = np.append(0, 4 * upto)[np.searchsorted(starts, np.append(0, ends + 1))].tolist()
        return [joined[s:e] for s, e in zip(bounds, bounds[1:])]


def _plain(piece: bytes) -> bool:
    """True for a piece without white space, which can stand among others."""
    text = piece.decode()
    return text.split() == [text]


@functools.cache
def _tokens(path: str) -> PieceTokens:
    return PieceTokens(path)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[bytes]]]:
    """Rows in groups of bounded text."""
    for batch in batches:
        ids, texts, size = [], [], 0
        column = batch.column(1)
        column = column.cast(pa.large_binary() if column.type == pa.large_string() else pa.binary())
        for doc_id, text in zip(batch.column(0), column):
            ids.append(doc_id.as_py())
            texts.append(text.as_py() or b"")
            size += len(texts[-1])
            if size >= _CHUNK_BYTES:
                yield ids, texts
                ids, texts, size = [], [], 0
        if ids:
            yield ids, texts


def _write_files(folder: str, tokenizer: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        system, root = pa.fs.FileSystem.from_uri(folder)
        name = f"part-{task:06d}-{uuid.uuid4().hex}.pfor"
        tokens, end = _tokens(tokenizer), struct.pack("<I", end_id)
        writer, stream = None, None
        for ids, texts in _chunks(batches):
            if writer is None:
                system.create_dir(root, recursive=True)
                stream = system.open_output_stream(f"{root}/{name}", compression=None)
                writer = BlockWriter(stream)
            for doc_id, found in zip(ids, tokens(texts)):
                writer.add(doc_id, found + end)
        if writer is not None:
            writer.close()
            stream.close()
            row = {"part": [task], "path": [f"{folder}/{name}"], "n_docs": [len(writer.doc_ids)], "n_ids": [writer.n_ids]}
            yield pa.RecordBatch.from_pydict(row, pa.schema([("part", pa.int64()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]))

    return run


def write_ids(
    docs: DataFrame, tokenizer: str, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID
) -> DataFrame:
    """Write all documents' ids in id order; return the manifest (part, path, n_docs, n_ids).

    ``folder`` is a URI that all executors reach; a new one below the shared folder if
    not given. ``tokenizer`` is a tokenizer file that all executors reach.
    """
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "pfor")
    folder = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.monotonically_increasing_id().alias("at")
    )
    order = ["doc_id", "at"]
    spread = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    return stored(spread.mapInArrow(_write_files(folder, tokenizer, end_id), _MANIFEST), "pfor-manifest")


def _read_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "n_tokens", "ids_crc32")])
    for batch in batches:
        for row in batch.to_pylist():
            system, path = pa.fs.FileSystem.from_uri(row["path"])
            start, out = row["start"], []
            with system.open_input_file(path) as source:
                for doc_id, ids in BlockReader(source).documents():
                    out.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4", copy=False).tobytes())))
                    start += len(ids)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out) if out else [[]] * 4)], schema=schema)


def read_documents(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    # One file a task; the window has one row per file.
    return placed.repartition(max(1, manifest.count())).mapInArrow(_read_files, _RESULT)
