import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from gradeloom.llm.pfor_blocks import BLOCK, BlockReader, PieceTokens, decode_blocks, encode_blocks, pack, read_documents, unpack, write_ids

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    None,
    "",
    " ",
    "plain words here",
    " leading and trailing ",
    "two  spaces\n\nand lines\n end",
    "tab\tand odd spaces\x1c\x85 x",
    "don't they're <|endoftext|> it's",
    "naïve café 東京 \U0001f600 12345 a\nb \n c",
    "(x) [y] {z}!!! a.b,c;d\r\nnext",
    "word " * 5000,
    "\n",
    "a",
    "a.b,c .d, e..f é. ü,x 3.14 a.'s \u00a0x \u2003 y\u3000z \u0085 q",
    "x\0y \0 z\n\0",
    "Zeile\nnächste\n\nübernächste \n Ende.\n",
    " .x , y",
]


@pytest.mark.parametrize("width", range(0, 33))
def test_pack_round_trip(width):
    values = np.random.default_rng(width).integers(0, 1 << width, (3, BLOCK), dtype=np.uint64).astype(np.uint32)
    assert (unpack(pack(values, width), width) == values).all()


@pytest.mark.parametrize("n", [1, 511, 512, 513, 5000])
def test_blocks_with_outliers_round_trip(n):
    pick = np.random.default_rng(n)
    ids = pick.integers(1000, 1100, n).astype(np.uint32)
    ids[pick.random(n) < 0.05] = 4_000_000_000
    blocks = encode_blocks(ids)
    starts = np.cumsum([0] + [len(b) for b in blocks[:-1]])
    assert (decode_blocks(b"".join(blocks), starts)[:n] == ids).all()
    assert sum(map(len, blocks)) < 4 * len(blocks) * BLOCK / 2


def test_word_tokens_equal_the_tokenizer():
    tokenizer = Tokenizer.from_file(PATH)
    texts = [t or "" for t in TEXTS]
    words = PieceTokens(PATH)
    for _ in range(2):  # the second time from memory
        for text, ids in zip(texts, words([t.encode() for t in texts])):
            assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_files_round_trip(spark):
    rows = [(i * 3 % 41, TEXTS[i % len(TEXTS)], "clash", 0.0) for i in range(41)] + [(None, "no id", "", 0.0), (5, TEXTS[3], "", 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string, part double").repartition(3)
    manifest = write_ids(docs, PATH)
    found = [tuple(r) for r in read_documents(manifest).collect()]
    tokenizer, at, want = Tokenizer.from_file(PATH), 0, []
    for doc_id, text, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1] or "")):
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        want.append((doc_id, len(ids), zlib.crc32(ids.tobytes())))
    assert sorted([f[0:1] + f[2:] for f in found], key=str) == sorted(want, key=str)
    for doc_id, start, n, _ in sorted(found, key=lambda f: f[1]):
        assert start == at
        at += n
    order = [f[0] for f in sorted(found, key=lambda f: f[1])]
    assert order[0] is None and order[1:] == sorted(order[1:])
    assert manifest.agg({"n_ids": "sum"}).first()[0] == at


def test_blocks_by_index_and_damage(spark, tmp_path):
    docs = spark.createDataFrame([(1, "some text " * 2000)], "doc_id long, text string")
    row = write_ids(docs, PATH, folder=f"file://{tmp_path}").first()
    import pyarrow.fs

    system, path = pyarrow.fs.FileSystem.from_uri(row["path"])
    reader = BlockReader(system.open_input_file(path))
    whole = next(reader.documents())[1]
    assert (reader.blocks(3, 5) == whole[3 * BLOCK : 5 * BLOCK]).all()
    data = bytearray(open(path, "rb").read())
    data[-60] ^= 1
    open(path, "wb").write(data)
    with pytest.raises(ValueError):
        BlockReader(system.open_input_file(path))


def test_empty_table(spark):
    manifest = write_ids(spark.createDataFrame([], "doc_id long, text string"), PATH)
    assert read_documents(manifest).collect() == []
