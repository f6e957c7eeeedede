import hashlib
import random

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece

from propensity.llm import common, pieces, queries
from pyspark.sql import functions as F
from tests.llm.fixtures import frame, sentence, texts

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "", " ", "  ", "\n", "\n\n ", " a", "a ", "a  b\n\nc  ", "\n x", "▁a ▁▁", "▁", "a▁", "<s> </s> <unk> <0x0A>", "é é ﬁ", "\t\tx\r\n y",
    "x" * 300, "漢字\U0001f600 ok", "　x y z", "a\x00b \x01", "﻿a", "é", "\r\n\r\n", "){\r\n\t}", "\U0010ffff ",
]


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def odd_texts(n):
    draw = random.Random(5)
    letters = ["a", "b", " ", " ", "\n", "▁", "é", "漢", "\U0001f600", "\t", "\r", ";", ")", "<", "0", "x", " ", "\x00"]
    return ["".join(draw.choice(letters) for _ in range(draw.randint(0, 40))) for _ in range(n)]


def test_equals_the_library(model):
    every = [*ODD, *odd_texts(3000), sentence(9, 2000), " ".join(ODD)]
    table = pieces.PieceTable(PATH)
    got = [x.tolist() for x in table.encode(every)]
    assert got == model.encode(every, add_bos=True, add_eos=True)
    assert table.encode([]) == []


def test_query_against_the_library(spark, model, tmp_path):
    rows = texts() + [(100 + i, t) for i, t in enumerate(ODD)]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in queries.op11_pieces(spark, str(tmp_path)).collect()]
    want = []
    for key, text in rows:
        ids = model.encode(text or "", add_bos=True, add_eos=True)
        told = hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
        want.append((key, len(ids), told, hashlib.sha256(model.decode(ids).encode()).hexdigest()))
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_blocks_do_not_change_the_result(spark, model, monkeypatch):
    whole = pieces.decode(pieces.encode(frame(spark), PATH), PATH).collect()
    monkeypatch.setattr(pieces, "BLOCK_BYTES", 100)
    small = pieces.decode(pieces.encode(frame(spark), PATH), PATH).collect()
    assert sorted(map(repr, whole)) == sorted(map(repr, small))
    assert all(r.text == (model.decode(r.ids)) for r in whole)


def test_long_texts_empty_table_and_other_columns(spark, model):
    long = [(1, "ab cd\n" * 400_000), (2, "é" * 300_000), (3, " " * 300_000)]
    got = {r.doc_id: r.ids for r in pieces.encode(frame(spark, long), PATH).collect()}
    assert all(got[k] == model.encode(t, add_bos=True, add_eos=True) for k, t in long)
    assert pieces.digests(frame(spark, []), PATH).collect() == [] == pieces.decode(pieces.encode(frame(spark, []), PATH), PATH).collect()
    clash = frame(spark, [(1, "a b")]).select("doc_id", "text", F.lit(0).alias("ids"), F.lit(0).alias("n_tokens"))
    assert pieces.encode(clash, PATH).first().ids == model.encode("a b", add_bos=True, add_eos=True)


def test_vocabulary_that_crosses_white_space_is_refused(monkeypatch):
    class Odd(sentencepiece.SentencePieceProcessor):
        def id_to_piece(self, i):
            return "a▁b" if i == 1000 else super().id_to_piece(i)

    monkeypatch.setattr(sentencepiece, "SentencePieceProcessor", Odd)
    with pytest.raises(ValueError, match="white space"):
        pieces.PieceTable(PATH)


@pytest.mark.parametrize("limit", [1, 7, 20, 1000])
def test_byte_blocks_keep_rows_and_bounds(limit):
    draw = random.Random(1)
    rows = [(i, None if i % 11 == 0 else "é" * draw.randint(0, 9)) for i in range(200)]
    batches = [pa.RecordBatch.from_pylist([{"i": i, "t": t} for i, t in rows[a : a + 30]], pa.schema([("i", pa.int64()), ("t", pa.string())])) for a in range(0, 200, 30)]
    batches = [b.slice(3) for b in batches]
    blocks = list(common.byte_blocks(iter(batches), limit, 1))
    assert pa.Table.from_batches(blocks).to_pylist() == pa.Table.from_batches(batches).to_pylist()
    sizes = [[len((t or "").encode()) for t in b.column(1).to_pylist()] for b in blocks]
    assert all(sum(s) <= limit or len(s) == 1 for s in sizes)
    assert list(common.byte_blocks(iter([]), limit, 1)) == []
    assert np.array_equal(common.gathered(np.arange(9), np.array([0, 4]), np.array([2, 3]), np.array([1, 0, 1])), [4, 5, 6, 0, 1, 4, 5, 6])
