"""Encoding and decoding with a public sentencepiece vocabulary by a table of distinct chunks.

No piece of the vocabulary goes on over the mark of a space, so a text falls apart into chunks (space marks and the word after
them) that are segmented alone. The chunks of a block of texts are numbered by their place in the table of the block's
distinct chunks; each distinct chunk is segmented once, and the ids are joined back by position, as whole arrays.

A block is bounded in bytes and made inside a task: the table never travels. One table for the whole corpus would have to meet the
texts again by two shuffles of every block's chunks (README: more than the texts themselves), to save what is
segmented twice by different blocks.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from propensity.llm import common

MARK = "▁"
#: Bytes of text whose chunks share one table; a longer text is a block of its own.
BLOCK_BYTES = 1 << 20
#: Texts that show whether a vocabulary changes characters or white space before it segments.
_PROBES = ("", " ", "  a  b ", "a\nb \n\n c\n", "ﬁ　x y", "\ta\t\tb\r\n", "<s></s><unk><0x0A>", f"a{MARK}b{MARK}", "\U0001f600 漢字", "x\x00y")


class PieceTable:
    """Segments chunks under the sentencepiece model at ``path``. Raises if its texts can't be cut at white space."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [model.id_to_piece(i) for i in range(len(model)) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        if any(MARK in piece.lstrip(MARK) for piece in pieces):
            raise ValueError("a piece of this vocabulary goes on over white space: its texts can't be cut there")
        self.mark, self.begin, self.end = model.piece_to_id(MARK), model.bos_id(), model.eos_id()
        line = any("\n" in piece and len(piece) > 1 for piece in pieces)  # a line break may only start a chunk if no piece goes over it
        self.cut = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+" if line else f"{MARK}*[^{MARK}\n]+|{MARK}+|\n[^{MARK}\n]*").findall
        for probe in _PROBES:
            if self.encode([probe])[0].tolist() != [self.begin, *model.encode(probe), self.end]:
                raise ValueError("this vocabulary changes texts before it cuts them: chunks can't be segmented alone")

    def chunks(self, text: str) -> list[str]:
        return self.cut(MARK + text.replace(" ", MARK)) if text else []

    def segment(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all chunks, one after another, and how many each has. The library puts a mark before what it is given."""
        bare = [c[1:].replace(MARK, " ") if c[0] == MARK else c for c in chunks]
        found = self.model.encode(bare, num_threads=1) if bare else []
        for i, chunk in enumerate(chunks):
            if chunk[0] != MARK:
                del found[i][0]
            elif len(chunk) == 1:
                found[i] = [self.mark]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter((x for ids in found for x in ids), np.int32, int(sizes.sum())), sizes

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text with begin and end."""
        if not texts:
            return []
        cut = [self.chunks(t) for t in texts]
        every = pa.array([c for chunks in cut for c in chunks], pa.large_string()).dictionary_encode()
        ids, sizes = self.segment(every.dictionary.to_pylist())
        # begin and end are two more entries of the table
        table, sizes = np.concatenate([ids, np.array([self.begin, self.end], np.int32)]), np.concatenate([sizes, [1, 1]])
        ends = np.cumsum([len(chunks) for chunks in cut])
        codes = every.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        places = np.stack([np.concatenate([[0], ends[:-1]]), ends], 1).ravel()
        codes = np.insert(codes, places, np.tile([len(sizes) - 2, len(sizes) - 1], len(cut)))
        flat = common.gathered(table, np.cumsum(sizes) - sizes, sizes, codes)
        stops = np.cumsum(sizes[codes])[ends + 2 * np.arange(1, len(cut) + 1) - 1]
        return np.split(flat, stops[:-1])


_TABLES: dict[str, PieceTable] = {}


def _table(path: str) -> PieceTable:
    """One model a worker process and vocabulary."""
    if path not in _TABLES:
        _TABLES[path] = PieceTable(path)
    return _TABLES[path]


def _encoded(batches: Iterator, table: PieceTable) -> Iterator[tuple[pa.Array, list[np.ndarray]]]:
    for block in common.byte_blocks(batches, BLOCK_BYTES, 1):
        yield block.column(0), table.encode([t or "" for t in block.column(1).to_pylist()])


def _texts(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, str]:
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows, rows.schema["doc_id"].dataType.simpleString()


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids) of every row: what the library gives for the whole text, with begin and end ids.

    A null text is empty and has these two only. Repeated rows repeat; a null key stays null. Other columns are ignored. A text
    without white space is one chunk, however long.
    """

    def run(batches: Iterator) -> Iterator:
        for keys, ids in _encoded(batches, _table(path)):
            yield pa.RecordBatch.from_arrays([keys, pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    rows, kind = _texts(docs, key, text)
    return common.in_batches(rows, run, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Add ``text``, the library's text of the ``ids``; null ids give null."""

    def run(batches: Iterator) -> Iterator:
        model = _table(path).model
        for batch in batches:
            for part in common.byte_blocks([batch], BLOCK_BYTES, 1):
                ids = part.column(1).to_pylist()
                texts = iter(model.decode([x for x in ids if x is not None], num_threads=1))
                told = pa.array([None if x is None else next(texts) for x in ids], pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), told], ["doc_id", "ids", "text"])

    rows = encoded.select("doc_id", "ids")
    return common.in_batches(rows, run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>, text string")


def digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row: hashes of the ids of ``encode`` as little-endian 32-bit
    numbers, and of the text decoded from them. Neither ids nor texts leave the task that made them.
    """

    def run(batches: Iterator) -> Iterator:
        table = _table(path)
        for keys, ids in _encoded(batches, table):
            told = [hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids]
            texts = [hashlib.sha256(table.model.decode(x.tolist()).encode()).hexdigest() for x in ids]
            columns = [keys, pa.array([len(x) for x in ids], pa.int64()), pa.array(told, pa.string()), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows, kind = _texts(docs, key, text)
    return common.in_batches(rows, run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
