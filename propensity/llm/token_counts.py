"""Exact token counts of every prefix of a text, for a public byte-fallback BPE vocabulary.

No piece of the vocabulary goes on over a space or holds a line break, so a text falls apart into segments (white
space and the word after it) that are encoded alone. The count of a prefix that ends with a segment is the
count before the segment plus the segment's own (``TokenCounter.prefixes``). Inside a segment the count of each prefix is the
count up to its last token plus one; the last token is the only piece that ends there and does not merge with the
last token before it (``TokenCounter.inside``). So a budget or cut is looked up and no prefix is encoded again.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from propensity.llm import common

SPACE = "▁"
_SEGMENT = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n[^{SPACE}\n]*")
#: Segments whose counts a task remembers; then it starts anew. Longer segments are not remembered.
REMEMBERED = 400_000
REMEMBERED_CHARS = 64


class TokenCounter:
    """Counts of prefixes under the sentencepiece model at ``path``, without begin, end or special tokens."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = [i for i in range(len(self.model)) if not (self.model.is_byte(i) or self.model.is_control(i) or self.model.is_unknown(i))]
        self.scores = {self.model.id_to_piece(i): self.model.get_score(i) for i in plain}
        if any(SPACE in p.lstrip(SPACE) or "\n" in p for p in self.scores):
            raise ValueError("a piece of this vocabulary goes on over white space: its texts can't be cut there")
        self.longest = max(map(len, self.scores))
        self.known: dict[str, int] = {}
        self.apart: dict[tuple[str, str], bool] = {}

    def segments(self, text: str) -> list[str]:
        return _SEGMENT.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def _counted(self, segments: list[str]) -> list[int]:
        """The library's counts of segments, each encoded as a text of its own."""
        texts, less = [], []
        for s in segments:
            if s[0] == "\n":
                texts.append(s)
                less.append(1)  # the space put before every text
            else:
                texts.append(s[1:].replace(SPACE, " "))
                less.append(0 if s != SPACE else -1)  # a lone space is one token; the library gives none for no text
        return [len(ids) - n for ids, n in zip(self.model.encode(texts, num_threads=1), less)]

    def remember(self, segments: set[str]) -> None:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = [s for s in segments if s not in self.known and len(s) <= REMEMBERED_CHARS]
        self.known.update(zip(new, self._counted(new)))

    def prefixes(self, segments: list[str]) -> np.ndarray:
        """Tokens up to the end of each segment."""
        get = self.known.get
        counts = [get(s) for s in segments]
        if None in counts:
            missing = [i for i, c in enumerate(counts) if c is None]
            for i, c in zip(missing, self._counted([segments[i] for i in missing])):
                counts[i] = c
        return np.cumsum(np.array(counts, np.int64))

    def _merged(self, symbols: list[str]) -> list[str]:
        while True:
            best = max(((self.scores.get(a + b, -np.inf), -i) for i, (a, b) in enumerate(zip(symbols, symbols[1:]))), default=(-np.inf, 0))
            if best[0] == -np.inf:
                return symbols
            i = -best[1]
            symbols = [*symbols[:i], symbols[i] + symbols[i + 1], *symbols[i + 2 :]]

    def _stay_apart(self, a: str, b: str) -> bool:
        if (a, b) not in self.apart:
            if len(self.apart) > REMEMBERED:
                self.apart.clear()
            self.apart[a, b] = self._merged(list(a + b)) == [x for x in (a, b) if x]
        return self.apart[a, b]

    def inside(self, segment: str) -> list[int]:
        """Tokens of each prefix of one segment, by its last token."""
        last, counts = [""], [0]
        for end in range(1, len(segment) + 1):
            for size in range(min(self.longest, end), 0, -1):
                piece, before = segment[end - size : end], end - size
                if (size == 1 or piece in self.scores) and self._stay_apart(last[before], piece):
                    last.append(piece)
                    counts.append(counts[before] + (1 if piece in self.scores else len(piece.encode())))
                    break
        return counts[1:]

    def fit(self, segments: list[str], totals: np.ndarray, limit: int) -> int:
        """The longest prefix of a text, in code points, of at most ``limit`` tokens."""
        full = int(np.searchsorted(totals, limit, side="right"))
        chars = sum(map(len, segments[:full]))
        if full < len(segments):
            before = int(totals[full - 1]) if full else 0
            inside = self.inside(segments[full])
            chars += max((k for k, n in enumerate(inside, 1) if before + n <= limit), default=0)
        return max(0, chars - 1)  # the space put before every text


_COUNTERS: dict[str, TokenCounter] = {}


def counter(path: str) -> TokenCounter:
    """One counter a worker process and vocabulary."""
    if path not in _COUNTERS:
        _COUNTERS[path] = TokenCounter(path)
    return _COUNTERS[path]


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))


def _each(batches: Iterator, path: str) -> Iterator[tuple[pa.RecordBatch, list[str], list[tuple[list[str], np.ndarray]]]]:
    count = counter(path)
    for batch in batches:
        texts = [t or "" for t in batch.column(1).to_pylist()]
        cut = [count.segments(t) for t in texts]
        count.remember(set().union(*cut))
        yield batch, texts, [(s, count.prefixes(s)) for s in cut]


def token_counts(docs: DataFrame, path: str, limit: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit, limit_chars) of every row.

    ``limit_chars`` is the length of the longest prefix (code points) within ``limit`` tokens, the whole text if it is not
    over the limit. A null text is empty: 0 bytes, 0 tokens. Repeated rows repeat. Other columns are ignored.
    """

    def run(batches: Iterator) -> Iterator:
        for batch, texts, counted in _each(batches, path):
            total = [int(c[-1]) if len(c) else 0 for _, c in counted]
            fits = [len(t) if n <= limit else counter(path).fit(s, c, limit) for t, n, (s, c) in zip(texts, total, counted)]
            columns = [batch.column(0), pa.array([len(t.encode()) for t in texts]), pa.array(total, pa.int64())]
            columns += [pa.array([n > limit for n in total]), pa.array(fits, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_tokens", "over_limit", "limit_chars"])

    docs = _rows(docs, key, text)
    key_type = docs.schema["doc_id"].dataType.simpleString()
    return common.in_batches(docs, run, f"doc_id {key_type}, n_bytes long, n_tokens long, over_limit boolean, limit_chars long")


def prefix_table(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ends, counts): the code points and tokens of each prefix that ends with a segment, to be stored.

    ``ends[i]`` and ``counts[i]`` rise; the empty prefix is left out. Null and empty texts have empty arrays.
    """

    def run(batches: Iterator) -> Iterator:
        for batch, _, counted in _each(batches, path):
            ends = [np.cumsum([len(x) for x in s], dtype=np.int64) - 1 if s else np.empty(0, np.int64) for s, _ in counted]
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ends, kind), pa.array([c for _, c in counted], kind)], ["doc_id", "ends", "counts"]
            )

    docs = _rows(docs, key, text)
    key_type = docs.schema["doc_id"].dataType.simpleString()
    return common.in_batches(docs, run, f"doc_id {key_type}, ends array<long>, counts array<long>")
