"""Language identification by compression: the language whose dictionary makes a text smallest.

Each language has a raw-content zstandard dictionary of letters from a bounded sample of its training texts. A text
(lower case, everything but letters a space) is cut into chunks, so that the dictionary counts all through it; each chunk
is encoded with each dictionary, and the sizes are added. The smallest wins; if the next is nearly as small, the
text is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from propensity.llm import common

#: Texts that make a language's dictionary, and the most characters each gives: the bound of the training sample.
SAMPLE_TEXTS = 64
SAMPLE_CHARS = 2048
CHUNK_BYTES = 4096
LEVEL = 6
#: The second-best size must exceed the best by this share of itself.
MARGIN = 0.01
UNKNOWN = "und"

_NO_LETTERS = regex.compile(r"[^\p{L}\p{M}]+")
_LETTER = regex.compile(r"\p{L}")


def letters(text: str | None) -> bytes:
    """Lower-case words of letters and the marks on them, one space apart; empty if there is no letter."""
    plain = _NO_LETTERS.sub(" ", (text or "").lower()).strip()
    return plain.encode() if _LETTER.search(plain) else b""


def fit(docs: DataFrame, text: str = "text", label: str = "lang", key: str = "doc_id") -> dict[str, bytes]:
    """A dictionary for each non-null label of ``docs`` that has a letter in its sampled texts.

    The sample is the SAMPLE_TEXTS rows of smallest key hash of each label; a filter on the hash keeps
    about four times as many before they are ranked, so that a label's size does not matter. The number of
    labels is taken to be that of languages.
    """
    rows = docs.select(
        F.col(label).cast("string").alias("lang"), F.xxhash64(key, text).alias("h"), F.substring(text, 1, SAMPLE_CHARS).alias("text")
    ).where("lang is not null and text is not null")
    sizes = rows.groupBy("lang").agg(F.count("*").alias("rows"))
    share = F.least(F.lit(1.0), F.lit(4.0 * SAMPLE_TEXTS) / F.col("rows"))
    near = rows.join(F.broadcast(sizes), "lang").where(F.pmod("h", F.lit(1 << 30)) <= share * (1 << 30))  # a row a language
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))
    found: dict[str, list[bytes]] = {}
    for row in near.withColumn("place", place).where(F.col("place") <= SAMPLE_TEXTS).orderBy("lang", "place").collect():
        found.setdefault(row.lang, []).append(letters(row.text))
    joined = {lang: b" ".join(x for x in texts if x) for lang, texts in found.items()}
    return {lang: content for lang, content in joined.items() if len(content) >= 8}


class Sizes:
    """Compressed sizes of a text under each dictionary."""

    def __init__(self, dictionaries: dict[str, bytes]):
        self.langs = sorted(dictionaries)
        self.compressors = []
        for lang in self.langs:
            content = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(level=LEVEL)
            self.compressors.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=content, write_content_size=False))

    def predict(self, text: str | None) -> tuple[str, float]:
        """Label and score: the share by which the second-best size exceeds the best, 1 if there is one label only."""
        plain = letters(text)
        if not plain or not self.langs:
            return UNKNOWN, 0.0
        sizes = [0] * len(self.langs)
        for start in range(0, len(plain), CHUNK_BYTES):
            chunk = plain[start : start + CHUNK_BYTES]
            for i, c in enumerate(self.compressors):
                sizes[i] += len(c.compress(chunk))
        order = sorted(range(len(sizes)), key=lambda i: (sizes[i], i))
        if len(order) == 1:
            return self.langs[0], 1.0
        return self.langs[order[0]], 1 - sizes[order[0]] / sizes[order[1]]


def _sizes(shared, cache: dict) -> Sizes:
    if not cache:
        cache["sizes"] = Sizes(shared.value)
    return cache["sizes"]


def predict(docs: DataFrame, dictionaries: dict[str, bytes], key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, accepted) of every row, from its text alone.

    ``lang_pred`` is ``und`` with score 0 for a null text, one without a letter, or no dictionaries; ties go to the first
    label in order. ``accepted`` is false for ``und`` and for scores below MARGIN. Other columns are ignored.
    """
    shared, cache = docs.sparkSession.sparkContext.broadcast(dictionaries), {}

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            told = [_sizes(shared, cache).predict(t) for t in batch.column(1).to_pylist()]
            langs, scores = [t[0] for t in told], [t[1] for t in told]
            keep = [lang != UNKNOWN and score >= MARGIN for lang, score in told]
            columns = [batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(keep, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score", "accepted"])

    docs = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    key_type = docs.schema["doc_id"].dataType.simpleString()
    return common.in_batches(docs, run, f"doc_id {key_type}, lang_pred string, score double, accepted boolean")


def accepted(docs: DataFrame, dictionaries: dict[str, bytes], text: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``predict`` accepts, all columns as they are, without a join."""
    shared, cache = docs.sparkSession.sparkContext.broadcast(dictionaries), {}
    place = docs.columns.index(text)

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            told = [_sizes(shared, cache).predict(t) for t in batch.column(place).to_pylist()]
            yield batch.filter(pa.array([lang != UNKNOWN and score >= MARGIN for lang, score in told], pa.bool_()))

    return common.in_batches(docs, run, docs.schema)
