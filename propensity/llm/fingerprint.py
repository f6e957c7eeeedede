"""Homomorphic multiset fingerprints of documents.

A text is the multiset of its paragraphs' pieces: lines, cut into sentences, cut into runs of ``PIECE_WORDS`` words.
Each piece is hashed to a wide vector: four 64-bit numbers, added modulo 2^64, by which equality is told, and
``LANES`` signs, added modulo 2^32, from which likeness is estimated. The signs are those of the piece and the number of its
occurrence, so that each occurrence counts once. Sums do not depend on the order of pieces, and a piece is inserted or
deleted by adding or subtracting its vector; the pieces that stay tell the numbers of those that repeat them.

As lanes are sums of random signs, the mean product of two fingerprints' lanes estimates how many pieces they share. With
256 lanes the standard error of ``likeness`` is about 0.06.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T
from pyspark.sql.internal import InternalFunction

from propensity.llm import common
from propensity.session import materialize

PIECE_WORDS = 8
LANES = 256
_CUT = re.compile(r"\n|(?<=[.!?]) ")


def pieces(text: str) -> list[str]:
    """The pieces of a text, in order; none for an empty one."""
    out = []
    for sentence in _CUT.split(text) if text else ():
        words = sentence.split(" ")
        if len(words) <= PIECE_WORDS:
            out.append(sentence)
        else:
            out += [" ".join(words[i : i + PIECE_WORDS]) for i in range(0, len(words), PIECE_WORDS)]
    return out


class Fingerprint:
    """Sums of piece vectors."""

    def __init__(self, exact: np.ndarray | None = None, lanes: np.ndarray | None = None):
        self.exact = np.zeros(4, np.uint64) if exact is None else exact
        self.lanes = np.zeros(LANES, np.uint32) if lanes is None else lanes

    def changed(self, added: Sequence[str], removed: Sequence[str] = (), kept: Sequence[str] = ()) -> Fingerprint:
        """The fingerprint after inserting and deleting pieces; ``kept`` are those that stay, or all that occur in the others."""
        exact, lanes = self.exact.copy(), self.lanes.copy()
        stay = Counter(kept)
        for some, sign in ((added, 1), (removed, -1)):
            numbers_of = Counter(stay)
            # some thousand pieces at a time: a long text takes little memory
            for start in range(0, len(some), 4096):
                each = some[start : start + 4096]
                raw = b"".join([hashlib.blake2b(p.encode()).digest() for p in each])
                hashed = np.frombuffer(raw, np.uint8).reshape(len(each), 64)
                signs = np.array(hashed[:, 32:])
                for i, piece in enumerate(each):
                    number = numbers_of[piece]
                    numbers_of[piece] = number + 1
                    if number:  # without a salt, the first
                        salted = hashlib.blake2b(piece.encode(), salt=number.to_bytes(16, "little")).digest()
                        signs[i] = np.frombuffer(salted, np.uint8, 32, 32)
                numbers = np.ascontiguousarray(hashed[:, :32]).view(np.uint64).sum(axis=0, dtype=np.uint64)
                ones = np.unpackbits(signs, axis=1).sum(axis=0, dtype=np.int64)
                exact = exact + numbers if sign > 0 else exact - numbers
                lanes = (lanes.astype(np.int64) + sign * (2 * ones - len(each))).astype(np.uint32)
        return Fingerprint(exact, lanes)

    def text(self) -> str:
        return self.exact.astype(">u8").tobytes().hex() + self.lanes.astype(">u4").tobytes().hex()


def parsed(text: str) -> Fingerprint:
    raw = bytes.fromhex(text)
    return Fingerprint(np.frombuffer(raw[:32], ">u8").astype(np.uint64), np.frombuffer(raw[32:], ">u4").astype(np.uint32))


def likeness(a: Fingerprint, b: Fingerprint) -> float:
    """Estimated share of pieces in common, 2 |A and B| / (|A| + |B|); 1 for equal fingerprints."""
    if np.array_equal(a.exact, b.exact) and np.array_equal(a.lanes, b.lanes):
        return 1.0
    x, y = a.lanes.view(np.int32).astype(np.float64), b.lanes.view(np.int32).astype(np.float64)
    total = float(x @ x + y @ y)
    return min(1.0, max(0.0, 2 * float(x @ y) / total)) if total else 0.0


def edited(text: str, after: str) -> str:
    """``text`` with its last third (code points, rounded down) replaced by as many from the start of ``after``."""
    n = len(text) // 3
    return text[: len(text) - n] + after[:n]


def row(key, text: str, mark: Fingerprint, cut: list[str], after: str, after_mark: Fingerprint) -> tuple:
    new = edited(text, after)
    parts = pieces(new)
    same = next((i for i, (x, y) in enumerate(zip(cut, parts)) if x != y), min(len(cut), len(parts)))
    other = mark.changed(parts[same:], cut[same:], cut[:same])
    sha = hashlib.sha256(new.encode()).hexdigest()
    return key, len(text), sha, mark.text(), other.text(), likeness(mark, other), likeness(mark, after_mark)


def _rank_number(key: str, kind: T.DataType) -> Column:
    """A long that never falls as the key rises; equal for keys that are close. NULL keys are NULL."""
    column = F.col(key)
    if isinstance(kind, (T.IntegralType, T.BooleanType)):
        return column.cast("long")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(column.cast("timestamp"))
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("long")
    if isinstance(kind, T.NumericType):
        bounded = F.greatest(F.least(column.cast("double"), F.lit(9e18)), F.lit(-9e18))
        return F.when(F.isnan(column.cast("double")), F.lit((1 << 63) - 1)).when(column.isNotNull(), F.floor(bounded))
    first = F.rpad(F.substring(F.hex(column.cast("string")), 1, 14), 14, "0")  # seven bytes
    return F.conv(first, 16, 10).cast("long")


def _ranged(docs: DataFrame, parts: int) -> tuple[DataFrame, int]:
    """``docs`` with ``digest`` and ``part``, a number that rises with (doc_id, digest), and how many there may be.

    The bounds are quantiles of the keys, so that ranges hold about as many rows; a key that takes several
    quantiles is spread over as many ranges by its digest. Bounds are numbers in the plan: ranges are the same whenever they are computed.
    """
    number = _rank_number("doc_id", docs.schema["doc_id"].dataType)
    docs = docs.withColumn("digest", F.xxhash64("text"))
    keys = docs.select(F.coalesce(number, F.lit(-(1 << 63))).alias("k"))
    bounds = keys.agg(F.percentile_approx("k", [i / parts for i in range(1, parts)], 10 * parts)).first()[0] or [] if parts > 1 else []
    if not bounds:
        return docs.withColumn("part", F.lit(0)), 1
    values = sorted(set(bounds))
    times = [bounds.count(v) for v in values]
    before = [sum(times[:i]) for i in range(len(values) + 1)]
    array = lambda numbers, kind: F.array(*[F.lit(n).cast(kind) for n in numbers])
    found = InternalFunction.array_binary_search(array(values, "long"), F.coalesce(number, F.lit(-(1 << 63))))
    share = (F.col("digest").cast("double") / 2.0**64 + 0.5) * F.get(array(times, "int"), F.col("found"))
    inside = F.get(array(before, "int"), F.col("found")) + F.least(F.floor(share).cast("int"), F.get(array(times, "int"), F.col("found")) - 1)
    apart = F.get(array(before, "int"), -F.col("found") - 1)
    placed = docs.withColumn("found", found).withColumn("part", F.when(F.col("found") >= 0, inside).otherwise(apart)).drop("found")
    return placed, len(bounds) + 1


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row.

    The next document is the next row by descending key (rows of one key by a hash of the text; null keys last), and after the last
    the first; one row alone is its own next. Null texts are empty; two empty texts are equal (likeness 1). Other columns are ignored.

    Rows are dealt into ranges of keys by one shuffle of the texts, the only copy that is made of them. A range is read from its smallest key
    up, so that the next document of a row has just been read; that of the first row is the greatest row of the range
    below, which is sent along.
    """
    docs = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    session, kind = docs.sparkSession, docs.schema["doc_id"].dataType.simpleString()
    tasks = int(session.conf.get("spark.sql.shuffle.partitions"))
    ranged, parts = _ranged(docs, 4 * tasks)

    tops = ranged.groupBy("part").agg(F.max(F.struct("doc_id", "digest")).alias("top"))
    tops = materialize(tops, "tops")  # a row per range
    order = Window.orderBy("part")
    below = F.coalesce(F.lag("top").over(order), F.last("top").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    wanted = tops.select("part", below.alias("top")).select(F.col("part").alias("above"), F.col("top.doc_id").alias("id"), F.col("top.digest").alias("hash"))
    borders = ranged.join(F.broadcast(wanted), F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("hash")))
    borders = borders.dropDuplicates(["above"]).select(F.col("above").alias("part"), F.lit(0).alias("role"), F.lit(None).cast(kind).alias("doc_id"), "digest", "text")
    rows = ranged.select("part", F.lit(1).alias("role"), "doc_id", "digest", "text").unionByName(borders)
    in_order = rows.repartition(tasks, "part").sortWithinPartitions("part", "role", F.asc_nulls_first("doc_id"), "digest", "text")

    def run(batches: Iterator) -> Iterator:
        after = None  # the text read before, and its fingerprint
        for batch in batches:
            found, key_type = [], batch.column(2).type
            for role, doc, body in zip(*(batch.column(i).to_pylist() for i in (1, 2, 4))):
                cut = pieces(body)
                mark = Fingerprint().changed(cut)
                if role:
                    found.append(row(doc, body, mark, cut, *after))
                after = body, mark
            types = [key_type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            columns = [pa.array(c, t) for c, t in zip(zip(*found) if found else [[]] * len(types), types)]
            yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    schema = f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return common.in_batches(in_order, run, schema)
