"""What the text operators share: token rules, Arrow loops, fixed-size filters, hash keys."""

from __future__ import annotations

import os
import re
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Rows of an Arrow batch: bounds what a Python worker holds when texts are very long.
BATCH_ROWS = 256
#: Bits of a membership filter sent to tasks: 1 MB at any input size. Fuller filters only let more through.
FILTER_BITS = 1 << 23


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def words(text: bytes | None) -> list[bytes]:
    """Lower-cased (A-Z) runs of bytes other than space and \\t \\n \\v \\f \\r; none for a null text."""
    return text.lower().split() if text else []


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the executors, once a session, if workers would not find them by their path."""
    top = Path(__file__).resolve().parents[2]
    found = [Path.cwd(), *(Path(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p)]
    if top in [p.resolve() for p in found] or getattr(spark.sparkContext, "_propensity_sent", False):
        return
    file = Path(os.path.realpath(tempfile.mkdtemp(prefix="propensity-"))) / "propensity.zip"
    with zipfile.ZipFile(file, "w") as out:
        for module in sorted((top / "propensity").rglob("*.py")):
            out.write(module, module.relative_to(top))
    spark.sparkContext.addPyFile(str(file))
    spark.sparkContext._propensity_sent = True


def in_batches(df: DataFrame, function: Callable[[Iterator], Iterator], schema: str, rows: int = BATCH_ROWS) -> DataFrame:
    """``mapInArrow`` with small batches: a worker holds some hundred texts at once, however long the table.

    The setting is the session's; it is read when the result is run.
    """
    ship(df.sparkSession)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    return df.mapInArrow(function, schema)


def keyed_bytes(batch: pa.RecordBatch) -> Iterator[tuple[object, bytes | None]]:
    """(first column, second column as UTF-8) of each row."""
    return zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist())


def word_hashes(tokens: list[bytes] | list[str]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))


def mixed(values: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of the 64-bit input (one to one)."""
    values = values ^ (values >> np.uint64(31))
    values = values * np.uint64(0x9E3779B97F4A7C15)
    values = values ^ (values >> np.uint64(29))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


#: Bytes whose words are hashed at once: the arrays stay in cache, and small for very long texts.
PIECE = 1 << 16
#: Longer words are hashed one by one.
LONG_WORD = 64
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_VALUES = mixed(np.arange(1, 257, dtype=np.uint64))
_VALUES[65:91] = _VALUES[97:123]
_BASE = 0xD6E8FEB86659FD93
#: Odd factors of the words of an n-gram, by place.
_FACTORS = mixed(np.arange(257, 273, dtype=np.uint64)) | np.uint64(1)


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_BASE, 2 * PIECE), _powers(pow(_BASE, -1, 1 << 64), 2 * PIECE)


def pieces(raw: bytes) -> Iterator[tuple[int, bytes]]:
    """``raw`` cut before white space, about every PIECE bytes: (offset, part)."""
    at = 0
    while len(raw) - at > PIECE:
        found = _SPACE.search(raw, at + PIECE)
        end = found.start() if found else len(raw)
        yield at, raw[at:end]
        at = end
    yield at, raw[at:]


def hashed_words(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash, start) of each of ``words(raw)``, without a Python object a word.

    A word's hash is a polynomial over its bytes, read off cumulated sums, and then mixed. Long words, of which a
    polynomial modulo 2^64 may confuse some, are hashed as a whole.
    """
    hashes, places = [], []
    for at, part in pieces(raw):
        data = np.frombuffer(part, np.uint8)
        up, down = (_UP, _DOWN) if len(data) <= len(_UP) else (_powers(_BASE, len(data)), _powers(pow(_BASE, -1, 1 << 64), len(data)))
        space = np.ones(len(data) + 2, bool)
        space[1:-1] = _IS_SPACE[data]
        edges = np.flatnonzero(space[1:] != space[:-1])
        starts, ends = edges[::2], edges[1::2]
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_VALUES[data] * up[: len(data)], out=sums[1:])
        each = mixed((sums[ends] - sums[starts]) * down[starts])
        for i in np.flatnonzero(ends - starts > LONG_WORD).tolist():
            each[i] = xxhash.xxh3_64_intdigest(part[starts[i] : ends[i]].lower())
        hashes.append(each)
        places.append(starts + at)
    return np.concatenate(hashes), np.concatenate(places)


def gram_hashes(each: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash for each run of ``size`` (at most 16) word hashes, in order; none if there are fewer."""
    last = len(each) - size + 1
    if last < 1:
        return np.empty(0, np.uint64)
    total = np.zeros(last, np.uint64)
    for i in range(size):
        total += each[i : i + last] * _FACTORS[i]
    return mixed(total)


def remainder(key: str, modulus: int):
    """crc32 of the key as text, modulo ``modulus``; a null key counts as an empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % modulus


def filter_bits(df: DataFrame, column: str) -> np.ndarray:
    """A bit array of FILTER_BITS over the values of a 64-bit hash column: 0 means surely absent.

    The bits are united on the executors; the driver gets at most FILTER_BITS / 64 longs.
    """
    place = F.pmod(F.col(column), F.lit(FILTER_BITS))
    rows = (
        df.where(F.col(column).isNotNull())
        .select(F.shiftright(place, 6).alias("at"), F.expr(f"shiftleft(1L, int(pmod({column}, 64)))").alias("bit"))
        .groupBy("at")
        .agg(F.bit_or("bit").alias("bits"))
        .toArrow()
    )
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    bits[rows.column("at").to_numpy()] = rows.column("bits").to_numpy()
    return bits.view(np.uint64)


def maybe_in(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    """For unsigned 64-bit values: False where ``filter_bits`` surely lacks the value."""
    place = values & np.uint64(FILTER_BITS - 1)
    return (bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def parted(df: DataFrame, hashed: Column, wanted: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """The rows of ``df`` whose hash is surely not in ``column`` of ``wanted``, and all others.

    Only the others need to meet ``wanted`` in a join: long rows that have no part in it are not shuffled.
    """
    ship(df.sparkSession)
    bits = df.sparkSession.sparkContext.broadcast(filter_bits(wanted, column))

    @F.arrow_udf("boolean")
    def maybe(hashes: pa.Array) -> pa.Array:
        return pa.array(maybe_in(bits.value, hashes.to_numpy(zero_copy_only=False).view(np.uint64)))

    return df.where(~maybe(hashed)), df.where(maybe(hashed))


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def byte_blocks(batches: Iterator[pa.RecordBatch], limit: int, column: int) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in order, dealt anew into batches of about ``limit`` bytes in ``column``; a larger value comes alone.

    The bound holds whatever batches the session makes: what one block needs does not depend on its settings.
    """
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        values = batch.column(column)
        width = 1 if pa.types.is_string(values.type) or pa.types.is_binary(values.type) else 4
        sizes = np.diff(np.frombuffer(values.buffers()[1], np.int32, batch.num_rows + 1, 4 * values.offset)).astype(np.int64) * width
        start, ends = 0, np.cumsum(sizes)
        while start < batch.num_rows:
            before = int(ends[start - 1]) if start else 0
            stop = int(np.searchsorted(ends, before + limit - size, side="right"))
            if stop > start:
                held.append(batch.slice(start, stop - start))
                size += int(ends[stop - 1]) - before
                start = stop
            elif not held:
                held.append(batch.slice(start, 1))
                start += 1
                size = limit
            if size >= limit or start < batch.num_rows:
                yield _united(held)
                held, size = [], 0
    if held:
        yield _united(held)


def _united(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return batches[0] if len(batches) == 1 else pa.concat_batches(batches)


def gathered(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """``values[starts[c] : starts[c] + sizes[c]]`` for each c of ``codes``, one after another."""
    lengths = sizes[codes]
    at = np.repeat(starts[codes] - (np.cumsum(lengths) - lengths), lengths)
    at += np.arange(len(at))
    return values[at]
