"""Exact selection by rank without ordering the rows.

Values are searched by narrowing: numbers become 64-bit integers in the same order, a pass counts the rows of at most 8,192
sub-ranges of the range that still holds a rank, and the next pass splits the chosen sub-range. Every pass narrows a range by 13 bits
at least, so five passes find any rank, and data of few or evenly spread values take two or three. Only counts are ever ordered.

Hashes are spread evenly by themselves: rows are counted in 65,536 ranges, and only the rows in the range of a cut are looked
at. Cuts are tables with a row per class and rank, so any number of classes can be cut at once.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from propensity.functions.scalars import hash_text
from propensity.session import materialize

_RUNNING = (Window.unboundedPreceding, Window.currentRow)

#: Rows are ordered by 15 hexadecimal digits and counted by the first 4: 65,536 ranges.
_HASH_DIGITS, _RANGE_DIGITS = 15, 4
#: Bits by which a pass narrows a range: 8,192 counts per range.
_PASS_BITS = 13


# ------------------------------------------------------------ by value


@dataclass(frozen=True)
class Place:
    """The value at a rank, how many rows have it, and which of them in order (from 1) the rank is."""

    value: float
    place: int
    ties: int


def order_bits(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The IEEE bits of each number as a double, as longs ``c0, c1 ...`` in the order of the numbers; NULL for NULL and NaN.

    Infinities are the ends; both zeros are 0. There is no function for the bits: the exponent is the rounded logarithm set right by
    comparison, and scaling by powers of two is exact. Each step is a projection of its own, so that no term is repeated.
    """
    numbers = range(len(names))
    steps = df.select(*[F.col(f"`{n}`").cast("double").alias(f"x{i}") for i, n in enumerate(names)])
    sizes = [F.when(F.abs(f"x{i}") < float("inf"), F.abs(f"x{i}")).otherwise(F.lit(1.0)).alias(f"s{i}") for i in numbers]
    steps = steps.select("*", *sizes)

    def step(frame: DataFrame, name: str, make: Callable[[Column, Column], Column]) -> DataFrame:
        made = [make(F.col(f"s{i}"), F.col(f"{name}{i}")).alias(f"e{i}") for i in numbers]
        return frame.select(*[f"{kept}{i}" for kept in "xs" for i in numbers], *made)

    power = lambda e: F.pow(F.lit(2.0), e)
    one = lambda condition: condition.cast("int")
    steps = step(steps, "x", lambda size, _: F.greatest(F.least(F.floor(F.log2(size)), F.lit(1023)), F.lit(-1022)))
    steps = step(steps, "e", lambda size, e: e - one(power(e) > size))
    steps = step(steps, "e", lambda size, e: F.greatest(e + one(power(e + 1) <= size), F.lit(-1022).cast("long")))
    steps = step(steps, "e", lambda size, e: F.shiftleft(e + 1022, 52) + (size / power(e) * F.lit(2.0**52)).cast("long"))

    def signed(x: Column, bits: Column) -> Column:
        size = F.when(x == 0, F.lit(0).cast("long")).when(F.abs(x) == float("inf"), F.lit(0x7FF0 << 48).cast("long")).otherwise(bits)
        return F.when(x.isNotNull() & ~F.isnan(x), size * F.when(x < 0, -1).otherwise(1))

    return steps.select(*[signed(F.col(f"x{i}"), F.col(f"e{i}")).alias(f"c{i}") for i in numbers])


def from_order_bits(bits: int) -> float:
    size = struct.unpack("<d", struct.pack("<q", abs(bits)))[0]
    return -size if bits < 0 else size


def places_at_ranks(df: DataFrame, wanted: Mapping[str, Sequence[int]]) -> dict[tuple[str, int], Place]:
    """What stands at the 1-based ascending ``wanted`` ranks of each column, without its NULLs and NaN.

    All columns and ranks are counted in the same passes over ``df``; a rank beyond a column's values is an error.
    """
    bits = order_bits(df, list(wanted))
    found: dict[tuple[str, int], Place] = {}
    # a range of a column, and the ranks sought in it with their places there; at first everything
    pending = {(i, None, None): {(c, rank): rank for rank in set(ranks)} for i, (c, ranks) in enumerate(wanted.items()) if ranks}
    while pending:
        hits = _counted(bits, pending)
        following: dict[tuple, dict] = {}
        for slot, sought in enumerate(pending.values()):
            for (c, rank), place in sought.items():
                row = next((r for r in hits if r.slot == slot and r.before < place <= r.before + r.n), None)
                if row is None:
                    raise ValueError(f"'{c}' has no {rank} comparable values")
                if row.low == row.top:
                    found[c, rank] = Place(from_order_bits(row.low), place - row.before, row.n)
                else:
                    column = list(wanted).index(c)
                    following.setdefault((column, row.low, row.top), {})[c, rank] = place - row.before
        pending = following
    return found


def _counted(bits: DataFrame, pending: Mapping[tuple, Mapping]) -> list:
    """The sub-ranges that hold a sought place: ``slot, n, before, low, top``, the last two the least and greatest value."""

    def entry(slot: int, column: int, low: int | None, top: int | None) -> Column:
        value = F.col(f"c{column}")
        if low is None:
            inside, part = value.isNotNull(), F.shiftright(value, 64 - _PASS_BITS)
        else:
            inside = value.between(low, top)
            part = F.shiftright(value - F.lit(low), max(0, (top - low).bit_length() - _PASS_BITS))
        return F.when(inside, F.struct(F.lit(slot).alias("slot"), part.alias("part"), value.alias("value")))

    entries = [entry(slot, *span) for slot, span in enumerate(pending)]
    counted = (
        bits.select(F.inline(F.array_compact(F.array(*entries))))
        .groupBy("slot", "part")
        .agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("top"))
    )
    in_order = Window.partitionBy("slot").orderBy("part").rowsBetween(*_RUNNING)
    before = counted.withColumn("before", F.sum("n").over(in_order) - F.col("n"))
    hit = F.lit(False)
    for slot, sought in enumerate(pending.values()):
        for place in sorted(set(sought.values())):
            hit = hit | ((F.col("slot") == slot) & (F.col("before") < place) & (F.col("before") + F.col("n") >= place))
    return before.where(hit).select("slot", "n", "before", "low", "top").collect()


def values_at_ranks(df: DataFrame, wanted: Mapping[str, Sequence[int]]) -> dict[tuple[str, int], float]:
    return {at: place.value for at, place in places_at_ranks(df, wanted).items()}


# ------------------------------------------------------------ by hash


def order_hash(key: Column, seed: int) -> Column:
    """The pseudo-random order of keys; ties are settled by the key itself."""
    return hash_text(key, seed, _HASH_DIGITS)


def hash_range(hashed: Column) -> Column:
    return F.substring(hashed, 1, _RANGE_DIGITS)


def hash_order(keys: Sequence[Column], seed: int) -> Column:
    """A value that orders rows by the seeded hash of their key, ties by the key; NULLs in it come first."""
    text = keys[0] if len(keys) == 1 else F.concat_ws("-", *[k.cast("string") for k in keys])
    return F.struct(order_hash(text, seed).alias("hash"), F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)]).alias("key"))


def ranges_before(rows: DataFrame) -> DataFrame:
    """Rows per ``label`` and ``hash_range`` of frames with ``label, place``, the running count ``upto`` and the label's ``total``.

    At most 65,536 rows per label whatever the data, so ordering them is cheap.
    """
    counted = rows.select("label", hash_range(F.col("place.hash")).alias("hash_range")).groupBy("label", "hash_range").count()
    same = Window.partitionBy("label")
    return counted.withColumns(
        {"upto": F.sum("count").over(same.orderBy("hash_range").rowsBetween(*_RUNNING)), "total": F.sum("count").over(same)}
    )


def hash_cuts(rows: DataFrame, ranks: Callable[[Column], Sequence[Column]]) -> DataFrame:
    """``label, rank, cut, of_ties, ties``: what stands at wanted ranks of each label, in the order of ``place``.

    ``rows`` holds ``label, place`` with places from ``hash_order``, and is read twice; ``ranks`` turns the rows of a label into
    1-based ranks, of which those of 0 are left out. ``ties`` rows have the very place ``cut``, ``of_ties`` of them are within the
    rank. A label may hold any share of the rows, and there may be any number of labels.
    """
    holds = (F.col("rank") <= F.col("upto")) & (F.col("rank") > F.col("upto") - F.col("count"))
    wanted = F.explode(F.array_distinct(F.array(*[r.cast("long") for r in ranks(F.col("total"))])))
    spots = (
        ranges_before(rows)
        .withColumn("rank", wanted)
        .where(holds)
        .select("label", "hash_range", "rank", (F.col("rank") - F.col("upto") + F.col("count")).alias("within"))
    )
    spots = materialize(spots, "spots")
    near = (
        rows.withColumn("hash_range", hash_range(F.col("place.hash")))
        .join(spots.select("label", "hash_range").distinct(), ["label", "hash_range"], "left_semi")
        .groupBy("label", "hash_range", "place")
        .count()
    )
    in_order = Window.partitionBy("label", "hash_range").orderBy("place").rowsBetween(*_RUNNING)
    exact = near.withColumn("upto", F.sum("count").over(in_order)).join(spots, ["label", "hash_range"])
    exact = exact.where((F.col("within") <= F.col("upto")) & (F.col("within") > F.col("upto") - F.col("count")))
    of_ties = F.col("within") - F.col("upto") + F.col("count")
    cuts = exact.select("label", "rank", F.col("place").alias("cut"), of_ties.alias("of_ties"), F.col("count").alias("ties"))
    return materialize(cuts, "cuts")


def numbered(ordered: DataFrame, name: str) -> DataFrame:
    """Add ``name``: the place of each row from 0 in the order a frame is sorted in.

    The sorted frame is written first, as its ranges are sampled; rows are numbered in their partition, and the
    offsets table has a row per partition.
    """
    placed = materialize(ordered.withColumn("_place", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_place", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_offset"))
    inside = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    rows = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    return rows.select(*ordered.columns, (F.col("_offset") + inside).alias(name))
