"""Audience selection from scored users."""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.internal import InternalFunction

from propensity.operators.ranking import hash_cuts, hash_order, order_hash, places_at_ranks
from propensity.session import materialize, scratch

#: Up to so many users are kept as whole rows in a bounded heap per task; beyond, the cut is searched by rank.
HEAP_ROWS = 100_000
#: Heaps of so many tasks are merged by one task of the next level.
FAN_IN = 32


def scored_only(scored: DataFrame) -> DataFrame:
    """Users with a probability: a NULL or NaN is no score and is never ranked or selected."""
    probability = F.col("probability")
    return scored.where(probability.isNotNull() & ~F.isnan(probability.cast("double")))


def ranked(scored: DataFrame, key: str = "user_id", seed: int = 42) -> DataFrame:
    """All scored users, most likely first, ties by seeded hash and then key; a range-partitioned sort."""
    return scored_only(scored).orderBy(F.desc("probability"), order_hash(F.col(key), seed), key)


def top_n(scored: DataFrame, n: int = 2000, key: str = "user_id", seed: int = 42) -> DataFrame:
    """The ``n`` most likely users, or all scored ones if they are fewer; ties at the cut go by seeded hash, then key.

    Every task keeps a heap of its best ``n`` and the heaps are merged in three levels, in one job over ``scored``. An ``n``
    above HEAP_ROWS is too many rows for a heap, and the cut is searched by rank; both give the same users.
    """
    if n < 0:
        raise ValueError(f"an audience has 0 or more users, not {n}")
    known = scored_only(scored)
    if n == 0:
        return known.where(F.lit(False))
    if n > HEAP_ROWS:
        return _cut(known, lambda size: min(n, size), key, seed)
    row = F.struct(
        (-F.col("probability")).alias("down"), hash_order([F.col(key)], seed).alias("place"), F.struct(*[F.col(c) for c in known.columns]).alias("row")
    )
    best = known.select(row.alias("row"), F.pmod(F.spark_partition_id(), F.lit(FAN_IN**2)).alias("part"))
    for _ in range(3):
        heap = InternalFunction.collect_top_k(F.col("row"), n, True)
        best = best.groupBy("part").agg(heap.alias("rows")).select(F.explode("rows").alias("row"), F.floor(F.col("part") / FAN_IN).alias("part"))
    return best.select("row.row.*")


def above(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Users at or above a probability."""
    return scored_only(scored).where(F.col("probability") >= threshold)


def top_percent(scored: DataFrame, percent: float = 15, key: str = "user_id", seed: int = 42) -> DataFrame:
    """The most likely ``percent`` of scored users, rounded up; ties at the cut as in ``top_n``."""
    if not 0 <= percent <= 100:
        raise ValueError(f"a percentage is from 0 to 100, not {percent}")
    return _cut(scored_only(scored), lambda size: math.ceil(Fraction(str(percent)) * size / 100), key, seed)


def _cut(known: DataFrame, wanted, key: str, seed: int) -> DataFrame:
    """The most likely users, as many as ``wanted`` makes of the number of all.

    The cut is found first from keys and probabilities, written once, so that the result is a filter of the scored table:
    nothing is sorted as a whole, and any share of users may have the same probability.
    """
    probability, place = F.col("probability").cast("double"), hash_order([F.col(key)], seed)
    with scratch(known.sparkSession):
        narrow = materialize(known.select(F.col(key).alias("key"), probability.alias("probability")), "scored")
        size = narrow.count()
        chosen = wanted(size)
        if chosen == 0:
            return known.where(F.lit(False))
        last = size - chosen + 1
        spot = places_at_ranks(narrow, {"probability": [last]})["probability", last]
        room = spot.ties - spot.place + 1
        if room == spot.ties:
            return known.where(probability >= spot.value)
        tied = narrow.where(F.col("probability") == spot.value).select(F.lit(0).alias("label"), hash_order([F.col("key")], seed).alias("place"))
        cut = hash_cuts(tied, lambda total: [F.lit(room)]).first()["cut"]
    return known.where((probability > spot.value) | ((probability == spot.value) & _within(place, cut)))


def _within(place: Column, cut) -> Column:
    hashed, key = place["hash"], place["key"]["k0"]
    return (hashed < cut["hash"]) | ((hashed == cut["hash"]) & (key <= cut["key"]["k0"]))
