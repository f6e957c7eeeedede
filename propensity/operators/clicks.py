"""Mean gap over all pairs of clicks of a user, without forming the pairs.

A pair is two clicks at different instants; its gap is the difference of their whole seconds.
So the number of pairs needs only how many clicks share an instant, and the sum of gaps needs
only how many clicks fall in each second:

    pairs = (clicks * (clicks - 1) - sum over instants of ties * (ties - 1)) / 2
    gaps  = sum over seconds of n * (second * earlier clicks - sum of earlier seconds)

The second sum is taken inside each day and then across days. A day has at most 86,400 seconds
and a user at most one row per day, so no window partition grows with the data, however many
clicks one user has; every grouping before them is reduced map-side. Products are exact decimals:
the clicks of a hot user squared do not fit 64 bits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from propensity.functions.scalars import DAY, epoch_seconds, ratio

_EXACT = "decimal(38,0)"
_EARLIER = (Window.unboundedPreceding, -1)


def _times(left: str, right: str) -> Column:
    return F.col(left).cast("decimal(19,0)") * F.col(right).cast("decimal(19,0)")


def _ordered_pairs(count: str) -> Column:
    """n * (n - 1); NULL for a single click, which is the common case and then costs nothing."""
    return F.when(F.col(count) > 1, _times(count, count) - F.col(count))


def _or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0).cast(_EXACT))


def _pairs() -> Column:
    return ((_or_zero(_ordered_pairs("n")) - _or_zero(F.col("ties"))) / 2).cast(_EXACT)


def _clicks_per_instant(clicks: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    known = clicks.na.drop(subset=[*keys, ts])
    return known.groupBy(*keys, ts).agg(F.count(F.lit(1)).alias("n"))


def click_pairs(clicks: DataFrame, keys: Sequence[str] = ("user_id",), ts: str = "event_dt_utc") -> DataFrame:
    """Number of earlier/later click pairs per user; users without a pair are left out."""
    return (
        _clicks_per_instant(clicks, keys, ts)
        .groupBy(*keys)
        .agg(F.sum("n").alias("n"), F.sum(_ordered_pairs("n")).alias("ties"))
        .select(*keys, _pairs().cast("long").alias("pair_count"))
        .where(F.col("pair_count") > 0)
    )


def click_states(clicks: DataFrame, keys: Sequence[str] = ("user_id",), ts: str = "event_dt_utc") -> DataFrame:
    """``n, ties, at, gaps`` per key: clicks, ordered pairs at one instant, the sum of their seconds, and the sum of all gaps.

    States of stretches of time that follow each other merge: the gaps of both, and those between them, which are
    n of the earlier times the later ``at`` less n of the later times the earlier ``at``.
    """
    whole = epoch_seconds(F.col(ts))
    gap = _times("at", "earlier") - _times("n", "earlier_at")
    per_second = (
        _clicks_per_instant(clicks, keys, ts)
        .withColumn("second", F.pmod(whole, F.lit(DAY)))
        .withColumn("day", ((whole - F.col("second")) / DAY).cast("long"))
        .groupBy(*keys, "day", "second")
        .agg(F.sum("n").alias("n"), F.sum(_ordered_pairs("n")).alias("ties"))
        .withColumn("at", F.col("second") * F.col("n"))
    )
    in_day = Window.partitionBy(*keys, "day").orderBy("second").rowsBetween(*_EARLIER)
    per_day = (
        per_second.withColumn("earlier", F.sum("n").over(in_day))
        .withColumn("earlier_at", F.sum("at").over(in_day))
        .groupBy(*keys, "day")
        .agg(
            F.sum("n").alias("n"),
            F.sum("at").alias("in_day_at"),
            F.sum("ties").alias("ties"),
            F.sum(gap).alias("gaps"),
        )
        .withColumn("at", F.col("day").cast("decimal(10,0)") * DAY * F.col("n") + F.col("in_day_at"))
    )
    over_days = Window.partitionBy(*keys).orderBy("day").rowsBetween(*_EARLIER)
    return (
        per_day.withColumn("earlier", F.sum("n").over(over_days))
        .withColumn("earlier_at", F.sum("at").over(over_days))
        .groupBy(*keys)
        .agg(
            F.sum("n").alias("n"),
            F.sum("ties").alias("ties"),
            F.sum("at").cast(_EXACT).alias("at"),
            (_or_zero(F.sum("gaps")) + _or_zero(F.sum(_across().cast(_EXACT)))).alias("gaps"),
        )
    )


def _across() -> Column:
    """The gaps between a stretch and all earlier ones, of which there are ``earlier`` clicks with ``earlier_at`` seconds."""
    return F.col("at") * F.col("earlier") - F.col("n") * F.col("earlier_at")


def mean_gap(n: Column, ties: Column, gaps: Column) -> Column:
    """The mean gap of a state; NULL without a pair."""
    pairs = ((_or_zero(F.when(n > 1, n.cast("decimal(19,0)") * n.cast("decimal(19,0)") - n)) - _or_zero(ties)) / 2).cast(_EXACT)
    return F.when(pairs > 0, ratio(gaps, pairs))


def click_interval(clicks: DataFrame, keys: Sequence[str] = ("user_id",), ts: str = "event_dt_utc") -> DataFrame:
    """``avg_click_interval_seconds`` per user; users without a pair are left out.

    ``clicks`` holds the rows with clicks > 0 up to the cut-off.
    """
    gap = mean_gap(F.col("n"), F.col("ties"), F.col("gaps")).alias("avg_click_interval_seconds")
    return click_states(clicks, keys, ts).select(*keys, gap).where(F.col("avg_click_interval_seconds").isNotNull())
