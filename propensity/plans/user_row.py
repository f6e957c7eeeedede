"""The point-in-time feature row: one row per user around a cut-off.

Traffic is read twice. Once it is reduced in two steps, by user and day and then by user, so that the blocks share the
scan, days are counted without a distinct aggregate, and a user with a large share of all rows is
spread over days before meeting in one group; distinct campaigns go the same way, by user and
campaign, as further entries of the same events. The second read is of the clicks alone. Clicks and orders give one row per
user each and meet the rest on the partitioning their own aggregation left, without another shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, functions as F

from propensity.functions.scalars import click_through_rate, in_share, seconds_between
from propensity.operators import clicks, conversions, traffic as ads
from propensity.operators.cutoffs import HORIZONS, Cutoff, cutoff
from propensity.plans.snapshots import per_user_and_cutoff
from propensity.sources.tables import CONVERSIONS, TRAFFIC, conform

TARGET = ("total_conversions_after_30d", "total_revenue_after_30d", "total_quantity_after_30d")


def _traffic_rows(traffic: DataFrame, cut: Cutoff, horizons: Sequence[int], as_of: bool) -> DataFrame:
    """All traffic blocks, one row per user with a sponsored-products event before the cut-off, from one read.

    An event gives an entry to its day and one to its campaign; both are reduced before the shuffle.
    """
    before = ads.of_type(ads.PRODUCTS) & cut.before
    day, campaign = F.to_date(cut.ts), F.col("campaign_id_string")

    def entry(of_day: bool, day: Column, campaign: Column) -> Column:
        return F.struct(F.lit(of_day).alias("of_day"), day.cast("date").alias("day"), campaign.cast("string").alias("campaign"))

    null = F.lit(None)
    entries = F.array(entry(True, day, null), F.when(before & campaign.isNotNull(), entry(False, null, campaign)))
    each = (traffic.where(cut.up_to) if as_of else traffic).select("*", F.inline(F.array_compact(entries)))
    of_day = F.col("of_day")
    products, brands, up_to = of_day & before, of_day & ads.of_type(ads.BRANDS) & cut.before, of_day & cut.up_to
    per_part = (
        each.groupBy("user_id", "of_day", "day", "campaign")
        .agg(
            *ads.window_totals(cut, products, horizons),
            *ads.last_event(cut, products),
            *ads.search_terms(of_day),
            *ads.product_totals(cut, "sp", products),
            *ads.product_totals(cut, "sb", brands),
            *ads.ad_day_flags(up_to),
            *ads.last_impression(cut, up_to),
            *ads.last_click(cut, up_to),
        )
        .withColumn("search_campaign_cnt", F.when(~of_day, 1))
        .drop("of_day", "day", "campaign")
    )
    counts = ("search_campaign_cnt", "impression_day_count", "click_day_count", "search_term_count")

    def merged(name: str) -> Column:
        if name in counts:
            return F.coalesce(F.sum(name), F.lit(0)).alias(name)
        return (F.max(name) if name.endswith(("_dt", "_dt_before")) else F.sum(name)).alias(name)

    per_user = per_part.groupBy("user_id").agg(*[merged(n) for n in per_part.columns if n != "user_id"])
    return per_user.where(F.col("last_event_dt_before").isNotNull())


def _conversion_blocks(cut: Cutoff, horizons: Sequence[int]) -> list[Column]:
    return [
        *conversions.conversion_target(cut, cut.after),
        *conversions.conversion_history(cut, cut.before, horizons),
    ]


def _contract(key: Sequence[str], at: Column, horizons: Sequence[int]) -> list[Column]:
    """The output columns in order.

    Users without a key come from the driving block only: a left join on the key finds nothing
    for them, so every other block is NULL there.
    """
    matched = F.col("user_id").isNotNull()

    def joined(name: str) -> Column:
        return F.when(matched, F.col(name)).alias(name)

    def rate(tag: str) -> Column:
        part = f"last_30days_{tag}"
        rate = click_through_rate(F.col(f"{part}_clicks"), F.col(f"{part}_impressions"))
        return F.when(matched, rate).otherwise(F.lit(0.0)).alias(f"{tag}_ctr_30d")

    def since(event: str) -> Column:
        seconds = seconds_between(F.col(f"last_{event}_dt"), at)
        return F.when(matched, seconds).alias(f"last_{event}_time_diff_seconds")

    windows = [f"total_{name}_{days}d" for days in horizons for name in ("impressions", "clicks")]
    history = [
        f"total_{name}_before_{days}d"
        for days in horizons
        for name in ("conversions", "revenue", "quantity")
    ]
    return [
        *map(F.col, key),
        F.col("search_campaign_cnt"),
        *map(F.col, windows),
        *map(F.col, TARGET),
        *map(F.col, history),
        F.col("last_event_dt_before"),
        joined("search_term_count"),
        joined("last_30days_sp_impressions"),
        joined("last_30days_sp_clicks"),
        rate("sp"),
        joined("last_30days_sb_impressions"),
        joined("last_30days_sb_clicks"),
        rate("sb"),
        F.col("avg_click_interval_seconds"),
        joined("impression_day_count"),
        joined("click_day_count"),
        since("impression"),
        since("click"),
    ]


def user_row(
    traffic: DataFrame,
    orders: DataFrame,
    time_point,
    horizons: Sequence[int] = HORIZONS,
    as_of: bool = False,
    sample_percent: float | None = None,
    seed: int = 42,
) -> DataFrame:
    """One feature row per user with a sponsored-products event before ``time_point``.

    ``as_of=True`` counts search terms up to the cut-off only; by default they are counted over
    all time, which leaks later events. ``sample_percent`` keeps a reproducible share of users and
    is applied to both tables before any shuffle.
    """
    traffic, orders = conform(traffic, TRAFFIC), conform(orders, CONVERSIONS)
    if sample_percent is not None:
        chosen = in_sample(F.col("user_id"), sample_percent, seed)
        traffic, orders = traffic.where(chosen), orders.where(chosen)
    cut = cutoff(traffic, time_point)
    per_user = _traffic_rows(traffic, cut, horizons, as_of)
    gaps = clicks.click_interval(traffic.where((F.col("clicks") > 0) & cut.up_to))
    bought = orders.where(conversions.is_order()).groupBy("user_id").agg(*_conversion_blocks(cut, horizons))
    joined = per_user.join(bought, "user_id", "left").join(gaps, "user_id", "left")
    return joined.select(*_contract(("user_id",), cut.at, horizons))


def user_rows(
    traffic: DataFrame,
    orders: DataFrame,
    time_points: Sequence,
    horizons: Sequence[int] = HORIZONS,
    as_of: bool = False,
) -> DataFrame:
    """Feature rows at any number of cut-offs in one job, keyed by ``time_point`` and ``user_id``.

    Events are read and reduced once, by user and the slices of time between the edges of all windows.
    """
    rows = per_user_and_cutoff(traffic, orders, time_points, horizons, as_of)
    return rows.select(*_contract(("time_point", "user_id"), F.col("time_point"), horizons))


def in_sample(user: Column, percent: float, seed: int = 42) -> Column:
    """A reproducible share of users: the same users in every run, engine and partitioning."""
    return in_share(user, Fraction(str(percent)) / 100, seed)
