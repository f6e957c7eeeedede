"""Per-user features of the ad traffic table.

Each function returns aggregate columns. ``rows`` limits a block to its own rows, so that blocks
with different filters can share one ``groupBy``; leave it out when the frame is filtered already.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from propensity.functions.scalars import only
from propensity.operators.cutoffs import HORIZONS, Cutoff

PRODUCTS = "sponsored_products"
BRANDS = "sponsored_brands"


def of_type(product_type: str) -> Column:
    return F.col("ad_product_type") == product_type


def campaigns(rows: Column | None = None) -> list[Column]:
    """Distinct campaigns."""
    return [F.count_distinct(only(rows, F.col("campaign_id_string"))).alias("search_campaign_cnt")]


def window_totals(
    cut: Cutoff, rows: Column | None = None, horizons: Sequence[int] = HORIZONS
) -> list[Column]:
    """Impressions and clicks per look-back window."""
    return [
        F.sum(only(rows, F.when(cut.younger_than(days), F.col(name)).otherwise(0))).alias(
            f"total_{name}_{days}d"
        )
        for days in horizons
        for name in ("impressions", "clicks")
    ]


def last_event(cut: Cutoff, rows: Column | None = None) -> list[Column]:
    return [F.max(only(rows, cut.ts)).alias("last_event_dt_before")]


def traffic_summary(cut: Cutoff, horizons: Sequence[int] = HORIZONS) -> list[Column]:
    """Distinct campaigns, impressions and clicks per look-back window, and the last event."""
    return [*campaigns(), *window_totals(cut, None, horizons), *last_event(cut)]


def product_totals(cut: Cutoff, tag: str, rows: Column | None = None, days: int = 30) -> list[Column]:
    """Impressions and clicks of one ad product over a closed window."""
    inside = cut.at_most(days)
    return [
        F.sum(only(rows, F.when(inside & (value > 0), value).otherwise(0))).alias(
            f"last_{days}days_{tag}_{name}"
        )
        for name, value in (("impressions", F.col("impressions")), ("clicks", F.col("clicks")))
    ]


def search_terms(rows: Column | None = None) -> list[Column]:
    """Events with a search term. Without ``rows`` this counts all time, past the cut-off too."""
    return [F.count(only(rows, F.col("customer_search_term"))).alias("search_term_count")]


def ad_day_flags(rows: Column | None = None) -> list[Column]:
    """For a frame grouped by day: 1 on a day with an impression, or a click, else NULL."""
    return [
        F.max(only(rows, F.when(F.col(f"{name}s") > 0, 1))).alias(f"{name}_day_count")
        for name in ("impression", "click")
    ]


def ad_days(events: DataFrame, ts: Column) -> DataFrame:
    """Distinct days with an impression, and with a click, per user: by day first, so that no distinct aggregate is needed."""
    per_day = events.groupBy("user_id", F.to_date(ts).alias("day")).agg(*ad_day_flags())
    names = ("impression_day_count", "click_day_count")
    return per_day.groupBy("user_id").agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])


def last_impression(cut: Cutoff, rows: Column | None = None) -> list[Column]:
    return [F.max(only(rows, F.when(F.col("impressions") > 0, cut.ts))).alias("last_impression_dt")]


def last_click(cut: Cutoff, rows: Column | None = None) -> list[Column]:
    return [F.max(only(rows, F.when(F.col("clicks") > 0, cut.ts))).alias("last_click_dt")]
