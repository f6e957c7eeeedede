"""Recency, frequency and monetary value of buyers, with their display-ad engagement."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from propensity.functions.scalars import money_sum, ratio, seconds_between
from propensity.operators.conversions import is_order
from propensity.sources.tables import (
    AUDIENCE_CONVERSIONS,
    DISPLAY_CLICKS,
    DISPLAY_IMPRESSIONS,
    conform,
)


def purchase_summary(orders: DataFrame) -> DataFrame:
    """Last purchase, purchases, sales and mean value per unit of each buyer."""
    return (
        conform(orders, AUDIENCE_CONVERSIONS)
        .where(is_order())
        .groupBy("user_id")
        .agg(
            F.max("event_date_utc").alias("last_purchase_date"),
            F.count("user_id").alias("total_purchases"),
            money_sum(F.col("total_product_sales")).alias("total_sales_value"),
            F.avg(ratio(F.col("total_product_sales"), F.col("total_units_sold"))).alias(
                "avg_order_value"
            ),
        )
    )


def engagement_events(impressions: DataFrame, clicks: DataFrame) -> DataFrame:
    """Impressions and clicks as one table, matched by position: click times join impression times."""
    shown = conform(impressions, DISPLAY_IMPRESSIONS).select(
        "user_id", "impressions", F.lit(0).alias("clicks"), "impression_dt_utc", "campaign_id"
    )
    clicked = conform(clicks, DISPLAY_CLICKS).select(
        "user_id", F.lit(0).alias("impressions"), "clicks", "click_dt_utc", "campaign_id"
    )
    return shown.union(clicked)


def engagement_summary(impressions: DataFrame, clicks: DataFrame) -> DataFrame:
    """Totals, distinct event times (not days) and distinct campaigns per user.

    Distinct times and (user, campaign) sums are reduced first and added up by user, so that no row is multiplied.
    """
    events = engagement_events(impressions, clicks)
    campaigns = events.groupBy("user_id", "campaign_id").agg(
        F.sum("impressions").alias("impressions"), F.sum("clicks").alias("clicks")
    )
    times = events.select("user_id", "impression_dt_utc").distinct()
    return (
        campaigns.unionByName(times, allowMissingColumns=True)
        .groupBy("user_id")
        .agg(
            F.sum("impressions").alias("total_impressions"),
            F.sum("clicks").alias("total_clicks"),
            F.count("impression_dt_utc").alias("active_days"),
            F.count("campaign_id").alias("distinct_campaigns"),
        )
    )


def rfm_row(orders: DataFrame, impressions: DataFrame, clicks: DataFrame, as_of_date) -> DataFrame:
    """One row per buyer; ``as_of_date`` stands for today, so that results repeat."""
    buyers = purchase_summary(orders)
    today = F.lit(as_of_date).cast("date")
    return buyers.join(engagement_summary(impressions, clicks), "user_id", "left").select(
        "user_id",
        seconds_between(F.col("last_purchase_date"), today).alias("recency"),
        F.col("total_purchases").alias("frequency"),
        F.col("total_sales_value").alias("monetary"),
        "avg_order_value",
        "total_impressions",
        "total_clicks",
        ratio(F.col("total_clicks"), F.col("total_impressions")).alias("click_through_rate"),
        "active_days",
        "distinct_campaigns",
    )
