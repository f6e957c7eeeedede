"""Per-user features of the conversions table; the same block convention as the traffic features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from propensity.functions.scalars import money_sum, only
from propensity.operators.cutoffs import HORIZONS, Cutoff


def is_order() -> Column:
    return F.col("event_subtype") == "order"


def _totals(inside: Column, rows: Column | None, suffix: str) -> list[Column]:
    def within(name: str, zero) -> Column:
        return only(rows, F.when(inside, F.col(name)).otherwise(zero))

    return [
        F.sum(within("conversions", 0)).alias(f"total_conversions_{suffix}"),
        money_sum(within("total_product_sales", 0)).alias(f"total_revenue_{suffix}"),
        F.sum(within("total_units_sold", 0)).alias(f"total_quantity_{suffix}"),
    ]


def conversion_target(cut: Cutoff, rows: Column | None = None, days: int = 30) -> list[Column]:
    """Conversions, revenue and quantity in the look-ahead window."""
    return _totals(cut.sooner_than(days), rows, f"after_{days}d")


def conversion_history(
    cut: Cutoff, rows: Column | None = None, horizons: Sequence[int] = HORIZONS
) -> list[Column]:
    """Conversions, revenue and quantity per look-back window."""
    return [
        column
        for days in horizons
        for column in _totals(cut.younger_than(days), rows, f"before_{days}d")
    ]
