"""Columns of an event table relative to a cut-off time.

Windows are measured in whole seconds, each side rounded down first. ``age < n`` then means that
the event is not before a fixed instant, so every window test is one comparison of the event column
with a constant: cheap per row, and usable by the scan.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cache

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from propensity.functions.scalars import DAY
from propensity.session import require_utc

#: Look-back windows in days, longest first. The longest is also the look-ahead.
HORIZONS = (30, 15, 5)


def _moved(at: Column, seconds: int, kind: T.DataType) -> Column:
    """``at`` without its fraction of a second, moved by ``seconds``."""
    step = F.make_dt_interval(secs=F.lit(seconds))
    return (F.date_trunc("second", at) + step).cast(kind)


@dataclass(frozen=True)
class Cutoff:
    """One event time column seen from the cut-off ``at``.

    ``edge`` gives the instant a number of whole seconds from the cut-off.
    """

    ts: Column
    at: Column
    edge: Callable[[int], Column]

    @property
    def before(self) -> Column:
        return self.ts < self.at

    @property
    def after(self) -> Column:
        return self.ts > self.at

    @property
    def up_to(self) -> Column:
        return self.ts <= self.at

    def younger_than(self, days: int) -> Column:
        """Less than ``days`` before the cut-off."""
        return self.ts >= self.edge(1 - days * DAY)

    def at_most(self, days: int) -> Column:
        """No more than ``days`` before the cut-off."""
        return self.ts >= self.edge(-days * DAY)

    def sooner_than(self, days: int) -> Column:
        """Less than ``days`` after the cut-off."""
        return self.ts < self.edge(days * DAY)


def cutoff(df: DataFrame, time_point, ts: str = "event_dt_utc") -> Cutoff:
    """``time_point`` takes the type of the event column, so comparisons leave that column bare."""
    require_utc(df, ts)
    kind = df.schema[ts].dataType
    at = F.lit(time_point).cast(kind)
    return Cutoff(F.col(ts), at, cache(lambda offset: _moved(at, offset, kind)))
