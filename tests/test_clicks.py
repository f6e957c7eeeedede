"""The closed form of the click gap against all pairs written out."""

import datetime as dt
import itertools
import math
import random

import pytest

from propensity.operators.clicks import click_interval, click_pairs

START = dt.datetime(2024, 1, 1)


def _brute(times):
    pairs = [(a, b) for a, b in itertools.combinations(sorted(times), 2) if a < b]
    gaps = [
        math.floor((b - START).total_seconds()) - math.floor((a - START).total_seconds()) for a, b in pairs
    ]
    return len(pairs), (sum(gaps) / len(gaps) if gaps else None)


@pytest.mark.parametrize("seed", range(4))
def test_pairs_and_gaps(spark, seed):
    draw = random.Random(seed)
    clicks = {}
    for user in range(40):
        spread = draw.choice([3, 100_000, 10_000_000])
        times = [
            START + dt.timedelta(seconds=draw.randrange(spread), microseconds=draw.choice([0, 1, 999_999]))
            for _ in range(draw.randrange(1, 30))
        ]
        clicks[user] = times + draw.choices(times, k=draw.randrange(4))
    rows = [(user, ts) for user, times in clicks.items() for ts in times] + [(None, START), (1, None)]
    df = spark.createDataFrame(rows, "user_id int, event_dt_utc timestamp_ntz")
    counted = {r.user_id: r.pair_count for r in click_pairs(df).collect()}
    gaps = {r.user_id: r.avg_click_interval_seconds for r in click_interval(df).collect()}
    expected = {user: _brute(times) for user, times in clicks.items()}
    assert counted == {user: n for user, (n, _) in expected.items() if n}
    assert gaps == {user: pytest.approx(g) for user, (n, g) in expected.items() if n}


def test_large_counts_do_not_overflow(spark):
    """Two instants a day apart with 40,000 clicks each: the squares are exact."""
    df = spark.range(80_000).selectExpr(
        "1 AS user_id",
        "CASE WHEN id % 2 = 0 THEN TIMESTAMP_NTZ '2024-01-01' ELSE TIMESTAMP_NTZ '2024-01-02' END AS event_dt_utc",
    )
    assert click_pairs(df).first().pair_count == 40_000**2
    assert click_interval(df).first().avg_click_interval_seconds == 86_400
