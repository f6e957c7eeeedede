"""Rows at many cut-offs from slices of time, against one row computation per cut-off."""

import datetime
import random
import re

import pytest
from pyspark.sql import functions as F

from propensity.plans.snapshots import Slices
from propensity.plans.user_row import user_row, user_rows

START = datetime.datetime(2024, 1, 1)
ADS = (
    "user_id string, event_dt_utc timestamp_ntz, ad_product_type string, campaign_id_string string, "
    "customer_search_term string, impressions int, clicks int"
)
ORDERS = (
    "user_id string, event_dt_utc timestamp_ntz, event_subtype string, conversions int, "
    "total_product_sales {money}, total_units_sold int"
)


def _events(seed):
    draw = random.Random(seed)

    def instant():
        if draw.random() < 0.03:
            return None
        step = draw.choice([1, 1_000_000, 3_600_000_000, 86_400_000_000])
        return START + datetime.timedelta(microseconds=draw.randrange(0, 90 * 86_400_000_000 // step) * step)

    user = lambda: draw.choice([None, "hot", "hot", "hot", *[f"u{i}" for i in range(12)]])
    number = lambda: draw.choice([None, -1, 0, 0, 1, 1, 2])
    ads = [
        (user(), instant(), draw.choice(["sponsored_products", "sponsored_products", "sponsored_brands", "other", None]),
         draw.choice([None, "c1", "c2", "c3"]), draw.choice([None, "t"]), number(), number())
        for _ in range(600)
    ]
    ads += [("nulls", START + datetime.timedelta(days=40 + i), "sponsored_products", "c", None, None, None) for i in range(3)]
    orders = [(user(), instant(), draw.choice(["order", "order", "other"]), number(), draw.choice([None, "0.10", "7.25", "1999.99"]), number()) for _ in range(300)]
    orders += [("nulls", START + datetime.timedelta(days=41 + i), "order", None, None, None) for i in range(2)]
    return ads, orders


def _frames(spark, seed, money):
    ads, orders = _events(seed)
    frame = spark.createDataFrame(orders, ORDERS.format(money="string"))
    return spark.createDataFrame(ads, ADS).repartition(3), frame.withColumn("total_product_sales", F.col("total_product_sales").cast(money))


def _plain(rows):
    return sorted(repr(tuple(round(v, 9) if isinstance(v, float) else v for v in r)) for r in rows)


@pytest.mark.parametrize("seed, money, as_of, horizons", [(1, "decimal(18,2)", False, (30, 15, 5)), (2, "double", True, (30, 15, 5)), (3, "double", False, (20, 7, 3))])
def test_slices_give_the_rows_of_single_cutoffs(spark, seed, money, as_of, horizons):
    ads, orders = _frames(spark, seed, money)
    known = [r.event_dt_utc for r in ads.where("event_dt_utc IS NOT NULL").limit(2).collect()]
    points = [START + datetime.timedelta(days=d, microseconds=us) for d, us in ((0, 0), (30, 0), (44, 500_000), (45, 0), (46, 1), (75, 0), (200, 0))] + known
    got = user_rows(ads, orders, [str(p) for p in points], horizons, as_of)
    want = []
    for p in points:
        single = user_row(ads, orders, str(p), horizons, as_of)
        want += single.select(F.lit(p).alias("time_point"), *single.columns).collect()
    assert got.columns == ["time_point", *single.columns] and [t for _, t in got.dtypes[1:]] == [t for _, t in single.dtypes]
    assert _plain(got.collect()) == _plain(want) and len(want) > 40


def test_zoned_and_repeated_cutoffs(spark):
    ads, orders = _frames(spark, 4, "decimal(18,2)")
    zoned = [df.withColumn("event_dt_utc", F.col("event_dt_utc").cast("timestamp")) for df in (ads, orders)]
    points = ["2024-02-20 00:00:00", "2024-02-10 12:30:00", "2024-02-20"]
    once = user_rows(ads, orders, points[:2]).drop("time_point", "last_event_dt_before").collect()
    again = user_rows(*zoned, points).drop("time_point", "last_event_dt_before").collect()
    assert _plain(once) == _plain(again)
    with pytest.raises(Exception, match="(?i)time|cast"):
        user_rows(ads, orders, ["not a time"])
    assert user_rows(ads.limit(0), orders, points).collect() == []


def test_edges_are_shared(spark):
    ads, _ = _frames(spark, 5, "double")
    slices = Slices(ads, ["2024-02-01", "2024-03-02 00:00:00"], (30, 15, 5))
    assert slices.edges == sorted(set(slices.edges)) and len(slices.points) == 2
    at = {name: slices.place(e) for name, e in (("early", min(slices.points)), ("late", max(slices.points)))}
    assert 0 < at["early"] < at["late"] < len(slices.edges)


def test_events_do_not_multiply_with_cutoffs(spark, tmp_path):
    """Three scans and the same operators for 3 and for 52 cut-offs; rows multiply only after the last shuffle."""
    ads, orders = _frames(spark, 6, "decimal(18,2)")
    ads.write.parquet(f"{tmp_path}/ads")
    orders.write.parquet(f"{tmp_path}/orders")
    tables = spark.read.parquet(f"{tmp_path}/ads"), spark.read.parquet(f"{tmp_path}/orders")
    shapes = []
    for n in (3, 52):
        points = [str(START + datetime.timedelta(days=20 + i)) for i in range(n)]
        text = user_rows(*tables, points)._jdf.queryExecution().executedPlan().toString()
        operators = re.findall(r"^[\s:+\-*()\d]*([A-Z]\w+)", text, re.M)
        shapes.append(operators)
        assert operators.count("FileScan") == 3 and "Join" not in text
        # inline of the cut-offs, of what a row counts for, and of an event's entries: only the first knows the cut-offs
        assert operators.index("Generate") < operators.index("Exchange")
    assert shapes[0] == shapes[1]
