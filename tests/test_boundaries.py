"""Hand-made rows at the edges of every window, against the joined SQL and against fixed values."""

import datetime as dt

import duckdb
import pytest
from pyspark.sql import functions as F

from catalog.features import _tidy, _user_row_sql
from propensity.plans.user_row import user_row, user_rows
from tests.compare import difference

AT = "2024-01-25 00:00:00"
T = dt.datetime(2024, 1, 25)
S, D = dt.timedelta(seconds=1), dt.timedelta(days=1)
SP, SB = "sponsored_products", "sponsored_brands"


def _ad(user, ts, product, impressions, clicks, term="x", campaign="c1"):
    return (user, ts, product, campaign, term, impressions, clicks)


def _order(user, ts, subtype="order", sales=9.5, units=2):
    return (user, ts, subtype, 1, sales, units)


def _at(text):
    return dt.datetime.fromisoformat(text)


ADS = [
    _ad(9001, T, SP, 1, 1),
    *[
        _ad(9002, ts, product, 1, 1)
        for ts in (T, T - S, T - 30 * D, T - 30 * D - S, T - 30 * D + S, T + S)
        for product in (SP, SB)
    ],
    _ad(9003, _at("2023-12-16"), SP, 5, 2),
    _ad(9004, _at("2024-01-20"), SP, 0, 1),
    _ad(9004, _at("2024-01-20"), SP, 0, 1),
    _ad(9005, _at("2024-01-20 00:00:00.9"), SP, 0, 1),
    _ad(9005, _at("2024-01-20 00:00:01.1"), SP, 0, 1),
    _ad(9005, _at("2024-01-20 00:00:01.1"), SB, 0, 1),
    _ad(9005, _at("2024-01-20 00:00:01.2"), SB, 0, 1, term=None),
    _ad(9006, _at("2024-01-20"), SB, 1, 1),
    # clicks without impressions, a single click, rows without a campaign, a user without a key
    _ad(9007, T - 2 * D, SP, 0, 3),
    _ad(9008, T - 5 * D, SP, 2, 1, campaign=None),
    _ad(9008, T - 5 * D - dt.timedelta(milliseconds=1), SP, 4, 0, campaign=None),
    _ad(9008, T - 15 * D + dt.timedelta(milliseconds=1), SP, 8, 0, campaign=None),
    _ad(None, T - D, SP, 1, 1, campaign="c8"),
    _ad(None, T - 2 * D, SB, 1, 1, campaign="c9"),
    # counts that are missing
    _ad(9009, T - D, SP, None, None),
    # nothing but future events
    _ad(9010, T + D, SP, 1, 1),
]
ORDERS = [
    *[_order(9002, ts) for ts in (T, T + 30 * D, T + 30 * D - S, T - 30 * D)],
    _order(9003, _at("2023-12-01")),
    _order(9003, _at("2024-06-01")),
    _order(9007, T - D, subtype="other"),
    _order(9008, T - D, units=None),
    _order(9008, T + D, units=0),
    _order(None, T - D),
]
AD_TYPES = (
    "user_id bigint, event_dt_utc timestamp_ntz, ad_product_type string, campaign_id_string string,"
    " customer_search_term string, impressions int, clicks int"
)
ORDER_TYPES = (
    "user_id bigint, event_dt_utc timestamp_ntz, event_subtype string, conversions int,"
    " total_product_sales double, total_units_sold int"
)


@pytest.fixture(scope="module")
def tables(spark):
    return spark.createDataFrame(ADS, AD_TYPES), spark.createDataFrame(ORDERS, ORDER_TYPES)


@pytest.fixture(scope="module")
def db():
    db = duckdb.connect()
    for name, types, rows in (("fx_traffic", AD_TYPES, ADS), ("fx_conversions", ORDER_TYPES, ORDERS)):
        kinds = types.replace("timestamp_ntz", "timestamp").replace(" string", " varchar")
        db.execute(f"CREATE TABLE {name} ({kinds})")
        db.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(rows[0]))})", rows)
    return db


@pytest.fixture(scope="module")
def rows(tables):
    return {r.user_id: r for r in user_row(*tables, AT).collect()}


@pytest.mark.parametrize("at", [AT, "2024-01-20 00:00:01.150000", "2024-01-24 23:59:59"])
@pytest.mark.parametrize("as_of", [False, True])
def test_edges_match_the_joined_sql(tables, db, at, as_of):
    assert difference(_tidy(user_row(*tables, at, as_of=as_of)), db, _user_row_sql(at, as_of)) is None


def test_several_cutoffs_match_single_ones(tables, db):
    """The same cut-off named twice counts once."""
    points = [AT, "2024-01-20 00:00:01.150000"]
    sql = "\nUNION ALL\n".join(_user_row_sql(p, head=f"TIMESTAMP '{p}' AS time_point,") for p in points)
    assert difference(_tidy(user_rows(*tables, [*points, "2024-01-25"])), db, sql) is None


def test_zoned_times_and_text_keys_give_the_same(tables, db):
    ads, orders = (
        df.withColumn("event_dt_utc", F.col("event_dt_utc").cast("timestamp")).withColumn(
            "user_id", F.col("user_id").cast("string")
        )
        for df in tables
    )
    df = _tidy(user_row(ads, orders, AT)).withColumns(
        {
            "user_id": F.col("user_id").cast("bigint"),
            "last_event_dt_before": F.col("last_event_dt_before").cast("timestamp_ntz"),
        }
    )
    assert difference(df, db, _user_row_sql(AT)) is None


def test_times_as_text_are_cast(tables, db):
    ads, orders = (df.withColumn("event_dt_utc", F.col("event_dt_utc").cast("string")) for df in tables)
    df = _tidy(user_row(ads, orders, AT))
    df = df.withColumn("last_event_dt_before", F.col("last_event_dt_before").cast("timestamp_ntz"))
    assert difference(df, db, _user_row_sql(AT)) is None


def test_only_users_with_an_earlier_product_event(rows):
    assert set(rows) == {9002, 9003, 9004, 9005, 9007, 9008, 9009, None}


def test_window_edges(rows):
    r = rows[9002]
    assert r.total_impressions_30d == 2
    assert (r.last_30days_sp_impressions, r.last_30days_sb_impressions) == (3, 3)
    assert (r.total_conversions_after_30d, r.total_revenue_after_30d, r.total_quantity_after_30d) == (1, 9.5, 2)
    assert r.total_conversions_before_30d == 0
    assert r.search_term_count == 12
    assert r.avg_click_interval_seconds == pytest.approx(1555200.2)
    assert (r.impression_day_count, r.last_impression_time_diff_seconds) == (4, 0)


def test_old_activity_is_zero_not_missing(rows):
    r = rows[9003]
    assert (r.total_impressions_30d, r.last_30days_sp_impressions, r.sp_ctr_30d, r.sb_ctr_30d) == (0, 0, 0, 0)
    assert r.last_30days_sb_impressions is None
    assert (r.total_conversions_after_30d, r.total_conversions_before_30d) == (0, 0)
    assert r.avg_click_interval_seconds is None
    assert r.last_impression_time_diff_seconds == 3456000


def test_clicks_at_one_instant_make_no_pair(rows):
    r = rows[9004]
    assert r.total_clicks_30d == 2 and r.avg_click_interval_seconds is None
    assert r.total_conversions_before_30d is None and r.total_conversions_after_30d is None
    assert r.last_impression_time_diff_seconds is None and r.last_click_time_diff_seconds == 432000


def test_gaps_are_in_whole_seconds(rows):
    r = rows[9005]
    assert r.search_term_count == 3
    assert (r.last_30days_sb_impressions, r.last_30days_sb_clicks) == (0, 2)
    assert r.avg_click_interval_seconds == pytest.approx(0.6)
    assert r.last_click_time_diff_seconds == 431999


def test_a_missing_key_meets_nothing(rows):
    r = rows[None]
    assert r.search_campaign_cnt == 1 and r.total_impressions_30d == 1
    assert r.search_term_count is None and r.total_conversions_before_30d is None
    assert r.sp_ctr_30d == 0


def test_missing_columns_are_named(tables):
    ads, orders = tables
    with pytest.raises(ValueError, match="clicks"):
        user_row(ads.drop("clicks"), orders, AT)


def test_other_horizons(tables):
    row = user_row(*tables, AT, horizons=(30, 15, 3)).where("user_id = 9008").first()
    assert (row.total_impressions_3d, row.total_impressions_15d, row.total_impressions_30d) == (0, 6, 14)


def test_times_without_a_zone_need_utc(spark, tables):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        for rows in (lambda: user_row(*tables, AT), lambda: user_rows(*tables, [AT])):
            with pytest.raises(ValueError, match="UTC"):
                rows()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
