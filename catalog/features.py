"""Feature queries: scans, filters, per-user blocks, the full feature row and the RFM row."""

from __future__ import annotations

import datetime
import math

from pyspark.sql import DataFrame, functions as F

from catalog.inputs import AS_OF_DATE, CUTOFF, CUTOFFS, EARLY_CUTOFF, view, with_views
from catalog.registry import registry, rounded as _rounded
from propensity.functions.scalars import click_through_rate, days_between
from propensity.operators import clicks as click_ops
from propensity.operators import conversions as orders_ops
from propensity.operators import traffic as ads
from propensity.operators.cutoffs import cutoff
from propensity.plans import rfm
from propensity.plans.user_row import in_sample, user_row, user_rows
from propensity.session import scratch_path, use_utc
from propensity.sources.stored import read_events, write_events
from propensity.sources.tables import read_table, time_range, user_pull

QUERIES, ORACLES, query = registry()


# ---------------------------------------------------------------- scans


@query(with_views(
    """SELECT user_id, event_dt_utc, ad_product_type, campaign_id_string, customer_search_term,
              impressions, clicks FROM fx_traffic""", "fx_traffic"))
def src_traffic(spark, directory):
    return view(spark, directory, "fx_traffic")


@query(with_views(
    """SELECT user_id, event_dt_utc, event_date_utc, event_subtype, conversions,
              CAST(total_product_sales AS DOUBLE) AS total_product_sales, total_units_sold
       FROM fx_conversions""", "fx_conversions"))
def src_conversions(spark, directory):
    df = view(spark, directory, "fx_conversions")
    return df.withColumn("total_product_sales", F.col("total_product_sales").cast("double"))


@query(with_views(
    """SELECT user_id FROM fx_conversions
       WHERE event_dt_utc >= TIMESTAMP '2024-01-20' AND event_dt_utc < TIMESTAMP '2024-01-22'
       ORDER BY user_id LIMIT 3000""", "fx_conversions"))
def src_time_range_users(spark, directory):
    df = view(spark, directory, "fx_conversions")
    return user_pull(df, "event_dt_utc", "2024-01-20 00:00:00", "2024-01-22 00:00:00", 3000)


@query(with_views(
    """SELECT user_id FROM fx_conversions
       WHERE event_dt_utc >= TIMESTAMP '2024-01-20' AND event_dt_utc < TIMESTAMP '2024-01-22'
       ORDER BY user_id LIMIT 100""", "fx_conversions"))
def src_time_range_limited(spark, directory):
    """Fewer rows than the range has."""
    df = view(spark, directory, "fx_conversions")
    return user_pull(df, "event_dt_utc", "2024-01-20 00:00:00", "2024-01-22 00:00:00", 100)


@query(with_views(
    """SELECT user_id, event_dt_utc, impressions, clicks FROM fx_traffic
       WHERE ad_product_type = 'sponsored_products'""", "fx_traffic"))
def flt_product_type(spark, directory):
    df = view(spark, directory, "fx_traffic").where(ads.of_type(ads.PRODUCTS))
    return df.select("user_id", "event_dt_utc", "impressions", "clicks")


@query(with_views(
    f"""SELECT user_id,
          count(*) FILTER (event_dt_utc < TIMESTAMP '{CUTOFF}') AS n_before,
          count(*) FILTER (event_dt_utc > TIMESTAMP '{CUTOFF}') AS n_after,
          count(*) FILTER (event_dt_utc <= TIMESTAMP '{CUTOFF}') AS n_up_to
        FROM fx_traffic GROUP BY user_id""", "fx_traffic"))
def flt_cutoff(spark, directory):
    df = view(spark, directory, "fx_traffic")
    cut = cutoff(df, CUTOFF)
    return df.groupBy("user_id").agg(
        F.count_if(cut.before).alias("n_before"),
        F.count_if(cut.after).alias("n_after"),
        F.count_if(cut.up_to).alias("n_up_to"),
    )


@query(with_views(
    """SELECT user_id, impressions, 0 AS clicks, impression_dt_utc, campaign_id FROM fx_dsp_impressions
       UNION ALL
       SELECT user_id, 0, clicks, click_dt_utc, campaign_id FROM fx_dsp_clicks""",
    "fx_dsp_impressions", "fx_dsp_clicks"))
def union_engagement(spark, directory):
    return rfm.engagement_events(
        view(spark, directory, "fx_dsp_impressions"), view(spark, directory, "fx_dsp_clicks")
    )


# ---------------------------------------------------------------- traffic blocks


def _age(at: str) -> str:
    return f"date_diff('second', event_dt_utc, TIMESTAMP '{at}')"


def _sum_in(value: str, inside: str) -> str:
    """Zero outside the window; NULL only where every value inside is."""
    return f"sum(CASE WHEN {inside} THEN {value} ELSE 0 END)"


def _windowed(value: str, at: str, days: int, op: str, name: str) -> str:
    inside = f"{_age(at)} {op} {days * 86400}"
    return f"CAST({_sum_in(value, inside)} AS BIGINT) AS {name}"


def _traffic_summary_sql(at: str) -> str:
    windows = ",\n".join(
        _windowed(value, at, days, "<", f"total_{value}_{days}d")
        for days in (30, 15, 5)
        for value in ("impressions", "clicks")
    )
    return f"""SELECT user_id, count(DISTINCT campaign_id_string) AS search_campaign_cnt,
      {windows}, max(event_dt_utc) AS last_event_dt_before
      FROM fx_traffic
      WHERE ad_product_type = 'sponsored_products' AND event_dt_utc < TIMESTAMP '{at}'
      GROUP BY user_id"""


def _target_sql(at: str) -> str:
    inside = f"date_diff('second', TIMESTAMP '{at}', event_dt_utc) < 2592000"
    return f"""SELECT user_id,
      CAST({_sum_in('conversions', inside)} AS BIGINT) AS total_conversions_after_30d,
      CAST({_sum_in('total_product_sales', inside)} AS DOUBLE) AS total_revenue_after_30d,
      CAST({_sum_in('total_units_sold', inside)} AS BIGINT) AS total_quantity_after_30d
      FROM fx_conversions
      WHERE event_subtype = 'order' AND event_dt_utc > TIMESTAMP '{at}'
      GROUP BY user_id"""


def _history_sql(at: str) -> str:
    parts = []
    for days in (30, 15, 5):
        inside = f"{_age(at)} < {days * 86400}"
        parts += [
            f"CAST({_sum_in('conversions', inside)} AS BIGINT) AS total_conversions_before_{days}d",
            f"CAST({_sum_in('total_product_sales', inside)} AS DOUBLE) AS total_revenue_before_{days}d",
            f"CAST({_sum_in('total_units_sold', inside)} AS BIGINT) AS total_quantity_before_{days}d",
        ]
    columns = ",\n".join(parts)
    return f"""SELECT user_id, {columns} FROM fx_conversions
      WHERE event_subtype = 'order' AND event_dt_utc < TIMESTAMP '{at}' GROUP BY user_id"""


def _terms_sql(at: str | None = None) -> str:
    rows = f"WHERE event_dt_utc <= TIMESTAMP '{at}'" if at else ""
    return f"""SELECT user_id, count(customer_search_term) AS search_term_count
      FROM fx_traffic {rows} GROUP BY user_id"""


def _product_sql(at: str, product: str, tag: str) -> str:
    columns = ",\n".join(
        f"CAST(coalesce(sum({value}) FILTER ({_age(at)} <= 2592000 AND {value} > 0), 0) AS BIGINT)"
        f" AS last_30days_{tag}_{value}"
        for value in ("impressions", "clicks")
    )
    return f"""SELECT user_id, {columns} FROM fx_traffic
      WHERE ad_product_type = '{product}' AND event_dt_utc < TIMESTAMP '{at}' GROUP BY user_id"""


def _gap_sql(at: str) -> str:
    """The pairs written out: a self-join, independent of the closed form it checks."""
    return f"""SELECT later.user_id,
      avg(date_diff('second', earlier.event_dt_utc, later.event_dt_utc)) AS avg_click_interval_seconds
      FROM fx_traffic later JOIN fx_traffic earlier
        ON earlier.user_id = later.user_id AND earlier.event_dt_utc < later.event_dt_utc
      WHERE later.clicks > 0 AND earlier.clicks > 0 AND later.event_dt_utc <= TIMESTAMP '{at}'
      GROUP BY later.user_id"""


def _days_sql(at: str) -> str:
    return f"""SELECT user_id,
      count(DISTINCT CAST(event_dt_utc AS DATE)) FILTER (impressions > 0) AS impression_day_count,
      count(DISTINCT CAST(event_dt_utc AS DATE)) FILTER (clicks > 0) AS click_day_count
      FROM fx_traffic WHERE event_dt_utc <= TIMESTAMP '{at}' GROUP BY user_id"""


def _last_sql(at: str, event: str) -> str:
    return f"""SELECT user_id, max(event_dt_utc) AS last_{event}_dt FROM fx_traffic
      WHERE {event}s > 0 AND event_dt_utc <= TIMESTAMP '{at}' GROUP BY user_id"""


def _ctr_sql(tag: str) -> str:
    part = f"{tag}.last_30days_{tag}"
    return f"""CASE WHEN {part}_impressions > 0
      THEN CAST({part}_clicks AS DOUBLE) / {part}_impressions ELSE 0 END"""


def _user_row_sql(at: str, as_of: bool = False, traffic_rows: str = "", head: str = "") -> str:
    """Every block as its own table, left-joined to the driving one."""
    windows = ", ".join(
        f"k.total_{value}_{days}d" for days in (30, 15, 5) for value in ("impressions", "clicks")
    )
    history = ", ".join(
        f"c.total_{value}_before_{days}d"
        for days in (30, 15, 5)
        for value in ("conversions", "revenue", "quantity")
    )
    return f"""SELECT {head} k.user_id, k.search_campaign_cnt, {windows},
      t.total_conversions_after_30d, t.total_revenue_after_30d, t.total_quantity_after_30d,
      {history}, k.last_event_dt_before, s.search_term_count,
      sp.last_30days_sp_impressions, sp.last_30days_sp_clicks, round({_ctr_sql('sp')}, 9) AS sp_ctr_30d,
      sb.last_30days_sb_impressions, sb.last_30days_sb_clicks, round({_ctr_sql('sb')}, 9) AS sb_ctr_30d,
      round(g.avg_click_interval_seconds, 6) AS avg_click_interval_seconds,
      d.impression_day_count, d.click_day_count,
      date_diff('second', li.last_impression_dt, TIMESTAMP '{at}') AS last_impression_time_diff_seconds,
      date_diff('second', lc.last_click_dt, TIMESTAMP '{at}') AS last_click_time_diff_seconds
    FROM ({_traffic_summary_sql(at)}) k
    LEFT JOIN ({_target_sql(at)}) t ON t.user_id = k.user_id
    LEFT JOIN ({_history_sql(at)}) c ON c.user_id = k.user_id
    LEFT JOIN ({_terms_sql(at if as_of else None)}) s ON s.user_id = k.user_id
    LEFT JOIN ({_product_sql(at, 'sponsored_products', 'sp')}) sp ON sp.user_id = k.user_id
    LEFT JOIN ({_product_sql(at, 'sponsored_brands', 'sb')}) sb ON sb.user_id = k.user_id
    LEFT JOIN ({_gap_sql(at)}) g ON g.user_id = k.user_id
    LEFT JOIN ({_days_sql(at)}) d ON d.user_id = k.user_id
    LEFT JOIN ({_last_sql(at, 'impression')}) li ON li.user_id = k.user_id
    LEFT JOIN ({_last_sql(at, 'click')}) lc ON lc.user_id = k.user_id
    {traffic_rows}"""


def _traffic(sql: str) -> str:
    return with_views(sql, "fx_traffic")


def _block(spark, directory, rows, columns):
    """One traffic block on its own rows; ``rows`` and ``columns`` are functions of the cut-off."""
    df = view(spark, directory, "fx_traffic")
    cut = cutoff(df, CUTOFF)
    return df.where(rows(cut)).groupBy("user_id").agg(*columns(cut))


@query(_traffic(_traffic_summary_sql(CUTOFF)))
def feat_traffic_summary(spark, directory):
    return _block(
        spark, directory, lambda cut: ads.of_type(ads.PRODUCTS) & cut.before, ads.traffic_summary
    )


@query(with_views(_target_sql(CUTOFF), "fx_conversions"))
def feat_conversion_target(spark, directory):
    df = view(spark, directory, "fx_conversions")
    cut = cutoff(df, CUTOFF)
    return df.where(orders_ops.is_order() & cut.after).groupBy("user_id").agg(
        *orders_ops.conversion_target(cut)
    )


@query(with_views(_history_sql(CUTOFF), "fx_conversions"))
def feat_conversion_history(spark, directory):
    df = view(spark, directory, "fx_conversions")
    cut = cutoff(df, CUTOFF)
    return df.where(orders_ops.is_order() & cut.before).groupBy("user_id").agg(
        *orders_ops.conversion_history(cut)
    )


@query(_traffic(_terms_sql()))
def feat_search_terms(spark, directory):
    return view(spark, directory, "fx_traffic").groupBy("user_id").agg(*ads.search_terms())


@query(_traffic(_terms_sql(CUTOFF)))
def feat_search_terms_as_of(spark, directory):
    return _block(spark, directory, lambda cut: cut.up_to, lambda cut: ads.search_terms())


@query(_traffic(_product_sql(CUTOFF, "sponsored_products", "sp")))
def feat_sp_30d(spark, directory):
    return _block(
        spark,
        directory,
        lambda cut: ads.of_type(ads.PRODUCTS) & cut.before,
        lambda cut: ads.product_totals(cut, "sp"),
    )


@query(_traffic(_product_sql(CUTOFF, "sponsored_brands", "sb")))
def feat_sb_30d(spark, directory):
    return _block(
        spark,
        directory,
        lambda cut: ads.of_type(ads.BRANDS) & cut.before,
        lambda cut: ads.product_totals(cut, "sb"),
    )


@query(_traffic(
    f"""SELECT sp.user_id, round({_ctr_sql('sp')}, 9) AS sp_ctr_30d, round({_ctr_sql('sb')}, 9) AS sb_ctr_30d
        FROM ({_product_sql(CUTOFF, 'sponsored_products', 'sp')}) sp
        LEFT JOIN ({_product_sql(CUTOFF, 'sponsored_brands', 'sb')}) sb ON sb.user_id = sp.user_id"""))
def feat_ctr_30d(spark, directory):
    df = view(spark, directory, "fx_traffic")
    cut = cutoff(df, CUTOFF)
    products = ads.of_type(ads.PRODUCTS) & cut.before
    brands = ads.of_type(ads.BRANDS) & cut.before
    totals = df.where(cut.before).groupBy("user_id").agg(
        F.count_if(products).alias("n"),
        *ads.product_totals(cut, "sp", products),
        *ads.product_totals(cut, "sb", brands),
    )
    rates = [
        F.round(
            click_through_rate(
                F.col(f"last_30days_{tag}_clicks"), F.col(f"last_30days_{tag}_impressions")
            ),
            9,
        ).alias(f"{tag}_ctr_30d")
        for tag in ("sp", "sb")
    ]
    return totals.where("n > 0").select("user_id", *rates)


@query(_traffic(
    f"""SELECT user_id, round(avg_click_interval_seconds, 6) AS avg_click_interval_seconds
        FROM ({_gap_sql(CUTOFF)})"""))
def feat_click_interval(spark, directory):
    df = view(spark, directory, "fx_traffic")
    clicked = df.where((F.col("clicks") > 0) & cutoff(df, CUTOFF).up_to)
    return _rounded(click_ops.click_interval(clicked), 6, "avg_click_interval_seconds")


@query(_traffic(
    """SELECT later.user_id, count(*) AS pair_count
       FROM fx_traffic later JOIN fx_traffic earlier
         ON earlier.user_id = later.user_id AND earlier.event_dt_utc < later.event_dt_utc
       WHERE later.clicks > 0 AND earlier.clicks > 0 GROUP BY later.user_id"""))
def join_click_pairs(spark, directory):
    df = view(spark, directory, "fx_traffic")
    return click_ops.click_pairs(df.where(F.col("clicks") > 0))


@query(_traffic(_days_sql(CUTOFF)))
def feat_ad_days(spark, directory):
    events = view(spark, directory, "fx_traffic")
    cut = cutoff(events, CUTOFF)
    return ads.ad_days(events.where(cut.up_to), cut.ts)


@query(_traffic(_last_sql(CUTOFF, "impression")))
def feat_last_impression(spark, directory):
    return _block(
        spark, directory, lambda cut: (F.col("impressions") > 0) & cut.up_to, ads.last_impression
    )


@query(_traffic(_last_sql(CUTOFF, "click")))
def feat_last_click(spark, directory):
    return _block(spark, directory, lambda cut: (F.col("clicks") > 0) & cut.up_to, ads.last_click)


# ---------------------------------------------------------------- the full row


def _row(spark, directory, at, **options):
    df = user_row(
        view(spark, directory, "fx_traffic"), view(spark, directory, "fx_conversions"), at, **options
    )
    return _tidy(df)


def _tidy(df):
    df = _rounded(df, 9, "sp_ctr_30d", "sb_ctr_30d")
    return _rounded(df, 6, "avg_click_interval_seconds")


def _both(sql: str) -> str:
    return with_views(sql, "fx_traffic", "fx_conversions")


@query(_both(_user_row_sql(CUTOFF)))
def feat_user_row(spark, directory):
    return _row(spark, directory, CUTOFF)


@query(_both(_user_row_sql(EARLY_CUTOFF)))
def feat_user_row_early(spark, directory):
    return _row(spark, directory, EARLY_CUTOFF)


@query(_both(_user_row_sql(CUTOFF, as_of=True)))
def feat_user_row_as_of(spark, directory):
    return _row(spark, directory, CUTOFF, as_of=True)


@query(_both("\nUNION ALL\n".join(
    _user_row_sql(at, head=f"TIMESTAMP '{at}' AS time_point,") for at in CUTOFFS)))
def feat_multi_cutoff(spark, directory):
    return _tidy(
        user_rows(
            view(spark, directory, "fx_traffic"), view(spark, directory, "fx_conversions"), CUTOFFS
        )
    )


def _stored(spark, directory, name: str):
    """An adapter view as a stored table of 8 buckets; its name."""
    path = scratch_path(spark, name)
    table = path.rsplit("/", 1)[1].replace("-", "_")
    write_events(view(spark, directory, name), table, path, buckets=8)
    return table


@query(with_views(
    f"""SELECT user_id, event_dt_utc, ad_product_type, campaign_id_string, customer_search_term, impressions, clicks
        FROM fx_traffic WHERE event_dt_utc <= TIMESTAMP '{CUTOFF}'""", "fx_traffic"))
def src_traffic_stored(spark, directory):
    """Traffic stored by day and user, read up to a time."""
    return read_events(spark, _stored(spark, directory, "fx_traffic"), CUTOFF)


@query(_both(_user_row_sql(CUTOFF)))
def feat_user_row_stored(spark, directory):
    """The feature row from stored tables, without a shuffle."""
    tables = [read_events(spark, _stored(spark, directory, name)) for name in ("fx_traffic", "fx_conversions")]
    return _tidy(user_row(*tables, CUTOFF))


# A cut-off every 14 hours: more edges than most users have events between them.
_EVERY_14_HOURS = [str(datetime.datetime(2024, 1, 1, 6) + datetime.timedelta(hours=14 * i)) for i in range(52)]


@query(_both("\nUNION ALL\n".join(
    _user_row_sql(at, head=f"TIMESTAMP '{at}' AS time_point,") for at in _EVERY_14_HOURS)))
def feat_multi_cutoff_52(spark, directory):
    """As many snapshots as a year has weeks, from the same reads as one."""
    return _tidy(
        user_rows(view(spark, directory, "fx_traffic"), view(spark, directory, "fx_conversions"), _EVERY_14_HOURS)
    )


def _share_sql(user: str, share: str, seed: int = 42) -> str:
    hashed = f"CAST('0x' || substr(md5(concat({user}, '-', {seed})), 1, 15) AS BIGINT)"
    return f"{hashed} < CAST(ceil(CAST({share} AS DECIMAL(18, 9)) * 1152921504606846976) AS HUGEINT)"


@query(_both(_user_row_sql(CUTOFF, traffic_rows=f"WHERE {_share_sql('k.user_id', '0.2')}")))
def sample_hash(spark, directory):
    """A reproducible share of users, cut before the shuffle; 20 % so that small data keeps rows."""
    return _row(spark, directory, CUTOFF, sample_percent=20)


@query()
def sample_random(spark, directory):
    """The unseeded 1 % row sample after the joins, here with a seed."""
    return _row(spark, directory, CUTOFF).sample(fraction=0.01, seed=42)


@query("""WITH n AS (SELECT count(*) AS n_rows FROM lineitem)
   SELECT fraction, n_rows, TRUE AS is_subset, TRUE AS repeats, TRUE AS other_seed_differs, TRUE AS within_bounds
   FROM n, (VALUES (0.01), (0.3)) AS shares(fraction)""")
def sample_random_facts(spark, directory):
    """Row samples of a larger table: rows of it, the same for a seed, others for another, in number within six deviations."""
    rows = read_table(spark, directory, "lineitem").select(F.monotonically_increasing_id().alias("row"), "l_orderkey")
    n, facts = rows.count(), []
    for share in (0.01, 0.3):
        once, again, other = (rows.sample(fraction=share, seed=seed) for seed in (42, 42, 43))
        size = once.count()
        subset = once.join(rows, ["row", "l_orderkey"], "left_anti").isEmpty() and once.select("row").distinct().count() == size
        repeats = once.join(again, "row").count() == size == again.count()
        differs = once.join(other, "row").count() < size
        bounds = abs(size - n * share) <= 6 * math.sqrt(n * share * (1 - share))
        facts.append((share, n, subset, repeats, differs, bounds))
    kind = "fraction double, n_rows long, is_subset boolean, repeats boolean, other_seed_differs boolean, within_bounds boolean"
    return spark.createDataFrame(facts, kind)


@query(with_views(
    f"""SELECT user_id FROM fx_traffic WHERE {_share_sql('user_id', '0.01')} GROUP BY user_id""",
    "fx_traffic"))
def sample_users(spark, directory):
    df = view(spark, directory, "fx_traffic")
    return df.select("user_id").where(in_sample(F.col("user_id"), 1)).distinct()


@query(with_views(
    """SELECT b.user_id, b.n_orders, e.n_views FROM
         (SELECT user_id, count(*) AS n_orders FROM fx_conversions
          WHERE event_subtype = 'order' GROUP BY user_id) b
       LEFT JOIN (SELECT user_id, count(*) AS n_views FROM fx_dsp_impressions GROUP BY user_id) e
         ON e.user_id = b.user_id""", "fx_conversions", "fx_dsp_impressions"))
def join_left_user(spark, directory):
    buyers = view(spark, directory, "fx_conversions").where(orders_ops.is_order())
    viewers = view(spark, directory, "fx_dsp_impressions")
    return (
        buyers.groupBy("user_id").agg(F.count("*").alias("n_orders"))
        .join(viewers.groupBy("user_id").agg(F.count("*").alias("n_views")), "user_id", "left")
    )


@query(with_views(
    f"""SELECT user_id, impressions, clicks, event_dt_utc FROM fx_traffic
        WHERE event_dt_utc >= TIMESTAMP '2024-01-10' AND event_dt_utc < TIMESTAMP '{CUTOFF}'""",
    "fx_traffic"))
def src_time_range(spark, directory):
    df = view(spark, directory, "fx_traffic")
    df = time_range(df, "event_dt_utc", "2024-01-10 00:00:00", CUTOFF)
    return df.select("user_id", "impressions", "clicks", "event_dt_utc")


# ---------------------------------------------------------------- recency, frequency, value

_PURCHASES = """SELECT user_id, max(event_date_utc) AS last_purchase_date, count(user_id) AS total_purchases,
   CAST(sum(total_product_sales) AS DOUBLE) AS total_sales_value,
   avg(CAST(total_product_sales AS DOUBLE) / nullif(total_units_sold, 0)) AS avg_order_value
   FROM fx_conversions WHERE event_subtype = 'order' GROUP BY user_id"""
_ENGAGEMENT = """SELECT user_id, CAST(sum(impressions) AS BIGINT) AS total_impressions,
   CAST(sum(clicks) AS BIGINT) AS total_clicks, count(DISTINCT event_time) AS active_days,
   count(DISTINCT campaign_id) AS distinct_campaigns
   FROM (SELECT user_id, impressions, 0 AS clicks, impression_dt_utc AS event_time, campaign_id FROM fx_dsp_impressions
         UNION ALL SELECT user_id, 0, clicks, click_dt_utc, campaign_id FROM fx_dsp_clicks)
   GROUP BY user_id"""


@query(with_views(
    f"""SELECT user_id, last_purchase_date, total_purchases, total_sales_value,
          round(avg_order_value, 6) AS avg_order_value FROM ({_PURCHASES})""", "fx_conversions"))
def feat_purchase_summary(spark, directory):
    df = rfm.purchase_summary(view(spark, directory, "fx_conversions"))
    return _rounded(df, 6, "avg_order_value")


@query(with_views(_ENGAGEMENT, "fx_dsp_impressions", "fx_dsp_clicks"))
def feat_engagement_summary(spark, directory):
    return rfm.engagement_summary(
        view(spark, directory, "fx_dsp_impressions"), view(spark, directory, "fx_dsp_clicks")
    )


@query(with_views(
    f"""SELECT p.user_id,
          date_diff('second', CAST(p.last_purchase_date AS TIMESTAMP), TIMESTAMP '{AS_OF_DATE}') AS recency,
          p.total_purchases AS frequency, p.total_sales_value AS monetary,
          round(p.avg_order_value, 6) AS avg_order_value, e.total_impressions, e.total_clicks,
          round(e.total_clicks * 1.0 / nullif(e.total_impressions, 0), 6) AS click_through_rate,
          e.active_days, e.distinct_campaigns
        FROM ({_PURCHASES}) p LEFT JOIN ({_ENGAGEMENT}) e ON e.user_id = p.user_id""",
    "fx_conversions", "fx_dsp_impressions", "fx_dsp_clicks"))
def feat_rfm(spark, directory):
    df = rfm.rfm_row(
        view(spark, directory, "fx_conversions"),
        view(spark, directory, "fx_dsp_impressions"),
        view(spark, directory, "fx_dsp_clicks"),
        AS_OF_DATE,
    )
    return _rounded(df, 6, "avg_order_value", "click_through_rate")


_LAST = """SELECT a.user_id, a.last_event, o.last_order FROM
   (SELECT user_id, max(event_dt_utc) AS last_event FROM fx_traffic GROUP BY user_id) a
   LEFT JOIN (SELECT user_id, max(event_dt_utc) AS last_order FROM fx_conversions
              WHERE event_subtype = 'order' GROUP BY user_id) o ON o.user_id = a.user_id"""


@query(with_views(
    f"""SELECT user_id, CAST(floor((epoch_us(last_event) - epoch_us(last_order)) / 86400000000.0) AS BIGINT)
          AS time_diff_days FROM ({_LAST})""", "fx_traffic", "fx_conversions"))
def feat_time_diff_days(spark, directory):
    """Whole days from the last order to the last ad event, rounded down (may be negative)."""
    seen = view(spark, directory, "fx_traffic").groupBy("user_id").agg(
        F.max("event_dt_utc").alias("last_event")
    )
    bought = view(spark, directory, "fx_conversions").where(orders_ops.is_order()).groupBy(
        "user_id"
    ).agg(F.max("event_dt_utc").alias("last_order"))
    return seen.join(bought, "user_id", "left").select(
        "user_id", days_between(F.col("last_order"), F.col("last_event")).alias("time_diff_days")
    )


_EXACT = """SELECT user_id, CAST(ts AS DATE) AS event_date_utc, 'order' AS event_subtype,
   value / 1000 AS total_product_sales, 1 AS total_units_sold FROM {events} WHERE event_type = 'purchase'"""


@query(f"""SELECT user_id, round(sum(total_product_sales), 6) AS revenue, sum(total_product_sales) > 0 AS paid
   FROM ({_EXACT.format(events='events')}) GROUP BY user_id""")
def feat_revenue_exact(spark, directory):
    """Amounts below a cent are not cut before they are summed."""
    orders = use_utc(spark).sql(_EXACT, events=read_table(spark, directory, "events"))
    rows = rfm.purchase_summary(orders)
    return rows.select("user_id", F.round("total_sales_value", 6).alias("revenue"), (F.col("total_sales_value") > 0).alias("paid"))
