"""Adapter views: test tables in the shape of the inputs. One text for Spark and for the SQL check."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from propensity.session import use_utc
from propensity.sources.tables import read_table

CUTOFF = "2024-01-25 00:00:00"
EARLY_CUTOFF = "2024-01-02 06:00:00"
CUTOFFS = (EARLY_CUTOFF, "2024-01-15 00:00:00", CUTOFF)
AS_OF_DATE = "2024-02-01"

VIEWS = {
    "fx_traffic": """
        SELECT user_id, ts AS event_dt_utc,
          CASE WHEN event_id % 3 = 0 THEN 'sponsored_brands' ELSE 'sponsored_products' END AS ad_product_type,
          concat('c', event_id % 7) AS campaign_id_string,
          CASE WHEN event_id % 5 = 0 THEN NULL ELSE concat('t', event_id % 11) END AS customer_search_term,
          CASE WHEN event_type = 'view' THEN 1 ELSE 0 END AS impressions,
          CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS clicks
        FROM {events} WHERE event_type IN ('view', 'click')""",
    "fx_conversions": """
        SELECT user_id, ts AS event_dt_utc, CAST(ts AS DATE) AS event_date_utc,
          CASE WHEN event_type = 'purchase' THEN 'order' ELSE 'other' END AS event_subtype,
          1 AS conversions, CAST(value AS DECIMAL(18,2)) AS total_product_sales,
          CAST(NULLIF(event_id % 4, 3) AS INT) AS total_units_sold
        FROM {events} WHERE event_type IN ('purchase', 'signup')""",
    "fx_dsp_impressions": """
        SELECT user_id, 1 AS impressions, ts AS impression_dt_utc, event_id % 7 AS campaign_id
        FROM {events} WHERE event_type = 'view'""",
    "fx_dsp_clicks": """
        SELECT user_id, 1 AS clicks, ts AS click_dt_utc, event_id % 7 AS campaign_id
        FROM {events} WHERE event_type = 'click'""",
    "fx_train_raw": """
        SELECT l.doc_id AS user_id,
          CASE WHEN l.doc_id % 17 = 0 THEN NULL ELSE l.quality END AS target_col,
          d.n_chars AS f_chars, l.toxic AS f_toxic, 0 AS f_zero, CAST(NULL AS DOUBLE) AS f_null,
          CASE WHEN l.doc_id % 13 = 0 THEN CAST('Infinity' AS DOUBLE)
               WHEN l.doc_id % 11 = 0 THEN NULL ELSE CAST(d.n_chars AS DOUBLE) / 7 END AS f_inf,
          CASE WHEN l.doc_id % 5 = 0 THEN '  ' ELSE d.lang END AS s_blank,
          CASE WHEN l.doc_id % 17 = 0 THEN NULL ELSE l.quality END AS f_label_copy
        FROM {labels} l JOIN {documents} d ON l.doc_id = d.doc_id""",
    "fx_scored": """
        SELECT doc_id AS user_id, quality AS label,
          CAST((doc_id * 7919) % 1000 AS DOUBLE) / 1000 AS probability,
          CASE WHEN (doc_id * 7919) % 1000 >= 500 THEN 1 ELSE 0 END AS prediction
        FROM {labels}""",
}
TABLES = ("events", "labels", "documents")


def view(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """An adapter view over the tables of ``directory``."""
    text = VIEWS[name]
    used = [table for table in TABLES if f"{{{table}}}" in text]
    return use_utc(spark).sql(text, **{t: read_table(spark, directory, t) for t in used})


def with_views(body: str, *names: str) -> str:
    """SQL text: the named adapter views, then ``body`` (a SELECT, or ``, x AS (...) SELECT``)."""
    tables = {table: table for table in TABLES}
    heads = [f"{name} AS ({VIEWS[name].format(**tables)})" for name in names]
    return "WITH " + ",\n".join(heads) + "\n" + body.strip()
