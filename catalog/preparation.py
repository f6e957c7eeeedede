"""Cleaning, splitting, balancing, encoding, and the CSV source and sink."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.inputs import CUTOFFS, view, with_views
from catalog.quality import NUMERIC, TRAIN_TYPES
from catalog.registry import registry, rounded
from propensity.functions import scalars
from propensity.operators import balance, cleaning, encoding, model as models
from propensity.plans.user_row import user_rows
from propensity.session import scratch_path, use_utc
from propensity.sources.csv_files import read_csv_directory, write_predictions
from propensity.sources.tables import read_table

QUERIES, ORACLES, query = registry()


def _raw(spark, directory):
    return view(spark, directory, "fx_train_raw")


def _train(sql: str) -> str:
    return with_views(sql, "fx_train_raw")


# ---------------------------------------------------------------- columns


@query(_train("SELECT target_col, f_chars, f_toxic, f_zero, f_null, f_inf, f_label_copy FROM fx_train_raw"))
def prep_drop_cols(spark, directory):
    return cleaning.drop_columns(_raw(spark, directory), ["user_id", "s_blank", "not_there"])


@query(_train("\nUNION ALL\n".join(
    f"""SELECT '{c}' AS column_name, count({c}) FILTER (WHERE {c} {'IS NOT NULL' if kind == 'string' else '<> 0'}) = 0
        AS is_empty FROM fx_train_raw""" for c, kind in TRAIN_TYPES.items())))
def prep_drop_empty(spark, directory):
    return cleaning.empty_report(_raw(spark, directory))


@query(_train("SELECT user_id, CASE WHEN isfinite(f_inf) THEN f_inf END AS f_inf, f_null FROM fx_train_raw"))
def prep_inf_null(spark, directory):
    return cleaning.infinities_to_null(_raw(spark, directory)).select("user_id", "f_inf", "f_null")


@query(_train("SELECT user_id, CASE WHEN trim(s_blank) <> '' THEN s_blank END AS s_blank FROM fx_train_raw"))
def prep_blank_null(spark, directory):
    return cleaning.blanks_to_null(_raw(spark, directory)).select("user_id", "s_blank")


@query(_train("SELECT " + ", ".join(f"coalesce({c}, 0) AS {c}" for c in NUMERIC) + " FROM fx_train_raw"))
def prep_fill_zero(spark, directory):
    return cleaning.fill_zero(_raw(spark, directory)).select(*NUMERIC)


@query(_train("SELECT " + ", ".join(NUMERIC) + " FROM fx_train_raw"))
def prep_numeric(spark, directory):
    df = _raw(spark, directory)
    return df.select(*cleaning.numeric_columns(df))


@query(_train("SELECT user_id, CAST(coalesce(target_col, 0) AS INT) AS label FROM fx_train_raw"))
def label_target(spark, directory):
    return _raw(spark, directory).select("user_id", cleaning.target(F.col("target_col")).alias("label"))


@query(with_views(
    """SELECT user_id, CASE WHEN coalesce(n, 0) > 0 OR coalesce(revenue, 0) > 0 THEN 1 ELSE 0 END AS high_potential
       FROM (SELECT t.user_id, c.n, c.revenue FROM (SELECT DISTINCT user_id FROM fx_traffic) t
             LEFT JOIN (SELECT user_id, sum(conversions) AS n, CAST(sum(total_product_sales) AS DOUBLE) AS revenue
                        FROM fx_conversions WHERE event_subtype = 'order'
                          AND event_dt_utc > TIMESTAMP '2024-01-28' GROUP BY user_id) c
               ON c.user_id = t.user_id)""", "fx_traffic", "fx_conversions"))
def label_high_potential(spark, directory):
    users = view(spark, directory, "fx_traffic").select("user_id").distinct()
    orders = view(spark, directory, "fx_conversions").where(
        (F.col("event_subtype") == "order")
        & (F.col("event_dt_utc") > F.lit("2024-01-28 00:00:00").cast("timestamp_ntz"))
    )
    bought = orders.groupBy("user_id").agg(
        F.sum("conversions").alias("n"), scalars.money_sum(F.col("total_product_sales")).alias("revenue")
    )
    label = cleaning.high_potential(F.col("n"), F.col("revenue")).alias("high_potential")
    return users.join(bought, "user_id", "left").select("user_id", label)


_CLEAN = """, fx_clean AS (SELECT user_id, CAST(coalesce(target_col, 0) AS INT) AS target_col,
   coalesce(f_chars, 0) AS f_chars, coalesce(f_toxic, 0) AS f_toxic,
   CASE WHEN isfinite(f_inf) THEN f_inf ELSE 0 END AS f_inf, coalesce(f_label_copy, 0) AS f_label_copy
   FROM fx_train_raw)
"""


def _clean(spark, directory):
    return cleaning.clean(_raw(spark, directory), "target_col")


@query(_train(_CLEAN + """SELECT user_id, target_col, f_chars, f_toxic, coalesce(f_inf, 0) AS f_inf, f_label_copy
   FROM fx_clean"""))
def prep_clean(spark, directory):
    return _clean(spark, directory)


@query("""SELECT event_id, TRY_CAST(CASE WHEN event_id % 7 = 0 THEN concat('n/a ', event_id)
            ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS TIMESTAMP) AS parsed FROM events""")
def prep_try_timestamp(spark, directory):
    events = read_table(use_utc(spark), directory, "events")
    text = F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("n/a "), F.col("event_id"))).otherwise(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    )
    return events.select("event_id", cleaning.parse_timestamp(text).cast("timestamp_ntz").alias("parsed"))


@query(with_views(
    """SELECT user_id, date_diff('second', TIMESTAMP '2024-01-25', event_dt_utc) AS lead_seconds,
         CAST(event_dt_utc AS DATE) AS day,
         CAST(floor((epoch_us(event_dt_utc) - epoch_us(TIMESTAMP '2024-01-25')) / 86400000000.0) AS BIGINT) AS lead_days,
         round(clicks * 1.0 / nullif(impressions, 0), 9) AS rate,
         CASE WHEN impressions > 0 THEN CAST(clicks AS DOUBLE) / impressions ELSE 0 END AS ctr,
         coalesce(customer_search_term, campaign_id_string) AS term,
         CASE WHEN regexp_matches(coalesce(customer_search_term, ' '), '^\\s*$') THEN NULL
              ELSE customer_search_term END AS known_term,
         regexp_extract(campaign_id_string, 'c([0-9]+)', 1) AS campaign_number,
         impressions BETWEEN 1 AND 5 AND clicks = 0 OR clicks > 3 AS in_range,
         abs(impressions - 3) AS distance
       FROM fx_traffic""", "fx_traffic"))
def fn_scalar_pack(spark, directory):
    at = F.lit("2024-01-25 00:00:00").cast("timestamp_ntz")
    ts, shown, clicked = F.col("event_dt_utc"), F.col("impressions"), F.col("clicks")
    term = F.col("customer_search_term")
    return view(spark, directory, "fx_traffic").select(
        "user_id",
        scalars.seconds_between(at, ts).alias("lead_seconds"),
        F.to_date(ts).alias("day"),
        scalars.days_between(at, ts).alias("lead_days"),
        F.round(scalars.ratio(clicked, shown), 9).alias("rate"),
        scalars.click_through_rate(clicked, shown).alias("ctr"),
        F.coalesce(term, F.col("campaign_id_string")).alias("term"),
        scalars.blank_to_null(term).alias("known_term"),
        F.regexp_extract("campaign_id_string", "c([0-9]+)", 1).alias("campaign_number"),
        ((shown.between(1, 5) & (clicked == 0)) | (clicked > 3)).alias("in_range"),
        F.abs(shown - 3).alias("distance"),
    )


@query(with_views(
    """SELECT user_id, event_dt_utc, impressions, clicks FROM fx_traffic
       ORDER BY event_dt_utc, user_id LIMIT 5""", "fx_traffic"))
def preview(spark, directory):
    df = view(spark, directory, "fx_traffic").select("user_id", "event_dt_utc", "impressions", "clicks")
    return df.orderBy("event_dt_utc", "user_id").limit(5)


@query(_train("""SELECT user_id, CAST(f_label_copy AS DOUBLE) AS f_label_copy, CAST(f_chars AS DOUBLE) AS f_chars,
     CASE WHEN isfinite(f_inf) THEN f_inf END AS f_inf, CAST(0 AS DOUBLE) AS f_absent
   FROM (SELECT user_id, coalesce(f_label_copy, 0) AS f_label_copy, f_chars, CASE WHEN isfinite(f_inf) THEN f_inf ELSE 0 END AS f_inf FROM fx_train_raw)"""))
def prep_to_double(spark, directory):
    """Features in a model's order, all doubles; what is missing or not finite is 0."""
    aligned = models.align(_raw(spark, directory), ["f_label_copy", "f_chars", "f_inf", "f_absent"])
    if {kind for name, kind in aligned.dtypes if name != "user_id"} != {"double"}:
        raise TypeError(f"features are not all doubles: {aligned.dtypes}")
    return aligned


# ---------------------------------------------------------------- split, folds, balance


def _order(key: str, seed: int = 42) -> str:
    return f"substr(md5(concat({key}, '-', {seed})), 1, 15), {key}"


_RANKED = f"""SELECT user_id, target_col,
   row_number() OVER (PARTITION BY target_col ORDER BY {_order('user_id')}) AS place,
   count(*) OVER (PARTITION BY target_col) AS n FROM fx_clean"""


@query(_train(_CLEAN + f"SELECT user_id, target_col, place <= round(0.2 * n) AS is_test FROM ({_RANKED})"))
def prep_stratified_split(spark, directory):
    df = balance.stratified_split(_clean(spark, directory), "target_col")
    return df.select("user_id", "target_col", "is_test")


@query(_train(_CLEAN + """SELECT user_id, target_col,
   CAST('0x' || substr(md5(concat(user_id, '-42')), 1, 15) AS BIGINT) < CAST(230584300921369396 AS BIGINT) AS is_test
   FROM fx_clean"""))
def prep_split_hash(spark, directory):
    df = balance.hash_split(_clean(spark, directory))
    return df.select("user_id", "target_col", "is_test")


@query(_train(_CLEAN + f"""SELECT user_id, target_col,
   CAST(ntile(5) OVER (PARTITION BY target_col ORDER BY {_order('user_id')}) - 1 AS INT) AS fold FROM fx_clean"""))
def prep_stratified_folds(spark, directory):
    df = balance.stratified_folds(_clean(spark, directory), "target_col")
    return df.select("user_id", "target_col", "fold")


@query(_train(_CLEAN + f""", ranked AS ({_RANKED}),
   largest AS (SELECT max(n) AS n FROM ranked),
   draws AS (SELECT j, CAST('0x' || substr(md5(concat(j, '-42')), 1, 15) AS BIGINT) AS h
             FROM (SELECT unnest(range((SELECT n FROM largest))) AS j))
   SELECT r.user_id, r.target_col FROM ranked r JOIN draws d ON d.h % r.n = r.place - 1
   WHERE r.n < (SELECT n FROM largest)
   UNION ALL SELECT user_id, target_col FROM ranked WHERE n = (SELECT n FROM largest)"""))
def prep_oversample(spark, directory):
    df = balance.oversample(_clean(spark, directory), "target_col")
    return df.select("user_id", "target_col")


# Many classes of very different sizes: squares modulo a thousand.
_MANY = """many AS (SELECT event_id, CAST(event_id * event_id % 1000 AS INT) AS label FROM events),
   ranked AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY substr(md5(concat(event_id, '-42')), 1, 15), event_id) AS place,
     count(*) OVER (PARTITION BY label) AS n FROM many)"""


def _many(spark, directory):
    label = (F.col("event_id") * F.col("event_id") % 1000).cast("int")
    return read_table(spark, directory, "events").select("event_id", label.alias("label"))


@query(f"WITH {_MANY} SELECT event_id, label, place <= round(0.2 * n) AS is_test FROM ranked")
def prep_stratified_split_many(spark, directory):
    return balance.stratified_split(_many(spark, directory), "label", "event_id")


@query(f"""WITH {_MANY} SELECT event_id, label,
   CAST(ntile(5) OVER (PARTITION BY label ORDER BY place) - 1 AS INT) AS fold FROM ranked""")
def prep_stratified_folds_many(spark, directory):
    return balance.stratified_folds(_many(spark, directory), "label", "event_id")


@query(f"""WITH {_MANY}, largest AS (SELECT max(n) AS n FROM ranked),
   draws AS (SELECT CAST('0x' || substr(md5(concat(j, '-42')), 1, 15) AS BIGINT) AS h
             FROM (SELECT unnest(range((SELECT n FROM largest))) AS j))
   SELECT r.event_id, r.label FROM ranked r JOIN draws d ON d.h % r.n = r.place - 1 WHERE r.n < (SELECT n FROM largest)
   UNION ALL SELECT event_id, label FROM ranked WHERE n = (SELECT n FROM largest)""")
def prep_oversample_many(spark, directory):
    return balance.oversample(_many(spark, directory), "label", "event_id")


@query("""WITH bare AS (SELECT user_id, event_type, CAST(event_id % 3 AS INT) AS label FROM events),
   told AS (SELECT *, md5(concat_ws(chr(31), CAST(user_id AS VARCHAR), event_type, CAST(label AS VARCHAR))) AS digest FROM bare)
   SELECT user_id, event_type, label, row_number() OVER (PARTITION BY label ORDER BY substr(md5(concat(digest, '-42')), 1, 15), digest)
     <= round(0.2 * count(*) OVER (PARTITION BY label)) AS is_test FROM told""")
def prep_split_no_key(spark, directory):
    """Rows without a key, many of them equal."""
    label = (F.col("event_id") % 3).cast("int").alias("label")
    return balance.stratified_split(read_table(spark, directory, "events").select("user_id", "event_type", label), "label", None)


# Feature rows of users at several cut-offs; the label is many recent clicks.
_SNAPSHOTS = """, cutoffs AS (SELECT unnest([{cutoffs}]) AS time_point),
   snapshots AS (SELECT time_point, user_id,
       CAST(sum(CASE WHEN date_diff('second', event_dt_utc, time_point) < 1296000 THEN clicks ELSE 0 END) > 8 AS INT) AS label
     FROM fx_traffic, cutoffs WHERE ad_product_type = 'sponsored_products' AND event_dt_utc < time_point GROUP BY ALL)
""".format(cutoffs=", ".join(f"TIMESTAMP '{at}'" for at in CUTOFFS))


def _snapshots(spark, directory):
    rows = user_rows(view(spark, directory, "fx_traffic"), view(spark, directory, "fx_conversions"), CUTOFFS)
    return rows.select("time_point", "user_id", (F.col("total_clicks_15d") > 8).cast("int").alias("label"))


@query(with_views(_SNAPSHOTS + """SELECT time_point, user_id, label,
     row_number() OVER (PARTITION BY label ORDER BY substr(md5(concat(time_point, '-', user_id, '-42')), 1, 15), time_point, user_id)
       <= round(0.2 * count(*) OVER (PARTITION BY label)) AS is_test FROM snapshots""", "fx_traffic"))
def prep_split_snapshots(spark, directory):
    """Several rows per user, told apart by cut-off and user together."""
    return balance.stratified_split(_snapshots(spark, directory), "label", ["time_point", "user_id"])


@query(with_views(_SNAPSHOTS + """, users AS (SELECT user_id, max(label) AS side FROM snapshots GROUP BY user_id),
   chosen AS (SELECT user_id, row_number() OVER (PARTITION BY side ORDER BY substr(md5(concat(user_id, '-42')), 1, 15), user_id)
       <= round(0.2 * count(*) OVER (PARTITION BY side)) AS is_test FROM users)
   SELECT time_point, user_id, label, is_test FROM snapshots JOIN chosen USING (user_id)""", "fx_traffic"))
def prep_split_users(spark, directory):
    """All rows of a user on one side."""
    return balance.split_by_group(_snapshots(spark, directory), "label", "user_id")


@query(_train(_CLEAN + """SELECT user_id, target_col, round(
     (SELECT count(*) FROM fx_clean) * 1.0 / ((SELECT count(DISTINCT target_col) FROM fx_clean)
       * count(*) OVER (PARTITION BY target_col)), 9) AS class_weight FROM fx_clean"""))
def prep_class_weights(spark, directory):
    df = balance.class_weights(_clean(spark, directory), "target_col")
    return rounded(df.select("user_id", "target_col", "class_weight"), 9, "class_weight")


# ---------------------------------------------------------------- encoding

_SCORES = """, stats AS (SELECT avg(f_chars) AS m, stddev_samp(f_chars) AS s FROM fx_clean)
"""


@query(_train(_CLEAN + _SCORES +
    "SELECT c.user_id, round((c.f_chars - stats.m) / stats.s, 6) AS f_chars FROM fx_clean c, stats"))
def prep_scale(spark, directory):
    df = encoding.standardize(_clean(spark, directory), ["f_chars"])
    return rounded(df.select("user_id", "f_chars"), 6, "f_chars")


@query("""SELECT doc_id, source, dense_rank() OVER (ORDER BY source) - 1 AS source_code FROM documents""")
def prep_label_encode(spark, directory):
    documents = read_table(spark, directory, "documents").select("doc_id", "source")
    return encoding.label_encode(documents, "source", "source_code")


@query("""SELECT e.event_id, abs((e.value - s.m) / s.s) > 3 AS is_anomaly
          FROM events e, (SELECT avg(value) AS m, stddev_samp(value) AS s FROM events) s""")
def anomaly_zscore(spark, directory):
    events = read_table(spark, directory, "events").select("event_id", "value")
    return encoding.anomalies(events, ["value"]).select("event_id", "is_anomaly")


# ---------------------------------------------------------------- files


@query("""SELECT event_id, user_id, event_type, value,
            CASE WHEN event_type IN ('error', 'signup') THEN ts END AS ts FROM events""")
def src_csv_union(spark, directory):
    """The event table written as CSV files with three different headers, and read back as one."""
    events = read_table(use_utc(spark), directory, "events")
    events = events.withColumn("ts", F.col("ts").cast("string"))
    folder = scratch_path(spark, "csv_union")
    layouts = {
        "views": (["view", "click"], ["event_id", "user_id", "event_type", "value"]),
        "orders": (["purchase"], ["value", "event_type", "event_id", "user_id"]),
        "rest": (["error", "signup"], ["event_id", "user_id", "event_type", "value", "ts"]),
    }
    for name, (types, columns) in layouts.items():
        part = events.where(F.col("event_type").isin(types)).select(*columns)
        part.write.mode("append").csv(folder, header=True)
    types = {"event_id": "bigint", "user_id": "bigint", "value": "double", "ts": "timestamp_ntz"}
    return read_csv_directory(spark, folder, types).select("event_id", "user_id", "event_type", "value", "ts")


@query(with_views("SELECT user_id, prediction, probability FROM fx_scored", "fx_scored"))
def sink_predictions_roundtrip(spark, directory):
    path = scratch_path(spark, "predictions")
    write_predictions(view(spark, directory, "fx_scored"), path)
    return read_csv_directory(
        spark, path, {"user_id": "bigint", "prediction": "int", "probability": "double"}
    )
