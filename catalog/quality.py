"""Data-quality queries, over the raw training frame and over the event table."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.inputs import view, with_views
from catalog.registry import registry, rounded
from propensity.operators import cleaning, quality
from propensity.sources.tables import read_table

QUERIES, ORACLES, query = registry()

# The raw training frame, its columns in order with their types.
TRAIN_TYPES = {
    "user_id": "bigint",
    "target_col": "int",
    "f_chars": "bigint",
    "f_toxic": "int",
    "f_zero": "int",
    "f_null": "double",
    "f_inf": "double",
    "s_blank": "string",
    "f_label_copy": "int",
}
NUMERIC = [name for name, kind in TRAIN_TYPES.items() if kind != "string"]


def _raw(spark, directory):
    return view(spark, directory, "fx_train_raw")


def _per_column(names, template: str) -> str:
    """One row per column, from a template over ``{c}``."""
    return with_views("\nUNION ALL\n".join(template.format(c=name) for name in names), "fx_train_raw")


@query(with_views("\nUNION ALL\n".join(
    f"""SELECT '{name}' AS column_name, {i} AS ordinal, '{kind}' AS data_type, count({name}) AS non_null,
        count(*) AS n_rows, {len(TRAIN_TYPES)} AS n_columns FROM fx_train_raw"""
    for i, (name, kind) in enumerate(TRAIN_TYPES.items(), 1)), "fx_train_raw"))
def qc_shape(spark, directory):
    return quality.shape(_raw(spark, directory))


@query(_per_column(TRAIN_TYPES,
    "SELECT '{c}' AS column_name, count(*) - count({c}) AS missing FROM fx_train_raw"))
def qc_missing(spark, directory):
    return quality.missing(_raw(spark, directory))


@query("""SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicated_rows FROM
          (SELECT count(*) AS n FROM events GROUP BY user_id, event_type, CAST(ts AS DATE))""")
def qc_duplicates(spark, directory):
    """Repeated (user, type, day) rows of the event table, which has many."""
    events = read_table(spark, directory, "events")
    return quality.duplicates(events.select("user_id", "event_type", F.to_date("ts").alias("day")))


@query(with_views(
    """SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicated_rows FROM
       (SELECT count(*) AS n FROM fx_train_raw GROUP BY ALL)""".replace(
        "GROUP BY ALL", "GROUP BY " + ", ".join(TRAIN_TYPES)), "fx_train_raw"))
def qc_duplicates_train(spark, directory):
    return quality.duplicates(_raw(spark, directory))


@query(with_views(
    """SELECT target_col AS label, count(*) AS n FROM fx_train_raw
       WHERE target_col IS NOT NULL GROUP BY target_col""", "fx_train_raw"))
def qc_label_dist(spark, directory):
    return quality.label_distribution(_raw(spark, directory), "target_col")


@query(_per_column(["f_toxic", "f_zero", "f_label_copy"],
    """SELECT '{c}' AS column_name, bool_and({c} IS NOT DISTINCT FROM target_col) AS is_identical
       FROM fx_train_raw"""))
def qc_identical(spark, directory):
    return quality.identical_to_label(_raw(spark, directory), "target_col")


_CORRELATION = """SELECT '{c}' AS column_name,
   CASE WHEN count(*) FILTER (isinf(x)) > 0 OR min(x) = max(x) OR min(y) = max(y) OR count(*) < 2 THEN NULL
        ELSE round(abs(corr(CASE WHEN isfinite(x) THEN x END, y)), 9) END AS correlation
   FROM (SELECT CAST({c} AS DOUBLE) AS x, CAST(target_col AS DOUBLE) AS y FROM fx_train_raw
         WHERE {c} IS NOT NULL AND target_col IS NOT NULL)"""
_FEATURES = [name for name in NUMERIC if name != "target_col"]


@query(_per_column(_FEATURES, _CORRELATION))
def qc_label_corr(spark, directory):
    return rounded(quality.label_correlation(_raw(spark, directory), "target_col"), 9, "correlation")


@query(with_views(
    "SELECT column_name, correlation FROM ("
    + "\nUNION ALL\n".join(_CORRELATION.format(c=name) for name in _FEATURES)
    + ") WHERE correlation >= 1 - 1e-12", "fx_train_raw"))
def qc_perfect_corr(spark, directory):
    return rounded(quality.perfect_correlation(_raw(spark, directory), "target_col"), 9, "correlation")


@query(with_views(
    "SELECT user_id, target_col, f_chars, f_toxic, f_zero, f_null, f_inf, s_blank FROM fx_train_raw",
    "fx_train_raw"))
def qc_leakage_drop(spark, directory):
    return quality.drop_leakage(_raw(spark, directory), ["f_label_copy", "not_there"])[0]


def _describe_sql(source: str, names) -> str:
    return "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 6) AS mean,
            round(stddev_samp({c}), 6) AS std, CAST(min({c}) AS DOUBLE) AS min,
            round(CAST(quantile_cont({c}, 0.25) AS DOUBLE), 6) AS p25,
            round(CAST(quantile_cont({c}, 0.5) AS DOUBLE), 6) AS p50,
            round(CAST(quantile_cont({c}, 0.75) AS DOUBLE), 6) AS p75,
            CAST(max({c}) AS DOUBLE) AS max FROM {source}"""
        for c in names
    )


def _described(df, names):
    return rounded(quality.describe(df, names), 6, "mean", "std", "p25", "p50", "p75")


@query(with_views(
    ", fx_finite AS (SELECT CAST(user_id AS DOUBLE) AS user_id, CAST(target_col AS DOUBLE) AS target_col,"
    " CAST(f_chars AS DOUBLE) AS f_chars, CAST(f_toxic AS DOUBLE) AS f_toxic, CAST(f_zero AS DOUBLE) AS f_zero,"
    " f_null, CASE WHEN isfinite(f_inf) THEN f_inf END AS f_inf,"
    " CAST(f_label_copy AS DOUBLE) AS f_label_copy FROM fx_train_raw)\n"
    + _describe_sql("fx_finite", NUMERIC), "fx_train_raw"))
def qc_describe(spark, directory):
    return _described(cleaning.infinities_to_null(_raw(spark, directory)), NUMERIC)


@query(_describe_sql("events", ["value"]))
def qc_describe_events(spark, directory):
    return _described(read_table(spark, directory, "events"), ["value"])


@query(_per_column(["f_null", "f_inf"],
    """SELECT '{c}' AS column_name, count(*) FILTER (isnan({c}) OR isinf({c})) AS non_finite
       FROM fx_train_raw"""))
def qc_nonfinite(spark, directory):
    return quality.non_finite(_raw(spark, directory))
