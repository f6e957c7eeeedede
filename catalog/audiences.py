"""Metrics and audience selection on a deterministic score column."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.inputs import view, with_views
from catalog.registry import registry, rounded
from propensity.operators import audience, metrics, quality
from propensity.operators.ranking import numbered
from propensity.session import scratch_path
from propensity.sources.tables import read_table

QUERIES, ORACLES, query = registry()


def _scored(spark, directory):
    return view(spark, directory, "fx_scored")


def _sql(body: str) -> str:
    return with_views(body, "fx_scored")


# ---------------------------------------------------------------- metrics

_COUNTS = """, counts AS (SELECT
   count(*) FILTER (label = 1 AND prediction = 1) AS tp, count(*) FILTER (label <> 1 AND prediction = 1) AS fp,
   count(*) FILTER (label = 1 AND prediction <> 1) AS fn, count(*) FILTER (label <> 1 AND prediction <> 1) AS tn
   FROM fx_scored)
"""
_BASIC = """round((tp + tn) * 1.0 / (tp + fp + fn + tn), 9) AS accuracy,
   round(coalesce(tp * 1.0 / nullif(tp + fp, 0), 0), 9) AS precision,
   round(coalesce(tp * 1.0 / nullif(tp + fn, 0), 0), 9) AS recall,
   round(coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0), 9) AS f1"""


def _counts(spark, directory):
    return metrics.confusion(_scored(spark, directory))


@query(_sql(_COUNTS + "SELECT tp, fp, fn, tn FROM counts"))
def metric_confusion(spark, directory):
    return _counts(spark, directory)


@query(_sql(_COUNTS + f"SELECT {_BASIC} FROM counts"))
def metric_basic(spark, directory):
    return rounded(metrics.basic_metrics(_counts(spark, directory)), 9, "accuracy", "precision", "recall", "f1")


_AREA = """SELECT round((sum(r) FILTER (label = 1) - p * (p + 1) / 2.0) / (p * q), 9) AS auc
   FROM (SELECT label, count(*) FILTER (label = 1) OVER () AS p, count(*) FILTER (label <> 1) OVER () AS q,
           rank() OVER (ORDER BY {score}) + (count(*) OVER (PARTITION BY {score}) - 1) / 2.0 AS r
         FROM fx_scored) GROUP BY p, q"""


@query(_sql(_AREA.format(score="probability")))
def metric_auc_prob(spark, directory):
    area = metrics.auc_of_probabilities(_scored(spark, directory))
    return spark.range(1).select(F.round(F.lit(area), 9).alias("auc"))


@query(_sql(_AREA.format(score="prediction")))
def metric_auc_hard(spark, directory):
    return rounded(metrics.auc_of_predictions(_counts(spark, directory)), 9, "auc")


@query(_sql(_COUNTS + """SELECT
   round((tp * 1.0 / (tp + fn) + tn * 1.0 / (tn + fp)) / 2, 9) AS balanced_accuracy,
   round((tp * tn - fp * fn) / sqrt((tp + fp) * 1.0 * (tp + fn) * (tn + fp) * (tn + fn)), 9) AS mcc
   FROM counts"""))
def metric_balanced_mcc(spark, directory):
    return rounded(metrics.balanced_metrics(_counts(spark, directory)), 9, "balanced_accuracy", "mcc")


@query(_sql(_COUNTS + f""", basic AS (SELECT {_BASIC} FROM counts), area AS ({_AREA.format(score='probability')})
   SELECT accuracy, precision, recall, f1, auc, accuracy = 1 AND precision = 1 AND recall = 1 AND f1 = 1
     AND auc IN (0, 1) AS is_suspicious FROM basic, area"""))
def qc_perfect_metrics(spark, directory):
    row = metrics.evaluation(_scored(spark, directory)).drop("auc_hard")
    return rounded(quality.perfect_metrics(row), 9, "accuracy", "precision", "recall", "f1", "auc")


def _four_digits(ten_thousandths: str) -> str:
    whole = f"({ten_thousandths})"
    return f"concat({whole} // 10000, '.', lpad(CAST({whole} % 10000 AS VARCHAR), 4, '0'))"


@query(with_views(
    """, counts AS (SELECT d.source, count(*) AS n,
         count(*) FILTER (s.label = 1) AS p, count(*) FILTER (s.label <> 1) AS q,
         count(*) FILTER (s.label = 1 AND s.prediction = 1) AS tp,
         count(*) FILTER (s.label <> 1 AND s.prediction <> 1) AS tn
         FROM fx_scored s JOIN documents d ON d.doc_id = s.user_id GROUP BY d.source),
       values_found AS (
         SELECT 'Accuracy' AS metric, (10000 * (tp + tn)) // n AS v FROM counts
         UNION ALL SELECT 'Accuracy', (10000 * (tp * q + tn * p)) // (2 * p * q) FROM counts WHERE p * q > 0
         UNION ALL SELECT 'Balanced Accuracy', (10000 * (tp * q + tn * p)) // (2 * p * q) FROM counts WHERE p * q > 0
         UNION ALL SELECT 'Recall', (10000 * tp) // p FROM counts WHERE p > 0)
       SELECT metric, CAST(v / 10000.0 AS DOUBLE) AS value FROM values_found""", "fx_scored"))
def log_metrics(spark, directory):
    """Scores per document source, logged as text lines, written out and read back by pattern."""
    documents = read_table(spark, directory, "documents").select(F.col("doc_id").alias("user_id"), "source")
    positive, called = F.col("label") == 1, F.col("prediction") == 1
    counts = _scored(spark, directory).join(documents, "user_id").groupBy("source").agg(
        F.count("*").alias("n"),
        F.count_if(positive).alias("p"),
        F.count_if(~positive).alias("q"),
        F.count_if(positive & called).alias("tp"),
        F.count_if(~positive & ~called).alias("tn"),
    )

    def line(name: str, share: str):
        value = f"({share}) div 10000, '.', lpad(cast(({share}) % 10000 as string), 4, '0')"
        return f"concat('{name}: ', {value})"

    balanced = "CASE WHEN p * q > 0 THEN (10000 * (tp * q + tn * p)) div (2 * p * q) END"
    lines = counts.selectExpr(
        f"""inline(array(
            struct({line('Accuracy', '(10000 * (tp + tn)) div n')} AS value),
            struct({line('Balanced Accuracy', balanced)} AS value),
            struct({line('Recall', 'CASE WHEN p > 0 THEN (10000 * tp) div p END')} AS value)))"""
    ).where("value IS NOT NULL")
    path = scratch_path(spark, "log")
    lines.write.text(path)
    return metrics.log_metrics(spark.read.text(path))


# ---------------------------------------------------------------- audiences


_HASHED = "substr(md5(concat(user_id, '-42')), 1, 15), user_id"


@query(_sql(f"""SELECT user_id, prediction, probability, label,
   CAST(row_number() OVER (ORDER BY probability DESC, {_HASHED}) - 1 AS BIGINT) AS place FROM fx_scored"""))
def audience_ranked(spark, directory):
    """The order itself is compared: rows are numbered as they are sorted."""
    return numbered(audience.ranked(_scored(spark, directory)), "place")


def _top_sql(view: str, n: int) -> str:
    return f"""SELECT user_id, probability FROM {view} WHERE probability IS NOT NULL AND NOT isnan(probability)
       ORDER BY probability DESC, {_HASHED} LIMIT {n}"""


@query(_sql(_top_sql("fx_scored", 100)))
def audience_top_n(spark, directory):
    return audience.top_n(_scored(spark, directory).select("user_id", "probability"), 100)


_UNSCORED = """SELECT user_id, CASE WHEN user_id % 5 = 0 THEN NULL WHEN user_id % 7 = 0 THEN CAST('NaN' AS DOUBLE)
   ELSE floor(probability * 4) / 4 END AS probability FROM {scored}"""


@query(_sql(f", rough AS ({_UNSCORED.format(scored='fx_scored')}) " + _top_sql("rough", 100)))
def audience_unscored(spark, directory):
    """The cut among tied users where others have no score or NaN."""
    rough = spark.sql(_UNSCORED, scored=_scored(spark, directory))
    return audience.top_n(rough, 100)


@query(_sql(f"""SELECT user_id, probability FROM
   (SELECT user_id, probability, row_number() OVER (ORDER BY probability DESC, {_HASHED}) AS place,
      count(*) OVER () AS n FROM fx_scored) WHERE place <= ceil(n * 15 / 100.0)"""))
def audience_top_pct(spark, directory):
    return audience.top_percent(_scored(spark, directory).select("user_id", "probability"), 15)


@query(_sql(f"""SELECT user_id, probability FROM
   (SELECT user_id, CAST(label AS DOUBLE) AS probability,
      row_number() OVER (ORDER BY label DESC, {_HASHED}) AS place,
      count(*) OVER () AS n FROM fx_scored) WHERE place <= ceil(n * 15 / 100.0)"""))
def audience_top_pct_tied(spark, directory):
    """The same cut where most users share one probability."""
    tied = _scored(spark, directory).select("user_id", F.col("label").cast("double").alias("probability"))
    return audience.top_percent(tied, 15)


@query(_sql("SELECT user_id, probability FROM fx_scored WHERE probability >= 0.7"))
def audience_threshold(spark, directory):
    return audience.above(_scored(spark, directory).select("user_id", "probability"), 0.7)
