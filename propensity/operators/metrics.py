"""Classifier scores as aggregates, and scores read back from log text."""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Column, DataFrame, functions as F

from propensity.functions.scalars import ratio

# The metric names looked for in logs, and the number that follows each.
LOG_METRICS = (
    "Accuracy",
    "Balanced Accuracy",
    "MCC",
    "ROC AUC",
    "F1 Score",
    "Precision",
    "Recall",
)
LOG_NUMBER = ": ([0-9]*[.][0-9]+)"


def confusion(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row ``tp, fp, fn, tn``; rows with a missing side count as negative there."""
    actual = F.coalesce(F.col(label) == 1, F.lit(False))
    called = F.coalesce(F.col(prediction) == 1, F.lit(False))
    return scored.agg(
        F.count_if(actual & called).alias("tp"),
        F.count_if(~actual & called).alias("fp"),
        F.count_if(actual & ~called).alias("fn"),
        F.count_if(~actual & ~called).alias("tn"),
    )


def _or_zero(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(ratio(numerator, denominator), F.lit(0.0))


def _counts() -> tuple[Column, Column, Column, Column]:
    return F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")


def _basic() -> list[Column]:
    tp, fp, fn, tn = _counts()
    return [
        _or_zero(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        _or_zero(tp, tp + fp).alias("precision"),
        _or_zero(tp, tp + fn).alias("recall"),
        _or_zero(2 * tp, 2 * tp + fp + fn).alias("f1"),
    ]


def _hard_auc() -> Column:
    tp, fp, fn, tn = _counts()
    return F.coalesce((ratio(tp, tp + fn) + ratio(tn, tn + fp)) / 2, F.lit(0.0))


def basic_metrics(counts: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and F1 from a confusion row; 0 where undefined."""
    return counts.select(*_basic())


def balanced_metrics(counts: DataFrame) -> DataFrame:
    """Balanced accuracy over the classes present, and Matthews correlation (0 if undefined)."""
    tp, fp, fn, tn = (c.cast("double") for c in _counts())
    recall, specificity = ratio(tp, tp + fn), ratio(tn, tn + fp)
    both = F.coalesce((recall + specificity) / 2, recall, specificity, F.lit(0.0))
    spread = F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))
    return counts.select(
        both.alias("balanced_accuracy"), _or_zero(tp * tn - fp * fn, spread).alias("mcc")
    )


def auc_of_predictions(counts: DataFrame) -> DataFrame:
    """ROC AUC of hard 0/1 predictions; 0 when only one class is present."""
    return counts.select(_hard_auc().alias("auc"))


def auc_of_probabilities(
    scored: DataFrame, label: str = "label", probability: str = "probability"
) -> float:
    """Exact ROC AUC, ties counted half; 0 when only one class is present or there are no rows.

    As in ``confusion``, a missing label is negative; a missing score (NULL or NaN) is below all others.

    Known scores, infinities among them, are counted per distinct value and sorted in parallel, without bins; the missing ones lose to
    all of them and tie with each other.
    """
    number = F.col(probability).cast("double")
    pair = scored.select(
        F.coalesce(F.col(label) == 1, F.lit(False)).alias("positive"), F.when(number == 0, 0.0).when(~F.isnan(number), number).alias("score")
    )
    known, positive = F.col("score").isNotNull(), F.col("positive")
    counts = pair.agg(
        F.count_if(positive & known).alias("pos"),
        F.count_if(~positive & known).alias("neg"),
        F.count_if(positive & ~known).alias("pos_missing"),
        F.count_if(~positive & ~known).alias("neg_missing"),
    ).first()
    pairs = (counts.pos + counts.pos_missing) * (counts.neg + counts.neg_missing)
    if not pairs:
        return 0.0
    won = counts.pos * counts.neg_missing + counts.pos_missing * counts.neg_missing / 2
    if counts.pos and counts.neg:
        evaluator = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", metricName="areaUnderROC", numBins=0)
        won += evaluator.evaluate(pair.where(known).select("score", positive.cast("double").alias("label"))) * counts.pos * counts.neg
    return won / pairs


def evaluation(
    scored: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    probability: str = "probability",
) -> DataFrame:
    """All scores of a scored frame in one row."""
    counts = confusion(scored, label, prediction)
    area = auc_of_probabilities(scored, label, probability)
    return counts.select(*_basic(), F.lit(area).alias("auc"), _hard_auc().alias("auc_hard"))


def log_metrics(lines: DataFrame, anchored: bool = False) -> DataFrame:
    """``metric, value`` for every metric found in text lines.

    Unanchored, ``Accuracy`` is also found inside ``Balanced Accuracy``; anchored patterns accept
    a name only at the start of a line, after blanks.
    """
    head = r"^\s*" if anchored else ""
    found = F.array(
        *[
            F.struct(
                F.lit(name).alias("metric"),
                F.regexp_extract("value", f"{head}{name}{LOG_NUMBER}", 1).alias("text"),
            )
            for name in LOG_METRICS
        ]
    )
    return (
        lines.select(F.inline(F.filter(found, lambda hit: hit["text"] != "")))
        .select("metric", F.col("text").cast("double").alias("value"))
    )
