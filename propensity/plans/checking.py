"""Is the data fit to train on? Quality checks, then a validated random forest."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from propensity.operators import balance, cleaning, metrics, model as models, quality
from propensity.plans import training
from propensity.session import materialize


@dataclass(frozen=True)
class Validation:
    folds: DataFrame
    mean_f1: float
    metrics: DataFrame


def validate(
    df: DataFrame,
    label: str,
    key: balance.Key = "user_id",
    drop: Sequence[str] = cleaning.NOT_FEATURES,
    folds: int = 5,
    seed: int = 42,
    **options,
) -> Validation:
    """F1 per fold on the training part and its mean, then scores on the test part, flagged if too good.

    The class decides the AUC here, not the probability, and the classes stay unbalanced.
    """
    key = training.key_of(df, key)
    prepared = training.prepare(df, label, key, drop, seed=seed)
    fit_on = prepared.where(~F.col("is_test")).drop("is_test")
    features = cleaning.features_of(fit_on, label, key)
    forest = models.random_forest(features, label, seed=seed, **options)
    folded = materialize(balance.stratified_folds(fit_on, label, key, folds, seed), "folds", "fold")
    scored = models.score(models.fit(forest, fit_on), prepared.where("is_test"))
    scores = metrics.evaluation(materialize(scored.select(label, "prediction", "probability"), "scored"), label)
    hard = scores.withColumn("auc", F.col("auc_hard")).drop("auc_hard")
    per_fold = materialize(models.cross_validate(folded, forest, label, folds), "f1")
    return Validation(per_fold, per_fold.agg(F.avg("f1")).first()[0], quality.perfect_metrics(hard))
