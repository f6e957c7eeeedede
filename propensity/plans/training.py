"""From a raw training frame to a saved, evaluated model."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, functions as F

from propensity.operators import balance, cleaning, metrics, model as models
from propensity.session import materialize, scratch


@dataclass(frozen=True)
class Trained:
    model: PipelineModel
    metrics: DataFrame
    test: DataFrame


def key_of(df: DataFrame, key: balance.Key) -> balance.Key:
    """The key, or None if the frame lacks a column of it: rows are then told by their contents."""
    return key if set(cleaning.names_of(key)) <= set(df.columns) and key is not None else None


def prepare(
    df: DataFrame, label: str, key: balance.Key = "user_id", drop: Sequence[str] = cleaning.NOT_FEATURES,
    test_size: float = 0.2, seed: int = 42, group: str | None = None, texts: Sequence[str] = (),
) -> DataFrame:
    """Clean, split and write out: ``key, label, features..., is_test``.

    Columns the label was made from, and those that identify the user, are dropped by default. ``key`` may be several columns, such
    as cut-off and user; rows without it are split by what they hold, alike under any layout. With ``group`` all rows
    of a group, such as the snapshots of a user, are on one side.
    """
    key = key_of(df, key)
    kept = list(dict.fromkeys([*cleaning.names_of(key), *([group] if group else [])]))
    with scratch(df.sparkSession):
        cleaned = materialize(cleaning.clean(df, label, kept, drop, texts), "cleaned")
        if group is not None:
            split = balance.split_by_group(cleaned, label, group, test_size, seed)
        else:
            split = balance.stratified_split(cleaned, label, key, test_size, seed)
        return materialize(split, "split", partition_by="is_test", outer=True)


def train(
    df: DataFrame,
    label: str,
    key: balance.Key = "user_id",
    drop: Sequence[str] = cleaning.NOT_FEATURES,
    balancing: str = "oversample",
    test_size: float = 0.2,
    seed: int = 42,
    save_to: str | None = None,
    estimator=models.boosted_trees,
    group: str | None = None,
    encode: Sequence[str] = (),
    **options,
) -> Trained:
    """Fit on the balanced training part, evaluate on the untouched test part, save the model.

    ``balancing`` is ``oversample``, ``weights`` or ``none``; ``key`` and ``group`` as in ``prepare``; ``encode`` names text columns that are
    features too, numbered as the training part has them. Errors are raised, not logged.
    """
    if balancing not in ("oversample", "weights", "none"):
        raise ValueError(f"unknown balancing '{balancing}'")
    absent = [n for n in (label, *encode, *([group] if group else [])) if n not in df.columns]
    if absent:
        raise ValueError(f"column '{absent[0]}' not found")
    key = key_of(df, key)
    prepared = prepare(df, label, key, drop, test_size, seed, group, encode)
    fit_on = prepared.where(~F.col("is_test")).drop("is_test")
    test = prepared.where("is_test").drop("is_test")
    kept = [*cleaning.names_of(key), *([group] if group else [])]
    features = [*cleaning.features_of(fit_on, label, kept), *encode]
    with scratch(df.sparkSession):
        if balancing == "oversample":
            fit_on = materialize(balance.oversample(fit_on, label, key, seed), "balanced")
        elif balancing == "weights":
            fit_on = balance.class_weights(fit_on, label)
            options["weight"] = "class_weight"
        if encode:
            options["encode"] = encode
        pipeline: Pipeline = estimator(features, label, seed=seed, **options)
        fitted = models.fit(pipeline, fit_on)
    if save_to is not None:
        fitted.write().overwrite().save(save_to)
    scored = models.score(fitted, test).select(*dict.fromkeys(kept), label, "prediction", "probability")
    return Trained(fitted, metrics.evaluation(materialize(scored, "scored"), label), test)
