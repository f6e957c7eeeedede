"""Batch scoring with a saved model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from propensity.operators import model as models
from propensity.operators.cleaning import names_of
from propensity.sources.csv_files import read_csv_directory, write_predictions


def score_frame(model: PipelineModel, df: DataFrame, key: str | Sequence[str] = "user_id") -> DataFrame:
    """The key, ``prediction, probability``. No shuffle: alignment and scoring are projections."""
    kept = [n for n in names_of(key) if n in df.columns]
    return models.score(model, models.align(df, models.contract(model), kept)).select(*kept, "prediction", "probability")


def score_audience(model: PipelineModel, df: DataFrame) -> DataFrame:
    """The columns of ``df`` as they came, with ``prediction`` and ``probability``."""
    whole = df.withColumn("source_row", F.struct(*df.columns))
    aligned = models.align(whole, models.contract(model), kept=("source_row",))
    return models.score(model, aligned).select("source_row.*", "prediction", "probability")


def score(df: DataFrame, model_path: str, output: str, key: str = "user_id") -> dict[str, str]:
    """Load a model, score, write CSV; returns the state of every feature (matched, cast, missing, extra).

    A feature that the data hold as text is read as numbers; the state tells how many values were none.
    """
    model = PipelineModel.load(model_path)
    write_predictions(score_frame(model, df, key), output)
    states = models.alignment(df, models.contract(model), kept=(key,))
    lost = models.lost_values(df, models.contract(model))
    return {n: f"{state}, {lost[n]} values are no numbers" if lost.get(n) else state for n, state in states.items()}


def score_files(spark: SparkSession, directory: str, model_path: str, output: str, key: str = "user_id") -> dict[str, str]:
    """Score a directory of CSV files. The model's contract is their schema: no type is inferred from the data to be scored.

    As all values are text here, a number is matched if it can be read, and every column that is no feature is extra.
    """
    features = models.contract(PipelineModel.load(model_path))
    df = read_csv_directory(spark, directory, {})
    states = {n: state.replace("cast", "matched") for n, state in score(df, model_path, output, key).items()}
    return states | {n: "extra" for n in df.columns if n not in features and n != key}
