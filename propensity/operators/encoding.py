"""Scaling, label encoding and outlier flags."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from propensity.functions.scalars import ratio
from propensity.operators.ranking import numbered


def moments(df: DataFrame, names: Sequence[str]) -> dict[str, tuple[float | None, float]]:
    """Mean and sample standard deviation per column, from one aggregation; plain numbers to keep with a model."""
    stats = df.agg(
        *[F.avg(n).cast("double").alias(f"avg_{i}") for i, n in enumerate(names)],
        *[F.stddev(n).alias(f"std_{i}") for i, n in enumerate(names)],
    ).first()
    return {n: (stats[f"avg_{i}"], stats[f"std_{i}"] or 0.0) for i, n in enumerate(names)}


def _scores(fitted: Mapping[str, tuple[float | None, float]]) -> dict[str, Column]:
    """Standard scores per column; 0 for a constant column."""
    scores = {}
    for n, (mean, deviation) in fitted.items():
        centred = F.col(n).cast("double") - F.lit(mean)
        spread = F.lit(deviation)
        known = F.when(F.col(n).isNotNull(), F.lit(0.0))
        scores[n] = F.coalesce(ratio(centred, spread), known)
    return scores


def standardize(
    df: DataFrame, names: Sequence[str], fitted: Mapping[str, tuple[float | None, float]] | None = None
) -> DataFrame:
    """Replace each column by its distance from the mean in sample standard deviations.

    ``fitted`` are the ``moments`` of another frame, such as the training part; without it those of ``df``.
    """
    fitted = moments(df, names) if fitted is None else fitted
    return df.withColumns(_scores({n: fitted[n] for n in names}))


def anomalies(df: DataFrame, names: Sequence[str], limit: float = 3.0) -> DataFrame:
    """Add ``n_outliers``, the features further than ``limit`` deviations out, and ``is_anomaly``."""
    flags = [
        F.coalesce((F.abs(score) > limit).cast("int"), F.lit(0)) for score in _scores(moments(df, names)).values()
    ]
    count = reduce(lambda a, b: a + b, flags)
    return df.withColumn("n_outliers", count).withColumn("is_anomaly", F.col("n_outliers") > 0)


def categories(df: DataFrame, column: str) -> DataFrame:
    """``value, code``: the distinct values in order, numbered from 0.

    Values are sorted by range and numbered from partition to partition.
    """
    values = df.select(F.col(column).alias("value")).where("value IS NOT NULL").distinct()
    return numbered(values.repartitionByRange("value").sortWithinPartitions("value"), "code")


def label_encode(df: DataFrame, column: str, output: str) -> DataFrame:
    """Add the number of each value among the distinct values in order; NULL stays NULL.

    Adaptive execution broadcasts codes of few bytes; otherwise it splits the partitions of hot values and of NULL.
    """
    return with_codes(df, column, categories(df, column), output)


def with_codes(df: DataFrame, column: str, codes: DataFrame, output: str) -> DataFrame:
    """Add the code of each value from ``categories`` of another frame, such as the training part; NULL if it has none."""
    return df.join(codes.select(F.col("value").alias(column), F.col("code").alias(output)), column, "left")
