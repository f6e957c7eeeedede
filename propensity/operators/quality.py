"""Data-quality and label-leakage checks. Each group of checks is one pass over the data."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from propensity.functions.scalars import non_finite_to_null
from propensity.operators.cleaning import column_report, drop_columns, numeric_columns
from propensity.operators.ranking import values_at_ranks

#: A perfect correlation may come out a rounding error below 1.
PERFECT = 1 - 1e-12

_FLOATING = (T.FloatType, T.DoubleType)


def _kind(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def _is_missing(df: DataFrame, name: str) -> Column:
    value = F.col(name)
    if isinstance(_kind(df, name), _FLOATING):
        return value.isNull() | F.isnan(value)
    return value.isNull()


def _require(df: DataFrame, label: str) -> None:
    if label not in df.columns:
        raise ValueError(f"label column '{label}' not found")


def shape(df: DataFrame) -> DataFrame:
    """Rows, columns, and per column its place, type and number of values."""
    return column_report(
        df,
        ordinal=lambda name: F.max(F.lit(df.columns.index(name) + 1)),
        data_type=lambda name: F.max(F.lit(_kind(df, name).simpleString())),
        non_null=lambda name: F.count_if(~_is_missing(df, name)),
        n_rows=lambda name: F.count(F.lit(1)),
    ).withColumn("n_columns", F.lit(len(df.columns)))


def missing(df: DataFrame) -> DataFrame:
    """Missing values per column."""
    return column_report(df, missing=lambda name: F.count_if(_is_missing(df, name)))


def non_finite(df: DataFrame) -> DataFrame:
    """NaN and infinite values per floating column."""

    def count(name: str) -> Column | None:
        if not isinstance(_kind(df, name), _FLOATING):
            return None
        value = F.col(name)
        return F.count_if(value.isNotNull() & non_finite_to_null(value).isNull())

    return column_report(df, non_finite=count)


def duplicates(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row in every column; NULLs are equal to each other.

    Digests of all rows are counted first, and only rows whose digest occurs twice are compared as a whole.
    """
    digest = F.xxhash64(*df.columns)
    repeated = df.select(digest.alias("digest")).groupBy("digest").count().where("count > 1").select("digest")
    rows = df.select(F.struct(*df.columns).alias("row"), digest.alias("digest")).join(repeated, "digest", "left_semi")
    copies = rows.groupBy("row").agg(F.count(F.lit(1)).alias("copies"))
    extra = F.coalesce(F.sum(F.col("copies") - 1), F.lit(0))
    return copies.agg(extra.alias("duplicated_rows"))


def label_distribution(df: DataFrame, label: str) -> DataFrame:
    """Rows per label value; missing labels are not counted."""
    _require(df, label)
    known = df.where(~_is_missing(df, label))
    return known.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))


def identical_to_label(df: DataFrame, label: str) -> DataFrame:
    """For each column of the label's type: does it equal the label in every row, NULLs included?"""
    _require(df, label)

    def same(name: str) -> Column | None:
        if name == label or _kind(df, name) != _kind(df, label):
            return None
        return F.coalesce(F.bool_and(F.col(name).eqNullSafe(F.col(label))), F.lit(True))

    return column_report(df, is_identical=same)


def label_correlation(df: DataFrame, label: str) -> DataFrame:
    """Absolute correlation of every numeric column with the label, strongest first.

    NULL where it is undefined: a constant column or label, fewer than two pairs, or infinities.
    """
    _require(df, label)
    names = numeric_columns(df, excluded=[label])

    def number(name: str) -> Column:
        value = F.col(name).cast("double")
        return F.when(~F.isnan(value), value).alias(name)

    y = F.col(label)
    known = df.select(number(label), *map(number, names)).where(y.isNotNull())

    def correlation(name: str) -> Column | None:
        if name == label:
            return None
        x = F.col(name)
        paired = F.when(x.isNotNull(), y)
        varies = (F.min(x) < F.max(x)) & (F.min(paired) < F.max(paired))
        finite = F.max(F.abs(x)) < float("inf")
        spread = F.when(varies & finite, F.stddev_pop(x) * F.stddev_pop(paired))
        strength = F.abs(F.try_divide(F.covar_pop(x, y), spread))
        return F.when(strength > 1, F.lit(1.0)).otherwise(strength)

    return column_report(known, correlation=correlation).orderBy(
        F.desc_nulls_last("correlation"), "column_name"
    )


def perfect_correlation(df: DataFrame, label: str) -> DataFrame:
    """Columns that correlate perfectly with the label: likely leaks."""
    return label_correlation(df, label).where(F.col("correlation") >= PERFECT)


def drop_leakage(df: DataFrame, known: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The frame without the known leaks, and the names dropped. The input stays as it is."""
    return drop_columns(df, known), [name for name in known if name in df.columns]


def describe(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, deviation, extremes and exact interpolated quartiles per numeric column."""
    names = list(names) if names is not None else numeric_columns(df)
    quarters = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    plain = df.select(
        *[F.when(~F.isnan(F.col(n).cast("double")), F.col(n).cast("double")).alias(n) for n in names]
    )
    sizes = plain.agg(*[F.count(n).alias(n) for n in names]).first().asDict()
    places = {
        (n, q): (sizes[n] - 1) * share for n in names if sizes[n] for q, share in quarters.items()
    }
    wanted = {
        n: [rank for q in quarters for p in [places[n, q]] for rank in (math.floor(p) + 1, math.ceil(p) + 1)]
        for n in names
        if sizes[n]
    }
    at = values_at_ranks(plain, wanted)

    def quartile(n: str, q: str) -> Column:
        if not sizes[n]:
            return F.max(F.lit(None).cast("double"))
        place = places[n, q]
        low, high = at[n, math.floor(place) + 1], at[n, math.ceil(place) + 1]
        return F.max(F.lit(float(low + (high - low) * (place - math.floor(place)))))

    return column_report(
        plain,
        count=lambda n: F.count(n),
        mean=lambda n: F.avg(n),
        std=lambda n: F.stddev(n),
        min=lambda n: F.min(n),
        **{q: (lambda n, q=q: quartile(n, q)) for q in quarters},
        max=lambda n: F.max(n),
    )


def perfect_metrics(metrics: DataFrame) -> DataFrame:
    """Flag a metrics row that is too good: all scores 1 and AUC 1, or 0 for want of a class."""
    scores = [F.col(n) == 1.0 for n in ("accuracy", "precision", "recall", "f1")]
    flag = scores[0] & scores[1] & scores[2] & scores[3] & F.col("auc").isin(0.0, 1.0)
    return metrics.withColumn("is_suspicious", flag)


def data_checks(df: DataFrame, label: str, known_leaks: Sequence[str] = ()) -> dict[str, DataFrame]:
    """All checks, each a small frame. The reduced data comes first, under ``data``."""
    reduced, dropped = drop_leakage(df, known_leaks)
    _require(reduced, label)
    checks = {
        "data": reduced,
        "shape": shape(df),
        "missing": missing(reduced),
        "duplicates": duplicates(reduced),
        "label_distribution": label_distribution(reduced, label),
    }
    if any(_kind(reduced, n) == _kind(reduced, label) for n in reduced.columns if n != label):
        checks["identical_to_label"] = identical_to_label(reduced, label)
    if numeric_columns(reduced, excluded=[label]):
        checks["label_correlation"] = label_correlation(reduced, label)
        checks["perfect_correlation"] = perfect_correlation(reduced, label)
    checks["dropped"] = df.sparkSession.createDataFrame([(n,) for n in dropped], "column_name string")
    return checks
