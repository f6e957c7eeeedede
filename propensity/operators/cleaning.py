"""Cleaning and typing of training and scoring frames."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from propensity.functions.scalars import blank_to_null, non_finite_to_null

#: Columns a label is derived from, or that identify the user: they would leak into training.
#: Fixed names of the inputs, which must be these.
LABEL_SOURCES = (
    "total_conversions_after_30d",
    "total_revenue_after_30d",
    "total_quantity_after_30d",
    "total_conversions_30d",
    "total_revenue_30d",
    "total_quantity_30d",
    "total_conversions_15d",
    "total_revenue_15d",
    "total_quantity_15d",
    "total_conversions_3d",
    "total_revenue_3d",
    "total_quantity_3d",
)
#: Fixed names of the inputs as well.
IDENTIFIERS = (
    "user_id",
    "user_id_type",
    "customer_search_term",
    "dma_code",
    "postal_code",
    "device_type",
    "browser_family",
    "operating_system",
)
#: What training leaves out by default.
NOT_FEATURES = (*LABEL_SOURCES, *IDENTIFIERS)


def columns_of(df: DataFrame, *kinds: type[T.DataType]) -> list[str]:
    return [field.name for field in df.schema if isinstance(field.dataType, kinds)]


def numeric_columns(df: DataFrame, excluded: Iterable[str] = ()) -> list[str]:
    """Columns of a declared numeric type; booleans and strings are not features."""
    skip = set(excluded)
    return [name for name in columns_of(df, T.NumericType) if name not in skip]


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop what is there, ignore what is not."""
    return df.drop(*names)


def column_report(df: DataFrame, **measures) -> DataFrame:
    """One row per column from a single aggregation of the data.

    Each measure maps a column name to an aggregate, or to None to leave the column out.
    """
    wanted = {
        name: {measure: make(name) for measure, make in measures.items()} for name in df.columns
    }
    wanted = {
        name: made for name, made in wanted.items() if all(v is not None for v in made.values())
    }
    if not wanted:
        raise ValueError("no column qualifies for this report")
    row = df.agg(
        *[
            value.alias(f"{measure}_{i}")
            for i, made in enumerate(wanted.values())
            for measure, value in made.items()
        ]
    )
    entries = [
        F.struct(
            F.lit(name).alias("column_name"),
            *[F.col(f"{measure}_{i}").alias(measure) for measure in made],
        )
        for i, (name, made) in enumerate(wanted.items())
    ]
    return row.select(F.inline(F.array(*entries)))


def _is_empty(df: DataFrame, name: str) -> Column:
    """True when no row holds a value other than NULL, NaN, zero or false."""
    kind, value = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.NumericType):
        filled = value != 0
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            filled = filled & ~F.isnan(value)
    elif isinstance(kind, T.BooleanType):
        filled = value
    else:
        filled = value.isNotNull()
    return ~F.coalesce(F.bool_or(filled), F.lit(False))


def empty_report(df: DataFrame) -> DataFrame:
    """Which columns are NULL or zero in every row."""
    return column_report(df, is_empty=lambda name: _is_empty(df, name))


def drop_empty(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Drop the columns that are NULL or zero in every row, except ``keep``; one small job."""
    flags = df.agg(*[_is_empty(df, name).alias(name) for name in df.columns]).first()
    return df.drop(*[n for n in df.columns if flags[n] and n not in keep])


def infinities_to_null(df: DataFrame) -> DataFrame:
    """NaN and infinities of floating columns become NULL."""
    return df.withColumns(
        {name: non_finite_to_null(F.col(name)) for name in columns_of(df, T.FloatType, T.DoubleType)}
    )


def blanks_to_null(df: DataFrame) -> DataFrame:
    """Blank strings become NULL."""
    return df.withColumns({name: blank_to_null(F.col(name)) for name in columns_of(df, T.StringType)})


def fill_zero(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    return df.na.fill(0, subset=list(names) if names is not None else numeric_columns(df))


def target(column: Column) -> Column:
    """The label as an integer; a missing label is 0 and fractions are cut off."""
    return F.coalesce(F.when(~F.isnan(column.cast("double")), column), F.lit(0)).cast("int")


def high_potential(conversions: Column, revenue: Column) -> Column:
    """1 when the user converted or spent anything, else 0; missing counts as nothing."""
    bought = (F.coalesce(conversions, F.lit(0)) > 0) | (F.coalesce(revenue, F.lit(0.0)) > 0)
    return bought.cast("int")


def parse_timestamp(text: Column) -> Column:
    """Text that is not a time becomes NULL."""
    return F.try_to_timestamp(text)


def names_of(key: str | Sequence[str] | None) -> list[str]:
    """The columns of a key: one, several or none."""
    return [] if key is None else [key] if isinstance(key, str) else list(key)


def clean(
    df: DataFrame, label: str | None = None, key: str | Sequence[str] | None = "user_id", drop: Sequence[str] = (), texts: Sequence[str] = ()
) -> DataFrame:
    """A model-ready frame: the key, the integer label, numeric features without NULLs, and ``texts`` with blanks as NULL."""
    kept = list(dict.fromkeys(name for name in (*names_of(key), *([label] if label else []), *texts) if name in df.columns))
    df = drop_columns(df, [name for name in drop if name not in kept])
    df = blanks_to_null(infinities_to_null(drop_empty(df, keep=kept)))
    features = numeric_columns(df, excluded=kept)
    if label in kept:
        df = df.withColumn(label, target(F.col(label)))
    return fill_zero(df.select(*kept, *features), features)


def features_of(df: DataFrame, label: str | None = None, key: str | Sequence[str] | None = "user_id") -> list[str]:
    return numeric_columns(df, excluded=[*names_of(key), *([label] if label else [])])
