"""Input contracts: the columns and types the features expect of each event table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

TRAFFIC = {
    "user_id": None,
    "event_dt_utc": "timestamp",
    "ad_product_type": "string",
    "campaign_id_string": "string",
    "customer_search_term": "string",
    "impressions": "integer",
    "clicks": "integer",
}
CONVERSIONS = {
    "user_id": None,
    "event_dt_utc": "timestamp",
    "event_subtype": "string",
    "conversions": "integer",
    "total_product_sales": "money",
    "total_units_sold": "integer",
}
AUDIENCE_CONVERSIONS = {
    "user_id": None,
    "event_date_utc": "date",
    "event_subtype": "string",
    "total_product_sales": "money",
    "total_units_sold": "integer",
}
DISPLAY_IMPRESSIONS = {
    "user_id": None,
    "impressions": "integer",
    "impression_dt_utc": "timestamp",
    "campaign_id": None,
}
DISPLAY_CLICKS = {
    "user_id": None,
    "clicks": "integer",
    "click_dt_utc": "timestamp",
    "campaign_id": None,
}

_ACCEPTED = {
    "timestamp": ((T.TimestampType, T.TimestampNTZType), "timestamp"),
    "date": ((T.DateType,), "date"),
    "integer": ((T.IntegralType,), "bigint"),
    "money": ((T.DecimalType, T.FractionalType), "double"),
    "string": ((T.StringType,), "string"),
}


def conform(df: DataFrame, contract: dict[str, str | None]) -> DataFrame:
    """Select the contract's columns; cast only a column that has another type.

    A column that already fits is left bare, so that filters on it still reach the scan.
    """
    missing = [name for name in contract if name not in df.columns]
    if missing:
        raise ValueError(f"input lacks the columns {missing}")
    columns = []
    for name, kind in contract.items():
        column = F.col(name)
        if kind is not None:
            accepted, target = _ACCEPTED[kind]
            if not isinstance(df.schema[name].dataType, accepted):
                column = column.cast(target).alias(name)
        columns.append(column)
    return df.select(*columns)


def read_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def time_range(df: DataFrame, ts: str, start, end) -> DataFrame:
    """Rows with ``start <= ts < end``; the bounds take the column's own type for pushdown."""
    kind = df.schema[ts].dataType
    return df.where((F.col(ts) >= F.lit(start).cast(kind)) & (F.col(ts) < F.lit(end).cast(kind)))


def user_pull(df: DataFrame, ts: str, start, end, limit: int, user: str = "user_id") -> DataFrame:
    """The first ``limit`` user rows of a time range, in user order."""
    return time_range(df, ts, start, end).select(user).orderBy(user).limit(limit)
