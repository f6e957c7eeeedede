"""Event tables stored for repeated feature runs: a folder per day, and within it buckets of users.

A read up to a time skips the folders of later days. Whatever groups or joins by user finds all rows of a user in one bucket and
needs no shuffle; two tables of as many buckets join bucket by bucket. Only an upper bound of time may be used: features look back without limit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

DAY = "event_date"


def write_events(
    df: DataFrame, name: str, path: str, buckets: int, ts: str = "event_dt_utc", user: str = "user_id"
) -> None:
    """Store events as the table ``name`` in the folder ``path``; one file per day and bucket, sorted by user and time.

    Rows are dealt by day and bucket first, so that a task writes whole files; adaptive execution does not split them. Events
    without a time are in a folder of their own and are part of no read up to a time.
    """
    if DAY in df.columns:
        raise ValueError(f"'{DAY}' is the name of the day folders: rename the column")
    dated = df.withColumn(DAY, F.to_date(ts))
    dealt = dated.repartition(F.col(DAY), F.pmod(F.hash(user), F.lit(buckets)))
    writer = dealt.write.mode("overwrite").option("path", path).partitionBy(DAY)
    writer.bucketBy(buckets, user).sortBy(user, ts).saveAsTable(name)


def attach_events(
    spark: SparkSession, name: str, path: str, buckets: int, ts: str = "event_dt_utc", user: str = "user_id"
) -> None:
    """Make a stored folder known as the table ``name`` in a session whose catalog lacks it; ``buckets`` as it was written."""
    fields = spark.read.parquet(path).schema
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY ({DAY}) "
        f"CLUSTERED BY ({user}) SORTED BY ({user}, {ts}) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    spark.catalog.recoverPartitions(name)


def read_events(spark: SparkSession, name: str, upto=None, ts: str = "event_dt_utc") -> DataFrame:
    """A stored table; with ``upto`` only events up to that time, of which later days are not even listed."""
    df = spark.table(name)
    if upto is not None:
        bound = F.lit(upto).cast(df.schema[ts].dataType)
        df = df.where((F.col(DAY) <= F.to_date(bound)) & (F.col(ts) <= bound))
    return df.drop(DAY)
