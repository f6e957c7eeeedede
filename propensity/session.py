"""Session settings and the shared folder for data that must outlive an executor."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import TimestampNTZType


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session zone: all second arithmetic here assumes UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def require_utc(df: DataFrame, ts: str) -> None:
    """Times without a zone are taken as the session's: in any other zone than UTC, hours that a change of clocks skips would be lost."""
    zone = df.sparkSession.conf.get("spark.sql.session.timeZone")
    if isinstance(df.schema[ts].dataType, TimestampNTZType) and zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"'{ts}' has no zone and the session is in {zone}: set spark.sql.session.timeZone to UTC (use_utc)")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A folder of our own is made only on a local master where none is named; on a cluster a
    machine-local folder would be lost with its machine, so that case is an error.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="propensity-"))
    return context.getCheckpointDir()


def _folders(spark: SparkSession) -> list[str]:
    """Folders of the scopes that are open, outermost first."""
    context = spark.sparkContext
    if not hasattr(context, "_propensity_scratch"):
        context._propensity_scratch = []
    return context._propensity_scratch


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is materialized inside goes to a folder of its own, deleted at the end; results are written with ``outer=True``.

    Nothing that is read later may depend on a frame written inside, unless it was written out.
    """
    folders = _folders(spark)
    folders.append(f"{folders[-1] if folders else checkpoint_dir(spark)}/scratch-{uuid.uuid4().hex}")
    try:
        yield
    finally:
        _delete(spark, folders.pop())


def scratch_path(spark: SparkSession, name: str, outer: bool = False) -> str:
    """A new, unused path in the shared folder, within the open scope or, with ``outer``, the one around it."""
    folders = _folders(spark)[: -1 if outer else None]
    return f"{folders[-1] if folders else checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, partition_by: str | None = None, outer: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors.

    ``partition_by`` names its last column; readers that filter on it skip the other files. ``outer`` writes outside the open ``scratch``.
    """
    path = scratch_path(df.sparkSession, name, outer)
    df.write.partitionBy(*([partition_by] if partition_by else [])).parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back._propensity_path = path
    return back


def discard(*frames: DataFrame) -> None:
    """Delete the files of materialized frames that nothing will read again."""
    for df in frames:
        _delete(df.sparkSession, df._propensity_path)
