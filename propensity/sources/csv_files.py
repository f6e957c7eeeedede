"""CSV directories united by column name, and the CSV prediction sink."""

from __future__ import annotations

import csv
from collections.abc import Iterator
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

#: More than any file: one file is one task, which stops after its first lines.
_WHOLE_FILES = str(1 << 50)


def _first_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``path, line`` of the first line with text of every ``*.csv`` file, from one job that reads no further.

    A session of its own holds the file settings: the caller's stay as they are.
    """
    session = spark.newSession()
    for setting in ("maxPartitionBytes", "openCostInBytes"):
        session.conf.set(f"spark.sql.files.{setting}", _WHOLE_FILES)
    session.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 16)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, line in enumerate(batch.column(1).to_pylist()):
                if line.strip():
                    yield batch.slice(at, 1)
                    return

    lines = session.read.option("pathGlobFilter", "*.csv").text(paths)
    return lines.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("line")).mapInArrow(first, "path string, line string")


def _names(line: str) -> tuple[str, ...]:
    """Column names of a header line; empty and repeated ones get their place, as Spark names them."""
    names = next(csv.reader([line.lstrip("\ufeff")], skipinitialspace=False))
    again = [n.lower() for n in names]
    return tuple(f"_c{i}" if not n else f"{n}{i}" if again.count(n.lower()) > 1 else n for i, n in enumerate(names))


def csv_groups(spark: SparkSession, paths: str | list[str]) -> dict[tuple[str, ...], list[str]]:
    """Paths of the files of each header, both in order; files without a line are left out. One job, however many files there are."""
    alike = _first_lines(spark, paths).groupBy("line").agg(F.sort_array(F.collect_list("path")).alias("paths")).collect()
    groups: dict[tuple[str, ...], list[str]] = {}
    for row in sorted(alike, key=lambda r: r.paths[0]):
        groups.setdefault(_names(row.line), []).extend(unquote(path) for path in row.paths)
    return groups


def read_csv(
    spark: SparkSession, paths: str | list[str], schema: dict[str, str] | None = None, header: tuple[str, ...] | None = None
) -> DataFrame:
    """Read CSV files that share one header.

    ``schema`` maps column names to types; columns it does not name are strings. Without it
    types are inferred, which costs one more pass over the files.
    """
    if schema is None:
        return spark.read.csv(paths, header=True, inferSchema=True)
    if header is None:
        header = next(iter(csv_groups(spark, paths if isinstance(paths, str) else paths[0])))
    fields = [f"`{name}` {schema.get(name, 'string')}" for name in header]
    return spark.read.csv(paths, header=True, schema=", ".join(fields))


def read_csv_directory(
    spark: SparkSession, directory: str, schema: dict[str, str] | None = None
) -> DataFrame:
    """Every CSV file of a directory, united by column name; absent columns are NULL.

    A plain directory read matches columns by position, so files are grouped by their header
    line first and each group is one scan. All headers are read by one job; types are inferred once a group.
    """
    groups = csv_groups(spark, directory)
    if not groups:
        raise FileNotFoundError(f"no CSV files in {directory}")
    parts = [read_csv(spark, members, schema, header) for header, members in groups.items()]
    if schema is None:
        parts = _without_empty(parts)
    united = reduce(
        lambda left, right: left.unionByName(right, allowMissingColumns=True), _widen(parts)
    )
    names = dict.fromkeys(name for header in groups for name in header)
    lost = [name for name in names if name not in united.columns]
    return united.withColumns({name: F.lit(None).cast("string") for name in lost}).select(*names)


def _without_empty(parts: list[DataFrame]) -> list[DataFrame]:
    """Leave out text columns without a value where another group has numbers: they say nothing about the type."""
    kinds = [dict(part.dtypes) for part in parts]
    out = []
    for part, own in zip(parts, kinds):
        doubtful = [n for n, kind in own.items() if kind == "string" and any(k.get(n, kind) != kind for k in kinds)]
        if doubtful:
            filled = part.agg(*[F.count(F.col(f"`{n}`")).alias(f"n{i}") for i, n in enumerate(doubtful)]).first()
            part = part.drop(*[n for i, n in enumerate(doubtful) if not filled[i]])
        out.append(part)
    return out


def _widen(parts: list[DataFrame]) -> list[DataFrame]:
    """Give a column one type across the groups: double for mixed numbers, else string."""
    kinds: dict[str, set[T.DataType]] = {}
    for part in parts:
        for field in part.schema:
            kinds.setdefault(field.name, set()).add(field.dataType)
    target = {
        name: "double" if all(isinstance(kind, T.NumericType) for kind in seen) else "string"
        for name, seen in kinds.items()
        if len(seen) > 1
    }
    return [
        part.withColumns({n: part[n].cast(target[n]) for n in part.columns if n in target})
        for part in parts
    ]


def write_predictions(scored: DataFrame, path: str) -> None:
    """``user_id, prediction, probability`` as CSV with a header, one file per partition."""
    names = [n for n in ("user_id", "prediction", "probability") if n in scored.columns]
    scored.select(*names).write.mode("overwrite").csv(path, header=True)


def write_audience(scored: DataFrame, path: str, format: str = "parquet") -> None:
    """Features together with ``predicted_high_potential`` and ``predicted_probability``."""
    renamed = scored.withColumnsRenamed(
        {"prediction": "predicted_high_potential", "probability": "predicted_probability"}
    )
    renamed.write.mode("overwrite").format(format).option("header", True).save(path)
