"""Stratified splits, folds, class weights and oversampling.

Everything is decided by a seeded hash of a row's identity, so a run gives the same rows whatever the partitioning, and a lost
task recomputes the same result. A class may hold nearly all rows, and there may be any number of classes: cuts, counts and
weights are tables with a few rows per class, written first, and joined by the class. Small ones are sent to the rows, which then
stay where they are; others meet the rows by a shuffle whose hot classes adaptive execution splits.

The identity of a row is its key, of one column or several. Without a key it is a 128-bit digest of the whole row and, among
equal rows, a number: equal rows are counted, not numbered, and the copies of a row that a cut divides are made again from their count.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from propensity.functions.scalars import hash_number, in_share, row_digest
from propensity.operators.ranking import hash_cuts, hash_order, hash_range, ranges_before
from propensity.session import materialize, scratch

#: Copies of a row, or draws of a class, that are made in one piece.
PIECE = 65_536

Key = str | Sequence[str] | None


def identity(df: DataFrame, key: Key) -> list[Column]:
    """The columns that tell a row: those of ``key``, or its digest."""
    if key is None:
        return [row_digest(df)]
    return [F.col(key)] if isinstance(key, str) else [F.col(k) for k in key]


def class_counts(df: DataFrame, label: str) -> DataFrame:
    """``label, n``: rows per class; a NULL is no class."""
    counts = df.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    return materialize(counts, "classes")


def _of_class(df: DataFrame, label: str, table: DataFrame, how: str = "left") -> DataFrame:
    """Join a written table of classes; rows of a NULL label find nothing."""
    named = table.withColumnRenamed("label", "_class")
    return df.join(named, F.col(label) == F.col("_class"), how).drop("_class")


def _cut(df: DataFrame, label: str, key: Key, ranks: Callable[[Column], Sequence[Column]], seed: int) -> DataFrame:
    """Add ``cuts_before``: how many of the ``ranks`` of its class a row is beyond; NULL for classes without a cut.

    Rows that share a given key stay together: what a cut divides goes before it. Without a key equal rows are divided exactly.
    """
    place = hash_order(identity(df, key), seed)
    with scratch(df.sparkSession):
        rows = materialize(df.where(F.col(label).isNotNull()).select(F.col(label).alias("label"), place.alias("place")), "places")
        found = hash_cuts(rows, ranks)
        if key is not None:
            found = found.withColumn("of_ties", F.col("ties"))
        cuts = found.groupBy("label").agg(
            F.collect_list(F.struct("cut", "of_ties")).alias("_cuts"),
            F.collect_set(F.when(F.col("of_ties") < F.col("ties"), F.col("cut"))).alias("_divided"),
        )
        cuts = materialize(cuts, "cuts", outer=True)
    placed = _of_class(df.withColumn("_place", place), label, cuts)

    def before(copy: Column) -> Column:
        beyond = F.filter("_cuts", lambda c: (c["cut"] < F.col("_place")) | ((c["cut"] == F.col("_place")) & (c["of_ties"] < copy)))
        return F.when(F.col("_cuts").isNotNull(), F.size(beyond)).alias("cuts_before")

    if key is not None or cuts.where(F.size("_divided") > 0).isEmpty():
        return placed.select(*df.columns, before(F.lit(1)))
    divided = F.coalesce(F.exists("_divided", lambda cut: cut == F.col("_place")), F.lit(False))
    counted = placed.where(divided).groupBy(*df.columns, "_place", "_cuts").agg(F.count(F.lit(1)).alias("_times"))
    copies = _repeated(counted, "_times").select(*df.columns, before(F.col("_copy")))
    return placed.where(~divided).select(*df.columns, before(F.lit(1))).unionByName(copies)


def _repeated(df: DataFrame, times: str) -> DataFrame:
    """Each row as often as ``times`` says, numbered from 1 in ``_copy``. A row of very many copies is dealt out in pieces."""
    piece, size = F.col("_piece") * PIECE, F.lit(PIECE)
    return (
        df.withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(times) - 1) / PIECE))))
        .repartition(times, "_piece", *[c for c in ("_place", "_draw") if c in df.columns])
        .withColumn("_copy", F.explode(F.sequence(piece + 1, F.least(piece + size, F.col(times)))))
    )


def stratified_split(df: DataFrame, label: str, key: Key = "user_id", test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """Add ``is_test``: exactly the rounded share of every class, chosen by hash order; false for rows of no class.

    ``key`` is a column, several that tell a row together, or None for rows without a key; sizes are exact if it is unique or None.
    """
    split = _cut(df, label, key, lambda total: [F.floor(total * F.lit(float(test_size)) + 0.5)], seed)
    return split.select(*df.columns, F.coalesce(F.col("cuts_before") == 0, F.lit(False)).alias("is_test"))


def split_by_group(
    df: DataFrame, label: str, group: str = "user_id", test_size: float = 0.2, seed: int = 42
) -> DataFrame:
    """Add ``is_test`` so that all rows of a group are on one side, such as the snapshots of a user.

    A group is of the class of its largest label; of the groups of every class exactly the rounded share is for the test. Rows of no
    group or without any label are not.
    """
    groups = df.where(F.col(group).isNotNull()).groupBy(group).agg(F.max(label).alias("_label"))
    sides = stratified_split(materialize(groups, "groups"), "_label", group, test_size, seed)
    sides = sides.select(F.col(group).alias("_group"), "is_test")
    joined = df.join(sides, F.col(group) == F.col("_group"), "left")
    return joined.select(*df.columns, F.coalesce("is_test", F.lit(False)).alias("is_test"))


def hash_split(df: DataFrame, key: Key = "user_id", test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """Add ``is_test`` by a hash threshold: shares are met on average, with no pass over the data."""
    told = identity(df, key)
    return df.withColumn("is_test", in_share(told[0] if len(told) == 1 else F.concat_ws("-", *told), test_size, seed))


def stratified_folds(df: DataFrame, label: str, key: Key = "user_id", folds: int = 5, seed: int = 42) -> DataFrame:
    """Add ``fold`` (0 to folds - 1); within a class fold sizes differ by at most one. NULL for rows of no class."""

    def ends(total: Column) -> list[Column]:
        each, more = F.floor(total / folds), total % folds
        return [each * f + F.least(F.lit(f), more) for f in range(1, folds)]

    return _cut(df, label, key, ends, seed).withColumnRenamed("cuts_before", "fold")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Add ``class_weight``: rows / (classes x rows of the class); NULL for rows of no class."""
    counts = class_counts(df, label)
    whole = counts.agg(F.sum("n").alias("rows"), F.count("*").alias("classes")).first()
    weight = F.lit(float(whole["rows"] or 0)) / (F.lit(float(whole["classes"])) * F.col("n"))
    return _of_class(df, label, counts.select("label", weight.alias("class_weight")))


def _numbered(df: DataFrame, label: str, key: Key, seed: int) -> DataFrame:
    """Add ``_class`` and ``_draw``: 0, 1, 2 ... in hash order within each class, without gaps.

    Rows are numbered inside each of 65,536 hash ranges of a class, and a range starts where those before it end. Rows that
    share a key go by a hash of the whole row, so that a task computed again gives the same numbers.
    """
    placed = df.withColumns({"_class": F.col(label), "_place": hash_order(identity(df, key), seed)})
    ranges = ranges_before(placed.select(F.col("_class").alias("label"), F.col("_place").alias("place")))
    offsets = ranges.select(F.col("label").alias("_class"), F.col("hash_range").alias("_range"), (F.col("upto") - F.col("count")).alias("_offset"))
    in_range = Window.partitionBy("_class", "_range").orderBy("_place", F.xxhash64(*df.columns))
    return (
        placed.withColumn("_range", hash_range(F.col("_place.hash")))
        .withColumn("_within", F.row_number().over(in_range) - 1)
        .join(offsets, ["_class", "_range"])
        .select(*df.columns, "_class", (F.col("_offset") + F.col("_within")).alias("_draw"))
    )


def oversample(df: DataFrame, label: str, key: Key = "user_id", seed: int = 42) -> DataFrame:
    """Draw every smaller class with replacement up to the size of the largest.

    Classes of the largest size are kept once. Draws are made in parallel and counted by the number drawn, so that a number meets its
    row once however often it is drawn. A NULL label is of no class: it is an error, as its rows would be lost.
    """
    if not df.where(F.col(label).isNull()).isEmpty():
        raise ValueError(f"'{label}' has NULLs: fill or drop them first")
    counts = class_counts(df, label)
    largest = counts.agg(F.max("n")).first()[0]
    smaller = counts.where(F.col("n") < F.lit(largest))
    if largest is None or smaller.isEmpty():
        return df
    first = F.col("_piece") * PIECE
    draws = (
        smaller.withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("long"), F.lit((largest - 1) // PIECE))))
        .repartition("label", "_piece")
        .withColumn("_id", F.explode(F.sequence(first, F.least(first + PIECE, F.lit(largest)) - 1)))
        .select(F.col("label").alias("_class"), F.pmod(hash_number(F.col("_id"), seed), F.col("n")).alias("_draw"))
        .groupBy("_class", "_draw")
        .agg(F.count(F.lit(1)).alias("_times"))
    )
    kept = _of_class(df, label, smaller.select("label"), "left_anti")
    numbered = _numbered(_of_class(df, label, smaller.select("label"), "left_semi"), label, key, seed)
    return kept.unionByName(_repeated(numbered.join(draws, ["_class", "_draw"]), "_times").select(*df.columns))
