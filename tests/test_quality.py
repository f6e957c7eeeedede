"""Checks and cleaning on small frames with every kind of odd value."""


import pytest
from pyspark.sql import functions as F

from propensity.operators import cleaning, quality

NAN, INF = float("nan"), float("inf")


@pytest.fixture(scope="module")
def odd(spark):
    rows = [
        ("a", 1, 1, 5.0, NAN, 2.0, " ", True),
        ("b", 0, 0, 5.0, NAN, INF, "x", False),
        ("c", 1, 1, 5.0, NAN, 4.0, "", None),
        ("c", 1, 1, 5.0, NAN, 4.0, "", None),
        ("d", None, None, 5.0, NAN, None, None, True),
    ]
    return spark.createDataFrame(
        rows, "user_id string, y int, copy int, flat double, nan double, wild double, s string, b boolean"
    )


def _by_name(df, value):
    return {r.column_name: r[value] for r in df.collect()}


def test_missing_counts_nan(odd):
    assert _by_name(quality.missing(odd), "missing") == {
        "user_id": 0, "y": 1, "copy": 1, "flat": 0, "nan": 5, "wild": 1, "s": 1, "b": 2
    }


def test_shape(odd):
    row = quality.shape(odd).where("column_name = 'wild'").first()
    assert (row.ordinal, row.data_type, row.non_null, row.n_rows, row.n_columns) == (6, "double", 4, 5, 8)


def test_duplicates_compare_missing_values_as_equal(odd):
    assert quality.duplicates(odd).first().duplicated_rows == 1
    assert quality.duplicates(odd.limit(0)).first().duplicated_rows == 0


def test_rows_of_one_digest_are_compared_as_a_whole(spark):
    """A NULL leaves the digest as it is, so these rows share one."""
    df = spark.createDataFrame([(None, 1), (1, None), (1, None), (2, 2)], "a int, b int")
    assert quality.duplicates(df).first().duplicated_rows == 1


def test_label_distribution_leaves_out_missing(odd):
    assert {r.label: r.n for r in quality.label_distribution(odd, "y").collect()} == {0: 1, 1: 3}


def test_a_missing_label_is_an_error(odd):
    for check in (quality.label_distribution, quality.identical_to_label, quality.label_correlation):
        with pytest.raises(ValueError, match="nowhere"):
            check(odd, "nowhere")


def test_identical(odd):
    assert _by_name(quality.identical_to_label(odd, "y"), "is_identical") == {"copy": True}


def test_correlation_is_undefined_for_constants_nan_and_infinities(odd):
    assert _by_name(quality.label_correlation(odd, "y"), "correlation") == {
        "copy": pytest.approx(1.0), "flat": None, "nan": None, "wild": None
    }
    assert [r.column_name for r in quality.perfect_correlation(odd, "y").collect()] == ["copy"]


def test_correlation_with_one_class(odd):
    assert set(_by_name(quality.label_correlation(odd.where("y = 1"), "y"), "correlation").values()) == {None}


def test_non_finite(odd):
    assert _by_name(quality.non_finite(odd), "non_finite") == {"flat": 0, "nan": 5, "wild": 1}


def test_data_checks_do_not_change_the_input(odd):
    checks = quality.data_checks(odd, "y", ["copy", "absent"])
    assert "copy" in odd.columns and "copy" not in checks["data"].columns
    assert [r.column_name for r in checks["dropped"].collect()] == ["copy"]
    assert "identical_to_label" not in checks


def test_drop_empty_keeps_the_label(spark, odd):
    zero = odd.withColumn("y", F.lit(0)).withColumn("z", F.lit(0)).withColumn("f", F.lit(False))
    kept = cleaning.drop_empty(zero, keep=["y"]).columns
    assert kept == ["user_id", "y", "copy", "flat", "wild", "s", "b"]


def test_clean(odd):
    df = cleaning.clean(odd, "y", drop=["copy"])
    assert df.columns == ["user_id", "y", "flat", "wild"]
    rows = sorted(tuple(r) for r in df.collect())
    assert rows == [
        ("a", 1, 5.0, 2.0), ("b", 0, 5.0, 0.0), ("c", 1, 5.0, 4.0), ("c", 1, 5.0, 4.0), ("d", 0, 5.0, 0.0)
    ]


def test_clean_without_a_label(odd):
    assert cleaning.clean(odd.drop("y")).columns == ["user_id", "copy", "flat", "wild"]


def test_target_cuts_fractions(spark):
    df = spark.createDataFrame([(1.9,), (None,), (NAN,), (0.0,)], "y double")
    assert [r[0] for r in df.select(cleaning.target(F.col("y"))).collect()] == [1, 0, 0, 0]


def test_high_potential(spark):
    df = spark.createDataFrame([(1, None), (None, 2.0), (0, 0.0), (None, None)], "c int, r double")
    label = cleaning.high_potential(F.col("c"), F.col("r"))
    assert [r[0] for r in df.select(label).collect()] == [1, 1, 0, 0]


def test_bad_times_become_null(spark):
    df = spark.createDataFrame([("2024-01-02 03:04:05",), ("soon",), (None,)], "t string")
    assert [r[0] is None for r in df.select(cleaning.parse_timestamp(F.col("t"))).collect()] == [False, True, True]


def test_suspicious_scores(spark):
    rows = [(1.0, 1.0, 1.0, 1.0, 1.0), (1.0, 1.0, 1.0, 1.0, 0.0), (1.0, 1.0, 1.0, 0.9, 1.0)]
    df = spark.createDataFrame(rows, "accuracy double, precision double, recall double, f1 double, auc double")
    assert [r.is_suspicious for r in quality.perfect_metrics(df).collect()] == [True, True, False]


def test_no_report_for_no_columns(spark):
    with pytest.raises(ValueError):
        quality.non_finite(spark.range(1))
