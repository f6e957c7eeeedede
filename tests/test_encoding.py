"""Scaling, label encoding and outliers."""

import pytest
from pyspark.sql import functions as F

from propensity.operators import encoding


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_label_codes_follow_the_order_of_values(spark, threshold):
    """Broadcast and shuffled joins."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    df = spark.range(5000).selectExpr("id", "IF(id % 3 = 0, 'hot', IF(id % 50 = 1, NULL, concat('v', id % 97))) AS c")
    codes = {v: i for i, v in enumerate(sorted({r.c for r in df.collect() if r.c is not None}))}
    try:
        rows = encoding.label_encode(df, "c", "code").collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(rows) == 5000
    assert all(r.code == (None if r.c is None else codes[r.c]) for r in rows)


def test_standard_scores(spark):
    df = spark.createDataFrame([(1.0, 4), (2.0, 4), (3.0, 4), (None, None)], "a double, b int")
    rows = [tuple(r) for r in encoding.standardize(df, ["a", "b"]).collect()]
    assert rows == [(-1.0, 0.0), (0.0, 0.0), (1.0, 0.0), (None, None)]


def test_codes_and_moments_of_another_frame(spark):
    train = spark.createDataFrame([("b", 1.0), ("a", 3.0)], "c string, x double")
    new = spark.createDataFrame([("a", 2.0), ("z", 4.0), (None, None)], "c string, x double")
    rows = encoding.with_codes(new, "c", encoding.categories(train, "c"), "code").collect()
    assert {r.c: r.code for r in rows} == {"a": 0, "z": None, None: None}
    scaled = encoding.standardize(new, ["x"], encoding.moments(train, ["x"])).collect()
    assert [r.x for r in scaled] == [0.0, 2 / 2**0.5, None]


def test_outliers(spark):
    df = spark.range(100).select(F.when(F.col("id") == 7, 1000.0).otherwise(F.col("id") % 3).alias("a"))
    rows = encoding.anomalies(df, ["a"]).where("is_anomaly").collect()
    assert [(r.a, r.n_outliers) for r in rows] == [(1000.0, 1)]
