"""The commands end to end, from event tables to an audience."""

import pytest
from pyspark.sql import functions as F

from catalog.inputs import view
from propensity.__main__ import main
from propensity.operators.cleaning import high_potential
from propensity.plans.checking import validate
from propensity.sources.csv_files import read_csv_directory
from tests.conftest import SF_DIR


@pytest.fixture(scope="module")
def work(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("work")
    for name in ("fx_traffic", "fx_conversions", "fx_dsp_impressions", "fx_dsp_clicks"):
        view(spark, SF_DIR, name).write.parquet(f"{root}/{name}")
    return root


def test_from_events_to_an_audience(spark, work, capsys):
    main(["features", "--traffic", f"{work}/fx_traffic", "--conversions", f"{work}/fx_conversions",
          "--at", "2024-01-28 00:00:00", "--as-of", "--output", f"{work}/features"])
    rows = spark.read.parquet(f"{work}/features")
    label = high_potential(F.col("total_conversions_after_30d"), F.col("total_revenue_after_30d"))
    rows.withColumn("target_col", label).coalesce(2).write.csv(f"{work}/train", header=True)
    main(["train", "--input", f"{work}/train", "--model", f"{work}/model", "--trees", "2"])
    printed = capsys.readouterr().out
    assert "Accuracy: 0." in printed or "Accuracy: 1." in printed
    main(["score", "--input", f"{work}/train", "--model", f"{work}/model", "--output", f"{work}/scores"])
    assert "missing" not in capsys.readouterr().out
    main(["select", "--input", f"{work}/scores", "--output", f"{work}/top", "--top-percent", "10"])
    top = read_csv_directory(spark, f"{work}/top")
    assert top.count() == 15 and set(top.columns) == {"user_id", "prediction", "probability"}


def test_value_of_buyers(spark, work):
    main(["value", "--conversions", f"{work}/fx_conversions", "--impressions", f"{work}/fx_dsp_impressions",
          "--clicks", f"{work}/fx_dsp_clicks", "--today", "2024-02-01", "--output", f"{work}/rfm"])
    assert spark.read.parquet(f"{work}/rfm").columns[:4] == ["user_id", "recency", "frequency", "monetary"]


def test_a_leak_makes_the_scores_suspicious(spark):
    df = spark.range(400).selectExpr(
        "id AS user_id", "IF(id % 4 = 0, 1, 0) AS y", "IF(id % 4 = 0, 7.5D, 2.5D) AS leak", "id % 13 AS noise"
    )
    result = validate(df, "y", trees=2, depth=3, folds=3)
    assert result.metrics.first().is_suspicious
    assert [r.f1 for r in result.folds.collect()] == [1.0] * 3
    assert result.mean_f1 == 1.0
    honest = validate(df, "y", drop=["leak"], trees=2, depth=3, folds=3)
    assert not honest.metrics.first().is_suspicious
