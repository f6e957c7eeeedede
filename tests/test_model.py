"""Training, saving, aligning and scoring on a separable frame."""

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from catalog import models as catalog_models
from propensity.operators import cleaning, model as models
from propensity.plans import scoring, training
from propensity.sources.csv_files import read_csv_directory
from tests.conftest import SMALL_DIR


@pytest.fixture(scope="module")
def frame(spark):
    return spark.range(600).selectExpr(
        "concat('u', id) AS user_id",
        "id % 7 * 1.0D AS a",
        "IF(id % 11 = 0, NULL, (id * 37) % 101) AS b",
        "'text' AS note",
        "0 AS nothing",
        "IF(id % 7 >= 5, 1, 0) AS high_potential",
        "IF(id % 7 >= 5, 3.0D, 0.0D) AS total_revenue_after_30d",
    )


@pytest.fixture(scope="module")
def trained(frame, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("model") / "gbt")
    result = training.train(frame, "high_potential", trees=3, depth=2, save_to=path)
    return result, path


def test_a_separable_label_is_learned(trained):
    row = trained[0].metrics.first()
    assert row.auc > 0.99 and row.accuracy > 0.99


def test_label_sources_and_empty_columns_are_not_features(trained):
    assert models.features_of_model(trained[0].model) == ["a", "b"]


def test_the_test_part_is_untouched(trained):
    test = trained[0].test
    assert test.count() == test.select("user_id").distinct().count() == 120


def test_saved_model_scores_the_same(frame, trained):
    result, path = trained
    before = {r.user_id: r.probability for r in scoring.score_frame(result.model, frame).collect()}
    after = {r.user_id: r.probability for r in scoring.score_frame(PipelineModel.load(path), frame).collect()}
    assert before == after and len(before) == 600


def test_scoring_a_table_with_other_columns(spark, frame, trained, tmp_path):
    """A feature is missing and one is extra: the table is still scored, and both are reported."""
    other = frame.drop("b").withColumn("new", F.lit(1))
    output = str(tmp_path / "scores")
    states = scoring.score(other, trained[1], output)
    assert states["a"] == "matched" and states["b"] == "missing" and states["new"] == "extra"
    scored = read_csv_directory(spark, output, {"prediction": "int", "probability": "double"})
    assert scored.columns == ["user_id", "prediction", "probability"] and scored.count() == 600
    assert scored.where("prediction != CAST(probability > 0.5 AS INT)").count() == 0


def test_scoring_without_a_key(frame, trained):
    assert scoring.score_frame(trained[0].model, frame.drop("user_id")).columns == ["prediction", "probability"]


def test_audience_keeps_columns_as_they_came(frame, trained):
    scored = scoring.score_audience(trained[0].model, frame)
    assert scored.columns == [*frame.columns, "prediction", "probability"]
    assert scored.where("b IS NULL").count() == frame.where("b IS NULL").count()


def test_thresholds_move_the_class(frame, trained):
    model = PipelineModel.load(trained[1])
    model.stages[-1].setThresholds([0.0, 1.0])
    assert scoring.score_frame(model, frame).where("prediction = 1").count() == 0


def test_weighted_training(frame):
    row = training.train(frame, "high_potential", balancing="weights", trees=2, depth=2).metrics.first()
    assert row.auc > 0.99


def test_cross_validation_and_grid(spark, frame):
    from propensity.operators.balance import stratified_folds
    from propensity.session import materialize

    clean = cleaning.clean(frame, "high_potential", drop=["total_revenue_after_30d"])
    df = materialize(stratified_folds(clean, "high_potential", folds=3), "folds")
    forest = models.random_forest(["a", "b"], "high_potential", trees=3, depth=3)
    scores = models.cross_validate(df, forest, "high_potential", folds=3).collect()
    assert all(r.f1 > 0.9 for r in scores) and len(scores) == 3
    found = models.grid_search(df, forest, "high_potential", {"maxDepth": [1, 3]}, folds=3)
    assert len(found.avgMetrics) == 2


def test_bad_requests_fail_early(frame):
    with pytest.raises(ValueError, match="nowhere"):
        training.train(frame, "nowhere")
    with pytest.raises(ValueError, match="balancing"):
        training.train(frame, "high_potential", balancing="guess")


def test_training_without_a_key(spark, frame):
    """The test rows are the same under any layout."""
    without = frame.drop("user_id").withColumn("dma_code", F.lit(7) + F.col("high_potential"))
    results = [training.train(without.repartition(n), "high_potential", trees=2, depth=2) for n in (1, 6)]
    tests = [sorted(map(repr, r.test.collect())) for r in results]
    assert tests[0] == tests[1] and len(tests[0]) == 120 and "dma_code" not in results[0].test.columns


def test_training_on_snapshots(spark, frame):
    """Several rows a user: a key of two columns, and all rows of a user on one side."""
    rows = frame.selectExpr("*", "explode(sequence(1, 3)) AS at")
    plain = training.train(rows, "high_potential", key=["at", "user_id"], trees=2, depth=2)
    assert plain.test.count() == plain.test.select("at", "user_id").distinct().count() == 360
    grouped = training.train(rows, "high_potential", key=["at", "user_id"], group="user_id", trees=2, depth=2)
    assert grouped.test.count() == 3 * grouped.test.select("user_id").distinct().count() == 360
    scored = scoring.score_frame(grouped.model, rows, ["at", "user_id"])
    assert scored.columns == ["at", "user_id", "prediction", "probability"] and scored.count() == 1800


def test_scale_and_codes_are_saved_with_the_model(spark, frame, tmp_path):
    rows = frame.withColumn("shop", F.when(F.col("a") == 0, None).otherwise(F.concat(F.lit("s"), F.col("a").cast("int"))))
    path = str(tmp_path / "model")
    trained = training.train(rows, "high_potential", trees=2, depth=2, scale=True, encode=["shop"], balancing="none", save_to=path)
    loaded = PipelineModel.load(path)
    assert models.contract(loaded) == {"a": "double", "b": "double", "shop": "string"}
    strange = spark.createDataFrame([("x", 3.0, "unseen"), ("y", 3.0, None), ("z", 3.0, "s1")], "user_id string, a double, shop string")
    values = [r.features.toArray().tolist() for r in loaded.transform(strange).orderBy("user_id").collect()]
    assert [v[2] for v in values] == [6.0, 6.0, 0.0] and values[0][0] == values[1][0]
    before, after = (scoring.score_frame(m, rows).orderBy("user_id").collect() for m in (trained.model, loaded))
    assert before == after and models.alignment(strange, models.contract(loaded)) == {"a": "matched", "b": "missing", "shop": "matched"}


def test_text_in_a_number_feature_is_reported(spark, frame, trained, tmp_path):
    text = frame.withColumn("a", F.when(F.col("a") == 3, "three").otherwise(F.col("a").cast("string")))
    states = scoring.score(text, trained[1], str(tmp_path / "out"))
    lost = frame.where("a = 3").count()
    assert states["a"] == f"cast, {lost} values are no numbers" and states["b"] == "matched"
    same = frame.withColumn("a", F.concat(F.lit(" "), F.col("a").cast("string")))
    both = [scoring.score_frame(trained[0].model, df).orderBy("user_id").collect() for df in (frame, same)]
    assert both[0] == both[1]
    with pytest.raises(ValueError, match="no number"):
        scoring.score_frame(trained[0].model, frame.withColumn("a", F.array("a")))
    text.coalesce(2).write.csv(str(tmp_path / "in"), header=True)
    states = scoring.score_files(spark, str(tmp_path / "in"), trained[1], str(tmp_path / "out"))
    assert states["a"] == f"matched, {lost} values are no numbers" and states["b"] == "matched" and states["note"] == "extra"


def test_share_of_pairs_in_order_is_counted_without_making_them(spark):
    rows = [(int(i * 37 % 11 < 5), float(i * 29 % 23) / 23) for i in range(200)] + [(1, None), (0, None), (1, float("nan")), (0, float("nan")), (None, 0.5)]
    frame = spark.createDataFrame(rows, "y int, s double")
    order = lambda s: float("inf") if s != s else s
    pairs = [(a, b) for y, a in rows if y == 1 for z, b in rows if z == 0]
    won = sum((order(a) > order(b)) + (order(a) == order(b)) / 2 for a, b in pairs if a is not None and b is not None)
    assert 0 < won < len(pairs) and catalog_models._share_in_order(frame) == pytest.approx(won / len(pairs), abs=1e-12)
    assert catalog_models._share_in_order(frame.where("y = 1")) == 0.0 == catalog_models._share_in_order(frame.where("false"))
    assert "JOIN" not in catalog_models._BY_DEFINITION


def test_models_of_a_directory_share_their_feature_rows(spark):
    assert catalog_models.labelled_rows(spark, SMALL_DIR) is catalog_models.labelled_rows(spark, SMALL_DIR)
