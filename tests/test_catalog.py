"""Every registered query against its SQL, on the test tables."""

import pytest

import __spark_entry__ as entry
from tests.compare import connect, difference
from tests.conftest import SF_DIR

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES])
def test_query_matches_sql(spark, db, name):
    assert difference(QUERIES[name](spark, SF_DIR), db, ORACLES[name]) is None


@pytest.mark.parametrize("name", ["model_gbt_scores", "model_gbt_weighted_scores", "model_rf_scores"])
def test_model_scores_are_shares(spark, name):
    row = QUERIES[name](spark, SF_DIR).first().asDict()
    assert set(row) == {"accuracy", "precision", "recall", "f1", "auc", "auc_hard"}
    assert all(0 <= value <= 1 for value in row.values())


def test_cross_validation_scores_each_fold(spark):
    rows = QUERIES["model_cv_f1"](spark, SF_DIR).collect()
    assert sorted(r.fold for r in rows) == [0, 1, 2, 3, 4]
    assert all(0 <= r.f1 <= 1 for r in rows)


def test_grid_scores_each_setting(spark):
    rows = QUERIES["model_grid"](spark, SF_DIR).collect()
    assert [r.max_depth for r in rows] == [2, 4] and all(0 <= r.mean_f1 <= 1 for r in rows)


def test_random_sample_is_a_subset(spark):
    everyone = {r.user_id for r in QUERIES["feat_user_row"](spark, SF_DIR).collect()}
    chosen = [r.user_id for r in QUERIES["sample_random"](spark, SF_DIR).collect()]
    assert set(chosen) <= everyone and len(chosen) == len(set(chosen)) < len(everyone)


def test_audience_sink_keeps_the_feature_columns(spark):
    df = QUERIES["sink_audience"](spark, SF_DIR)
    assert df.columns[-2:] == ["predicted_high_potential", "predicted_probability"]
    assert df.count() == QUERIES["feat_user_row"](spark, SF_DIR).count()


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 33 and df.count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
