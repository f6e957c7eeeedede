"""Scores against their definitions, including classes that are absent."""

import random

import pytest

from propensity.operators import metrics

TYPES = "label int, prediction int, probability double"


def _area(pairs):
    wins = [
        1.0 if p > q else 0.5 if p == q else 0.0
        for label, p in pairs if label for other, q in pairs if not other
    ]
    return sum(wins) / len(wins)


@pytest.mark.parametrize("levels", [3, 1000])
def test_auc_counts_ties_half(spark, levels):
    draw = random.Random(levels)
    pairs = [(draw.randrange(2), draw.randrange(levels) / levels) for _ in range(400)]
    df = spark.createDataFrame([(y, 0, p) for y, p in pairs], TYPES)
    assert metrics.auc_of_probabilities(df) == pytest.approx(_area(pairs))


def test_infinite_and_missing_scores(spark):
    """Infinities are scores; NULL and NaN are below all, minus infinity too."""
    inf, nan = float("inf"), float("nan")
    df = spark.createDataFrame([(1, 0, inf), (0, 0, 0.5), (0, 0, -inf), (None, 0, 3.0)], TYPES)
    assert metrics.auc_of_probabilities(df) == 1.0
    rows = [(1, -inf), (1, None), (1, 0.0), (0, nan), (0, -0.0), (0, None), (0, inf)]
    df = spark.createDataFrame([(y, 0, p) for y, p in rows], TYPES).repartition(3)
    order = {None: -2, nan: -2, -inf: -1, 0.0: 0, inf: 1}
    plain = [(y, -2 if p is None or p != p else order[p]) for y, p in rows]
    assert metrics.auc_of_probabilities(df) == pytest.approx(_area(plain))


def test_hard_auc_is_the_auc_of_the_class(spark):
    draw = random.Random(5)
    pairs = [(draw.randrange(2), draw.randrange(2)) for _ in range(300)]
    df = spark.createDataFrame([(y, p, float(p)) for y, p in pairs], TYPES)
    counts = metrics.confusion(df)
    assert metrics.auc_of_predictions(counts).first().auc == pytest.approx(_area(pairs))


def test_one_class(spark):
    df = spark.createDataFrame([(0, 0, 0.2), (0, 1, 0.7)], TYPES)
    counts = metrics.confusion(df)
    assert metrics.basic_metrics(counts).first() == (0.5, 0.0, 0.0, 0.0)
    assert metrics.auc_of_probabilities(df) == 0.0
    assert metrics.auc_of_predictions(counts).first().auc == 0.0
    assert metrics.balanced_metrics(counts).first() == (0.5, 0.0)


def test_evaluation_of_nothing(spark):
    row = metrics.evaluation(spark.createDataFrame([], TYPES)).first()
    assert set(row.asDict().values()) == {0.0}


LINES = [
    "  Accuracy: 0.7500",
    "  Balanced Accuracy: .5",
    "MCC: 0.25 and ROC AUC: 0.9000",
    "F1 Score: 1",
    "accuracy: 0.7",
    "Recall:    0.7000",
    "Precision: 0.125",
]


@pytest.mark.parametrize(
    "anchored, expected",
    [
        (False, {("Accuracy", 0.75), ("Accuracy", 0.5), ("Balanced Accuracy", 0.5), ("MCC", 0.25),
                 ("ROC AUC", 0.9), ("Precision", 0.125)}),
        (True, {("Accuracy", 0.75), ("Balanced Accuracy", 0.5), ("MCC", 0.25), ("Precision", 0.125)}),
    ],
)
def test_log_lines(spark, anchored, expected):
    lines = spark.createDataFrame([(line,) for line in LINES], "value string")
    assert {tuple(r) for r in metrics.log_metrics(lines, anchored).collect()} == expected
