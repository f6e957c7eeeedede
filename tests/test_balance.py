"""Properties of splits, folds, weights and oversampling."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from propensity.operators import balance


@pytest.fixture(scope="module")
def frame(spark):
    """A user id as text; one class holds nearly everything."""
    return spark.range(1003).selectExpr(
        "concat('u', id) AS user_id", "IF(id % 10 = 0, 1, 0) AS label", "id * 1.5D AS x"
    )


def _split(df):
    return {r.user_id: r.is_test for r in balance.stratified_split(df, "label").collect()}


def test_split_sizes_are_exact_per_class(frame):
    rows = balance.stratified_split(frame, "label").groupBy("label", "is_test").count().collect()
    sizes = {(r.label, r.is_test): r["count"] for r in rows}
    assert sizes == {(1, True): 20, (1, False): 81, (0, True): 180, (0, False): 722}


def test_split_does_not_depend_on_partitioning(spark, frame):
    once = _split(frame.repartition(1))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        assert _split(frame.repartition(50)) == once
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_another_seed_gives_another_split(frame):
    other = {r.user_id: r.is_test for r in balance.stratified_split(frame, "label", seed=7).collect()}
    assert other != _split(frame)


@pytest.mark.parametrize("share", [0.0, 1.0])
def test_split_extremes(frame, share):
    flags = balance.stratified_split(frame, "label", test_size=share).select("is_test").distinct().collect()
    assert [r.is_test for r in flags] == [share == 1.0]


@pytest.mark.parametrize("kind", ["boolean", "double", "string"])
def test_labels_of_other_types(frame, kind):
    typed = frame.withColumn("label", F.col("label").cast(kind))
    assert _split(typed) == _split(frame)


def test_hash_split_is_close(frame):
    n = balance.hash_split(frame).where("is_test").count()
    assert abs(n - 200) < 50


def test_folds_differ_by_at_most_one(frame):
    rows = balance.stratified_folds(frame, "label").groupBy("label", "fold").count().collect()
    for label in (0, 1):
        sizes = [r["count"] for r in rows if r.label == label]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_more_folds_than_rows(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1), ("c", 0)], "user_id string, label int")
    folds = {r.user_id: r.fold for r in balance.stratified_folds(df, "label").collect()}
    assert sorted([folds["a"], folds["b"]]) == [0, 1] and folds["c"] == 0


def test_weights_balance_the_classes(frame):
    rows = balance.class_weights(frame, "label").groupBy("label").agg(F.sum("class_weight").alias("w")).collect()
    assert [r.w for r in rows] == [pytest.approx(1003 / 2)] * 2


def test_oversampling(spark, frame):
    """Both ways of joining give the same multiset; the largest class is kept once."""
    rows = balance.oversample(frame, "label").collect()
    counts = Counter(r.label for r in rows)
    assert counts == {0: 902, 1: 902}
    assert len({r.user_id for r in rows if r.label == 0}) == 902
    original = {r.user_id: r.x for r in frame.collect()}
    assert all(original[r.user_id] == r.x for r in rows)
    drawn = Counter(r.user_id for r in rows if r.label == 1)
    assert max(drawn.values()) > 1
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = balance.oversample(frame.repartition(7), "label").collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert Counter(r.user_id for r in shuffled if r.label == 1) == drawn


def test_oversampling_numbers_rows_of_one_key_alike(spark):
    df = spark.createDataFrame([("a", 0, x) for x in range(9)] + [("b", 1, x) for x in range(4)], "user_id string, label int, x int")
    draws = [Counter(map(tuple, balance.oversample(df.repartition(n), "label").collect())) for n in (1, 5)]
    assert draws[0] == draws[1]


def test_balanced_classes_are_left_alone(spark):
    df = spark.createDataFrame([("a", 0), ("b", 1)], "user_id string, label int")
    assert sorted(r.user_id for r in balance.oversample(df, "label").collect()) == ["a", "b"]


def test_any_number_of_classes(spark):
    """A thousand classes of 1 to 4 rows and one of half of all rows: exact shares, folds and draws in each."""
    df = spark.range(2500).selectExpr("id", "CAST(id AS string) AS user_id", "IF(id % 2 = 0, -1, (id * id) % 1009) AS label")
    sizes = Counter(r.label for r in df.collect())
    assert len(sizes) > 400 and max(sizes.values()) == 1250
    tests = Counter(r.label for r in balance.stratified_split(df, "label").collect() if r.is_test)
    assert all(tests[c] == int(0.2 * n + 0.5) for c, n in sizes.items())
    folds = Counter((r.label, r.fold) for r in balance.stratified_folds(df, "label").collect())
    assert all(folds[c, f] == n // 5 + (f < n % 5) for c, n in sizes.items() for f in range(5))
    weights = {r.label: r.class_weight for r in balance.class_weights(df, "label").collect()}
    assert all(weights[c] == pytest.approx(2500 / (len(sizes) * n)) for c, n in sizes.items())
    drawn = balance.oversample(df, "label").groupBy("label").count().collect()
    assert {r.label: r["count"] for r in drawn} == {c: 1250 for c in sizes}


def test_rows_of_no_class(spark):
    df = spark.createDataFrame([("a", 0), ("b", 0), ("c", None), (None, 0)], "user_id string, label int")
    assert {r.user_id: r.is_test for r in balance.stratified_split(df, "label", test_size=1).collect()} == {"a": True, "b": True, "c": False, None: True}
    assert {r.user_id: r.fold for r in balance.stratified_folds(df, "label").collect()}["c"] is None
    assert {r.user_id: r.class_weight for r in balance.class_weights(df, "label").collect()} == {"a": 1.0, "b": 1.0, "c": None, None: 1.0}
    with pytest.raises(ValueError, match="NULL"):
        balance.oversample(df, "label")
    empty = df.where("label = 9")
    for add in (balance.stratified_split, balance.stratified_folds, balance.class_weights, balance.oversample):
        assert (add(empty, "label") if add is balance.class_weights else add(empty, "label")).collect() == []


def test_rows_without_a_key(spark):
    """One row is a third of all: the split and the folds divide its copies exactly, alike under any layout."""
    rows = [(1, 0.5, "x")] * 100 + [(i % 7, i * 0.25, None if i % 3 else "y") for i in range(200)] + [(0, None, None)] * 10
    df = spark.createDataFrame(rows, "label int, x double, s string")
    sizes = Counter(r[0] for r in rows)
    splits = [Counter(map(tuple, balance.stratified_split(df.repartition(n), "label", None).collect())) for n in (1, 7)]
    assert splits[0] == splits[1] and Counter(k[:3] for k in splits[0].elements()) == Counter(rows)
    tests = Counter(k[0] for k in splits[0].elements() if k[3])
    assert all(tests[c] == int(0.2 * n + 0.5) for c, n in sizes.items())
    folds = [Counter(map(tuple, balance.stratified_folds(df.repartition(n), "label", None, folds=4).collect())) for n in (2, 5)]
    assert folds[0] == folds[1]
    shares = Counter((k[0], k[3]) for k in folds[0].elements())
    assert all(shares[c, f] == n // 4 + (f < n % 4) for c, n in sizes.items() for f in range(4))
    drawn = [Counter(map(tuple, balance.oversample(df.repartition(n), "label", None).collect())) for n in (1, 6)]
    assert drawn[0] == drawn[1] and set(Counter(k[0] for k in drawn[0].elements()).values()) == {max(sizes.values())}


def test_keys_of_several_columns(spark):
    df = spark.range(500).selectExpr("id % 50 AS user_id", "id DIV 50 AS at", "CAST(id % 3 AS int) AS label")
    once, again = ({(r.user_id, r["at"]): r.is_test for r in balance.stratified_split(df.repartition(n), "label", ["user_id", "at"]).collect()} for n in (1, 9))
    assert once == again and sum(once.values()) == 99
    assert len(once) == 500


def test_groups_stay_on_one_side(spark):
    df = spark.range(3000).selectExpr("IF(id % 3 = 0, 0, id % 90) AS user_id", "id", "IF(id % 90 < 20, 1, 0) AS label")
    df = df.unionByName(spark.createDataFrame([(None, 1, 1)], "user_id long, id long, label int"))
    rows = balance.split_by_group(df, "label").collect()
    sides = {}
    for r in rows:
        sides.setdefault(r.user_id, set()).add(r.is_test)
    assert len(rows) == 3001 and all(len(s) == 1 for s in sides.values()) and sides[None] == {False}
    labels = {}
    for r in rows:
        if r.user_id is not None:
            labels[r.user_id] = max(r.label, labels.get(r.user_id, 0))
    for c, n in Counter(labels.values()).items():
        assert sum(labels[u] == c and sides[u] == {True} for u in labels) == int(0.2 * n + 0.5)


def test_a_row_of_very_many_copies(spark, monkeypatch):
    monkeypatch.setattr(balance, "PIECE", 7)
    df = spark.range(300).selectExpr("concat('u', id) AS user_id", "IF(id < 2, 1, 0) AS label")
    counts = Counter(r.user_id for r in balance.oversample(df, "label").collect())
    assert len(counts) == 300 and counts["u0"] + counts["u1"] == 298
