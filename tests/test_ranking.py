"""Selection by rank against sorting."""

import math
import random
import struct
from hashlib import md5

import pytest
from pyspark.sql import functions as F

from propensity.functions.scalars import hash_number, hash_text
from propensity.operators import audience, ranking
from propensity.operators.audience import top_n, top_percent
from propensity.operators.quality import describe
from propensity.operators.ranking import Place, from_order_bits, hash_cuts, hash_order, order_bits, places_at_ranks, values_at_ranks

SHAPES = {
    "spread": lambda draw: draw.random(),
    "ties": lambda draw: draw.randrange(5) / 4,
    "hot": lambda draw: 0.5 if draw.random() < 0.6 else draw.random(),
    "narrow": lambda draw: 0.9 + draw.random() * 1e-9,
    "constant": lambda draw: 3.0,
}


@pytest.mark.parametrize("shape", SHAPES)
def test_values_at_ranks(spark, shape):
    draw = random.Random(1)
    values = [SHAPES[shape](draw) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in [*values, None, float("nan")]], "x double").repartition(4)
    ranks = [1, 2, 700, 1500, 1501, 2999, 3000]
    ordered = sorted(values)
    found = places_at_ranks(df, {"x": ranks})
    for rank in ranks:
        value = ordered[rank - 1]
        assert found["x", rank] == Place(value, rank - ordered.index(value), ordered.count(value))
    with pytest.raises(ValueError):
        values_at_ranks(df, {"x": [3001]})


EXTREMES = [
    0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, -1e-310, 1.0, -1.0, 0.1, 1 - 2**-53, 1 + 2**-52, 2.0**52,
    2.0**53 - 1, 1.7976931348623157e308, -1.7976931348623157e308, float("inf"), float("-inf"), 3.0, 4.0, 4.0 - 2**-51, 1e-5, 123456.789,
]


def test_order_bits_are_the_bits_of_doubles(spark):
    draw = random.Random(4)
    powers = [p for e in range(-1074, 1024) for p in (2.0**e, math.nextafter(2.0**e, 0), math.nextafter(2.0**e, math.inf))]
    values = [*EXTREMES, *powers, *(struct.unpack("<d", draw.randbytes(8))[0] for _ in range(5000))]
    values = [v for v in values if not math.isnan(v)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    found = [r.c0 for r in order_bits(df.coalesce(1), ["x"]).collect()]
    assert len(found) == len(values)
    for x, bits in zip((r.x for r in df.coalesce(1).collect()), found):
        size = struct.unpack("<q", struct.pack("<d", abs(x)))[0]
        assert bits == (-size if x < 0 else size)
        assert from_order_bits(bits) == x


def test_ranks_of_extremes_and_many_columns(spark):
    rows = [(v, 7.0, float(i % 2)) for i, v in enumerate(EXTREMES * 3)]
    df = spark.createDataFrame(rows, "x double, one double, two double").repartition(3)
    ranks = list(range(1, len(rows) + 1))
    found = values_at_ranks(df, {"x": ranks, "one": [1, len(rows)], "two": [1, len(rows)]})
    ordered = sorted(v for v, _, _ in rows)
    assert [found["x", r] for r in ranks] == ordered
    assert found["one", 1] == found["one", len(rows)] == 7.0 and (found["two", 1], found["two", len(rows)]) == (0.0, 1.0)


def test_a_rank_takes_at_most_five_passes(spark, monkeypatch):
    passes = []
    counted = ranking._counted
    monkeypatch.setattr(ranking, "_counted", lambda bits, pending: passes.append(len(pending)) or counted(bits, pending))
    near = [(1.0 + i * 2**-52,) for i in range(3000)] + [(float("inf"),), (-1e300,)] * 500
    assert values_at_ranks(spark.createDataFrame(near, "x double"), {"x": [1600]})["x", 1600] == 1.0 + 1099 * 2**-52
    assert len(passes) <= 5
    passes.clear()
    values_at_ranks(spark.createDataFrame([(3.0,)] * 50, "x double"), {"x": [25]})
    assert len(passes) == 1


def test_describe_against_pandas(spark):
    draw = random.Random(2)
    rows = [(draw.randrange(7), draw.gauss(0, 1) if i % 5 else None) for i in range(501)]
    df = spark.createDataFrame(rows, "a int, b double")
    expected = df.toPandas().describe()
    for row in describe(df).collect():
        column = expected[row.column_name]
        for ours, theirs in [("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"),
                             ("p25", "25%"), ("p50", "50%"), ("p75", "75%"), ("max", "max")]:
            assert row[ours] == pytest.approx(column[theirs])


def test_describe_of_an_empty_column(spark):
    row = describe(spark.createDataFrame([(None,), (None,)], "a double")).first()
    assert row["count"] == 0 and row["p50"] is None


@pytest.mark.parametrize("copies", [1, 50])
def test_hash_cuts(spark, copies):
    """One group holds most rows; a key may repeat."""
    df = spark.range(2000).selectExpr("id AS k", "IF(id % 20 = 0, 'b', 'a') AS label")
    if copies > 1:
        df = df.unionAll(spark.range(copies).selectExpr("7L AS k", "'a' AS label"))
    rows = df.select("k", "label", hash_text(F.col("k"), 5, 15).alias("h")).collect()
    ordered = {g: sorted((r.h, r.k) for r in rows if r.label == g) for g in "ab"}
    cuts = hash_cuts(df.select("label", hash_order([F.col("k")], 5).alias("place")), lambda total: [F.lit(0), F.lit(30), total - 1, total]).collect()
    assert len(cuts) == 6
    for r in cuts:
        at = (r.cut.hash, r.cut.key.k0)
        assert at == ordered[r.label][r["rank"] - 1]
        assert r.ties == ordered[r.label].count(at) and r.of_ties == r["rank"] - ordered[r.label].index(at)


@pytest.mark.parametrize("shape", SHAPES)
@pytest.mark.parametrize("percent", [0.1, 15, 33.3, 100])
def test_top_percent(spark, shape, percent):
    draw = random.Random(3)
    rows = [(f"u{i}", SHAPES[shape](draw)) for i in range(997)] + [("unscored", None)]
    df = spark.createDataFrame(rows, "user_id string, probability double")
    hashes = {r.user_id: r.h for r in df.select("user_id", hash_number(F.col("user_id"), 42).alias("h")).collect()}
    ordered = sorted((r for r in rows if r[1] is not None), key=lambda r: (-r[1], hashes[r[0]], r[0]))
    wanted = -(-int(997 * round(percent * 10)) // 1000)
    chosen = {r.user_id for r in top_percent(df, percent).collect()}
    assert chosen == {user for user, _ in ordered[:wanted]}


def test_top_n_breaks_ties_by_user(spark):
    df = spark.createDataFrame([(3, 0.5), (1, 0.5), (2, 0.9)], "user_id int, probability double")
    first = min((1, 3), key=lambda user: md5(f"{user}-42".encode()).hexdigest()[:15])
    assert {r.user_id for r in top_n(df, 2).collect()} == {2, first}


def test_missing_scores_are_never_selected(spark):
    df = spark.createDataFrame([(1, 0.9), (2, float("nan")), (3, 0.1), (4, None)], "user_id int, probability double")
    assert {r.user_id for r in top_percent(df, 50).collect()} == {1}
    assert {r.user_id for r in top_n(df, 9).collect()} == {r.user_id for r in audience.above(df, 0.0).collect()} == {1, 3}
    assert [r.user_id for r in audience.ranked(df).collect()] == [1, 3]
    with pytest.raises(ValueError):
        values_at_ranks(df, {"probability": [3]})


@pytest.mark.parametrize("shape", SHAPES)
@pytest.mark.parametrize("n", [1, 100, 996, 2000])
def test_heap_and_rank_cut_agree(spark, monkeypatch, shape, n):
    draw = random.Random(6)
    rows = [(f"u{i}", SHAPES[shape](draw), i) for i in range(997)]
    df = spark.createDataFrame(rows, "user_id string, probability double, row int").repartition(40)
    heap = sorted(map(tuple, top_n(df, n).collect()))
    monkeypatch.setattr(audience, "HEAP_ROWS", 0)
    assert sorted(map(tuple, top_n(df, n).collect())) == heap and len(heap) == min(n, 997)


def test_audience_arguments(spark):
    df = spark.createDataFrame([(1, 0.9)], "user_id int, probability double")
    assert top_n(df, 0).collect() == [] == top_percent(df, 0).collect()
    for bad in (lambda: top_n(df, -1), lambda: top_percent(df, -5), lambda: top_percent(df, 101)):
        with pytest.raises(ValueError):
            bad()
    empty = df.where("user_id = 2")
    assert top_n(empty, 3).collect() == [] == top_percent(empty, 10).collect()


def test_top_n_is_cut_by_threshold(spark):
    rows = [(i, (i * 37 % 100) / 100) for i in range(500)]
    df = spark.createDataFrame(rows, "user_id int, probability double")
    chosen = [r.probability for r in top_n(df, 203).collect()]
    assert sorted(chosen, reverse=True) == sorted((p for _, p in rows), reverse=True)[:203]
    assert top_n(df, 1000).count() == 500
