"""CSV directories, sinks and the shared folder."""

import pytest

from propensity import session
from propensity.sources import csv_files


def _write(folder, name, text):
    (folder / name).write_text(text)


@pytest.fixture
def folder(tmp_path):
    _write(tmp_path, "a.csv", "user_id,x,y\nu1,1,2.5\nu2,,3\n")
    _write(tmp_path, "b.csv", "y,user_id,x\n7.5,u3,9\n")
    _write(tmp_path, "c.csv", "user_id,x,y,z\nu4,4,1,extra\n")
    _write(tmp_path, "notes.txt", "not,a,table\n")
    return tmp_path


def _rows(df):
    return sorted(tuple(r) for r in df.select("user_id", "x", "y", "z").collect())


EXPECTED = [("u1", 1, 2.5, None), ("u2", None, 3.0, None), ("u3", 9, 7.5, None), ("u4", 4, 1.0, "extra")]


def test_files_are_united_by_name(spark, folder):
    df = csv_files.read_csv_directory(spark, str(folder), {"x": "int", "y": "double"})
    assert _rows(df) == EXPECTED


def test_inferred_types_are_widened(spark, folder):
    df = csv_files.read_csv_directory(spark, str(folder))
    assert dict(df.dtypes)["y"] == "double" and _rows(df) == EXPECTED


def test_mixed_text_and_numbers_become_text(spark, tmp_path):
    _write(tmp_path, "a.csv", "k,v\n1,2\n")
    _write(tmp_path, "b.csv", "v,k\nword,2\n")
    df = csv_files.read_csv_directory(spark, str(tmp_path))
    assert dict(df.dtypes)["v"] == "string"
    assert sorted((r.k, r.v) for r in df.collect()) == [(1, "2"), (2, "word")]


def test_an_empty_column_does_not_decide_the_type(spark, tmp_path):
    _write(tmp_path, "a.csv", "k,f,e\n1,2.5,\n")
    _write(tmp_path, "b.csv", "f,k,e\n,2,\n")
    df = csv_files.read_csv_directory(spark, str(tmp_path))
    assert dict(df.dtypes) == {"k": "int", "f": "double", "e": "string"}
    assert sorted(tuple(r) for r in df.collect()) == [(1, 2.5, None), (2, None, None)]


def test_single_file(spark, folder):
    df = csv_files.read_csv(spark, str(folder / "a.csv"), {"x": "bigint"})
    assert dict(df.dtypes) == {"user_id": "string", "x": "bigint", "y": "string"}


def test_an_empty_directory_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        csv_files.read_csv_directory(spark, str(tmp_path))


def test_predictions_without_a_key(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([(1, 0.75)], "prediction int, probability double")
    csv_files.write_predictions(df, path)
    assert csv_files.read_csv_directory(spark, path).collect() == [(1, 0.75)]


def test_materialize_reads_back_the_same(spark):
    df = spark.createDataFrame([(1, None), (2, "b")], "k int, v string")
    back = session.materialize(df, "test")
    assert sorted(map(tuple, back.collect())) == [(1, None), (2, "b")]
    assert "LogicalRDD" not in back._jdf.queryExecution().toString()


def test_scratch_is_deleted_and_results_stay(spark):
    df = spark.range(5)
    with session.scratch(spark):
        inner, gone = session.materialize(df, "inner"), session.materialize(df, "gone")
        session.discard(gone)
        with session.scratch(spark):
            deep = session.materialize(inner, "deep")
            kept = session.materialize(deep, "kept", outer=True)
        assert kept.count() == 5
        result = session.materialize(kept.union(inner), "result", outer=True)
    assert result.count() == 10
    for frame in (inner, gone, deep, kept):
        with pytest.raises(Exception, match="(?i)exist|not found"):
            spark.read.parquet(frame._propensity_path)
    with pytest.raises(ZeroDivisionError):
        with session.scratch(spark):
            lost = session.materialize(df, "lost")
            raise ZeroDivisionError
    with pytest.raises(Exception, match="(?i)exist|not found"):
        spark.read.parquet(lost._propensity_path)


def test_audience_as_csv(spark, tmp_path):
    df = spark.createDataFrame([("u1", 2.0, 1, 0.75)], "user_id string, x double, prediction int, probability double")
    csv_files.write_audience(df, str(tmp_path / "out"), format="csv")
    back = csv_files.read_csv_directory(spark, str(tmp_path / "out"))
    assert back.columns == ["user_id", "x", "predicted_high_potential", "predicted_probability"]
    assert back.collect() == [("u1", 2.0, 1, 0.75)]


def _jobs(spark, run):
    """Jobs that a call starts."""
    import uuid

    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "count")
    try:
        run()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_headers_take_one_job_for_any_number_of_files(spark, tmp_path):
    counts = []
    for n in (100, 300):
        folder = tmp_path / f"of {n}"  # a space, which paths in tables encode
        folder.mkdir()
        for i in range(n):
            _write(folder, f"f{i}.csv", f"k,v\n{i},{i}.5\n" if i % 3 else f"v,k,w\n{i}.5,{i},x\n")
        counts.append([])
        counts[-1].append(_jobs(spark, lambda: csv_files.csv_groups(spark, str(folder))))
        counts[-1].append(_jobs(spark, lambda: csv_files.read_csv_directory(spark, str(folder), {"k": "int", "v": "double"})))
        counts[-1].append(_jobs(spark, lambda: csv_files.read_csv_directory(spark, str(folder))))
        df = csv_files.read_csv_directory(spark, str(folder))
        assert dict(df.dtypes) == {"k": "int", "v": "double", "w": "string"} and set(df.columns) == {"k", "v", "w"}
        assert {(r.k, r.v) for r in df.collect()} == {(i, i + 0.5) for i in range(n)}
    assert counts[0] == counts[1] and counts[0][0] <= 2
    assert spark.conf.get("spark.sql.files.openCostInBytes") != csv_files._WHOLE_FILES


def test_odd_headers(spark, tmp_path):
    _write(tmp_path, "a.csv", '\n"k, one",v\n1,2\n')
    _write(tmp_path, "b.csv", "")
    _write(tmp_path, "c.csv", "v\n7\n")
    df = csv_files.read_csv_directory(spark, str(tmp_path), {"v": "int"})
    assert df.columns == ["k, one", "v"] and sorted((r[0] or "", r[1]) for r in df.collect()) == [("", 7), ("1", 2)]
    assert csv_files._names("a,,A,b") == ("a0", "_c1", "A2", "b")


@pytest.fixture
def stored(spark, tmp_path):
    ads = spark.range(400).selectExpr(
        "id % 9 AS user_id", "TIMESTAMP_NTZ '2024-01-20' + make_dt_interval(0, id % 200) AS event_dt_utc",
        "'sponsored_products' AS ad_product_type", "concat('c', id % 3) AS campaign_id_string",
        "'t' AS customer_search_term", "1 AS impressions", "CAST(id % 2 AS INT) AS clicks",
    )
    orders = spark.range(50).selectExpr(
        "id % 9 AS user_id", "TIMESTAMP_NTZ '2024-01-20' + make_dt_interval(0, id % 200) AS event_dt_utc",
        "'order' AS event_subtype", "1 AS conversions", "CAST(1.5 AS DECIMAL(18,2)) AS total_product_sales", "1 AS total_units_sold",
    )
    from propensity.sources.stored import write_events

    write_events(ads, "ads_stored", f"{tmp_path}/ads", buckets=4)
    write_events(orders, "orders_stored", f"{tmp_path}/orders", buckets=4)
    yield {"ads": ads, "orders": orders, "path": str(tmp_path)}
    spark.sql("DROP TABLE ads_stored")
    spark.sql("DROP TABLE orders_stored")


def test_stored_tables_need_no_shuffle_by_user(spark, stored):
    from propensity.plans.user_row import user_row
    from propensity.sources.stored import read_events

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        at = "2024-01-25 00:00:00"
        df = user_row(read_events(spark, "ads_stored"), read_events(spark, "orders_stored"), at)
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in text and text.count("SortMergeJoin") == 2
        early = read_events(spark, "ads_stored", at)
        text = early._jdf.queryExecution().executedPlan().toString()
        assert "event_date" in text.split("PartitionFilters: [")[1].split("]")[0] and "LessThanOrEqual(event_dt_utc" in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert sorted(map(repr, df.collect())) == sorted(map(repr, user_row(stored["ads"], stored["orders"], at).collect()))
    assert early.count() == stored["ads"].where(f"event_dt_utc <= TIMESTAMP_NTZ '{at}'").count() > 0


def test_stored_folders_can_be_attached(spark, stored):
    from propensity.sources.stored import attach_events, read_events, write_events

    other = spark.newSession()
    other.sql("CREATE DATABASE IF NOT EXISTS elsewhere")
    try:
        attach_events(other, "elsewhere.ads", f"{stored['path']}/ads", buckets=4)
        df = read_events(other, "elsewhere.ads", "2024-01-22 12:00:00")
        assert df.groupBy("user_id").count()._jdf.queryExecution().executedPlan().toString().count("Exchange") == 0
        assert df.count() == stored["ads"].where("event_dt_utc <= TIMESTAMP_NTZ '2024-01-22 12:00:00'").count()
    finally:
        other.sql("DROP DATABASE elsewhere CASCADE")
    with pytest.raises(ValueError, match="event_date"):
        write_events(stored["ads"].selectExpr("*", "1 AS event_date"), "x", "/nowhere", 2)
