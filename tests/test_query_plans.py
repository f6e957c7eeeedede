"""The physical plans that matter at scale."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from propensity.operators import balance, clicks, traffic
from propensity.operators.cutoffs import cutoff
from propensity.plans.user_row import user_row
from tests.conftest import SMALL_DIR


@pytest.fixture
def plan(spark):
    """Plans as for tables too big to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    yield lambda df: df._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.maxMetadataStringLength")


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Event tables as files, so that pushed filters and read columns show."""
    root = tmp_path_factory.mktemp("events")
    ads = spark.range(100).selectExpr(
        "id % 9 AS user_id", "TIMESTAMP_NTZ '2024-01-20' + make_dt_interval(0, id % 200) AS event_dt_utc",
        "'sponsored_products' AS ad_product_type", "concat('c', id % 3) AS campaign_id_string",
        "'t' AS customer_search_term", "1 AS impressions", "CAST(id % 2 AS INT) AS clicks", "'unused' AS other",
    )
    orders = spark.range(50).selectExpr(
        "id % 9 AS user_id", "TIMESTAMP_NTZ '2024-01-20' + make_dt_interval(0, id % 200) AS event_dt_utc",
        "'order' AS event_subtype", "1 AS conversions", "CAST(1.5 AS DECIMAL(18,2)) AS total_product_sales",
        "1 AS total_units_sold", "'unused' AS other",
    )
    for name, df in (("ads", ads), ("orders", orders)):
        df.write.parquet(f"{root}/{name}")
    return spark.read.parquet(f"{root}/ads"), spark.read.parquet(f"{root}/orders")


def test_user_row_scans_and_joins(plan, tables):
    text = plan(user_row(*tables, "2024-01-25 00:00:00"))
    assert len(re.findall(r"FileScan", text)) == 3
    assert text.count("SortMergeJoin") == 2
    assert "Expand" not in text and "CartesianProduct" not in text and "NestedLoop" not in text
    assert "other" not in text.replace("otherwise", "")
    # the joins use the partitioning of the aggregations: two exchanges for traffic by day or campaign and by
    # user, one for orders, four for clicks
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 7


def test_cutoffs_and_types_are_pushed_to_the_scan(plan, tables):
    text = plan(user_row(*tables, "2024-01-25 00:00:00", as_of=True))
    pushed = re.findall(r"PushedFilters: \[(.*?)\]", text)
    assert sum("LessThanOrEqual(event_dt_utc" in p for p in pushed) == 2
    assert any("GreaterThan(clicks,0)" in p for p in pushed)
    assert any("EqualTo(event_subtype,order)" in p for p in pushed)
    assert "EqualTo(ad_product_type,sponsored_products)" in plan(tables[0].where(traffic.of_type(traffic.PRODUCTS)))


def test_sampling_comes_before_every_shuffle(plan, tables):
    text = plan(user_row(*tables, "2024-01-25 00:00:00", sample_percent=1))
    for branch in text.split("FileScan")[:-1]:
        assert "md5" in branch.rsplit("Exchange", 1)[-1]


def test_click_pairs_are_not_joined(plan, tables):
    ads = tables[0]
    clicked = ads.where((F.col("clicks") > 0) & cutoff(ads, "2024-01-25 00:00:00").up_to)
    assert "Join" not in plan(clicks.click_interval(clicked))


@pytest.mark.parametrize("n_classes", [2, 40])
def test_splits_do_not_shuffle_rows(spark, plan, tables, n_classes):
    """Cuts and weights of the classes are small tables that are sent to the rows."""
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    ads = tables[0].withColumn("key", F.monotonically_increasing_id()).withColumn("label", F.col("key") % n_classes)
    for split in (balance.stratified_split, balance.stratified_folds, balance.class_weights):
        text = plan(split(ads, "label", "key") if split is not balance.class_weights else split(ads, "label"))
        assert "Exchange hashpartitioning" not in text and "Exchange SinglePartition" not in text and "Exchange range" not in text
        assert text.count("BroadcastHashJoin") == 1


@pytest.mark.parametrize("name", ["audience_top_pct", "audience_top_pct_tied", "audience_threshold"])
def test_filters_do_not_shuffle(spark, plan, name):
    text = plan(entry.queries()[name](spark, SMALL_DIR))
    assert "Exchange" not in text and "Sort" not in text and "Filter" in text


def test_top_users_are_merged_from_heaps(spark, plan):
    """No sort and no window: a bounded heap in each task, merged in three levels."""
    text = plan(entry.queries()["audience_top_n"](spark, SMALL_DIR))
    assert text.count("Exchange hashpartitioning") == 3 and "Window" not in text and "Exchange range" not in text
    assert text.count("collect_top_k") >= 6


def test_no_query_multiplies_tables(spark, plan):
    """Cross joins, Python workers and whole-table windows do not appear in any feature plan."""
    for name, run in entry.queries().items():
        if name.startswith(("feat_", "qc_", "prep_", "audience_", "metric_", "src_", "flt_", "join_")):
            text = plan(run(spark, SMALL_DIR))
            assert "CartesianProduct" not in text and "NestedLoop" not in text, name
            assert "Python" not in text, name
            if name not in ("prep_label_encode", "audience_ranked"):  # offsets of partitions
                assert "Exchange SinglePartition" not in text or "Window" not in text, name
