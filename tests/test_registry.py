"""Every registered query, beside its SQL, on the smallest tables."""

import os

import pytest

from registry import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the given tables are not here")


@pytest.fixture(scope="module")
def con():
    from tools.compare import connect

    return connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    from tools.compare import compare

    assert compare(spark, con, FOLDER, name) == ""


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name", ["traffic_view", "bounces_view", "co_group_three_mixed", "hash_join_outer", "normalize_user_ids", "group_sorted"]
)
def test_no_query_pairs_all_rows(spark, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_traffic_view_scans_and_shuffles_once(spark, folder):
    from registry.base import page_views
    from tidemark.plans import views

    page_views(spark, FOLDER).write.parquet(f"{folder}/pv")
    view = views.traffic_view(spark.read.parquet(f"{folder}/pv"))
    view.collect()
    plan = plan_of(view)
    final = plan.split("Initial Plan")[0]
    assert final.count("FileScan parquet") == 1
    assert final.count("ReusedExchange") >= 2
    scan = final.split("ReadSchema")[1]
    assert "nonce" not in scan and "url" in scan


def test_counting_views_reads_two_columns(spark, folder):
    from registry.base import page_views
    from tidemark.plans import views

    page_views(spark, FOLDER).write.parquet(f"{folder}/pv")
    plan = plan_of(views.page_view_batch_view(spark.read.parquet(f"{folder}/pv")))
    scan = plan.split("ReadSchema")[1].split("\n")[0]
    assert "url" in scan and "ts" in scan and "person" not in scan and "nonce" not in scan
    assert "PushedFilters: [IsNotNull(url)]" in plan


def test_entry(spark):
    import __spark_entry__ as contract

    df = contract.entry(spark)
    assert df.columns == ["url", "granularity", "bucket", "views", "visitors"]
    assert df.count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())
