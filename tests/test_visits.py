import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark import schema
from tidemark.functions import buckets
from tidemark.plans import views


def brute_force(times):
    visits = bounces = size = 0
    last = None
    for t in sorted(times):
        if last is None or t - last > 900:
            visits += 1
            bounces += size == 1
            size = 0
        size += 1
        last = t
    return visits, bounces + (size == 1)


def analyzed(spark, times_by_key):
    rows = [(k, t) for k, times in times_by_key.items() for t in times]
    df = spark.createDataFrame(rows, "k int, ts int")
    return {r["k"]: (r["visits"], r["bounces"]) for r in views.analyze_visits(df, ["k"]).collect()}


def test_gap_of_exactly_900_and_901(spark):
    assert analyzed(spark, {1: [0, 900], 2: [0, 901], 3: [5], 4: [5, 5]}) == {
        1: (1, 0), 2: (2, 2), 3: (1, 1), 4: (1, 0),
    }


def test_visit_across_midnight(spark):
    late = 86_400 - 10
    times = {1: [late, 86_400 + 5], 2: [late, 86_400 + 895], 3: [-10, 5], 4: [late - 950, late, 86_400, 2 * 86_400 + 7]}
    assert analyzed(spark, times) == {k: brute_force(v) for k, v in times.items()}


def test_extreme_times(spark):
    assert analyzed(spark, {1: [-(2**31), 2**31 - 1]}) == {1: (2, 2)}


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.dictionaries(
        st.integers(1, 4), st.lists(st.integers(0, 3 * 86_400), min_size=1, max_size=60), min_size=1
    )
)
def test_any_times(spark, times):
    assert analyzed(spark, times) == {k: brute_force(v) for k, v in times.items()}


def test_busy_visitor_is_not_sent_whole_to_one_task(spark):
    """Views of the same 900 s are counted before any shuffle, and the windows work
    on these counts."""
    rng = random.Random(3)
    times = {1: [rng.randrange(5 * 86_400) for _ in range(20_000)], 2: [1]}
    assert analyzed(spark, times) == {k: brute_force(v) for k, v in times.items()}
    df = spark.createDataFrame([(1, 1)], "k int, ts int")
    plan = views.analyze_visits(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    steps = [line for line in reversed(plan.splitlines()) if "partial_count" in line or "Window" in line]
    assert "partial_count" in steps[0]
    windows = [line for line in steps if "Window [" in line]
    assert windows and all("_from" in line for line in windows)


def test_totals_agree_over_levels(spark, seed_views):
    view = views.page_view_batch_view(seed_views)
    totals = {r[0]: r[1] for r in view.groupBy("granularity").agg(F.sum("value")).collect()}
    assert totals == {"h": 11, "d": 11, "w": 11, "m": 11}


def test_sketch_error(spark):
    n = 200_000
    df = spark.range(n).select(
        schema.user_person(F.col("id") % 50_000).alias("person"),
        F.lit("http://a/b").alias("url"),
        F.col("id").alias("nonce"),
        (F.col("id") % 90_000).cast("int").alias("ts"),
    )
    found = {(r["granularity"], r["bucket"]): r["value"] for r in views.uniques_view(df).collect()}
    assert found[("m", 0)] == pytest.approx(50_000, rel=0.03)
    exact = df.groupBy(F.floor(F.col("ts") / 3600).alias("h")).agg(F.count_distinct("person").alias("n"))
    for r in exact.collect():
        assert found[("h", r["h"])] == pytest.approx(r["n"], rel=0.03)


def test_buckets(spark):
    df = spark.createDataFrame([(0,), (3599,), (3600,), (-1,), (-3600,), (2_419_200,)], "ts int")
    rows = df.select("ts", buckets.hour_bucket("ts").alias("hour"))
    assert [r["hour"] for r in rows.collect()] == [0, 0, 1, 0, -1, 672]
    levels = buckets.emit_granularities(rows.where("ts = 2419200"))
    assert {r["granularity"]: r["bucket"] for r in levels.collect()} == {"h": 672, "d": 28, "w": 4, "m": 1}


def test_keys_and_bytes(spark):
    one = spark.range(1)
    key = buckets.url_bucketed_key(F.lit("http://a/b"), F.lit("h"), F.lit(7))
    row = one.select(
        key.alias("key"),
        buckets.key_url(key).alias("url"),
        buckets.url_shard(key, 5).alias("shard"),
        buckets.serialized_long(F.lit(-2)).alias("long"),
        buckets.serialized_long_pair(F.lit(1), F.lit(258)).alias("pair"),
        buckets.serialized_string(F.lit("x")).alias("text"),
    ).first()
    assert row["key"] == "http://a/b/h-7"
    assert row["url"] == "http://a/b"
    assert 0 <= row["shard"] < 5
    assert bytes(row["long"]) == (-2).to_bytes(8, "big", signed=True)
    assert bytes(row["pair"]) == (1).to_bytes(8, "big") + (258).to_bytes(8, "big")
    assert row["text"] == "x"


def test_bounce_rate(spark):
    df = spark.createDataFrame([(1, 4), (0, 0)], "b long, v long")
    assert [r[0] for r in df.select(buckets.bounce_rate("b", "v")).collect()] == [0.25, None]
    assert df.where("v > 0").select(buckets.bounce_rate("b", "v", legacy=True)).first()[0] == 0
    with pytest.raises(Exception, match="(?i)divi"):
        df.select(buckets.bounce_rate("b", "v", legacy=True)).collect()
