"""One key holds a third of all rows: its partition is split, on either side."""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from tidemark import schema
from tidemark.operators import joins
from tidemark.plans import identity


@contextmanager
def small_thresholds(spark):
    wanted = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "60KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "30KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def hot(spark, rows=60_000):
    """Keys of which 7 holds a third of the rows."""
    return spark.range(0, rows, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).cast("bigint").alias("k"),
        F.col("id").alias("v"),
    )


def test_busy_visitor_in_the_identity_join(spark):
    with small_thresholds(spark):
        views = hot(spark).select(
            schema.user_person("k").alias("person"),
            F.lit("http://a/b").alias("url"),
            F.col("v").alias("nonce"),
            F.lit(1).alias("ts"),
        )
        roots = spark.range(0, 40_000, 2).select(
            schema.user_person(F.col("id") + 1).alias("id"), schema.user_person("id").alias("root")
        )
        found = identity.normalize_user_ids(views, roots)
        rows = found.collect()
        assert len(rows) == 60_000
        assert sum(r["person"]["user_id"] == 6 for r in rows) >= 20_000
        assert "skew=true" in final_plan(found)


@pytest.mark.parametrize("joiner", ["left", "right", "outer"])
@pytest.mark.parametrize("hot_side", [0, 1])
def test_busy_key_on_either_side_of_an_outer_join(spark, joiner, hot_side):
    with small_thresholds(spark):
        few = spark.range(5, 30_000).select(F.col("id").alias("k2"), (F.col("id") * 2).alias("w"))
        streams = [(hot(spark), ["k"]), (few, ["k2"])]
        if hot_side:
            streams.reverse()
        joined = joins.co_group(streams, joiner)
        rows = joined.collect()
        plain = streams[0][0].join(
            streams[1][0], F.col("k") == F.col("k2"), {"outer": "full"}.get(joiner, joiner)
        )
        assert len(rows) == plain.count()
        assert sum(r["k"] == 7 and r["w"] == 14 for r in rows) == 20_001
        assert "skew=true" in final_plan(joined)


@pytest.mark.parametrize("joiner", ["inner", "left", "right", "outer"])
@pytest.mark.parametrize("place", [0, 1, 2])
def test_busy_key_in_three_streams(spark, joiner, place):
    with small_thresholds(spark):
        few = [
            spark.range(5, 30_000).select(F.col("id").alias(f"k{i}"), (F.col("id") * i).alias(f"w{i}"))
            for i in (1, 2)
        ]
        streams = [(few[0], ["k1"]), (few[1], ["k2"])]
        streams.insert(place, (hot(spark), ["k"]))
        joined = joins.co_group(streams, joiner)
        rows = joined.collect()
        assert sum(r["k"] == 7 and r["w1"] == 7 and r["w2"] == 14 for r in rows) == 20_001
        keys = hot(spark).groupBy("k").count().collect()
        size = {r["k"]: r["count"] for r in keys}
        needed = {"inner": (0, 1, 2), "left": (0, 1), "right": (1, 2), "outer": ()}[joiner]
        every = set(size) | set(range(5, 30_000))
        there = [k for k in every if all((k in size) if i == place else 5 <= k < 30_000 for i in needed)]
        assert len(rows) == sum(size.get(k, 1) for k in there)
        assert "skew=true" in final_plan(joined)
