import itertools

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import grouping as g
from tidemark.operators import joins as j


@pytest.fixture(scope="module")
def values(spark):
    return spark.createDataFrame(
        [("x", 1.5), ("x", None), ("y", -2.0), ("y", 7.0), (None, 3.0), (None, 4.0)], "k string, v double"
    )


def by_key(df):
    return {r["k"]: tuple(r)[1:] for r in df.collect()}


def test_null_is_zero(values):
    found = by_key(g.aggregate_by(values, ["k"], s=g.total("v"), a=g.average("v"), n=g.count()))
    assert found == {"x": (1.5, 0.75, 2), "y": (5.0, 2.5, 2), None: (7.0, 3.5, 2)}
    assert by_key(g.sum_by(values, ["k"], "v", "s", "bigint"))["x"] == (1,)


def test_extremes_keep_the_value(spark, values):
    found = by_key(g.aggregate_by(values, ["k"], lo=g.minimum("v"), hi=g.maximum("v", ignore=[7.0, 4.0])))
    assert found == {"x": (None, 1.5), "y": (-2.0, -2.0), None: (3.0, 3.0)}
    text = spark.createDataFrame([("a", "10"), ("a", "9")], "k string, v string")
    assert by_key(g.aggregate_by(text, ["k"], hi=g.maximum("v"))) == {"a": ("10",)}
    assert by_key(g.aggregate_by(text, ["k"], hi=g.maximum("v", ignore=["9", "10"]))) == {"a": (None,)}


def test_first_and_last(spark, rows_of):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (1, 2, "b"), (2, 5, "z")], "k int, o int, s string")
    assert rows_of(g.first(df, ["k"], ["s"], ["o"])) == [(1, "a"), (2, "z")]
    assert rows_of(g.last(df, ["k"], ["s"], ["o"])) == [(1, "c"), (2, "z")]
    assert rows_of(g.first(df, ["k"], ["s"], ["o"], ignore=[("a",), ("z",)])) == [(1, "b")]


def test_unique_keeps_whole_rows(spark, rows_of):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "z"), (None, 3, "n")], "k int, o int, s string")
    assert rows_of(g.unique(df, ["k"], ["o"])) == sorted([(1, 1, "z"), (None, 3, "n")], key=repr)
    assert g.distinct_fields(df, "k").count() == 2


def test_merge_checks_fields(values, rows_of):
    assert g.merge(values, values).count() == 12
    assert g.union_distinct(values, values).count() == 6
    with pytest.raises(ValueError):
        g.merge(values, values.select("k"))


def test_group_sorted_runs_over_partitions(spark):
    df = spark.range(2_000).select((F.col("id") % 3).alias("k"), (F.lit(2_000) - F.col("id")).alias("o"))
    for reverse in (False, True):
        found = [tuple(r) for r in g.group_sorted(df, ["k"], ["o"], reverse, partitions=7).collect()]
        assert found == sorted(found, reverse=reverse)
    spread = g.group_sorted(df, ["k"], ["o"], partitions=7).select("k", F.spark_partition_id().alias("p"))
    assert spread.distinct().groupBy("k").count().agg(F.max("count")).first()[0] > 1


STATE = T.StructType(
    [T.StructField("k", T.StringType()), T.StructField("s", T.DoubleType()), T.StructField("n", T.LongType())]
)


def test_custom_aggregate(spark):
    def partial(rows):
        return rows.groupby("k", as_index=False, dropna=False).agg(s=("v", "sum"), n=("v", "size"))

    def merge(states):
        return states.groupby("k", as_index=False, dropna=False)[["s", "n"]].sum()

    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise((F.col("id") % 500).cast("string")).alias("k"),
        F.col("id").cast("double").alias("v"),
    )
    mine = by_key(g.custom_aggregate(df, ["k"], partial, merge, STATE, held_keys=50, fan_in=4))
    assert mine == by_key(df.groupBy("k").agg(F.sum("v").alias("s"), F.count("v").alias("n")))


def busiest_merge(spark, tasks):
    """The most states of one key that met in one call of the merge function, below a fan-in of 4."""

    def partial(rows):
        return rows.groupby("k", as_index=False).agg(n=("v", "size")).assign(met=1)

    def merge(states):
        made = states.groupby("k", as_index=False).agg(n=("n", "sum"), here=("n", "size"), met=("met", "max"))
        return made.assign(met=made[["here", "met"]].max(axis=1))[["k", "n", "met"]]

    state = T.StructType.fromDDL("k long, n long, met long")
    df = spark.range(0, 6400, 1, tasks).select(F.lit(1).cast("long").alias("k"), F.col("id").alias("v"))
    row = g.custom_aggregate(df, ["k"], partial, merge, state, fan_in=4).first()
    assert row["n"] == 6400
    return row["met"]


def test_custom_aggregate_merges_no_more_when_there_are_more_tasks(spark):
    assert g.partitions_of(spark.range(0, 10, 1, 7)) == 7
    assert g.partitions_of(spark.range(10).repartition(9, "id").where("id > 3")) == 9
    # Parts of a key rarely share a task, and small ones are not put together.
    wanted = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        found = [busiest_merge(spark, tasks) for tasks in (16, 32, 64)]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert max(found) <= 8


def test_custom_aggregate_of_everything_and_of_null_keys(spark):
    state = T.StructType.fromDDL("n long")

    def partial(rows):
        return pd.DataFrame({"n": [len(rows)]})

    def merge(states):
        return pd.DataFrame({"n": [states["n"].sum()]})

    assert g.custom_aggregate(spark.range(0, 1000, 1, 9), [], partial, merge, state, fan_in=3).collect() == [(1000,)]
    assert g.custom_aggregate(spark.range(0), [], partial, merge, state).count() == 0
    keyed = T.StructType.fromDDL("k long, j string, n long")
    df = spark.range(0, 3000, 1, 10).selectExpr("nullif(id % 50, 3) AS k", "nullif(string(id % 2), '1') AS j")

    def count(rows):
        return rows.groupby(["k", "j"], as_index=False, dropna=False).size().rename(columns={"size": "n"})

    def add(states):
        return states.groupby(["k", "j"], as_index=False, dropna=False)["n"].sum()

    made = g.custom_aggregate(df, ["k", "j"], count, add, keyed, held_keys=7, fan_in=2)
    want = df.groupBy("k", "j").count().collect()
    assert sorted(map(tuple, made.collect()), key=repr) == sorted(map(tuple, want), key=repr)


def test_stream_buffer_reads_a_big_group_bit_by_bit(spark):
    """One group of two million rows, a thousand at a time, in order, with state between them."""
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")

    def steps(key, frames):
        last, most, rows = -1, 0, 0
        for frame in frames:
            assert list(frame.index) == list(range(len(frame))) and frame["v"].is_monotonic_increasing and frame["v"].iloc[0] == last + 1
            last, most, rows = frame["v"].iloc[-1], max(most, len(frame)), rows + len(frame)
        yield pd.DataFrame({"k": [key[0]], "rows": [rows], "most": [most], "last": [last]})

    try:
        rows = spark.range(0, 2_000_000, 1, 8).selectExpr("1 AS k", "1999999 - id AS v")
        made = g.stream_buffer(rows, ["k"], steps, "k int, rows long, most long, last long", ["v"])
        assert made.collect() == [(1, 2_000_000, 1000, 1_999_999)]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_stream_buffer_groups_nulls_sorts_once_and_need_not_read_on(spark, values, rows_of):
    def first(key, frames):
        yield next(frames).head(1).assign(k=key[0])

    made = g.stream_buffer(values, ["k"], first, values.schema, ["v"])
    assert rows_of(made) == sorted([("x", None), ("y", -2.0), (None, 3.0)], key=repr)
    plan = made._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Sort [") == 1 and plan.count("Exchange") == 1
    assert g.stream_buffer(values.where("false"), ["k"], first, values.schema).count() == 0
    nothing = g.stream_buffer(values, ["k"], lambda key, frames: [], values.schema)
    assert nothing.count() == 0


def test_key_runs():
    keys = pd.DataFrame({"a": [1.0, 1.0, None, None, 2.0], "b": ["x", "x", "x", None, None]})
    assert list(g.key_runs(keys)) == [((1.0, "x"), 0, 2), ((None, "x"), 2, 3), ((None, None), 3, 4), ((2.0, None), 4, 5)]
    whole = pd.DataFrame({"a": pd.array([2**60, 2**60 + 1, None, None], "Int64")})
    assert list(g.key_runs(whole)) == [((2**60,), 0, 1), ((2**60 + 1,), 1, 2), ((None,), 2, 4)]
    assert list(g.key_runs(pd.DataFrame(index=range(3)))) == [((), 0, 3)]
    assert list(g.key_runs(keys.head(0))) == []


def test_stream_buffer_over_many_groups(spark):
    """Groups that begin and end anywhere in a batch, of keys of two kinds."""
    rows = spark.range(0, 30_000, 1, 8).selectExpr("id % 7001 AS k", "string(id % 2) AS j", "id AS v")

    def count(key, frames):
        frames = list(frames)
        yield pd.DataFrame({"k": [key[0]], "j": [key[1]], "n": [sum(map(len, frames))]})

    made = g.stream_buffer(rows, ["k", "j"], count, "k long, j string, n long")
    assert sorted(map(tuple, made.collect())) == sorted(map(tuple, rows.groupBy("k", "j").count().collect()))


def test_buffer(values, rows_of):
    first = g.buffer(values, ["k"], lambda rows: rows.head(1), values.schema, ["v"])
    assert rows_of(first) == sorted([("x", None), ("y", -2.0), (None, 3.0)], key=repr)


def test_buffer_takes_a_group_of_any_size(spark):
    rows = spark.range(0, 1_000_001, 1, 4).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    count = g.buffer(rows, ["k"], lambda group: pd.DataFrame({"n": [len(group)]}), "n long")
    assert count.first()["n"] == 1_000_001


# -- joins


def brute_force(streams, required):
    keys = {k for rows in streams for k, _ in rows}
    out = []
    for key in keys:
        held = [[r for r in rows if r[0] == key] for rows in streams]
        if all(h or not need for h, need in zip(held, required)):
            held = [h or [(None, None)] for h in held]
            out += [sum(combo, ()) for combo in itertools.product(*held)]
    return sorted(out, key=repr)


def frames(spark, streams):
    return [
        (spark.createDataFrame(rows, f"k{i} int, v{i} int"), [f"k{i}"]) for i, rows in enumerate(streams)
    ]


A = [(1, 10), (1, 11), (None, 12), (2, 13)]
B = [(1, 20), (None, 21), (3, 22), (3, 23)]
C = [(1, 30), (4, 31), (3, 32)]
FLAGS = {"inner": (True, True, True), "left": (True, True, False), "right": (False, True, True), "outer": (False,) * 3}


@pytest.mark.parametrize("joiner", [*FLAGS, (False, True, False), (True, False, False)])
def test_three_streams(spark, rows_of, joiner):
    required = FLAGS.get(joiner, joiner) if isinstance(joiner, str) else joiner
    assert rows_of(j.co_group(frames(spark, [A, B, C]), joiner)) == brute_force([A, B, C], required)


cells = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.integers(0, 3)), max_size=8)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(cells, min_size=2, max_size=3), st.data())
def test_any_streams(spark, rows_of, streams, data):
    required = [data.draw(st.booleans()) for _ in streams]
    assert rows_of(j.co_group(frames(spark, streams), required)) == brute_force(streams, required)


@pytest.mark.parametrize("joiner", list(FLAGS))
@pytest.mark.parametrize("limit", ["64MB", "-1"])
def test_hash_join_small_and_big(spark, rows_of, joiner, limit):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for key in keys:
            spark.conf.set(key, limit)
        joined = j.hash_join(frames(spark, [A, B, C]), joiner)
        assert rows_of(joined) == brute_force([A, B, C], FLAGS[joiner])
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_names(spark, rows_of):
    stream = frames(spark, [A])[0]
    with pytest.raises(ValueError, match="clash"):
        j.co_group([stream, stream])
    twice = j.co_group([stream, stream], declared=["a", "b", "c", "d"])
    assert rows_of(twice) == brute_force([A, A], (True, True))
    with pytest.raises(ValueError):
        j.co_group([stream, (stream[0], ["k0", "v0"])], declared=["a", "b", "c", "d"])
    with pytest.raises(ValueError):
        j.co_group([stream, stream], "sideways", ["a", "b", "c", "d"])


def test_custom_joiner(spark, rows_of):
    def widths(left, right):
        key = (left["k0"] if len(left) else right["k1"]).iloc[0]
        return pd.DataFrame({"k": [key], "l": [len(left)], "r": [len(right)]})

    left, right = frames(spark, [A, B])
    rows = j.co_group_apply(left, right, widths, "k double, l int, r int")
    assert {(r["l"], r["r"]) for r in rows.collect()} == {(2, 1), (1, 1), (1, 0), (0, 2)}


def test_streamed_joiner(spark, rows_of):
    def widths(held, frames):
        frames = list(frames)
        key = (held["k0"] if len(held) else frames[0]["k1"]).iloc[0]
        yield pd.DataFrame({"k": [key], "l": [len(held)], "r": [sum(map(len, frames))]})

    left, right = frames(spark, [A, B])
    rows = j.co_group_stream(left, right, widths, "k double, l int, r int").collect()
    assert {(None if r["k"] != r["k"] else r["k"], r["l"], r["r"]) for r in rows} == {
        (1, 2, 1), (None, 1, 1), (2, 1, 0), (3, 0, 2)
    }


def test_streamed_joiner_keeps_types_and_names_of_both_sides(spark, rows_of):
    """Fields of the same names, nulls, and whole numbers that must not turn into floats."""
    left = spark.createDataFrame([(1, 2**60 + 1, "a"), (1, None, None), (2, 5, "c")], "k int, v bigint, s string")
    right = spark.createDataFrame([(1, "z", 7), (1, "y", None), (4, "w", 3)], "k int, s string, n int")

    def pairs(held, frames):
        for frame in frames:
            yield held.rename(columns={"s": "ls"}).merge(frame, on="k", how="right")[["k", "v", "ls", "s", "n"]]

    schema = "k int, v bigint, ls string, s string, n int"
    want = left.withColumnRenamed("s", "ls").join(right, "k", "right").select("k", "v", "ls", "s", "n")
    got = j.co_group_stream((left, ["k"]), (right, ["k"]), pairs, schema, order=["s"])
    assert rows_of(got) == rows_of(want)
    assert j.co_group_stream((left.where("false"), ["k"]), (right.where("false"), ["k"]), pairs, schema).count() == 0


@pytest.mark.parametrize("splits", [1, 16])
def test_streamed_joiner_on_a_hot_key(spark, splits):
    """A key with a third of a million rows is streamed by one task, or shared by several."""
    right = spark.range(0, 1_000_000, 1, 8).selectExpr("if(id % 3 = 0, 7, id) AS k", "id AS v").where("k IN (7, 8, 10)")
    left = spark.createDataFrame([(7, "hot"), (8, "cold")], "k long, name string")

    def count(held, frames):
        from pyspark import TaskContext

        rows = sum(map(len, frames))
        yield held.assign(rows=rows, task=TaskContext.get().partitionId())[["name", "rows", "task"]]

    wanted = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        made = j.co_group_stream((left, ["k"]), (right, ["k"]), count, "name string, rows long, task int", splits=splits)
        found = made.toPandas().groupby("name").agg(rows=("rows", "sum"), tasks=("task", "nunique"))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert found.loc["hot", "rows"] == 333_335 and found.loc["cold", "rows"] == 1
    assert found.loc["hot", "tasks"] == 1 if splits == 1 else found.loc["hot", "tasks"] > 4
