import pytest
from pyspark.sql import functions as F

from tidemark.operators import observing
from tidemark.operators import quality as q


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(
        [(1, "a", "a"), (2, None, "b"), (3, None, None), (4, "a", "b")], "k int, s string, t string"
    )


def kept(df, *rules, level=q.Level.STRICT):
    good, rejected = q.trap(df, list(rules), level)
    keys = sorted(r["k"] for r in good.collect())
    assert sorted(r["k"] for r in rejected.collect()) == sorted({1, 2, 3, 4} - set(keys))
    return keys


def test_rules(df):
    both = ["s", "t"]
    assert kept(df, q.equals(both, ["a", "b"])) == [4]
    assert kept(df, q.equals(both, [None, "b"])) == [2]
    assert kept(df, q.not_equals(both, ["a", "b"])) == [1, 2, 3]
    assert kept(df, q.equals_all(both, "a")) == [1]
    assert kept(df, q.all_null(both)) == [3]
    assert kept(df, q.none_null(both)) == [1, 4]
    assert kept(df, q.matches(both, "a\t")) == [1, 4]
    assert kept(df, q.matches(both, "a\t", negate=True)) == [2, 3]
    assert kept(df, q.matches_all(both, "^[ab]$")) == [1, 4]
    assert kept(df, q.matches_all(both, "b", negate=True)) == [1, 3]
    assert kept(df, q.holds("k > 2")) == [3, 4]
    # An unknown outcome is not a pass.
    assert kept(df, q.holds("s = 'a'")) == [1, 4]


def test_levels(df):
    strict, valid = q.none_null(["s"]), q.holds("k > 1", q.Level.VALID)
    assert kept(df, strict, valid) == [4]
    assert kept(df, strict, valid, level=q.Level.VALID) == [2, 3, 4]
    assert kept(df, strict, valid, level=q.Level.NONE) == [1, 2, 3, 4]


def test_rejected_rows_say_why(df):
    _good, rejected = q.trap(df, [q.none_null(["s"]), q.holds("k < 3")])
    assert {r["k"]: r["broken"] for r in rejected.collect()} == {
        2: ["not_null"], 3: ["not_null", "expression"], 4: ["expression"],
    }


def test_enforce(df):
    assert q.enforce(df, [q.holds("k > 0")]).count() == 4
    assert q.enforce(df, [q.holds("k > 1")], q.Level.NONE).count() == 4
    with pytest.raises(Exception, match="assertion not_null failed"):
        q.enforce(df, [q.none_null(["s"])]).collect()


def test_enforce_reads_the_rule_fields_only(spark, folder):
    spark.range(10).select("id", F.lit("x").alias("wide"), F.lit(1).alias("n")).write.parquet(f"{folder}/t")
    checked = q.enforce(spark.read.parquet(f"{folder}/t"), [q.none_null(["n"])]).select("id")
    plan = checked._jdf.queryExecution().executedPlan().toString()
    assert "wide" not in plan.split("ReadSchema")[1]


def test_write_with_trap(df, folder, rows_of):
    good, rejected = q.write_with_trap(df, [q.none_null(["s"])], f"{folder}/t")
    assert sorted(r["k"] for r in good.collect()) == [1, 4]
    assert sorted(r["k"] for r in rejected.collect()) == [2, 3]
    assert good.columns == df.columns


def test_sizes(df):
    assert q.check_size(df, "equals", 3) is df
    assert q.check_size(df, "less_than", 4) is df
    with pytest.raises(q.AssertionFailed):
        q.check_size(df, "more_than", 3)


def test_group_sizes(df):
    def failing(*args, **options):
        return sorted(str(r["t"]) for r in q.group_size_failures(df, ["t"], *args, **options).collect())

    assert failing("equals", 2) == ["None", "a"]
    assert failing("less_than", 2) == ["b"]
    assert failing("more_than", 1) == ["None", "a"]
    assert failing("more_than", 1, pattern="[a-c]") == ["a"]
    fine = q.aggregate_checked(df, ["t"], {"top": F.max("k")}, "more_than", 0)
    assert {r["t"]: r["top"] for r in fine.collect()} == {"a": 1, "b": 4, None: 3}
    with pytest.raises(Exception, match="group size"):
        q.aggregate_checked(df, ["t"], {"top": F.max("k")}, "more_than", 1).collect()


def test_counters(spark, df):
    watched, seen = observing.counter(df, "rows", lettered=F.col("s") == "a")
    watched.collect()
    assert observing.observed(seen) == {"rows": 4, "lettered": 2}
    nothing, unseen = observing.counter(df.where("false"), "none")
    nothing.collect()
    assert observing.observed(unseen).get("rows", 0) == 0
    ones, _ = observing.debug(df)
    assert {r["debug"] for r in ones.collect()} == {1}
    assert observing.debug(df, on=False) == (df, None)
    assert len(observing.peek(df, 2)) == 2
    with observing.status(spark, "at work"):
        assert spark.sparkContext.getLocalProperty("spark.job.description") == "at work"
    assert spark.sparkContext.getLocalProperty("spark.job.description") != "at work"


def test_counters_add_up(spark, df):
    counters = observing.Counters()
    first = counters.count(df, "letters", a=F.col("s") == "a", twice=2)
    second = counters.count(df.where("s = 'a'"), "letters", a=1)
    third = counters.count(spark.range(10), "numbers", total=F.col("id"), odd=F.when(F.col("id") % 2 == 1, F.col("id")))
    fourth = counters.count(spark.range(3))
    fifth = counters.count(spark.range(0), "none")
    for frame in (first, second, third, fourth, fifth):
        frame.write.format("noop").mode("overwrite").save()
    assert counters.values() == {
        "letters": {"a": 4, "twice": 8}, "numbers": {"total": 45, "odd": 25}, "rows": {"rows": 3}, "none": {"rows": 0}
    }


def test_status_finds_its_jobs(spark):
    assert observing.job_states(spark, "reading, part 1") == {}
    with observing.status(spark, "reading, part 1"):
        assert spark.range(10).repartition(2).count() == 10
        with observing.status(spark, "inside"):
            spark.range(3).collect()
    spark.range(4).collect()
    states = observing.job_states(spark, "reading, part 1")
    inside = observing.job_states(spark, "inside")
    assert inside and set(inside) < set(states) and set(states.values()) == {"SUCCEEDED"}
    assert not spark.sparkContext.getJobTags()
