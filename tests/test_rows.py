import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.functions import coerce
from tidemark.operators import rows


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame([(1, "a", None), (2, None, None), (3, "c", 9)], "k int, s string, n int")


def test_each_outputs(df, rows_of):
    made = {"up": F.upper("s")}
    assert rows.each(df, made).columns == ["k", "s", "n", "up"]
    assert rows.each(df, made, "RESULTS").columns == ["up"]
    assert rows.each(df, {"s": F.upper("s")}, "REPLACE").columns == ["k", "s", "n"]
    assert rows.each(df, made, "SWAP", ["s"]).columns == ["k", "n", "up"]
    assert rows.each(df, made, ["up", "k"]).columns == ["up", "k"]
    with pytest.raises(ValueError):
        rows.each(df, {"s": F.upper("s")})
    with pytest.raises(ValueError):
        rows.each(df, made, "REPLACE")


def test_fields(df):
    assert rows.retain(df, "s").columns == ["s"]
    assert rows.discard(df, "s").columns == ["k", "n"]
    assert rows.rename(df, {"s": "t"}).columns == ["k", "t", "n"]
    with pytest.raises(ValueError):
        rows.rename(df, {"zzz": "t"})
    with pytest.raises(ValueError):
        rows.discard(df, "zzz")


def test_filters(df):
    def keys(found):
        return sorted(r["k"] for r in found.collect())

    assert keys(rows.filter_null(df, "s", "n")) == [3]
    assert keys(rows.filter_not_null(df, "s", "n")) == [2]
    assert keys(rows.expression_filter(df, "n > 5")) == [1, 2]
    big, lettered = F.col("k") > 1, F.col("s").isNotNull()
    assert keys(rows.remove(df, rows.all_of(big, lettered))) == [1, 2]
    assert keys(rows.remove(df, rows.any_of(big, lettered))) == []
    assert keys(rows.remove(df, rows.one_of(big, lettered))) == [3]
    assert keys(rows.remove(df, rows.negate(big))) == [2, 3]
    # An unknown condition removes nothing.
    assert keys(rows.remove(df, F.col("n") > 5)) == [1, 2]
    assert keys(rows.remove(df, rows.negate(F.col("n") > 5))) == [3]


def test_set_value(df):
    found = df.select("k", rows.set_value(F.col("n") > 5, "kept", "removed").alias("v")).collect()
    assert {r["k"]: r["v"] for r in found} == {1: "kept", 2: "kept", 3: "removed"}


def test_un_group(spark, rows_of):
    wide = spark.createDataFrame([(1, 2, 3, 4, 5)], "g int, a int, b int, c int, d int")
    assert rows_of(rows.un_group(wide, ["g"], [["a", "b"], ["c", "d"]])) == [(1, 2, 3), (1, 4, 5)]
    assert rows_of(rows.un_group(wide, ["g"], [["b"]])) == [(1, 3)]
    assert rows_of(rows.un_group_every(wide, ["g"], 2, ["g", "x", "y"])) == [(1, 2, 3), (1, 4, 5)]
    with pytest.raises(ValueError):
        rows.un_group(wide, ["g"], [["a"], ["b", "c"]])
    with pytest.raises(ValueError):
        rows.un_group_every(wide, ["g"], 3)


def test_limit_and_sample(spark):
    numbers = spark.range(10_000)
    assert rows.limit(numbers, 37).count() == 37
    drawn = rows.sample(numbers, 0.2, seed=1)
    assert 1_700 < drawn.count() < 2_300
    assert drawn.distinct().count() == drawn.count()


def test_coerce(spark, rows_of):
    text = spark.createDataFrame([("12", "TRUE", "1.5"), (None, None, None), ("-7", "yes", "x")], "a string, b string, c string")
    found = coerce.coerce(text, {"a": "int", "b": "boolean", "c": "double"}, safe=True)
    assert rows_of(found) == sorted([(12, True, 1.5), (0, False, 0.0), (-7, False, None)], key=repr)
    with pytest.raises(Exception, match="cannot coerce"):
        coerce.coerce(text, {"c": "double"}).collect()
    numbers = spark.createDataFrame([(2.9,), (-2.9,), (None,)], "x double")
    assert rows_of(coerce.coerce(numbers, {"x": "long"})) == sorted([(2,), (-2,), (0,)], key=repr)
    assert rows_of(coerce.coerce(numbers.limit(1), {"x": "string"})) == [("2.9",)]
    with pytest.raises(ValueError):
        coerce.coerce(numbers, {"x": "decimal"})


@pytest.fixture
def repeats():
    def function(batch):
        """As many results as ``n`` says, none for null."""
        times = batch.column("n").to_pylist()
        places = [i for i, n in enumerate(times) for _ in range(n or 0)]
        turn = [t for n in times for t in range(n or 0)]
        yield places, pa.table({"turn": pa.array(turn, pa.int64())})

    return function


def test_row_function_gives_any_number_of_rows(spark, rows_of, repeats):
    df = spark.createDataFrame([(1, "a", None), (2, None, 0), (3, "c", 1), (4, "d", 3), (4, "d", 3)], "k int, s string, n int")
    every = rows.each_row(df, repeats, "turn bigint", arguments=["n"])
    assert every.columns == ["k", "s", "n", "turn"]
    want = [(3, "c", 1, 0)] + [(4, "d", 3, t) for t in range(3)] * 2
    assert rows_of(every) == sorted(want, key=repr)
    assert rows_of(rows.each_row(df, repeats, "turn bigint", "RESULTS")) == sorted([(w[3],) for w in want], key=repr)
    assert rows.each_row(df, repeats, "turn int", "SWAP", ["n"]).columns == ["k", "s", "turn"]
    assert rows_of(rows.each_row(df, repeats, "turn int", ["turn", "k"], ["n"])) == sorted([(w[3], w[0]) for w in want], key=repr)
    assert rows.each_row(df.where("false"), repeats, "turn bigint").count() == 0


def test_row_function_replaces_in_place(spark, rows_of):
    df = spark.createDataFrame([(1, "b a", 2.5), (2, None, None), (3, "", 1.0)], "k int, s string, x double")
    words = rows.row_function(lambda s: [(w,) for w in (s or "").split()], "s string")
    assert rows_of(rows.each_row(df, words, "s string", "REPLACE", ["s"])) == [(1, "a", 2.5), (1, "b", 2.5)]


def test_row_function_refuses_clashing_names(df, repeats):
    for output in ("ALL", ["k", "s"]):
        with pytest.raises(ValueError, match="twice"):
            rows.each_row(df, repeats, "s bigint", output, ["n"])
    with pytest.raises(ValueError, match="no field to replace"):
        rows.each_row(df, repeats, "turn bigint", "REPLACE", ["n"])
    with pytest.raises(ValueError, match="no such fields"):
        rows.each_row(df, repeats, "turn bigint", ["nothing"], ["n"])
    with pytest.raises(ValueError, match="no such fields"):
        rows.each_row(df, repeats, "turn bigint", arguments=["nothing"])
    with pytest.raises(ValueError, match="twice"):
        rows.each_row(df.select("k", "k", "n"), repeats, "turn bigint", arguments=["n"])


def test_row_function_hands_many_results_on_in_parts(spark):
    many = rows.row_function(lambda n: ((i,) for i in range(n)), "i bigint", at_once=1000)
    sizes = [made.num_rows for _, made in many(pa.record_batch({"n": [2500, 0, 1]}))]
    assert sizes == [1000, 1000, 501]
    assert rows.each_row(spark.range(3).selectExpr("id * 100000 AS n"), many, "i bigint").count() == 300_000


def test_row_function_reads_only_what_it_needs(spark, repeats):
    wide = spark.range(5).selectExpr("id AS n", "id * 2 AS k", "uuid() AS unused")
    plan = rows.each_row(wide, repeats, "turn bigint", ["k", "turn"], ["n"])._jdf.queryExecution().optimizedPlan().toString()
    assert "unused" not in plan
