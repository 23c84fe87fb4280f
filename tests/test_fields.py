import pytest

from tidemark.operators import fields


def test_lists():
    names = ["a", "b", "c"]
    assert fields.resolve(names, ["c", 0, -2]) == ["c", "a", "b"]
    assert fields.subtract(names, [-1]) == ["a", "b"]
    assert fields.append(names, ["d"]) == ["a", "b", "c", "d"]
    assert fields.merge(names, ["b", "x"]) == ["a", "b", "c", "x"]
    assert fields.rename(names, [0, "c"], ["x", "y"]) == ["x", "b", "y"]
    for wrong in (["z"], [3], [-4]):
        with pytest.raises(ValueError):
            fields.resolve(names, wrong)
    with pytest.raises(ValueError):
        fields.append(names, ["a"])


def test_frames(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert fields.select(df, [-1, "a"]).columns == ["c", "a"]
    assert fields.project(df, [1], ["z"]).collect()[0]["z"] == 2
