"""Queries that hand back every row of their table, on rows of their own."""

from registry import QUERIES


def test_debug_keeps_every_row(spark, folder, rows_of):
    ids = [1, 2, 2, None]
    spark.createDataFrame([(i, 1.0) for i in ids], "event_id bigint, value double").write.parquet(f"{folder}/events.parquet")
    got = QUERIES["debug_rows"](spark, folder)
    assert got.columns == ["event_id", "debug", "seen"]
    assert rows_of(got) == sorted(((i, 1, len(ids)) for i in ids), key=repr)


def test_debug_without_rows(spark, folder):
    spark.createDataFrame([], "event_id bigint, value double").write.parquet(f"{folder}/events.parquet")
    assert QUERIES["debug_rows"](spark, folder).collect() == []


def test_consolidate_keeps_every_row(spark, folder, rows_of):
    orders = [(k, 10 * k, status) for status in ("F", "O") for k in range(9)]
    orders += [(1, 5, "F"), (1, 5, "F"), (None, 7, "F"), (None, None, "O"), (-2, 1, "O")]
    odd = [(None, 3, None), (1, None, None), (2, 4, None)]
    spark.createDataFrame(orders + odd, "o_orderkey bigint, o_custkey bigint, o_orderstatus string").write.parquet(
        f"{folder}/orders.parquet"
    )
    got = QUERIES["dataset_consolidate"](spark, folder)
    assert got.columns == ["o_orderkey", "o_custkey", "o_orderstatus", "merged", "before", "after"]
    assert rows_of(got) == sorted(((*row, True, 3, 1) for row in orders + odd), key=repr)
