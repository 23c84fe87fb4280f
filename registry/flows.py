"""Queries of checkpoints, skip rules, counters and reusable parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.base import query, table
from tidemark.operators import grouping, quality, rows
from tidemark.plans import flow
from tidemark.sources import files
from tidemark.sources.scratch import Scratch


@query(
    "checkpoint",
    "SELECT o_custkey, count(*) AS n FROM orders WHERE o_totalprice > 1000 GROUP BY o_custkey",
)
def _(spark, folder):
    kept = flow.checkpoint(table(spark, folder, "orders").where("o_totalprice > 1000"))
    return grouping.count_by(kept, ["o_custkey"], "n")


@query("checkpoint_named_sink", "SELECT l_suppkey, sum(l_quantity) AS q FROM lineitem GROUP BY l_suppkey")
def _(spark, folder):
    sink = Scratch(spark, "named").path("sink")
    kept = flow.checkpoint(table(spark, folder, "lineitem").select("l_suppkey", "l_quantity"), sink=sink)
    return grouping.sum_by(kept, ["l_suppkey"], "l_quantity", "q")


# The second and third run find the sink there and fresh; after the source is
# written again the fourth run does the work once more.
@query(
    "skip_rules",
    """
SELECT 'first' AS run, true AS ran UNION ALL SELECT 'exists', false
UNION ALL SELECT 'fresh', false UNION ALL SELECT 'stale', true""",
)
def _(spark, folder):
    scratch = Scratch(spark, "skip")
    source, sink = scratch.path("source"), scratch.path("sink")
    files.write_table(table(spark, folder, "orders").select("o_custkey"), source)

    def job():
        files.write_table(files.read_table(spark, source).distinct(), sink, "REPLACE")
        return True

    ran = {"first": flow.run_unless(flow.sinks_exist(spark, [sink]), job)}
    ran["exists"] = flow.run_unless(flow.sinks_exist(spark, [sink]), job)
    ran["fresh"] = flow.run_unless(flow.sinks_fresh(spark, [source], [sink]), job)
    files.write_table(table(spark, folder, "orders").select("o_custkey"), source, "REPLACE")
    ran["stale"] = flow.run_unless(flow.sinks_fresh(spark, [source], [sink]), job)
    outcome = F.array(
        *[F.struct(F.lit(k).alias("run"), F.lit(bool(v)).alias("ran")) for k, v in ran.items()]
    )
    one = files.read_table(spark, sink).agg(F.count(F.lit(1)).alias("n")).where("n > 0")
    return one.select(F.inline(outcome))


@query(
    "row_counters",
    """
SELECT count(*) AS read, count(*) FILTER (o_custkey % 2 = 0) AS written,
       count(*) FILTER (o_custkey % 2 <> 0) AS trapped
FROM orders""",
)
def _(spark, folder):
    scratch = Scratch(spark, "counters")
    counters = flow.RowCounters()
    source = counters.read(table(spark, folder, "orders").select("o_orderkey", "o_custkey"))
    flow.checkpoint(source, scratch, name="all")
    good, rejected = quality.trap(
        table(spark, folder, "orders").select("o_orderkey", "o_custkey"), [quality.holds("o_custkey % 2 = 0")]
    )
    files.write_table(counters.written(good), scratch.path("good"))
    files.write_table(counters.trapped(rejected), scratch.path("rejected"))
    counts = counters.get()
    return spark.createDataFrame([(counts["read"], counts["written"], counts["trapped"])], "read bigint, written bigint, trapped bigint")


@query(
    "write_with_trap",
    """
SELECT o_orderkey, CASE WHEN o_custkey % 2 = 0 THEN '' ELSE 'expression' END AS broken FROM orders""",
)
def _(spark, folder):
    good, rejected = quality.write_with_trap(
        table(spark, folder, "orders").select("o_orderkey", "o_custkey"),
        [quality.holds("o_custkey % 2 = 0")],
        Scratch(spark, "trap").path("table"),
    )
    broken = rejected.select("o_orderkey", F.array_join("broken", ",").alias("broken"))
    return good.select("o_orderkey", F.lit("").alias("broken")).unionByName(broken)


@query(
    "sub_assembly",
    """
SELECT l_partkey, count(*) AS n FROM lineitem WHERE NOT (l_quantity > 40) GROUP BY l_partkey""",
)
def _(spark, folder):
    return flow.assemble(
        table(spark, folder, "lineitem"),
        lambda df: rows.expression_filter(df, "l_quantity > 40"),
        lambda df: rows.retain(df, "l_partkey"),
        lambda df: grouping.count_by(df, ["l_partkey"], "n"),
    )
