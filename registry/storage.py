"""Queries that write tables to the shared folder and read them back."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from registry.base import LINKS, PV, query, raw_views, table
from registry.product import FACT_COUNTS, KEY, PAGE_VIEW_SQL, VISITS, wide_facts
from tidemark import schema
from tidemark.operators import observing
from tidemark.plans import batch
from tidemark.sources import facts, files
from tidemark.sources.dataset import Dataset
from tidemark.sources.history import History
from tidemark.sources.scratch import Scratch
from tidemark.sources.serving import BOUNCE_VIEW, PAGE_VIEW_VIEW, UNIQUE_VIEW, VIEWS, SpeedViews
from tidemark.sources.timeline import Timeline, week_of


def place(spark, name: str) -> str:
    return Scratch(spark, name).path("data")


# -- file sources and sinks


@query("text_lines", "SELECT c_custkey || chr(9) || c_name AS line FROM customer")
def _(spark, folder):
    path = place(spark, "text-lines")
    files.write_lines(table(spark, folder, "customer").select("c_custkey", "c_name"), path, parts=3)
    return files.read_lines(spark, path)


# Ids rise along each compressed file, in which keys do too.
@query(
    "text_lines_compressed",
    """
SELECT CAST(o_orderkey AS VARCHAR) AS line,
       CAST(row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS INTEGER) AS place FROM orders""",
)
def _(spark, folder):
    path = place(spark, "text-gz")
    orders = table(spark, folder, "orders").select("o_orderstatus", F.col("o_orderkey").cast("string").alias("value"), "o_orderkey")
    ordered = orders.repartition("o_orderstatus").sortWithinPartitions("o_orderstatus", "o_orderkey").drop("o_orderkey")
    ordered.write.partitionBy("o_orderstatus").option("compression", "gzip").text(path)
    lines = files.read_lines(spark, f"{path}/*", pattern="*.gz", order_key="at")
    status = table(spark, folder, "orders").select("o_orderstatus", F.col("o_orderkey").cast("string").alias("line"))
    within = Window.partitionBy("o_orderstatus").orderBy("at")
    return lines.join(status, "line").select("line", F.row_number().over(within).alias("place"))


# One file per market segment, with letters of two bytes; some lines end with a carriage return too.
@query(
    "text_lines_offset",
    """
SELECT segment, CAST(coalesce(sum(strlen(line) + 1 + part % 3 // 2) OVER w, 0) AS BIGINT) AS "offset", line
FROM (SELECT c_mktsegment AS segment, c_custkey AS part, 'ü' || c_custkey || ' ' || c_name AS line FROM customer)
WINDOW w AS (PARTITION BY segment ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
)
def _(spark, folder):
    path = place(spark, "text-offsets")
    lines = table(spark, folder, "customer").select(
        "c_mktsegment",
        "c_custkey",
        F.concat(F.lit("ü"), "c_custkey", F.lit(" "), "c_name", F.when(F.col("c_custkey") % 3 == 2, "\r").otherwise("")).alias("value"),
    )
    sorted_lines = lines.repartition("c_mktsegment").sortWithinPartitions("c_mktsegment", "c_custkey")
    sorted_lines.drop("c_custkey").write.partitionBy("c_mktsegment").text(path)
    found = files.read_offsets(spark, f"{path}/*", with_path=True)
    segment = F.regexp_extract("path", "c_mktsegment=([^/]*)", 1)
    return found.select(segment.alias("segment"), "offset", "line")


@query("delimited_text", "SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer")
def _(spark, folder):
    path = place(spark, "delimited")
    customers = table(spark, folder, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    files.write_delimited(customers, path, delimiter="|")
    return files.read_delimited(
        spark, path, customers.columns, delimiter="|", types=["long", "string", "int", "double"]
    )


@query(
    "delimited_text_header_quotes",
    """
SELECT p_partkey, p_name || ', "' || p_brand || '"' AS label,
       CASE WHEN p_size % 2 = 0 THEN p_type END AS maybe FROM part""",
)
def _(spark, folder):
    path = place(spark, "delimited-header")
    parts = table(spark, folder, "part").select(
        "p_partkey",
        F.concat("p_name", F.lit(', "'), "p_brand", F.lit('"')).alias("label"),
        F.when(F.col("p_size") % 2 == 0, F.col("p_type")).alias("maybe"),
    )
    files.write_delimited(parts, path, delimiter=",", quote='"', header=True)
    return files.read_delimited(spark, path, delimiter=",", quote='"', types=["long", "string", "string"])


def _ragged(spark, folder) -> str:
    """Lines with two or three fields, some of them not numbers."""
    path = place(spark, "ragged")
    key = F.col("o_orderkey")
    lines = table(spark, folder, "orders").select(
        F.when(key % 5 == 0, F.concat_ws(",", key, F.lit("x")))
        .when(key % 5 == 1, F.concat_ws(",", key, F.lit("y"), F.lit("bad")))
        .when(key % 5 == 2, F.concat_ws(",", key, F.lit("z"), "o_custkey", F.lit("more")))
        .otherwise(F.concat_ws(",", key, F.lit("w"), "o_custkey"))
        .alias("value")
    )
    lines.write.text(path)
    return path


@query(
    "delimited_strict_trap",
    """
SELECT o_orderkey || ',' || CASE o_orderkey % 5 WHEN 0 THEN 'x' WHEN 1 THEN 'y,bad'
       ELSE 'z,' || o_custkey || ',more' END AS line
FROM orders WHERE o_orderkey % 5 IN (0, 1, 2)""",
)
def _(spark, folder):
    _good, rejected = files.read_delimited(
        spark, _ragged(spark, folder), ["k", "s", "n"], ",", types=["long", "string", "long"], safe=False, trap=True
    )
    return rejected


@query(
    "delimited_lenient",
    """
SELECT o_orderkey AS k, CASE o_orderkey % 5 WHEN 0 THEN 'x' WHEN 1 THEN 'y' WHEN 2 THEN 'z' ELSE 'w' END AS s,
       CASE WHEN o_orderkey % 5 = 0 THEN 0 WHEN o_orderkey % 5 IN (1, 2) THEN NULL ELSE o_custkey END AS n
FROM orders""",
)
def _(spark, folder):
    return files.read_delimited(
        spark, _ragged(spark, folder), ["k", "s", "n"], ",", types=["long", "string", "long"], strict=False
    )


# The types of the columns come back too: a day can be subtracted, a price multiplied.
@query(
    "typed_table",
    """
SELECT l_orderkey, l_linenumber, CAST(datediff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) AS INTEGER) AS days,
       l_extendedprice * 2 AS twice FROM lineitem""",
)
def _(spark, folder):
    path = place(spark, "typed")
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice")
    files.write_table(lines, path, codec="gzip")
    stored = files.read_table(spark, path)
    if stored.schema != lines.schema:
        raise RuntimeError(f"types changed: {stored.schema} was {lines.schema}")
    days = F.datediff(F.col("l_shipdate"), F.lit("1992-01-01").cast("date"))
    return stored.select("l_orderkey", "l_linenumber", days.alias("days"), (F.col("l_extendedprice") * 2).alias("twice"))


@query("key_values", "SELECT o_orderkey AS key, o_custkey AS value FROM orders")
def _(spark, folder):
    path = place(spark, "pairs")
    files.write_key_values(table(spark, folder, "orders"), path, "o_orderkey", "o_custkey")
    return files.read_table(spark, path)


@query("key_value_bytes", "SELECT hex(url) AS key, hex(html) AS value FROM pages")
def _(spark, folder):
    path = place(spark, "bytes")
    files.write_key_value_bytes(table(spark, folder, "pages"), path, "url", "html")
    stored = files.read_key_value_bytes(spark, path)
    return stored.select(F.hex("key").alias("key"), F.hex("value").alias("value"))


@query("glob_source", "SELECT c_custkey AS k FROM customer UNION ALL SELECT s_suppkey FROM supplier")
def _(spark, folder):
    root = place(spark, "glob")
    for name, source, key in (
        ("a1", "customer", "c_custkey"),
        ("a2", "supplier", "s_suppkey"),
        ("b1", "supplier", "s_suppkey"),
    ):
        files.write_table(table(spark, folder, source).select(F.col(key).alias("k")), f"{root}/{name}")
    return files.read_table(spark, f"{root}/a*", pattern="*.parquet")


@query(
    "multi_source",
    "SELECT c_name AS name FROM customer UNION ALL SELECT s_name FROM supplier UNION ALL SELECT n_name FROM nation",
)
def _(spark, folder):
    return files.multi_source(
        table(spark, folder, "customer").select(F.col("c_name").alias("name")),
        table(spark, folder, "supplier").select(F.col("s_name").alias("name")),
        table(spark, folder, "nation").select(F.col("n_name").alias("name")),
    )


@query(
    "multi_sink",
    """
SELECT 'table' AS sink, count(*) AS n, CAST(sum(o_custkey) AS BIGINT) AS total FROM orders
UNION ALL SELECT 'text', count(*), CAST(sum(o_custkey) AS BIGINT) FROM orders""",
)
def _(spark, folder):
    scratch = Scratch(spark, "multi-sink")
    first, second = scratch.path("first"), scratch.path("second")
    files.multi_sink(
        table(spark, folder, "orders").select("o_custkey"),
        scratch,
        lambda rows: files.write_table(rows, first),
        lambda rows: files.write_delimited(rows, second),
    )
    stored = {
        "table": files.read_table(spark, first),
        "text": files.read_delimited(spark, second, ["o_custkey"], types=["long"]),
    }
    parts = [
        rows.agg(F.count(F.lit(1)).alias("n"), F.sum("o_custkey").alias("total")).select(
            F.lit(sink).alias("sink"), "n", "total"
        )
        for sink, rows in stored.items()
    ]
    return parts[0].unionByName(parts[1])


@query(
    "template_sink",
    "SELECT c_mktsegment, c_nationkey, count(*) AS n FROM customer GROUP BY c_mktsegment, c_nationkey",
)
def _(spark, folder):
    path = place(spark, "template")
    files.template_sink(
        table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_mktsegment"),
        path,
        ["c_mktsegment", "c_nationkey"],
    )
    return (
        files.read_table(spark, path)
        .groupBy("c_mktsegment", "c_nationkey")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query("sink_modes", "SELECT c_custkey AS k FROM customer UNION ALL SELECT s_suppkey FROM supplier")
def _(spark, folder):
    path = place(spark, "modes")
    customers = table(spark, folder, "customer").select(F.col("c_custkey").alias("k"))
    suppliers = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("k"))
    files.write_table(suppliers, path, "KEEP")
    files.write_table(customers, path, "REPLACE")
    files.write_table(suppliers, path, "UPDATE")
    return files.read_table(spark, path)


# What the sink was given is counted on its way in.
@query("null_sink", "SELECT count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS keys FROM lineitem")
def _(spark, folder):
    counters = observing.Counters()
    files.discard_rows(counters.count(table(spark, folder, "lineitem").select("l_orderkey"), "sink", n=1, keys=F.col("l_orderkey")))
    sums = counters.values()["sink"]
    return spark.createDataFrame([(sums["n"], sums["keys"])], "n bigint, keys bigint")


@query(
    "document_store",
    "SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name, '' AS note FROM part",
)
def _(spark, folder):
    path = place(spark, "documents")
    files.write_document_store(
        table(spark, folder, "part"), "json", {"id": "p_partkey", "name": "p_name"}, path=path
    )
    return files.read_document_store(spark, "json", ["id", "name", "note"], path=path)


# -- facts and datasets


@query("master_facts", FACT_COUNTS)
def _(spark, folder):
    master = facts.open_master(spark, place(spark, "master"))
    master.append(wide_facts(spark, folder))
    return master.read().groupBy("unit", "value_kind").agg(F.count(F.lit(1)).alias("facts"))


@query(
    "master_facts_by_kind",
    f"WITH {LINKS} SELECT 3 AS unit, count(*) AS n FROM links UNION ALL SELECT 2, count(*) FROM pages",
)
def _(spark, folder):
    master = facts.open_master(spark, place(spark, "kinds"))
    master.append(wide_facts(spark, folder))
    chosen = facts.read_kinds(master, schema.EQUIV, schema.PAGE_PROPERTY)
    return chosen.groupBy("unit").agg(F.count(F.lit(1)).alias("n"))


@query("append_facts", f"WITH {PV} SELECT user_id, url, nonce, ts FROM pv")
def _(spark, folder):
    new_data = facts.open_new_data(spark, place(spark, "append"))
    rows = raw_views(spark, folder).select(schema.user_person("user_id").alias("person"), "url", "nonce", "ts")
    facts.append_facts(new_data, rows, schema.PAGE_VIEW)
    return facts.read_arm(new_data, schema.PAGE_VIEW).select(
        F.col("person.user_id").alias("user_id"), "url", "nonce", "ts"
    )


@query(
    "ingest_facts",
    f"""
SELECT unit, value_kind, facts, CAST(0 AS BIGINT) AS left_over FROM ({FACT_COUNTS})""",
)
def _(spark, folder):
    scratch = Scratch(spark, "ingest")
    new_data = facts.open_new_data(spark, scratch.path("new"))
    master = facts.open_master(spark, scratch.path("master"))
    arriving = wide_facts(spark, folder)
    new_data.append(arriving.where("unit IN (1, 2)"))
    facts.ingest(master, new_data)
    new_data.append(arriving.where("unit IN (3, 4)"))
    facts.ingest(master, new_data)
    facts.ingest(master, new_data)
    stored = master.read().groupBy("unit", "value_kind").agg(F.count(F.lit(1)).alias("facts"))
    return stored.withColumn("left_over", F.lit(new_data.read().count()))


def _orders_dataset(spark, folder, name: str) -> Dataset:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    made = Dataset.create(spark, place(spark, name), orders.schema, ("o_orderstatus",))
    made.append(orders)
    return made


@query("dataset_part", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F'")
def _(spark, folder):
    stored = _orders_dataset(spark, folder, "part").read("o_orderstatus = 'F'")
    return stored.select("o_orderkey", "o_custkey")


@query(
    "dataset_paths",
    "SELECT o_orderkey, 'o_orderstatus=' || o_orderstatus AS folder FROM orders",
)
def _(spark, folder):
    stored = _orders_dataset(spark, folder, "paths").read(with_path=True)
    return stored.select("o_orderkey", F.regexp_extract("path", r"/([^/]+)/[^/]+$", 1).alias("folder"))


@query("dataset_snapshot", "SELECT o_orderkey + 100000000 AS o_orderkey FROM orders")
def _(spark, folder):
    stored = _orders_dataset(spark, folder, "snapshot")
    snapshot = stored.snapshot()
    stored.append(snapshot.read().withColumn("o_orderkey", F.col("o_orderkey") + 100000000))
    stored.delete_snapshot(snapshot)
    return stored.read().select("o_orderkey")


@query(
    "dataset_absorb",
    """
SELECT o_orderstatus, 3 * count(*) AS n FROM orders GROUP BY o_orderstatus""",
)
def _(spark, folder):
    stored = _orders_dataset(spark, folder, "absorb")
    stored.copy_append(_orders_dataset(spark, folder, "absorb-copy"))
    stored.absorb(_orders_dataset(spark, folder, "absorb-move"))
    return stored.read().groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


# Three appends leave three files in each folder; afterwards there is one, with all rows.
@query(
    "dataset_consolidate",
    """
SELECT o_orderkey, o_custkey, o_orderstatus, true AS merged, CAST(3 AS BIGINT) AS before, CAST(1 AS BIGINT) AS after FROM orders""",
)
def _(spark, folder):
    made = _orders_dataset(spark, folder, "merge")
    snapshot = made.snapshot()
    made.append(snapshot.read())
    made.delete_snapshot(snapshot)
    made.append(made.read().where("false"))
    stored = made.empty_copy(place(spark, "merge-parts"))
    for third in range(3):
        stored.append(made.read().where(F.coalesce(F.abs(F.col("o_orderkey") % 3), F.lit(0)) == third))

    def counted(name: str):
        files = stored.read(with_path=True).groupBy(F.col("o_orderstatus").alias(f"{name}_status"))
        counts = files.agg(F.countDistinct("path").alias(name))
        return spark.createDataFrame([tuple(r) for r in counts.collect()], counts.schema)  # one row a status

    before, files = counted("before"), stored.file_frame().count()
    stored.consolidate()
    after, merged = counted("after"), stored.file_frame().count() < files
    rows = stored.read().withColumn("merged", F.lit(merged))
    for counts in (before, after):
        status = F.col(counts.columns[0])
        rows = rows.join(F.broadcast(counts), F.col("o_orderstatus").eqNullSafe(status)).drop(status)
    return rows


@query("dataset_recompress", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def _(spark, folder):
    return _orders_dataset(spark, folder, "codec").coerce(place(spark, "codec-gz"), "gzip").read()


# Rows, the named text, and whether the files are the same bytes.
@query("dataset_copy", "SELECT o_orderkey, o_custkey, o_orderstatus, 'kept' AS note, true AS same FROM orders")
def _(spark, folder):
    stored = _orders_dataset(spark, folder, "copy")
    stored.set_metadata("note", "kept")
    copy = stored.copy_to(place(spark, "copy-to"))

    def checksums(dataset: Dataset) -> list:
        bytes_of = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(dataset.path)
        below = F.regexp_extract("path", "/(change=.*)", 1)
        return sorted(map(tuple, bytes_of.select(below, F.md5("content")).where(F.endswith("path", F.lit(".parquet"))).collect()))

    same = checksums(stored) == checksums(copy)
    return copy.read().withColumns({"note": F.lit(copy.metadata("note")), "same": F.lit(same)})


@query("dataset_clear", "SELECT CAST(0 AS BIGINT) AS n")
def _(spark, folder):
    stored = _orders_dataset(spark, folder, "clear")
    stored.clear()
    return stored.read().agg(F.count(F.lit(1)).alias("n"))


# -- versions and slices


@query(
    "versioned_store",
    """
SELECT 'newest' AS which, o_orderkey FROM orders WHERE o_orderkey % 4 = 3
UNION ALL SELECT 'at most 2', o_orderkey FROM orders WHERE o_orderkey % 4 = 2""",
)
def _(spark, folder):
    store = History(spark, place(spark, "versions"))
    orders = table(spark, folder, "orders").select("o_orderkey")
    for version in range(4):
        store.add(orders.where(F.col("o_orderkey") % 4 == version), version, keep=3)
    newest = store.read().select(F.lit("newest").alias("which"), "o_orderkey")
    older = store.read(store.latest(up_to=2)).select(F.lit("at most 2").alias("which"), "o_orderkey")
    return newest.unionByName(older)


@query(
    "time_slices",
    """
WITH s AS (SELECT event_id, CAST(epoch_us(ts) // 1000000 AS INTEGER) AS secs FROM events),
w AS (SELECT event_id, secs - secs % 604800 AS week_start FROM s)
SELECT event_id, week_start, week_start AS slice_start FROM w
WHERE week_start < (SELECT max(week_start) FROM w)""",
)
def _(spark, folder):
    events = table(spark, folder, "events").select(
        "event_id", F.unix_seconds(F.col("ts").cast("timestamp")).cast("int").alias("secs")
    )
    store = Timeline.create(spark, place(spark, "slices"), events.schema)
    store.add(events, week_of(F.col("secs")))
    weeks = store.slices()
    last = weeks.agg(F.max("slice_start")).first()[0]
    store.close(weeks.where(F.col("slice_start") < last))
    place_of = [F.col(c).cast("int").alias(c) for c in ("week_start", "slice_start")]
    return store.read_closed().select("event_id", *place_of)


# -- served views


def _served(spark, folder):
    scratch = Scratch(spark, "served")
    places = batch.Places.below(scratch.path("site"))
    facts.open_new_data(spark, places.new_data).append(wide_facts(spark, folder))
    return places, batch.run(spark, places)


@query(
    "batch_page_views",
    PAGE_VIEW_SQL + f"SELECT {KEY} AS key, views AS value, url, granularity, bucket FROM counted",
)
def _(spark, folder):
    return _served(spark, folder)[1].read(PAGE_VIEW_VIEW)


@query(
    "batch_uniques",
    PAGE_VIEW_SQL + f"SELECT {KEY} AS key, visitors AS value, url, granularity, bucket FROM counted",
)
def _(spark, folder):
    return _served(spark, folder)[1].read(UNIQUE_VIEW)


# A second batch over the same facts, come in again, replaces the views and
# changes nothing in them.
@query(
    "batch_bounces_replaced",
    VISITS
    + """SELECT domain AS key, domain, visits, bounces,
       CAST(bounces AS DOUBLE) / CAST(visits AS DOUBLE) AS rate FROM per_domain""",
)
def _(spark, folder):
    places, first = _served(spark, folder)
    before = first.live_version(BOUNCE_VIEW)
    facts.open_new_data(spark, places.new_data).append(wide_facts(spark, folder).where("unit = 4"))
    second = batch.run(spark, places)
    if second.live_version(BOUNCE_VIEW) == before:
        raise RuntimeError("the view was not replaced")
    return second.read(BOUNCE_VIEW)


@query(
    "speed_views",
    """
SELECT v AS view, n AS number, CASE WHEN n = 1 THEN 0 ELSE (SELECT count(*) FROM pages) END AS kept
FROM (VALUES ('page-view'), ('unique-view'), ('bounce-view')) AS a(v), (VALUES (0), (1)) AS b(n)""",
)
def _(spark, folder):
    speed = SpeedViews(spark, place(spark, "speed"))
    pages = table(spark, folder, "pages").select("url")
    for view in VIEWS:
        for number in (0, 1):
            files.write_table(pages, speed.path(view, number))
    if speed.update() != 0:
        raise RuntimeError("the other set should be current")
    parts = [
        files.read_table(spark, speed.path(view, number)).agg(F.count(F.lit(1)).alias("kept")).select(
            F.lit(view).alias("view"), F.lit(number).alias("number"), "kept"
        )
        for view in VIEWS
        for number in (0, 1)
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


