"""Queries of the row, text, date, grouping, join and quality operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registry.base import query, table
from tidemark.functions import coerce, dates, text
from tidemark.operators import fields, grouping, joins, observing, quality, rows
from tidemark.sources.scratch import Scratch
from tidemark.sources import files

# -- row functions


@query(
    "each_all",
    "SELECT s_suppkey, s_name, s_nationkey, s_acctbal, upper(s_name) AS loud FROM supplier",
)
def _(spark, folder):
    return rows.each(table(spark, folder, "supplier"), {"loud": F.upper("s_name")})


@query("each_results", "SELECT o_orderkey * 2 AS double_key FROM orders")
def _(spark, folder):
    return rows.each(
        table(spark, folder, "orders"), {"double_key": F.col("o_orderkey") * 2}, output="RESULTS"
    )


@query(
    "each_replace",
    "SELECT c_custkey, lower(c_name) AS c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
)
def _(spark, folder):
    return rows.each(table(spark, folder, "customer"), {"c_name": F.lower("c_name")}, output="REPLACE")


@query(
    "each_swap",
    "SELECT c_custkey, c_nationkey, c_acctbal, c_name || '/' || c_mktsegment AS label FROM customer",
)
def _(spark, folder):
    return rows.each(
        table(spark, folder, "customer"),
        {"label": text.field_join("c_name", "c_mktsegment", delimiter="/")},
        output="SWAP",
        arguments=["c_name", "c_mktsegment"],
    )


@query("each_selected", "SELECT length(p_name) AS width, p_partkey FROM part")
def _(spark, folder):
    return rows.each(
        table(spark, folder, "part"), {"width": F.length("p_name")}, output=["width", "p_partkey"]
    )


@query("retain", "SELECT l_orderkey, l_linenumber FROM lineitem")
def _(spark, folder):
    return rows.retain(table(spark, folder, "lineitem"), "l_orderkey", "l_linenumber")


@query("discard", "SELECT p_partkey, p_brand, p_size FROM part")
def _(spark, folder):
    return rows.discard(table(spark, folder, "part"), "p_name", "p_type", "p_retailprice")


@query("rename", "SELECT s_suppkey AS id, s_name AS name, s_nationkey, s_acctbal FROM supplier")
def _(spark, folder):
    return rows.rename(table(spark, folder, "supplier"), {"s_suppkey": "id", "s_name": "name"})


@query(
    "coerce",
    """
SELECT o_orderkey,
       coalesce(CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_custkey AS INTEGER) END, 0) AS custkey,
       CAST(trunc(o_totalprice) AS BIGINT) AS price,
       o_orderstatus = 'TRUE' AS flag,
       CAST(o_orderkey AS VARCHAR) AS key_text,
       CAST(o_custkey AS DOUBLE) AS cust_real
FROM orders""",
)
def _(spark, folder):
    prepared = table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 3 != 0, F.col("o_custkey").cast("string")).alias("custkey"),
        F.col("o_totalprice").alias("price"),
        F.col("o_orderstatus").alias("flag"),
        F.col("o_orderkey").alias("key_text"),
        F.col("o_custkey").cast("string").alias("cust_real"),
    )
    return coerce.coerce(
        prepared,
        {"custkey": "int", "price": "long", "flag": "boolean", "key_text": "string", "cust_real": "double"},
    )


@query(
    "coerce_safe",
    """
SELECT page_id, TRY_CAST(nullif(regexp_extract(url, '/([0-9a-z.]+)[^/]*$', 1), '') AS INTEGER) AS number
FROM pages""",
)
def _(spark, folder):
    found = table(spark, folder, "pages").select(
        "page_id", F.regexp_extract("url", r"/([0-9a-z.]+)[^/]*$", 1).alias("number")
    )
    return coerce.coerce(found, {"number": "int"}, safe=True)


@query("identity", "SELECT p_partkey AS id, CAST(p_size AS VARCHAR) AS size_text FROM part")
def _(spark, folder):
    return rows.identity(
        table(spark, folder, "part"), {"p_partkey": "id", "p_size": "size_text"}, {"size_text": "string"}
    )


@query("insert", "SELECT o_orderkey, 7 AS seven, 'x' AS letter FROM orders")
def _(spark, folder):
    return rows.insert(rows.retain(table(spark, folder, "orders"), "o_orderkey"), {"seven": 7, "letter": "x"})


@query(
    "set_value",
    """
SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'debt' ELSE 'fine' END AS state FROM customer""",
)
def _(spark, folder):
    return table(spark, folder, "customer").select(
        "c_custkey", rows.set_value(F.col("c_acctbal") < 0, "fine", "debt").alias("state")
    )


@query(
    "un_group",
    """
SELECT l_orderkey, l_linenumber, l_quantity AS amount FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, l_discount FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, l_tax FROM lineitem""",
)
def _(spark, folder):
    return rows.un_group(
        table(spark, folder, "lineitem"),
        ["l_orderkey", "l_linenumber"],
        [["l_quantity"], ["l_discount"], ["l_tax"]],
        ["l_orderkey", "l_linenumber", "amount"],
    )


@query(
    "un_group_every",
    """
SELECT l_orderkey, l_linenumber, l_partkey AS a, l_suppkey AS b FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey FROM lineitem""",
)
def _(spark, folder):
    wide = table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.col("l_suppkey").alias("s2"),
        F.col("l_partkey").alias("p2"),
    )
    return rows.un_group_every(
        wide, ["l_orderkey", "l_linenumber"], 2, ["l_orderkey", "l_linenumber", "a", "b"]
    )


# A function over batches: no row for a null or a key without small divisors, else up to four.
@query(
    "row_function",
    """
SELECT o_orderkey, o_orderstatus, divisor, CAST(k // divisor AS BIGINT) AS quotient
FROM (SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 11 <> 0 THEN o_orderkey END AS k FROM orders),
     (VALUES (2), (3), (5), (7)) AS t(divisor)
WHERE k % divisor = 0""",
)
def _(spark, folder):
    def divisors(batch: pa.RecordBatch):
        known = batch.column("k").is_valid().to_numpy(zero_copy_only=False)
        keys = batch.column("k").fill_null(1).to_numpy()
        for divisor in (2, 3, 5, 7):
            places = np.flatnonzero(known & (keys % divisor == 0))
            yield places, pa.record_batch(
                {"divisor": np.full(len(places), divisor, dtype=np.int32), "quotient": keys[places] // divisor}
            )

    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_orderstatus", F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderkey")).alias("k")
    )
    found = rows.each_row(orders, divisors, "divisor int, quotient bigint", arguments=["k"])
    return found.select("o_orderkey", "o_orderstatus", "divisor", "quotient")


# A function over single rows, whose results take the place of its argument.
@query(
    "row_function_swap",
    """
SELECT p_partkey, p_size, part, CAST(length(part) AS INTEGER) AS width
FROM (SELECT p_partkey, p_size, unnest(string_split(p_name, ' ')) AS part FROM part) WHERE length(part) > 4""",
)
def _(spark, folder):
    def long_words(text: str | None):
        return [(word, len(word)) for word in (text or "").split(" ") if len(word) > 4]

    results = "part string, width int"
    parts = table(spark, folder, "part").select("p_partkey", "p_name", "p_size")
    return rows.each_row(parts, rows.row_function(long_words, results), results, "SWAP", ["p_name"])


@query("expression_function", "SELECT l_orderkey, l_linenumber, l_partkey + l_suppkey AS total FROM lineitem")
def _(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", rows.expression("l_partkey + l_suppkey").alias("total")
    )


@query("expression_filter", "SELECT o_orderkey FROM orders WHERE NOT (o_totalprice > 100000)")
def _(spark, folder):
    return rows.expression_filter(table(spark, folder, "orders"), "o_totalprice > 100000").select("o_orderkey")


def _with_gaps(spark, folder):
    """Orders with some fields emptied."""
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 3 != 0, F.col("o_custkey")).alias("cust"),
        F.when(F.col("o_orderkey") % 2 != 0, F.col("o_orderstatus")).alias("status"),
    )


GAPS = """
gaps AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_custkey END AS cust,
         CASE WHEN o_orderkey % 2 <> 0 THEN o_orderstatus END AS status
  FROM orders
)"""


@query("filter_null", f"WITH {GAPS} SELECT * FROM gaps WHERE cust IS NOT NULL AND status IS NOT NULL")
def _(spark, folder):
    return rows.filter_null(_with_gaps(spark, folder))


@query(
    "filter_not_null",
    f"WITH {GAPS} SELECT o_orderkey FROM gaps WHERE cust IS NULL AND status IS NULL",
)
def _(spark, folder):
    return rows.filter_not_null(_with_gaps(spark, folder), "cust", "status").select("o_orderkey")


# Each condition says what to remove.
@query("filter_and", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE NOT (l_quantity > 25 AND l_tax > 0.04)")
def _(spark, folder):
    condition = rows.all_of(F.col("l_quantity") > 25, F.col("l_tax") > 0.04)
    return rows.remove(table(spark, folder, "lineitem"), condition).select("l_orderkey", "l_linenumber")


@query("filter_or", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE NOT (l_quantity > 25 OR l_tax > 0.04)")
def _(spark, folder):
    condition = rows.any_of(F.col("l_quantity") > 25, F.col("l_tax") > 0.04)
    return rows.remove(table(spark, folder, "lineitem"), condition).select("l_orderkey", "l_linenumber")


@query("filter_not", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity > 25")
def _(spark, folder):
    condition = rows.negate(F.col("l_quantity") > 25)
    return rows.remove(table(spark, folder, "lineitem"), condition).select("l_orderkey", "l_linenumber")


@query(
    "filter_xor",
    "SELECT l_orderkey, l_linenumber FROM lineitem WHERE (l_quantity > 25) = (l_tax > 0.04)",
)
def _(spark, folder):
    condition = rows.one_of(F.col("l_quantity") > 25, F.col("l_tax") > 0.04)
    return rows.remove(table(spark, folder, "lineitem"), condition).select("l_orderkey", "l_linenumber")


@query("limit_rows", "SELECT count(*) AS n FROM (SELECT * FROM orders LIMIT 1000)")
def _(spark, folder):
    return rows.limit(table(spark, folder, "orders"), 1000).agg(F.count(F.lit(1)).alias("n"))


# A one-in-ten sample has about a tenth of the rows, none twice, none invented.
@query("sample_share", "SELECT true AS close, CAST(0 AS BIGINT) AS strangers")
def _(spark, folder):
    orders = table(spark, folder, "orders")
    drawn = rows.sample(orders.select("o_orderkey"), 0.1, seed=7).select(F.col("o_orderkey").alias("drawn"))
    both = orders.join(drawn, F.col("o_orderkey") == F.col("drawn"), "full")
    return both.agg(
        (F.abs(F.count("drawn") / F.count("o_orderkey") - 0.1) < 0.02).alias("close"),
        F.sum(F.when(F.col("o_orderkey").isNull(), 1).otherwise(0)).alias("strangers"),
    )


# Each row with its one, and how many rows the debug step has seen.
@query("debug_rows", "SELECT event_id, 1 AS debug, count(*) OVER () AS seen FROM events")
def _(spark, folder):
    watched, seen = observing.debug(table(spark, folder, "events").select("event_id"))
    written = Scratch(spark, "debug").save(watched, "rows")
    return written.withColumn("seen", F.lit(observing.observed(seen).get("rows", 0)).cast("bigint"))


# The counter stands before the filter, so it sees all rows.
@query(
    "counter_rows",
    """
SELECT count(*) FILTER (value > 10) AS kept, count(*) AS seen, count(*) FILTER (event_type = 'click') AS clicks FROM events""",
)
def _(spark, folder):
    watched, seen = observing.counter(
        table(spark, folder, "events"), "events", clicks=F.col("event_type") == "click"
    )
    kept = watched.where("value > 10").count()
    found = observing.observed(seen)
    return spark.createDataFrame([(kept, found["rows"], found["clicks"])], "kept bigint, seen bigint, clicks bigint")


@query("job_status", "SELECT 'counting orders' AS status, true AS ended, count(*) AS n FROM orders")
def _(spark, folder):
    with observing.status(spark, "counting orders"):
        n = table(spark, folder, "orders").groupBy("o_custkey").count().agg(F.sum("count")).first()[0]
    states = observing.job_states(spark, "counting orders")
    return spark.createDataFrame([("counting orders", set(states.values()) == {"SUCCEEDED"}, n)], "status string, ended boolean, n bigint")


@query(
    "counter_values",
    """
SELECT 'orders' AS counted, 'rows' AS counter, count(*) AS n FROM orders
UNION ALL SELECT 'orders', 'pairs', 2 * count(*) FROM orders
UNION ALL SELECT 'orders', 'dear', count(*) FILTER (o_totalprice > 1000) FROM orders
UNION ALL SELECT 'orders', 'keys', CAST(sum(o_custkey) AS BIGINT) FROM orders WHERE o_custkey % 7 <> 0
UNION ALL SELECT 'parties', 'rows', (SELECT count(*) FROM customer) + (SELECT count(*) FROM supplier)
UNION ALL SELECT 'nobody', 'rows', 0""",
)
def _(spark, folder):
    counters = observing.Counters()
    orders = counters.count(
        table(spark, folder, "orders").select("o_custkey", "o_totalprice"),
        "orders",
        rows=1,
        pairs=2,
        dear=F.col("o_totalprice") > 1000,
        keys=F.when(F.col("o_custkey") % 7 != 0, F.col("o_custkey")),
    )
    customers = counters.count(table(spark, folder, "customer").select("c_custkey"), "parties")
    suppliers = counters.count(table(spark, folder, "supplier").select("s_suppkey"), "parties")
    nobody = counters.count(table(spark, folder, "orders").where("o_custkey < 0"), "nobody")
    for counted in (orders, customers, suppliers, nobody):
        files.discard_rows(counted)
    sums = [(group, name, n) for group, own in counters.values().items() for name, n in own.items()]
    return spark.createDataFrame(sums, "counted string, counter string, n bigint")


# -- text


@query("regex_filter", "SELECT c_custkey FROM customer WHERE regexp_matches(c_name || chr(9) || c_mktsegment, '7\tB')")
def _(spark, folder):
    found = text.regex_filter(table(spark, folder, "customer"), "7\tB", "c_name", "c_mktsegment")
    return found.select("c_custkey")


@query(
    "regex_filter_each",
    """
SELECT c_custkey FROM customer
WHERE NOT regexp_matches(c_name, '[37]$') AND NOT regexp_matches(c_mktsegment, '[37]$')""",
)
def _(spark, folder):
    found = text.regex_filter(
        table(spark, folder, "customer"), "[37]$", "c_name", "c_mktsegment", remove_match=True, each=True
    )
    return found.select("c_custkey")


@query(
    "regex_parser",
    """
SELECT page_id, regexp_extract(url, '^([a-z]+)://([^/]+)', 1) AS protocol,
       regexp_extract(url, '^([a-z]+)://([^/]+)', 2) AS host
FROM pages""",
)
def _(spark, folder):
    parsed = text.regex_parse(
        table(spark, folder, "pages"), "url", r"^([a-z]+)://([^/]+)", ["protocol", "host"]
    )
    return parsed.select("page_id", "protocol", "host")


@query("regex_replace_all", "SELECT page_id, regexp_replace(url, '([aeiou])', '<\\1>', 'g') AS marked FROM pages")
def _(spark, folder):
    return table(spark, folder, "pages").select(
        "page_id", text.regex_replace("url", "([aeiou])", "<$1>").alias("marked")
    )


@query("regex_replace_first", "SELECT doc_id, regexp_replace(text, '([aeiou])', '<\\1>') AS marked FROM documents")
def _(spark, folder):
    return table(spark, folder, "documents").select(
        "doc_id", text.regex_replace("text", "([aeiou])", "<$1>", every=False).alias("marked")
    )


@query(
    "regex_splitter",
    """
SELECT page_id, string_split(url, '/')[1] AS a, string_split(url, '/')[2] AS b,
       array_to_string(string_split(url, '/')[3:], '/') AS c
FROM pages""",
)
def _(spark, folder):
    parts = text.regex_split_columns(table(spark, folder, "pages"), "url", "/", ["a", "b", "c"])
    return parts.select("page_id", "a", "b", "c")


@query(
    "regex_split_generator",
    """
SELECT doc_id, part, count(*) AS n FROM (
  SELECT doc_id, unnest(string_split(regexp_replace(text, ' +$', ''), ' ')) AS part FROM documents
) GROUP BY doc_id, part""",
)
def _(spark, folder):
    parts = text.regex_split_rows(table(spark, folder, "documents"), "text", " ", "part")
    return parts.groupBy("doc_id", "part").agg(F.count(F.lit(1)).alias("n"))


@query(
    "regex_generator",
    """
SELECT doc_id, word, count(*) AS n FROM (
  SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z]+')) AS word FROM documents
) GROUP BY doc_id, word""",
)
def _(spark, folder):
    words = text.regex_generate(table(spark, folder, "documents"), "text", "[A-Za-z]+", "word")
    return words.groupBy("doc_id", "word").agg(F.count(F.lit(1)).alias("n"))


@query(
    "field_joiner",
    f"""
WITH {GAPS}
SELECT o_orderkey, coalesce(CAST(cust AS VARCHAR), '') || chr(9) || coalesce(status, '') AS joined FROM gaps""",
)
def _(spark, folder):
    return _with_gaps(spark, folder).select("o_orderkey", text.field_join("cust", "status").alias("joined"))


@query(
    "field_formatter",
    "SELECT c_custkey, printf('%08d is %s', c_custkey, c_mktsegment) AS formatted FROM customer",
)
def _(spark, folder):
    return table(spark, folder, "customer").select(
        "c_custkey", text.field_format("%08d is %s", "c_custkey", "c_mktsegment").alias("formatted")
    )


# -- dates

ORDER_TEXT = "strftime(o_orderdate, '%d/%m/%Y %H:%M:%S')"


def _order_texts(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "dd/MM/yyyy HH:mm:ss").alias("day_text")
    )


@query("date_parser", "SELECT o_orderkey, epoch_ms(o_orderdate) AS ts FROM orders")
def _(spark, folder):
    return _order_texts(spark, folder).select(
        "o_orderkey", dates.date_parse("day_text", "dd/MM/yyyy HH:mm:ss").alias("ts")
    )


@query(
    "date_parser_zone",
    "SELECT o_orderkey, epoch_ms(o_orderdate) - 9 * 3600000 AS ts FROM orders",
)
def _(spark, folder):
    return _order_texts(spark, folder).select(
        "o_orderkey", dates.date_parse("day_text", "dd/MM/yyyy HH:mm:ss", "Asia/Tokyo").alias("ts")
    )


@query(
    "date_parser_fields",
    """
SELECT event_id, CAST(year(ts) AS INTEGER) AS y, CAST(month(ts) - 1 AS INTEGER) AS m,
       CAST(day(ts) AS INTEGER) AS d, CAST(dayofweek(ts) + 1 AS INTEGER) AS dow,
       CAST(dayofyear(ts) AS INTEGER) AS doy, CAST(hour(ts) AS INTEGER) AS h,
       CAST(minute(ts) AS INTEGER) AS mi, CAST(second(ts) AS INTEGER) AS s
FROM events""",
)
def _(spark, folder):
    names = {
        "y": "YEAR",
        "m": "MONTH",
        "d": "DAY_OF_MONTH",
        "dow": "DAY_OF_WEEK",
        "doy": "DAY_OF_YEAR",
        "h": "HOUR_OF_DAY",
        "mi": "MINUTE",
        "s": "SECOND",
    }
    texts = table(spark, folder, "events").select(
        "event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("t")
    )
    columns = dates.date_parse_fields("t", "yyyy-MM-dd'T'HH:mm:ss", list(names.values()))
    return texts.select("event_id", *[c.alias(n) for n, c in zip(names, columns)])


@query(
    "date_formatter",
    "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS datetime FROM events",
)
def _(spark, folder):
    return table(spark, folder, "events").select(
        "event_id",
        dates.date_format(F.unix_millis(F.col("ts").cast("timestamp")), "yyyy-MM-dd HH:mm:ss").alias("datetime"),
    )


@query(
    "date_formatter_zone",
    "SELECT event_id, strftime(ts + INTERVAL 9 HOUR, '%d.%m.%Y %H:%M') AS datetime FROM events",
)
def _(spark, folder):
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    return table(spark, folder, "events").select(
        "event_id", dates.date_format(millis, "dd.MM.yyyy HH:mm", "Asia/Tokyo").alias("datetime")
    )


# Names of the months and days, Monday first, in German and French.
GERMAN_MONTHS = "Januar Februar März April Mai Juni Juli August September Oktober November Dezember".split()
FRENCH_MONTHS = "janvier février mars avril mai juin juillet août septembre octobre novembre décembre".split()
FRENCH_DAYS = "lundi mardi mercredi jeudi vendredi samedi dimanche".split()


def _case(number: str, names: list[str]) -> str:
    return f"CASE {number} " + " ".join(f"WHEN {n} THEN '{name}'" for n, name in enumerate(names, 1)) + " END"


def _spelled(number, names: list[str]):
    return F.element_at(F.array(*[F.lit(n) for n in names]), number)


@query(
    "date_formatter_locale",
    f"""
SELECT o_orderkey, day(o_orderdate) || '. ' || {_case("month(o_orderdate)", GERMAN_MONTHS)} || ' ' || year(o_orderdate) AS german,
       {_case("isodow(o_orderdate)", FRENCH_DAYS)} || ' ' || day(o_orderdate) || ' '
       || {_case("month(o_orderdate)", FRENCH_MONTHS)} || ' ' || year(o_orderdate) AS french
FROM orders""",
)
def _(spark, folder):
    millis = F.unix_millis(F.col("o_orderdate").cast("timestamp"))
    return table(spark, folder, "orders").select(
        "o_orderkey",
        dates.date_format(millis, "d. MMMM yyyy", locale="de").alias("german"),
        dates.date_format(millis, "EEEE d MMMM yyyy", locale="fr").alias("french"),
    )


# Tokyo is nine hours ahead all year round. Weeks start on Monday in Germany, and the
# first one of a year has four days of it: the rules of ISO.
@query(
    "date_parser_locale",
    """
SELECT o_orderkey, epoch_ms(o_orderdate) AS german, epoch_ms(o_orderdate) - 9 * 3600000 AS french,
       CAST(weekofyear(o_orderdate) AS INTEGER) AS week, CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS weekday
FROM orders""",
)
def _(spark, folder):
    day, month, year = F.dayofmonth("o_orderdate"), F.month("o_orderdate"), F.year("o_orderdate")
    texts = table(spark, folder, "orders").select(
        "o_orderkey",
        F.concat(day, F.lit(". "), _spelled(month, GERMAN_MONTHS), F.lit(" "), year).alias("de"),
        F.concat_ws(" ", _spelled(F.weekday("o_orderdate") + 1, FRENCH_DAYS), day, _spelled(month, FRENCH_MONTHS), year).alias("fr"),
    )
    week, weekday = dates.date_parse_fields("de", "d. MMMM yyyy", ["WEEK_OF_YEAR", "DAY_OF_WEEK"], locale="de-DE")
    return texts.select(
        "o_orderkey",
        dates.date_parse("de", "d. MMMM yyyy", locale="de").alias("german"),
        dates.date_parse("fr", "EEEE d MMMM yyyy", "Asia/Tokyo", locale="fr").alias("french"),
        week.alias("week"),
        weekday.alias("weekday"),
    )


# -- grouping


@query(
    "aggregate_count_sum_average",
    """
SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS quantity,
       CAST(sum(l_quantity) AS BIGINT) AS whole, avg(l_quantity) AS mean
FROM lineitem GROUP BY ALL""",
)
def _(spark, folder):
    return grouping.aggregate_by(
        table(spark, folder, "lineitem"),
        ["l_returnflag", "l_linestatus"],
        n=grouping.count(),
        quantity=grouping.total("l_quantity"),
        whole=grouping.total("l_quantity", "bigint"),
        mean=grouping.average("l_quantity"),
    )


@query(
    "aggregate_nulls_as_zero",
    """
WITH gaps AS (SELECT o_orderstatus, CASE WHEN o_orderkey % 4 <> 0 THEN o_custkey END AS cust FROM orders)
SELECT o_orderstatus, CAST(coalesce(sum(cust), 0) AS DOUBLE) AS total,
       avg(CAST(coalesce(cust, 0) AS DOUBLE)) AS mean
FROM gaps GROUP BY o_orderstatus""",
)
def _(spark, folder):
    gaps = table(spark, folder, "orders").select(
        "o_orderstatus", F.when(F.col("o_orderkey") % 4 != 0, F.col("o_custkey")).alias("cust")
    )
    return grouping.aggregate_by(
        gaps, ["o_orderstatus"], total=grouping.total("cust"), mean=grouping.average("cust")
    )


@query(
    "min_max_as_numbers",
    """
SELECT o_orderpriority,
       CAST(min(o_custkey) AS VARCHAR) AS low, CAST(max(o_custkey) AS VARCHAR) AS high,
       min(o_custkey) FILTER (o_custkey NOT IN (0, 1, 2, 3, 4)) AS low_but
FROM orders GROUP BY o_orderpriority""",
)
def _(spark, folder):
    orders = table(spark, folder, "orders").withColumn("cust_text", F.col("o_custkey").cast("string"))
    return grouping.aggregate_by(
        orders,
        ["o_orderpriority"],
        low=grouping.minimum("cust_text"),
        high=grouping.maximum("cust_text"),
        low_but=grouping.minimum("o_custkey", ignore=[0, 1, 2, 3, 4]),
    )


@query(
    "first_of_group",
    """
SELECT o_custkey, o_orderkey, o_orderstatus FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders
) WHERE rn = 1""",
)
def _(spark, folder):
    return grouping.first(
        table(spark, folder, "orders"),
        ["o_custkey"],
        ["o_orderkey", "o_orderstatus"],
        ["o_orderdate", "o_orderkey"],
    )


@query(
    "last_of_group",
    """
SELECT o_custkey, o_orderstatus, o_orderpriority FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders WHERE NOT (o_orderstatus = 'F' AND o_orderpriority = '5-LOW')
) WHERE rn = 1""",
)
def _(spark, folder):
    return grouping.last(
        table(spark, folder, "orders"),
        ["o_custkey"],
        ["o_orderstatus", "o_orderpriority"],
        ["o_orderdate", "o_orderkey"],
        ignore=[("F", "5-LOW")],
    )


@query("sum_by", "SELECT l_suppkey, sum(l_quantity) AS quantity FROM lineitem GROUP BY l_suppkey")
def _(spark, folder):
    return grouping.sum_by(table(spark, folder, "lineitem"), ["l_suppkey"], "l_quantity", "quantity")


@query("count_by", "SELECT event_type, count(*) AS count FROM events GROUP BY event_type")
def _(spark, folder):
    return grouping.count_by(table(spark, folder, "events"), ["event_type"])


@query("average_by", "SELECT p_brand, avg(p_size) AS average FROM part GROUP BY p_brand")
def _(spark, folder):
    return grouping.average_by(table(spark, folder, "part"), ["p_brand"], "p_size")


@query(
    "group_several_streams",
    """
SELECT nation, count(*) AS n FROM (
  SELECT c_nationkey AS nation FROM customer UNION ALL SELECT s_nationkey FROM supplier
) GROUP BY nation""",
)
def _(spark, folder):
    customers = table(spark, folder, "customer").select(F.col("c_nationkey").alias("nation"))
    suppliers = table(spark, folder, "supplier").select(F.col("s_nationkey").alias("nation"))
    return grouping.aggregate_by([customers, suppliers], ["nation"], n=grouping.count())


@query(
    "group_sorted",
    """
SELECT o_custkey, o_orderkey, row_number() OVER (ORDER BY o_custkey, o_orderkey) AS place FROM orders""",
)
def _(spark, folder):
    # Rows come in key order through the partitions. The place of a row is its
    # place in its partition plus the rows of the partitions before.
    ordered = grouping.group_sorted(
        table(spark, folder, "orders").select("o_custkey", "o_orderkey"), ["o_custkey"], ["o_orderkey"]
    )
    marked = ordered.select(
        "o_custkey",
        "o_orderkey",
        F.spark_partition_id().alias("part"),
        (F.monotonically_increasing_id() % (1 << 33)).alias("at"),
    )
    sizes = marked.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    # One row per partition, so the running total over them is small.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return marked.join(starts, "part").select(
        "o_custkey", "o_orderkey", (F.col("start") + F.col("at") + 1).alias("place")
    )


@query("unique_fields", "SELECT DISTINCT o_custkey, o_orderstatus FROM orders")
def _(spark, folder):
    return grouping.distinct_fields(table(spark, folder, "orders"), "o_custkey", "o_orderstatus")


@query(
    "unique_rows",
    """
SELECT c_custkey, c_nationkey, c_mktsegment FROM (
  SELECT *, row_number() OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY c_custkey) AS rn FROM customer
) WHERE rn = 1""",
)
def _(spark, folder):
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return grouping.unique(customers, ["c_nationkey", "c_mktsegment"], ["c_custkey"])


@query("distinct_count", "SELECT l_returnflag, true AS close FROM lineitem GROUP BY l_returnflag")
def _(spark, folder):
    counted = table(spark, folder, "lineitem").groupBy("l_returnflag").agg(
        grouping.distinct_count("l_orderkey").alias("estimate"),
        F.count_distinct("l_orderkey").alias("exact"),
    )
    gap = F.abs(F.col("estimate") - F.col("exact"))
    return counted.select("l_returnflag", (gap <= F.col("exact") * 0.03).alias("close"))


@query(
    "ordered_groups",
    """
SELECT o_orderkey, row_number() OVER w AS place, lag(o_orderkey) OVER w AS before
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""",
)
def _(spark, folder):
    looked = grouping.ordered_groups(
        table(spark, folder, "orders"),
        ["o_custkey"],
        ["o_orderdate", "o_orderkey"],
        lambda w: {
            "place": F.row_number().over(w).cast("bigint"),
            "before": F.lag("o_orderkey").over(w),
        },
    )
    return looked.select("o_orderkey", "place", "before")


@query(
    "group_buffer",
    """
SELECT o_custkey, o_orderkey, sum(o_orderkey) OVER w AS running FROM (
  SELECT o_custkey, o_orderkey, o_orderdate FROM orders
) WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING)""".replace(
        "sum(o_orderkey) OVER w", "CAST(sum(o_orderkey) OVER w AS BIGINT)"
    ),
)
def _(spark, folder):
    def running(_key: tuple, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        so_far = 0
        for frame in frames:
            made = frame.assign(running=frame["o_orderkey"].cumsum() + so_far)
            so_far = made["running"].iloc[-1]
            yield made

    return grouping.stream_buffer(
        table(spark, folder, "orders").select("o_custkey", "o_orderkey"),
        ["o_custkey"],
        running,
        "o_custkey bigint, o_orderkey bigint, running bigint",
        ["o_orderkey"],
    )


@query(
    "custom_aggregate",
    """
SELECT l_returnflag, CAST(sum(l_quantity) AS BIGINT) AS s,
       CAST(sum(l_quantity * l_quantity) AS BIGINT) AS squares, count(*) AS n
FROM lineitem GROUP BY l_returnflag""",
)
def _(spark, folder):
    state = T.StructType.fromDDL("l_returnflag string, s bigint, squares bigint, n bigint")

    def partial(found: pd.DataFrame) -> pd.DataFrame:
        whole = found["l_quantity"].astype("int64")
        made = found.assign(s=whole, squares=whole * whole, n=1)
        return made.groupby("l_returnflag", as_index=False, dropna=False)[["s", "squares", "n"]].sum()

    def merge(states: pd.DataFrame) -> pd.DataFrame:
        return states.groupby("l_returnflag", as_index=False, dropna=False)[["s", "squares", "n"]].sum()

    lines = table(spark, folder, "lineitem").select("l_returnflag", "l_quantity")
    return grouping.custom_aggregate(lines, ["l_returnflag"], partial, merge, state)


@query(
    "total_sort",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey DESC",
)
def _(spark, folder):
    return grouping.total_sort(
        table(spark, folder, "orders").select("o_orderkey", "o_totalprice"),
        "o_totalprice",
        "o_orderkey",
        reverse=True,
    )


# -- joins and set operations


def _streams(spark, folder):
    """Customers, and orders under a key that is five higher: both have keys
    without a partner. One key is missing on both sides."""
    customers = table(spark, folder, "customer").select(
        F.nullif("c_custkey", F.lit(7)).alias("ck"), "c_nationkey"
    )
    orders = table(spark, folder, "orders").select(
        F.nullif(F.col("o_custkey") + 5, F.lit(7)).alias("ok"), "o_orderkey"
    )
    return customers, orders


STREAMS = """
c AS (SELECT nullif(c_custkey, 7) AS ck, c_nationkey FROM customer),
o AS (SELECT nullif(o_custkey + 5, 7) AS ok, o_orderkey FROM orders)"""


def _register_pair(how: str, sql_how: str):
    @query(
        f"co_group_{how}",
        f"""
WITH {STREAMS}
SELECT ck, c_nationkey, ok, o_orderkey FROM c {sql_how} JOIN o ON c.ck IS NOT DISTINCT FROM o.ok""",
    )
    def _(spark, folder):
        customers, orders = _streams(spark, folder)
        return joins.co_group([(customers, ["ck"]), (orders, ["ok"])], how)

    @query(
        f"hash_join_{how}",
        f"""
WITH {STREAMS}
SELECT ok, o_orderkey, ck, c_nationkey FROM o {sql_how} JOIN c ON c.ck IS NOT DISTINCT FROM o.ok""",
    )
    def _(spark, folder):
        customers, orders = _streams(spark, folder)
        return joins.hash_join([(orders, ["ok"]), (customers, ["ck"])], how)


for _how, _sql in (("inner", "INNER"), ("left", "LEFT"), ("right", "RIGHT"), ("outer", "FULL")):
    _register_pair(_how, _sql)


# Three streams on one key: customers, orders, and suppliers by the same number.
THREE = f"""
WITH {STREAMS},
s AS (SELECT s_suppkey AS sk, s_nationkey FROM supplier),
k AS (SELECT ck AS k FROM c UNION SELECT ok FROM o UNION SELECT sk FROM s)
SELECT ck, c_nationkey, ok, o_orderkey, sk, s_nationkey FROM k
LEFT JOIN c ON c.ck IS NOT DISTINCT FROM k.k
LEFT JOIN o ON o.ok IS NOT DISTINCT FROM k.k
LEFT JOIN s ON s.sk IS NOT DISTINCT FROM k.k
WHERE """
IN_C, IN_O, IN_S = "c_nationkey IS NOT NULL", "o_orderkey IS NOT NULL", "s_nationkey IS NOT NULL"


def _three(spark, folder, joiner):
    customers, orders = _streams(spark, folder)
    suppliers = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("sk"), "s_nationkey")
    return joins.co_group([(customers, ["ck"]), (orders, ["ok"]), (suppliers, ["sk"])], joiner)


for _name, _joiner, _where in (
    ("inner", "inner", f"{IN_C} AND {IN_O} AND {IN_S}"),
    ("left", "left", f"{IN_C} AND {IN_O}"),
    ("right", "right", f"{IN_O} AND {IN_S}"),
    ("outer", "outer", "true"),
    ("mixed", [False, True, False], IN_O),
):
    query(f"co_group_three_{_name}", THREE + _where)(
        lambda spark, folder, joiner=_joiner: _three(spark, folder, joiner)
    )


@query(
    "co_group_self",
    """
SELECT a.o_orderkey AS a, a.o_custkey AS cust, b.o_orderkey AS b, c.o_custkey AS cust_c
FROM orders a JOIN orders b USING (o_orderkey) JOIN orders c USING (o_orderkey)""",
)
def _(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    joined = joins.co_group(
        [(orders, ["o_orderkey"])] * 3, declared=["a", "cust", "b", "cust_b", "c", "cust_c"]
    )
    return joined.select("a", "cust", "b", "cust_c")


@query(
    "co_group_two_keys",
    """
SELECT l_orderkey, l_suppkey, l_linenumber, n FROM lineitem
JOIN (SELECT l_orderkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY ALL) USING (l_orderkey, l_suppkey)""",
)
def _(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber")
    keys = ["l_orderkey", "l_suppkey"]
    joined = joins.co_group(
        [(lines, keys), (grouping.count_by(lines, keys, "n"), keys)],
        declared=["l_orderkey", "l_suppkey", "l_linenumber", "o2", "s2", "n"],
    )
    return joined.select("l_orderkey", "l_suppkey", "l_linenumber", "n")


@query(
    "co_group_custom_joiner",
    """
SELECT c_custkey, count(o_orderkey) AS n, coalesce(max(o_orderkey), -1) AS newest
FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey""",
)
def _(spark, folder):
    def joiner(customers: pd.DataFrame, orders: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, newest = 0, -1
        for frame in orders:
            n, newest = n + len(frame), max(newest, frame["o_orderkey"].max())
        yield customers.assign(n=n, newest=newest)

    return joins.co_group_stream(
        (table(spark, folder, "customer").select("c_custkey"), ["c_custkey"]),
        (table(spark, folder, "orders").select("o_custkey", "o_orderkey"), ["o_custkey"]),
        joiner,
        "c_custkey bigint, n bigint, newest bigint",
    )


# There are few nations, each with many orders; orders are looked at one by one, so that
# eight tasks can share a nation.
@query(
    "co_group_split_joiner",
    """
SELECT c_nationkey, o_orderkey, n.n_name AS nation
FROM (SELECT c_nationkey, o_orderkey FROM customer JOIN orders ON o_custkey = c_custkey)
JOIN nation n ON n.n_nationkey = c_nationkey WHERE o_orderkey % 10 = n_regionkey""",
)
def _(spark, folder):
    def joiner(nations: pd.DataFrame, orders: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for nation in nations.itertuples():
            for frame in orders:
                own = frame[frame["o_orderkey"] % 10 == nation.n_regionkey]
                yield own.assign(nation=nation.n_name)[["c_nationkey", "o_orderkey", "nation"]]

    customers, orders = table(spark, folder, "customer"), table(spark, folder, "orders")
    placed = customers.join(orders, F.col("c_custkey") == F.col("o_custkey")).select("c_nationkey", "o_orderkey")
    return joins.co_group_stream(
        (table(spark, folder, "nation").select("n_nationkey", "n_regionkey", "n_name"), ["n_nationkey"]),
        (placed, ["c_nationkey"]),
        joiner,
        "c_nationkey int, o_orderkey bigint, nation string",
        splits=8,
    )


@query(
    "merge_streams",
    "SELECT c_nationkey AS nation, c_name AS name FROM customer UNION ALL SELECT s_nationkey, s_name FROM supplier",
)
def _(spark, folder):
    return grouping.merge(
        table(spark, folder, "customer").select(F.col("c_nationkey").alias("nation"), F.col("c_name").alias("name")),
        table(spark, folder, "supplier").select(F.col("s_nationkey").alias("nation"), F.col("s_name").alias("name")),
    )


@query("union_distinct", "SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier")
def _(spark, folder):
    return grouping.union_distinct(
        table(spark, folder, "customer").select(F.col("c_nationkey").alias("nation")),
        table(spark, folder, "supplier").select(F.col("s_nationkey").alias("nation")),
    )


# -- data quality


def _order_rules():
    return [
        quality.none_null(["cust", "status"]),
        quality.not_equals(["status"], ["P"]),
        quality.matches(["cust", "status"], "[02468]\tO", negate=True),
        quality.holds("cust > 10", quality.Level.VALID),
    ]


BROKEN = f"""
WITH {GAPS},
judged AS (
  SELECT *, cust IS NULL OR status IS NULL AS b1, coalesce(status = 'P', false) AS b2,
         regexp_matches(coalesce(CAST(cust AS VARCHAR), '') || chr(9) || coalesce(status, ''), '[02468]\tO') AS b3,
         NOT coalesce(cust > 10, false) AS b4
  FROM gaps
)
"""


@query("trap_good_rows", BROKEN + "SELECT o_orderkey, cust, status FROM judged WHERE NOT (b1 OR b2 OR b3 OR b4)")
def _(spark, folder):
    good, _rejected = quality.trap(_with_gaps(spark, folder), _order_rules())
    return good


@query(
    "trap_rejected_rows",
    BROKEN
    + """SELECT o_orderkey, cust, status, concat_ws(',',
    CASE WHEN b1 THEN 'not_null' END, CASE WHEN b2 THEN 'not_equals' END,
    CASE WHEN b3 THEN 'matches' END, CASE WHEN b4 THEN 'expression' END) AS broken
FROM judged WHERE b1 OR b2 OR b3 OR b4""",
)
def _(spark, folder):
    _good, rejected = quality.trap(_with_gaps(spark, folder), _order_rules())
    return rejected.withColumn("broken", F.array_join("broken", ","))


@query("assert_level_valid", BROKEN + "SELECT o_orderkey FROM judged WHERE NOT b4")
def _(spark, folder):
    good, _rejected = quality.trap(_with_gaps(spark, folder), _order_rules(), quality.Level.VALID)
    return good.select("o_orderkey")


@query("assert_level_none", "SELECT o_orderkey FROM orders")
def _(spark, folder):
    good, _rejected = quality.trap(_with_gaps(spark, folder), _order_rules(), quality.Level.NONE)
    return good.select("o_orderkey")


def _count_kept(spark, folder, name: str, rule: quality.Rule):
    good, _rejected = quality.trap(table(spark, folder, name), [rule])
    return good


@query("assert_equals", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '5-LOW'")
def _(spark, folder):
    rule = quality.equals(["o_orderstatus", "o_orderpriority"], ["F", "5-LOW"])
    return _count_kept(spark, folder, "orders", rule).select("o_orderkey")


@query("assert_not_equals", "SELECT o_orderkey FROM orders WHERE NOT (o_orderstatus = 'F' AND o_orderpriority = '5-LOW')")
def _(spark, folder):
    rule = quality.not_equals(["o_orderstatus", "o_orderpriority"], ["F", "5-LOW"])
    return _count_kept(spark, folder, "orders", rule).select("o_orderkey")


@query("assert_not_null", f"WITH {GAPS} SELECT o_orderkey FROM gaps WHERE cust IS NOT NULL AND status IS NOT NULL")
def _(spark, folder):
    good, _rejected = quality.trap(_with_gaps(spark, folder), [quality.none_null(["cust", "status"])])
    return good.select("o_orderkey")


# Which of the three size rules a frame of so many fields passes.
@query(
    "assert_sizes",
    """
SELECT comparison, size, CASE comparison WHEN 'equals' THEN 3 = size WHEN 'less_than' THEN 3 < size ELSE 3 > size END AS passes,
       (SELECT count(*) FROM nation) AS n
FROM (VALUES ('equals'), ('less_than'), ('more_than')) AS a(comparison), (VALUES (2), (3), (4)) AS b(size)""",
)
def _(spark, folder):
    nations = table(spark, folder, "nation").select("n_nationkey", "n_name", "n_regionkey")

    def passes(comparison: str, size: int) -> bool:
        try:
            quality.check_size(nations, comparison, size)
        except quality.AssertionFailed:
            return False
        return True

    tried = [(c, size, passes(c, size)) for c in ("equals", "less_than", "more_than") for size in (2, 3, 4)]
    outcome = spark.createDataFrame(tried, "comparison string, size int, passes boolean")
    return outcome.withColumn("n", F.lit(nations.count()).cast("bigint"))


@query("assert_equals_all", "SELECT doc_id FROM labels WHERE quality = 0 AND toxic = 0")
def _(spark, folder):
    return _count_kept(spark, folder, "labels", quality.equals_all(["quality", "toxic"], 0)).select("doc_id")


@query("assert_null", f"WITH {GAPS} SELECT o_orderkey FROM gaps WHERE cust IS NULL AND status IS NULL")
def _(spark, folder):
    good, _rejected = quality.trap(_with_gaps(spark, folder), [quality.all_null(["cust", "status"])])
    return good.select("o_orderkey")


@query(
    "assert_matches_all",
    "SELECT page_id FROM pages WHERE regexp_matches(url, 'example') AND regexp_matches(html, 'example')",
)
def _(spark, folder):
    return _count_kept(spark, folder, "pages", quality.matches_all(["url", "html"], "example")).select("page_id")


@query("assert_passes_all_rows", "SELECT l_orderkey, l_linenumber FROM lineitem")
def _(spark, folder):
    lines = quality.check_size(table(spark, folder, "lineitem"), "more_than", 10)
    checked = quality.enforce(lines, [quality.holds("l_quantity > 0"), quality.none_null(["l_partkey"])])
    return checked.select("l_orderkey", "l_linenumber")


def _register_group_size(comparison: str, sign: str):
    @query(
        f"assert_group_size_{comparison}",
        f"""
SELECT o_custkey, count(*) AS group_size FROM orders GROUP BY o_custkey HAVING NOT (count(*) {sign} 10)""",
    )
    def _(spark, folder):
        return quality.group_size_failures(table(spark, folder, "orders"), ["o_custkey"], comparison, 10)


for _comparison, _sign in (("equals", "="), ("less_than", "<"), ("more_than", ">")):
    _register_group_size(_comparison, _sign)


@query(
    "assert_group_size_pattern",
    """
SELECT o_custkey, count(*) AS group_size FROM orders WHERE regexp_full_match(CAST(o_custkey AS VARCHAR), '1.*')
GROUP BY o_custkey HAVING NOT (count(*) < 10)""",
)
def _(spark, folder):
    return quality.group_size_failures(
        table(spark, folder, "orders"), ["o_custkey"], "less_than", 10, pattern="1.*"
    )


@query("aggregate_checked", "SELECT o_custkey, max(o_orderkey) AS newest FROM orders GROUP BY o_custkey")
def _(spark, folder):
    return quality.aggregate_checked(
        table(spark, folder, "orders"), ["o_custkey"], {"newest": F.max("o_orderkey")}, "more_than", 0
    )


@query("select_by_position", "SELECT l_tax, l_orderkey AS line_of FROM lineitem")
def _(spark, folder):
    lines = table(spark, folder, "lineitem")
    return fields.project(lines, [7, "l_orderkey"], ["l_tax", "line_of"])
