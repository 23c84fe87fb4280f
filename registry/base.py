"""Tables, the page views and links derived from them, and the query register."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schema

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, with the SQL that gives the same rows."""

    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    # Times of the tables are UTC wall times.
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{folder}/{name}.parquet")


def raw_views(spark: SparkSession, folder: str) -> DataFrame:
    """``user_id, url, nonce, ts``: every event as a view of one of the pages."""
    pages = table(spark, folder, "pages").select("page_id", "url")
    total = table(spark, folder, "pages").agg(F.count(F.lit(1))).scalar()
    events = table(spark, folder, "events").select(
        "user_id",
        F.col("event_id").alias("nonce"),
        F.unix_seconds(F.col("ts").cast("timestamp")).cast("int").alias("ts"),
        (F.col("event_id") % total).alias("page_id"),
    )
    return events.join(pages, "page_id").select("user_id", "url", "nonce", "ts")


def page_views(spark: SparkSession, folder: str) -> DataFrame:
    return raw_views(spark, folder).select(
        schema.user_person("user_id").alias("person"), "url", "nonce", "ts"
    )


def links(spark: SparkSession, folder: str) -> DataFrame:
    """``low, high``: the user ids of every identity link."""
    users = table(spark, folder, "events").select("user_id").distinct()
    return users.where("user_id % 5 <> 0").select(
        F.col("user_id").alias("low"), (F.col("user_id") + 1).alias("high")
    )


def equivs(spark: SparkSession, folder: str) -> DataFrame:
    return links(spark, folder).select(
        schema.user_person("low").alias("id1"),
        schema.user_person("high").alias("id2"),
        F.lit(1000).alias("ts"),
    )


# The same derivations for the SQL side.
PV = """
pv AS (
  SELECT e.user_id, p.url, e.event_id AS nonce,
         CAST(epoch_us(e.ts) // 1000000 AS INTEGER) AS ts
  FROM events e JOIN pages p ON p.page_id = e.event_id % (SELECT count(*) FROM pages)
)"""

NORMAL_URL = (
    "regexp_extract(url, '^([a-z]+)://', 1) || '://' || "
    "regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1) || "
    "regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1)"
)

LINKS = """
links AS (
  SELECT DISTINCT user_id AS low, user_id + 1 AS high FROM events WHERE user_id % 5 <> 0
)"""

# Every link leads from an id to the next one, so the smallest id that leads to
# an id is the root of its component.
ROOTS = LINKS + """,
reach AS (
  SELECT low AS id, low AS root FROM links
  UNION
  SELECT l.high, r.root FROM reach r JOIN links l ON l.low = r.id
),
roots AS (SELECT id, min(root) AS root FROM reach GROUP BY id HAVING min(root) <> id)"""

RESOLVED = PV + "," + ROOTS + f""",
uv AS (
  SELECT DISTINCT coalesce(r.root, pv.user_id) AS user_id, {NORMAL_URL} AS url, nonce, ts
  FROM pv LEFT JOIN roots r ON r.id = pv.user_id
)"""

# Granularity levels of an hour bucket.
LEVELS = """
levels AS (
  SELECT 'h' AS granularity, 1 AS hours UNION ALL SELECT 'd', 24
  UNION ALL SELECT 'w', 168 UNION ALL SELECT 'm', 672
)"""
