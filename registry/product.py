"""Queries of the web-traffic job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registry.base import (
    LEVELS,
    LINKS,
    NORMAL_URL,
    PV,
    RESOLVED,
    ROOTS,
    equivs,
    links,
    page_views,
    query,
    raw_views,
    table,
)
from tidemark import schema
from tidemark.functions import buckets, urls
from tidemark.plans import identity, views
from tidemark.sources.facts import shred
from tidemark.sources.scratch import Scratch

USER = "person.user_id"


def resolved(spark: SparkSession, folder: str) -> DataFrame:
    """Page views as the serving views read them."""
    clean = views.normalize_urls(page_views(spark, folder))
    return views.deduplicate_page_views(identity.resolve_identities(clean, equivs(spark, folder)))


def wide_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Facts of all four kinds, derived from the tables."""
    customers = table(spark, folder, "customer")
    names = customers.select(
        schema.user_person("c_custkey").alias("person"),
        F.lit(schema.FULL_NAME).alias("value_kind"),
        F.col("c_name").alias("full_name"),
        F.lit(0).alias("ts"),
    )
    places = customers.select(
        schema.user_person("c_custkey").alias("person"),
        F.lit(schema.LOCATION).alias("value_kind"),
        F.col("c_mktsegment").alias("city"),
        F.lit(0).alias("ts"),
    )
    genders = customers.where("c_custkey % 3 > 0").select(
        schema.user_person("c_custkey").alias("person"),
        F.lit(schema.GENDER).alias("value_kind"),
        F.when(F.col("c_custkey") % 3 == 1, schema.MALE).otherwise(schema.FEMALE).alias("gender"),
        F.lit(0).alias("ts"),
    )
    pages = table(spark, folder, "pages").select(
        "url",
        F.lit(schema.PAGE_VIEW_COUNT).alias("value_kind"),
        F.length("html").alias("page_view"),
        F.lit(0).alias("ts"),
    )
    parts = [
        schema.to_facts(page_views(spark, folder), schema.PAGE_VIEW),
        schema.to_facts(equivs(spark, folder), schema.EQUIV),
        schema.to_facts(names, schema.PERSON_PROPERTY),
        schema.to_facts(places, schema.PERSON_PROPERTY),
        schema.to_facts(genders, schema.PERSON_PROPERTY),
        schema.to_facts(pages, schema.PAGE_PROPERTY),
    ]
    facts = parts[0]
    for part in parts[1:]:
        facts = facts.unionByName(part)
    return facts


FACT_COUNTS = f"""
WITH {PV}, {LINKS}
SELECT 4 AS unit, 0 AS value_kind, count(*) AS facts FROM pv
UNION ALL SELECT 3, 0, count(*) FROM links
UNION ALL SELECT 1, 1, count(*) FROM customer
UNION ALL SELECT 1, 2, count(*) FROM customer WHERE c_custkey % 3 > 0
UNION ALL SELECT 1, 3, count(*) FROM customer
UNION ALL SELECT 2, 1, count(*) FROM pages"""


@query("shred_facts", FACT_COUNTS)
def _(spark, folder):
    shredded = shred(wide_facts(spark, folder))
    return shredded.groupBy("unit", "value_kind").agg(F.count(F.lit(1)).alias("facts"))


@query("normalize_urls", f"SELECT page_id, url, {NORMAL_URL} AS normalized FROM pages")
def _(spark, folder):
    return table(spark, folder, "pages").select(
        "page_id", "url", urls.normalize_url("url").alias("normalized")
    )


@query("normalize_urls_strict", f"SELECT page_id, {NORMAL_URL} AS normalized FROM pages")
def _(spark, folder):
    return table(spark, folder, "pages").select(
        "page_id", urls.strict_normalize_url("url").alias("normalized")
    )


HOST = "regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1)"
PATH = "regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1)"
TRIMMED_PATH = f"regexp_replace({PATH}, '/$', '')"


@query(
    "normalize_unusual_urls",
    f"""
SELECT page_id, 'port' AS kind, 'http://' || {HOST} || {PATH} AS normalized,
       {HOST} || ':8080' AS domain FROM pages
UNION ALL SELECT page_id, 'user', 'http://' || {HOST} || {PATH}, 'me:pw@' || {HOST} FROM pages
UNION ALL SELECT page_id, 'upper', 'http://' || {HOST} || {PATH}, {HOST} FROM pages
UNION ALL SELECT page_id, 'unknown', 'gopher://' || {HOST} || {PATH}, NULL FROM pages
UNION ALL SELECT page_id, 'bad port', 'http://' || {HOST} || ':x' || {PATH}, NULL FROM pages
UNION ALL SELECT page_id, 'dots', 'http://' || {HOST} || '/b' || {PATH}, {HOST} FROM pages
UNION ALL SELECT page_id, 'blank', 'http://' || {HOST} || '/a b', {HOST} FROM pages
UNION ALL SELECT page_id, 'none', url, NULL FROM (SELECT page_id, {HOST} AS url FROM pages)""",
)
def _(spark, folder):
    host = F.regexp_extract("url", "^[a-z]+://([^/?#:]*)", 1)
    path = F.regexp_extract("url", "^[a-z]+://[^/?#]*([^?#]*)", 1)
    forms = {
        "port": F.concat(F.lit("http://"), host, F.lit(":8080"), path),
        "user": F.concat(F.lit("http://me:pw@"), host, path, F.lit("?x=1#y")),
        "upper": F.concat(F.lit("HTTP://"), host, path),
        "unknown": F.concat(F.lit("gopher://"), host, path),
        "bad port": F.concat(F.lit("http://"), host, F.lit(":x"), path),
        "dots": F.concat(F.lit("http://"), host, F.lit("/a/./../b"), path),
        "blank": F.concat(F.lit(" http://"), host, F.lit("/a b ")),
        "none": host,
    }
    rows = F.array(
        *[F.struct(F.lit(kind).alias("kind"), form.alias("raw")) for kind, form in forms.items()]
    )
    return (
        table(spark, folder, "pages")
        .select("page_id", F.inline(rows))
        .select(
            "page_id",
            "kind",
            urls.normalize_url("raw").alias("normalized"),
            urls.extract_domain("raw").alias("domain"),
        )
    )


@query(
    "normalize_fact_urls",
    f"""
WITH {PV}
SELECT unit, url, count(*) AS facts FROM (
  SELECT 4 AS unit, {NORMAL_URL} AS url FROM pv
  UNION ALL SELECT 2, {NORMAL_URL} FROM pages
) GROUP BY unit, url""",
)
def _(spark, folder):
    facts = views.normalize_fact_urls(wide_facts(spark, folder)).where("url IS NOT NULL")
    return facts.groupBy("unit", "url").agg(F.count(F.lit(1)).alias("facts"))


@query("edgify_equivs", f"WITH {LINKS} SELECT low AS node1, high AS node2 FROM links")
def _(spark, folder):
    return identity.edgify_equiv(equivs(spark, folder)).select(
        F.col("node1")["user_id"].alias("node1"), F.col("node2")["user_id"].alias("node2")
    )


def _edges(spark, folder) -> DataFrame:
    return identity.edgify_equiv(equivs(spark, folder))


@query(
    "bidirectional_edges",
    f"WITH {LINKS} SELECT low AS b1, high AS b2 FROM links UNION ALL SELECT high, low FROM links",
)
def _(spark, folder):
    return identity.bidirectional_edges(_edges(spark, folder)).select(
        F.col("b1")["user_id"].alias("b1"), F.col("b2")["user_id"].alias("b2")
    )


ITERATION = f"""
WITH {LINKS},
both_ways AS (SELECT low AS b1, high AS b2 FROM links UNION SELECT high, low FROM links),
nodes AS (
  SELECT b1, least(b1, min(b2)) AS smallest, count(*) > 1 AND min(b2) < b1 AS is_new
  FROM both_ways GROUP BY b1
),
emitted AS (
  SELECT n.smallest AS node1, e.b2 AS node2, n.is_new
  FROM both_ways e JOIN nodes n ON n.b1 = e.b1 WHERE e.b2 <> n.smallest
  UNION ALL
  SELECT smallest, b1, is_new FROM nodes WHERE b1 <> smallest
)"""


@query("iterate_edges", ITERATION + " SELECT node1, node2, is_new FROM emitted")
def _(spark, folder):
    rows = identity.iterate_edges(identity.bidirectional_edges(_edges(spark, folder)))
    return rows.select(
        F.col("node1")["user_id"].alias("node1"), F.col("node2")["user_id"].alias("node2"), "is_new"
    )


@query("identity_iteration", ITERATION + " SELECT DISTINCT node1, node2 FROM emitted")
def _(spark, folder):
    following, _progress = identity.identity_iteration(_edges(spark, folder))
    return following.select(
        F.col("node1")["user_id"].alias("node1"), F.col("node2")["user_id"].alias("node2")
    )


@query("identity_progress", ITERATION + " SELECT node1, node2 FROM emitted WHERE is_new")
def _(spark, folder):
    _following, progress = identity.identity_iteration(_edges(spark, folder))
    return progress.select(
        F.col("node1")["user_id"].alias("node1"), F.col("node2")["user_id"].alias("node2")
    )


@query("connected_components", f"WITH RECURSIVE {ROOTS} SELECT id, root FROM roots")
def _(spark, folder):
    return identity.connected_components(_edges(spark, folder)).select(
        F.col("id")["user_id"].alias("id"), F.col("root")["user_id"].alias("root")
    )


# Ids divisible by three are cookies here. Cookies come before user ids.
@query(
    "connected_components_cookies",
    f"""
WITH RECURSIVE {ROOTS},
members AS (
  SELECT id, root FROM roots UNION SELECT root, root FROM roots
),
persons AS (
  SELECT root, id, CASE WHEN id % 3 = 0 THEN '1:c' || id ELSE '2:' || id END AS person,
         CASE WHEN id % 3 = 0 THEN 1 ELSE 2 END AS kind,
         CASE WHEN id % 3 = 0 THEN 'c' || id END AS cookie
  FROM members
),
firsts AS (
  SELECT root, person AS first_person FROM (
    SELECT *, row_number() OVER (PARTITION BY root ORDER BY kind, cookie NULLS FIRST, id) AS rn
    FROM persons
  ) WHERE rn = 1
)
SELECT p.person AS id, f.first_person AS root
FROM persons p JOIN firsts f ON f.root = p.root WHERE p.person <> f.first_person""",
)
def _(spark, folder):
    def person(name):
        return F.when(
            F.col(name) % 3 == 0, schema.cookie_person(F.concat(F.lit("c"), F.col(name).cast("string")))
        ).otherwise(schema.user_person(name))

    edges = links(spark, folder).select(person("low").alias("node1"), person("high").alias("node2"))
    return identity.connected_components(edges).select(
        schema.person_key("id").alias("id"), schema.person_key("root").alias("root")
    )


@query(
    "normalize_user_ids",
    f"""
WITH RECURSIVE {PV}, {ROOTS}
SELECT coalesce(r.root, pv.user_id) AS user_id, url, nonce, ts
FROM pv LEFT JOIN roots r ON r.id = pv.user_id""",
)
def _(spark, folder):
    rows = identity.resolve_identities(page_views(spark, folder), equivs(spark, folder))
    return rows.select(F.col(USER).alias("user_id"), "url", "nonce", "ts")


@query(
    "deduplicate_page_views",
    f"""
WITH {PV},
twice AS (SELECT user_id, url, nonce % 7 AS nonce, ts - ts % 86400 AS ts FROM pv)
SELECT DISTINCT user_id, url, nonce, ts FROM twice""",
)
def _(spark, folder):
    views_twice = page_views(spark, folder).select(
        "person",
        "url",
        (F.col("nonce") % 7).alias("nonce"),
        (F.col("ts") - F.col("ts") % 86400).alias("ts"),
    )
    rows = views.deduplicate_page_views(views_twice)
    return rows.select(F.col(USER).alias("user_id"), "url", "nonce", "ts")


@query("extract_page_view_fields", f"WITH {PV} SELECT url, user_id, ts FROM pv")
def _(spark, folder):
    rows = views.extract_page_view_fields(page_views(spark, folder))
    return rows.select("url", F.col(USER).alias("user_id"), "ts")


@query("to_hour_bucket", f"WITH {PV} SELECT nonce, CAST(ts // 3600 AS INTEGER) AS hour FROM pv")
def _(spark, folder):
    return raw_views(spark, folder).select("nonce", buckets.hour_bucket("ts").alias("hour"))


@query(
    "emit_granularities",
    f"""
WITH {PV}, {LEVELS}
SELECT nonce, granularity, CAST(ts // 3600 // hours AS INTEGER) AS bucket FROM pv, levels""",
)
def _(spark, folder):
    hours = raw_views(spark, folder).select("nonce", buckets.hour_bucket("ts").alias("hour"))
    return buckets.emit_granularities(hours).drop("hour")


PAGE_VIEW_SQL = f"""
WITH RECURSIVE {RESOLVED}, {LEVELS},
counted AS (
  SELECT url, granularity, CAST(ts // 3600 // hours AS INTEGER) AS bucket,
         count(*) AS views, count(DISTINCT user_id) AS visitors
  FROM uv, levels GROUP BY ALL
)
"""


@query(
    "page_view_batch_view",
    PAGE_VIEW_SQL + "SELECT url, granularity, bucket, views AS value FROM counted",
)
def page_view_batch_view(spark, folder):
    return views.page_view_batch_view(resolved(spark, folder))


# With this few visitors the sketches hold every visitor and are exact.
@query("uniques_view", PAGE_VIEW_SQL + "SELECT url, granularity, bucket, visitors AS value FROM counted")
def uniques_view(spark, folder):
    return views.uniques_view(resolved(spark, folder))


@query("traffic_view", PAGE_VIEW_SQL + "SELECT url, granularity, bucket, views, visitors FROM counted")
def traffic_view(spark, folder):
    return views.traffic_view(resolved(spark, folder))


@query(
    "construct_sketch",
    f"""
WITH {PV}
SELECT {NORMAL_URL} AS url, CAST(ts // 3600 AS INTEGER) AS hour, true AS close
FROM pv GROUP BY 1, 2""",
)
def _(spark, folder):
    hourly = views.hourly_rollup(
        views.normalize_urls(page_views(spark, folder)),
        views.construct_sketch(schema.person_key("person")).alias("sketch"),
        F.count_distinct("person").alias("exact"),
    )
    gap = F.abs(F.hll_sketch_estimate("sketch") - F.col("exact"))
    return hourly.select("url", "hour", (gap <= F.greatest(F.lit(1), F.col("exact") * 0.03)).alias("close"))


@query(
    "merge_sketches",
    """
SELECT l_returnflag, l_linestatus, true AS close FROM lineitem GROUP BY 1, 2""",
)
def _(spark, folder):
    # Part keys, by supplier first and then over all suppliers.
    lines = table(spark, folder, "lineitem")
    groups = ["l_returnflag", "l_linestatus"]
    exact = lines.groupBy(*groups).agg(F.count_distinct("l_partkey").alias("exact"))
    merged = (
        lines.groupBy(*groups, "l_suppkey")
        .agg(views.construct_sketch("l_partkey").alias("sketch"))
        .groupBy(*groups)
        .agg(views.merge_sketches("sketch").alias("estimate"))
    )
    gap = F.abs(F.col("estimate") - F.col("exact"))
    return merged.join(exact, groups).select(*groups, (gap <= F.col("exact") * 0.03).alias("close"))


@query(
    "extract_domain",
    "SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS domain FROM pages",
)
def _(spark, folder):
    return table(spark, folder, "pages").select("page_id", urls.extract_domain("url").alias("domain"))


VISITS = f"""
WITH RECURSIVE {RESOLVED},
d AS (SELECT regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS domain, user_id, ts FROM uv),
gaps AS (
  SELECT *, CASE WHEN ts - lag(ts) OVER w > 900 THEN 1 ELSE 0 END AS opens
  FROM d WINDOW w AS (PARTITION BY domain, user_id ORDER BY ts)
),
numbered AS (
  SELECT *, sum(opens) OVER (PARTITION BY domain, user_id ORDER BY ts) AS visit FROM gaps
),
visit_sizes AS (
  SELECT domain, user_id, visit, count(*) AS n FROM numbered GROUP BY ALL
),
per_user AS (
  SELECT domain, user_id, count(*) AS visits, count(*) FILTER (n = 1) AS bounces
  FROM visit_sizes GROUP BY ALL
),
per_domain AS (
  SELECT domain, CAST(sum(visits) AS BIGINT) AS visits, CAST(sum(bounces) AS BIGINT) AS bounces
  FROM per_user GROUP BY domain
)
"""


@query("analyze_visits", VISITS + "SELECT domain, user_id, visits, bounces FROM per_user")
def _(spark, folder):
    rows = views.analyze_visits(views.domain_views(resolved(spark, folder)))
    return rows.select("domain", F.col(USER).alias("user_id"), "visits", "bounces")


# Visits over all domains: busier groups, and visits that cross midnight.
@query(
    "analyze_visits_all_domains",
    f"""
WITH {PV},
gaps AS (
  SELECT *, CASE WHEN ts - lag(ts) OVER w > 900 THEN 1 ELSE 0 END AS opens
  FROM pv WINDOW w AS (PARTITION BY user_id % 4 ORDER BY ts)
),
numbered AS (
  SELECT *, user_id % 4 AS grp, sum(opens) OVER (PARTITION BY user_id % 4 ORDER BY ts) AS visit FROM gaps
),
sizes AS (SELECT grp, visit, count(*) AS n FROM numbered GROUP BY ALL)
SELECT grp, count(*) AS visits, count(*) FILTER (n = 1) AS bounces FROM sizes GROUP BY grp""",
)
def _(spark, folder):
    rows = raw_views(spark, folder).select((F.col("user_id") % 4).alias("grp"), "ts")
    return views.analyze_visits(rows, ["grp"])


LEGACY = f"""
WITH RECURSIVE {RESOLVED},
per_domain AS (
  SELECT regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS domain, count(*) AS visits,
         count(*) AS bounces
  FROM uv GROUP BY 1
)
"""


@query(
    "analyze_visits_legacy",
    f"""
WITH RECURSIVE {RESOLVED}
SELECT regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS domain, user_id, count(*) AS visits,
       count(*) AS bounces
FROM uv GROUP BY 1, 2""",
)
def _(spark, folder):
    rows = views.analyze_visits(views.domain_views(resolved(spark, folder)), legacy=True)
    return rows.select("domain", F.col(USER).alias("user_id"), "visits", "bounces")


@query("bounces_view", VISITS + "SELECT domain, visits, bounces FROM per_domain")
def bounces_view(spark, folder):
    return views.bounces_view(resolved(spark, folder))


@query(
    "bounce_rate",
    VISITS + "SELECT domain, CAST(bounces AS DOUBLE) / CAST(visits AS DOUBLE) AS rate FROM per_domain",
)
def _(spark, folder):
    rows = views.bounces_view(resolved(spark, folder))
    return rows.select("domain", buckets.bounce_rate("bounces", "visits").alias("rate"))


@query("bounce_rate_legacy", LEGACY + "SELECT domain, visits // bounces AS rate FROM per_domain")
def _(spark, folder):
    rows = views.bounces_view(resolved(spark, folder), legacy=True)
    return rows.select("domain", buckets.bounce_rate("visits", "bounces", legacy=True).alias("rate"))


KEY = "url || '/' || granularity || '-' || bucket"


@query("publish_page_views", PAGE_VIEW_SQL + f"SELECT {KEY} AS key, views AS value, url, granularity, bucket FROM counted")
def _(spark, folder):
    return views.publishable_buckets(views.page_view_batch_view(resolved(spark, folder)))


@query("publish_uniques", PAGE_VIEW_SQL + f"SELECT {KEY} AS key, visitors AS value, url, granularity, bucket FROM counted")
def _(spark, folder):
    return views.publishable_buckets(views.uniques_view(resolved(spark, folder)))


@query(
    "publish_bounces",
    VISITS
    + """SELECT domain AS key, domain, visits, bounces,
       CAST(bounces AS DOUBLE) / CAST(visits AS DOUBLE) AS rate FROM per_domain""",
)
def _(spark, folder):
    return views.publishable_bounces(views.bounces_view(resolved(spark, folder)))


@query(
    "publish_bounces_legacy",
    LEGACY
    + """SELECT domain AS key, domain, visits AS bounces, bounces AS total,
       visits // bounces AS rate FROM per_domain""",
)
def _(spark, folder):
    rows = views.bounces_view(resolved(spark, folder), legacy=True)
    return views.publishable_bounces(rows, legacy=True)


@query(
    "to_url_bucketed_key",
    f"""
WITH {PV}
SELECT nonce, url || '/h-' || CAST(ts // 3600 AS VARCHAR) AS key FROM pv""",
)
def _(spark, folder):
    return raw_views(spark, folder).select(
        "nonce",
        buckets.url_bucketed_key("url", F.lit("h"), buckets.hour_bucket("ts")).alias("key"),
    )


@query("to_serialized_string", "SELECT page_id, url AS serialized FROM pages")
def _(spark, folder):
    return table(spark, folder, "pages").select(
        "page_id", buckets.serialized_string("url").alias("serialized")
    )


HEX16 = "lpad(hex({0}), 16, '0')"


@query("to_serialized_long", f"SELECT event_id, {HEX16.format('user_id')} AS hexed FROM events")
def _(spark, folder):
    return table(spark, folder, "events").select(
        "event_id", F.hex(buckets.serialized_long("user_id")).alias("hexed")
    )


@query(
    "to_serialized_long_pair",
    f"SELECT event_id, {HEX16.format('user_id')} || {HEX16.format('event_id')} AS hexed FROM events",
)
def _(spark, folder):
    return table(spark, folder, "events").select(
        "event_id", F.hex(buckets.serialized_long_pair("user_id", "event_id")).alias("hexed")
    )


# All keys of a URL fall into one shard, and the shard is in range.
@query(
    "url_shards",
    f"""
WITH {PV}
SELECT url, count(DISTINCT ts // 3600) AS keys, CAST(1 AS BIGINT) AS shards, true AS in_range
FROM pv GROUP BY url""",
)
def _(spark, folder):
    keys = (
        raw_views(spark, folder)
        .select("url", buckets.url_bucketed_key("url", F.lit("h"), buckets.hour_bucket("ts")).alias("key"))
        .distinct()
        .withColumn("shard", buckets.url_shard("key", 16))
    )
    return keys.groupBy("url").agg(
        F.count(F.lit(1)).alias("keys"),
        F.count_distinct("shard").alias("shards"),
        ((F.min("shard") >= 0) & (F.max("shard") < 16)).alias("in_range"),
    )


@query(
    "hourly_totals_agree",
    """
SELECT granularity, (SELECT count(*) FROM events) AS views
FROM (VALUES ('h'), ('d'), ('w'), ('m')) AS t(granularity)""",
)
def _(spark, folder):
    view = views.page_view_batch_view(page_views(spark, folder))
    return view.groupBy("granularity").agg(F.sum("value").alias("views"))


__all__ = ["Scratch", "bounces_view", "page_view_batch_view", "resolved", "traffic_view", "uniques_view", "wide_facts"]
