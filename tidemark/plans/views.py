"""From page views to the three serving views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import schema
from tidemark.functions import buckets, urls

# A longer silence than this opens a new visit; sketch precision.
VISIT_GAP_SECONDS = 900
SKETCH_PRECISION = 14
SECONDS_PER_DAY = 86_400


def normalize_urls(df: DataFrame, url: str = "url") -> DataFrame:
    """Reduce the URL column to protocol, host and path."""
    return df.withColumn(url, urls.normalize_url(url))


def normalize_fact_urls(facts: DataFrame) -> DataFrame:
    """The same for wide facts: page views and page properties only."""
    has_page = F.col("unit").isin(schema.PAGE_VIEW, schema.PAGE_PROPERTY)
    return facts.withColumn("url", F.when(has_page, urls.normalize_url("url")).otherwise(F.col("url")))


def deduplicate_page_views(page_views: DataFrame) -> DataFrame:
    """Distinct whole records: person, page, nonce and time."""
    return page_views.select(*schema.PAGE_VIEWS.names).distinct()


def extract_page_view_fields(page_views: DataFrame) -> DataFrame:
    """``(url, person, ts)`` of the views that have a URL."""
    return page_views.where(F.col("url").isNotNull()).select("url", "person", "ts")


def hourly_rollup(page_views: DataFrame, *aggregates: Column) -> DataFrame:
    """Aggregates per URL and hour, the base of both bucketed views."""
    rows = extract_page_view_fields(page_views)
    return rows.groupBy("url", buckets.hour_bucket("ts").alias("hour")).agg(*aggregates)


def construct_sketch(value) -> Column:
    """Aggregate: HyperLogLog sketch of a text or number column, as bytes."""
    return F.hll_sketch_agg(value, SKETCH_PRECISION)


def merge_sketches(sketch) -> Column:
    """Aggregate: number of distinct values in the union of sketches."""
    return F.hll_sketch_estimate(F.hll_union_agg(sketch))


def page_view_batch_view(page_views: DataFrame) -> DataFrame:
    """Views per ``(url, granularity, bucket)``."""
    hourly = hourly_rollup(page_views, F.count(F.lit(1)).alias("views"))
    return _roll_up(hourly.withColumnRenamed("views", "value"), value=F.sum("value"))


def _roll_up(hourly: DataFrame, **merges: Column) -> DataFrame:
    """Hourly rows and their merges at the longer levels.

    Days are merged from hours, weeks and months from days, so a sketch is sent on
    once per hour and twice per day instead of four times per hour; hour rows are
    whole already and are not sent at all. The shuffle below the hourly rows is
    the same in all branches and runs once.
    """
    names = list(merges)
    merged = [merge.alias(name) for name, merge in merges.items()]
    bare = hourly.select("url", "hour", *names)
    daily = bare.groupBy("url", buckets.day_bucket("hour").alias("day")).agg(*merged)
    longer = (
        daily.select("url", F.inline(buckets.day_granularities("day")), *names)
        .groupBy("url", "granularity", "bucket")
        .agg(*merged)
    )
    return (
        bare.select("url", F.lit("h").alias("granularity"), F.col("hour").alias("bucket"), *names)
        .unionByName(
            daily.select("url", F.lit("d").alias("granularity"), F.col("day").alias("bucket"), *names)
        )
        .unionByName(longer)
    )


def uniques_view(page_views: DataFrame) -> DataFrame:
    """Approximate distinct visitors per ``(url, granularity, bucket)``."""
    hourly = hourly_rollup(
        page_views, construct_sketch(schema.person_key("person")).alias("sketch")
    )
    rows = _roll_up(hourly, sketch=F.hll_union_agg("sketch"))
    return rows.select(
        "url", "granularity", "bucket", F.hll_sketch_estimate("sketch").alias("value")
    )


def traffic_view(page_views: DataFrame) -> DataFrame:
    """Views and visitors together: one scan and one shuffle serve both views."""
    hourly = hourly_rollup(
        page_views,
        F.count(F.lit(1)).alias("views"),
        construct_sketch(schema.person_key("person")).alias("sketch"),
    )
    rows = _roll_up(hourly, views=F.sum("views"), sketch=F.hll_union_agg("sketch"))
    return rows.select(
        "url", "granularity", "bucket", "views", F.hll_sketch_estimate("sketch").alias("visitors")
    )


def domain_views(page_views: DataFrame) -> DataFrame:
    """``(domain, person, ts)``; views with a malformed URL are dropped."""
    rows = extract_page_view_fields(page_views).where(urls.has_domain("url"))
    return rows.select(urls.extract_domain("url").alias("domain"), "person", "ts")


def analyze_visits(views: DataFrame, keys=("domain", "person"), legacy: bool = False) -> DataFrame:
    """``visits`` and ``bounces`` per group of ``keys``, from a column ``ts``.

    A visit ends with a silence of more than 900 s; a bounce is a visit with one
    view. No task ever holds all rows of a group, however busy its visitor is: two
    views in the same 900 s are always one visit, so views are first counted per
    900 s, which combines on the map side; then the counts of a group, at most 96 a
    day, are joined into visits by one window.

    ``legacy`` counts every view as a visit and as a bounce.
    """
    keys = list(keys)
    if legacy:
        return views.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("visits"), F.count(F.lit(1)).alias("bounces")
        )
    stretch = F.floor(F.col("ts") / F.lit(VISIT_GAP_SECONDS))
    stretches = views.groupBy(*keys, stretch.alias("_stretch")).agg(
        F.min("ts").alias("_from"), F.max("ts").alias("_to"), F.count(F.lit(1)).alias("_n")
    )

    in_group = Window.partitionBy(*keys).orderBy("_from")
    apart = F.col("_from").cast("long") - F.lag("_to").over(in_group) > VISIT_GAP_SECONDS
    return (
        stretches.withColumn("_opens", F.coalesce(apart, F.lit(False)).cast("int"))
        .withColumn("_visit", F.sum("_opens").over(in_group))
        .groupBy(*keys, "_visit")
        .agg(F.sum("_n").alias("_n"))
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("visits"),
            F.count(F.when(F.col("_n") == 1, 1)).alias("bounces"),
        )
    )


def bounces_view(page_views: DataFrame, legacy: bool = False) -> DataFrame:
    """Visits and bounces per domain."""
    per_visitor = analyze_visits(domain_views(page_views), legacy=legacy)
    return per_visitor.groupBy("domain").agg(
        F.sum("visits").alias("visits"), F.sum("bounces").alias("bounces")
    )


def publishable_buckets(view: DataFrame, value: str = "value") -> DataFrame:
    """Serving rows of a bucketed view, with its key."""
    return view.select(
        buckets.url_bucketed_key("url", "granularity", "bucket").alias("key"),
        F.col(value).alias("value"),
        "url",
        "granularity",
        "bucket",
    )


def publishable_bounces(view: DataFrame, legacy: bool = False) -> DataFrame:
    """Serving rows of the bounce view.

    ``legacy`` binds the counts by position to other names, ``bounces`` and
    ``total``, and gives the truncated quotient.
    """
    key = buckets.serialized_string("domain").alias("key")
    if legacy:
        return view.select(
            key,
            "domain",
            F.col("visits").alias("bounces"),
            F.col("bounces").alias("total"),
            buckets.bounce_rate("visits", "bounces", legacy=True).alias("rate"),
        )
    return view.select(
        key, "domain", "visits", "bounces", buckets.bounce_rate("bounces", "visits").alias("rate")
    )
