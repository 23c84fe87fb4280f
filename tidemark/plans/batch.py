"""The whole batch: new facts in, three served views out."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidemark import schema
from tidemark.plans import identity, views
from tidemark.sources import facts
from tidemark.sources.scratch import Scratch
from tidemark.sources.serving import BOUNCE_VIEW, PAGE_VIEW_VIEW, UNIQUE_VIEW, BatchViews, SpeedViews


@dataclass(frozen=True)
class Places:
    """Where a batch reads and writes."""

    new_data: str
    master: str
    batch_views: str
    speed_views: str

    @staticmethod
    def below(root: str) -> Places:
        root = root.rstrip("/")
        return Places(f"{root}/new", f"{root}/master", f"{root}/views", f"{root}/speed")


def resolved_page_views(master: DataFrame, scratch: Scratch) -> DataFrame:
    """Page views with clean URLs and resolved visitors, without repeats.

    Stored once, since all three views read them.
    """
    clean = views.normalize_urls(schema.arm(master, schema.PAGE_VIEW))
    resolved = identity.resolve_identities(clean, schema.arm(master, schema.EQUIV), scratch)
    return scratch.save(views.deduplicate_page_views(resolved), "page-views")


def compute_views(page_views: DataFrame, scratch: Scratch, legacy: bool = False) -> dict[str, DataFrame]:
    """The serving rows of every view.

    The two bucketed views come from one pass; their common rollup is stored and
    read twice, a column each.
    """
    traffic = scratch.save(views.traffic_view(page_views), "traffic")
    return {
        PAGE_VIEW_VIEW: views.publishable_buckets(traffic, "views"),
        UNIQUE_VIEW: views.publishable_buckets(traffic, "visitors"),
        BOUNCE_VIEW: views.publishable_bounces(views.bounces_view(page_views, legacy), legacy),
    }


def run(
    spark: SparkSession, places: Places, legacy: bool = False, wait_seconds: float = 0
) -> BatchViews:
    """One batch. Everything is recomputed from the master table, so a batch that
    fails can simply run again."""
    master = facts.open_master(spark, places.master)
    facts.ingest(master, facts.open_new_data(spark, places.new_data))

    scratch = Scratch(spark, "batch")
    served = BatchViews(spark, places.batch_views)
    try:
        page_views = resolved_page_views(master.read(), scratch)
        for name, rows in compute_views(page_views, scratch, legacy).items():
            served.publish(name, rows)
    finally:
        scratch.close()

    time.sleep(wait_seconds)
    served.replace()
    SpeedViews(spark, places.speed_views).update()
    return served
