"""Values worked out by hand from the seed facts."""

from tidemark import schema
from tidemark.plans import batch, identity, views
from tidemark.sources import facts
from tidemark.sources.scratch import Scratch, shared_folder
from tidemark.sources.serving import BOUNCE_VIEW, PAGE_VIEW_VIEW, UNIQUE_VIEW

PAGE_VIEWS = {
    ("shop.example/cart", "h", 0): 3, ("shop.example/cart", "d", 0): 3,
    ("shop.example/cart", "w", 0): 3, ("shop.example/cart", "m", 0): 3,
    ("shop.example/list", "h", 0): 2, ("shop.example/list", "h", 694): 1,
    ("shop.example/list", "d", 0): 2, ("shop.example/list", "d", 28): 1,
    ("shop.example/list", "w", 0): 2, ("shop.example/list", "w", 4): 1,
    ("shop.example/list", "m", 0): 2, ("shop.example/list", "m", 1): 1,
    ("news.example/today", "h", 0): 1, ("news.example/today", "h", 1): 1,
    ("news.example/today", "h", 25): 1, ("news.example/today", "h", 194): 1,
    ("news.example/today", "d", 0): 2, ("news.example/today", "d", 1): 1, ("news.example/today", "d", 8): 1,
    ("news.example/today", "w", 0): 3, ("news.example/today", "w", 1): 1,
    ("news.example/today", "m", 0): 4,
}
# Users 10 and 4 are one visitor, and so are 12 and 8.
VISITORS = PAGE_VIEWS | {
    ("shop.example/cart", "h", 0): 2, ("shop.example/cart", "d", 0): 2,
    ("shop.example/cart", "w", 0): 2, ("shop.example/cart", "m", 0): 2,
    ("shop.example/list", "h", 0): 1, ("shop.example/list", "d", 0): 1,
    ("shop.example/list", "w", 0): 1, ("shop.example/list", "m", 0): 1,
    ("news.example/today", "w", 0): 2, ("news.example/today", "m", 0): 2,
}


def bucketed(df):
    return {
        (r["url"].removeprefix("http://"), r["granularity"], r["bucket"]): r["value"] for r in df.collect()
    }


def resolved(seed_views, seed_equivs):
    return views.deduplicate_page_views(identity.resolve_identities(seed_views, seed_equivs))


def test_roots(seed_equivs):
    found = identity.connected_components(identity.edgify_equiv(seed_equivs))
    assert {(r["id"]["user_id"], r["root"]["user_id"]) for r in found.collect()} == {(10, 4), (12, 8)}


def test_views(seed_views, seed_equivs):
    page_views = resolved(seed_views, seed_equivs)
    assert bucketed(views.page_view_batch_view(page_views)) == PAGE_VIEWS
    assert bucketed(views.uniques_view(page_views)) == VISITORS
    traffic = views.traffic_view(page_views)
    assert bucketed(traffic.withColumnRenamed("views", "value")) == PAGE_VIEWS
    assert bucketed(traffic.withColumnRenamed("visitors", "value")) == VISITORS


def test_bounces(seed_views, seed_equivs):
    page_views = resolved(seed_views, seed_equivs)
    served = views.publishable_bounces(views.bounces_view(page_views)).collect()
    assert sorted(tuple(r) for r in served) == [
        ("news.example", "news.example", 4, 4, 1.0),
        ("shop.example", "shop.example", 4, 3, 0.75),
    ]
    per_user = views.analyze_visits(views.domain_views(page_views)).collect()
    assert {(r["domain"][:4], r["person"]["user_id"]): (r["visits"], r["bounces"]) for r in per_user} == {
        ("shop", 4): (2, 1), ("shop", 8): (1, 1), ("shop", 2): (1, 1), ("news", 7): (2, 2), ("news", 8): (2, 2)
    }


def test_bounces_legacy(seed_views, seed_equivs):
    page_views = resolved(seed_views, seed_equivs)
    rows = views.publishable_bounces(views.bounces_view(page_views, legacy=True), legacy=True)
    assert rows.columns == ["key", "domain", "bounces", "total", "rate"]
    assert sorted(tuple(r) for r in rows.collect()) == [
        ("news.example", "news.example", 4, 4, 1),
        ("shop.example", "shop.example", 6, 6, 1),
    ]


def fill(spark, places, seed_views, seed_equivs):
    new_data = facts.open_new_data(spark, places.new_data)
    facts.append_facts(new_data, seed_views, schema.PAGE_VIEW)
    facts.append_facts(new_data, seed_equivs, schema.EQUIV)


def test_batch(spark, folder, seed_views, seed_equivs):
    places = batch.Places.below(folder)
    fill(spark, places, seed_views, seed_equivs)
    served = batch.run(spark, places)
    page_views = served.read(PAGE_VIEW_VIEW)
    assert page_views.columns == schema.BUCKETED_VIEW_COLUMNS
    assert bucketed(page_views) == PAGE_VIEWS
    assert bucketed(served.read(UNIQUE_VIEW)) == VISITORS
    assert {r["key"] for r in page_views.collect()} >= {"http://shop.example/cart/h-0", "http://news.example/today/m-0"}
    assert served.read(BOUNCE_VIEW).columns == schema.BOUNCE_VIEW_COLUMNS
    served.register()
    assert spark.sql("SELECT visits FROM bounce_view").first()["visits"] == 4

    # The new data is gone into the master table, by kind.
    assert facts.open_new_data(spark, places.new_data).is_empty()
    master = facts.open_master(spark, places.master)
    assert facts.read_arm(master, schema.PAGE_VIEW).count() == 11
    assert facts.read_arm(master, schema.EQUIV).columns == schema.EQUIVS.names


def test_batch_in_steps_equals_batch_at_once(spark, folder, seed_views, seed_equivs, rows_of):
    whole = batch.Places.below(f"{folder}/whole")
    fill(spark, whole, seed_views, seed_equivs)
    steps = batch.Places.below(f"{folder}/steps")
    new_data = facts.open_new_data(spark, steps.new_data)
    facts.append_facts(new_data, seed_views.where("ts < 4000"), schema.PAGE_VIEW)
    first = batch.run(spark, steps).live_version(PAGE_VIEW_VIEW)
    # Late links and views, and repeats of known views.
    facts.append_facts(new_data, seed_views, schema.PAGE_VIEW)
    facts.append_facts(new_data, seed_equivs, schema.EQUIV)
    in_steps, at_once = batch.run(spark, steps), batch.run(spark, whole)
    assert in_steps.live_version(PAGE_VIEW_VIEW) > first
    for view in (PAGE_VIEW_VIEW, UNIQUE_VIEW, BOUNCE_VIEW):
        assert rows_of(in_steps.read(view)) == rows_of(at_once.read(view))


def test_scratch_is_in_the_shared_folder(spark):
    scratch = Scratch(spark, "where")
    saved = scratch.save(spark.range(3), "numbers")
    assert scratch.root.startswith(shared_folder(spark))
    given = spark.conf.get("spark.checkpoint.dir", None)
    assert given is None or scratch.root.startswith(given)
    assert saved.count() == 3
    scratch.close()
