"""Visitor identity: connected components over the identity links.

Two ways to the same result, the smallest id of every component:

* ``identity_iteration`` is one round of the plain scheme: every node hands its
  smallest known id to all its neighbours.
* ``connected_components`` alternates large-star and small-star rounds (Kiveris
  et al., 2014), which needs a logarithmic number of rounds in practice.

The rounds work on numbers, not on id structs. No round builds an array per node:
minima are aggregates with a map-side part, and they meet the edges again in an inner join that adaptive execution can split
on a hub node. Every half round is written to the shared checkpoint folder.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schema
from tidemark.sources.scratch import Scratch


def edgify_equiv(equivs: DataFrame) -> DataFrame:
    """Identity-link facts as edges ``(node1, node2)``."""
    return equivs.select(F.col("id1").alias("node1"), F.col("id2").alias("node2"))


def bidirectional_edges(edges: DataFrame) -> DataFrame:
    """Both directions of every edge; self-loops are dropped.

    One pass over the input: each edge explodes into its two directions.
    """
    forth = F.struct(F.col("node1").alias("b1"), F.col("node2").alias("b2"))
    back = F.struct(F.col("node2").alias("b1"), F.col("node1").alias("b2"))
    return edges.where(~F.col("node1").eqNullSafe(F.col("node2"))).select(
        F.inline(F.array(forth, back))
    )


def iterate_edges(directed: DataFrame) -> DataFrame:
    """Per node, over itself and its neighbours: ``(node1, node2, is_new)`` from
    the smallest id to every other id.

    ``is_new`` marks rows that bring a link not known before: the set has more
    than two ids and the node is not itself the smallest.
    """
    pairs = directed.select("b1", "b2").distinct()
    nodes = (
        pairs.groupBy("b1")
        .agg(F.min("b2").alias("low"), F.count(F.lit(1)).alias("degree"))
        .select(
            "b1",
            F.least("b1", "low").alias("smallest"),
            ((F.col("degree") > 1) & (F.col("low") < F.col("b1"))).alias("is_new"),
        )
    )
    to_neighbours = (
        pairs.join(nodes, "b1")
        .where(F.col("b2") != F.col("smallest"))
        .select(F.col("smallest").alias("node1"), F.col("b2").alias("node2"), "is_new")
    )
    to_self = nodes.where(F.col("b1") != F.col("smallest")).select(
        F.col("smallest").alias("node1"), F.col("b1").alias("node2"), "is_new"
    )
    return to_neighbours.unionByName(to_self)


def identity_iteration(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One round: the next edge set, and the edges that show progress."""
    rows = iterate_edges(bidirectional_edges(edges))
    following = rows.select("node1", "node2").distinct()
    progress = rows.where("is_new").select("node1", "node2")
    return following, progress


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour."""
    directed = edges.select(
        F.inline(
            F.array(
                F.struct(F.col("high").alias("node"), F.col("low").alias("other")),
                F.struct(F.col("low").alias("node"), F.col("high").alias("other")),
            )
        )
    )
    lows = directed.groupBy("node").agg(F.min("other").alias("low"))
    return (
        directed.join(lows, "node")
        .where(F.col("other") > F.col("node"))
        .select(
            F.col("other").alias("high"),
            F.least("node", "low").alias("low"),
            (F.col("low") < F.col("node")).alias("moved"),
        )
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Link every smaller neighbour of a node, and the node, to the smallest."""
    lows = edges.groupBy("high").agg(F.min("low").alias("root"))
    return (
        edges.join(lows, "high")
        .select(
            F.inline(
                F.array(
                    F.struct(
                        F.col("high").alias("high"),
                        F.col("root").alias("low"),
                        F.lit(False).alias("moved"),
                    ),
                    F.struct(
                        F.col("low").alias("high"),
                        F.col("root").alias("low"),
                        (F.col("low") != F.col("root")).alias("moved"),
                    ),
                )
            )
        )
        .where(F.col("high") != F.col("low"))
    )


def _once(rows: DataFrame) -> DataFrame:
    """Each edge once, with a mark if any of its rows moved."""
    return rows.groupBy("high", "low").agg(F.bool_or("moved").alias("moved"))


def _as_numbers(links: DataFrame, cookies: bool, scratch: Scratch):
    """Links between numbers that order as the ids do, and the way back.

    Numbers sort, hash and shuffle far cheaper than id structs, which pays over
    the rounds. User ids are numbers already. With cookies among the ids, all ids
    are sorted once over the cluster, and their places are their numbers.
    """
    if not cookies:
        coded = links.select(F.col("high.user_id").alias("high"), F.col("low.user_id").alias("low"))
        return coded, lambda pairs: pairs.select(
            schema.user_person("high").alias("id"), schema.user_person("low").alias("root")
        )
    ids = links.select(F.explode(F.array("high", "low")).alias("person")).distinct()
    places = ids.repartitionByRange("person").sortWithinPartitions("person")
    book = scratch.save(
        places.select("person", F.monotonically_increasing_id().alias("number")), "numbers"
    )

    def looked_up(pairs: DataFrame, given: str, wanted: str, names: dict[str, str]) -> DataFrame:
        for old, new in names.items():
            page = book.select(F.col(given).alias(f"_{old}"), F.col(wanted).alias(f"_{new}_value"))
            kept = [c for c in pairs.columns if c != old]
            pairs = pairs.join(page, pairs[old] == page[f"_{old}"]).select(
                *kept, F.col(f"_{new}_value").alias(new)
            )
        return pairs

    coded = looked_up(links, "person", "number", {"high": "high", "low": "low"})
    return scratch.save(coded, "numbered"), lambda pairs: looked_up(
        pairs, "number", "person", {"high": "id", "low": "root"}
    )


def connected_components(edges: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """``(id, root)`` for every linked id that is not itself the root.

    ``root`` is the smallest id of the component. The rounds end when neither
    star operation moves an edge, which holds exactly for a set of stars around
    the smallest ids. Every round that moves an edge lowers the sum of the smaller
    ends, so the rounds end.
    """
    spark = edges.sparkSession
    scratch = scratch or Scratch(spark, "identity")
    links = (
        edges.where(F.col("node1") != F.col("node2"))
        .select(
            F.greatest("node1", "node2").alias("high"),
            F.least("node1", "node2").alias("low"),
        )
        .distinct()
    )
    has_cookie = (F.col("high.kind") == schema.COOKIE) | (F.col("low.kind") == schema.COOKIE)
    stored = scratch.save(links, "links")
    kinds = stored.agg(F.bool_or(has_cookie).alias("cookies")).first()
    if kinds["cookies"] is None:
        return stored.select(F.col("high").alias("id"), F.col("low").alias("root"))
    current, decode = _as_numbers(stored, kinds["cookies"], scratch)
    for turn in count():
        large = scratch.save(_once(_large_star(current)), f"large-{turn}")
        small = scratch.save(_once(_small_star(large)), f"small-{turn}")
        moved = any(half.agg(F.bool_or("moved")).first()[0] for half in (large, small))
        scratch.drop(large)
        scratch.drop(current)
        current = small
        if not moved:
            return decode(current.select("high", "low"))


def normalize_user_ids(page_views: DataFrame, roots: DataFrame) -> DataFrame:
    """Replace the person of every page view by the root of its component.

    ``roots`` has one row per id, so the left join adds no rows. A visitor with
    very many views sits on the left side, which adaptive execution splits.
    """
    linked = roots.select(F.col("id").alias("_linked"), F.col("root").alias("_root"))
    columns = [
        F.coalesce("_root", "person").alias("person") if name == "person" else F.col(name)
        for name in page_views.columns
    ]
    return page_views.join(linked, page_views["person"] == linked["_linked"], "left").select(*columns)


def resolve_identities(
    page_views: DataFrame, equivs: DataFrame, scratch: Scratch | None = None
) -> DataFrame:
    """Components of ``equivs`` applied to ``page_views``."""
    return normalize_user_ids(page_views, connected_components(edgify_equiv(equivs), scratch))


__all__ = [
    "bidirectional_edges",
    "connected_components",
    "edgify_equiv",
    "identity_iteration",
    "iterate_edges",
    "normalize_user_ids",
    "resolve_identities",
]
