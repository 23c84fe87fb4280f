"""Near-duplicate documents by a MinHash LSH forest.

A document's set holds its distinct five-word shingles. Every tree of the forest
is a sorted order of all sets by their signature in that tree. Sets that share a
prefix form a region. First, each set is compared with its neighbours in every
order, those with the longest common prefix: in a small region these are all its
members, in a crowded one the search goes as deep as the sets agree. What the
neighbours leave open is settled exactly: where a region's members are not yet in one
component, the members outside its main component are compared with each other and
with all of that component, in blocks. No region is gathered in a task, and links
inside a component that is known already are not looked for again.

Neighbours are sieved by 128 one-bit signatures (at similarity 0.75 a pair is lost with
a chance of about 5e-6), then confirmed on the full sets. With 20 trees and a base
depth of 3, a pair of similarity 0.75 meets in no tree with a chance of 2e-5.

A null or empty text has an empty set and is linked with nothing. A row without an id
has no component, is kept, and is linked with nothing. Repeated rows are copies of one
document. Copies are represented by the smallest id among them, and
only such representatives are compared. An empty table gives an empty result; other
columns are not looked at.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schema
from tidemark.llm import common
from tidemark.plans.identity import connected_components

#: Words of a shingle, trees, values of a tree's signature and of its base prefix.
WORDS, TREES, DEPTH, BASE = 5, 20, 6, 3
#: Bits of each value; a prefix of three fits into a long.
VALUE_BITS = 21
#: Neighbours in an order on one side.
REACH = 2
#: One-bit signatures in which a pair may differ.
SIEVE = 34
#: Sets of a block's side when components are settled, and shingles multiplied at a time.
CHUNK, SLICE = 512, 8192
#: Words whose hash a worker remembers.
REMEMBERED = 300_000


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) > REMEMBERED:
            self.clear()
        self[word] = value
        return value


@functools.lru_cache(maxsize=1)
def _seeds() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20_240_607)
    shingle = rng.integers(1, 1 << 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    times = rng.integers(1, 1 << 63, TREES * DEPTH + 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    plus = rng.integers(1, 1 << 63, TREES * DEPTH + 8, dtype=np.uint64)
    return shingle, times, plus


_KNOWN = _Words()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    hashes = np.fromiter(map(_KNOWN.__getitem__, words), dtype=np.uint64, count=len(words))
    times = _seeds()[0]
    width = min(WORDS, len(words))
    total = np.full(len(words) - width + 1, len(words) if width < WORDS else 0, dtype=np.uint64)
    for k in range(width):
        total = _mixed(total + hashes[k : len(words) - width + 1 + k] * times[k])
    return np.unique(total)


def _signature(values: np.ndarray) -> np.ndarray:
    """Least hash of the set under each function."""
    _, times, plus = _seeds()
    least = None
    for first in range(0, len(values), 256):
        x = np.multiply.outer(times, values[first : first + 256])
        x += plus[:, None]
        x ^= x >> np.uint64(32)
        own = x.min(axis=1)
        least = own if least is None else np.minimum(least, own)
    return least


def _as_long(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


SETS = "doc_id long, n_shingles long, key1 long, key2 long, bits1 long, bits2 long, high array<long>, low array<long>"
SETS_ARROW = pa.schema(
    [(n, pa.int64()) for n in ("doc_id", "n_shingles", "key1", "key2", "bits1", "bits2")]
    + [("high", pa.list_(pa.int64())), ("low", pa.list_(pa.int64()))]
)


def signatures(documents: DataFrame) -> DataFrame:
    """Set size, digest, sieve bits, and base and deeper prefix in each tree."""

    def work(batches):
        out = []
        shift = np.uint64(64 - VALUE_BITS)
        places = np.array([1 << (VALUE_BITS * (BASE - 1 - k)) for k in range(BASE)], dtype=np.uint64)
        for key, text in common.rows(batches, "doc_id", "text"):
            values = shingles(text)
            if not len(values):
                out.append((key, 0, None, None, None, None, None, None))
            else:
                digest = np.frombuffer(hashlib.blake2b(values.tobytes(), digest_size=16).digest(), "<i8")
                least = _signature(values)
                bits = np.packbits((least[:128] & np.uint64(1)).astype(np.uint8)).view("<i8")
                # The least of many hashes begins with zeros; mixing spreads it over all bits.
                trees = (_mixed(least[: TREES * DEPTH]) >> shift).reshape(TREES, 2, BASE)
                prefix = _as_long((trees * places).sum(axis=2, dtype=np.uint64))
                out.append((key, len(values), *digest.tolist(), *bits.tolist(), prefix[:, 0], prefix[:, 1]))
            if len(out) >= 2048:
                yield common.batch_of(SETS_ARROW, list(zip(*out)))
                out = []
        if out:
            yield common.batch_of(SETS_ARROW, list(zip(*out)))

    return documents.select("doc_id", "text").mapInArrow(work, SETS)


PAIRS_ARROW = pa.schema([(n, pa.int64()) for n in ("a", "b", "apart")])


def _neighbours(forest: DataFrame) -> DataFrame:
    """Pairs of sets near each other in the order of a tree, with the same base prefix."""
    ordered = forest.repartitionByRange("tree", "high", "low", "id").sortWithinPartitions("tree", "high", "low", "id")

    def work(batches):
        tail = None
        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in ("tree", "high", "id", "bits1", "bits2")]
            if tail is not None:
                columns = [np.concatenate([t, c]) for t, c in zip(tail, columns)]
            tree, high, key, one, two = columns
            tail = [c[-REACH:] for c in columns]
            for step in range(1, REACH + 1):
                if len(key) <= step:
                    break
                apart = np.bitwise_count(one[step:] ^ one[:-step]) + np.bitwise_count(two[step:] ^ two[:-step])
                same = (tree[step:] == tree[:-step]) & (high[step:] == high[:-step]) & (apart <= SIEVE)
                a, b = key[:-step][same], key[step:][same]
                yield common.batch_of(PAIRS_ARROW, [np.minimum(a, b), np.maximum(a, b), apart[same].astype(np.int64)])

    return ordered.mapInArrow(work, "a long, b long, apart long").where("a <> b").distinct()


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs with 100 * intersection >= 75 * union, on the full sets."""
    one = sets.select(F.col("doc_id").alias("a"), F.col("set").alias("set_a"))
    other = sets.select(F.col("doc_id").alias("b"), F.col("set").alias("set_b"))
    schema_out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def work(batches):
        for batch in batches:
            kept = []
            for a, b, x, y in common.rows([batch], "a", "b", "set_a", "set_b"):
                x, y = np.frombuffer(x, dtype="<u8"), np.frombuffer(y, dtype="<u8")
                if min(len(x), len(y)) * 100 < 75 * max(len(x), len(y)):
                    continue
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= 75 * (len(x) + len(y) - both):
                    kept.append((a, b))
            yield common.batch_of(schema_out, list(zip(*kept)) if kept else [[], []])

    return pairs.join(one, "a").join(other, "b").select("a", "b", "set_a", "set_b").mapInArrow(work, "a long, b long")


def _full_sets(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    schema_out = pa.schema([("doc_id", pa.int64()), ("set", pa.binary())])

    def work(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                piece = batch.slice(start, 256)
                made = [shingles(t).astype("<u8").tobytes() for t in piece.column("text").to_pylist()]
                yield common.batch_of(schema_out, [piece.column("doc_id"), made])

    chosen = documents.select("doc_id", "text").join(wanted, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return chosen.mapInArrow(work, "doc_id long, set binary")


def _components(links: DataFrame, room) -> DataFrame:
    """``(id, root)`` of every linked id that is not the smallest of its component."""
    edges = links.select(schema.user_person("a").alias("node1"), schema.user_person("b").alias("node2"))
    found = connected_components(edges, room)
    return found.select(F.col("id.user_id").alias("id"), F.col("root.user_id").alias("root"))


def _block_links(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Which sets of ``left`` and ``right`` have 100 * intersection >= 75 * union, as a matrix."""
    values = np.unique(np.concatenate(left))
    shared = np.intersect1d(values, np.unique(np.concatenate(right)), assume_unique=True)
    both = np.zeros((len(left), len(right)), dtype=np.float32)
    sides = []
    for sets in (left, right):
        owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        every = np.concatenate(sets)
        at = np.searchsorted(shared, every)
        at[at == len(shared)] = 0
        hit = shared[at] == every if len(shared) else np.zeros(len(every), dtype=bool)
        order = np.argsort(at[hit], kind="stable")
        sides.append((owner[hit][order], at[hit][order]))
    for first in range(0, len(shared), SLICE):
        grids = []
        for (owner, at), count in zip(sides, both.shape, strict=True):
            a, b = np.searchsorted(at, [first, first + SLICE])
            grid = np.zeros((count, SLICE), dtype=np.float32)
            grid[owner[a:b], at[a:b] - first] = 1
            grids.append(grid)
        both += grids[0] @ grids[1].T
    sizes = np.array([len(x) for x in left])[:, None] + np.array([len(x) for x in right])[None, :]
    return 100 * both >= 75 * (sizes - both)


def _settled(forest: DataFrame, roots: DataFrame, sets: DataFrame, room) -> DataFrame:
    """Links ``(a, b)`` between different components that share a base prefix.

    In each region with several components, the sets outside the largest one are
    attached to it. All that is attached to a component is compared with each other
    and with the whole component, in blocks of ``CHUNK`` sets by ``CHUNK`` that are
    dealt over the cluster. One link per set and component it meets is enough.
    """
    known = forest.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    region = ["tree", "high"]
    sized = known.groupBy(*region, "root").agg(F.count("*").alias("n"))
    main = sized.groupBy(*region).agg(
        F.max_by("root", F.struct("n", "root")).alias("main"), F.count("*").alias("roots")
    ).where("roots > 1")
    outside = known.join(main, region).where("root <> main").select("main", "id", "root").distinct()
    outside = room.save(outside, "outside")
    mains = outside.select("main").distinct()
    ids = known.select("id", "root").distinct()
    inside = ids.join(mains, ids["root"] == mains["main"]).select("main", "id", "root")
    left_sizes = outside.groupBy("main").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("lefts"))
    right = room.save(outside.unionByName(inside), "right")
    right_sizes = right.groupBy("main").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("rights"))
    sizes = left_sizes.join(right_sizes, "main")
    several = F.col("lefts") * F.col("rights") > 1
    buckets = 4 * common.parts(forest.sparkSession)
    key = F.when(several, F.xxhash64("main", "l", "r")).otherwise(F.pmod(F.xxhash64("main"), F.lit(buckets)))

    def dealt(rows: DataFrame, own: str, other: str, mine: str, theirs: str) -> DataFrame:
        placed = rows.join(sizes, "main").withColumns(
            {mine: F.pmod(F.xxhash64("id"), F.col(own)).cast("int"), theirs: F.explode(F.sequence(F.lit(0), F.col(other) - 1))}
        )
        placed = placed.select(key.alias("key"), "main", "l", "r", "id", "root")
        full = placed.join(sets.select(F.col("doc_id").alias("id"), "set"), "id")
        return full.select(*(F.col(c).alias(c) for c in ("key", "main", "l", "r", "id", "root", "set"))).groupBy("key")

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple[int, int]] = []
        groups: dict[tuple, tuple[list, list]] = {}
        for side, table in enumerate((left, right)):
            for row in zip(*(table.column(c).to_pylist() for c in ("main", "l", "r", "id", "root", "set"))):
                groups.setdefault(row[:3], ([], []))[side].append(row[3:])
        for one, other in groups.values():
            if one and other:
                linked = _block_links(*([np.frombuffer(x[2], dtype="<u8") for x in side] for side in (one, other)))
                for k, (a, root, _) in enumerate(one):
                    met = {other[j][1]: other[j][0] for j in np.flatnonzero(linked[k]) if other[j][1] != root}
                    found += [(a, b) for b in met.values()]
        columns = list(zip(*found)) if found else [[], []]
        return pa.table({"a": pa.array(columns[0], pa.int64()), "b": pa.array(columns[1], pa.int64())})

    pairs = dealt(outside, "lefts", "rights", "l", "r").cogroup(dealt(right, "rights", "lefts", "r", "l"))
    return pairs.applyInArrow(work, "a long, b long")


def near_duplicates(documents: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``: one row per row of ``documents``."""
    spark = documents.sparkSession
    room = common.scratch(spark, "near-duplicates")
    sets = room.save(signatures(documents), "signatures")
    copies = sets.where("n_shingles > 0 and doc_id is not null").groupBy("key1", "key2").agg(
        F.min("doc_id").alias("id"), F.first(F.struct("bits1", "bits2", "high", "low")).alias("s")
    )
    trees = F.posexplode(F.arrays_zip("s.high", "s.low")).alias("tree", "at")
    rows = copies.select("id", "s.bits1", "s.bits2", trees).select(
        "tree", F.col("at.high").alias("high"), F.col("at.low").alias("low"), "id", "bits1", "bits2"
    )
    shared = rows.groupBy("tree", "high").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    forest = room.save(rows.join(shared, ["tree", "high"], "left_semi"), "forest")
    wanted = forest.select(F.col("id").alias("doc_id")).distinct()
    full = room.save(_full_sets(documents, wanted), "sets")
    near = room.save(_neighbours(forest), "neighbours")
    links = room.save(_confirmed(near.select("a", "b"), full), "links")
    roots = room.save(_components(links, room), "roots")
    more = room.save(_settled(forest, roots, full, room), "more-links")
    if more.limit(1).count():
        roots = room.save(_components(links.unionByName(more), room), "all-roots")
    leaders = copies.select("key1", "key2", "id").join(roots, "id", "left")
    leaders = leaders.select("key1", "key2", F.coalesce("root", "id").alias("root"))
    joined = sets.select("doc_id", "n_shingles", "key1", "key2").join(leaders, ["key1", "key2"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id"))
    kept = F.col("doc_id").isNull() | (F.col("doc_id") == component)
    return joined.select("doc_id", "n_shingles", component.alias("component_id"), kept.alias("kept"))


def deduplicate(documents: DataFrame) -> DataFrame:
    """The rows of ``documents`` whose id is the smallest of its component; of one id one row.

    Rows without an id stay as they are.
    """
    kept = near_duplicates(documents).where("kept and doc_id is not null").select("doc_id")
    chosen = documents.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return chosen.unionByName(documents.where("doc_id is null"))
