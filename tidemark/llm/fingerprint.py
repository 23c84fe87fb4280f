"""SimHash fingerprints of whole texts and the search for those within a radius.

Terms are pairs of neighbouring lower-cased words (the only word of a text with
one word), each weighted by how often it occurs. The 64 bits of a term's hash
vote for or against the bits of the fingerprint; a tie, also that of a text
without words, votes for 0. Equal texts have equal fingerprints.

Votes are added in lanes of 16 bits, four to a long, over at most 2^15 - 1 terms
at a time, so a text of any length is counted exactly. Only DataFrame functions
are used. A null text is empty. Repeated rows get rows of their own; an empty
table gives an empty result; other columns are left as they are.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import common

BITS, LANES = 64, 4
#: Terms whose votes fit into a lane.
LANE_TERMS = (1 << 15) - 1
#: Multiplier and mask that put 4 neighbouring bits into 4 lanes.
SPREAD = 1 + (1 << 15) + (1 << 30) + (1 << 45)
MASK = 1 + (1 << 16) + (1 << 32) + (1 << 48)


def fingerprints(texts: DataFrame, keys: tuple[str, ...], text: str = "text") -> DataFrame:
    """``keys`` and ``fingerprint`` (long) of each row. ``keys`` must tell the rows apart."""
    words = texts.select(
        *keys, F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[\x20\x09-\x0D]+").alias("_words")
    )
    pairs = F.greatest(F.size("_words") - 1, F.lit(1))
    zipped = F.arrays_zip(
        F.slice("_words", F.lit(1), pairs).alias("a"), F.slice("_words", F.lit(2), pairs).alias("b")
    )
    exploded = words.select(*keys, F.posexplode(zipped).alias("_at", "_pair"))
    voting = (F.col("_pair.a") != "") | F.col("_pair.b").isNotNull()
    hashed = exploded.select(
        *keys,
        F.expr(f"_at div {LANE_TERMS}").alias("_stretch"),
        F.when(voting, F.xxhash64("_pair.a", "_pair.b")).alias("_h"),
    )
    lanes = [
        F.sum((F.shiftright("_h", LANES * k).bitwiseAND(15) * SPREAD).bitwiseAND(MASK)).alias(f"_s{k}")
        for k in range(BITS // LANES)
    ]
    summed = hashed.groupBy(*keys, "_stretch").agg(F.count("_h").alias("_n"), *lanes)
    lane = [(k, j) for k in range(BITS // LANES) for j in range(LANES)]
    votes = [
        F.sum(F.shiftrightunsigned(f"_s{k}", 16 * j).bitwiseAND(0xFFFF)).alias(f"_v{LANES * k + j}")
        for k, j in lane
    ]
    whole = summed.groupBy(*keys).agg(F.sum("_n").alias("_n"), *votes)
    bits = [
        F.when(F.coalesce(F.col(f"_v{b}"), F.lit(0)) * 2 > F.col("_n"), F.lit(1 << b if b < 63 else -(1 << 63))).otherwise(0)
        for b in range(BITS)
    ]
    fingerprint = bits[0]
    for bit in bits[1:]:
        fingerprint = fingerprint.bitwiseOR(bit)
    return whole.select(*keys, fingerprint.cast("long").alias("fingerprint"))


def likeness(one: Column, other: Column) -> Column:
    """Share of equal bits."""
    return 1 - F.bit_count(one.bitwiseXOR(other)) / F.lit(float(BITS))


def as_text(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def block_masks(radius: int) -> list[int]:
    """Masks of the permuted tables: two of ``radius + 2`` blocks each.

    Fingerprints that differ in at most ``radius`` bits agree on two whole blocks
    or more, so they meet in at least one table.
    """
    edges = [BITS * k // (radius + 2) for k in range(radius + 3)]
    blocks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    masks = [one | other for one, other in combinations(blocks, 2)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def within(queries: DataFrame, fingerprints: DataFrame, radius: int = 3) -> DataFrame:
    """``(fingerprint, near, copies)``: all fingerprints within ``radius`` bits of each query's.

    Equal fingerprints count as one with a number of ``copies``, so copies are
    never paired. A pair comes from the first table in which it meets. Nulls take
    no part.
    """
    masks = block_masks(radius)
    whole = fingerprints.where("fingerprint is not null").groupBy("fingerprint").agg(F.count("*").alias("copies"))
    asked = queries.where("fingerprint is not null").select("fingerprint").distinct()

    def tabled(df: DataFrame, name: str, *more: str) -> DataFrame:
        keys = F.array(*(F.col("fingerprint").bitwiseAND(F.lit(m)) for m in masks))
        return df.select(F.col("fingerprint").alias(name), *more, F.posexplode(keys).alias("_table", "_key"))

    differ = F.col("fingerprint").bitwiseXOR(F.col("near"))
    first = F.lit(None)
    for number, mask in reversed(list(enumerate(masks))):
        first = F.when(differ.bitwiseAND(F.lit(mask)) == 0, F.lit(number)).otherwise(first)
    one, other = tabled(asked, "fingerprint"), tabled(whole, "near", "copies")
    met = one.join(other, ["_table", "_key"]).where((F.bit_count(differ) <= radius) & (first == F.col("_table")))
    return met.select("fingerprint", "near", "copies")


def successive(documents: DataFrame) -> DataFrame:
    """``(place, doc_id, text, next_text, total)``: documents in ascending order with the next text.

    The documents are dealt into ranges of ids; each range also gets the first row
    of the next one. Rows with one id are ordered by text, a null id comes first,
    and the last document is followed by the first.
    """
    shards = common.parts(documents.sparkSession)
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    bounds = rows.approxQuantile("doc_id", [k / shards for k in range(1, shards)], 1 / (4 * shards))
    shard = F.lit(0)
    if bounds:
        edges = F.array(*(F.lit(int(b)).cast("long") for b in sorted(set(bounds))))
        shard = F.size(F.filter(edges, lambda b: b <= F.coalesce("doc_id", F.lit(-(1 << 63)))))
    rows = rows.withColumn("_shard", shard)
    held = {r["_shard"]: r["count"] for r in rows.groupBy("_shard").count().collect()}  # one a range
    used = sorted(held)
    ahead, follow, total = {}, {}, 0
    for k, number in enumerate(used):
        ahead[number], total = total, total + held[number]
        follow[number] = used[k - 1]

    def mapped(names: dict[int, int]) -> Column:
        pairs = [F.lit(x) for pair in names.items() for x in pair]
        return F.element_at(F.create_map(*pairs), F.col("_shard")) if pairs else F.lit(0)

    heads = rows.groupBy("_shard").agg(F.min(F.struct("doc_id", "text")).alias("h"))
    heads = heads.select("h.doc_id", "h.text", mapped(follow).alias("_shard"), F.lit(True).alias("_head"))
    order = Window.partitionBy("_shard").orderBy("_head", F.asc_nulls_first("doc_id"), "text")
    return (
        rows.withColumn("_head", F.lit(False))
        .unionByName(heads)
        .withColumns({"place": F.row_number().over(order) - 1 + mapped(ahead), "next_text": F.lead("text").over(order)})
        .where(~F.col("_head"))
        .select(F.col("place").cast("long").alias("place"), "doc_id", "text", "next_text", F.lit(total).alias("total"))
    )


def edited_fingerprints(documents: DataFrame, radius: int = 3, every: int = 20) -> DataFrame:
    """Fingerprint of each text and of its edited text, and how alike they are.

    The edited text has its last quarter replaced by the beginning of the next
    document. ``n_near`` is, for documents whose id is divisible by ``every``, the
    number of other documents within ``radius`` bits, else null.
    """
    room = common.scratch(documents.sparkSession, "fingerprints")
    rows = successive(documents)
    rows = rows.withColumn("n_chars", F.length("text").cast("long"))
    cut = F.expr("cast(n_chars div 4 as int)")
    edited = F.concat(
        F.substring("text", F.lit(1), F.col("n_chars").cast("int") - cut), F.substring("next_text", F.lit(1), cut)
    )
    rows = rows.withColumn("edited", edited)
    both = rows.select("place", F.posexplode(F.array("text", "edited")).alias("_which", "text"))
    found = fingerprints(both, ("place", "_which"))
    found = found.groupBy("place").agg(
        F.max(F.when(F.col("_which") == 0, F.col("fingerprint"))).alias("own"),
        F.max(F.when(F.col("_which") == 1, F.col("fingerprint"))).alias("changed"),
    )
    facts = rows.select("place", "doc_id", "n_chars", "total", F.sha2("edited", 256).alias("edited_sha256"))
    held = room.save(facts.join(found, "place"), "fingerprints")
    queries = held.where(F.col("doc_id") % every == 0).select(F.col("own").alias("fingerprint"))
    near = within(queries, held.select(F.col("own").alias("fingerprint")), radius)
    near = near.groupBy(F.col("fingerprint").alias("own")).agg((F.sum("copies") - 1).alias("_near"))
    following = held.select(
        F.when(F.col("place") == 0, F.col("total") - 1).otherwise(F.col("place") - 1).alias("place"),
        F.col("own").alias("following"),
    )
    return (
        held.join(following, "place")
        .join(near, "own", "left")
        .select(
            "doc_id",
            "n_chars",
            "edited_sha256",
            as_text(F.col("own")).alias("fingerprint"),
            as_text(F.col("changed")).alias("edited_fingerprint"),
            likeness(F.col("own"), F.col("changed")).alias("near_edited"),
            likeness(F.col("own"), F.col("following")).alias("near_next"),
            F.when(F.col("doc_id") % every == 0, F.col("_near")).alias("n_near"),
        )
    )
