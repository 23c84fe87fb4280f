"""Ranked lexical search in which documents that look alike to the items are scored once.

A term is a run of ASCII letters, digits and code points from 128 on; only A-Z are
lower-cased. Each document is restricted to the vocabulary of the items: what is left of
it is a bag (term numbers and their counts) and its length norm ``m``. Documents with
the same bag and the same ``m`` get the same score for every item, so they form a class:
rows are dealt by a hash of both, and compared in full before they share a class. A class is
scored once against all items in 64-bit integers, and its members, by ascending id,
take that score.

Statistics (documents with a term, terms, document frequencies) cover all documents.
Items are worked on in blocks of about ``BLOCK`` bytes of text, dealt by hash, so that what a
task is sent (vocabulary and items of one block) has a bounded size; the documents are
read once per block. A class keeps as many members as one result can hold; the
least ids are found with a map-side part, so a class may hold any share of all rows.

Null and empty texts have no terms: such documents are in no result, and such items have
none. Repeated rows of a document are documents of their own. Rows of one item id are one
item, whose text is the least of theirs. Documents without an id come last among equal
scores; a null item id is an id. Very long texts are worked on whole, one in a task's
memory at a time. Empty tables give an empty result; other columns are not looked at.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import common

#: Bytes of item text that a block holds, about.
BLOCK = 4 << 20
#: Cells of the table of contributions that a scoring step fills.
CELLS = 2 << 20
#: Parts that the rows of one item are ranked in before they meet.
SPREAD = 32

_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
RESULT = "item_id long, rank int, doc_id long, score long"


def terms_of(text: bytes | None) -> list[bytes]:
    """Terms of a UTF-8 text in their order."""
    return text.translate(_TERM_BYTES).split() if text else []


def bags(documents: DataFrame, vocabulary: dict[bytes, int], key: str, column: str) -> DataFrame:
    """``(doc_id, n, terms, counts)``: number of all terms, and the bag within the vocabulary."""
    rows = documents.select(F.col(key).cast("long").alias("doc_id"), F.col(column).cast("string").alias("text"))
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64()))]
    )

    def restricted(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                piece = batch.slice(start, 1024)
                lengths, terms, counts, ends = [], [], [], [0]
                for text in piece.column("text").cast(pa.binary()):
                    words = terms_of(text.as_py())
                    found = Counter(filter(vocabulary.__contains__, words))
                    own = sorted((vocabulary[t], c) for t, c in found.items())
                    lengths.append(len(words))
                    terms += [t for t, _ in own]
                    counts += [c for _, c in own]
                    ends.append(len(terms))
                offsets = pa.array(ends, pa.int32())
                lists = [
                    pa.ListArray.from_arrays(offsets, pa.array(v, t))
                    for v, t in ((terms, pa.int32()), (counts, pa.int64()))
                ]
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(lengths, pa.int64()), *lists], schema=schema)

    return rows.mapInArrow(restricted, "doc_id long, n long, terms array<int>, counts array<long>")


def classes(bagged: DataFrame, documents: int, terms: int, k: int) -> DataFrame:
    """``(m, terms, counts, members)`` of each class; ``members`` are its ``k`` least rows."""
    norm = F.lit(100 - 25).cast("long") + F.expr(f"(25L * n * {documents}L) div {terms}L")
    rows = bagged.where(F.size("terms") > 0).select("doc_id", norm.alias("m"), "terms", "counts")
    same = ["digest", "m", "terms", "counts"]
    rows = rows.withColumn("digest", F.xxhash64("m", "terms", "counts"))
    least = Window.partitionBy(*same).orderBy(F.col("doc_id").asc_nulls_last())
    rows = rows.withColumn("place", F.row_number().over(least)).where(F.col("place") <= k)
    member = F.struct("place", "doc_id")
    return rows.groupBy(*same).agg(F.array_sort(F.collect_list(member)).alias("members")).drop("digest")


class _Best:
    """The best ``k`` rows of one item so far, best first."""

    def __init__(self, k: int):
        self.k, self.rows = k, []

    def floor(self) -> int:
        return max(1, self.rows[-1][0]) if len(self.rows) == self.k else 1

    def add(self, more: list[tuple[int, int | None]]) -> None:
        self.rows = sorted(self.rows + more, key=lambda r: (-r[0], r[1] is None, r[1] or 0))[: self.k]


def _class_scores(alike: DataFrame, weights: np.ndarray, items: list[tuple[np.ndarray, np.ndarray]], k: int) -> DataFrame:
    """``(item, doc_id, score)``: the best ``k`` rows a task has for each item."""

    def scored(batches):
        best = [_Best(k) for _ in items]
        step = max(1, CELLS // max(1, len(weights)))
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                piece = batch.slice(start, step)
                terms, counts = piece.column("terms"), piece.column("counts")
                sizes = np.diff(terms.offsets.to_numpy())
                rows = np.repeat(np.arange(piece.num_rows), sizes)
                m = piece.column("m").to_numpy()[rows]
                at, tf = terms.flatten().to_numpy(), counts.flatten().to_numpy()
                table = np.zeros((len(weights), piece.num_rows), dtype=np.int64)
                table[at, rows] = weights[at] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))
                members = piece.column("members")
                for own, (places, times) in zip(best, items, strict=True):
                    scores = times @ table[places]
                    for row in np.flatnonzero(scores >= own.floor()):
                        score = int(scores[row])
                        if score >= own.floor():
                            own.add([(score, x["doc_id"]) for x in members[int(row)].as_py()])
        found = [(item, doc, score) for item, own in enumerate(best) for score, doc in own.rows]
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[c] for x in found], t) for c, t in enumerate((pa.int32(), pa.int64(), pa.int64()))],
            names=["item", "doc_id", "score"],
        )

    return alike.select("m", "terms", "counts", "members").mapInArrow(scored, "item int, doc_id long, score long")


def weights_of(frequency: dict[int, int], size: int, documents: int) -> np.ndarray:
    """Weight of each term number from the number of documents that hold it."""
    return np.array(
        [math.floor(1000 * math.log((2 * documents + 2) / (2 * frequency.get(t, 0) + 1))) for t in range(size)],
        dtype=np.int64,
    )


def search(
    documents: DataFrame, items: DataFrame, k: int = 20, *, key: str = "doc_id", column: str = "text",
    item_key: str = "item_id", item_column: str = "text",
) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` documents of each item with the highest score above 0."""
    spark = documents.sparkSession
    room = common.scratch(spark, "lexical")
    asked = items.select(
        F.col(item_key).cast("long").alias("item_id"), F.coalesce(F.col(item_column).cast("string"), F.lit("")).alias("text")
    )
    asked = room.save(asked.groupBy("item_id").agg(F.min("text").alias("text")), "items")
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / BLOCK))
    results = []
    for block in range(blocks):
        own = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()  # about BLOCK bytes
        bag_of = [Counter(terms_of(row["text"].encode())) for row in own]
        vocabulary = {t: n for n, t in enumerate(sorted(set().union(*bag_of)))}
        if not vocabulary:
            continue
        bagged = room.save(bags(documents, vocabulary, key, column), f"bags-{block}")
        facts = bagged.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
        if not facts[1]:
            continue
        held = bagged.select(F.explode("terms").alias("term")).groupBy("term").count().collect()  # within the vocabulary
        weights = weights_of({r["term"]: r["count"] for r in held}, len(vocabulary), facts[0])
        lines = [
            (np.array([vocabulary[t] for t in bag], dtype=np.int64), np.array(list(bag.values()), dtype=np.int64))
            for bag in bag_of
        ]
        found = _class_scores(classes(bagged, facts[0], facts[1], k), weights, lines, k)
        names = spark.createDataFrame([(n, row["item_id"]) for n, row in enumerate(own)], "item int, item_id long")
        results.append(_ranked(found, k).join(F.broadcast(names), "item"))  # as many rows as the block has items
    if not results:
        return spark.createDataFrame([], RESULT)
    every = results[0]
    for more in results[1:]:
        every = every.unionByName(more)
    return every.select("item_id", "rank", "doc_id", "score")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """Rows of each item ranked; each item's rows meet in ``SPREAD`` parts first."""
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last()]
    parts = found.withColumn("part", F.pmod(F.xxhash64("doc_id", F.spark_partition_id()), F.lit(SPREAD)))
    parts = parts.withColumn("rank", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order)))
    met = Window.partitionBy("item").orderBy(*order)
    return parts.where(F.col("rank") <= k).withColumn("rank", F.row_number().over(met)).where(F.col("rank") <= k)


ORACLE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[0-9a-z\x{80}-\x{10FFFF}]+') AS terms
  FROM documents),
items AS (
  SELECT item_id,
         unnest(regexp_extract_all(translate(min(coalesce(text, '')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term
  FROM benchmark GROUP BY item_id),
asked AS (SELECT item_id, term, count(*) AS times FROM items GROUP BY ALL),
totals AS (SELECT count(*) FILTER (len(terms) > 0) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM docs),
tf AS (
  SELECT row, doc_id, n, term, count(*) AS tf
  FROM (SELECT row, doc_id, len(terms) AS n, unnest(terms) AS term FROM docs)
  WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * max(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, totals GROUP BY term),
scored AS (
  SELECT item_id, row, doc_id,
         CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM asked JOIN tf USING (term) JOIN weights USING (term), totals
  GROUP BY item_id, row, doc_id),
ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST) AS INTEGER) AS rank,
         doc_id, score
  FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""
