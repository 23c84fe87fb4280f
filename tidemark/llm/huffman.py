"""Token ids in files of length-limited canonical Huffman codes.

A dataset is a folder of Parquet files below ``shard=N``; shards, blocks in a
shard and documents in a block rise with ``doc_id``. A row is a block that is
decoded on its own: the ids of its documents, how many ids each has, the packed
bits, in which every document begins on a byte, and the bit offset of every
``STRIDE``-th id. The code lengths, from counts over the whole corpus, are beside
the shards in ``code``; canonical codes follow from them.

A null text is empty and has only the end id. Documents with one id are all kept,
in the order of their length. An empty table gives an empty dataset. Other
columns are not looked at.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import common
from tidemark.llm.tokens import encoded, forget

#: Ids between two checkpoints.
STRIDE = 256
#: Ids after which a block ends.
BLOCK = 1 << 18
#: Bytes of codes that a shard holds at most, about.
SHARD = 32 << 20


def code_lengths(counts: np.ndarray, longest: int) -> np.ndarray:
    """Length of each symbol's code by package-merge, 0 where it never occurs."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), dtype=np.uint8)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << longest:
        raise ValueError(f"{len(used)} symbols do not fit into codes of {longest} bits")
    used = used[np.argsort(counts[used], kind="stable")]
    weights = counts[used].astype(np.float64)
    coins, leaves = weights, [np.ones(len(used), dtype=bool)]
    for _ in range(longest - 1):
        pairs = coins[: len(coins) // 2 * 2].reshape(-1, 2).sum(axis=1)
        coins = np.concatenate([weights, pairs])
        order = np.argsort(coins, kind="stable")
        coins = coins[order]
        leaves.append(order < len(weights))
    taken = 2 * len(used) - 2
    for level in reversed(leaves):
        own = int(level[:taken].sum())
        lengths[used[:own]] += 1
        taken = 2 * (taken - own)
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes that rise with (length, symbol)."""
    codes = np.zeros(len(lengths), dtype=np.uint64)
    code = previous = 0
    for symbol in np.lexsort((np.arange(len(lengths)), lengths)):
        size = int(lengths[symbol])
        if size:
            code <<= size - previous
            codes[symbol] = code
            code, previous = code + 1, size
    return codes


def decode_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Symbol and code length of every possible next ``width`` bits."""
    width = max(1, int(lengths.max(initial=0)))
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    spans = 1 << (width - lengths[order].astype(np.int64))
    symbols, sizes = np.repeat(order, spans), np.repeat(lengths[order], spans)
    short = (1 << width) - len(symbols)
    return np.pad(symbols, (0, short)).astype(np.uint32), np.pad(sizes, (0, short), constant_values=1), width


def pack_bits(ids: np.ndarray, first: np.ndarray, lengths: np.ndarray, codes: np.ndarray):
    """Bytes of the codes of ``ids``, and the bit at which each begins.

    ``first`` are the places in ``ids`` where a document begins, on a whole byte.
    """
    size = lengths[ids].astype(np.int64)
    ends = np.cumsum(size)
    starts = ends - size
    doc_starts = starts[first]
    bits = np.diff(np.append(doc_starts, ends[-1] if len(ends) else 0))
    aligned = np.concatenate([[0], np.cumsum((bits + 7) // 8 * 8)])
    starts += np.repeat(aligned[:-1] - doc_starts, np.diff(np.append(first, len(ids))))
    value = codes[ids] << (64 - (starts & 31) - size).astype(np.uint64)
    word, total = starts >> 5, int(aligned[-1] + 31 >> 5) + 1
    high = np.bincount(word, (value >> np.uint64(32)).astype(np.float64), total)
    low = np.bincount(word + 1, (value & np.uint64(0xFFFFFFFF)).astype(np.float64), total + 1)
    words = high + low[:total]
    return words.astype(">u4").tobytes()[: int(aligned[-1]) // 8], starts, aligned // 8


def unpack_bits(payload: bytes, checkpoints: np.ndarray, counts: np.ndarray, table) -> np.ndarray:
    """Ids between checkpoints, all stretches side by side.

    ``counts`` has the number of ids from each checkpoint on.
    """
    symbols, sizes, width = table
    data = np.frombuffer(payload + bytes(8), dtype=np.uint8).astype(np.uint32)
    windows = data[:-3] << 24 | data[1:-2] << 16 | data[2:-1] << 8 | data[3:]
    at = checkpoints.astype(np.int64)
    places = np.concatenate([[0], np.cumsum(counts)])
    out = np.empty(int(places[-1]), dtype=np.uint32)
    order = np.argsort(-counts, kind="stable")
    at, left, goal = at[order], counts[order], places[:-1][order]
    for step in range(int(counts.max(initial=0))):
        live = int(np.searchsorted(-left, -step, side="left"))
        here = at[:live]
        key = (windows[here >> 3].astype(np.int64) >> (32 - width - (here & 7))) & ((1 << width) - 1)
        out[goal[:live] + step] = symbols[key]
        at[:live] = here + sizes[key]
    return out


def _width(symbols: int) -> str:
    return "<u2" if symbols <= 1 << 16 else "<u4"


IDS = pa.schema(
    [("doc_id", pa.int64()), ("ids", pa.binary()), ("seen", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64()))]
)


def _ids(documents: DataFrame, tokenizer: str, end: int, symbols: int) -> DataFrame:
    """The ids of each document, and a row without ids for each task: how often it saw which id."""

    def work(batches):
        total = np.zeros(symbols, dtype=np.int64)

        def flush(held):
            keys, parts = zip(*held)
            every = np.frombuffer(b"".join(parts), dtype="<u4")
            total[:] += np.bincount(every, minlength=symbols)
            data = every.astype(_width(symbols)).tobytes()
            ends = np.cumsum([len(x) for x in parts]) * len(data) // (4 * len(every))
            ids = [data[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]
            return common.batch_of(IDS, [keys, ids, [None] * len(ids), [None] * len(ids)])

        held, size = [], 0
        for key, ids in encoded(common.rows(batches, "doc_id", "text"), tokenizer, True, end):
            held.append((key, ids))
            size += len(ids)
            if size > 4 << 20:
                yield flush(held)
                held, size = [], 0
        if held:
            yield flush(held)
        used = np.flatnonzero(total)
        yield common.batch_of(IDS, [[None], [None], [used], [total[used]]])

    columns = "doc_id long, ids binary, seen array<int>, counts array<long>"
    return documents.select("doc_id", "text").mapInArrow(work, columns)


def _counts(ids: DataFrame, symbols: int) -> np.ndarray:
    """How often each id occurs; at most ``symbols`` rows reach the driver."""
    pairs = ids.select(F.explode(F.arrays_zip("seen", "counts")).alias("p"))
    found = pairs.groupBy(F.col("p.seen").alias("id")).agg(F.sum("p.counts").alias("n"))
    out = np.zeros(symbols, dtype=np.int64)
    for row in found.collect():
        out[row["id"]] = row["n"]
    return out


CODED = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("bits", pa.binary()), ("marks", pa.binary())])
BLOCKS = "shard int, block int, doc_ids array<long>, sizes array<long>, checkpoints binary, payload binary"


def _coded(ids: DataFrame, lengths: np.ndarray) -> DataFrame:
    """Each document's bits and the bit offsets of its checkpoints."""
    codes, width = canonical_codes(lengths), _width(len(lengths))

    def flush(keys, held):
        every = np.frombuffer(b"".join(held), dtype=width)
        sizes = np.array([len(x) for x in held]) // every.itemsize
        first = np.cumsum(sizes) - sizes
        payload, starts, edges = pack_bits(every, first, lengths, codes)
        bits = [payload[a:b] for a, b in zip(edges[:-1], edges[1:])]
        marks = [
            (starts[f : f + n : STRIDE] - starts[f]).astype("<u4").tobytes() for f, n in zip(first, sizes)
        ]
        return common.batch_of(CODED, [keys, sizes, bits, marks])

    def work(batches):
        forget()
        keys, held, size = [], [], 0
        for key, data in common.rows(batches, "doc_id", "ids"):
            keys.append(key)
            held.append(data)
            size += len(data)
            if size > 1 << 20:
                yield flush(keys, held)
                keys, held, size = [], [], 0
        if held:
            yield flush(keys, held)

    documents = ids.where("ids is not null").select("doc_id", "ids")
    return documents.mapInArrow(work, "doc_id long, n long, bits binary, marks binary")


def _blocks(coded: DataFrame) -> DataFrame:
    """Blocks of the documents of a shard, which arrive in order."""
    names = ["shard", "block", "doc_ids", "sizes", "checkpoints", "payload"]
    types = [pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary()]
    schema = pa.schema(list(zip(names, types)))

    def work(batches):
        shard, block, held, size = None, 0, [], 0

        def flush():
            marks, at = [], 0
            for _, _, bits, own in held:
                marks.append(np.frombuffer(own, dtype="<u4").astype("<u8") + at)
                at += 8 * len(bits)
            keys, sizes, bits, _ = zip(*held)
            return common.batch_of(
                schema, [[shard], [block], [keys], [sizes], [np.concatenate(marks).tobytes()], [b"".join(bits)]]
            )

        for at, *document in common.rows(batches, "shard", "doc_id", "n", "bits", "marks"):
            if held and (at != shard or size >= BLOCK):
                yield flush()
                block, held, size = block + 1 if at == shard else 0, [], 0
            shard = at
            held.append(document)
            size += document[1]
        if held:
            yield flush()

    return coded.mapInArrow(work, BLOCKS)


def write(documents: DataFrame, folder: str, tokenizer: str, end: int, symbols: int, longest: int = 18) -> None:
    """Encode every text and write the dataset to ``folder``.

    ``symbols`` bounds the ids; the table of their counts and code lengths is all
    that the driver holds.
    """
    spark = documents.sparkSession
    room = common.scratch(spark, "huffman")
    target = room.path("ids")
    _ids(documents, tokenizer, end, symbols).write.option("compression", "zstd").parquet(target)
    ids = spark.read.parquet(target)
    counts = _counts(ids, symbols)
    lengths = code_lengths(counts, longest)
    code = [(int(s), int(lengths[s])) for s in np.flatnonzero(lengths)]
    spark.createDataFrame(code, "id int, bits int").coalesce(1).write.parquet(f"{folder}/code")
    # As many shards as the session has partitions, or as it takes to keep one below SHARD bytes of codes.
    coded = sum(int(n) * int(bits) for n, bits in zip(counts, lengths)) // 8
    shards = max(common.parts(spark), math.ceil(coded / SHARD))
    bounds = ids.approxQuantile("doc_id", [k / shards for k in range(1, shards)], 1 / (4 * shards))
    edges = F.array(*(F.lit(int(b)).cast("long") for b in sorted(set(bounds))))
    shard = F.size(F.filter(edges, lambda b: b <= F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))))
    (
        _blocks(
            _coded(ids, lengths)
            .withColumn("shard", shard if bounds else F.lit(0))
            .repartition(shards, "shard")
            .sortWithinPartitions("shard", "doc_id", "n")
        )
        .write.partitionBy("shard")
        .option("compression", "uncompressed")
        .parquet(f"{folder}/blocks")
    )
    room.close()


def _decoded(spark: SparkSession, folder: str, symbols: int, fields: str, made) -> DataFrame:
    """Rows that ``made`` gives for each block, from its documents' ids, first places and sizes, and ids (an array)."""
    lengths = np.zeros(symbols, dtype=np.uint8)
    for row in spark.read.parquet(f"{folder}/code").collect():
        lengths[row["id"]] = row["bits"]
    table = decode_table(lengths)
    blocks = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")
    held = blocks.select(
        "shard", "block", F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x).alias("n")
    )
    inside = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = held.groupBy("shard").agg(F.sum("n").alias("n")).collect()  # one row a shard
    starts, ahead = {}, 0
    for row in sorted(totals, key=lambda r: r["shard"]):
        starts[row["shard"]], ahead = ahead, ahead + row["n"]
    placed = held.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0))).drop("n")

    def work(batches):
        wanted = ("shard", "inside", "doc_ids", "sizes", "checkpoints", "payload")
        for shard, inside, keys, sizes, marks, payload in common.rows(batches, *wanted):
            sizes = np.array(sizes, dtype=np.int64)
            whole = -(-sizes // STRIDE)
            counts = np.full(int(whole.sum()), STRIDE, dtype=np.int64)
            counts[np.cumsum(whole) - 1] = sizes - (whole - 1) * STRIDE
            ids = unpack_bits(payload, np.frombuffer(marks, dtype="<u8"), counts, table).astype("<u4", copy=False)
            yield made(keys, np.cumsum(sizes) - sizes, sizes, starts[shard] + inside, ids)

    return blocks.join(placed, ["shard", "block"]).mapInArrow(work, fields)


def read(spark: SparkSession, folder: str, symbols: int) -> DataFrame:
    """``(doc_id, start, ids)`` of every document, from the files; ids as 4-byte integers."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.binary())])

    def whole(keys, first, sizes, ahead, ids):
        parts = [ids[a : a + n].tobytes() for a, n in zip(first, sizes)]
        return common.batch_of(schema, [keys, first + ahead, parts])

    return _decoded(spark, folder, symbols, "doc_id long, start long, ids binary", whole)


def digest(spark: SparkSession, folder: str, symbols: int) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, from the files; checksums are taken where ids are decoded."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
    )

    def summed(keys, first, sizes, ahead, ids):
        checks = [zlib.crc32(ids[a : a + n]) for a, n in zip(first.tolist(), sizes.tolist())]
        return common.batch_of(schema, [keys, first + ahead, sizes, checks])

    return _decoded(spark, folder, symbols, "doc_id long, start long, n_tokens long, ids_crc32 long", summed)
