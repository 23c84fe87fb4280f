"""Packing of documents into sequences of fixed length by bin completion.

Only the number of pieces of each length matters for a packing, and there are at
most ``capacity`` lengths, so the search works on that bounded histogram: a
*filling* is a multiset of lengths around the largest one left, used as many
times as the counts allow. Documents then find their place by their rank among
the pieces of the same length, without any task seeing all of them.

A null text is empty and has one id (the end id). Repeated rows are packed as
rows of their own. An empty table gives an empty result. Other columns are not
looked at.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import common
from tidemark.llm.tokens import encoded

Filling = tuple[tuple[int, int], ...]  # (length, uses), largest first

PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("part", pa.int32()),
        ("seat", pa.int64()),
    ]
)


def cut(documents: DataFrame, tokenizer: str, capacity: int, end: int) -> DataFrame:
    """Pieces of at most ``capacity`` ids, with their seat among those of a length in a part."""

    def work(batches):
        seats: dict[int, int] = defaultdict(int)
        part = TaskContext.get().partitionId()
        out: list[tuple] = []
        for key, ids in encoded(common.rows(batches, "doc_id", "text"), tokenizer, False, end):
            for at in range(0, len(ids), 4 * capacity):
                piece = ids[at : at + 4 * capacity]
                size = len(piece) // 4
                out.append((key, at // (4 * capacity), at // 4, size, zlib.crc32(piece), part, seats[size]))
                seats[size] += 1
            if len(out) >= 8192:
                yield common.batch_of(PIECES, list(zip(*out)))
                out = []
        if out:
            yield common.batch_of(PIECES, list(zip(*out)))

    return documents.select("doc_id", "text").mapInArrow(
        work,
        "doc_id long, piece int, start long, length long, ids_crc32 long, part int, seat long",
    )


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, Filling]]:
    """Best-fit decreasing on the histogram: ``(times, filling)`` of every kind of bin."""
    room: dict[int, list[list]] = defaultdict(list)  # room left -> [times, filling as a chain]
    open_rooms: list[int] = []
    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            at = bisect_left(open_rooms, size)
            if at == len(open_rooms):
                per = capacity // size
                whole, rest = divmod(left, per)
                made = [(whole, per)] * bool(whole) + [(1, rest)] * bool(rest)
                for times, uses in made:
                    _open(room, open_rooms, capacity - uses * size, [times, ((size, uses), None)])
                left = 0
                continue
            gap = open_rooms[at]
            group = room[gap][-1]
            times = min(left, group[0])
            left -= times
            group[0] -= times
            if not group[0]:
                room[gap].pop()
                if not room[gap]:
                    open_rooms.pop(at)
            _open(room, open_rooms, gap - size, [times, ((size, 1), group[1])])
    out = []
    for groups in room.values():
        for times, chain in groups:
            uses: dict[int, int] = defaultdict(int)
            while chain:
                (size, n), chain = chain
                uses[size] += n
            out.append((times, tuple(sorted(uses.items(), reverse=True))))
    return out


def _open(room, open_rooms, gap, group) -> None:
    if not room[gap]:
        open_rooms.insert(bisect_left(open_rooms, gap), gap)
    room[gap].append(group)


def fillings(left: dict[int, int], sizes: list[int], capacity: int, width: int, effort: int):
    """Undominated fillings around the largest length, those with the least waste first.

    ``sizes`` are the lengths left, rising. A filling is dominated when a longer
    piece that is left fits in place of one of its pieces: the other filling
    wastes less and leaves an easier rest.
    """
    first = sizes[-1]
    found: list[tuple[int, Filling]] = []
    steps = 0

    def free(size: int, uses: dict[int, int]) -> bool:
        return left.get(size, 0) > uses.get(size, 0)

    def dominated(gap: int, uses: dict[int, int]) -> bool:
        if not gap:
            return False
        for size in uses:
            if size == first and uses[size] == 1:
                continue
            at = bisect_right(sizes, size)
            while at < len(sizes) and sizes[at] <= size + gap:
                if free(sizes[at], uses):
                    return True
                at += 1
        return False

    def walk(gap: int, top: int, uses: dict[int, int]) -> None:
        nonlocal steps
        steps += 1
        if gap and gap <= top and free(gap, uses):
            found.append((0, _as_filling(uses, gap)))
            return
        at = bisect_right(sizes, min(gap, top)) - 1
        leaf = True
        while at >= 0:
            if free(sizes[at], uses):
                leaf = False
                walk(gap - sizes[at], sizes[at], uses | {sizes[at]: uses.get(sizes[at], 0) + 1})
                if len(found) >= width and any(not w for w, _ in found) or steps >= effort:
                    return
            at -= 1
        if leaf and not dominated(gap, uses):
            found.append((gap, _as_filling(uses)))

    walk(capacity - first, first, {first: 1})
    found.sort(key=lambda x: (x[0], len(x[1])))
    return list(dict.fromkeys(found))[:width]


def _as_filling(uses: dict[int, int], more: int = 0) -> Filling:
    if more:
        uses = uses | {more: uses.get(more, 0) + 1}
    return tuple(sorted(uses.items(), reverse=True))


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Bins that no packing can go below: by volume, and by pieces over half a bin."""
    volume = -(-sum(s * n for s, n in counts.items()) // capacity)
    return max(volume, sum(n for s, n in counts.items() if 2 * s > capacity))


def bin_completion(
    counts: dict[int, int], capacity: int, nodes: int = 6000, width: int = 3, effort: int = 300
) -> list[tuple[int, Filling]]:
    """The kinds of bins of a packing: ``(times, ((length, uses), ...))``.

    Best-fit decreasing gives the first incumbent. The branch and bound then
    fills bins around the largest length left; a branch is cut when its waste
    leaves no room for fewer bins than the incumbent. ``nodes`` bounds the effort
    at any size of the corpus, as every node uses up one length or more.
    """
    counts = {s: n for s, n in counts.items() if n}
    if not counts:
        return []
    best = best_fit(counts, capacity)
    bins = sum(n for n, _ in best)
    bound, volume = lower_bound(counts, capacity), sum(s * n for s, n in counts.items())
    stack = [(counts, (), 0, 0)]  # lengths left, chain of bins made, their number, their waste
    while stack and bins > bound and nodes:
        left, chain, made, waste = stack.pop()
        nodes -= 1
        if waste > (bins - 1) * capacity - volume or made + lower_bound(left, capacity) >= bins:
            continue
        if not left:
            best, bins = [], made
            while chain:
                step, chain = chain
                best.append(step)
            continue
        branches = []
        for gap, filling in fillings(left, sorted(left), capacity, width, effort):
            times = min(left[s] // n for s, n in filling)
            rest = dict(left)
            for s, n in filling:
                rest[s] -= times * n
                if not rest[s]:
                    del rest[s]
            branches.append((rest, ((times, filling), chain), made + times, waste + times * gap))
        stack += reversed(branches)
    return best


def places(kinds: list[tuple[int, Filling]]) -> np.ndarray:
    """Per kind of bin and length: length, first rank, times, first sequence, offset."""
    ranks: dict[int, int] = defaultdict(int)
    out, sequence = [], 0
    for times, filling in kinds:
        offset = 0
        for size, uses in filling:
            out.append((size, ranks[size], times, sequence, offset))
            ranks[size] += times * uses
            offset += size * uses
        sequence += times
    return np.array(sorted(out), dtype=np.int64).reshape(-1, 5)


def pack(documents: DataFrame, tokenizer: str, capacity: int = 2048, end: int = 0) -> DataFrame:
    """One row per piece with its ``sequence_id`` and ``offset``.

    The histogram that reaches the driver has at most ``capacity`` rows, the
    table of places that goes back at most ``capacity`` kinds of bins.
    """
    spark = documents.sparkSession
    room = common.scratch(spark, "packing")
    pieces = room.save(cut(documents, tokenizer, capacity, end), "pieces")
    seats = room.save(pieces.groupBy("length", "part").agg(F.count("*").alias("held")), "seats")
    counts = {r["length"]: r["held"] for r in seats.groupBy("length").agg(F.sum("held").alias("held")).collect()}
    table = places(bin_completion(counts, capacity))
    keys = (table[:, 0] << 44) | table[:, 1]
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    seats = seats.select(
        "length", "part", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("ahead")
    )

    def place(batches):
        for batch in batches:
            size, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            row = table[np.searchsorted(keys, (size << 44) | rank, side="right") - 1]
            turn = rank - row[:, 1]
            found = [pa.array(row[:, 3] + turn % row[:, 2]), pa.array(row[:, 4] + turn // row[:, 2] * size)]
            kept = [batch.column(c) for c in range(5)]
            yield pa.RecordBatch.from_arrays(
                kept + found, names=batch.schema.names[:5] + ["sequence_id", "offset"]
            )

    ranked = pieces.join(seats, ["length", "part"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("ahead") + F.col("seat")).alias("rank")
    )
    return ranked.mapInArrow(
        place,
        "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
    )
