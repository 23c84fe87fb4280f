"""Joins of several streams on key lists. Null keys match each other.

Outer streams are handled by presence: one aggregate finds which streams hold
each key, a stream that may be absent gets one empty row for every key it lacks,
and then all streams meet in inner joins. Adaptive execution can split either
side of an inner join on a busy key, which it cannot do for the optional side of
an outer join. From the third stream on the joined rows are shuffled once more,
so that a busy key is split in every join.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import reduce
from itertools import chain, groupby
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.operators.grouping import dealt_by_key, gathered, key_runs

Stream = tuple[DataFrame, list[str]]
_NULLABLE = {
    pa.bool_(): pd.BooleanDtype(), pa.int8(): pd.Int8Dtype(), pa.int16(): pd.Int16Dtype(),
    pa.int32(): pd.Int32Dtype(), pa.int64(): pd.Int64Dtype(),
}


def _required(joiner: str | Sequence[bool], count: int) -> list[bool]:
    """Which streams must hold a key for it to come out."""
    if not isinstance(joiner, str):
        flags = list(joiner)
        if len(flags) != count:
            raise ValueError(f"{len(flags)} flags for {count} streams")
        return flags
    if joiner == "inner":
        return [True] * count
    if joiner == "left":
        return [True] * (count - 1) + [False]
    if joiner == "right":
        return [False] + [True] * (count - 1)
    if joiner == "outer":
        return [False] * count
    raise ValueError(f"unknown joiner {joiner!r}")


def _key_names(width: int) -> list[str]:
    return [f"_key{i}" for i in range(width)]


def _staged(streams: Sequence[Stream]) -> tuple[list[DataFrame], list[list[str]], int]:
    """Streams under unique names, each with its join keys beside its fields."""
    width = len(streams[0][1])
    staged, fields = [], []
    for i, (df, keys) in enumerate(streams):
        if len(keys) != width:
            raise ValueError("all streams need the same number of keys")
        own = [f"_s{i}_{c}" for c in df.columns]
        staged.append(
            df.select(
                *[F.col(k).alias(n) for k, n in zip(keys, _key_names(width))],
                *[F.col(c).alias(n) for c, n in zip(df.columns, own)],
            )
        )
        fields.append(own)
    return staged, fields, width


def _output_names(streams: Sequence[Stream], declared: list[str] | None) -> list[str]:
    names = [c for df, _ in streams for c in df.columns]
    if declared is not None:
        if len(declared) != len(names):
            raise ValueError(f"{len(declared)} declared fields for {len(names)}")
        return declared
    twice = {n for n in names if names.count(n) > 1}
    if twice:
        raise ValueError(f"declare the fields, these names clash: {sorted(twice)}")
    return names


def _on(left: DataFrame, right: DataFrame, width: int, turn: int) -> tuple[DataFrame, Column]:
    renamed = right.withColumnsRenamed({n: f"{n}_r" for n in _key_names(width)})
    condition = reduce(
        lambda a, b: a & b,
        [left[n].eqNullSafe(renamed[f"{n}_r"]) for n in _key_names(width)],
    )
    if turn > 1:
        # A key of another shape puts an exchange between two joins on the same key,
        # without which adaptive execution splits neither of them.
        mine = F.struct(F.lit(turn).alias("turn"), *[left[n].alias(n) for n in _key_names(width)])
        theirs = F.struct(F.lit(turn).alias("turn"), *[renamed[f"{n}_r"].alias(n) for n in _key_names(width)])
        condition = mine.eqNullSafe(theirs)
    return renamed, condition


def _join(left: DataFrame, right: DataFrame, width: int, how: str, turn: int = 1) -> DataFrame:
    renamed, condition = _on(left, right, width, turn)
    return left.join(renamed, condition, how).drop(*[f"{n}_r" for n in _key_names(width)])


def _with_absences(staged: list[DataFrame], required: list[bool], width: int) -> list[DataFrame]:
    """Give every optional stream an empty row per key it lacks."""
    keys = _key_names(width)
    seen = reduce(
        lambda a, b: a.unionByName(b),
        [df.select(*keys, F.lit(1 << i).cast("bigint").alias("_in")) for i, df in enumerate(staged)],
    )
    presence = seen.groupBy(*keys).agg(F.bit_or("_in").alias("_in"))
    needed = sum(1 << i for i, flag in enumerate(required) if flag)
    if needed:
        presence = presence.where(F.col("_in").bitwiseAND(F.lit(needed)) == needed)
    filled = []
    for i, df in enumerate(staged):
        if required[i]:
            filled.append(df)
            continue
        empty = [
            F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields if f.name not in keys
        ]
        absent = presence.where(F.col("_in").bitwiseAND(F.lit(1 << i)) == 0).select(*keys, *empty)
        filled.append(df.unionByName(absent))
    return filled


def co_group(
    streams: Sequence[Stream],
    joiner: str | Sequence[bool] = "inner",
    declared: list[str] | None = None,
) -> DataFrame:
    """Join any number of ``(frame, keys)`` streams by shuffling.

    ``joiner`` is inner, left (only the last stream is optional), right (only the
    first is), outer (all are), or one flag per stream, true where the stream is
    required. The output has all fields of all streams; ``declared`` renames them.
    Join a frame with itself by listing it more than once.
    """
    required = _required(joiner, len(streams))
    names = _output_names(streams, declared)
    staged, fields, width = _staged(streams)
    if not all(required):
        staged = _with_absences(staged, required, width)
    joined = staged[0]
    for turn, right in enumerate(staged[1:], start=1):
        joined = _join(joined, right, width, "inner", turn)
    own = [c for group in fields for c in group]
    return joined.select(*[F.col(c).alias(n) for c, n in zip(own, names)])


def hash_join(streams: Sequence[Stream], joiner: str = "inner", declared: list[str] | None = None) -> DataFrame:
    """Join where every stream but the first is meant to be small.

    Adaptive execution sends a right stream to all executors if its measured size is
    under ``spark.sql.adaptive.autoBroadcastJoinThreshold``; a bigger one is joined by
    shuffling, with the same result. Right and outer joins, which must know the keys
    of the first stream, go through ``co_group``.
    """
    if joiner not in ("inner", "left"):
        return co_group(streams, joiner, declared)
    names = _output_names(streams, declared)
    staged, fields, width = _staged(streams)
    joined = staged[0]
    for i, right in enumerate(staged[1:], start=1):
        how = "left" if joiner == "left" and i == len(staged) - 1 else "inner"
        joined = _join(joined, right, width, how, i)
    own = [c for group in fields for c in group]
    return joined.select(*[F.col(c).alias(n) for c, n in zip(own, names)])


def co_group_apply(
    left: Stream,
    right: Stream,
    function: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame],
    schema: T.StructType | str,
) -> DataFrame:
    """A joiner of one's own over two streams: a pandas function gets both sides
    of every key at once, so a key must fit into the memory of one task. ``co_group_stream``
    holds only one side; joins that need no function go through ``co_group``."""
    return (
        left[0]
        .groupBy(*left[1])
        .cogroup(right[0].groupBy(*right[1]))
        .applyInPandas(function, schema)
    )


def co_group_stream(
    held: Stream,
    streamed: Stream,
    function: Callable[[pd.DataFrame, Iterator[pd.DataFrame]], Iterable[pd.DataFrame]],
    schema: T.StructType | str,
    order: Sequence[str] = (),
    splits: int = 1,
) -> DataFrame:
    """A joiner of one's own over two streams of which only the first is held.

    Both streams go through one shuffle, as one frame in which every row says whose it is,
    sorted by key, with the held rows of a key first. For each key of either stream the
    function gets the held rows as one frame (empty if there are none) and an iterator over
    the streamed ones, in ``order`` (nulls first) and ``spark.sql.execution.arrow.maxRecordsPerBatch``
    at a time. So the held rows of a key must fit into the memory of a task, and the streamed
    rows may be any number: hold the smaller stream. Null keys match each other. Whole
    numbers and truth values come as pandas' nullable types, so that nulls do not change
    them, and moments with their zone.

    A joiner that looks at each streamed row on its own can let ``splits`` tasks share a
    key: streamed rows are dealt out by a hash of their fields, and held rows go to all
    parts. The function is then called once per part, and ``splits`` times for a key that has no
    streamed rows.
    """
    (both_held, both_streamed), fields, width = _staged([held, streamed])
    keys = _key_names(width)
    types = [{f.name: f.dataType for f in df.schema} for df in (held[0], streamed[0])]
    if splits > 1:
        parts = F.array(*[F.lit(i) for i in range(splits)])
        both_held = both_held.withColumn("_part", F.explode(parts))
        both_streamed = both_streamed.withColumn("_part", F.pmod(F.xxhash64(*fields[1]), F.lit(splits)).cast("int"))
        keys = [*keys, "_part"]

    def tagged(df: DataFrame, place: int) -> DataFrame:
        """The rows with the fields of the other stream empty."""
        other = [
            F.lit(None).cast(t).alias(n) for n, t in zip(fields[1 - place], types[1 - place].values(), strict=True)
        ]
        return df.select("*", F.lit(place).alias("_stream"), *other)

    union = tagged(both_held, 0).unionByName(tagged(both_streamed, 1))
    place_of = dict(zip(streamed[0].columns, fields[1], strict=True))
    sort = [F.asc_nulls_first(c) for c in [*keys, "_stream", *[place_of[c] for c in order]]]
    result = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(result)

    own_names = [held[0].columns, streamed[0].columns]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pd.DataFrame, pd.DataFrame]]:
        """Key, held rows and streamed rows of each run of a key."""
        for batch in batches:
            rows = batch.to_pandas(types_mapper=_NULLABLE.get)
            sides = [rows[own].set_axis(names, axis=1) for own, names in zip(fields, own_names, strict=True)]
            before = np.concatenate([[0], np.cumsum(rows["_stream"].to_numpy() == 0)])
            for key, start, end in key_runs(rows[keys]):
                cut = start + int(before[end] - before[start])  # held rows come first
                yield key, sides[0].iloc[start:cut], sides[1].iloc[cut:end].reset_index(drop=True)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        for _, own in groupby(pieces(batches), itemgetter(0)):
            first, rest = [], iter(())
            for _, mine, others in own:
                first.append(mine)
                if len(others):
                    rest = chain([others], (later for _, _, later in own))
                    break
            yield from function(pd.concat(first, ignore_index=True) if len(first) > 1 else first[0].reset_index(drop=True), rest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for made in gathered(frame[result.names] for frame in joined(batches)):
            yield pa.RecordBatch.from_pandas(made, schema=arrow, preserve_index=False)

    return dealt_by_key(union, keys).sortWithinPartitions(*sort).mapInArrow(run, result)
