"""Grouping and aggregation.

Null counts as zero in sums and averages, and null keys form a group.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from functools import reduce
from itertools import groupby
from operator import itemgetter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def merge(*inputs: DataFrame) -> DataFrame:
    """All rows of inputs with the same fields."""
    names = inputs[0].columns
    for df in inputs[1:]:
        if set(df.columns) != set(names):
            raise ValueError(f"fields differ: {names} and {df.columns}")
    return reduce(lambda a, b: a.unionByName(b), inputs)


def union_distinct(*inputs: DataFrame) -> DataFrame:
    """Distinct rows over all inputs."""
    return merge(*inputs).distinct()


def group_sorted(
    inputs: DataFrame | list[DataFrame],
    keys: list[str],
    sort: list[str] | None = None,
    reverse: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """Rows in key order with a secondary sort inside the groups, nulls first.

    Range partitioning covers the sort fields too, so a group too big for one
    partition runs on into the next one, still in order.
    """
    df = merge(*inputs) if isinstance(inputs, list) else inputs
    order = [
        F.desc_nulls_last(c) if reverse else F.asc_nulls_first(c) for c in [*keys, *(sort or [])]
    ]
    spread = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    return spread.sortWithinPartitions(*order)


def total_sort(df: DataFrame, *fields: str, reverse: bool = False) -> DataFrame:
    """Total order over the whole result, nulls first."""
    return df.orderBy(*[F.desc_nulls_last(c) if reverse else F.asc_nulls_first(c) for c in fields])


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _listed(value: Column, ignore) -> Column:
    hit = F.lit(False)
    for item in ignore:
        hit = hit | value.eqNullSafe(F.lit(item))
    return hit


def count() -> Column:
    """Rows of the group."""
    return F.count(F.lit(1))


def total(value, to: str = "double") -> Column:
    """Sum with null as zero, as type ``to``."""
    return F.coalesce(F.sum(_col(value)), F.lit(0)).cast(to)


def average(value) -> Column:
    """Mean over all rows; a null value is a zero that counts."""
    return F.avg(F.coalesce(_col(value).cast("double"), F.lit(0.0)))


def _extreme(pick, value, ignore) -> Column:
    value = _col(value)
    weight = F.coalesce(value.cast("double"), F.lit(0.0))
    if ignore:
        weight = F.when(~_listed(value, ignore), weight)
    return pick(value, weight)


def minimum(value, ignore=()) -> Column:
    """The value that is smallest as a number, in its own type; null weighs 0.
    Values in ``ignore`` do not take part."""
    return _extreme(F.min_by, value, ignore)


def maximum(value, ignore=()) -> Column:
    """The value that is largest as a number, in its own type; null weighs 0."""
    return _extreme(F.max_by, value, ignore)


def _extent(pick, df, keys, fields, order, ignore) -> DataFrame:
    row = F.struct(*[F.col(f).alias(f) for f in fields])
    rank = F.struct(*order)
    for values in ignore:
        same = reduce(
            lambda a, b: a & b, [F.col(f).eqNullSafe(F.lit(v)) for f, v in zip(fields, values)]
        )
        rank = F.when(~same, rank)
    picked = df.groupBy(*keys).agg(pick(row, rank).alias("_row"))
    return picked.where(F.col("_row").isNotNull()).select(*keys, "_row.*")


def first(df: DataFrame, keys: list[str], fields: list[str], order: list[str], ignore=()) -> DataFrame:
    """The fields of the first row of every group in ``order``. Rows equal to a
    tuple in ``ignore`` do not take part; a group without rows gives none."""
    return _extent(F.min_by, df, keys, fields, order, ignore)


def last(df: DataFrame, keys: list[str], fields: list[str], order: list[str], ignore=()) -> DataFrame:
    """The fields of the last row of every group in ``order``."""
    return _extent(F.max_by, df, keys, fields, order, ignore)


def aggregate_by(inputs: DataFrame | list[DataFrame], keys: list[str], **aggregates: Column) -> DataFrame:
    """Several aggregates over one grouping, in one pass with map-side partials."""
    df = merge(*inputs) if isinstance(inputs, list) else inputs
    return df.groupBy(*keys).agg(*[value.alias(name) for name, value in aggregates.items()])


def sum_by(df: DataFrame, keys: list[str], value: str, name: str, to: str = "double") -> DataFrame:
    return aggregate_by(df, keys, **{name: total(value, to)})


def count_by(df: DataFrame, keys: list[str], name: str = "count") -> DataFrame:
    return aggregate_by(df, keys, **{name: count()})


def average_by(df: DataFrame, keys: list[str], value: str, name: str = "average") -> DataFrame:
    return aggregate_by(df, keys, **{name: average(value)})


def unique(df: DataFrame, fields: list[str], order: list[str] | None = None) -> DataFrame:
    """One whole row per distinct value of ``fields``: the first in ``order``.

    Without an order all other fields decide, so the choice is the same on every
    run.
    """
    others = [c for c in df.columns if c not in fields]
    if not others:
        return df.distinct()
    picked = df.groupBy(*fields).agg(
        F.min_by(F.struct(*others), F.struct(*(order or others))).alias("_row")
    )
    return picked.select(*fields, "_row.*").select(*df.columns)


def distinct_fields(df: DataFrame, *fields: str) -> DataFrame:
    """The distinct values of the fields."""
    return df.select(*fields).distinct()


def distinct_count(value, precision: int = 14) -> Column:
    """Approximate number of distinct values, in one step."""
    return F.hll_sketch_estimate(F.hll_sketch_agg(value, precision))


def ordered_groups(
    df: DataFrame, keys: list[str], order: list[str], results: Callable[[object], dict[str, Column]]
) -> DataFrame:
    """Look at every row with its ordered group around it.

    ``results`` gets the window and returns the columns to add.
    """
    window = Window.partitionBy(*keys).orderBy(*[F.asc_nulls_first(c) for c in order])
    return df.select("*", *[value.alias(name) for name, value in results(window).items()])


def buffer(
    df: DataFrame,
    keys: list[str],
    function: Callable[[pd.DataFrame], pd.DataFrame],
    schema: T.StructType | str,
    order: list[str] | None = None,
) -> DataFrame:
    """Hand every whole group to a pandas function that may return any rows.

    For logic that no window and no partial aggregate can express and that needs its
    group as one frame, which must fit into the memory of a task; ``stream_buffer`` reads a
    group of any size bit by bit, ``custom_aggregate`` and ``ordered_groups`` never hold one.
    """
    order = list(order or [])

    def run(group: pd.DataFrame) -> pd.DataFrame:
        if order:
            group = group.sort_values(order, na_position="first", kind="stable")
        return function(group)

    return df.groupBy(*keys).applyInPandas(run, schema)


def stream_buffer(
    df: DataFrame,
    keys: list[str],
    function: Callable[[tuple, Iterator[pd.DataFrame]], Iterable[pd.DataFrame]],
    schema: T.StructType | str,
    order: list[str] | None = None,
) -> DataFrame:
    """Hand every group to a function as a stream of frames, which may return any frames.

    The function gets the key's values and an iterator over the rows of the group in
    ``order`` (nulls first), ``spark.sql.execution.arrow.maxRecordsPerBatch`` at a time at most;
    what it keeps between frames is its own state. It is called once per group and need not
    read to the end. Rows are sorted in the JVM, which spills, and reach Python as one stream per
    partition, so a group may be larger than the memory of a task, and many small groups
    cost little. A group is still read by one task: what can be merged from parts belongs in
    ``custom_aggregate``. Null keys form a group.
    """
    sort = [F.asc_nulls_first(c) for c in [*keys, *(order or [])]]

    def made(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        runs = ((key, frame.iloc[a:b]) for frame in frames for key, a, b in key_runs(frame[keys]))
        for key, own in groupby(runs, itemgetter(0)):
            yield from function(key, (rows.reset_index(drop=True) for _, rows in own))

    spread = dealt_by_key(df, keys)
    spread = spread.sortWithinPartitions(*sort) if sort else spread
    return spread.mapInPandas(lambda frames: gathered(made(frames)), schema)


def dealt_by_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of a key in one partition, of as many as the session says. A function of one's own takes
    longer than its bytes suggest, so small partitions are not put together as they would be else."""
    if not keys:
        return df.coalesce(1)
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *[F.col(k) for k in keys])


def gathered(frames: Iterable[pd.DataFrame], rows: int = 4096) -> Iterator[pd.DataFrame]:
    """The same rows in fewer frames: small neighbours of equal types put together."""
    held: list[pd.DataFrame] = []
    size = 0
    for frame in frames:
        if held and (size + len(frame) > rows or not frame.dtypes.equals(held[0].dtypes)):
            yield pd.concat(held, ignore_index=True) if len(held) > 1 else held[0]
            held, size = [], 0
        if len(frame):
            held.append(frame)
            size += len(frame)
    if held:
        yield pd.concat(held, ignore_index=True) if len(held) > 1 else held[0]


def key_runs(keys: pd.DataFrame) -> Iterator[tuple[tuple, int, int]]:
    """``(key, start, end)`` of each run of equal rows, null equal to null. Keys can be compared."""
    size = len(keys)
    if not size:
        return
    changes = np.zeros(size - 1, dtype=bool)
    columns = [(keys.iloc[:, i].array, keys.iloc[:, i].isna().to_numpy()) for i in range(keys.shape[1])]
    for values, null in columns:
        differ = np.asarray(pd.Series(values[1:] != values[:-1]).fillna(True), dtype=bool)
        changes |= np.where(null[1:] | null[:-1], null[1:] != null[:-1], differ)
    starts = [0, *(np.flatnonzero(changes) + 1).tolist(), size]
    for start, end in zip(starts, starts[1:]):
        yield tuple(_plain(values[start], null[start]) for values, null in columns), start, end


def _plain(value, null: bool):
    if null:
        return None
    return value.item() if isinstance(value, np.generic) else value


def partitions_of(df: DataFrame) -> int | None:
    """Number of tasks that will make the rows of ``df``, known without running anything.

    None where only running would tell, as for a union of shuffled frames. Adaptive execution may
    merge the partitions of a shuffle into fewer."""
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        return plan.initialPlan().outputPartitioning().numPartitions() or None
    return plan.outputPartitioning().numPartitions() or df.rdd.getNumPartitions()


def custom_aggregate(
    df: DataFrame,
    keys: list[str],
    partial: Callable[[pd.DataFrame], pd.DataFrame],
    merge_partials: Callable[[pd.DataFrame], pd.DataFrame],
    state: T.StructType,
    held_keys: int = 10_000,
    fan_in: int = 64,
) -> DataFrame:
    """An aggregate of one's own, computed in mergeable steps.

    ``partial`` turns rows of several groups into state rows, one per group, and
    ``merge_partials`` does the same for state rows; both get and return frames
    with the key columns. ``state`` lists all state columns, keys included.

    States are built where the rows are, up to ``held_keys`` at a time. They are then
    merged up a tree: a level brings together the states that ``fan_in`` neighbouring
    tasks have for a key, and there are as many levels as it takes to get from the
    number of tasks to one, so no task merges more states of a busy key the more
    tasks there are. States come sorted by key and are merged by the batch: functions are
    called per batch, not per key, and hold a batch and ``held_keys`` states at most.
    """
    names = state.names
    every = T.StructType([*state.fields, T.StructField("_part", T.LongType())])

    def build(batches):
        held: pd.DataFrame | None = None
        for rows in batches:
            if rows.empty:
                continue
            made = partial(rows)[names]
            held = made if held is None else merge_partials(
                pd.concat([held, made], ignore_index=True)
            )[names]
            if len(held) > held_keys:
                yield held
                held = None
        if held is not None:
            yield held

    def fold(batches):
        """Input is sorted by key, so of the keys of a batch only the last one can go on."""
        held: pd.DataFrame | None = None
        for rows in batches:
            if rows.empty:
                continue
            rows = rows if held is None else pd.concat([held, rows], ignore_index=True)
            merged = merge_partials(rows[names])[names]
            if keys:
                parts = rows.groupby(keys, as_index=False, dropna=False, sort=False)["_part"].min()
                merged = merged.merge(parts, on=keys, how="left")
                last = _has_key(merged, parts.iloc[-1], keys)
            else:
                merged = merged.assign(_part=rows["_part"].min())
                last = pd.Series(True, index=merged.index)
            yield merged[~last]
            held = merged[last]
        if held is not None:
            yield held

    made = df.mapInPandas(build, state).withColumn("_part", F.spark_partition_id().cast("long"))
    tasks = partitions_of(df) or 1 << 20
    for _ in range(max(1, math.ceil(math.log(max(tasks, 2), fan_in)))):
        dealt = made.withColumn("_part", F.floor(F.col("_part") / fan_in))
        spread = dealt.repartition(*keys, "_part")
        made = (spread.sortWithinPartitions(*keys) if keys else spread).mapInPandas(fold, every)
    return made.drop("_part")


def _has_key(rows: pd.DataFrame, key: pd.Series, keys: list[str]) -> pd.Series:
    """Which rows have the key, null equal to null."""
    same = pd.Series(True, index=rows.index)
    for name in keys:
        same &= rows[name].isna() if pd.isna(key[name]) else rows[name] == key[name]
    return same
