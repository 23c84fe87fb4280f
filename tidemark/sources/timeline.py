"""Rows in time slices that are closed one after the other.

A slice is known by the epoch second it starts at; its week, counted from the
epoch, follows from that. Both are partition columns. A status table beside the
rows lists closed slices, and readers get closed slices by a semi join with it,
so the plan does not grow with the number of slices and only their folders are
opened. A slice can take rows while neither it nor a later one is closed.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.dataset import Dataset

WEEK_SECONDS = 7 * 24 * 3600
_PLACE = T.StructType([T.StructField("week_start", T.LongType()), T.StructField("slice_start", T.LongType())])
_STATUS = "slice_start long"


def week_of(second: Column) -> Column:
    """Start of the week of an epoch second."""
    return second - F.pmod(second, F.lit(WEEK_SECONDS))


class Timeline:
    def __init__(self, rows: Dataset):
        self.rows = rows
        self.spark = rows.spark
        self._status = f"{rows.path}/_status"

    @classmethod
    def create(cls, spark: SparkSession, path: str, schema: T.StructType) -> Timeline:
        """A timeline for rows of ``schema``, to which the slice columns are added."""
        made = cls(Dataset.create(spark, path, T.StructType([*schema, *_PLACE]), _PLACE.names))
        made.close([])
        return made

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> Timeline:
        return cls(Dataset.open(spark, path))

    # -- which slices there are

    def closed(self) -> DataFrame:
        """``slice_start`` of closed slices."""
        return self.spark.read.schema(_STATUS).parquet(self._status).distinct()

    def slices(self) -> DataFrame:
        """``week_start, slice_start, closed`` of all slices with rows or with a status,
        from file names and the status table; no row is read."""
        start = F.regexp_extract("path", "/slice_start=(-?[0-9]+)/", 1).cast("long")
        stored = self.rows.file_frame().select(start.alias("slice_start"), F.lit(False).alias("closed"))
        known = stored.unionByName(self.closed().withColumn("closed", F.lit(True)))
        return (
            known.groupBy("slice_start")
            .agg(F.bool_or("closed").alias("closed"))
            .select(week_of(F.col("slice_start")).alias("week_start"), "slice_start", "closed")
        )

    def span(self, week: int | None = None) -> tuple[int | None, int | None]:
        """First and last closed slice, of all weeks or of one; None where there is none."""
        starts = self.closed()
        if week is not None:
            starts = starts.where(week_of(F.col("slice_start")) == week)
        ends = starts.agg(F.min("slice_start").alias("first"), F.max("slice_start").alias("last")).first()
        return ends["first"], ends["last"]

    # -- rows

    def add(self, rows: DataFrame, start: Column | int) -> None:
        """Add rows to the slices that ``start``, an epoch second, puts them in, all in one
        pass. A row without a slice, or for a slice at or before a closed one, fails the job."""
        start = (F.lit(start) if isinstance(start, int) else start).cast("long")
        last = self.span()[1]
        refused = start.isNull() if last is None else start.isNull() | (start <= last)
        problem = F.concat(F.lit("no open slice starts at "), F.coalesce(start.cast("string"), F.lit("null")))
        place = F.when(refused, F.raise_error(problem).cast("long")).otherwise(start)
        placed = rows.withColumn("slice_start", place)
        self.rows.append(placed.withColumn("week_start", week_of(F.col("slice_start"))))

    def close(self, starts: DataFrame | Iterable[int]) -> None:
        """Make slices readable, given by their starts or as a frame with ``slice_start``.
        A closed slice may be empty."""
        if not isinstance(starts, DataFrame):
            starts = self.spark.createDataFrame([(s,) for s in starts], _STATUS)
        starts.select(F.col("slice_start").cast("long")).coalesce(1).write.mode("append").parquet(self._status)

    def read(self, start: int) -> DataFrame:
        """Rows of one closed slice."""
        if self.closed().where(F.col("slice_start") == start).isEmpty():
            raise ValueError(f"the slice at {start} is not closed")
        week = start - start % WEEK_SECONDS
        return self.rows.read((F.col("week_start") == week) & (F.col("slice_start") == start))

    def read_closed(self) -> DataFrame:
        """Rows of all closed slices."""
        return self.rows.read().join(self.closed(), "slice_start", "left_semi").select(*self.rows.spec.schema.names)

    # -- whole timelines

    def extend(self, other: Timeline, move: bool = False) -> None:
        """Add a timeline whose closed slices are all newer, as a copy, or with ``move`` by
        taking its files where that is possible. Its open slices stay open here."""
        last, first = self.span()[1], other.span()[0]
        if last is not None and first is not None and first <= last:
            raise ValueError(f"slice {first} is not newer than {last}, the last one here")
        (self.rows.absorb if move else self.rows.copy_append)(other.rows)
        self.close(other.closed())

    def consolidate(self, start: int | None = None) -> int:
        """Merge small files inside the slices, of all or of one."""
        if start is None:
            return self.rows.consolidate()
        week = start - start % WEEK_SECONDS
        return self.rows.consolidate(part={"week_start": week, "slice_start": start})
