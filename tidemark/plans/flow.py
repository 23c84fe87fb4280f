"""Parts of a multi-step job: checkpoints, skip rules and row counters."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession

from tidemark.operators.observing import counter, observed
from tidemark.sources.fs import FileSystem
from tidemark.sources.scratch import Scratch


def checkpoint(df: DataFrame, scratch: Scratch | None = None, sink: str | None = None, name: str = "checkpoint") -> DataFrame:
    """Store the frame here and go on from the stored rows.

    The rows go to ``sink`` if one is named, and stay there; otherwise to a table
    in the shared folder.
    """
    if sink is None:
        return (scratch or Scratch(df.sparkSession)).save(df, name)
    df.write.mode("errorifexists").parquet(sink)
    return df.sparkSession.read.schema(df.schema).parquet(sink)


def sinks_exist(spark: SparkSession, sinks: Iterable[str]) -> bool:
    """Skip rule: every sink is there."""
    return all(FileSystem(spark, s).exists(s) for s in sinks)


def sinks_fresh(spark: SparkSession, sources: Iterable[str], sinks: Iterable[str]) -> bool:
    """Skip rule: every sink is there and no source is newer than the oldest."""
    oldest = min((FileSystem(spark, s).modified(s) for s in sinks), default=0)
    if oldest == 0:
        return False
    for source in sources:
        newest = FileSystem(spark, source).modified(source)
        if newest == 0:
            raise FileNotFoundError(source)
        if newest > oldest:
            return False
    return True


def run_unless(skip: bool, job: Callable[[], object]):
    """Run a job unless its skip rule holds; returns its result, or None."""
    return None if skip else job()


class RowCounters:
    """Rows read, written and trapped by one job."""

    def __init__(self, name: str = "rows"):
        self._name = name
        self._seen = {}

    def _watch(self, kind: str, df: DataFrame, **conditions: Column) -> DataFrame:
        watched, seen = counter(df, f"{self._name}-{kind}", **conditions)
        self._seen[kind] = seen
        return watched

    def read(self, df: DataFrame) -> DataFrame:
        return self._watch("read", df)

    def written(self, df: DataFrame) -> DataFrame:
        return self._watch("written", df)

    def trapped(self, df: DataFrame) -> DataFrame:
        return self._watch("trapped", df)

    def get(self) -> dict[str, int]:
        """The counts, after the actions that use the watched frames."""
        return {kind: observed(seen).get("rows", 0) for kind, seen in self._seen.items()}


def assemble(df: DataFrame, *steps: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Put reusable parts, functions from frame to frame, one after the other."""
    for step in steps:
        df = df.transform(step)
    return df
