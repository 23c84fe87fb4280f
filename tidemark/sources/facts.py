"""The raw facts: new data as it comes in, and the master table split by kind."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schema
from tidemark.sources.dataset import Dataset


def _valid_kinds() -> str:
    allowed = [
        f"(unit = {unit} AND value_kind IN ({', '.join(map(str, kinds))}))"
        for unit, kinds in schema.VALUE_KINDS.items()
    ]
    return " OR ".join(allowed)


def open_new_data(spark: SparkSession, path: str) -> Dataset:
    """The dataset that receives facts, unsplit."""
    return Dataset.create(spark, path, schema.FACTS, fail_on_exists=False)


def open_master(spark: SparkSession, path: str) -> Dataset:
    """The dataset of all facts, in one folder per fact kind and property kind."""
    return Dataset.create(
        spark, path, schema.FACTS, ("unit", "value_kind"), _valid_kinds(), fail_on_exists=False
    )


def append_facts(dataset: Dataset, rows: DataFrame, unit: int) -> None:
    """Add rows of one fact kind."""
    dataset.append(schema.to_facts(rows, unit))


def read_kinds(dataset: Dataset, *units: int) -> DataFrame:
    """Facts of the chosen kinds; only their folders are opened."""
    return dataset.read(F.col("unit").isin(*units))


def read_arm(dataset: Dataset, unit: int) -> DataFrame:
    """Facts of one kind with the columns of that kind."""
    return schema.arm(dataset.read(), unit)


def shred(facts: DataFrame) -> DataFrame:
    """Bring facts of a kind together for a split write. A kind that holds most
    of the rows is still spread over many tasks."""
    return facts.hint("rebalance", F.col("unit"), F.col("value_kind"))


def ingest(master: Dataset, new_data: Dataset) -> int:
    """Move the present new data into the master table; returns how many changes were taken.

    The new rows take the place of the changes they come from, so a job that dies and
    runs again neither loses nor repeats facts. Facts that arrive while it runs stay for
    the next time.
    """
    master.settle()
    snapshot = new_data.snapshot()
    if snapshot.changes:
        master.replace(snapshot.read(), snapshot)
    return len(snapshot.changes)
