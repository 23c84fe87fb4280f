"""What the operators of this subpackage share: tables, folds, session figures."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.scratch import Scratch


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    find_package(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def find_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it."""
    home = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if home not in known.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{home}:{known}".strip(":")


def fold(column: str, modulus: int) -> Column:
    """``crc32`` of the id as text, modulo ``modulus``; a null id counts as empty text."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return (F.crc32(text.cast("binary")) % modulus).cast("int")


def scratch(spark: SparkSession, label: str) -> Scratch:
    return Scratch(spark, label)


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def rows(batches: Iterable[pa.RecordBatch], *columns: str) -> Iterator[tuple]:
    """Rows of Arrow batches as tuples of Python values, a slice at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, 512):
            piece = batch.slice(start, 512)
            yield from zip(*(piece.column(c).to_pylist() for c in columns), strict=True)


def batch_of(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )
