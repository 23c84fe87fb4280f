"""Whole tables kept side by side under rising numbers.

A catalogue, one small JSON file, says which numbers can be read and in which
folder each lies. Rows go to a fresh folder first; a number exists from the
moment the catalogue names it and is gone from the moment it does not, so no
reader meets a half-written or half-deleted table. One writer at a time.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.sources.fs import FileSystem

# Fixed value: how many numbers stay when a new one is added.
KEPT = 3


class History:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._fs = FileSystem(spark, root)

    def _catalogue(self) -> dict[int, str]:
        text = self._fs.read_text(f"{self.root}/_catalogue.json")
        return {int(n): folder for n, folder in json.loads(text).items()} if text else {}

    def _list(self, entries: dict[int, str]) -> None:
        self._fs.mkdirs(self.root)
        self._fs.replace_text(f"{self.root}/_catalogue.json", json.dumps(entries, sort_keys=True))

    def numbers(self) -> list[int]:
        """What can be read, oldest first."""
        return sorted(self._catalogue())

    def latest(self, up_to: int | None = None) -> int | None:
        """The highest number, or the highest one not above ``up_to``; None if there is none."""
        return max((n for n in self.numbers() if up_to is None or n <= up_to), default=None)

    def folder(self, number: int) -> str:
        """Where the rows of a number lie."""
        try:
            return f"{self.root}/{self._catalogue()[number]}"
        except KeyError:
            raise FileNotFoundError(f"{self.root} has no number {number}") from None

    @contextmanager
    def adding(self, number: int | None = None) -> Iterator[tuple[int, str]]:
        """A number and an empty folder to fill. Leaving the block lists it; an error
        inside drops the folder and lists nothing. The number defaults to the clock in
        milliseconds, past the highest number there is."""
        if number is None:
            number = max(time.time_ns() // 1_000_000, (self.latest() or 0) + 1)
        if number in self._catalogue():
            raise FileExistsError(f"{self.root} has a number {number}")
        name = f"rows-{uuid.uuid4().hex}"
        try:
            yield number, f"{self.root}/{name}"
            if not self._fs.is_dir(f"{self.root}/{name}"):
                raise FileNotFoundError(f"nothing was written for number {number} of {self.root}")
        except BaseException:
            self._fs.delete(f"{self.root}/{name}")
            raise
        self._list(self._catalogue() | {number: name})

    def add(self, rows: DataFrame, number: int | None = None, keep: int | None = KEPT) -> int:
        """Store a frame under a new number and keep the ``keep`` highest (None: all)."""
        with self.adding(number) as (number, folder):
            rows.write.parquet(folder)
        if keep is not None:
            self.trim(keep)
        return number

    def forget(self, numbers: Iterable[int]) -> None:
        """Delete numbers; unknown ones are passed over."""
        entries = self._catalogue()
        gone = {n: entries.pop(n) for n in set(numbers) if n in entries}
        if gone:
            self._list(entries)
        for name in gone.values():
            self._fs.delete(f"{self.root}/{name}")

    def trim(self, keep: int) -> None:
        """Keep the ``keep`` highest numbers; a negative count keeps all."""
        if keep >= 0:
            known = self.numbers()
            self.forget(known[: max(len(known) - keep, 0)])

    def read(self, number: int | None = None, schema: T.StructType | None = None) -> DataFrame:
        """Rows of a number, of the highest one by default."""
        number = self.latest() if number is None else number
        if number is None:
            raise FileNotFoundError(f"{self.root} is empty")
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(self.folder(number))
