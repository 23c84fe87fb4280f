"""Append-only partitioned Parquet datasets.

Layout below the root: one folder ``change=<when>-<id>`` per change, each a plain
partitioned Parquet write, and beside them ``_meta`` (the layout and small named texts).
A change is there from the moment Spark's own commit puts ``_SUCCESS`` into its folder, and a
write that dies leaves a folder no reader looks at. Retiring, moving and clearing work on
whole folders, so the driver makes a few calls per change, however many files it has.

A change can take the place of others, also of another dataset's: their names are written into
its folder before its rows, so they are out of date from the same moment on as it is there.
Their folders are deleted afterwards, at the latest by ``settle`` when the dataset is opened next.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.files import can_copy, copy_files, spread_by_folder
from tidemark.sources.fs import FileSystem

# Fixed value: files are merged up to this size.
TARGET_FILE_BYTES = 127 * 1024 * 1024


@dataclass(frozen=True)
class Spec:
    schema: T.StructType
    partitions: tuple[str, ...] = ()
    valid: str | None = None
    codec: str = "zstd"

    def to_text(self) -> str:
        return json.dumps(
            {
                "schema": json.loads(self.schema.json()),
                "partitions": list(self.partitions),
                "valid": self.valid,
                "codec": self.codec,
            }
        )

    @staticmethod
    def from_text(text: str) -> Spec:
        found = json.loads(text)
        return Spec(
            T.StructType.fromJson(found["schema"]),
            tuple(found["partitions"]),
            found["valid"],
            found["codec"],
        )


@dataclass(frozen=True)
class Snapshot:
    """The changes a dataset consisted of at one moment."""

    dataset: Dataset
    changes: tuple[str, ...]

    def read(self) -> DataFrame:
        return self.dataset._read_changes(self.changes)


class Dataset:
    def __init__(self, spark: SparkSession, path: str, spec: Spec):
        self.spark = spark
        self.path = path.rstrip("/")
        self.spec = spec
        self._fs = FileSystem(spark, path)

    # -- creating and opening

    @classmethod
    def create(
        cls,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        partitions: Sequence[str] = (),
        valid: str | None = None,
        codec: str = "zstd",
        fail_on_exists: bool = True,
    ) -> Dataset:
        """A new dataset. ``valid`` is a SQL condition that every row must meet.

        An existing one is an error, or with ``fail_on_exists=False`` is opened,
        in which case its layout must be the same.
        """
        spec = Spec(schema, tuple(partitions), valid, codec)
        made = cls(spark, path, spec)
        found = made._fs.read_text(made._meta("spec.json"))
        if found is not None:
            if fail_on_exists:
                raise FileExistsError(f"a dataset exists at {path}")
            if Spec.from_text(found) != spec:
                raise ValueError(f"the dataset at {path} has another layout")
            return cls.open(spark, path)
        made._fs.mkdirs(made.path)
        made._fs.write_text(made._meta("spec.json"), spec.to_text(), overwrite=False)
        return made

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> Dataset:
        """An existing dataset, after deleting what its changes have replaced."""
        text = FileSystem(spark, path).read_text(f"{path.rstrip('/')}/_meta/spec.json")
        if text is None:
            raise FileNotFoundError(f"no dataset at {path}")
        opened = cls(spark, path, Spec.from_text(text))
        opened.settle()
        return opened

    def empty_copy(self, path: str) -> Dataset:
        """A new empty dataset of the same layout."""
        s = self.spec
        return Dataset.create(self.spark, path, s.schema, s.partitions, s.valid, s.codec)

    # -- named texts

    def _meta(self, name: str) -> str:
        return f"{self.path}/_meta/{name}"

    def set_metadata(self, name: str, text: str) -> None:
        self._fs.mkdirs(f"{self.path}/_meta/text")
        self._fs.write_text(self._meta(f"text/{name}"), text)

    def metadata(self, name: str) -> str | None:
        return self._fs.read_text(self._meta(f"text/{name}"))

    def metadata_names(self) -> list[str]:
        return [n for n in self._fs.list(self._meta("text")) if not n.startswith(".")]

    def delete_metadata(self, name: str) -> bool:
        return self._fs.delete(self._meta(f"text/{name}"))

    # -- reading

    def read(self, where: Column | str | None = None, with_path: bool = False) -> DataFrame:
        """All rows, or the part ``where`` selects; conditions on partition columns
        open only their folders. ``with_path`` adds the file of each row."""
        rows = self._read_changes(self.changes(), with_path)
        return rows if where is None else rows.where(where)

    def changes(self) -> list[str]:
        """Names of the changes that are there, in the order they were begun."""
        complete = [p.rsplit("/", 2)[1] for p in self._fs.glob(self.path, "change=*/_SUCCESS")]
        gone = {folder.rsplit("/", 1)[1] for _, folders in self._replaced(complete) for folder in folders}
        return sorted(set(complete) - gone)

    def _replaced(self, complete: Sequence[str]) -> list[tuple[str, list[str]]]:
        """``(note, folders)`` of complete changes whose note still says which folders they replaced."""
        notes = [p for p in self._fs.glob(self.path, "change=*/_replaces") if p.rsplit("/", 2)[1] in complete]
        return [(note, (self._fs.read_text(note) or "").split("\n")) for note in notes]

    def _read_changes(self, changes: Sequence[str], with_path: bool = False) -> DataFrame:
        names, path = self.spec.schema.names, F.col("_metadata.file_path").alias("path")
        if not changes:
            empty = self.spark.createDataFrame([], self.spec.schema)
            return empty.withColumn("path", F.lit("")) if with_path else empty
        reader = self.spark.read.schema(self.spec.schema).option("basePath", self.path)
        rows = reader.parquet(*[f"{self.path}/{name}" for name in changes])
        return rows.select(*names, path) if with_path else rows.select(*names)

    def file_frame(self) -> DataFrame:
        """``path, length`` of the data files, listed by Spark and not opened."""
        changes = self.changes()
        if not changes:
            return self.spark.createDataFrame([], "path string, length bigint")
        listed = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        return listed.load([f"{self.path}/{name}" for name in changes]).select("path", "length")

    def files(self) -> list[tuple[str, int]]:
        """Data files with their sizes, for a person to look at."""
        return sorted((row["path"], row["length"]) for row in self.file_frame().collect())

    def is_empty(self) -> bool:
        return self.read().isEmpty()

    def __iter__(self) -> Iterator:
        """Rows one by one, fetched a partition at a time, for small datasets."""
        return self.read().toLocalIterator()

    # -- adding rows

    def _checked(self, df: DataFrame) -> DataFrame:
        """Rows in the layout's columns; a row outside the layout fails the job."""
        have = {f.name: f.dataType for f in df.schema.fields}
        want = {f.name: f.dataType for f in self.spec.schema.fields}
        if _shape(have) != _shape(want):
            raise ValueError(f"fields {have} do not fit the dataset's {want}")
        rows = df.select(*self.spec.schema.names)
        if self.spec.valid is None:
            return rows
        problem = F.concat(
            F.lit(f"row outside the layout of {self.path}: "), F.to_json(F.struct(*rows.columns))
        )
        valid = F.coalesce(F.expr(self.spec.valid), F.lit(False))
        return rows.where(F.when(valid, F.lit(True)).otherwise(F.raise_error(problem).cast("boolean")))

    def _add(self, df: DataFrame, replaced: Sequence[str] = ()) -> str:
        """Write a change that takes the place of the folders ``replaced``; returns its name."""
        name = f"change={time.time_ns() // 1_000_000:014d}-{uuid.uuid4().hex}"
        folder, parts = f"{self.path}/{name}", self.spec.partitions
        if replaced:
            self._fs.mkdirs(folder)
            self._fs.write_text(f"{folder}/_replaces", "\n".join(replaced))
        if parts:
            df = spread_by_folder(df, parts)
        writer = df.write.mode("append").option("compression", self.spec.codec)
        (writer.partitionBy(*parts) if parts else writer).parquet(folder)
        if not self._fs.exists(f"{folder}/_SUCCESS"):
            raise FileNotFoundError(f"no _SUCCESS in {folder}: nothing was changed")
        return name

    def append(self, df: DataFrame) -> None:
        """Add rows; each goes to the folder of its partition values."""
        self._add(self._checked(df))

    def copy_append(self, other: Dataset) -> None:
        """Add a copy of another dataset's rows."""
        self.append(other.read())

    def move_append(self, other: Dataset) -> None:
        """Take over another dataset's changes; it is empty afterwards.

        Both must have the same layout and lie in the same file system. Each change is
        renamed as a whole, so after a crash it is in one dataset or in the other.
        """
        if self.spec != other.spec:
            raise ValueError("cannot move files between datasets of different layouts")
        if not self._same_file_system(other):
            raise ValueError("cannot move files between file systems")
        other.settle()
        for name in other.changes():
            self._fs.rename(f"{other.path}/{name}", f"{self.path}/{name}")

    def absorb(self, other: Dataset) -> None:
        """Move another dataset's files if that is possible, otherwise copy the rows."""
        if self.spec == other.spec and self._same_file_system(other):
            self.move_append(other)
        else:
            self.copy_append(other)

    def _same_file_system(self, other: Dataset) -> bool:
        return self._fs._fs.getUri().equals(other._fs._fs.getUri())

    # -- snapshots

    def snapshot(self) -> Snapshot:
        """What there is now. Rows added later are not in it."""
        return Snapshot(self, tuple(self.changes()))

    def delete_snapshot(self, snapshot: Snapshot) -> None:
        """Delete the snapshot's changes and nothing else."""
        for name in snapshot.changes:
            self._fs.delete(f"{self.path}/{name}")

    def clear(self) -> None:
        """Delete all rows; the layout and the named texts stay."""
        self.delete_snapshot(self.snapshot())

    # -- changes in the place of others

    def replace(self, rows: DataFrame, gone: Snapshot) -> None:
        """Add ``rows`` in the place of a snapshot of this or another dataset, as one change."""
        self._add(self._checked(rows), [f"{gone.dataset.path}/{name}" for name in gone.changes])
        self.settle()

    def settle(self) -> None:
        """Delete the folders that complete changes have replaced."""
        complete = [p.rsplit("/", 2)[1] for p in self._fs.glob(self.path, "change=*/_SUCCESS")]
        for note, folders in self._replaced(complete):
            for folder in folders:
                self._fs.delete(folder)
            self._fs.delete(note)

    def drop_unfinished(self) -> None:
        """Delete what writers that failed have left. No writer may be running."""
        self.settle()
        complete = {p.rsplit("/", 2)[1] for p in self._fs.glob(self.path, "change=*/_SUCCESS")}
        for name in self._fs.list(self.path):
            if name.startswith("_copying-") or name.startswith("change=") and name not in complete:
                self._fs.delete(f"{self.path}/{name}")

    # -- upkeep

    def consolidate(
        self, target_bytes: int = TARGET_FILE_BYTES, part: dict[str, object] | None = None
    ) -> int:
        """Merge small files; returns how many were merged.

        A file below half the target is small if its folder has another such file, in all folders or
        those of one ``part``, given by values of leading partition columns. The changes that have
        at least half of their bytes there in such files are written anew as one change.
        Adaptive execution sizes the new files, so a folder of any size is spread over as
        many tasks as it needs.
        """
        inside = ""
        if part:
            if tuple(part) != self.spec.partitions[: len(part)]:
                raise ValueError(f"{list(part)} do not lead the partitions {self.spec.partitions}")
            inside = "/".join(f"{name}={value}" for name, value in part.items()) + "/"
        self.settle()
        files = self.file_frame().select(
            F.regexp_extract("path", "/(change=[^/]+)/", 1).alias("change"),
            F.regexp_extract("path", "/change=[^/]+/(.*)", 1).alias("below"),
            "length",
        ).where(F.startswith("below", F.lit(inside)))
        folder = F.regexp_replace("below", "[^/]*$", "")
        small = F.col("length") < target_bytes / 2
        merged = small & (F.count_if(small).over(Window.partitionBy(folder)) > 1)
        changes = files.select("change", "length", merged.alias("merged")).groupBy("change").agg(
            F.count_if("merged").alias("n"), F.sum(F.when(F.col("merged"), F.col("length"))).alias("bytes"), F.sum("length").alias("all")
        )
        chosen = changes.where("2 * bytes >= all").orderBy("change").collect()  # one row a change
        if sum(row["n"] for row in chosen) < 2:
            return 0
        old = Snapshot(self, tuple(row["change"] for row in chosen))
        # Shuffled rows are larger than their Parquet form, about three to one.
        with _setting(
            self.spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", str(3 * target_bytes)
        ):
            rows = old.read()
            self.replace(rows if self.spec.partitions else rows.hint("rebalance"), old)
        return sum(row["n"] for row in chosen)

    def coerce(self, path: str, codec: str) -> Dataset:
        """A copy under another compression."""
        s = self.spec
        copy = Dataset.create(self.spark, path, s.schema, s.partitions, s.valid, codec)
        copy.copy_append(self)
        return copy

    def copy_to(self, path: str) -> Dataset:
        """A copy of rows and named texts, made by all executors: file by file where they can reach
        both places, as one change that is there when all files are; row by row otherwise."""
        copy = self.empty_copy(path)
        if can_copy(self.path, copy.path):
            copy._copy_files(self)
        else:
            copy.copy_append(self)
        for name in self.metadata_names():
            copy.set_metadata(name, self.metadata(name))
        return copy

    def _copy_files(self, other: Dataset) -> None:
        names = other.changes()
        if not names:
            return
        files = other.file_frame()
        folder = f"{self.path}/_copying-{uuid.uuid4().hex}"
        done = copy_files(files, other.path, folder).agg(F.count(F.lit(1)), F.sum("length")).first()
        if tuple(done) != tuple(files.agg(F.count(F.lit(1)), F.sum("length")).first()):
            raise OSError(f"{other.path} changed while it was copied: nothing was added")
        for name in names:  # one rename a change; the mark that makes it complete comes last
            self._fs.mkdirs(f"{folder}/{name}")
            self._fs.rename(f"{folder}/{name}", f"{self.path}/{name}")
        for name in names:
            self._fs.write_text(f"{self.path}/{name}/_SUCCESS", "")
        self._fs.delete(folder)


def _shape(fields: dict[str, T.DataType]) -> dict[str, str]:
    return {name: kind.simpleString() for name, kind in fields.items()}


class _setting:
    """A session setting for the time of one job."""

    def __init__(self, spark: SparkSession, key: str, value: str):
        self._spark, self._key, self._value = spark, key, value

    def __enter__(self):
        self._before = self._spark.conf.get(self._key, None)
        self._spark.conf.set(self._key, self._value)

    def __exit__(self, *_):
        if self._before is None:
            self._spark.conf.unset(self._key)
        else:
            self._spark.conf.set(self._key, self._before)
