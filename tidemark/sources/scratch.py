"""Intermediate tables in the shared checkpoint folder.

A written table cuts lineage and survives the loss of any executor. It is also
cheaper than ``DataFrame.checkpoint``, which computes its input twice.
"""

from __future__ import annotations

import atexit
import re
import uuid

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.fs import FileSystem


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``.

    Where it is unset, a folder of the session's default file system is made and
    remembered in the session. Executors on other machines would not see a folder of
    this one, so on a cluster the default file system must not be the local one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    store = FileSystem(spark, "/")
    one_machine = re.fullmatch(r"local(\[[^-]*\])?", spark.sparkContext.master)
    if store.uri().startswith("file:") and not one_machine:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    spark.sparkContext.setCheckpointDir(f"{store.uri().rstrip('/')}/tmp/tidemark-{uuid.uuid4().hex}")
    return spark.sparkContext.getCheckpointDir()


class Scratch:
    """A private folder for one run's intermediate tables.

    Whoever made it closes it when its tables are no longer read. One that nobody closes, as
    that of a checkpoint whose frame goes on to be used, is deleted when the driver ends.
    """

    def __init__(self, spark: SparkSession, label: str = "run"):
        self.spark = spark
        self.root = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
        self._fs = FileSystem(spark, self.root)
        self._count = 0
        atexit.register(self._left)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` as Parquet and return the table read back."""
        self._count += 1
        target = self.path(f"{self._count:04d}-{name}")
        df.write.mode("errorifexists").parquet(target)
        saved = self.spark.read.schema(df.schema).parquet(target)
        saved._tidemark_path = target
        return saved

    def drop(self, saved: DataFrame) -> None:
        """Delete a table made by ``save``."""
        target = getattr(saved, "_tidemark_path", None)
        if target and target.startswith(self.root):
            self._fs.delete(target)

    def close(self) -> None:
        """Delete the whole folder. Frames read from it are unusable afterwards."""
        self._fs.delete(self.root)
        atexit.unregister(self._left)

    def _left(self) -> None:
        try:
            self._fs.delete(self.root)
        except Exception:  # noqa: BLE001 - the JVM may be gone already
            pass
