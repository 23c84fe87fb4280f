"""The published views that readers see.

Every batch writes each view whole, as a new version. One catalogue entry names the
live version of all views; going live is one rename of its file, so a reader of it
sees all views of the old batch or all of the new one and never a mixture.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.fs import FileSystem
from tidemark.sources.history import History

# The names of the views, and the pair of speed view sets.
PAGE_VIEW_VIEW = "page-view"
UNIQUE_VIEW = "unique-view"
BOUNCE_VIEW = "bounce-view"
VIEWS = (PAGE_VIEW_VIEW, UNIQUE_VIEW, BOUNCE_VIEW)
FIRST_SPEED_SET = 1


@dataclass(frozen=True)
class Served:
    """The views of one batch. They stay the same when a later batch goes live, until their
    versions are dropped."""

    views: BatchViews
    versions: dict[str, int]

    def read(self, view: str) -> DataFrame:
        return self.views._store(view).read(self.versions[view])

    def register(self) -> None:
        """Make the views readable from SQL, as page_view, unique_view and bounce_view."""
        for view in VIEWS:
            self.read(view).createOrReplaceTempView(view.replace("-", "_"))


class BatchViews:
    def __init__(self, spark: SparkSession, root: str, keep: int = 3):
        self.spark = spark
        self.root = root.rstrip("/")
        self.keep = keep
        self._fs = FileSystem(spark, root)

    def _store(self, view: str) -> History:
        if view not in VIEWS:
            raise ValueError(f"unknown view {view!r}")
        return History(self.spark, f"{self.root}/{view}")

    def _entry(self, name: str) -> dict[str, int]:
        return json.loads(self._fs.read_text(f"{self.root}/_{name}.json") or "{}")

    def _enter(self, name: str, versions: dict[str, int]) -> None:
        self._fs.mkdirs(self.root)
        self._fs.replace_text(f"{self.root}/_{name}.json", json.dumps(versions, sort_keys=True))

    def publish(self, view: str, rows: DataFrame) -> int:
        """Write the next version of a view; readers do not see it yet."""
        version = self._store(view).add(rows, keep=None)
        self._enter("next", self._entry("next") | {view: version})
        return version

    def live_version(self, view: str) -> int | None:
        return self._entry("live").get(view)

    def live(self) -> Served:
        """All views of the batch that is live now."""
        versions = self._entry("live")
        if not versions:
            raise FileNotFoundError(f"nothing is live at {self.root}")
        return Served(self, versions)

    def replace(self) -> dict[str, int]:
        """Let the next version of every view go live at once, then drop old versions.

        All views must have a next version, or nothing changes. Errors are raised.
        """
        coming = self._entry("next")
        missing = [view for view in VIEWS if view not in coming]
        if missing:
            raise RuntimeError(f"views without a new version: {missing}")
        for view, version in coming.items():
            if version not in self._store(view).numbers():
                raise RuntimeError(f"{view}: version {version} is not finished")
        self._enter("live", coming)
        for view in VIEWS:
            store = self._store(view)
            older = [v for v in store.numbers() if v < coming[view]]
            store.forget(older[: max(len(older) - max(self.keep - 1, 0), 0)])
        return coming

    def read(self, view: str) -> DataFrame:
        """The live rows of one view; who reads several takes them from one ``live()``."""
        if view not in VIEWS:
            raise ValueError(f"unknown view {view!r}")
        version = self.live_version(view)
        if version is None:
            raise FileNotFoundError(f"{view} has no live version")
        return self._store(view).read(version)

    def register(self) -> None:
        """Make the views that are live now readable from SQL, all of one batch."""
        self.live().register()


class SpeedViews:
    """Two sets of views that a real-time layer fills in turn; a batch empties the
    set whose rows its result now covers."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._fs = FileSystem(spark, root)

    def path(self, view: str, number: int) -> str:
        return f"{self.root}/{view}_{number}"

    def current(self) -> int:
        text = self._fs.read_text(f"{self.root}/_current")
        return int(text) if text else FIRST_SPEED_SET

    def update(self) -> int:
        """Empty the current set and switch to the other; returns the number now
        current. The columns of an emptied table stay."""
        number = self.current()
        for view in VIEWS:
            path = self.path(view, number)
            if self._fs.exists(path):
                columns = self.spark.read.parquet(path).schema
                empty = self.spark.createDataFrame([], columns)
                empty.write.mode("overwrite").parquet(path)
        self._fs.mkdirs(self.root)
        self._fs.replace_text(f"{self.root}/_current", str(1 - number))
        return 1 - number
