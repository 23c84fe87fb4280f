"""Counters and debug output that ride along with a job."""

from __future__ import annotations

import uuid
from collections import defaultdict
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def counter(df: DataFrame, name: str, **counters: Column) -> tuple[DataFrame, Observation]:
    """Count rows, and rows that meet each condition, while the frame is used.

    Read ``observed(observation)`` after an action. Rows of a task that ran twice are
    counted twice, so the numbers are for reports, not for results.
    """
    seen = Observation(name)
    sums = [
        F.coalesce(F.sum(F.coalesce(v, F.lit(False)).cast("bigint")), F.lit(0)).alias(k)
        for k, v in counters.items()
    ]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *sums), seen


class Counters:
    """Named counters in named groups, increased by the rows of any number of frames.

    ``count`` watches a frame: whenever it is used, each counter grows by its increment for
    every row. An increment is a number, a condition (1 where it is true) or a column of
    numbers; null adds nothing. ``values`` has the sums after the actions. Every watched
    frame must have been used once by then. The sums are made where the rows are and come
    with the finished tasks, so rows of a task that ran twice count twice, and so do those
    of a frame that is used twice: the numbers are for reports, not for results.
    """

    def __init__(self):
        self._seen: dict[str, list[Observation]] = defaultdict(list)
        self._names: dict[str, dict[str, None]] = defaultdict(dict)

    def count(self, df: DataFrame, group: str = "rows", **increments: Column | int) -> DataFrame:
        """The same rows, counted into ``group`` when used; without increments they count as ``rows``."""
        own = increments or {"rows": 1}
        for name in own:
            self._names[group][name] = None
        seen = Observation(f"{group}-{uuid.uuid4().hex}")
        self._seen[group].append(seen)
        return df.observe(seen, *[self._sum(df, value).alias(name) for name, value in own.items()])

    @staticmethod
    def _sum(df: DataFrame, value: Column | int) -> Column:
        if isinstance(value, int):
            return F.count(F.lit(1)) * value
        kind = df.select(value).schema[0].dataType.typeName()
        amount = value.cast("bigint") if kind == "boolean" else value
        return F.coalesce(F.sum(amount), F.lit(0)).cast("bigint")

    def values(self) -> dict[str, dict[str, int]]:
        """The sums by group and name. Frames that Spark found to be empty add nothing."""
        sums = {group: dict.fromkeys(names, 0) for group, names in self._names.items()}
        for group, seen in self._seen.items():
            for one in seen:
                for name, value in observed(one).items():
                    sums[group][name] += value
        return sums


def debug(df: DataFrame, name: str = "debug", on: bool = True) -> tuple[DataFrame, Observation | None]:
    """A one per row, with the row count observed; switched off, the plan is as
    if it had not been asked for."""
    if not on:
        return df, None
    seen = Observation(name)
    observed = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    return observed.select("*", F.lit(1).alias("debug")), seen


def peek(df: DataFrame, rows: int = 20) -> list[str]:
    """A few rows as text, for a person to look at."""
    return [str(row) for row in df.take(rows)]


def observed(seen: Observation) -> dict:
    """What was observed; empty if the plan was found to have no rows at all, in
    which case Spark runs nothing that could be observed."""
    try:
        return seen.get
    except Py4JJavaError as problem:
        if "AssertionError" not in str(problem.java_exception.getClass().getName()):
            raise
        return {}


def status_tag(text: str) -> str:
    """The job tag that stands for a status; tags can hold no commas."""
    return f"status: {text}".replace(",", ";")


@contextmanager
def status(spark: SparkSession, text: str):
    """Give the jobs started inside ``text`` as their status: it is their description, and a tag
    that ``job_states`` and ``SparkContext.cancelJobsWithTag`` find them by."""
    context = spark.sparkContext
    before = context.getLocalProperty("spark.job.description")
    known = status_tag(text) in context.getJobTags()
    context.setJobDescription(text)
    context.addJobTag(status_tag(text))
    try:
        yield
    finally:
        context.setLocalProperty("spark.job.description", before)
        if not known:
            context.removeJobTag(status_tag(text))


def job_states(spark: SparkSession, text: str) -> dict[int, str]:
    """State of each known job that was started under a status: RUNNING, SUCCEEDED, FAILED or UNKNOWN."""
    tracker = spark.sparkContext._jsc.sc().statusTracker()
    ids = tracker.getJobIdsForTag(status_tag(text))
    infos = {int(job): spark.sparkContext.statusTracker().getJobInfo(int(job)) for job in ids}
    return {job: info.status if info else "UNKNOWN" for job, info in infos.items()}
