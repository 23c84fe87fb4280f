"""Assertions on rows and groups, and traps for the rows that fail.

A rule is a boolean column that says the row is fine, with a level. Running at a
weaker level leaves the stronger rules out of the plan altogether.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from enum import IntEnum
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import field_join


class Level(IntEnum):
    NONE = 0
    VALID = 1
    STRICT = 2


@dataclass(frozen=True)
class Rule:
    name: str
    passes: Column
    level: Level = Level.STRICT
    fields: tuple[str, ...] = ()

    def ok(self) -> Column:
        return F.coalesce(self.passes, F.lit(False))


class AssertionFailed(ValueError):
    """A frame's fields break a size rule."""


def _all(conditions) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def _any(conditions) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def equals(fields: Sequence[str], values: Sequence, level: Level = Level.STRICT) -> Rule:
    """The fields together equal the values."""
    same = _all(F.col(f).eqNullSafe(F.lit(v)) for f, v in zip(fields, values, strict=True))
    return Rule("equals", same, level, tuple(fields))


def not_equals(fields: Sequence[str], values: Sequence, level: Level = Level.STRICT) -> Rule:
    """The fields together differ from the values."""
    return Rule("not_equals", ~equals(fields, values).passes, level, tuple(fields))


def equals_all(fields: Sequence[str], value, level: Level = Level.STRICT) -> Rule:
    """Every field equals the one value."""
    return Rule("equals_all", _all(F.col(f).eqNullSafe(F.lit(value)) for f in fields), level, tuple(fields))


def all_null(fields: Sequence[str], level: Level = Level.STRICT) -> Rule:
    """Every field is null."""
    return Rule("null", _all(F.col(f).isNull() for f in fields), level, tuple(fields))


def none_null(fields: Sequence[str], level: Level = Level.STRICT) -> Rule:
    """No field is null."""
    return Rule("not_null", _all(F.col(f).isNotNull() for f in fields), level, tuple(fields))


def matches(fields: Sequence[str], pattern: str, negate: bool = False, level: Level = Level.STRICT) -> Rule:
    """The pattern is found in the tab-joined fields, or is not when negated."""
    return Rule("matches", field_join(*fields).rlike(pattern) != F.lit(negate), level, tuple(fields))


def matches_all(fields: Sequence[str], pattern: str, negate: bool = False, level: Level = Level.STRICT) -> Rule:
    """The pattern is found in every field, or in none when negated."""
    found = [F.coalesce(F.col(f).cast("string"), F.lit("")).rlike(pattern) for f in fields]
    return Rule("matches_all", _all(one != F.lit(negate) for one in found), level, tuple(fields))


def holds(expression: str | Column, level: Level = Level.STRICT, fields: Sequence[str] = ()) -> Rule:
    """A boolean expression is true. ``fields`` are shown when it is not."""
    column = F.expr(expression) if isinstance(expression, str) else expression
    return Rule("expression", column, level, tuple(fields))


def _active(rules: Sequence[Rule], level: Level) -> list[Rule]:
    return [r for r in rules if Level.NONE < r.level <= level]


def enforce(df: DataFrame, rules: Sequence[Rule], level: Level = Level.STRICT) -> DataFrame:
    """Pass all rows on; the job fails at the first row that breaks a rule.

    The message shows the rule's own fields only, so that no other column has to
    be read for its sake.
    """
    checked = df
    for rule in _active(rules, level):
        problem = F.lit(f"assertion {rule.name} failed")
        if rule.fields:
            problem = F.concat(problem, F.lit(": "), F.to_json(F.struct(*rule.fields)))
        checked = checked.where(
            F.when(rule.ok(), F.lit(True)).otherwise(F.raise_error(problem).cast("boolean"))
        )
    return checked


def broken_rules(rules: Sequence[Rule]) -> Column:
    """Names of the rules a row breaks, as an array."""
    names = F.array(*[F.when(~r.ok(), F.lit(r.name)) for r in rules]) if rules else F.array()
    return F.filter(names.cast("array<string>"), lambda name: name.isNotNull())


def trap(
    df: DataFrame, rules: Sequence[Rule], level: Level = Level.STRICT
) -> tuple[DataFrame, DataFrame]:
    """``(good, rejected)``: rejected rows stay whole, with ``broken`` beside them."""
    active = _active(rules, level)
    fine = _all(r.ok() for r in active)
    rejected = df.where(~fine).withColumn("broken", broken_rules(active))
    return df.where(fine), rejected


def write_with_trap(
    df: DataFrame, rules: Sequence[Rule], path: str, level: Level = Level.STRICT, mode: str = "errorifexists"
) -> tuple[DataFrame, DataFrame]:
    """Check and write in a single pass over the input.

    Good and rejected rows go to two partitions of one table, which come back as
    two frames.
    """
    active = _active(rules, level)
    flagged = df.withColumn("broken", broken_rules(active)).withColumn(
        "rejected", (F.size("broken") > 0).cast("int")
    )
    flagged.write.mode(mode).partitionBy("rejected").parquet(path)
    stored = df.sparkSession.read.schema(flagged.schema).parquet(path)
    good = stored.where("rejected = 0").select(*df.columns)
    rejected = stored.where("rejected = 1").select(*df.columns, "broken")
    return good, rejected


_COMPARE = {
    "equals": lambda n, size: n == size,
    "less_than": lambda n, size: n < size,
    "more_than": lambda n, size: n > size,
}


def check_size(df: DataFrame, comparison: str, size: int) -> DataFrame:
    """The number of fields, known from the schema, compares as asked."""
    if not _COMPARE[comparison](len(df.columns), size):
        raise AssertionFailed(f"{len(df.columns)} fields, expected {comparison} {size}")
    return df


def group_size_ok(
    count: Column, keys: Sequence[str], comparison: str, size: int, pattern: str | None = None
) -> Column:
    """Whether a group's row count is as asked. With a pattern, only groups whose
    tab-joined key matches it as a whole are looked at."""
    ok = _COMPARE[comparison](count, size)
    if pattern is None:
        return ok
    return ~field_join(*keys).rlike(rf"\A(?:{pattern})\z") | ok


def group_size_failures(
    df: DataFrame, keys: Sequence[str], comparison: str, size: int, pattern: str | None = None
) -> DataFrame:
    """The groups that break a size rule, with their ``group_size``."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("group_size"))
    return sizes.where(~group_size_ok(F.col("group_size"), keys, comparison, size, pattern))


def aggregate_checked(
    df: DataFrame,
    keys: Sequence[str],
    aggregates: dict[str, Column],
    comparison: str,
    size: int,
    pattern: str | None = None,
) -> DataFrame:
    """Aggregates over groups whose size is checked in the same pass; the job
    fails at the first group that breaks the rule."""
    grouped = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_size"), *[v.alias(k) for k, v in aggregates.items()]
    )
    ok = group_size_ok(F.col("_size"), keys, comparison, size, pattern)
    problem = F.concat(
        F.lit(f"group size is not {comparison} {size}: "), F.to_json(F.struct(*keys, "_size"))
    )
    checked = grouped.where(
        F.when(ok, F.lit(True)).otherwise(F.raise_error(problem).cast("boolean"))
    )
    return checked.drop("_size")


