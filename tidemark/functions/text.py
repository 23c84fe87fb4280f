"""Regular-expression and text columns. Null text reads as empty text."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _text(value) -> Column:
    column = F.col(value) if isinstance(value, str) else value
    return F.coalesce(column.cast("string"), F.lit(""))


def field_join(*fields, delimiter: str = "\t") -> Column:
    """All fields as text with a delimiter between them; null is empty text."""
    return F.concat_ws(delimiter, *[_text(f) for f in fields])


def field_format(pattern: str, *fields) -> Column:
    """printf-style text; null prints as ``null``."""
    return F.format_string(pattern, *[F.col(f) if isinstance(f, str) else f for f in fields])


def regex_removes(pattern: str, *fields, remove_match: bool = False, each: bool = False) -> Column:
    """Whether a regex filter removes the row.

    The pattern is looked for in the tab-joined fields, or with ``each`` in every
    field, where one bad field is enough. ``remove_match`` turns the test round.
    """
    if not each:
        return field_join(*fields).rlike(pattern) == F.lit(remove_match)
    removed = F.lit(False)
    for field in fields:
        removed = removed | (_text(field).rlike(pattern) == F.lit(remove_match))
    return removed


def regex_filter(
    df: DataFrame, pattern: str, *fields: str, remove_match: bool = False, each: bool = False
) -> DataFrame:
    """Keep the rows in which the pattern is found."""
    fields = fields or tuple(df.columns)
    return df.where(~regex_removes(pattern, *fields, remove_match=remove_match, each=each))


def regex_groups(field, pattern: str, groups: list[int] | None = None, strict: bool = True) -> list[Column]:
    """One column per group of the first match.

    Without ``groups`` all groups are given, or the whole match if there are
    none. Text without a match raises, or gives nulls when not ``strict``. A group
    that took no part in the match gives empty text.
    """
    text = _text(field)
    found = text.rlike(pattern)
    if groups is None:
        groups = list(range(1, _group_count(pattern) + 1)) or [0]
    failed = F.lit(None).cast("string")
    if strict:
        failed = F.raise_error(F.concat(F.lit(f"no match for {pattern}: "), text)).cast("string")
    return [F.when(found, F.regexp_extract(text, pattern, g)).otherwise(failed) for g in groups]


def _group_count(pattern: str) -> int:
    # Python only counts the groups, so Java's own spellings are made neutral.
    neutral = re.sub(r"\(\?<(?=[A-Za-z])", "(?P<", pattern).replace("\\z", "\\Z")
    return re.compile(neutral).groups


def regex_parse(
    df: DataFrame,
    field: str,
    pattern: str,
    names: list[str],
    groups: list[int] | None = None,
    strict: bool = True,
) -> DataFrame:
    """Add the groups of the first match as columns ``names``."""
    columns = regex_groups(field, pattern, groups, strict)
    if len(columns) != len(names):
        raise ValueError(f"{len(names)} names for {len(columns)} groups")
    return df.withColumns(dict(zip(names, columns)))


def regex_replace(field, pattern: str, replacement: str, every: bool = True) -> Column:
    """Replace all matches, or only the first one."""
    text = _text(field)
    if every:
        return F.regexp_replace(text, pattern, replacement)
    # A group for the text before the match shifts the caller's groups by one.
    digits = r"(\d)" if _group_count(pattern) < 9 else r"(\d\d?)"
    moved = re.sub(r"(?<!\\)\$" + digits, lambda m: f"${int(m.group(1)) + 1}", replacement)
    inner = re.sub(r"(?<!\\)\\([1-9])", lambda m: f"\\{int(m.group(1)) + 1}", pattern)
    return F.regexp_replace(text, rf"\A((?s:.*?))(?:{inner})", "$1" + moved)


def regex_split(field, pattern: str, count: int | None = None) -> Column:
    """Array of the parts; ``count`` limits it and puts the rest in the last part."""
    return F.split(_text(field), pattern, -1 if count is None else count)


def regex_split_columns(df: DataFrame, field: str, pattern: str, names: list[str]) -> DataFrame:
    """Add the parts as columns ``names``; a missing part is null."""
    parts = regex_split(field, pattern, len(names))
    return df.withColumns({name: F.get(parts, F.lit(i)) for i, name in enumerate(names)})


def regex_split_rows(df: DataFrame, field: str, pattern: str, name: str) -> DataFrame:
    """One row per part. Empty parts at the end are dropped; empty text gives one
    empty part."""
    text = _text(field)
    parts = F.split(text, pattern, -1)
    # Last non-empty position, found without a Python step.
    filled = F.transform(parts, lambda part, i: F.when(part != "", i + 1))
    last = F.coalesce(F.array_max(filled), F.lit(0))
    kept = F.when(text == "", F.array(F.lit(""))).otherwise(F.slice(parts, F.lit(1), last))
    return df.select("*", F.explode(kept).alias(name))


def regex_generate(df: DataFrame, field: str, pattern: str, name: str) -> DataFrame:
    """One row per match of the pattern."""
    return df.select(
        "*", F.explode(F.regexp_extract_all(_text(field), F.lit(pattern), F.lit(0))).alias(name)
    )
