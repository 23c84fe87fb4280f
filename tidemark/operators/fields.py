"""Lists of fields, by name or by position; positions may count from the end."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Selector = Sequence[str | int]


def resolve(columns: Sequence[str], selector: Selector) -> list[str]:
    """Names behind a selector; an unknown name or position is an error."""
    names = []
    for item in selector:
        if isinstance(item, int):
            if not -len(columns) <= item < len(columns):
                raise ValueError(f"no field at {item} in {list(columns)}")
            names.append(columns[item])
        elif item in columns:
            names.append(item)
        else:
            raise ValueError(f"no field {item!r} in {list(columns)}")
    return names


def select(df: DataFrame, selector: Selector) -> DataFrame:
    return df.select(*resolve(df.columns, selector))


def subtract(columns: Sequence[str], selector: Selector) -> list[str]:
    """The fields that are not selected."""
    gone = set(resolve(columns, selector))
    return [c for c in columns if c not in gone]


def append(columns: Sequence[str], more: Sequence[str]) -> list[str]:
    """Both lists in order; a name in both is an error."""
    twice = set(columns) & set(more)
    if twice:
        raise ValueError(f"field names appear twice: {sorted(twice)}")
    return [*columns, *more]


def merge(*lists: Sequence[str]) -> list[str]:
    """All names once, in the order they come up."""
    return list(dict.fromkeys(name for names in lists for name in names))


def rename(columns: Sequence[str], selector: Selector, to: Sequence[str]) -> list[str]:
    """The list with the selected fields under other names."""
    changes = dict(zip(resolve(columns, selector), to, strict=True))
    return [changes.get(c, c) for c in columns]


def project(df: DataFrame, selector: Selector, names: Sequence[str]) -> DataFrame:
    """The selected fields under new names."""
    chosen = resolve(df.columns, selector)
    return df.select(*[F.col(c).alias(n) for c, n in zip(chosen, names, strict=True)])
