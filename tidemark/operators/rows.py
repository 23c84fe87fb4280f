"""Projections, filters and row functions.

Filter conditions say which rows to *remove*; ``remove`` applies one. An unknown
condition (null) removes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def each(
    df: DataFrame,
    results: dict[str, Column],
    output: str | list[str] = "ALL",
    arguments: list[str] | None = None,
) -> DataFrame:
    """Apply column functions and choose what comes out.

    ``output`` is ALL (input and results), RESULTS, REPLACE (results take the
    place of the fields of the same name), SWAP (results take the place of
    ``arguments``), or a list of field names.
    """
    made = [value.alias(name) for name, value in results.items()]
    if output == "RESULTS":
        return df.select(*made)
    if output == "REPLACE":
        missing = set(results) - set(df.columns)
        if missing:
            raise ValueError(f"no field to replace: {sorted(missing)}")
        return df.withColumns(results)
    if output == "SWAP":
        gone = set(df.columns if arguments is None else arguments)
        return df.select(*[c for c in df.columns if c not in gone], *made)
    clash = set(results) & set(df.columns)
    if clash:
        raise ValueError(f"field names appear twice: {sorted(clash)}")
    everything = df.select("*", *made)
    if output == "ALL":
        return everything
    return everything.select(*output)


#: A row function: gets a batch of argument fields and gives, as often as it likes, the result
#: fields of some rows and beside each the place in the batch of the row it was made from.
RowFunction = Callable[[pa.RecordBatch], Iterable[tuple[Iterable[int], "pa.RecordBatch | pa.Table"]]]


def row_function(function: Callable[..., Iterable[tuple]], results: T.StructType | str, at_once: int = 4096) -> RowFunction:
    """A ``RowFunction`` from a plain one, which gets the arguments of one row and gives any number
    of tuples; results are handed on ``at_once`` rows at a time, so a row may give very many."""
    schema = to_arrow_schema(_struct(results))

    def run(batch: pa.RecordBatch):
        places, made = [], []

        def handed_on():
            columns = zip(*made) if made else [()] * len(schema)
            arrays = [pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)]
            return list(places), pa.RecordBatch.from_arrays(arrays, schema=schema)

        values = zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)))
        for place, row in enumerate(values):
            for result in function(*row):
                places.append(place)
                made.append(result)
                if len(made) >= at_once:
                    yield handed_on()
                    places, made = [], []
        yield handed_on()

    return run


def _struct(fields: T.StructType | str) -> T.StructType:
    return fields if isinstance(fields, T.StructType) else T.StructType.fromDDL(fields)


def each_row(
    df: DataFrame,
    function: RowFunction,
    results: T.StructType | str,
    output: str | list[str] = "ALL",
    arguments: list[str] | None = None,
) -> DataFrame:
    """Apply a function of one's own that gives 0 to n rows for each row.

    The function sees batches of the ``arguments`` (all fields by default), as Arrow
    columns. ``results`` declares its fields. ``output`` chooses what comes out as in
    ``each``; other fields of a row are repeated beside each of its results. Only
    fields that are read or come out are sent to the function's process.
    """
    made = _struct(results)
    twice = {c for c in df.columns if df.columns.count(c) > 1}
    if twice:
        raise ValueError(f"field names appear twice: {sorted(twice)}")
    arguments = list(df.columns if arguments is None else arguments)
    own = {f.name: f for f in df.schema}
    missing = set(arguments) - set(own)
    if missing:
        raise ValueError(f"no such fields: {sorted(missing)}")
    if output == "RESULTS":
        names = made.names
    elif output == "REPLACE":
        if set(made.names) - set(own):
            raise ValueError(f"no field to replace: {sorted(set(made.names) - set(own))}")
        names = list(own)
    elif output == "SWAP":
        names = [c for c in own if c not in arguments] + made.names
    else:
        names = [*own, *made.names] if output == "ALL" else list(output)
        if set(names) - set(own) - set(made.names):
            raise ValueError(f"no such fields: {sorted(set(names) - set(own) - set(made.names))}")
    clash = set(made.names) & set(own) if output not in ("RESULTS", "REPLACE", "SWAP") else ()
    if clash or len(set(names)) < len(names):
        raise ValueError(f"field names appear twice: {sorted(clash) or names}")
    given = {f.name: f for f in made}
    schema = T.StructType([given.get(n) or own[n] for n in names])
    arrow = to_arrow_schema(schema)
    carried = [n for n in names if n not in given]

    def run(batches):
        for batch in batches:
            for places, rows in function(batch.select(arguments)):
                places = pa.array(places, pa.int64())
                if not len(places):
                    continue
                taken = batch.select(carried).take(places) if carried else None
                if rows.num_rows != len(places):
                    raise ValueError(f"{len(places)} places for {rows.num_rows} rows")
                columns = [rows.column(n) if n in given else taken.column(n) for n in names]
                whole = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns]
                yield pa.RecordBatch.from_arrays(
                    [c.cast(f.type) for c, f in zip(whole, arrow, strict=True)], schema=arrow
                )

    needed = [c for c in own if c in arguments or c in carried]
    return df.select(*needed).mapInArrow(run, schema)


def retain(df: DataFrame, *fields: str) -> DataFrame:
    """Keep the named fields only."""
    return df.select(*fields)


def discard(df: DataFrame, *fields: str) -> DataFrame:
    """Drop the named fields."""
    missing = set(fields) - set(df.columns)
    if missing:
        raise ValueError(f"no such fields: {sorted(missing)}")
    return df.drop(*fields)


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename fields; all must exist."""
    missing = set(names) - set(df.columns)
    if missing:
        raise ValueError(f"no such fields: {sorted(missing)}")
    return df.withColumnsRenamed(names)


def identity(df: DataFrame, names: dict[str, str], casts: dict[str, str] | None = None) -> DataFrame:
    """Pass the fields of ``names`` on under new names, cast where asked."""
    from tidemark.functions.coerce import coerce

    passed = df.select(*[F.col(old).alias(new) for old, new in names.items()])
    return coerce(passed, casts) if casts else passed


def insert(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """Add constant fields."""
    return df.select("*", *[F.lit(v).alias(k) for k, v in values.items()])


def set_value(removed: Column, first=True, second=False) -> Column:
    """``first`` where the filter keeps the row, ``second`` where it removes it."""
    return F.when(F.coalesce(removed, F.lit(False)), F.lit(second)).otherwise(F.lit(first))


def expression(text: str) -> Column:
    """A SQL expression over the fields."""
    return F.expr(text)


def remove(df: DataFrame, condition: Column) -> DataFrame:
    """Remove the rows for which ``condition`` is true."""
    return df.where(~F.coalesce(condition, F.lit(False)))


def expression_filter(df: DataFrame, text: str) -> DataFrame:
    """Remove the rows for which the SQL expression is true."""
    return remove(df, F.expr(text))


def any_null(*fields: str) -> Column:
    """Condition: some field is null."""
    return any_of(*[F.col(f).isNull() for f in fields])


def any_present(*fields: str) -> Column:
    """Condition: some field is not null."""
    return any_of(*[F.col(f).isNotNull() for f in fields])


def filter_null(df: DataFrame, *fields: str) -> DataFrame:
    """Remove rows with a null among the fields."""
    return remove(df, any_null(*(fields or df.columns)))


def filter_not_null(df: DataFrame, *fields: str) -> DataFrame:
    """Remove rows with anything but nulls in the fields."""
    return remove(df, any_present(*(fields or df.columns)))


def _sure(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def all_of(*conditions: Column) -> Column:
    """Condition: every condition removes."""
    return reduce(lambda a, b: a & b, [_sure(c) for c in conditions])


def any_of(*conditions: Column) -> Column:
    """Condition: some condition removes."""
    return reduce(lambda a, b: a | b, [_sure(c) for c in conditions])


def negate(condition: Column) -> Column:
    """Condition: the given condition does not remove."""
    return ~_sure(condition)


def one_of(first: Column, second: Column) -> Column:
    """Condition: exactly one of the two removes."""
    return _sure(first) != _sure(second)


def un_group(
    df: DataFrame, group: list[str], values: list[list[str]], names: list[str] | None = None
) -> DataFrame:
    """Wide to long: one row per value selector, each beside the group fields.

    ``names`` names the output, group fields first; by default the group fields
    keep theirs and the values take those of the first selector.
    """
    width = len(values[0])
    if any(len(v) != width for v in values):
        raise ValueError("all value selectors must have the same number of fields")
    names = names or [*group, *values[0]]
    if len(names) != len(group) + width:
        raise ValueError(f"{len(names)} names for {len(group) + width} fields")
    rows = F.array(
        *[
            F.struct(*[F.col(f).alias(n) for f, n in zip(selector, names[len(group):])])
            for selector in values
        ]
    )
    return df.select(*[F.col(g).alias(n) for g, n in zip(group, names)], F.inline(rows))


def un_group_every(df: DataFrame, group: list[str], size: int, names: list[str] | None = None) -> DataFrame:
    """Wide to long: the fields outside the group, ``size`` at a time."""
    rest = [c for c in df.columns if c not in group]
    if len(rest) % size:
        raise ValueError(f"{len(rest)} value fields do not divide by {size}")
    return un_group(df, group, [rest[i : i + size] for i in range(0, len(rest), size)], names)


def limit(df: DataFrame, rows: int) -> DataFrame:
    """At most ``rows`` rows, exactly that many if there are."""
    return df.limit(rows)


def sample(df: DataFrame, fraction: float, seed: int | None = None) -> DataFrame:
    """Keep every row with the same chance."""
    return df.sample(False, fraction, seed)
