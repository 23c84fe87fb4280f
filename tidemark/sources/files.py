"""File sources and sinks: text, delimited text, typed tables, key/value pairs."""

from __future__ import annotations

import re
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import accumulate, chain, pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.coerce import coerce_column
from tidemark.functions.text import field_join

# What to do when the target is there already.
SINK_MODES = {"KEEP": "errorifexists", "REPLACE": "overwrite", "UPDATE": "append"}
COMPRESSION = {"DEFAULT": None, "ENABLE": "gzip", "DISABLE": "none"}


def _paths(path: str | Sequence[str]) -> list[str]:
    found = [path] if isinstance(path, str) else list(path)
    for one in found:
        if one.lower().endswith(".zip"):
            raise ValueError(f"zip archives cannot be read in parts: {one}")
    return found


def read_lines(
    spark: SparkSession, path: str | Sequence[str], pattern: str | None = None, order_key: str | None = None
) -> DataFrame:
    """Text lines as ``line``. Paths may hold wildcards; ``pattern`` filters file
    names. ``order_key`` adds an id that rises along each file; ``read_offsets`` gives
    byte offsets."""
    reader = spark.read
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    lines = reader.text(_paths(path)).select(F.col("value").alias("line"))
    return lines.withColumn(order_key, F.monotonically_increasing_id()) if order_key else lines


def _offsets_in_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines with the bytes of all lines before them in their block of a file. A task reads a
    block in one go, so a line of another block or the first line begins anew."""
    block, so_far = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = batch.column("size").to_numpy()
        begins = batch.column("start").to_numpy()
        paths = batch.column("path").dictionary_encode()
        codes = paths.indices.to_numpy()
        edges = np.flatnonzero((codes[1:] != codes[:-1]) | (begins[1:] != begins[:-1])) + 1
        before = np.cumsum(sizes) - sizes
        for start, end in pairwise([0, *edges.tolist(), len(sizes)]):
            here = (paths.dictionary[int(codes[start])].as_py(), int(begins[start]))
            so_far = so_far if here == block else 0
            block = here
            shift = so_far - before[start]
            so_far = int(before[end - 1] + sizes[end - 1] + shift)
            before[start:end] += shift
        lines, rows = batch.column("line"), None
        if pc.any(pc.match_substring(lines, "\r")).as_py():
            parts = [_ended_by_returns(line) for line in lines.view(pa.binary()).to_pylist()]
            rows = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
            lines = pa.array([line for own in parts for _, line in own], pa.binary()).view(pa.string())
            before = before[rows] + np.array([skip for own in parts for skip, _ in own], dtype=np.int64)
        kept = [batch.column(c) if rows is None else batch.column(c).take(pa.array(rows)) for c in ("path", "start")]
        yield pa.RecordBatch.from_arrays([lines, *kept, pa.array(before)], names=["line", "path", "start", "before"])


def _ended_by_returns(line: bytes) -> list[tuple[int, bytes]]:
    """``(place, line)`` of the lines in what a line feed ended: carriage returns inside end lines too, and
    one at the end is part of the line break."""
    parts = line.split(b"\r")
    if len(parts) > 1 and not parts[-1]:
        parts.pop()
    places = accumulate((len(p) + 1 for p in parts[:-1]), initial=0)
    return list(zip(places, parts, strict=True))


def read_offsets(spark: SparkSession, path: str | Sequence[str], pattern: str | None = None, with_path: bool = False) -> DataFrame:
    """Text lines as ``offset, line``: the place of the line's first byte in its file, or in the
    unpacked text of a compressed one. ``with_path`` adds the file.

    Lines end with a line feed, a carriage return, or both; what ended a line is not in it, but
    counts as bytes. An end of file after a line break begins no line. Offsets are a distributed
    prefix sum: bytes are summed up within each block where it is read, the totals of the blocks (one row
    each) are summed per file, and a line's offset is its place in the block beyond the
    blocks before. So the lines themselves are read twice and not shuffled. A path listed
    twice is read once.
    """
    reader = spark.read.option("lineSep", "\n")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    placed = reader.text(list(dict.fromkeys(_paths(path)))).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        (F.octet_length("value") + 1).cast("bigint").alias("size"),
    )
    totals = placed.groupBy("path", "start").agg(F.sum("size").alias("bytes"))
    earlier = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    firsts = totals.select(
        F.col("path").alias("file"), F.col("start").alias("block"), F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("first")
    )
    summed = placed.mapInArrow(_offsets_in_block, "line string, path string, start bigint, before bigint")
    found = summed.join(firsts, (F.col("path") == F.col("file")) & (F.col("start") == F.col("block")))
    return found.select((F.col("first") + F.col("before")).alias("offset"), "line", *(["path"] if with_path else []))


def write_lines(
    df: DataFrame, path: str, mode: str = "KEEP", compression: str = "DEFAULT", parts: int | None = None
) -> None:
    """Rows as tab-joined text lines."""
    lines = df.select(field_join(*df.columns).alias("value"))
    if parts:
        lines = lines.repartition(parts)
    writer = lines.write.mode(SINK_MODES[mode])
    if COMPRESSION[compression]:
        writer = writer.option("compression", COMPRESSION[compression])
    writer.text(path)


def _spare_characters(*texts: str) -> list[str]:
    """Four control characters that none of the texts holds."""
    taken = set("".join(texts)) | set("\t\n\r")
    return [chr(code) for code in range(1, 32) if chr(code) not in taken][:4]


def _split_fields(line: Column, delimiter: str, quote: str | None, limit: int) -> Column:
    """Parts of a line, at most ``limit`` of them, or all for -1.

    A delimiter counts only where an even number of quotes follows. The line is cut at
    its quotes, the delimiters that count are marked in every second run, and the runs
    are put together and cut at the marks; this takes time in proportion to the line.
    The mark and the escape are control characters; where the line holds them itself
    they are escaped first and restored at the end.
    """
    plain = F.split(line, re.escape(delimiter), limit)
    if not quote:
        return plain
    mark, escape, one, two = _spare_characters(delimiter, quote)

    def swap(value: Column, *pairs: tuple[str, str]) -> Column:
        for old, new in pairs:
            value = F.replace(value, F.lit(old), F.lit(new))
        return value

    runs = F.split(swap(line, (escape, escape + one), (mark, escape + two)), re.escape(quote), -1)

    def marked(run: Column, place: Column) -> Column:
        return F.when((F.size(runs) - place) % 2 == 1, swap(run, (delimiter, mark))).otherwise(run)

    fields = F.split(F.array_join(F.transform(runs, marked), quote), mark, limit)
    restored = F.transform(
        fields, lambda f: swap(f, (mark, delimiter), (escape + two, mark), (escape + one, escape))
    )
    return F.when(F.contains(line, F.lit(quote)), restored).otherwise(plain)


def _without_quotes(value: Column, quote: str) -> Column:
    """The inside of a value in quotes; other values as they are."""
    width = len(quote)
    whole = (F.length(value) >= 2 * width) & F.startswith(value, F.lit(quote)) & F.endswith(value, F.lit(quote))
    return F.when(whole, F.substring(value, F.lit(width + 1), F.length(value) - 2 * width)).otherwise(value)


def parse_delimited(
    line: Column | str,
    names: Sequence[str],
    delimiter: str = "\t",
    quote: str | None = None,
    types: Sequence[str] | None = None,
    strict: bool = True,
    safe: bool = True,
) -> tuple[list[Column], Column]:
    """Field columns of a delimited line, and the condition that it is well formed.

    The line is cut into as many fields as there are names, with any rest in the
    last. Empty fields are null. A line with too few fields is malformed when
    ``strict``, otherwise the missing ones are empty. A value that does not coerce
    is null when ``safe``, otherwise the line is malformed.
    """
    line = F.col(line) if isinstance(line, str) else line
    parts = _split_fields(line, delimiter, quote, len(names))
    well_formed = F.size(parts) == len(names) if strict else F.lit(True)
    columns = []
    for i, name in enumerate(names):
        value = F.get(parts, F.lit(i))
        if quote:
            value = F.replace(_without_quotes(value, quote), F.lit(quote * 2), F.lit(quote))
        value = F.when(value != "", value)
        if types:
            typed = coerce_column(value, T.StringType(), types[i], safe=True)
            if not safe:
                well_formed = well_formed & (value.isNull() | typed.isNotNull())
            value = typed
        columns.append(value.alias(name))
    return columns, well_formed


def _distinct_readings(paths: Sequence[str]) -> list[list[str]]:
    """The paths in as many lists as the most frequent one is named, each at most once in each."""
    times = Counter(paths)
    return [[p for p, n in times.items() if n > turn] for turn in range(max(times.values()))]


def _whole_lines(spark: SparkSession, paths: list[str], header: bool) -> DataFrame:
    """Lines, but the first one of every file with ``header``; a file read twice has two.

    The line to leave out is the one with the least id of those in the block at place 0; ids rise along
    a block. They are found in one aggregate, with one row per file, over the first blocks."""
    if not header:
        return spark.read.text(paths)
    read = []
    for some in _distinct_readings(paths):
        lines = spark.read.text(some).select("value", F.monotonically_increasing_id().alias("id"))
        start, file = F.col("_metadata.file_block_start"), F.col("_metadata.file_path")
        placed = spark.read.text(some).select(F.monotonically_increasing_id().alias("id"), file.alias("path"), start.alias("start"))
        first = placed.where("start = 0").groupBy("path").agg(F.min("id").alias("id"))
        read.append(lines.join(first.select("id"), "id", "left_anti").select("value"))
    return reduce(lambda a, b: a.unionByName(b), read)


def header_names(
    spark: SparkSession, path: str | Sequence[str], delimiter: str = "\t", quote: str | None = None
) -> list[str]:
    """Field names from the first line of a file."""
    starts = spark.read.text(_paths(path)).where(F.col("_metadata.file_block_start") == 0)
    names = _split_fields(F.col("value"), delimiter, quote, -1)
    if quote:
        names = F.transform(names, lambda n: _without_quotes(n, quote))
    row = starts.select(names.alias("names")).first()
    if row is None:
        raise ValueError(f"no header, {path} is empty")
    return list(row["names"])


def read_delimited(
    spark: SparkSession,
    path: str | Sequence[str],
    names: Sequence[str] | None = None,
    delimiter: str = "\t",
    quote: str | None = None,
    types: Sequence[str] | None = None,
    header: bool = False,
    strict: bool = True,
    safe: bool = True,
    trap: bool = False,
) -> DataFrame | tuple[DataFrame, DataFrame]:
    """Delimited text, one record per line.

    Without ``names`` the header line gives them. A malformed line fails the job, or with ``trap`` goes to a second frame
    as ``line``.
    """
    paths = _paths(path)
    if names is None:
        names = header_names(spark, paths, delimiter, quote)
        header = True
    lines = _whole_lines(spark, paths, header)
    columns, well_formed = parse_delimited("value", names, delimiter, quote, types, strict, safe)
    if trap:
        good = lines.where(well_formed).select(*columns)
        return good, lines.where(~well_formed).select(F.col("value").alias("line"))
    problem = F.concat(F.lit("malformed line: "), F.col("value"))
    checked = lines.where(
        F.when(well_formed, F.lit(True)).otherwise(F.raise_error(problem).cast("boolean"))
    )
    return checked.select(*columns)


def write_delimited(
    df: DataFrame,
    path: str,
    delimiter: str = "\t",
    quote: str | None = None,
    header: bool = False,
    mode: str = "KEEP",
    compression: str = "DEFAULT",
    parts: int | None = None,
) -> None:
    """Rows as delimited lines; null is empty. With a quote, quotes inside a value
    are doubled and a value with the delimiter in it is put in quotes."""
    values = []
    for name in df.columns:
        value = F.coalesce(F.col(name).cast("string"), F.lit(""))
        if quote:
            doubled = F.replace(value, F.lit(quote), F.lit(quote * 2))
            value = F.when(
                F.contains(value, F.lit(delimiter)), F.concat(F.lit(quote), doubled, F.lit(quote))
            ).otherwise(doubled)
        values.append(value)
    lines = df.select(F.concat_ws(delimiter, *values).alias("value"))
    if parts:
        lines = lines.repartition(parts)
    if header:
        first = pd.DataFrame({"value": [delimiter.join(df.columns)]})
        # Every task writes one file, so a header before its lines is one per file.
        lines = lines.mapInPandas(lambda batches: chain([first], batches), "value string")
    writer = lines.write.mode(SINK_MODES[mode]).option("maxRecordsPerFile", 0)
    if COMPRESSION[compression]:
        writer = writer.option("compression", COMPRESSION[compression])
    writer.text(path)


def write_table(df: DataFrame, path: str, mode: str = "KEEP", codec: str | None = None) -> None:
    """Typed rows as Parquet, the form for data between jobs."""
    writer = df.write.mode(SINK_MODES[mode])
    if codec:
        writer = writer.option("compression", codec)
    writer.parquet(path)


def read_table(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | None = None,
    pattern: str | None = None,
) -> DataFrame:
    """Parquet from a path, a wildcard path, or several paths together."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.parquet(*_paths(path))


KEY_VALUE_BYTES = T.StructType(
    [T.StructField("key", T.BinaryType()), T.StructField("value", T.BinaryType())]
)


def write_key_values(
    df: DataFrame, path: str, key: str | None = None, value: str | None = None, mode: str = "KEEP"
) -> None:
    """Pairs of typed columns, or one of the two alone."""
    columns = [F.col(c).alias(n) for c, n in ((key, "key"), (value, "value")) if c]
    if not columns:
        raise ValueError("name a key column, a value column, or both")
    write_table(df.select(*columns), path, mode)


def write_key_value_bytes(df: DataFrame, path: str, key: str, value: str, mode: str = "KEEP") -> None:
    """Pairs of bytes."""
    pairs = df.select(F.col(key).cast("binary").alias("key"), F.col(value).cast("binary").alias("value"))
    write_table(pairs, path, mode)


def read_key_value_bytes(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return read_table(spark, path, KEY_VALUE_BYTES)


def discard_rows(df: DataFrame) -> None:
    """Compute all rows and keep none."""
    df.write.format("noop").mode("overwrite").save()


def read_nothing(*_args, **_options) -> DataFrame:
    """The null source holds no rows to read."""
    raise ValueError("the null sink cannot be read")


def multi_source(*inputs: DataFrame) -> DataFrame:
    """The rows of several sources of the same fields."""
    from tidemark.operators.grouping import merge

    return merge(*inputs)


def multi_sink(df: DataFrame, scratch, *writes) -> None:
    """Send the same rows to several sinks.

    The rows are computed once, into the shared folder; every ``write`` is called
    with the stored frame.
    """
    stored = scratch.save(df, "multi-sink")
    for write in writes:
        write(stored)
    scratch.drop(stored)


def template_sink(
    df: DataFrame, path: str, path_fields: Sequence[str], mode: str = "KEEP", keep_fields: bool = False
) -> None:
    """One folder per value of the path fields.

    Rows are brought together by folder first, in a few parts each, so that a
    task has few files open; a busy folder is spread over more than one task.
    """
    rows = df
    if keep_fields:
        copies = {f"{f}_path": F.col(f) for f in path_fields}
        rows = df.withColumns(copies)
        path_fields = list(copies)
    spread_by_folder(rows, path_fields).write.mode(SINK_MODES[mode]).partitionBy(*path_fields).parquet(path)


def spread_by_folder(df: DataFrame, folders: Sequence[str]) -> DataFrame:
    """Bring rows of a folder together without tying a folder to one task.

    The ``rebalance`` hint lets adaptive execution split a folder that is too
    big and merge those that are small.
    """
    return df.hint("rebalance", *[F.col(f) for f in folders])


def read_document_store(
    spark: SparkSession, source: str, columns: Sequence[str], **options: str
) -> DataFrame:
    """Named columns from any installed connector; a missing value is empty text."""
    rows = spark.read.format(source).options(**options).load()
    return rows.select(
        *[
            F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
            if c in rows.columns
            else F.lit("").alias(c)
            for c in columns
        ]
    )


def write_document_store(
    df: DataFrame,
    sink: str,
    mappings: dict[str, str] | None = None,
    mode: str = "UPDATE",
    **options: str,
) -> None:
    """One document per row through any installed connector, key included.

    ``mappings`` gives the field that fills each document column. A write error
    fails the job.
    """
    rows = df.select(*[F.col(f).alias(c) for c, f in mappings.items()]) if mappings else df
    rows.write.format(sink).mode(SINK_MODES[mode]).options(**options).save()


def _opened(folder: str):
    """pyarrow's file system for a folder, and its path there; None for one that only Spark can open."""
    uri = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    try:
        return pafs.FileSystem.from_uri(uri)
    except (pa.ArrowInvalid, OSError, ImportError):
        return None


def can_copy(source: str, target: str) -> bool:
    """Whether ``copy_files`` can reach both places."""
    return _opened(source) is not None and _opened(target) is not None


def copy_files(listed: DataFrame, source: str, target: str, tasks: int | None = None) -> DataFrame:
    """Copy files byte by byte to the same places below another folder, by all executors.

    ``listed`` has ``path, length`` of files below ``source``, as the binaryFile source lists them (it
    leaves out files without bytes).
    Files are dealt out so that every task gets as many of each size, counted in
    powers of two. Each is written under the name of the attempt and then renamed, so a task that runs
    again leaves whole files. Returns ``path, length, crc32`` of what was written, below ``target``; the
    copying happens when it is used, once, so store it or collect it. Both folders must be
    open to pyarrow on all executors, see ``can_copy``.
    """
    spark = listed.sparkSession
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    root = _qualified(spark, source)
    below = F.substring("path", F.lit(len(root) + 1), F.length("path"))
    same_size = Window.partitionBy(F.floor(F.log2(F.col("length") + 1))).orderBy(F.desc("length"), "path")
    dealt = listed.select(below.alias("below"), "length", ((F.row_number().over(same_size) - 1) % tasks).cast("int").alias("task"))

    def copied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (store, start), (other, end) = _opened(source), _opened(target)
        for batch in batches:
            done = []
            for below in batch.column("below").to_pylist():
                name = f"{end}/{below}"
                part, size, check = f"{name}.{uuid.uuid4().hex}", 0, 0
                other.create_dir(name.rpartition("/")[0], recursive=True)
                with store.open_input_stream(f"{start}/{below}", compression=None) as read, other.open_output_stream(part, compression=None) as write:
                    while piece := read.read(4 << 20):
                        write.write(piece)
                        size, check = size + len(piece), zlib.crc32(piece, check)
                other.move(part, name)
                done.append((below, size, check))
            yield pa.RecordBatch.from_arrays(
                [pa.array([d[i] for d in done], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64()))],
                names=["path", "length", "crc32"],
            )

    return dealt.repartitionById(tasks, "task").mapInArrow(copied, "path string, length bigint, crc32 bigint")


def _qualified(spark: SparkSession, folder: str) -> str:
    """The folder as the names of files below it begin, with a slash at the end."""
    from tidemark.sources.fs import FileSystem

    store = FileSystem(spark, folder)
    return store._fs.makeQualified(store.path(folder)).toString().rstrip("/") + "/"
