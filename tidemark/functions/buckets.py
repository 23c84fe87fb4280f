"""Time buckets, view keys, and the byte forms of keys and values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Seconds in an hour, and the block lengths of the levels.
SECONDS_PER_HOUR = 3600
HOURS_PER_DAY = 24
DAYS_PER_WEEK = 7
DAYS_PER_MONTH = 28


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _truncating_div(value: Column, by: int) -> Column:
    # Integer division that truncates toward zero, kept as int.
    return F.call_function("div", value, F.lit(by)).cast("int")


def hour_bucket(ts) -> Column:
    """Hours since the epoch of a column of epoch seconds."""
    return _truncating_div(_col(ts), SECONDS_PER_HOUR)


def day_bucket(hour) -> Column:
    """Days since the epoch of an hour bucket."""
    return _truncating_div(_col(hour), HOURS_PER_DAY)


def _level(name: str, bucket: Column) -> Column:
    return F.struct(F.lit(name).alias("granularity"), bucket.cast("int").alias("bucket"))


def day_granularities(day) -> Column:
    """Array of the week and month ``(granularity, bucket)`` pairs of a day bucket."""
    day = _col(day)
    return F.array(
        _level("w", _truncating_div(day, DAYS_PER_WEEK)),
        _level("m", _truncating_div(day, DAYS_PER_MONTH)),
    )


def granularities(hour) -> Column:
    """Array of the four ``(granularity, bucket)`` pairs of an hour bucket."""
    hour = _col(hour)
    day = day_bucket(hour)
    return F.concat(F.array(_level("h", hour), _level("d", day)), day_granularities(day))


def emit_granularities(df: DataFrame, hour: str = "hour") -> DataFrame:
    """Four rows per input row: the columns ``granularity`` and ``bucket`` come on."""
    return df.select("*", F.inline(granularities(hour)))


def url_bucketed_key(url, granularity, bucket) -> Column:
    """``url/granularity-bucket``."""
    return F.concat(
        _col(url), F.lit("/"), _col(granularity), F.lit("-"), _col(bucket).cast("string")
    )


def serialized_string(value) -> Column:
    """The text itself."""
    return _col(value).cast("string")


def serialized_long(value) -> Column:
    """Eight bytes, highest first."""
    return F.unhex(F.lpad(F.hex(_col(value).cast("bigint")), 16, "0"))


def serialized_long_pair(first, second) -> Column:
    """Sixteen bytes: both numbers, highest byte first."""
    return F.concat(serialized_long(first), serialized_long(second))


def key_url(key) -> Column:
    """The URL part of a bucketed key: all before the last slash."""
    return F.regexp_extract(_col(key), r"(?s)^(.*)/", 1)


def url_shard(key, shards: int) -> Column:
    """Shard number in ``0 .. shards-1`` from the URL part of a bucketed key."""
    return F.pmod(F.hash(key_url(key)), F.lit(shards))


def bounce_rate(bounces, visits, legacy: bool = False) -> Column:
    """Share of visits with one view. ``legacy`` is the truncated quotient, which
    raises on zero visits."""
    bounces, visits = _col(bounces), _col(visits)
    if legacy:
        return F.call_function("div", bounces.cast("bigint"), visits.cast("bigint"))
    return F.try_divide(bounces.cast("double"), visits.cast("double"))
