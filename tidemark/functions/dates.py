"""Date text and epoch milliseconds. UTC unless a zone is named.

Parsing and calendar fields do not depend on the session's time zone. Formatting
assumes the UTC session that ``tidemark.session`` sets up.

``locale`` is a language tag such as ``de`` or ``fr-CA``. Spark's date functions take
none, but its JSON functions do, so text in a language goes through a JSON
document of one field. This stays inside the JVM.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

_MS_PER_DAY = 86_400_000


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _names_a_zone(pattern: str) -> bool:
    return bool(re.search(r"[zZX]", re.sub(r"'[^']*'", "", pattern)))


def _without_day_names(text: Column, pattern: str, locale: str) -> tuple[Column, str]:
    """Text and pattern without the name of the day, which Spark does not read; null if there is none."""
    rest = re.sub(r"'[^']*'|E+", lambda m: "" if m[0][0] == "E" else m[0], pattern)
    if rest == pattern:
        return text, pattern
    java = SparkSession.active()._jvm.java
    symbols = java.text.DateFormatSymbols.getInstance(java.util.Locale.forLanguageTag(locale))
    names = {n for some in (symbols.getWeekdays(), symbols.getShortWeekdays()) for n in some if n}
    any_name = "|".join(re.escape(n) for n in sorted(names, key=len, reverse=True))
    before = "" if pattern.startswith("E") else ".*?"
    found = rf"(?siu)^({before})(?<!\p{{L}})(?:{any_name})(?!\p{{L}})"
    return F.when(F.rlike(text, F.lit(found)), F.regexp_replace(text, found, "$1")), rest


def _locale_options(pattern: str, zone: str, locale: str) -> dict[str, str]:
    return {"timestampFormat": pattern, "timeZone": zone, "locale": locale}


def date_parse(text, pattern: str, zone: str = "UTC", safe: bool = False, locale: str | None = None) -> Column:
    """Epoch milliseconds of date text. Bad text raises, or is null when ``safe``.

    With a ``locale``, names of months and days are read in its language. The name of a day must
    be one, but need not be that of the date. Null text is bad text."""
    text = _col(text)
    if locale:
        plain, rest = _without_day_names(text.cast("string"), pattern, locale)
        document = F.to_json(F.struct(plain.alias("d")))
        moment = F.from_json(document, "d timestamp", _locale_options(rest, zone, locale))["d"]
    elif _names_a_zone(pattern):
        moment = F.try_to_timestamp(text, F.lit(pattern))
    else:
        moment = F.try_to_timestamp(F.concat(text, F.lit(" +00:00")), F.lit(pattern + " XXX"))
        if zone != "UTC":
            moment = F.to_utc_timestamp(moment, zone)
    millis = F.unix_millis(moment)
    if safe:
        return millis
    problem = F.concat(F.lit("unable to parse date: "), F.coalesce(text, F.lit("null")))
    return F.coalesce(millis, F.raise_error(problem).cast("bigint"))


def week_rules(locale: str) -> tuple[int, int]:
    """First day of the week (Sunday = 1) and least days of a first week in the region of ``locale``."""
    java = SparkSession.active()._jvm.java.util
    calendar = java.Calendar.getInstance(java.Locale.forLanguageTag(locale))
    return calendar.getFirstDayOfWeek(), calendar.getMinimalDaysInFirstWeek()


def _week(day: Column, period: str, first: int, least: int, carry: bool) -> Column:
    """Number of the week of ``day`` in its month or year. Week 1 is the first one with ``least`` days
    in the period. With ``carry``, days before it belong to the last period's weeks and days in
    the next period's week 1 to that; otherwise the days before it are in week 0."""
    step = {"month": 1, "year": 12}[period]

    def week_start(date: Column) -> Column:
        return F.date_sub(date, F.pmod(F.dayofweek(date) - first, F.lit(7)))

    def first_week(months: int) -> Column:
        begin = F.add_months(F.trunc(day, period), months)
        here = 7 - F.pmod(F.dayofweek(begin) - first, F.lit(7))
        return F.date_add(week_start(begin), F.when(here >= least, 0).otherwise(7))

    def number(begin: Column) -> Column:
        return F.floor(F.datediff(week_start(day), begin) / 7) + 1

    own = number(first_week(0))
    if not carry:
        return own
    before = F.when(own < 1, number(first_week(-step))).otherwise(own)
    return F.when(week_start(day) >= first_week(step), F.lit(1)).otherwise(before)


def calendar_field(millis, field: str, weeks: tuple[int, int] = (1, 1)) -> Column:
    """A calendar field in UTC, numbered as Java calendars do: months from 0, days of the
    week from Sunday = 1. ``weeks`` says on which day weeks start and how many days of the
    period its first week needs, see ``week_rules``; by default Sunday and 1."""
    millis = _col(millis)
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(millis / _MS_PER_DAY).cast("int"))
    in_day = F.pmod(millis, F.lit(_MS_PER_DAY))
    hour = F.floor(in_day / 3_600_000).cast("int")
    fields = {
        "YEAR": lambda: F.year(day),
        "MONTH": lambda: F.month(day) - 1,
        "DAY_OF_MONTH": lambda: F.dayofmonth(day),
        "DAY_OF_YEAR": lambda: F.dayofyear(day),
        "DAY_OF_WEEK": lambda: F.dayofweek(day),
        "WEEK_OF_MONTH": lambda: _week(day, "month", *weeks, carry=False),
        "WEEK_OF_YEAR": lambda: _week(day, "year", *weeks, carry=True),
        "HOUR_OF_DAY": lambda: hour,
        "HOUR": lambda: hour % 12,
        "AM_PM": lambda: F.floor(hour / 12),
        "MINUTE": lambda: F.floor(in_day / 60_000) % 60,
        "SECOND": lambda: F.floor(in_day / 1_000) % 60,
        "MILLISECOND": lambda: in_day % 1_000,
    }
    if field not in fields:
        raise ValueError(f"unknown calendar field {field!r}; known: {', '.join(fields)}")
    return fields[field]().cast("int")


def date_parse_fields(
    text, pattern: str, fields: list[str], zone: str = "UTC", safe: bool = False, locale: str | None = None
) -> list[Column]:
    """Calendar fields of date text, one column each. Weeks follow the locale, if one is given."""
    millis = date_parse(text, pattern, zone, safe, locale)
    weeks = week_rules(locale) if locale else (1, 1)
    return [calendar_field(millis, field, weeks) for field in fields]


def date_format(millis, pattern: str, zone: str = "UTC", locale: str | None = None) -> Column:
    """Epoch milliseconds as text; a missing number reads as 0. A ``locale`` gives the language of
    the names of months and days."""
    number = F.coalesce(_col(millis).cast("bigint"), F.lit(0).cast("bigint"))
    if locale:
        moment = F.struct(F.timestamp_millis(number).alias("d"))
        return F.from_json(F.to_json(moment, _locale_options(pattern, zone, locale)), "d string")["d"]
    start = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00"))
    wall = F.timestamp_add("MICROSECOND", number * 1000, start)
    if zone != "UTC":
        wall = F.convert_timezone(F.lit("UTC"), F.lit(zone), wall)
    return F.date_format(wall, pattern)
