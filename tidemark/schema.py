"""Record layouts of the raw facts and of the published views.

A person is a struct with one set arm. Struct ordering on
``(kind, cookie, user_id)`` puts every cookie before every user id, which is the
order that picks the root of an identity component.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The fact kinds and property kinds, by their stored numbers.
PERSON_PROPERTY, PAGE_PROPERTY, EQUIV, PAGE_VIEW = 1, 2, 3, 4
COOKIE, USER_ID = 1, 2
FULL_NAME, GENDER, LOCATION = 1, 2, 3
MALE, FEMALE = 1, 2
PAGE_VIEW_COUNT = 1
NO_VALUE_KIND = 0

VALUE_KINDS = {
    PERSON_PROPERTY: (FULL_NAME, GENDER, LOCATION),
    PAGE_PROPERTY: (PAGE_VIEW_COUNT,),
    EQUIV: (NO_VALUE_KIND,),
    PAGE_VIEW: (NO_VALUE_KIND,),
}

PERSON = T.StructType(
    [
        T.StructField("kind", T.IntegerType()),
        T.StructField("cookie", T.StringType()),
        T.StructField("user_id", T.LongType()),
    ]
)

PAGE_VIEWS = T.StructType(
    [
        T.StructField("person", PERSON),
        T.StructField("url", T.StringType()),
        T.StructField("nonce", T.LongType()),
        T.StructField("ts", T.IntegerType()),
    ]
)

EQUIVS = T.StructType(
    [
        T.StructField("id1", PERSON),
        T.StructField("id2", PERSON),
        T.StructField("ts", T.IntegerType()),
    ]
)

PERSON_PROPERTIES = T.StructType(
    [
        T.StructField("person", PERSON),
        T.StructField("value_kind", T.IntegerType()),
        T.StructField("full_name", T.StringType()),
        T.StructField("gender", T.IntegerType()),
        T.StructField("city", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("ts", T.IntegerType()),
    ]
)

PAGE_PROPERTIES = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("value_kind", T.IntegerType()),
        T.StructField("page_view", T.IntegerType()),
        T.StructField("ts", T.IntegerType()),
    ]
)

ARM_SCHEMAS = {
    PERSON_PROPERTY: PERSON_PROPERTIES,
    PAGE_PROPERTY: PAGE_PROPERTIES,
    EQUIV: EQUIVS,
    PAGE_VIEW: PAGE_VIEWS,
}

# One wide row holds any fact; the two partition columns come last.
FACTS = T.StructType(
    [
        T.StructField("ts", T.IntegerType()),
        T.StructField("person", PERSON),
        T.StructField("url", T.StringType()),
        T.StructField("nonce", T.LongType()),
        T.StructField("id1", PERSON),
        T.StructField("id2", PERSON),
        T.StructField("full_name", T.StringType()),
        T.StructField("gender", T.IntegerType()),
        T.StructField("city", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("page_view", T.IntegerType()),
        T.StructField("unit", T.IntegerType()),
        T.StructField("value_kind", T.IntegerType()),
    ]
)

BUCKETED_VIEW_COLUMNS = ["key", "value", "url", "granularity", "bucket"]
BOUNCE_VIEW_COLUMNS = ["key", "domain", "visits", "bounces", "rate"]


def cookie_person(cookie) -> Column:
    """Person struct for a cookie string column."""
    return F.struct(
        F.lit(COOKIE).cast("int").alias("kind"),
        _col(cookie).cast("string").alias("cookie"),
        F.lit(None).cast("bigint").alias("user_id"),
    ).cast(PERSON)


def user_person(user_id) -> Column:
    """Person struct for a numeric user id column."""
    return F.struct(
        F.lit(USER_ID).cast("int").alias("kind"),
        F.lit(None).cast("string").alias("cookie"),
        _col(user_id).cast("bigint").alias("user_id"),
    ).cast(PERSON)


def person_key(person) -> Column:
    """Text that is equal for equal persons only, for sketches and reports."""
    person = _col(person)
    return F.concat(
        person["kind"].cast("string"),
        F.lit(":"),
        F.coalesce(person["cookie"], person["user_id"].cast("string")),
    )


def to_facts(df: DataFrame, unit: int) -> DataFrame:
    """Widen the rows of one arm to the common fact layout."""
    have = set(df.columns)
    columns = []
    for field in FACTS.fields:
        if field.name == "unit":
            value = F.lit(unit)
        elif field.name == "value_kind" and "value_kind" not in have:
            value = F.lit(NO_VALUE_KIND)
        elif field.name in have:
            value = F.col(field.name)
        else:
            value = F.lit(None)
        columns.append(value.cast(field.dataType).alias(field.name))
    return df.select(*columns)


def arm(facts: DataFrame, unit: int) -> DataFrame:
    """Rows of one arm, narrowed to its columns. The filter prunes partitions."""
    names = ARM_SCHEMAS[unit].names
    return facts.where(F.col("unit") == unit).select(*names)


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value
