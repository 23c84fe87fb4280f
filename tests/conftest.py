import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


SHOP, NEWS = "http://shop.example", "http://news.example"
# (user, url, nonce, ts); the first one comes twice.
SEED_VIEWS = [
    (10, f"{SHOP}/cart", 1, 100),
    (10, f"{SHOP}/cart", 1, 100),
    (10, f"{SHOP}/cart", 2, 100),
    (10, f"{SHOP}/list", 3, 900),
    (4, f"{SHOP}/list", 4, 1801),
    (7, f"{NEWS}/today", 5, 50),
    (7, f"{NEWS}/today", 6, 90_000),
    (8, f"{SHOP}/cart", 7, 3599),
    (8, f"{NEWS}/today", 8, 3600),
    (12, f"{NEWS}/today", 9, 700_000),
    (2, f"{SHOP}/list", 10, 2_500_000),
]
SEED_LINKS = [(10, 4), (12, 8), (4, 10)]


@pytest.fixture(scope="session")
def seed_views(spark):
    from pyspark.sql import functions as F

    from tidemark import schema

    rows = spark.createDataFrame(SEED_VIEWS, "u long, url string, nonce long, ts int")
    return rows.select(
        schema.user_person("u").alias("person"), "url", "nonce", "ts"
    )


@pytest.fixture(scope="session")
def seed_equivs(spark):
    from pyspark.sql import functions as F

    from tidemark import schema

    rows = spark.createDataFrame(SEED_LINKS, "a long, b long")
    return rows.select(
        schema.user_person("a").alias("id1"), schema.user_person("b").alias("id2"), F.lit(1000).alias("ts")
    )


def rows_of(df):
    """Rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(name="rows_of")
def _rows_of():
    return rows_of
