import pytest

from tidemark.functions import urls

# address, normalized, authority
CASES = [
    ("http://foo.com/post1", "http://foo.com/post1", "foo.com"),
    ("http://foo.com/a?x=1#y", "http://foo.com/a", "foo.com"),
    ("http://u:p@foo.com:8080/a/b?x=1#t", "http://foo.com/a/b", "u:p@foo.com:8080"),
    ("HTTP://Foo.com/A", "http://Foo.com/A", "Foo.com"),
    ("https://foo.com", "https://foo.com", "foo.com"),
    ("http://foo.com?x=1", "http://foo.com", "foo.com"),
    ("http://foo.com#x/y", "http://foo.com", "foo.com"),
    ("http://a b/c d", "http://a b/c d", "a b"),
    (" http://foo.com/x \n", "http://foo.com/x", "foo.com"),
    ("url:http://foo.com/q", "http://foo.com/q", "foo.com"),
    ("http://foo.com:/x", "http://foo.com/x", "foo.com:"),
    ("http://foo.com:-1/x", "http://foo.com/x", "foo.com:-1"),
    ("http://[::1]:80/x", "http://[::1]/x", "[::1]:80"),
    ("http://a@b@c/x", "http:///x", "a@b@c"),
    ("file:///etc/x", "file:///etc/x", ""),
    ("file:/etc/x", "file:///etc/x", None),
    ("http:foo", "http://foo", None),
    ("mailto:a@b.c", "mailto://a@b.c", None),
    ("jar:file:/a.jar!/b", "jar://file:/a.jar!/b", None),
    ("ftp://f.com/a;type=i", "ftp://f.com/a;type=i", "f.com"),
    # dot segments
    ("http://foo.com/a/./b/../c", "http://foo.com/a/c", "foo.com"),
    ("http://foo.com/a/..", "http://foo.com/", "foo.com"),
    ("http://foo.com/a/.", "http://foo.com/a/", "foo.com"),
    ("http://foo.com/../a", "http://foo.com/../a", "foo.com"),
    ("http://foo.com/a/../../b", "http://foo.com/../b", "foo.com"),
    ("http://foo.com/a//../b", "http://foo.com/a/b", "foo.com"),
    ("http://foo.com/.hidden/x", "http://foo.com/.hidden/x", "foo.com"),
    # malformed: stays as it is, and has no authority
    ("nope", "nope", None),
    ("", "", None),
    (None, None, None),
    ("gopher://x/y", "gopher://x/y", None),
    ("http://foo.com:abc/", "http://foo.com:abc/", None),
    ("http://foo.com:-2/x", "http://foo.com:-2/x", None),
    ("http://foo.com:99999999999/x", "http://foo.com:99999999999/x", None),
    ("http://[zz/x", "http://[zz/x", None),
    ("jar:file:/a.jar", "jar:file:/a.jar", None),
    ("//foo.com/x", "//foo.com/x", None),
]


@pytest.fixture(scope="module")
def parsed(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, url string")
    rows = df.select(
        "i", urls.normalize_url("url").alias("n"), urls.extract_domain("url").alias("d"), urls.has_domain("url").alias("h")
    )
    return {r["i"]: r for r in rows.collect()}


@pytest.mark.parametrize("i", range(len(CASES)), ids=[repr(c[0]) for c in CASES])
def test_case(parsed, i):
    _, normalized, authority = CASES[i]
    assert parsed[i]["n"] == normalized
    assert parsed[i]["d"] == authority
    assert bool(parsed[i]["h"]) == (authority is not None)


def test_long_path(spark):
    url = "http://foo.com" + "/abc" * 20_000
    row = spark.createDataFrame([(url + "?q",)], "url string").select(urls.normalize_url("url").alias("n"))
    assert row.first()["n"] == url


def test_normalizing_twice_changes_nothing(spark):
    df = spark.createDataFrame([(c[0],) for c in CASES if c[0] and c[0].startswith("http://foo")], "url string")
    once = df.select(urls.normalize_url("url").alias("url"))
    twice = once.select("url", urls.normalize_url("url").alias("again"))
    assert all(r["url"] == r["again"] for r in twice.collect())


def test_strict(spark):
    df = spark.createDataFrame([("http://foo.com:80/a?x",), ("http://a b/c",)], "url string")
    found = [r[0] for r in df.select(urls.strict_normalize_url("url")).collect()]
    assert found == ["http://foo.com/a", "http://a b/c"]
