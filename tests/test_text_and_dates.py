import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions import dates, text
from tidemark.operators import quality


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(
        [("a1b22c", "x", 1), (None, "y", 2), ("", None, 3), ("zz9,,", "q", 4)], "s string, t string, n int"
    )


def one(df, column):
    return {r["n"]: r["v"] for r in df.select("n", column.alias("v")).collect()}


def test_replace(df):
    assert one(df, text.regex_replace("s", "([a-z])([0-9])", "<$2$1>"))[1] == "<1a><2b>2c"
    assert one(df, text.regex_replace("s", "([a-z])([0-9])", "<$2$1>", every=False)) == {
        1: "<1a>b22c", 2: "", 3: "", 4: "z<9z>,,",
    }
    assert one(df, text.regex_replace("s", r"([a-z])\1", "$1!", every=False))[4] == "z!9,,"
    assert one(df, text.regex_replace("s", "[0-9]", "#", every=False))[1] == "a#b22c"


def test_join_and_format(df):
    assert one(df, text.field_join("s", "t", "n", delimiter="|")) == {1: "a1b22c|x|1", 2: "|y|2", 3: "||3", 4: "zz9,,|q|4"}
    assert one(df, text.field_format("%s-%03d", "s", "n"))[2] == "null-002"


def test_split(df, rows_of):
    columns = text.regex_split_columns(df, "s", "[0-9]", ["p", "q"]).select("n", "p", "q")
    assert rows_of(columns) == sorted([(1, "a", "b22c"), (2, "", None), (3, "", None), (4, "zz", ",,")], key=repr)
    parts = text.regex_split_rows(df, "s", ",", "p").select("n", "p")
    assert rows_of(parts) == sorted([(1, "a1b22c"), (2, ""), (3, ""), (4, "zz9")], key=repr)


def test_split_rows_inside_and_only_empties(spark, rows_of):
    df = spark.createDataFrame([(",a,,b,,",), (",,",)], "s string")
    assert rows_of(text.regex_split_rows(df, "s", ",", "p").select("p")) == sorted([("",), ("a",), ("",), ("b",)], key=repr)


def test_generate(df, rows_of):
    assert rows_of(text.regex_generate(df, "s", "[0-9]+", "p").select("p")) == [("1",), ("22",), ("9",)]


def test_parse(df):
    good = df.where("n IN (1, 4)")
    row = text.regex_parse(good, "s", "([a-z]+)([0-9])", ["p", "q"]).orderBy("n").collect()
    assert [(r["p"], r["q"]) for r in row] == [("a", "1"), ("zz", "9")]
    whole = text.regex_parse(good, "s", "[0-9]+", ["p"]).orderBy("n").collect()
    assert [r["p"] for r in whole] == ["1", "9"]
    chosen = text.regex_parse(good, "s", "([a-z]+)([0-9])", ["q"], groups=[2]).orderBy("n").collect()
    assert [r["q"] for r in chosen] == ["1", "9"]
    with pytest.raises(Exception, match="no match"):
        text.regex_parse(df, "s", "([a-z]+)([0-9])", ["p", "q"]).collect()
    lenient = text.regex_parse(df, "s", "([a-z]+)([0-9])", ["p", "q"], strict=False)
    assert lenient.where("n = 2").first()["p"] is None
    with pytest.raises(ValueError):
        text.regex_parse(df, "s", "([a-z]+)([0-9])", ["p"])


def test_filter(df):
    def kept(**options):
        return sorted(r["n"] for r in text.regex_filter(df, "[xyz]", "s", "t", **options).collect())

    assert kept() == [1, 2, 4]
    assert kept(remove_match=True) == [3]
    assert kept(each=True) == []
    assert kept(each=True, remove_match=True) == [3]


MOMENTS = ["2024-03-10 02:30:15", "1969-12-31 23:59:59", "2023-12-31 00:00:00", "2000-02-29 12:00:00"]


def test_dates(spark):
    df = spark.createDataFrame([(m,) for m in MOMENTS], "s string")
    millis = dates.date_parse("s", "yyyy-MM-dd HH:mm:ss")
    fields = ["YEAR", "MONTH", "DAY_OF_MONTH", "DAY_OF_YEAR", "DAY_OF_WEEK", "HOUR_OF_DAY", "HOUR", "AM_PM", "MINUTE", "SECOND"]
    rows = df.select("s", millis.alias("ms"), *[dates.calendar_field(millis, f).alias(f) for f in fields]).collect()
    for r in rows:
        t = datetime.datetime.fromisoformat(r["s"]).replace(tzinfo=datetime.UTC)
        assert r["ms"] == int(t.timestamp() * 1000)
        want = [
            t.year, t.month - 1, t.day, t.timetuple().tm_yday, t.isoweekday() % 7 + 1, t.hour, t.hour % 12,
            t.hour // 12, t.minute, t.second,
        ]
        assert [r[f] for f in fields] == want
    back = df.select("s", dates.date_format(millis, "yyyy-MM-dd HH:mm:ss").alias("b")).collect()
    assert all(r["s"] == r["b"] for r in back)


def test_weeks_start_on_sunday(spark):
    days = ["2023-12-30", "2023-12-31", "2024-01-01", "2024-01-07", "2024-12-28", "2024-12-29"]
    df = spark.createDataFrame([(d,) for d in days], "s string")
    ms = dates.date_parse("s", "yyyy-MM-dd")
    rows = df.select(dates.calendar_field(ms, "WEEK_OF_YEAR"), dates.calendar_field(ms, "WEEK_OF_MONTH")).collect()
    assert [tuple(r) for r in rows] == [(52, 5), (1, 6), (1, 1), (2, 2), (52, 4), (1, 5)]


def test_date_zones_and_bad_text(spark):
    df = spark.createDataFrame([("2024-07-01 12:00",)], "s string")
    tokyo = dates.date_parse("s", "yyyy-MM-dd HH:mm", "Asia/Tokyo")
    row = df.select(
        tokyo.alias("ms"),
        dates.date_format(tokyo, "HH:mm", "Asia/Tokyo").alias("there"),
        dates.date_format(tokyo, "HH:mm").alias("utc"),
        dates.date_parse(F.lit("2024-07-01 12:00 +0200"), "yyyy-MM-dd HH:mm Z").alias("offset"),
        dates.date_parse(F.lit("x"), "yyyy", safe=True).alias("bad"),
    ).first()
    noon = 1719835200000
    assert tuple(row) == (noon - 9 * 3_600_000, "12:00", "03:00", noon - 2 * 3_600_000, None)
    with pytest.raises(Exception, match="unable to parse date"):
        df.select(dates.date_parse("s", "yyyy")).collect()
    with pytest.raises(ValueError):
        dates.calendar_field("s", "ERA")


def test_dates_in_a_language(spark, rows_of):
    texts = ["3. März 2024", "3. Maerz 2024", '3. "März, 2024', "31. Februar 2024", "3. März 2024\nx", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, s string")
    millis = dates.date_parse("s", "d. MMMM yyyy", locale="de", safe=True)
    assert one(df, millis) == {0: 1709424000000} | dict.fromkeys(range(1, 7))
    there = dates.date_parse("s", "d. MMMM yyyy", "Asia/Tokyo", locale="de", safe=True)
    assert one(df, there)[0] == 1709424000000 - 9 * 3_600_000
    with pytest.raises(Exception, match="unable to parse date: 3. Maerz 2024"):
        df.where("n < 2").select(dates.date_parse("s", "d. MMMM yyyy", locale="de")).collect()
    good, rejected = quality.trap(df, [quality.Rule("date", millis.isNotNull())])
    assert rows_of(good.select("n")) == [(0,)]
    assert rows_of(rejected.select("n", "s")) == sorted(list(enumerate(texts))[1:], key=repr)


def test_names_of_days_are_read(spark):
    texts = ["mardi 5 mars 2024", "Mar. 5 mars 2024", "lundi 5 mars 2024", "5 mars 2024", "mardis 5 mars 2024", "mardi 5 mars"]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, s string")
    day = 1709596800000
    found = one(df, dates.date_parse("s", "EEEE d MMMM yyyy", locale="fr", safe=True))
    assert found == {0: day, 1: day, 2: day, 3: None, 4: None, 5: None}
    english = dates.date_parse(F.lit("5 Mar 2024 (Tue) E"), "d MMM yyyy (EEE) 'E'", locale="en", safe=True)
    assert spark.range(1).select(english).first()[0] == day


def test_dates_are_written_in_a_language(spark):
    noon = F.lit(1709467200000)
    row = spark.range(1).select(
        dates.date_format(noon, "EEEE, d. MMM yyyy HH:mm", locale="de"),
        dates.date_format(noon, "d MMMM yyyy HH:mm", "Asia/Tokyo", "fr"),
        dates.date_format(noon, "MMMM 'o''clock' h a", "America/New_York", "en"),
        dates.date_format(F.lit(None).cast("long"), "MMMM yyyy", locale="es"),
    )
    assert tuple(row.first()) == ("Sonntag, 3. März 2024 12:00", "3 mars 2024 21:00", "March o'clock 7 AM", "enero 1970")


@pytest.mark.parametrize("locale", ["de-DE", "en-US", "fr", "ar-EG", "pt"])
def test_weeks_follow_the_locale(spark, locale):
    """Against the JVM's own calendar, around turns of years and months."""
    java = spark._jvm.java.util
    calendar = java.Calendar.getInstance(java.TimeZone.getTimeZone("UTC"), java.Locale.forLanguageTag(locale))
    days = [d for y in range(2010, 2020) for m in (1, 3, 12) for d in _days(y, m)]
    df = spark.createDataFrame([(d,) for d in days], "ms long")
    rules = dates.week_rules(locale)
    fields = ["WEEK_OF_YEAR", "WEEK_OF_MONTH", "DAY_OF_WEEK"]
    rows = df.select("ms", *[dates.calendar_field("ms", f, rules).alias(f) for f in fields]).collect()
    for row in rows:
        calendar.setTimeInMillis(row["ms"])
        assert [row[f] for f in fields] == [calendar.get(getattr(java.Calendar, f)) for f in fields], row


def _days(year, month):
    first = datetime.datetime(year, month, 1, tzinfo=datetime.UTC) - datetime.timedelta(days=9)
    return [int((first + datetime.timedelta(days=k)).timestamp() * 1000) for k in range(0, 20)]
