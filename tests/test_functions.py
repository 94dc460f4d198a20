"""Edge rows for the expression library (FIXTURES §3)."""

import datetime as dt
import math

from pyspark.sql import functions as F

from starloom.functions import arrays, dates, numbers, text

P = "No description available"


def test_date_cascade_strict(spark):
    rows = [
        ("First published July 15, 2022", dt.date(2022, 7, 15)),
        ("First published 1960", dt.date(1960, 1, 1)),
        ("First published June 2001", dt.date(2001, 6, 1)),
        ("First published 0800", dt.date(800, 1, 1)),
        ("Published July 15, 2022", dt.date(1900, 1, 1)),
        ("First published January 1, 1", dt.date(1900, 1, 1)),
        ("2022 foo", dt.date(1900, 1, 1)),
        ("July 15, 2022 extra", dt.date(1900, 1, 1)),
        ("Expected publication 2024", dt.date(1900, 1, 1)),
        ("", dt.date(1900, 1, 1)),
        (None, dt.date(1900, 1, 1)),
    ]
    df = spark.createDataFrame([(r[0],) for r in rows], "d string")
    strict = dates.parse_publish_date(text.remove_phrase("d", dates.PUBLISHED_PREFIX), prefix=False)
    got = df.select(strict.alias("p")).collect()
    assert [r.p for r in got] == [r[1] for r in rows]


def test_date_cascade_legacy_prefix(spark):
    rows = [
        ("First published July 15, 2022", dt.date(2022, 7, 15)),
        ("First published 1960", dt.date(1960, 1, 1)),
        ("First published June 2001", dt.date(2001, 6, 1)),
        ("First published 0800", dt.date(800, 1, 1)),
        ("Published July 15, 2022", dt.date(1900, 1, 1)),
        ("First published January 1, 1", dt.date(1, 1, 1)),
        ("2022 foo", dt.date(2022, 1, 1)),
        ("July 15, 2022 extra", dt.date(2022, 7, 15)),
        ("Expected publication 2024", dt.date(1900, 1, 1)),
        ("", dt.date(1900, 1, 1)),
        (None, dt.date(1900, 1, 1)),
    ]
    df = spark.createDataFrame([(r[0],) for r in rows], "d string")
    parsed = dates.parse_publish_date(text.remove_phrase("d", dates.PUBLISHED_PREFIX))
    assert [r.p for r in df.select(parsed.alias("p")).collect()] == [r[1] for r in rows]


def test_date_defaults_and_roundtrip(spark):
    df = spark.createDataFrame([(None, None), ("x", "y")], "a string, b string")
    got = df.select(
        dates.default_date_text("a", dt.date(2024, 3, 5)).alias("a"),
        dates.default_published_words("b", dt.date(2024, 3, 5)).alias("b"),
    ).collect()
    assert (got[0].a, got[0].b) == ("2024-03-05", "Published March 05, 2024")
    assert (got[1].a, got[1].b) == ("x", "y")
    d = spark.createDataFrame([(dt.date(1999, 12, 31),), (dt.date(800, 1, 2),)], "d date")
    back = d.select(dates.parse_day_month_year(dates.format_day_month_year("d")).alias("r")).collect()
    assert [r.r for r in back] == [dt.date(1999, 12, 31), dt.date(800, 1, 2)]
    bad = spark.createDataFrame([("31-02-2020",), ("not a date",), ("2020-05-06",)], "s string")
    assert [r.x for r in bad.select(dates.lenient_date("s").alias("x")).collect()] == [None, None, dt.date(2020, 5, 6)]


def test_text_two_pass_cleaning(spark):
    cases = [
        (None, P), ("", P), ("  ", P), ("\t\n", P), ("123", P), ("1st place", P), ("foo bar2", P),
        ("great book9\n", P), ("1984 a novel", "1984 a novel"), ("a9 b", "a9 b"), ("in 2x4 z", "in 2x4 z"),
        ("It is the 1990s", "It is the 1990s"), ("foo bar2 ", "foo bar2 "), ('x "q" é-ü', "x q "),
        ("плохо", P), ('Café "noir" été', "Caf noir t"),
    ]
    df = spark.createDataFrame([(c[0],) for c in cases], "t string")
    got = [r.c for r in df.select(text.clean_text("t", passes=2).alias("c")).collect()]
    assert got == [c[1] for c in cases]
    # a third pass changes nothing
    third = [r.c for r in df.select(text.clean_text("t", passes=3).alias("c")).collect()]
    assert third == got


def test_fast_edge_pattern_equals_reference_pattern(spark):
    samples = ["abc123", "abc 123", "x1", "1x", "12ab cd", "word", "ends with a9\n", "ends 9\n", "a9\r\n",
               "a9\n\n", "", "9", "a", "ab12cd", "zz99 ", "no digits here", "q7 "]
    df = spark.createDataFrame([(s,) for s in samples], "t string")
    got = df.select(
        F.col("t").rlike(text.DIGITS_LETTERS_EDGE).alias("ref"),
        F.col("t").rlike(text.DIGITS_LETTERS_EDGE_FAST).alias("fast"),
    ).collect()
    assert all(r.ref == r.fast for r in got)


def test_numbers(spark):
    df = spark.createDataFrame(
        [("8,932,568", "12.7", "4.25"), ("n/a", " 7 ", "x"), (None, "unknown", None), ("-3", "+4", "1e2")],
        "n string, p string, r string")
    got = df.select(
        numbers.to_int(numbers.strip_thousands("n")).alias("n"), numbers.to_int("p").alias("p"),
        numbers.to_float("r").alias("r"),
    ).collect()
    assert [(g.n, g.p) for g in got] == [(8932568, 12), (None, 7), (None, None), (-3, 4)]
    assert math.isclose(got[0].r, 4.25) and got[1].r is None and got[2].r is None


def _with_conf(spark, conf, run):
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        return run()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_dates_equal_the_legacy_parser(spark):
    samples = ["Jul 15, 2022", "Jul 2001", "July  15, 2022", "July 15, 2022 (ebook)", "2022 reissue", "july 15, 2022",
               "JULY 15, 2022", "  July 15, 2022", "July 15,2022", "July 15 2022", "Sept 5, 2020", "Sep 5, 2020", "May 2020",
               "February 30, 2020", "February 29, 2021", "July 0, 2020", "July 32, 2020", "2022", "  2022", "22", "0", "x 2022",
               "July", "July 15,", "Julyx 15, 2022", "July\t15, 2022", "July \t15, 2022", "July 15,  2022", "3 July 2022", "",
               "January 1, 1", "December 31, 999", "2022-01-05", "July 015, 2022", "Augustus 3, 2020", None]
    df = spark.createDataFrame([(s,) for s in samples], "d string")
    legacy = F.coalesce(*[F.to_date("d", f) for f in dates.DATE_FORMATS])
    want = _with_conf(spark, {"spark.sql.legacy.timeParserPolicy": "LEGACY", "spark.sql.ansi.enabled": "false"},
                      lambda: [r.p for r in df.select(legacy.cast("string").alias("p")).collect()])
    got = [r.p for r in df.select(dates.parse_date_cascade("d").cast("string").alias("p")).collect()]
    assert dict(zip(samples, got)) == dict(zip(samples, want))


def test_integers_equal_the_lenient_cast(spark):
    samples = [".5", ".", "\x0112", "12\u0085", "12", " 12 ", "+4", "-4", "-", "+", "", " ", "-.5", "+.", "12.", "12.7", "1.2.3", "1e2",
               "12 3", "\t7\n", "\x7f8", "2147483647", "2147483648", "-2147483648", "-2147483649", "2147483647.9", "007", "--1", "1-",
               "n/a", "\u00a05", "٣", "1_0", "0x1", None]
    df = spark.createDataFrame([(s,) for s in samples], "n string")
    want = _with_conf(spark, {"spark.sql.ansi.enabled": "false"}, lambda: [r.i for r in df.select(F.col("n").cast("int").alias("i")).collect()])
    got = [r.i for r in df.select(numbers.to_int("n").alias("i")).collect()]
    assert dict(zip(samples, got)) == dict(zip(samples, want))


def test_split_and_join(spark):
    df = spark.createDataFrame([("Fiction, Crime,, ",), ("",)], "g string")
    got = [r.a for r in df.select(arrays.split_items("g").alias("a")).collect()]
    assert got == [["Fiction", " Crime", "", " "], [""]]
    trimmed = [r.a for r in df.select(arrays.split_items("g", trim_items=True).alias("a")).collect()]
    assert trimmed[0] == ["Fiction", "Crime", "", ""]
    arr = spark.createDataFrame([([],), (None,), ([1, None, 3],)], "a array<bigint>")
    assert [r.s for r in arr.select(arrays.join_items("a").alias("s")).collect()] == ["", "", "1,3"]


def test_fill_defaults_casts_values(spark):
    from starloom.plans.clean import fill_defaults

    df = spark.createDataFrame([(None, None, float("nan"), None)], "pages int, rank string, rating float, score int")
    got = fill_defaults(df).first()
    assert (got.pages, got.rank, got.rating, got.score) == (0, "0", 0.0, 0)


def test_date_phrases_parameter(spark):
    from starloom.plans.clean import clean_records

    raw = spark.createDataFrame(
        [("a", "Published July 15, 2022"), ("b", "First published 1960")], "_id string, Date string"
    ).selectExpr("_id", "'1' AS Rank", "'t' AS Title", "'x' AS Author", "'1.0' AS Rating",
                 "'1' AS `Number of Ratings`", "'1' AS Reviews", "'1' AS Score", "'1' AS Pages",
                 "'p' AS `Cover Type`", "Date", "'d' AS Description", "'g' AS Genres")
    literal = {r.date_text: r.publish_date for r in clean_records(raw).collect()}
    assert literal["Published July 15, 2022"] == dt.date(1900, 1, 1)
    both = clean_records(raw, date_phrases=("First published ", "Published "))
    got = {r.date_text: r.publish_date for r in both.collect()}
    assert got == {"Published July 15, 2022": dt.date(2022, 7, 15), "First published 1960": dt.date(1960, 1, 1)}
