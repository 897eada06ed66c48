import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace.functions import dates, synthetic

D, T = dt.date, dt.datetime


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2020-01-02 03:04:05", T(2020, 1, 2, 3, 4, 5)),
        ("2020-01-02 03:04:05.678", T(2020, 1, 2, 3, 4, 5)),
        ("2020-01-02", T(2020, 1, 2)),
        ("2020-02-30 00:00:00", None),
        ("junk", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_ts(spark, text, expected):
    assert one(spark, dates.parse_ts(F.lit(text))) == expected


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_parsing_ignores_the_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # 02:30 does not exist on this day in New York.
        assert one(spark, dates.parse_ts(F.lit("2024-03-10 02:30:00"))) == T(2024, 3, 10, 2, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize(
    "text, expected",
    [
        ("02-01-2020 03:04:05", T(2020, 1, 2, 3, 4, 5)),
        ("02-01-2020", T(2020, 1, 2)),
        ("2020-01-02 03:04:05", None),
        ("31-02-2020 00:00:00", None),
        ("", None),
    ],
)
def test_parse_ts_day_first(spark, text, expected):
    assert one(spark, dates.parse_ts_day_first(F.lit(text))) == expected


@pytest.mark.parametrize(
    "text, expected",
    [("29/02/1988", D(1988, 2, 29)), ("29/02/1989", None), ("1988-02-29", None), ("", None), (None, None)],
)
def test_parse_date_day_first(spark, text, expected):
    assert one(spark, dates.parse_date_day_first(F.lit(text))) == expected


@pytest.mark.parametrize(
    "end, start, expected",
    [
        (D(2001, 2, 28), D(2000, 2, 29), (0, 11, 28)),
        (D(2001, 3, 1), D(2000, 2, 29), (1, 0, 1)),
        (D(2024, 12, 31), D(1990, 12, 31), (34, 0, 0)),
        (D(2024, 3, 30), D(2024, 1, 31), (0, 1, 30)),
        (D(2000, 3, 1), D(2024, 1, 31), (-23, -10, -30)),
        (D(2000, 3, 1), None, (None, None, None)),
    ],
)
def test_age_parts(spark, end, start, expected):
    age = dates.age_parts(F.lit(end).cast("date"), F.lit(start).cast("date"))
    assert tuple(one(spark, part) for part in age) == expected


def test_tenure_at_year_end(spark):
    years = one(spark, dates.age_in_years(F.lit(D(2024, 12, 31)), F.lit(D(2019, 1, 1))))
    assert round(years, 6) == 5.985626


def test_month_name_is_padded(spark):
    assert one(spark, dates.padded_month_name(F.lit(D(2024, 5, 1)))) == "May      "


def test_sunday_on_or_before(spark):
    assert one(spark, dates.sunday_on_or_before(F.lit(T(2024, 6, 1, 23, 59)))) == D(2024, 5, 26)
    assert one(spark, dates.sunday_on_or_before(F.lit(T(2024, 6, 2)))) == D(2024, 6, 2)


def test_seconds_keep_their_fraction(spark):
    a = F.lit("2024-01-01 00:00:01.5").cast("timestamp_ntz")
    b = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    assert one(spark, dates.seconds_between(a, b)) == 1.5


def test_rejected_texts(spark):
    df = spark.createDataFrame([("1", "junk", ""), ("2", "2020-01-01", None)], "id string, a string, b string")
    found = dates.rejected_texts(df, "id", {"a": dates.parse_ts, "b": dates.parse_ts}).collect()
    assert [tuple(r) for r in found] == [("1", "a", "junk")]


def test_draws_stay_in_range_and_depend_on_the_seed(spark):
    key = F.col("id").cast("string")
    draws = spark.range(5000).select(
        synthetic.whole_number(key, "x", "1", 3, 7).alias("a"), synthetic.whole_number(key, "x", "2", 3, 7).alias("b")
    )
    assert {r["a"] for r in draws.select("a").distinct().collect()} == {3, 4, 5, 6, 7}
    assert draws.where("a <> b").count() > 1000


def test_short_forms_equal_the_full_age(spark):
    days = spark.sql("select explode(sequence(date'1999-12-30', date'2001-03-02')) d")
    pairs = days.select(F.col("d").alias("a")).join(days.select(F.col("d").alias("b")), F.expr("(a != b or a = b)"))
    wrong = pairs.where(
        (dates.age_years("a", "b") != dates.age_parts("a", "b").years)
        | (
            (F.year("a") >= F.year("b"))
            & (F.abs(dates.age_from_new_year("a", "b") - dates.age_in_years("a", F.trunc("b", "year"))) > 1e-9)
        )
    )
    assert pairs.count() == 429**2 and wrong.isEmpty()
