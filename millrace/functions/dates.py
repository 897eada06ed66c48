"""Lenient text-to-time parsing and calendar arithmetic as column expressions.

Everything here stays inside generated code: no UDF, no session clock, and no dependence on the session
time zone (timestamps are ``timestamp_ntz`` throughout).
"""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import Column, functions as F

DAYS_PER_YEAR = 365.25
DAYS_PER_MONTH = 30


def as_column(value: Column | str | dt.date) -> Column:
    if isinstance(value, str):
        return F.col(value)
    return value if isinstance(value, Column) else F.lit(value)


def blank_to_null(x: Column | str) -> Column:
    return F.nullif(as_column(x), F.lit(""))


def parse_ts(x: Column | str) -> Column:
    """``YYYY-MM-DD HH:MM:SS`` text; a tail after the seconds is ignored and a bare date is midnight."""
    return F.substring(as_column(x), 1, 19).try_cast("timestamp_ntz")


def _day_first_to_iso(x: Column, separator: str) -> Column:
    return F.regexp_replace(x, rf"^(\d{{1,2}}){separator}(\d{{1,2}}){separator}(\d{{4}})", "$3-$2-$1")


def parse_ts_day_first(x: Column | str) -> Column:
    """``DD-MM-YYYY HH:MM:SS`` text, empty meaning missing."""
    text = blank_to_null(x)
    # Year-first text must not slip through the rewrite unchanged and parse as ISO.
    return F.when(text.rlike(r"^\d{1,2}-"), parse_ts(_day_first_to_iso(text, "-")))


def parse_date(x: Column | str) -> Column:
    """``YYYY-MM-DD`` text, empty meaning missing."""
    return F.substring(blank_to_null(x), 1, 10).try_cast("date")


def parse_date_day_first(x: Column | str) -> Column:
    """``DD/MM/YYYY`` text, empty meaning missing."""
    text = blank_to_null(x)
    return F.when(text.rlike(r"^\d{1,2}/"), _day_first_to_iso(text, "/").try_cast("date"))


def padded_month_name(d: Column | str) -> Column:
    """English month name blank-padded to nine characters."""
    return F.rpad(F.date_format(as_column(d), "MMMM"), 9, " ")


def year_month(ts: Column | str) -> Column:
    return F.date_format(as_column(ts), "yyyy-MM")


def is_sunday(d: Column | str) -> Column:
    return F.dayofweek(as_column(d)) == 1


def sunday_on_or_before(d: Column | str) -> Column:
    day = F.to_date(as_column(d))
    return F.date_sub(day, F.dayofweek(day) - 1)


class Age(NamedTuple):
    years: Column
    months: Column
    days: Column


def age_parts(end: Column | str | dt.date, start: Column | str | dt.date) -> Age:
    """Calendar difference of two dates in whole years, months and days.

    Missing days are borrowed from the length of the earlier date's month. All three parts are negative
    when ``end`` lies before ``start``.
    """
    a, b = as_column(end), as_column(start)
    late, early = F.greatest(a, b), F.least(a, b)
    # greatest/least skip nulls, so a null on either side has to be put back.
    sign = F.when(a.isNull() | b.isNull(), F.lit(None)).when(a < b, F.lit(-1)).otherwise(F.lit(1))
    day_gap = F.dayofmonth(late) - F.dayofmonth(early)
    short_days = (day_gap < 0).cast("int")
    total_months = (
        (F.year(late) - F.year(early)) * 12 + F.month(late) - F.month(early) - short_days
    )
    years = F.floor(total_months / 12).cast("int")
    return Age(
        years=sign * years,
        months=sign * (total_months - years * 12),
        days=sign * (day_gap + short_days * F.dayofmonth(F.last_day(early))),
    )


def age_years(end: Column | str | dt.date, start: Column | str | dt.date) -> Column:
    """The years of :func:`age_parts` in a shorter form. A leap-day birthday counts only from the 29th on."""

    def completed(late: Column, early: Column) -> Column:
        not_yet = F.month(late) * 32 + F.dayofmonth(late) < F.month(early) * 32 + F.dayofmonth(early)
        return F.year(late) - F.year(early) - not_yet.cast("int")

    a, b = as_column(end), as_column(start)
    return F.when(a >= b, completed(a, b)).otherwise(-completed(b, a))


def age_from_new_year(end: Column | str, start: Column | str) -> Column:
    """:func:`age_in_years` since January 1 of the year of ``start``, for an ``end`` in that year or later.

    Counted from the first day of a year, no month or day is ever borrowed.
    """
    a, b = as_column(end), as_column(start)
    rest = (F.month(a) - 1) * F.lit(DAYS_PER_MONTH) + F.dayofmonth(a) - 1
    return F.year(a) - F.year(b) + rest / F.lit(DAYS_PER_YEAR)


def age_in_years(end: Column | str | dt.date, start: Column | str | dt.date) -> Column:
    """Fractional years with a year of 365.25 days and a month of 30."""
    age = age_parts(end, start)
    return (
        age.years * F.lit(DAYS_PER_YEAR) + age.months * F.lit(DAYS_PER_MONTH) + age.days
    ) / F.lit(DAYS_PER_YEAR)


def seconds_between(end: Column | str, start: Column | str) -> Column:
    return F.timestamp_diff("MICROSECOND", as_column(start), as_column(end)) / 1_000_000


def days_between(end: Column | str, start: Column | str) -> Column:
    """Whole days, cut off towards zero."""
    return F.timestamp_diff("DAY", as_column(start), as_column(end))


def rejected_texts(df, key: str, parsers: dict[str, object]):
    """Non-empty texts a parser could not read, as ``(row_key, column_name, raw_text)`` rows."""
    cells = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(name).alias("column_name"),
                    F.col(name).alias("raw_text"),
                    (blank_to_null(name).isNotNull() & parser(F.col(name)).isNull()).alias("bad"),
                )
                for name, parser in parsers.items()
            ]
        )
    )
    return (
        df.select(F.col(key).alias("row_key"), cells.alias("cell"))
        .where("cell.bad")
        .select("row_key", "cell.column_name", "cell.raw_text")
    )
