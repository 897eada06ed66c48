"""Day and month spines. Their size depends on the calendar alone, never on the data."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.functions.dates import padded_month_name

# The span of the stored day spine.
FIRST_DAY = dt.date(2000, 1, 1)
LAST_DAY = dt.date(2099, 12, 31)


def time_series_of(bounds: DataFrame) -> DataFrame:
    """One row per day from ``first`` to ``last`` of the single row of ``bounds``.

    Columns: time_id, date, year, month, month_name, quarter, is_month_end.
    """
    days = bounds.select(
        "first", F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("date")
    )
    return days.select(
        (F.datediff("date", "first") + 1).alias("time_id"),
        "date",
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        padded_month_name("date").alias("month_name"),
        F.quarter("date").alias("quarter"),
        (F.col("date") == F.last_day("date")).alias("is_month_end"),
    )


def time_series(spark: SparkSession, first: dt.date = FIRST_DAY, last: dt.date = LAST_DAY) -> DataFrame:
    """The stored day spine."""
    return time_series_of(
        spark.range(1, numPartitions=1).select(F.lit(first).alias("first"), F.lit(last).alias("last"))
    )


def month_spine(spark: SparkSession, as_of: dt.date, years: int = 5) -> DataFrame:
    """``month_year`` texts from December ``years`` ago to December of the year of ``as_of``."""
    return spark.range(1, numPartitions=1).select(
        F.explode(
            F.sequence(
                F.lit(dt.date(as_of.year - years, 12, 1)),
                F.lit(dt.date(as_of.year, 12, 1)),
                F.expr("interval 1 month"),
            )
        ).alias("month_start")
    ).select(F.date_format("month_start", "yyyy-MM").alias("month_year"))
