"""Interval joins turned into equi-joins.

A date falls inside an employment span; a timestamp falls inside a week. Written as a range condition both
plan as a nested loop over every pair. Here each span lists the few calendar points it can touch (years or
months, at most as many as the calendar has) and joins them on equality; each timestamp computes its own
week. The exact condition stays as a residual filter.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def explode_month_ends(df: DataFrame, first: Column, last: Column, name: str, step_months: int = 1) -> DataFrame:
    """One row per month end between the months of ``first`` and ``last``, both included.

    With ``step_months=12`` the points are the year ends (``first`` and ``last`` then only give the years).
    Rows whose span is empty disappear.
    """
    unit = "month" if step_months == 1 else "year"
    start, stop = F.trunc(first, unit), F.trunc(last, unit)
    points = F.when(
        # sequence() would count backwards on an empty span.
        start <= stop,
        F.sequence(start, stop, F.expr(f"interval {step_months} months")),
    )
    return df.withColumn(name, F.explode(points)).withColumn(
        name, F.last_day(F.add_months(name, step_months - 1))
    )


def span_by_calendar(
    spans: DataFrame,
    calendar: DataFrame,
    start: str,
    end: str,
    as_of: dt.date,
    first_day: dt.date,
    calendar_date: str = "date",
    yearly: bool = False,
) -> DataFrame:
    """Inner join of ``spans`` with the calendar points not before ``start`` and not after the month of ``end``.

    ``calendar`` holds month ends (year ends if ``yearly``), one row each, so it has at most one row per
    calendar month and may be broadcast. The caller filters on the exact end condition.
    """
    points = explode_month_ends(
        spans.where(F.col(start).isNotNull()),
        F.greatest(F.col(start), F.lit(first_day)),
        F.least(F.coalesce(F.col(end), F.lit(as_of)), F.lit(as_of)),
        "_point",
        step_months=12 if yearly else 1,
    )
    return (
        points.join(F.broadcast(calendar), F.col("_point") == F.col(calendar_date), "inner")
        .where(F.col(start) <= F.col(calendar_date))
        .drop("_point")
    )


def month_number(day: Column) -> Column:
    """Months counted from year 0, so that neighbouring months differ by one."""
    return F.year(day) * 12 + F.month(day) - 1


def distinct_per_month(
    spans: DataFrame, group: Sequence[str], member: str, first: str, last: str, name: str
) -> DataFrame:
    """Distinct known members per group and month, from spans of month numbers (both ends included).

    Listing the months of every span would multiply the spans by their length. Instead overlapping spans of
    a member are merged, each merged span counts +1 where it starts and -1 after it ends, and running sums
    per group give the level of each month. Only changes are shuffled, combined per group and month before
    that. Months in which a group has no member at all are left out; a group whose members all lack a
    ``member`` value is kept with 0.

    Returns the group columns, ``month`` and ``name``.
    """
    group = list(group)
    distinct_spans = spans.where(F.col(first) <= F.col(last)).select(*group, member, first, last).distinct()
    # A member's distinct spans are bounded by the pairs of calendar months, whatever the row count.
    before = (
        Window.partitionBy(*group, member)
        .orderBy(first, last)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    merged = distinct_spans.withColumn(
        "_from", F.greatest(F.col(first), F.max(last).over(before) + 1)
    ).where(F.col("_from") <= F.col(last))
    steps = F.array(
        F.struct(F.col("_from").alias("month"), F.lit(1).alias("step")),
        F.struct((F.col(last) + 1).alias("month"), F.lit(-1).alias("step")),
    )
    known = F.col(member).isNotNull().cast("int")
    changes = (
        merged.select(*group, known.alias("_known"), F.explode(steps).alias("_s"))
        .groupBy(*group, F.col("_s.month").alias("month"))
        .agg(
            F.sum("_s.step").alias("_spans"),
            F.sum(F.col("_s.step") * F.col("_known")).alias("_members"),
        )
    )
    # One row per group and calendar month at most.
    in_order = Window.partitionBy(*group).orderBy("month")
    upto = in_order.rowsBetween(Window.unboundedPreceding, 0)
    levels = changes.select(
        *group,
        "month",
        (F.lead("month").over(in_order) - 1).alias("_until"),
        F.sum("_spans").over(upto).alias("_present"),
        F.sum("_members").over(upto).alias(name),
    ).where(F.col("_present") > 0)
    return levels.select(*group, F.explode(F.sequence("month", "_until")).alias("month"), name)
