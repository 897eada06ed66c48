"""The monthly free-effort forecast per member, and its refresh as a keyed snapshot.

Actual effort comes from the work log, planned effort from approved pod efforts. Months with neither are
forecast from a moving average of actual effort, carried forward. Free effort is capacity minus the first of
actual, planned and forecast that exists.

``mode="reference"`` keeps three oddities of the published query: the moving average runs over all members'
rows together, planned and actual effort of one member only meet in months inside the spine (elsewhere they
stay two rows), and rows that tie on a month share their carried value. ``mode="fixed"`` averages per member
and always brings planned and actual effort of a month together, so (member_email, month_year) is unique.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.functions.dates import year_month
from millrace.operators.calendar import month_spine
from millrace.operators.windows import carry_forward, carry_forward_by_island, sequential_window
from millrace.params import Params
from millrace.plans.registry import Inputs, model
from millrace.session import cut_lineage

MART = "jira"
KEYS = ("member_email", "month_year")

# Seconds per hour, working hours per person-month, length of the moving average.
SECONDS_PER_HOUR = 3600
HOURS_PER_MONTH = 160
AVERAGE_ROWS = 4


def members_by_email(members: DataFrame) -> DataFrame:
    """One row per e-mail: how many member rows share it and how many distinct members they are.

    Joining this instead of the members keeps one hot e-mail from multiplying rows: sums are scaled by the
    row count, which is what the multiplied rows would have added up to.
    """
    return members.groupBy("member_email").agg(
        F.count(F.lit(1)).alias("member_rows"),
        F.countDistinct("member_id").alias("normal_efforts"),
    )


def _exact_sum(column: str) -> Column:
    """A sum that does not depend on the order of its rows, unlike one of floating numbers."""
    return F.sum(F.col(column).cast("decimal(28,8)")).cast("double")


def actual_efforts(worklog: DataFrame, members: DataFrame) -> DataFrame:
    """Worked person-months per member and month. The log shrinks to (author, month) before it joins."""
    # Months are dates until the log has shrunk: a text per row costs more than the sum, and is wider.
    worked = (
        worklog.where(F.col("worklog_author").isNotNull())
        .groupBy(F.col("worklog_author").alias("member_email"), F.trunc("start_time", "month").alias("month"))
        .agg(_exact_sum("time_worked").alias("seconds"))
        .withColumn("month_year", year_month("month"))
    )
    months = F.col("seconds") * F.col("member_rows") / SECONDS_PER_HOUR / HOURS_PER_MONTH
    return worked.join(members_by_email(members), "member_email").select(
        *KEYS, months.alias("actual_efforts"), "normal_efforts"
    )


def with_moving_average(actual: DataFrame, mode: str) -> DataFrame:
    """Adds ``ma4``, the average of this and the three rows before it by month."""
    if mode == "reference":
        # Both halves of the window read the input, so it is stored once instead of scanned twice.
        return sequential_window(
            cut_lineage(actual),
            leading=["month_year"],
            tie_keys=["member_email"],
            preceding=AVERAGE_ROWS - 1,
            columns=lambda w: {"ma4": F.avg("actual_efforts").over(w.rowsBetween(1 - AVERAGE_ROWS, 0))},
        )
    per_member = Window.partitionBy("member_email").orderBy(F.col("month_year").asc_nulls_last())
    return actual.withColumn(
        "ma4", F.avg("actual_efforts").over(per_member.rowsBetween(1 - AVERAGE_ROWS, 0))
    )


def planned_efforts(efforts: DataFrame, members: DataFrame) -> DataFrame:
    """Planned effort per member and month; both sides shrink to their distinct keys before the join."""
    planned = efforts.groupBy("member_id", "month_year").agg(_exact_sum("effort").alias("effort"))
    mailboxes = members.groupBy("member_id", "member_email").agg(F.count(F.lit(1)).alias("member_rows"))
    return (
        planned.join(mailboxes, "member_id")
        .withColumn("scaled", F.col("effort") * F.col("member_rows"))
        .groupBy(*KEYS)
        .agg(
            _exact_sum("scaled").alias("pod_efforts"),
            F.countDistinct("member_id").alias("planned_members"),
        )
    )


def combined_efforts(planned: DataFrame, actual: DataFrame, spine: DataFrame, mode: str) -> DataFrame:
    """Planned and actual effort side by side; both inputs are unique by member and month.

    The spine adds no member rows of its own (its unmatched months have no member and end up dropped). In
    reference mode it decides which planned rows may meet an actual row.
    """
    on = list(KEYS)
    if mode == "reference":
        inside = F.broadcast(spine.withColumn("meets", F.lit(True)))
        planned = planned.join(inside, "month_year", "left").withColumn(
            "meets", F.coalesce("meets", F.lit(False))
        )
        actual = actual.withColumn("meets", F.lit(True))
        on.append("meets")
    return planned.join(actual, on, "full_outer").select(
        *KEYS,
        F.coalesce("normal_efforts", "planned_members").alias("normal_efforts"),
        "actual_efforts",
        "ma4",
        "pod_efforts",
    )


def forecast(efforts: DataFrame, mode: str) -> DataFrame:
    """Adds the forecast: the previous row's average, carried forward over rows that have none.

    A member has at most a row or two per calendar month, so no partition of these windows can grow with
    the data.
    """
    # Where rows tie on the month, plan-only ones come first, so that the result is repeatable.
    order = [F.col("month_year").asc_nulls_last(), F.col("ma4").isNotNull()]
    by_month = Window.partitionBy("member_email").orderBy(*order)
    lagged = efforts.withColumn("lagged", F.lag("ma4").over(by_month))
    if mode == "reference":
        return carry_forward_by_island(
            lagged, "lagged", ["member_email"], "month_year", "predicting_efforts"
        )
    return lagged.withColumn("predicting_efforts", carry_forward("lagged", ["member_email"], order))


def build(worklog: DataFrame, members: DataFrame, efforts: DataFrame, p: Params) -> DataFrame:
    actual = with_moving_average(actual_efforts(worklog, members), p.mode)
    spine = month_spine(worklog.sparkSession, p.as_of, p.forecast_years)
    together = combined_efforts(planned_efforts(efforts, members), actual, spine, p.mode)
    used = F.coalesce("actual_efforts", "pod_efforts", "predicting_efforts")
    return (
        forecast(together, p.mode)
        .where(F.col("member_email").isNotNull())
        .select(
            *KEYS,
            "actual_efforts",
            "predicting_efforts",
            "pod_efforts",
            "normal_efforts",
            (F.col("normal_efforts") - used).alias("free_efforts"),
        )
    )


@model(
    MART,
    "mview_member_free_effort",
    [f"{MART}.fct_worklog", f"{MART}.dim_members", f"{MART}.fct_pod_member_efforts"],
    unique_key=KEYS,
)
def mview_member_free_effort(inputs: Inputs, p: Params) -> DataFrame:
    return build(
        inputs[f"{MART}.fct_worklog"],
        inputs[f"{MART}.dim_members"],
        inputs[f"{MART}.fct_pod_member_efforts"],
        p,
    )
