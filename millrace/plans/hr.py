"""The HR mart."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions import synthetic
from millrace.functions.dates import age_from_new_year, age_years
from millrace.operators.intervals import span_by_calendar
from millrace.params import Params
from millrace.plans.registry import Inputs, model, project

DWH, HR = "dwh", "hr"

# Monthly pay range per level, months paid per year and performance labels.
PAY_RANGES = {
    "FRESHER": (280, 400),
    "JUNIOR": (400, 600),
    "MIDDLE": (600, 1000),
    "SENIOR": (1000, 1600),
    "EXPERT": (1600, 2400),
    "MANAGER": (1200, 2000),
    "DIRECTOR": (2000, 3200),
    "VISIONARY LEADER": (3200, 4800),
}
PAID_MONTHS = 13
PERFORMANCE_LABELS = ("Exceeds", "Fully Meets", "PIP", "Needs Improvement")


@model(HR, "dim_branches", [f"{DWH}.branches"])
def dim_branches(inputs: Inputs, p: Params) -> DataFrame:
    return inputs[f"{DWH}.branches"].select("branch_id", "branch_name")


@model(HR, "dim_departments", [f"{DWH}.departments"])
def dim_departments(inputs: Inputs, p: Params) -> DataFrame:
    return inputs[f"{DWH}.departments"].select("department_id", "department_name")


@model(HR, "dim_positions", [f"{DWH}.user_positions"])
def dim_positions(inputs: Inputs, p: Params) -> DataFrame:
    return inputs[f"{DWH}.user_positions"].select("position_id", "position_name")


@model(HR, "dim_month_year", [f"{DWH}.time_series"])
def dim_month_year(inputs: Inputs, p: Params) -> DataFrame:
    """Month ends as ``M`` rows and December ends again as ``Y`` rows, in one pass."""
    days = inputs[f"{DWH}.time_series"].where(
        F.col("is_month_end") & F.col("date").between(p.calendar_start, p.as_of)
    )
    codes = F.when(F.col("month") == 12, F.array(F.lit("M"), F.lit("Y"))).otherwise(F.array(F.lit("M")))
    return days.select(
        "date",
        F.explode(codes).alias("freq_code"),
        F.col("year").cast("string").alias("year"),
        "month_name",
        F.concat(F.col("year").cast("string"), F.lit("-"), F.col("month_name")).alias("month_year"),
    )


def yearly_absence(attendances: DataFrame) -> DataFrame:
    """Absent days per user and four-digit year text."""
    return attendances.groupBy(
        F.col("user_id").alias("emp_id"), F.date_format("end_date", "yyyy").alias("report_year")
    ).agg(F.sum("absent_day").alias("total_absence"))


def absence_by_user(attendances: DataFrame) -> DataFrame:
    """One row per user: a map from year text to absent days, with at most one entry per calendar year."""
    per_year = yearly_absence(attendances).where(F.col("report_year").isNotNull())
    return per_year.groupBy(F.col("emp_id").alias("user_id")).agg(
        F.map_from_entries(F.collect_list(F.struct("report_year", "total_absence"))).alias("absences")
    )


def yearly_pay(level: Column, row_key: Column, seed: str) -> Column:
    """A repeatable draw from the level's pay range; null for a level without one."""
    lows, spans = F.lit(None).cast("int"), F.lit(None).cast("int")
    for name, (low, high) in PAY_RANGES.items():
        lows = F.when(level == name, low).otherwise(lows)
        spans = F.when(level == name, high - low + 1).otherwise(spans)
    return PAID_MONTHS * F.floor(lows + synthetic.fraction(row_key, "emp_salary", seed) * spans).cast("int")


@model(HR, "fct_hrm_employees", [f"{DWH}.time_series", f"{DWH}.users", f"{DWH}.staff_attendances"])
def fct_hrm_employees(inputs: Inputs, p: Params) -> DataFrame:
    """One row per employee and year end while employed, leavers of that December included.

    The span of each employee lists its own year ends (at most ``fact_years`` + 1), so no date range join
    takes place. Absences join while an employee is still one row; nothing is shuffled after the years are
    listed.
    """
    first_day = dt.date(p.as_of.year - p.fact_years, 1, 1)
    year_ends = (
        inputs[f"{DWH}.time_series"]
        .where(
            F.col("is_month_end") & (F.col("month") == 12) & F.col("date").between(first_day, p.as_of)
        )
        .select("date")
    )
    users = inputs[f"{DWH}.users"].where(F.col("probation_date").isNotNull())
    absent = users.join(absence_by_user(inputs[f"{DWH}.staff_attendances"]), "user_id", "left")
    employed = span_by_calendar(
        absent, year_ends, "probation_date", "quit_date", p.as_of, first_day, yearly=True
    ).where(F.col("quit_date").isNull() | (F.col("quit_date") >= F.trunc("date", "month")))
    joined = employed.select(
        "*",
        F.concat_ws("|", "user_id", F.col("date").cast("string")).alias("_key"),
        F.col("absences")[F.year("date").cast("string")].alias("total_absence"),
    )
    key = F.col("_key")
    labels = F.array(*[F.lit(label) for label in PERFORMANCE_LABELS])
    engagement = synthetic.fraction(key, "engagement_score", p.seed) * 4 + 1
    return project(
        joined,
        {
            "report_date": "date",
            "emp_id": "user_id",
            "emp_name": "user_name",
            "emp_dob": "birthday",
            "emp_age": age_years("date", "birthday"),
            "emp_gender": "gender",
            "emp_email": "company_email",
            "staff_code": "staff_code",
            "branch_id": "branch_id",
            "department_id": "department_id",
            "position_id": "position_id",
            "emp_level": "user_level",
            "emp_status": "user_status",
            "probation_date": "probation_date",
            "quit_date": "quit_date",
            "tenure_years": F.round(
                age_from_new_year("date", "probation_date").cast("decimal(20,10)"), 1
            ),
            "total_absence": "total_absence",
            "emp_salary": yearly_pay(F.col("user_level"), key, p.seed),
            "satisfaction_score": synthetic.whole_number(key, "satisfaction_score", p.seed, 1, 10),
            "engagement_score": F.round(engagement.cast("decimal(20,10)"), 2),
            "performance_score": F.element_at(
                labels,
                synthetic.whole_number(key, "performance_score", p.seed, 1, len(PERFORMANCE_LABELS)),
            ),
        },
    )
