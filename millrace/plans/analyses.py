"""Ad-hoc analyses over the warehouse and the marts.

Each summary shrinks its fact table before it joins, so a hot project, author or week arrives at a join as a
few rows. Where the published query multiplies rows and then aggregates, the products are computed from
counts instead of being laid out.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window, functions as F

from millrace.functions.dates import seconds_between, sunday_on_or_before, year_month
from millrace.operators.intervals import distinct_per_month, month_number
from millrace.operators.joins import equi_left_join, splittable_join
from millrace.operators.windows import sequential_window
from millrace.params import Params
from millrace.plans.delivery import projects_with_value
from millrace.session import cut_lineage

HEADCOUNT_GROUP = ("branch_id", "department_id", "user_level")
FIRST_HEADCOUNT_DAY = dt.date(2005, 1, 31)


# Headcount ---------------------------------------------------------------------------------------


def monthly_headcount(time_series: DataFrame, users: DataFrame, p: Params) -> DataFrame:
    """Distinct staff per month end, branch, department and level; a month without staff keeps one row.

    Somebody counts from the month they start in up to the month before the one they quit in.
    """
    month_ends = time_series.where(
        F.col("is_month_end") & F.col("date").between(FIRST_HEADCOUNT_DAY, p.as_of)
    ).select(month_number(F.col("date")).alias("month"), F.col("date").alias("month_end"), "year", "month_name")
    first, last = month_number(F.lit(FIRST_HEADCOUNT_DAY)), month_number(F.lit(p.as_of))
    spans = users.where(F.col("probation_date").isNotNull()).select(
        *HEADCOUNT_GROUP,
        "staff_code",
        F.greatest(month_number(F.col("probation_date")), first).alias("first_month"),
        F.least(month_number(F.col("quit_date")) - 1, last).alias("last_month"),
    )
    counts = distinct_per_month(
        spans, HEADCOUNT_GROUP, "staff_code", "first_month", "last_month", "employee_count"
    )
    # The calendar side is preserved, and has one row per month.
    return (
        month_ends.join(counts, "month", "left")
        .drop("month")
        .withColumn("employee_count", F.coalesce("employee_count", F.lit(0)))
    )


def _with_change(df: DataFrame) -> DataFrame:
    before, now = F.col("previous_count"), F.col("employee_count")
    return df.withColumns(
        {
            "absolute_change": now - before,
            "percent_change": F.when(before != 0, F.round((now - before) / before * 100, 2)),
        }
    )


def headcount_change(time_series: DataFrame, users: DataFrame, p: Params, by: str = "group") -> DataFrame:
    """Headcount with the change against the row before.

    ``by="group"`` compares a branch, department and level with its own previous row; ``by="total"`` the
    whole company with the month before; ``by="sequence"`` each row with the row before it in one sequence
    over all months and groups, as the published query does.
    """
    counts = monthly_headcount(time_series, users, p)
    if by == "sequence":
        # Both halves of the window read the counts, so they are stored once instead of computed twice.
        ordered = sequential_window(
            cut_lineage(counts),
            leading=["month_end"],
            tie_keys=list(HEADCOUNT_GROUP),
            preceding=1,
            columns=lambda w: {"previous_count": F.lag("employee_count").over(w)},
        )
        return _with_change(ordered)
    keys = list(HEADCOUNT_GROUP)
    if by == "total":
        counts = counts.groupBy("month_end", "year", "month_name").agg(
            F.sum("employee_count").alias("employee_count")
        )
        keys = []
    # Without keys this is one row per month of the calendar, so a single task is enough for it.
    history = Window.partitionBy(*keys).orderBy("month_end")
    return _with_change(counts.withColumn("previous_count", F.lag("employee_count").over(history)))


def headcount_facts(time_series: DataFrame, users: DataFrame, p: Params) -> DataFrame:
    """Month-end headcount tagged ``M``, and December again tagged ``Y``."""
    codes = F.when(F.month("month_end") == 12, F.array(F.lit("M"), F.lit("Y"))).otherwise(
        F.array(F.lit("M"))
    )
    return monthly_headcount(time_series, users, p).select(
        F.col("month_end").alias("report_date"),
        *HEADCOUNT_GROUP,
        "employee_count",
        F.explode(codes).alias("freq_code"),
    )


def yearly_headcount(facts: DataFrame) -> DataFrame:
    return facts.where(F.col("freq_code") == "Y")


def total_headcount(facts: DataFrame) -> DataFrame:
    return (
        facts.where(F.col("freq_code") == "M")
        .groupBy("report_date")
        .agg(F.sum("employee_count").alias("total_employees"))
    )


def ever_joined(time_series: DataFrame, users: DataFrame, p: Params) -> DataFrame:
    """Distinct staff who had joined by each year end.

    The published quit test admits whoever is still there, leaves later, or left after joining; a joined
    employee only fails it when the quit date lies before the joining date. So nobody ever drops out again:
    staff are counted in the year they first qualify and the counts summed up over the calendar.
    """
    first_day = p.calendar_start
    year_ends = time_series.where(
        F.col("is_month_end") & (F.col("month") == 12) & F.col("date").between(first_day, p.as_of)
    ).select(F.col("date").alias("report_date"))
    joined = (
        users.where(
            F.col("staff_code").isNotNull()
            & (F.col("quit_date").isNull() | (F.col("quit_date") >= F.col("probation_date")))
        )
        .groupBy("staff_code")
        .agg(F.min("probation_date").alias("joined"))
        .where(F.col("joined").isNotNull())
        .groupBy(F.greatest(F.year("joined"), F.lit(first_day.year)).alias("joined_year"))
        .agg(F.count(F.lit(1)).alias("joiners"))
    )
    # One row per calendar year on the preserved side; joiners outside it are past the last report.
    per_year = year_ends.join(joined, F.year("report_date") == F.col("joined_year"), "left")
    upto = Window.orderBy("report_date").rowsBetween(Window.unboundedPreceding, 0)
    return per_year.select(
        "report_date", F.coalesce(F.sum("joiners").over(upto), F.lit(0)).alias("employee_count")
    )


# Projects ----------------------------------------------------------------------------------------


def projects_having_value(dim_projects: DataFrame) -> DataFrame:
    return dim_projects.where(F.col("project_value").isNotNull())


STRICT_VALUE_COLUMNS = (
    "project_id",
    "jira_project_id",
    "project_name",
    "project_jira_url",
    "location",
    "scope",
    "type",
    "point_css",
    "summary",
    "size",
    "period",
    "team_size",
    "start_date",
    "end_date",
)


def strict_project_value(projects: DataFrame, profit_loss: DataFrame) -> DataFrame:
    """Projects with their value, where a row missing either part adds nothing."""
    return projects_with_value(
        projects, profit_loss, F.col("value") + F.col("value1"), STRICT_VALUE_COLUMNS
    )


def future_projects(projects: DataFrame, as_of: dt.date) -> DataFrame:
    return projects.where(F.col("start_date") > F.lit(as_of).cast("timestamp_ntz"))


def members_of_pods(project_members: DataFrame, pods: DataFrame) -> DataFrame:
    """Member rows whose project is a pod, once per pod of that id."""
    keys = pods.select(F.col("_id").alias("projectObjId"))
    return project_members.join(keys, "projectObjId", "inner").select(*project_members.columns)


# Staff -------------------------------------------------------------------------------------------


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def absence_by_month(attendances: DataFrame) -> DataFrame:
    return attendances.groupBy("user_id", year_month("end_date").alias("year_month")).agg(
        F.sum("absent_day").alias("absent_days")
    )


def absence_by_year(attendances: DataFrame) -> DataFrame:
    return attendances.groupBy("user_id", F.year("end_date").alias("year")).agg(
        F.sum("absent_day").alias("absent_days")
    )


def users_with_attendance(staged_users: DataFrame, staged_attendances: DataFrame) -> DataFrame:
    """Users with at least one attendance row; the attendance side shrinks to its distinct users first."""
    present = staged_attendances.select(F.col("userObjId").alias("_id")).distinct()
    return staged_users.join(present, "_id", "left_semi")


def facts_with_absence(employee_facts: DataFrame) -> DataFrame:
    return employee_facts.where(F.col("total_absence").isNotNull())


def users_without_start(users: DataFrame) -> DataFrame:
    return users.where(F.col("probation_date").isNull())


def active_without_start(users: DataFrame, mode: str, last_year: int = 2025) -> DataFrame:
    """Distinct active staff lacking a start date.

    In reference mode a second test on the year of that missing date is kept, so the answer is always 0.
    """
    found = users.where((F.col("user_status") != "Inactivity") & F.col("probation_date").isNull())
    if mode == "reference":
        found = found.where(F.year("probation_date") <= last_year)
    return found.agg(F.countDistinct("staff_code").alias("staff_count"))


def pay_range(employee_facts: DataFrame) -> DataFrame:
    return employee_facts.agg(
        F.min("emp_salary").alias("min_salary"), F.max("emp_salary").alias("max_salary")
    )


def member(members: DataFrame, member_id: str) -> DataFrame:
    return members.where(F.col("member_id") == member_id)


# Issues and work -----------------------------------------------------------------------------------


def issues_with_status(issues: DataFrame, statuses: DataFrame) -> DataFrame:
    """Issues with their project, assignee and the name of their status."""
    names = statuses.select(F.col("status_id").alias("_status"), F.col("status_name").alias("status"))
    kept = issues.select("issue_id", "issue_assignee", "jira_project_id", "issue_status")
    return equi_left_join(kept, names, "issue_status", "_status").drop("issue_status")


def resolution_hours_by_week(issues: DataFrame, weeks: DataFrame, mode: str) -> DataFrame:
    """Mean hours from creation to resolution per week, empty weeks kept.

    ``weeks`` are Sundays. Weeks do not overlap, so an issue finds its week by arithmetic and the issues
    shrink to one row per week before they meet the calendar. In reference mode a week ends at Saturday
    midnight, which leaves out issues created during Saturday.
    """
    week = sunday_on_or_before("created_time")
    counted = issues.select("created_time", "resolution_date", week.alias("date")).where(
        F.col("resolution_date") > F.col("date").cast("timestamp_ntz")
    )
    if mode == "reference":
        counted = counted.where(
            F.col("created_time") <= F.date_add("date", 6).cast("timestamp_ntz")
        )
    hours = counted.groupBy("date").agg(
        (F.avg(seconds_between("resolution_date", "created_time")) / 3600).alias("avg_hour_resolution")
    )
    return weeks.select("date").join(hours, "date", "left")


def issues_of_type(dim_issues: DataFrame, type_name: str = "Bug") -> DataFrame:
    return dim_issues.where(F.col("type") == type_name)


SLA_GROUP = ("project_name", "location", "scope", "size")


def project_sla(dim_projects: DataFrame, project_members: DataFrame, issues: DataFrame) -> DataFrame:
    """Share of resolved, dated issues done by their due date, and the distinct team size.

    A project contributes members x issues row pairs to its group. Its issues are counted first, its rows
    shrink to one per group, and only then do they meet its distinct members, each weighted by its row count.
    """
    per_issue_project = (
        issues.where(F.col("resolution_date").isNotNull() & F.col("due_date").isNotNull())
        .groupBy("jira_project_id")
        .agg(
            F.count(F.lit(1)).alias("issues"),
            F.count_if(F.col("resolution_date") <= F.col("due_date")).alias("on_time"),
        )
    )
    projects = splittable_join(
        dim_projects.select("project_id", "jira_project_id", *SLA_GROUP),
        per_issue_project,
        ["jira_project_id"],
        "inner",
    )
    projects = projects.groupBy("project_id", *SLA_GROUP).agg(
        F.sum("issues").alias("issues"), F.sum("on_time").alias("on_time")
    )
    team = project_members.groupBy("project_id", "member_id").agg(F.count(F.lit(1)).alias("member_rows"))
    pairs, on_time = (F.col("member_rows") * F.col(c) for c in ("issues", "on_time"))
    return (
        splittable_join(team, projects, ["project_id"], "inner")
        .groupBy(*SLA_GROUP)
        .agg(
            F.countDistinct("member_id").alias("team_size"),
            (F.sum(on_time) / F.sum(pairs)).alias("sla_compliance_percent"),
        )
    )


MEMBER_COLUMNS = (
    "member_name",
    "member_email",
    "staff_code",
    "department_name",
    "position_name",
    "user_level",
)


def _work_by_author(worklog: DataFrame, project_id: str | None) -> DataFrame:
    if project_id is not None:
        worklog = worklog.where(F.col("jira_project_id") == project_id)
    return worklog.groupBy("worklog_author", "jira_project_id").agg(
        F.sum("time_worked").alias("time_worked")
    )


def worked_time(
    worklog: DataFrame, members: DataFrame, author: str | None = None, project_id: str | None = None
) -> DataFrame:
    """Seconds worked per member and project, for one author, one project or all of them."""
    if author is not None:
        worklog = worklog.where(F.col("worklog_author") == author)
    work = _work_by_author(worklog, project_id).where(F.col("worklog_author").isNotNull())
    people = members.groupBy(*MEMBER_COLUMNS).agg(F.count(F.lit(1)).alias("member_rows"))
    return people.join(work, people["member_email"] == work["worklog_author"], "inner").select(
        *MEMBER_COLUMNS,
        "jira_project_id",
        (F.col("time_worked") * F.col("member_rows")).alias("time_worked"),
    )


def contributions(
    dim_projects: DataFrame,
    project_members: DataFrame,
    members: DataFrame,
    worklog: DataFrame,
    issues: DataFrame,
    project_id: str | None = None,
    closed: str = "Closed",
) -> DataFrame:
    """Per project member: time worked on and issues closed in the project, missing ones as zero."""
    if project_id is not None:
        dim_projects = dim_projects.where(F.col("jira_project_id") == project_id)
        issues = issues.where(F.col("jira_project_id") == project_id)
    work = _work_by_author(worklog, project_id).withColumnRenamed("worklog_author", "member_email")
    resolved = issues.groupBy(F.col("issue_assignee").alias("member_email"), "jira_project_id").agg(
        F.countDistinct(F.when(F.col("status") == closed, F.col("issue_id"))).alias("issues_resolved")
    )
    # Members drop rows, so they join first. One member or one project may own much of the rows.
    of_members = splittable_join(project_members.select("project_id", "member_id"), members.select("member_id", *MEMBER_COLUMNS), ["member_id"], "inner")
    team = splittable_join(
        of_members.drop("member_id"), dim_projects.select("project_id", "project_name", "jira_project_id"), ["project_id"], "inner"
    )
    keys = ["member_email", "jira_project_id"]
    zero = F.lit(0)
    # Both summaries have one row per key, so they become one first and the wide team rows are shuffled once for both.
    done = work.join(resolved, keys, "full_outer")
    return (
        splittable_join(team, done, keys, "left")
        .select(
            "project_name",
            *MEMBER_COLUMNS,
            F.coalesce("time_worked", zero).alias("total_hours_worked"),
            F.coalesce("issues_resolved", zero).alias("issues_resolved"),
        )
        .orderBy("project_name", "member_name")
    )


# Run log -----------------------------------------------------------------------------------------


def log_of_target(job_log: DataFrame, target_table: str) -> DataFrame:
    return job_log.where(F.col("target_table") == target_table)


def log_with_status(job_log: DataFrame, status: str = "SUCCESS") -> DataFrame:
    """Entries of one status, newest first."""
    return job_log.where(F.col("status") == status).orderBy(F.col("created_time").desc())
