"""The project-delivery mart."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.functions.dates import is_sunday
from millrace.operators.joins import equi_left_join, splittable_join
from millrace.params import Params
from millrace.plans.registry import Inputs, model, project

DWH, MART = "dwh", "jira"

_LOOKUPS = (
    ("jira_issue_types", "issue_type", "type_id", "type_name", "type"),
    ("jira_issue_resolution", "issue_resolution", "resolution_id", "resolution_name", "resolution"),
    ("jira_issue_status", "issue_status", "status_id", "status_name", "status"),
    ("jira_issue_priority", "issue_priority", "priority_id", "priority_name", "priority"),
)


@model(MART, "dim_jira_issues", [f"{DWH}.jira_issues", *[f"{DWH}.{t[0]}" for t in _LOOKUPS]])
def dim_jira_issues(inputs: Inputs, p: Params) -> DataFrame:
    """Issues with the names of their type, resolution, status and priority."""
    issues = inputs[f"{DWH}.jira_issues"]
    for table, foreign_key, key, label, name in _LOOKUPS:
        lookup = project(inputs[f"{DWH}.{table}"], {f"_{key}": key, name: label})
        issues = equi_left_join(issues, lookup, foreign_key, f"_{key}")
    return issues.select(
        "issue_id",
        "issue_assignee",
        "priority",
        "type",
        "resolution",
        "resolution_date",
        "status",
        "due_date",
        "time_original_estimate",
        "time_estimate",
        "time_spent",
        "created_time",
        "updated_time",
    )


# How the sources spell a missing text and a deactivated mailbox.
MISSING_TEXT = "null"
INACTIVE_PREFIX = "Inactive"


def _is_present(name: str):
    return F.col(name).isNotNull() & (F.col(name) != MISSING_TEXT)


@model(
    MART,
    "dim_members",
    [f"{DWH}.users", f"{DWH}.branches", f"{DWH}.departments", f"{DWH}.user_positions"],
)
def dim_members(inputs: Inputs, p: Params) -> DataFrame:
    """Members with a live company e-mail whose department, position and level are on the allow-lists.

    Every lookup column is tested, so the lookups are filtered first and join as inner joins.
    """
    members = inputs[f"{DWH}.users"].where(
        _is_present("company_email")
        & ~F.col("company_email").startswith(INACTIVE_PREFIX)
        & F.col("user_level").isin(*p.levels)
    )
    branches = inputs[f"{DWH}.branches"].where(_is_present("branch_name"))
    departments = inputs[f"{DWH}.departments"].where(F.col("department_name").isin(*p.departments))
    positions = inputs[f"{DWH}.user_positions"].where(F.col("position_name").isin(*p.positions))
    joined = (
        members.join(branches.select("branch_id", "branch_name"), "branch_id")
        .join(departments.select("department_id", "department_name"), "department_id")
        .join(positions.select("position_id", "position_name"), "position_id")
    )
    return project(
        joined,
        {
            "member_id": "user_id",
            "member_name": "user_name",
            "member_email": "company_email",
            "staff_code": "staff_code",
            "branch_name": "branch_name",
            "department_name": "department_name",
            "position_name": "position_name",
            "user_level": "user_level",
            "user_status": "user_status",
        },
    )


@model(MART, "dim_pods", [f"{DWH}.pods"])
def dim_pods(inputs: Inputs, p: Params) -> DataFrame:
    return inputs[f"{DWH}.pods"].select(
        "pod_id",
        "project_code",
        "project_name",
        "project_size",
        "jira_url",
        "department_id",
        "start_date",
        "plan_uat_date",
        "plan_release_date",
        "final_release_date",
        "pod_status",
        "status",
    )


PROJECT_COLUMNS = (
    "project_id",
    "jira_project_id",
    "project_name",
    "project_jira_url",
    "project_description",
    "project_bill",
    "project_category",
    "project_type",
    "project_status",
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


def projects_with_value(projects: DataFrame, profit_loss: DataFrame, value, columns) -> DataFrame:
    """Projects left-joined to one summed value per project.

    A project may come with many external facts, so its id can be hot on the left.
    """
    values = profit_loss.groupBy("project_id").agg(F.sum(value).alias("project_value"))
    joined = splittable_join(projects.select(*columns), values, ["project_id"], "left")
    return joined.select(*columns, "project_value")


@model(MART, "dim_projects", [f"{DWH}.projects", f"{DWH}.project_profit_loss"])
def dim_projects(inputs: Inputs, p: Params) -> DataFrame:
    """Projects with their value; a missing part of a value counts as zero."""
    zero = F.lit(0)
    return projects_with_value(
        inputs[f"{DWH}.projects"],
        inputs[f"{DWH}.project_profit_loss"],
        F.coalesce("value", zero) + F.coalesce("value1", zero),
        PROJECT_COLUMNS,
    )


@model(MART, "dim_time_series", [f"{DWH}.time_series"])
def dim_time_series(inputs: Inputs, p: Params) -> DataFrame:
    """Sundays. ``week_year`` pairs the calendar year with the ISO week, unpadded."""
    year = F.col("year").cast("string")
    return (
        inputs[f"{DWH}.time_series"]
        .where(F.col("date").between(p.calendar_start, p.as_of) & is_sunday("date"))
        .select(
            "date",
            F.concat(year, F.lit("-W"), F.weekofyear("date").cast("string")).alias("week_year"),
            "year",
            "month_name",
            F.concat(year, F.lit("-"), F.col("month_name")).alias("month_year"),
            "is_month_end",
        )
    )


@model(MART, "fct_pod_member_efforts", [f"{DWH}.billable_efforts_approveds"])
def fct_pod_member_efforts(inputs: Inputs, p: Params) -> DataFrame:
    return project(
        inputs[f"{DWH}.billable_efforts_approveds"],
        {
            "pod_id": "pod_id",
            "member_id": "user_id",
            "department_id": "department_id",
            "user_role": "user_role",
            "effort": "effort",
            "month_year": "month_year",
            "status": "status",
        },
    )


@model(MART, "fct_project_members", [f"{DWH}.project_members"])
def fct_project_members(inputs: Inputs, p: Params) -> DataFrame:
    return project(
        inputs[f"{DWH}.project_members"],
        {
            "project_id": "project_id",
            "member_id": "user_id",
            "joined_at": "joined_at",
            "left_at": "left_at",
        },
    )


@model(MART, "fct_worklog", [f"{DWH}.jira_worklog", f"{DWH}.jira_issues"])
def fct_worklog(inputs: Inputs, p: Params) -> DataFrame:
    """Work log rows with the project of their issue; one issue may own much of the log."""
    issues = inputs[f"{DWH}.jira_issues"].select("issue_id", "jira_project_id")
    return splittable_join(inputs[f"{DWH}.jira_worklog"], issues, ["issue_id"], "left").select(
        "worklog_id",
        "issue_id",
        "jira_project_id",
        "worklog_author",
        "worklog_description",
        "start_time",
        "time_worked",
        "created_time",
        "updated_time",
    )
