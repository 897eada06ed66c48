"""Staging to warehouse. Column pairs are fixed values: warehouse name, then staged name."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.functions.dates import (
    blank_to_null,
    parse_date,
    parse_date_day_first,
    parse_ts,
    parse_ts_day_first,
)
from millrace.operators.joins import equi_left_join, left_join_hot_right
from millrace.params import Params
from millrace.plans.registry import Inputs, model, project
from millrace.sources.cleaning import stamp

PORTAL, TRACKER, FACTS, DWH = "src_create", "src_jira", "src_jisseki", "dwh"


def _rename_model(table: str, source: str, columns: dict) -> None:
    """A model that only renames and parses the columns of one staged table.

    Values given as ``(parser, source column)`` are parsed; plain strings are copied.
    """

    def build(inputs: Inputs, p: Params) -> DataFrame:
        picked = {
            name: spec if isinstance(spec, str) else spec[0](F.col(spec[1]))
            for name, spec in columns.items()
        }
        return stamp(project(inputs[source], picked), p.load_ts)

    model(DWH, table, [source])(build)


def month_code_to_number(code):
    """``M3`` to ``03``."""
    return F.lpad(F.substr(code, F.lit(2)), 2, "0")


def nullable_ts(x):
    return parse_ts(blank_to_null(x))


def _effort_month(_):
    # concat, not concat_ws: a missing year or month must leave the whole value missing.
    return F.concat(F.col("year").cast("string"), F.lit("-"), month_code_to_number(F.col("month")))


_rename_model(
    "billable_efforts_approveds",
    f"{PORTAL}.stg_billable_efforts_approveds",
    {
        "effort_id": "_id",
        "user_id": "employeeObjId",
        "pod_id": "pODObjId",
        "department_id": "departmentObjId",
        "effort": "effort",
        "month_year": (_effort_month, "month"),
        "user_role": "role",
        "status": "status",
        "is_deleted": "isDeleted",
        "created_time": (parse_ts, "createdAt"),
        "updated_time": (parse_ts, "updatedAt"),
    },
)

_rename_model(
    "branches",
    f"{PORTAL}.stg_branches",
    {
        "branch_id": "_id",
        "branch_code": "branchCode",
        "branch_name": "branchName",
        "branch_address": "branchAddress",
        "is_hidden": "isHidden",
        "status": "status",
        "is_deleted": "isDeleted",
        "created_time": (parse_ts, "createdAt"),
    },
)

_rename_model(
    "departments",
    f"{PORTAL}.stg_company_departments",
    {
        "department_id": "_id",
        "branch_id": "branchObjId",
        "department_name": "departmentName",
        "level": "level",
        "children": "children",
        "parent_id": "parentObjId",
        "status": "status",
        "is_deleted": "isDeleted",
        "updated_time": (parse_ts, "updatedAt"),
    },
)

for _table, _source, _prefix in (
    ("jira_issue_priority", "stg_priority", "priority"),
    ("jira_issue_resolution", "stg_resolution", "resolution"),
    ("jira_issue_status", "stg_issuestatus", "status"),
    ("jira_issue_types", "stg_issuetype", "type"),
):
    _rename_model(
        _table,
        f"{TRACKER}.{_source}",
        {f"{_prefix}_id": "ID", f"{_prefix}_name": "pname", f"{_prefix}_description": "DESCRIPTION"},
    )

_rename_model(
    "jira_issues",
    f"{TRACKER}.stg_jiraissue",
    {
        "issue_id": "ID",
        "issue_number": "issuenum",
        "jira_project_id": "PROJECT",
        "issue_type": "issuetype",
        "issue_reporter": "REPORTER",
        "issue_assignee": "ASSIGNEE",
        "issue_creator": "CREATOR",
        "issue_summary": "SUMMARY",
        "issue_description": "DESCRIPTION",
        "issue_priority": "PRIORITY",
        "issue_resolution": "RESOLUTION",
        "resolution_date": "RESOLUTIONDATE",
        "issue_status": "issuestatus",
        "due_date": "DUEDATE",
        "time_original_estimate": "TIMEORIGINALESTIMATE",
        "time_estimate": "TIMEESTIMATE",
        "time_spent": "TIMESPENT",
        "environment": "ENVIRONMENT",
        "created_time": "CREATED",
        "updated_time": "UPDATED",
    },
)

_rename_model(
    "jira_worklog",
    f"{TRACKER}.stg_worklog",
    {
        "worklog_id": "ID",
        "issue_id": "issueid",
        "worklog_author": "AUTHOR",
        "worklog_description": "worklogbody",
        "start_time": "STARTDATE",
        "time_worked": "timeworked",
        "update_author": "UPDATEAUTHOR",
        "created_time": "CREATED",
        "updated_time": "UPDATED",
    },
)

_rename_model(
    "pods",
    f"{PORTAL}.stg_pods",
    {
        "pod_id": "_id",
        "project_code": "projectCode",
        "project_name": "projectName",
        "project_type": "projectType",
        "project_size": "projectSize",
        "project_rank": "projectRank",
        "project_overview": "projectOverview",
        "project_category": "projectCategory",
        "warranty_condition": "warrantyCondition",
        "development_model": "developmentModel",
        "department_id": "departmentObjId",
        "jira_url": "jiraUrl",
        "start_date": (parse_ts_day_first, "startDate"),
        "plan_uat_date": (parse_ts_day_first, "planUATDate"),
        "plan_release_date": (parse_ts_day_first, "planReleaseDate"),
        "final_release_date": (parse_ts_day_first, "finalReleaseDate"),
        "pod_status": "statusPOD",
        "status": "status",
        "is_deleted": "isDeleted",
        "created_time": (parse_ts, "createdAt"),
        "updated_time": (parse_ts, "updatedAt"),
    },
)

_rename_model(
    "project_members",
    f"{PORTAL}.stg_project_members",
    {
        "project_id": "projectObjId",
        "user_id": "userObjId",
        "joined_at": (nullable_ts, "joinedAt"),
        "left_at": (nullable_ts, "leftAt"),
        "status": "status",
        "is_deleted": "isDeleted",
        "user_level": "level",
        "updated_time": (parse_ts, "updatedAt"),
    },
)

_rename_model(
    "project_profit_loss",
    f"{PORTAL}.stg_profit_loss_project_expenses",
    {
        "project_id": "projectObjId",
        "user_id": "userObjId",
        "department_id": "departmentObjId",
        "branch_id": "branchObjId",
        "value": "value",
        "value1": "value1",
        "status": "status",
        "is_deleted": "isDeleted",
        "month_at": "monthAt",
        "updated_time": (parse_ts, "updatedAt"),
    },
)

_rename_model(
    "salaries",
    f"{PORTAL}.stg_salaries",
    {
        "salary_id": "_id",
        "user_id": "userObjId",
        "insurance": "insurance",
        "basic_salary": "salaryBasic",
        "total_salary": "totalSalary",
        "is_deleted": "isDeleted",
        "status": "status",
        "user_info_block": "userInfoBlock",
        "created_time": (parse_ts, "createdAt"),
        "updated_time": (parse_ts, "updatedAt"),
    },
)

_rename_model(
    "staff_attendances",
    f"{PORTAL}.stg_staff_attendances",
    {
        "attendance_id": "_id",
        "user_id": "userObjId",
        "attendance_type_id": "attendanceTypeObjId",
        "from_date": (parse_ts, "fromDate"),
        "end_date": (parse_ts, "endDate"),
        "absent_day": "absentDay",
        "absent_reason": "reason",
        "status_approval": "statusApproval",
        "date_approval": (parse_ts, "dateApproval"),
        "type": "type",
        "status": "status",
        "is_deleted": "isDeleted",
        "created_time": (parse_ts, "createdAt"),
        "updated_time": (parse_ts, "updatedAt"),
    },
)

_rename_model(
    "staff_attendances_types",
    f"{PORTAL}.stg_staff_attendance_types",
    {
        "attendance_type_id": "_id",
        "attendance_type_name": "attendanceTypeName",
        "attendance_type_code": "attendanceTypeCode",
        "attendance_work_day": "attendanceWorkDay",
        "status": "status",
        "is_deleted": "isDeleted",
        "type": "type",
        "unit_status": "unitStatus",
        "unit_type": "unitType",
        "unit_value": "unitValue",
        "created_time": (parse_ts, "createdAt"),
        "updated_time": (parse_ts, "updatedAt"),
    },
)

_rename_model(
    "user_positions",
    f"{PORTAL}.stg_user_positions",
    {
        "position_id": "_id",
        "position_code": "positionCode",
        "position_name": "positionName",
        "position_level": "positionLevel",
        "position_description": "positionDescription",
        "position_status": "positionStatus",
        "position_type": "type",
        "status": "status",
        "is_deleted": "isDeleted",
        "updated_time": "updatedAt",
    },
)


@model(
    DWH,
    "projects",
    [
        f"{PORTAL}.stg_projects",
        f"{PORTAL}.stg_project_categories",
        f"{FACTS}.stg_projects",
        f"{PORTAL}.stg_project_bill_costs",
    ],
)
def projects(inputs: Inputs, p: Params) -> DataFrame:
    """Portal projects with their category, external facts and total billed effort.

    Bills shrink to one row per project before they join. Facts are not unique by code: each match yields a
    row, and that side may be hot, hence the split left join.
    """
    portal = project(
        inputs[f"{PORTAL}.stg_projects"],
        {
            "project_id": "_id",
            "jira_project_id": "jiraProjectId",
            "project_code": "projectCode",
            "project_name": "projectName",
            "project_jira_url": "projectJiraUrl",
            "project_description": "projectDescription",
            "category_id": "projectCategoryObjId",
            "project_status": "projectStatus",
            "project_type": "projectType",
            "type": "type",
            "project_rank": "projectRank",
            "is_deleted": "isDeleted",
        },
    )
    categories = project(
        inputs[f"{PORTAL}.stg_project_categories"],
        {"_category": "_id", "project_category": "projectCategoryName"},
    )
    facts = project(
        inputs[f"{FACTS}.stg_projects"],
        {
            "project_code": "code",
            "name_pm": "name_pm",
            "name_brse": "name_br_se",
            "location": "location",
            "scope": "scope",
            "point_css": "point_css",
            "point_comment": "point_comment",
            "summary": "summary",
            "size": "size",
            "period": "period",
            "team_size": "team_size",
            "start_date": "startDate",
            "end_date": "endDate",
            "updated_time": "updated_at",
        },
    )
    billed = (
        inputs[f"{PORTAL}.stg_project_bill_costs"]
        .groupBy(F.col("projectObjId").alias("_billed"))
        .agg(F.sum(F.coalesce("billEffortMenMonth", F.lit(0))).alias("project_bill"))
    )
    # Bills join before facts, where each project is still one row.
    one_per_project = equi_left_join(
        equi_left_join(portal, categories, "category_id", "_category"), billed, "project_id", "_billed"
    )
    joined = left_join_hot_right(one_per_project, facts, ["project_code"])
    return stamp(
        joined.select(
            "project_id",
            "jira_project_id",
            "project_code",
            "project_name",
            "project_jira_url",
            "project_description",
            "project_category",
            "project_status",
            "project_type",
            "project_bill",
            "name_pm",
            "name_brse",
            "location",
            "scope",
            "type",
            "point_css",
            "point_comment",
            "summary",
            "size",
            "period",
            "project_rank",
            "team_size",
            "start_date",
            "end_date",
            "is_deleted",
            "updated_time",
        ),
        p.load_ts,
    )


@model(DWH, "users", [f"{PORTAL}.stg_users", f"{PORTAL}.stg_user_infos"])
def users(inputs: Inputs, p: Params) -> DataFrame:
    """Accounts with their personal record. The source's password column is not carried on."""
    accounts = project(
        inputs[f"{PORTAL}.stg_users"],
        {
            "user_id": "_id",
            "user_name": "name",
            "username": "username",
            "company_email": "email",
            "staff_code": "staffCode",
            "branch_id": "branchObjId",
            "department_id": "departmentObjId",
            "position_id": "userPositionObjId",
            "welcome_day": parse_date("welcomeDay"),
            "user_level": "userLevel",
            "user_status": "userStatus",
            "is_deleted": "isDeleted",
        },
    )
    records = project(
        inputs[f"{PORTAL}.stg_user_infos"],
        {
            "user_id": "userObjId",
            "staff_code": "staffCode",
            "birthday": parse_date_day_first("birthDay"),
            "address": "address",
            "gender": "gender",
            "personal_email": "emailPersonal",
            "mobile": "mobile",
            "probation_date": parse_date("probationDate"),
            "quit_date": parse_date("quitDate"),
        },
    )
    joined = accounts.join(records, ["staff_code", "user_id"], "left")
    return stamp(
        joined.select(
            "user_id",
            "user_name",
            "birthday",
            "address",
            "gender",
            "personal_email",
            "mobile",
            "username",
            "company_email",
            "staff_code",
            "branch_id",
            "department_id",
            "position_id",
            "welcome_day",
            "probation_date",
            "quit_date",
            "user_level",
            "user_status",
            "is_deleted",
        ),
        p.load_ts,
    )
