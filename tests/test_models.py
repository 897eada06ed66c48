"""Models on small hand-made inputs that hold the awkward rows."""

import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from harness import catalogue
from millrace import allowlists
from millrace.operators import calendar, quality
from millrace.params import Params
from millrace.plans import analyses, free_effort, hr
from millrace.plans.registry import MODELS

P = Params(as_of=dt.date(2024, 2, 28), load_ts=dt.datetime(2024, 3, 1))
D = dt.date


def frame(spark, columns, *rows):
    return spark.createDataFrame(list(rows), columns)


def build(name, p=P, **inputs):
    model = MODELS[name]
    return model.build({i: inputs[i.split(".")[1]] for i in model.inputs}, p)


def test_all_models_are_registered():
    by_schema = [sum(n.startswith(f"{s}.") for n in MODELS) for s in ("dwh", "hr", "jira")]
    assert by_schema == [18, 5, 9]


def test_default_allow_lists():
    assert [len(x) for x in (allowlists.DEPARTMENTS, allowlists.POSITIONS, allowlists.LEVELS)] == [67, 31, 6]


def test_month_codes(spark):
    columns = (
        "_id string, employeeObjId string, pODObjId string, departmentObjId string, effort double, year int, "
        "month string, role string, status string, isDeleted boolean, createdAt string, updatedAt string"
    )
    row = lambda y, m: ("1", "2", "3", "4", 1.0, y, m, "r", "s", False, "2024-01-01", None)
    staged = frame(spark, columns, row(2024, "M3"), row(2024, "M12"), row(None, "M1"), row(2024, None))
    found = build("dwh.billable_efforts_approveds", stg_billable_efforts_approveds=staged).collect()
    assert [r["month_year"] for r in found] == ["2024-03", "2024-12", None, None]
    assert found[0]["created_time"] == dt.datetime(2024, 1, 1) and found[0]["updated_time"] is None


def test_users_join_on_both_keys_and_drop_the_password(spark):
    accounts = frame(
        spark,
        "_id string, name string, username string, password string, email string, staffCode string, "
        "branchObjId string, departmentObjId string, userPositionObjId string, welcomeDay string, "
        "userLevel string, userStatus string, isDeleted boolean",
        *[(i, "n", "u", "secret", "e", c, "b", "d", "p", "", "L", "S", False) for i, c in (("1", "A"), ("2", "B"))],
    )
    records = frame(
        spark,
        "userObjId string, staffCode string, address string, gender string, emailPersonal string, mobile string, "
        "birthDay string, probationDate string, quitDate string",
        ("1", "A", "x", "F", "p", "m", "29/02/1988", "2020-01-01", ""),
        ("2", "A", "x", "F", "p", "m", "29/02/1988", "2020-01-01", ""),
    )
    found = {r["user_id"]: r for r in build("dwh.users", stg_users=accounts, stg_user_infos=records).collect()}
    assert "password" not in found["1"].asDict()
    assert (found["1"]["birthday"], found["1"]["quit_date"]) == (D(1988, 2, 29), None)
    assert found["2"]["birthday"] is None and found["2"]["staff_code"] == "B"


def test_projects_fan_out_on_shared_codes_but_not_on_bills(spark):
    names = (
        "_id jiraProjectId projectCode projectName projectJiraUrl projectDescription projectCategoryObjId "
        "projectStatus projectType type projectRank"
    ).split()
    portal = frame(
        spark,
        ", ".join(f"{n} string" for n in names) + ", isDeleted boolean",
        ("1", "10", "P1", *["x"] * 3, "c", *["x"] * 4, False),
        ("2", "20", "P2", *["x"] * 3, "none", *["x"] * 4, False),
        ("3", "30", None, *["x"] * 3, None, *["x"] * 4, False),
    )
    fact_names = "code name_pm name_br_se location scope point_comment summary size period".split()
    facts = frame(
        spark,
        ", ".join(f"{n} string" for n in fact_names)
        + ", point_css double, team_size int, startDate timestamp_ntz, endDate timestamp_ntz, updated_at timestamp_ntz",
        ("P1", "first", *["f"] * 7, 1.0, 2, None, None, None),
        ("P1", "second", *["f"] * 7, 1.0, 2, None, None, None),
    )
    found = MODELS["dwh.projects"].build(
        {
            "src_create.stg_projects": portal,
            "src_jisseki.stg_projects": facts,
            "src_create.stg_project_categories": frame(spark, "_id string, projectCategoryName string", ("c", "Cat")),
            "src_create.stg_project_bill_costs": frame(
                spark, "projectObjId string, billEffortMenMonth double", ("1", 1.5), ("1", None), ("1", 2.0), ("2", None)
            ),
        },
        P,
    )
    rows = sorted((r["project_id"], r["name_pm"] or "", r["project_category"], r["project_bill"]) for r in found.collect())
    assert rows == [("1", "first", "Cat", 3.5), ("1", "second", "Cat", 3.5), ("2", "", None, 0.0), ("3", "", None, None)]


MEMBER = (
    "user_id string, user_name string, company_email string, staff_code string, branch_id string, "
    "department_id string, position_id string, user_level string, user_status string"
)


def test_members_pass_every_test(spark):
    user = lambda i, email, b="1", d="1", p="1", level="JUNIOR": (i, "n", email, "s", b, d, p, level, "a")
    users = frame(
        spark,
        MEMBER,
        user("ok", "a@x"),
        user("none", None),
        user("text null", "null"),
        user("inactive", "Inactive_a@x"),
        user("lower case", "inactive_a@x"),
        user("branch", "a@x", b="2"),
        user("department", "a@x", d="2"),
        user("other position", "a@x", p="2"),
        user("level", "a@x", level="DIRECTOR"),
        user("no branch", "a@x", b=None),
    )
    found = build(
        "jira.dim_members",
        users=users,
        branches=frame(spark, "branch_id string, branch_name string", ("1", "B"), ("2", "null")),
        departments=frame(
            spark, "department_id string, department_name string", ("1", "R&D Department"), ("2", "Elsewhere")
        ),
        user_positions=frame(
            spark, "position_id string, position_name string", ("1", "Thử việc (BA)"), ("2", "Tester?")
        ),
    )
    assert sorted(r["member_id"] for r in found.collect()) == ["lower case", "ok"]


def employees(spark, p, *rows):
    users = frame(
        spark,
        "user_id string, user_name string, birthday date, gender string, company_email string, staff_code string, "
        "branch_id string, department_id string, position_id string, user_level string, user_status string, "
        "probation_date date, quit_date date",
        *[(i, "n", b, "F", "e", i, "1", "1", "1", level, "a", d0, d1) for i, b, level, d0, d1 in rows],
    )
    absences = frame(
        spark,
        "user_id string, absent_day double, end_date timestamp_ntz",
        ("a", 1.5, dt.datetime(2022, 5, 1)),
        ("a", 2.0, dt.datetime(2022, 12, 31, 23)),
        ("a", 4.0, dt.datetime(2021, 1, 1)),
        ("b", None, dt.datetime(2022, 1, 1)),
    )
    return build(
        "hr.fct_hrm_employees", p, time_series=calendar.time_series(spark), users=users, staff_attendances=absences
    )


def test_employee_facts(spark):
    found = employees(
        spark,
        P,
        ("a", D(1990, 12, 31), "JUNIOR", D(2021, 12, 31), None),
        ("b", D(2000, 2, 29), "INTERN", D(2020, 6, 1), D(2022, 12, 1)),
        ("c", None, "EXPERT", D(2020, 6, 1), D(2021, 11, 30)),
        ("d", None, "EXPERT", None, None),
        ("e", None, "EXPERT", D(2030, 1, 1), None),
        ("f", None, "EXPERT", D(2022, 1, 1), D(2020, 1, 1)),
        ("g", None, "EXPERT", D(1990, 1, 1), D(2004, 12, 31)),
    ).collect()
    rows = {(r["emp_id"], r["report_date"].year): r for r in found}
    assert sorted(rows) == [
        ("a", 2021), ("a", 2022), ("a", 2023), ("b", 2020), ("b", 2021), ("b", 2022), ("c", 2020), ("g", 2004),
    ]
    assert all((r["report_date"].month, r["report_date"].day) == (12, 31) for r in found)
    assert [rows["a", y]["emp_age"] for y in (2021, 2022)] == [31, 32]
    assert [float(rows["a", y]["tenure_years"]) for y in (2021, 2022, 2023)] == [1.0, 2.0, 3.0]
    assert [rows["a", y]["total_absence"] for y in (2021, 2022, 2023)] == [4.0, 3.5, None]
    assert rows["b", 2022]["total_absence"] is None and rows["b", 2020]["emp_salary"] is None
    assert rows["c", 2020]["emp_age"] is None
    for r in found:
        assert 1 <= r["satisfaction_score"] <= 10 and 1 <= r["engagement_score"] <= 5
        assert r["performance_score"] in hr.PERFORMANCE_LABELS
        if r["emp_level"] in hr.PAY_RANGES:
            low, high = hr.PAY_RANGES[r["emp_level"]]
            assert r["emp_salary"] % 13 == 0 and low <= r["emp_salary"] // 13 <= high


def test_draws_follow_the_seed(spark):
    row = ("a", None, "DIRECTOR", D(2000, 1, 1), None)
    pay = lambda seed: [r["emp_salary"] for r in employees(spark, replace(P, seed=seed), row).orderBy("report_date").collect()]  # noqa: E731,E501
    assert pay("1") == pay("1") != pay("2")


def test_calendar_dimensions(spark):
    days = calendar.time_series(spark)
    months = build("hr.dim_month_year", time_series=days)
    # As-of is no month end: the last one is January 2024.
    assert months.where("freq_code = 'M'").count() == 19 * 12 + 1
    assert months.where("freq_code = 'Y'").count() == 19
    assert months.where("freq_code = 'Y'").first()["month_year"] == "2005-December "
    weeks = build("jira.dim_time_series", time_series=days)
    first = weeks.orderBy("date").first()
    assert (first["date"], first["week_year"]) == (D(2005, 1, 2), "2005-W53")


# Free effort -------------------------------------------------------------------------------------


def efforts(spark, mode):
    members = frame(
        spark,
        "member_id string, member_email string",
        ("1", "a@x"),
        ("2", "b@x"),
        ("3", "both@x"),
        ("4", "both@x"),
        ("5", "idle@x"),
    )
    at = lambda y, m: dt.datetime(y, m, 15)
    month = 3600.0 * 160
    worklog = frame(
        spark,
        "worklog_author string, start_time timestamp_ntz, time_worked double",
        ("a@x", at(2023, 1), month),
        ("a@x", at(2023, 2), month / 2),
        ("a@x", at(2010, 1), month / 4),
        ("both@x", at(2023, 1), month),
        ("stranger@x", at(2023, 1), month),
        (None, at(2023, 1), month),
    )
    planned = frame(
        spark,
        "member_id string, month_year string, effort double",
        ("1", "2023-02", 0.5),
        ("1", "2023-06", 0.25),
        ("1", "2023-09", 0.75),
        ("1", "2010-01", 0.125),
        ("2", "2023-01", 0.5),
        ("2", "2023-01", 0.25),
        ("9", "2023-01", 1.0),
    )
    found = free_effort.build(worklog, members, planned, replace(P, mode=mode)).collect()
    rows = {}
    for r in found:
        rows.setdefault((r["member_email"], r["month_year"]), []).append(r)
    return rows


def test_free_effort_fixed(spark):
    rows = efforts(spark, "fixed")
    assert all(len(r) == 1 for r in rows.values())
    one = {k: r[0] for k, r in rows.items()}
    assert sorted(one) == [
        ("a@x", "2010-01"), ("a@x", "2023-01"), ("a@x", "2023-02"), ("a@x", "2023-06"), ("a@x", "2023-09"),
        ("b@x", "2023-01"), ("both@x", "2023-01"),
    ]
    # Out of the spine, planned and actual effort still share a row.
    assert (one["a@x", "2010-01"]["actual_efforts"], one["a@x", "2010-01"]["pod_efforts"]) == (0.25, 0.125)
    # The forecast is the average before the row, then carried over later plan-only rows.
    assert one["a@x", "2010-01"]["predicting_efforts"] is None
    assert one["a@x", "2023-01"]["predicting_efforts"] == 0.25
    assert one["a@x", "2023-02"]["predicting_efforts"] == pytest.approx((0.25 + 1) / 2)
    average = (0.25 + 1 + 0.5) / 3
    assert one["a@x", "2023-06"]["predicting_efforts"] == pytest.approx(average)
    assert one["a@x", "2023-09"]["predicting_efforts"] == pytest.approx(average)
    # Planned effort outranks the forecast, actual effort outranks both.
    assert one["a@x", "2023-06"]["free_efforts"] == 0.75
    assert one["a@x", "2023-02"]["free_efforts"] == 0.5
    assert one["b@x", "2023-01"]["pod_efforts"] == 0.75
    # Two members behind one e-mail double the work and the capacity.
    assert (one["both@x", "2023-01"]["actual_efforts"], one["both@x", "2023-01"]["normal_efforts"]) == (2.0, 2)


def test_free_effort_reference_splits_months_outside_the_spine(spark):
    rows = efforts(spark, "reference")
    outside = rows["a@x", "2010-01"]
    assert sorted((r["actual_efforts"], r["pod_efforts"]) for r in outside if r["actual_efforts"]) == [(0.25, None)]
    assert [(r["pod_efforts"]) for r in outside if r["actual_efforts"] is None] == [0.125]
    assert len(rows["a@x", "2023-02"]) == 1


def test_mode_is_checked():
    with pytest.raises(ValueError):
        replace(P, mode="other")


# Analyses ----------------------------------------------------------------------------------------


def test_resolution_hours_and_saturdays(spark):
    weeks = frame(spark, "date date", (D(2024, 1, 7),), (D(2024, 1, 14),))
    ts = dt.datetime
    issues = frame(
        spark,
        "created_time timestamp_ntz, resolution_date timestamp_ntz",
        (ts(2024, 1, 8), ts(2024, 1, 8, 2)),
        (ts(2024, 1, 13), ts(2024, 1, 13, 4)),
        (ts(2024, 1, 13, 12), ts(2024, 1, 14, 0)),
        (ts(2024, 1, 8), None),
        (ts(2024, 1, 9), ts(2024, 1, 1)),
    )
    hours = lambda mode: {
        r["date"]: r["avg_hour_resolution"]
        for r in analyses.resolution_hours_by_week(issues, weeks, mode).collect()
    }
    assert hours("reference") == {D(2024, 1, 7): 3.0, D(2024, 1, 14): None}
    assert hours("fixed") == {D(2024, 1, 7): 6.0, D(2024, 1, 14): None}


def test_point_forms_of_the_member_reports(spark, sf_dir):
    ws = catalogue.workspace(spark, sf_dir, catalogue.HR)
    worklog, members = ws.table("jira.fct_worklog"), ws.table("jira.dim_members")
    everything = analyses.worked_time(worklog, members)
    some = everything.first()
    author, project = some["member_email"], some["jira_project_id"]
    point = analyses.worked_time(worklog, members, author, project)
    expected = everything.where((F.col("member_email") == author) & (F.col("jira_project_id") == project))
    assert sorted(map(tuple, point.collect())) == sorted(map(tuple, expected.collect()))
    issues = analyses.issues_with_status(ws.table("dwh.jira_issues"), ws.table("dwh.jira_issue_status"))
    args = (ws.table("jira.dim_projects"), ws.table("jira.fct_project_members"), members, worklog, issues)
    one = analyses.contributions(*args, project_id=project)
    whole = analyses.contributions(*args)
    assert 0 < one.count() < whole.count()
    assert one.exceptAll(whole).isEmpty()


# Quality -----------------------------------------------------------------------------------------


def test_suite_on_awkward_columns(spark):
    values = [float(i) for i in range(100)]
    df = spark.createDataFrame(
        [(str(i % 60), v, 5.0, None, 1e6 if i == 0 else 0.5, i % 2 == 0) for i, v in enumerate(values)],
        "some_id string, v double, same double, empty double, spike double, flag boolean",
    )
    found = {(r["column_name"], r["expectation"]): r for r in quality.validate(df, "t").collect()}
    get = lambda c, e: (found[c, e]["evaluated"], found[c, e]["unexpected"], found[c, e]["success"])
    assert get("empty", quality.NOT_NULL) == (100, 100, False)
    assert get("some_id", quality.UNIQUE) == (100, 80, False)
    assert get("v", quality.BETWEEN) == (100, 10, False)
    assert get("same", quality.BETWEEN) == (100, 0, True)
    assert get("empty", quality.BETWEEN) == (0, 0, True)
    assert get("spike", quality.NOT_IN_SET) == (100, 1, True)
    assert get("same", quality.NOT_IN_SET) == (100, 0, True)
    assert get("flag", quality.OF_TYPE) == (100, 0, True)
    assert ("flag", quality.BETWEEN) not in found
    assert len(found) == 6 + 1 + 4 + 6 + 4


def test_suite_of_an_empty_table(spark):
    results = quality.validate(spark.createDataFrame([], "id int, v double"), "t")
    assert results.where("not success").isEmpty()


def test_report_without_failures(spark):
    results = quality.check_not_null(spark.range(3), "t")
    counts = frame(spark, "table_name string, total_rows long, new_rows long", ("t", 3, -1))
    text = quality.report(results, counts).first()["report"]
    assert text.splitlines() == [
        "Table: t",
        "Total Rows: 3",
        "New Rows Inserted: -1",
        "Status: Passed",
        "Total Expectations: 1",
        "Successful: 1",
        "Success Rate: 100.00%",
        "All expectations passed!",
    ]


def test_contributions_shuffles_the_team_once_per_join(spark):
    """Work and closed issues meet in one summary, so that the wide team rows are not shuffled for each."""
    people = "member_id string, " + ", ".join(f"{c} string" for c in analyses.MEMBER_COLUMNS)
    members = spark.createDataFrame([("m1", *["a"] * 6), ("m2", *["b"] * 6), ("m3", *[None] * 6)], people)
    projects = spark.createDataFrame([("p1", "P1", "1"), ("p2", "P2", None)], "project_id string, project_name string, jira_project_id string")
    team = spark.createDataFrame([("p1", "m1"), ("p1", "m1"), ("p1", "m2"), ("p1", "m3"), ("p2", "m1"), (None, "m1"), ("p1", None)], "project_id string, member_id string")
    log = spark.createDataFrame([("a", "1", 2.0), ("a", "1", 3.0), (None, "1", 9.0), ("a", None, 9.0)], "worklog_author string, jira_project_id string, time_worked double")
    issues = spark.createDataFrame([("b", "1", "Closed", 1), ("b", "1", "Open", 2), (None, None, "Closed", 3)], "issue_assignee string, jira_project_id string, status string, issue_id int")
    found = analyses.contributions(projects, team, members, log, issues)
    rows = sorted((r["project_name"], r["member_email"] or "", r["total_hours_worked"], r["issues_resolved"]) for r in found.collect())
    assert rows == [("P1", "", 0.0, 0), ("P1", "a", 5.0, 0), ("P1", "a", 5.0, 0), ("P1", "b", 0.0, 1), ("P2", "a", 0.0, 0)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 1 and plan.count("Join FullOuter") == 1
