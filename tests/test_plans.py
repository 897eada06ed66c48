"""What the physical plans must not contain, and what the scans must not read."""

import re

import pytest

from __spark_entry__ import queries
from millrace.plans import analyses

QUERIES = queries()
# Queries whose single-task step holds one row per calendar month or year, per (month, slice) or per result.
BOUNDED_SINGLE_TASK = {
    # window over one row per (calendar month, digest slice)
    "d9_mview_member_free_effort_reference",
    "n1_moving_average",
    "s11_unique_key",
    "x1_headcount_sequence",
    # window over one row per calendar month or year
    "x1_headcount_total",
    "x5_ever_joined",
}

# Training-data operators may run numpy in tasks, but for the fourth.
FREE_STYLE = re.compile(r"op(?!4_)\d+_|pipeline")


def physical(spark, sf_dir, name):
    return QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_nested_loops_and_no_single_task_windows(spark, sf_dir, name):
    plan = physical(spark, sf_dir, name)
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    if not FREE_STYLE.match(name):
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    if name not in BOUNDED_SINGLE_TASK:
        assert not re.search(r"Window \[[^\n]*\n[^\n]*Sort [^\n]*\n[^\n]*Exchange SinglePartition", plan)


def columns_read(plan, table):
    found = set()
    for scan in re.findall(rf"FileScan parquet \[([^\]]*)\][^\n]*/{table}\.parquet", plan):
        found |= {re.sub(r"#\d+L?", "", c) for c in scan.split(",") if c}
    return found


def test_scans_read_only_what_they_need(spark, sf_dir):
    value = physical(spark, sf_dir, "x3_strict_project_value")
    assert columns_read(value, "lineitem") == {
        "l_partkey",
        "l_linenumber",
        "l_extendedprice",
        "l_tax",
    }
    weeks = physical(spark, sf_dir, "x13_resolution_hours")
    assert columns_read(weeks, "lineitem") == {"l_orderkey", "l_shipdate"}
    assert "o_totalprice" not in columns_read(weeks, "orders")


def test_filters_reach_the_scan(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    work = table.selectExpr(
        "l_orderkey worklog_id", "l_partkey jira_project_id", "l_returnflag worklog_author", "l_quantity time_worked"
    )
    members = work.selectExpr(*[f"worklog_author {c}" for c in analyses.MEMBER_COLUMNS])
    plan = analyses.worked_time(work, members, "A", 7)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(l_returnflag,A)" in plan and "EqualTo(l_partkey,7)" in plan
    assert columns_read(plan, "lineitem") == {"l_partkey", "l_returnflag", "l_quantity"}, plan


def test_projects_read_each_source_once(spark, sf_dir):
    """Portal projects and facts are joined without reading either side again."""
    plan = physical(spark, sf_dir, "w13_projects")
    before = plan.split("== Initial Plan ==")[0]
    assert before.count("/lineitem.parquet") <= 1 and before.count("/supplier.parquet") <= 1, plan
