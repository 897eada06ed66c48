"""A stored run end to end: staging, models, view, log, counts, checks and reports."""

import datetime as dt
import threading
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from harness import catalogue
from millrace.operators import runlog
from millrace.plans import registry, runs
from millrace.plans.registry import MODELS, Model
from millrace.session import fresh_path
from millrace.sources import staging
from millrace.sources.tables import TableStore

SCHEMAS = ("src_create", "src_jira", "src_jisseki", "dwh", "hr", "jira", "monitoring")


@pytest.fixture
def store(spark):
    yield TableStore(spark, fresh_path(spark, "run"))
    for schema in SCHEMAS:
        spark.sql(f"DROP DATABASE IF EXISTS {schema} CASCADE")


def test_whole_run(spark, sf_dir, store):
    first = replace(catalogue.DELIVERY, load_ts=dt.datetime(2024, 6, 1))
    ws = catalogue.workspace(spark, sf_dir, first)

    def extract(source, table):
        return ws.table(f"{staging.SOURCES[source].schema}.{staging.staged_name(table)}")

    staged = runs.load_staging(store, extract, first)
    assert [o.status for o in staged] == [runlog.SUCCESS] * 26
    store.overwrite("dwh", "time_series", ws.table("dwh.time_series"))
    built = runs.build_models(store, MODELS, first)
    assert [(o.name, o.result) for o in built if o.status == runlog.FAILURE] == []
    assert len(built) == len(MODELS)

    stored, lazy = store.read("jira", "dim_members"), ws.table("jira.dim_members")
    assert stored.exceptAll(lazy).isEmpty() and lazy.exceptAll(stored).isEmpty() and stored.count() > 0
    stored, lazy = store.read("jira", "mview_member_free_effort"), ws.table("jira.mview_member_free_effort")
    assert stored.exceptAll(lazy).isEmpty() and lazy.exceptAll(stored).isEmpty()

    # The next day one source is down and one table shrinks.
    second = replace(first, load_ts=dt.datetime(2024, 6, 2))

    def extract_again(source, table):
        if table == "branches":
            raise OSError("source down")
        rows = extract(source, table)
        return rows.where("_id <> '1'") if table == "user_positions" or table == "company_departments" else rows

    staged = runs.load_staging(store, extract_again, second)
    assert [o.name for o in staged if o.status == runlog.FAILURE] == ["src_create.stg_branches"]
    log = store.read("monitoring", "etl_job_logs")
    assert log.count() == 26 + len(MODELS) + 26
    failures = log.where("status = 'FAILURE'").collect()
    assert [(r["target_table"], r["source_table"]) for r in failures] == [("stg_branches", '["branches"]')]
    members = log.where("target_table = 'jira_dtm-dim_members'").first()
    assert members["source_db"] == "dwh" and members["target_db"] == "dtm"

    texts = {r["table_name"]: r["report"] for r in runs.reports(store, second).collect()}
    assert "src_create.stg_branches" not in texts
    assert "New Rows Inserted: -1" in texts["src_create.stg_company_departments"]
    assert "New Rows Inserted: 0" in texts["src_create.stg_users"]


def test_what_reads_a_failed_model_is_skipped(spark, sf_dir, store):
    ws = catalogue.workspace(spark, sf_dir, catalogue.HR)
    store.overwrite("src_create", "stg_branches", ws.table("src_create.stg_branches").drop("branchName"))
    for name in ("stg_company_departments",):
        store.overwrite("src_create", name, ws.table(f"src_create.{name}"))
    outcomes = runs.build_models(store, ["hr.dim_branches", "hr.dim_departments"], catalogue.HR)
    assert {o.name: o.status for o in outcomes} == {
        "dwh.branches": runlog.FAILURE,
        "hr.dim_branches": runlog.FAILURE,
        "dwh.departments": runlog.SUCCESS,
        "hr.dim_departments": runlog.SUCCESS,
    }
    assert "not built: dwh.branches" in str({o.name: o.result for o in outcomes}["hr.dim_branches"])
    logged = store.read("monitoring", "etl_job_logs").where(F.col("status") == runlog.FAILURE)
    assert {r["target_table"] for r in logged.collect()} == {"branches", "hr_dtm-dim_branches"}


def test_checks_that_fail_stay_with_their_table(spark, store, monkeypatch):
    check = runs.quality.validate

    def broken(df, name):
        if name == "src_jira.bad":
            raise KeyError("v")
        return check(df, name)

    monkeypatch.setattr(runs.quality, "validate", broken)
    rows = spark.createDataFrame([(1, 2.0)], "id bigint, v double")
    outcomes = [runs.Outcome("job", "a", "b", ("t",), f"src_jira.{t}", t, rows) for t in ("bad", "good")]
    runs.record(store, outcomes, catalogue.DELIVERY)
    got = store.read("monitoring", runs.CHECKS).collect()
    assert [(r.expectation, r.success) for r in got if r.table_name == "src_jira.bad"] == [("checks_ran: KeyError", False)]
    assert len([r for r in got if r.table_name == "src_jira.good"]) > 1


def test_independent_models_are_built_at_the_same_time(spark, store, monkeypatch):
    """Two models that wait for each other's start both get built; readers come after, and only those of a failed one are skipped."""
    together = threading.Barrier(2, timeout=60)
    started = []

    def make(table, inputs=(), wait=False, fails=False):
        def build(found, p):
            started.append(table)
            if wait:
                together.wait()
            if fails:
                raise OSError("lost")
            return spark.range(1 + sum(f.count() for f in found.values()))

        return f"m.{table}", Model(table, tuple(f"m.{i}" for i in inputs), build, "m")

    models = dict([make("a", wait=True), make("b", wait=True), make("c", ["a", "b"]), make("d", fails=True), make("e", ["d", "a"]), make("f", ["e"])])
    for module in (runs, registry):
        monkeypatch.setattr(module, "MODELS", models)
    outcomes = {o.name: o.result for o in runs.build_models(store, models, catalogue.HR)}
    assert [n for n, r in outcomes.items() if isinstance(r, Exception)] == ["m.d", "m.e", "m.f"]
    assert outcomes["m.c"].count() == 3 and started.index("c") > max(started.index("a"), started.index("b"))
    assert "not built: m.e" in str(outcomes["m.f"]) and "e" not in started
    spark.sql("DROP DATABASE IF EXISTS m CASCADE")
