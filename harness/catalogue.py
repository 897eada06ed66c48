"""The checked queries: each takes (spark, sf_dir) and runs over the whole test tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Mapping
from dataclasses import replace
from functools import cache, partial, reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    DateType,
    DecimalType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from harness.bindings import SCHEMAS, SparkDialect, views
from millrace.functions import dates
from millrace.operators import calendar, quality, runlog, snapshots
from millrace.operators.intervals import span_by_calendar
from millrace.params import Params
from millrace.plans import analyses, delivery, free_effort, hr, warehouse  # noqa: F401 - registers models
from millrace.plans.registry import MODELS, Workspace
from millrace.session import fresh_path, tune
from millrace.sources import cleaning, readers, staging
from millrace.sources.tables import TableStore

LOAD_TS = dt.datetime(2024, 6, 1)
SEED = "7"
DEPARTMENTS = tuple(
    "R&D NATION_10" if n == 10 else f"NATION_{n}" for n in range(25) if n not in (7, 13)
)
POSITIONS = ("AUTOMOBILE", "BUILDING", "HOUSEHOLD", "MACHINERY")
HR = Params(
    as_of=dt.date(2024, 12, 31), load_ts=LOAD_TS, seed=SEED, departments=DEPARTMENTS, positions=POSITIONS
)
DELIVERY = replace(HR, as_of=dt.date(2001, 12, 31), calendar_start=dt.date(1995, 1, 1))
REFERENCE = replace(DELIVERY, mode="reference")
# Work logged from here on is missing in the older of two compared view versions.
OLD_VIEW_CUTOFF = dt.datetime(2001, 7, 1)
FUTURE_FROM = dt.date(1995, 3, 1)
SOME_MEMBER = "27"
VALUE_TABLE = "dwh.project_profit_loss"

VIEWS = views(SparkDialect())

PROJECT_DIGITS = {"project_bill": 2, "project_value": 2, "team_size": 0}
EMPLOYEE_DIGITS = {
    "total_absence": 4,
    "tenure_years": 1,
    "engagement_score": 2,
    "emp_age": 0,
    "emp_salary": 0,
}
CHANGE_DIGITS = {"previous_count": 0, "absolute_change": 0}
AGE_DIGITS = {"years": 0, "months": 0, "days": 0}


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def calendar_bounds(read: Callable[[str], DataFrame]) -> DataFrame:
    """First day of the first order's year to the last day of the last event's year."""
    first = read("orders").agg(F.to_date(F.min("o_orderdate")).alias("d"))
    last = read("events").agg(F.to_date(F.max("ts")).alias("d"))
    return (
        first.unionByName(last)
        .agg(F.min("d").alias("d0"), F.max("d").alias("d1"))
        .select(
            F.trunc("d0", "year").alias("first"),
            F.last_day(F.add_months(F.trunc("d1", "year"), 11)).alias("last"),
        )
    )


def workspace(spark: SparkSession, sf_dir: str, p: Params) -> Workspace:
    tune(spark)
    # Opening a file reads its footer, so each is opened once.
    read = cache(partial(raw, spark, sf_dir))

    def given(name: str) -> DataFrame:
        if name == "dwh.time_series":
            return calendar.time_series_of(calendar_bounds(read))
        view = VIEWS[name]
        return spark.sql(view.select, **{t: read(t) for t in view.tables})

    return Workspace(given, p)


def present(df: DataFrame, digits: Mapping[str, int] | None = None) -> DataFrame:
    """Dates and times as ISO text, decimals as doubles and long fractions rounded, so that engines compare alike.

    Whole numbers that may be missing are listed with 0 digits: some clients read them as doubles anyway.
    """
    columns = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, TimestampNTZType):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(f.dataType, DecimalType):
            c = c.cast("double")
        if digits and f.name in digits:
            c = F.round(c.cast("double"), digits[f.name])
        columns.append(c.alias(f.name))
    return df.select(*columns)


Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str, p: Params = HR, digits: Mapping[str, int] | None = None):
    """Registers ``f(table, p)`` where ``table`` resolves staged, warehouse and mart names."""

    def register(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ws = workspace(spark, sf_dir, p)
            return present(f(ws.table, p), digits)

        QUERIES[name] = run
        return f

    return register


def scan_query(name: str, digits: Mapping[str, int] | None = None):
    """Registers ``f(spark, read)`` where ``read`` opens a test table."""

    def register(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            tune(spark)
            return present(f(spark, partial(raw, spark, sf_dir)), digits)

        QUERIES[name] = run
        return f

    return register


def model_query(key: str, name: str, p: Params = HR, digits: Mapping[str, int] | None = None) -> None:
    query(f"{key}_{name.split('.')[1]}", p, digits)(lambda table, _: table(name))


# Sources and sinks -------------------------------------------------------------------------------


@scan_query("s1_relational_scan")
def _(spark, read):
    read("customer").createOrReplaceTempView("source_customer")
    return readers.extract_sql_data(spark, "SELECT * FROM source_customer")


@scan_query("s1_split_scan")
def _(spark, read):
    """A table in parts of equal size, by a column that repeats; one value owns many rows."""
    split = readers.Split("o_orderpriority", 8, "o_orderkey")
    source = staging.Source(schema="src_orders", tables=("source_orders",), splits={"source_orders": split})
    read("orders").createOrReplaceTempView("source_orders")
    return source.extract(spark, "source_orders")


@scan_query("s2_document_scan")
def _(spark, read):
    path = fresh_path(spark, "documents-export")
    conversations = read("conversations")
    conversations.write.json(path)
    return readers.extract_document_data(spark, path, conversations.schema)


def _documents(read) -> DataFrame:
    """Nested documents, one per conversation turn, as a document store exports them."""

    def object_id(c):
        return F.struct(F.lpad(c.cast("string"), 24, "0").alias(cleaning.OBJECT_ID))

    return read("conversations").select(
        object_id(F.col("conv_id") * 1000 + F.col("turn")).alias("_id"),
        F.struct(
            object_id(F.col("conv_id")).alias("conversation"),
            F.col("role").alias("role"),
            F.col("text").alias("text"),
        ).alias("author"),
        F.array(object_id(F.col("turn")), object_id(F.col("turn") + 1)).alias("links"),
        F.concat(F.col("role"), F.char(F.lit(0)), F.col("text"), F.char(F.lit(0))).alias("body"),
    )


@scan_query("s3_object_ids")
def _(spark, read):
    flat = cleaning.convert_object_ids(_documents(read))
    return flat.select(
        "_id",
        F.col("author.conversation").alias("conversation_id"),
        F.col("author.role").alias("role"),
        F.element_at("links", 1).alias("first_link"),
        F.element_at("links", 2).alias("second_link"),
    )


@scan_query("s4_json_cells")
def _(spark, read):
    flat = cleaning.serialize_complex_types(cleaning.convert_object_ids(_documents(read)))
    return flat.select("_id", "author", "links")


@scan_query("s5_strip_nul")
def _(spark, read):
    documents = cleaning.serialize_complex_types(cleaning.convert_object_ids(_documents(read)))
    return cleaning.strip_nul(documents).select("_id", "body", F.length("body").alias("body_length"))


@scan_query("s2_changed_documents")
def _(spark, read):
    """An export whose documents have fields, one of them nested, that the declared schema does not know, as it is staged."""
    path = fresh_path(spark, "documents-export")
    documents = _documents(read)
    documents.write.json(path)
    declared = documents.drop("body").withColumn("author", F.col("author").dropFields("text")).schema
    exported = readers.extract_document_data(spark, path, declared, surplus="stage")
    store, schema = _isolated_store(spark)
    source = replace(staging.SOURCES["portal"], schema=schema)
    staging.load_table(store, source, "turns", lambda _: exported, LOAD_TS)
    return store.read(schema, "stg_turns")


@query("s6_load_stamp")
def _(table, p):
    return staging.clean(table("src_create.stg_users"), staging.SOURCES["portal"], p.load_ts)


def _isolated_store(spark: SparkSession) -> tuple[TableStore, str]:
    return TableStore(spark, fresh_path(spark, "tables"), publish=False), f"check_{uuid.uuid4().hex[:12]}"


@query("s7_staging_load")
def _(table, p):
    data = table("src_create.stg_staff_attendances")
    store, schema = _isolated_store(data.sparkSession)
    source = replace(staging.SOURCES["portal"], schema=schema)
    for _ in ("first load", "reload"):
        staging.load_table(store, source, "staff_attendances", lambda _: data, p.load_ts)
    return store.read(schema, "stg_staff_attendances")


@query("s8_batch_load")
def _(table, p):
    """Rows and content of every staging table as it is stored after the batch load."""
    store, _ = _isolated_store(table("src_create.stg_users").sparkSession)

    def extract(name: str, t: str) -> DataFrame:
        return table(f"{staging.SOURCES[name].schema}.{staging.staged_name(t)}")

    loaded = staging.load_all(store, extract, p.load_ts)
    for result in loaded.values():
        if isinstance(result, Exception):
            raise result
    parts = []
    for name, t in loaded:
        schema, staged = staging.SOURCES[name].schema, staging.staged_name(t)
        parts.append(runlog.content_digest(store.read(schema, staged), f"{schema}.{staged}"))
    return reduce(DataFrame.unionByName, parts)


@query("s9_materialise")
def _(table, p):
    data = table("jira.dim_members")
    store, schema = _isolated_store(data.sparkSession)
    store.overwrite(schema, "dim_members", data)
    return store.read(schema, "dim_members")


@query("s11_unique_key", REFERENCE)
def _(table, p):
    view = MODELS["jira.mview_member_free_effort"]
    return snapshots.duplicate_keys(table(view.name), view.unique_key)


@query("s11_view_refresh", DELIVERY)
def _(table, p):
    view = MODELS["jira.mview_member_free_effort"]
    worklog, members, efforts = (table(i) for i in view.inputs)
    before = worklog.where(F.col("start_time") < F.lit(OLD_VIEW_CUTOFF).cast("timestamp_ntz"))
    old = free_effort.build(before, members, efforts, p)
    return snapshots.change_counts(old, table(view.name), view.unique_key)


@query("s11_merged_view", DELIVERY, {c: 8 for c in ("actual_efforts", "predicting_efforts", "pod_efforts", "free_efforts")})
def _(table, p):
    """The view as it is stored after two refreshes."""
    view = MODELS["jira.mview_member_free_effort"]
    worklog, members, efforts = (table(i) for i in view.inputs)
    before = worklog.where(F.col("start_time") < F.lit(OLD_VIEW_CUTOFF).cast("timestamp_ntz"))
    store, schema = _isolated_store(worklog.sparkSession)
    for state in (free_effort.build(before, members, efforts, p), table(view.name)):
        snapshots.refresh(store, schema, "view", state, view.unique_key)
    return store.read(schema, "view")


VIEW_DIGITS = {
    c: 8 for c in ("actual_efforts", "predicting_efforts", "pod_efforts", "free_efforts")
}


@query("s12_layers", DELIVERY)
def _(table, p):
    return runlog.total_rows({name: table(name) for name in MODELS})


@scan_query("s13_catalogue_sync")
def _(spark, read):
    remote = read("events").select(
        F.concat(F.lit("src_"), "event_type").alias("table_schema"),
        F.concat(F.lit("stg_u"), F.col("user_id").cast("string")).alias("table_name"),
        F.when(F.col("event_type") == "error", "VIEW").otherwise("BASE TABLE").alias("table_type"),
    ).distinct()
    local = read("supplier").select(
        F.concat(F.lit("stg_u"), F.col("s_suppkey").cast("string")).alias("table_name")
    )
    return runlog.new_tables(remote, local)


@query("s14_date_spine")
def _(table, p):
    """The day spine with the number of pay records that start on each day."""
    starts = table("dwh.users").groupBy(F.col("probation_date").alias("date")).agg(
        F.count(F.lit(1)).alias("starters")
    )
    return table("dwh.time_series").join(starts, "date", "left").withColumn(
        "starters", F.coalesce("starters", F.lit(0))
    )


@query("s15_month_spine", DELIVERY)
def _(table, p):
    """The forecast months with the planned effort of each."""
    efforts = table("jira.fct_pod_member_efforts")
    planned = efforts.groupBy("month_year").agg(F.count(F.lit(1)).alias("plans"))
    spine = calendar.month_spine(efforts.sparkSession, p.as_of, p.forecast_years)
    return spine.join(planned, "month_year", "left").withColumn("plans", F.coalesce("plans", F.lit(0)))


@query("s16_repeatable_sample")
def _(table, p):
    return runlog.repeatable_sample(table("dwh.salaries"), "salary_id", 100)


def _daily_runs(events: DataFrame) -> DataFrame:
    day = F.to_date("ts").cast("timestamp_ntz")
    return events.groupBy(F.col("event_type").alias("table_name"), day.alias("run_ts")).agg(
        F.count(F.lit(1)).alias("total_rows")
    )


@scan_query("s17_row_count_deltas")
def _(spark, read):
    return runlog.row_count_deltas(_daily_runs(read("events")))


def job_log(events: DataFrame) -> DataFrame:
    """One log entry per event type and day."""
    kind = F.col("event_type")
    staged = F.concat(F.lit("stg_"), kind)
    return (
        events.groupBy("event_type", F.to_date("ts").alias("day"))
        .agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("started"), F.max("ts").alias("ended"))
        .select(
            F.concat(F.lit("load_"), kind).alias("job_name"),
            F.lit("source").alias("source_db"),
            F.lit("stg").alias("target_db"),
            runlog.json_list(F.array(kind, staged)).alias("source_table"),
            staged.alias("target_table"),
            F.lit("staging").alias("dag_id"),
            F.concat(kind, F.lit("_to_"), staged).alias("task_id"),
            F.col("started").alias("execution_time"),
            F.when(F.col("n") % 3 == 0, runlog.FAILURE).otherwise(runlog.SUCCESS).alias("status"),
            F.col("ended").alias("created_time"),
        )
    )


@scan_query("s18_job_log")
def _(spark, read):
    entries = job_log(read("events"))
    store, schema = _isolated_store(spark)
    for status in (runlog.SUCCESS, runlog.FAILURE):
        store.append(schema, "etl_job_logs", entries.where(F.col("status") == status))
    return store.read(schema, "etl_job_logs")


@scan_query("s19_expired_backups")
def _(spark, read):
    key = F.col("o_orderkey")
    day = (
        F.when(key % 13 == 0, "99999999")
        .when(key % 17 == 0, "undated")
        .otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    )
    objects = read("orders").select(
        F.concat(F.lit("backup/db-"), day, F.lit("-"), key.cast("string"), F.lit(".gz")).alias("object_name")
    )
    return runlog.expired_objects(objects, dt.date(1998, 1, 2))


@scan_query("s20_load_check")
def _(spark, read):
    return runlog.load_check({n: read(n) for n in SCHEMAS})


# Models --------------------------------------------------------------------------------------------

for _key, _name in (
    ("w1", "billable_efforts_approveds"),
    ("w2", "branches"),
    ("w3", "departments"),
    ("w4", "jira_issue_priority"),
    ("w5", "jira_issue_resolution"),
    ("w6", "jira_issue_status"),
    ("w7", "jira_issue_types"),
    ("w8", "jira_issues"),
    ("w9", "jira_worklog"),
    ("w10", "pods"),
    ("w11", "project_members"),
    ("w12", "project_profit_loss"),
    ("w13", "projects"),
    ("w14", "salaries"),
    ("w15", "staff_attendances"),
    ("w16", "staff_attendances_types"),
    ("w17", "user_positions"),
    ("w18", "users"),
):
    model_query(_key, f"dwh.{_name}", digits=PROJECT_DIGITS)

model_query("h1", "hr.dim_branches")
model_query("h2", "hr.dim_departments")
model_query("h3", "hr.dim_positions")
model_query("h4", "hr.dim_month_year")
model_query("h5", "hr.fct_hrm_employees", digits=EMPLOYEE_DIGITS)
model_query("d1", "jira.dim_jira_issues")
model_query("d2", "jira.dim_members")
model_query("d3", "jira.dim_pods")
model_query("d4", "jira.dim_projects", digits=PROJECT_DIGITS)
model_query("d5", "jira.dim_time_series")
model_query("d6", "jira.fct_pod_member_efforts")
model_query("d7", "jira.fct_project_members")
model_query("d8", "jira.fct_worklog")
model_query("d9", "jira.mview_member_free_effort", DELIVERY, VIEW_DIGITS)
query("d9_mview_member_free_effort_reference", REFERENCE, VIEW_DIGITS)(
    lambda table, _: table("jira.mview_member_free_effort")
)


# Joins and windows whose form differs from the plain one -------------------------------------------


@query("j5_span_join")
def _(table, p):
    """Employment spans against year ends."""
    ends = table("dwh.time_series").where((F.col("month") == 12) & F.col("is_month_end")).select("date")
    spans = span_by_calendar(
        table("dwh.users").select("user_id", "probation_date", "quit_date"),
        ends,
        "probation_date",
        "quit_date",
        p.as_of,
        p.calendar_start,
        yearly=True,
    )
    return spans.where(F.col("quit_date").isNull() | (F.col("quit_date") >= F.trunc("date", "month")))


@query("j6_week_bucket", DELIVERY)
def _(table, p):
    """Issues created per week, empty weeks kept."""
    created = (
        table("dwh.jira_issues")
        .groupBy(dates.sunday_on_or_before("created_time").alias("date"))
        .agg(F.count(F.lit(1)).alias("issues"))
    )
    return (
        table("jira.dim_time_series")
        .select("date", "week_year")
        .join(created, "date", "left")
        .withColumn("issues", F.coalesce("issues", F.lit(0)))
    )


@query("n1_moving_average", REFERENCE, {"actual_efforts": 8, "ma4": 8})
def _(table, p):
    actual = free_effort.actual_efforts(table("jira.fct_worklog"), table("jira.dim_members"))
    return free_effort.with_moving_average(actual, "reference")


@query("n3_n4_carry_forward", DELIVERY, {"lagged": 8, "predicting_efforts": 8})
def _(table, p):
    """The lagged average and its carried-forward form per member and month."""
    worklog, members = table("jira.fct_worklog"), table("jira.dim_members")
    actual = free_effort.with_moving_average(free_effort.actual_efforts(worklog, members), p.mode)
    planned = free_effort.planned_efforts(table("jira.fct_pod_member_efforts"), members)
    spine = calendar.month_spine(worklog.sparkSession, p.as_of, p.forecast_years)
    together = free_effort.combined_efforts(planned, actual, spine, p.mode)
    return free_effort.forecast(together, p.mode).select(
        "member_email", "month_year", "lagged", "predicting_efforts"
    )


# Scalar functions on which engines disagree --------------------------------------------------------


@query("f1_parse_timestamp")
def _(table, p):
    return table("src_create.stg_billable_efforts_approveds").select(
        "_id", "createdAt", dates.parse_ts("createdAt").alias("created_time")
    )


@query("f1_rejected_texts")
def _(table, p):
    return dates.rejected_texts(
        table("src_create.stg_billable_efforts_approveds"),
        "_id",
        {"createdAt": dates.parse_ts, "updatedAt": dates.parse_ts},
    )


@query("f2_parse_day_first_timestamp")
def _(table, p):
    names = ("startDate", "planUATDate", "planReleaseDate", "finalReleaseDate")
    return table("src_create.stg_pods").select(
        "_id", *[dates.parse_ts_day_first(n).alias(n) for n in names]
    )


@query("f3_parse_date")
def _(table, p):
    return table("src_create.stg_user_infos").select(
        "userObjId",
        dates.parse_date_day_first("birthDay").alias("birthday"),
        dates.parse_date("quitDate").alias("quit_date"),
    )


@query("f6_padded_month_name")
def _(table, p):
    issues = table("dwh.jira_issues")
    name = dates.padded_month_name("created_time")
    return issues.select("issue_id", name.alias("month_name"), F.length(name).alias("name_length"))


@query("f8_iso_week")
def _(table, p):
    return table("dwh.jira_issues").select("issue_id", F.weekofyear("created_time").alias("iso_week"))


@query("f9_sunday")
def _(table, p):
    return table("dwh.jira_issues").select(
        "issue_id",
        dates.is_sunday("created_time").alias("is_sunday"),
        dates.sunday_on_or_before("created_time").alias("week_start"),
    )


@query("f10_age_years", digits=AGE_DIGITS)
def _(table, p):
    age = dates.age_parts(F.lit(p.as_of), F.col("birthday"))
    return table("dwh.users").select(
        "user_id", age.years.alias("years"), age.months.alias("months"), age.days.alias("days")
    )


@query("f11_age_in_years", digits={"tenure": 6})
def _(table, p):
    return table("dwh.users").select(
        "user_id", dates.age_in_years(F.lit(p.as_of), F.col("probation_date")).alias("tenure")
    )


@query("f12_elapsed")
def _(table, p):
    return table("dwh.jira_issues").select(
        "issue_id",
        dates.seconds_between("resolution_date", "created_time").alias("seconds"),
        dates.days_between("resolution_date", "created_time").cast("double").alias("days"),
    )


# Data quality --------------------------------------------------------------------------------------


@query("q_a_not_null")
def _(table, p):
    return quality.check_not_null(table(VALUE_TABLE), VALUE_TABLE)


@query("q_b_unique")
def _(table, p):
    return quality.check_unique(table("jira.fct_worklog"), "jira.fct_worklog")


@query("q_c_between")
def _(table, p):
    return quality.check_between(table(VALUE_TABLE), VALUE_TABLE)


def _declared(df: DataFrame) -> StructType:
    """The observed schema, but for one column declared as text."""
    return StructType(
        [StructField(f.name, StringType() if f.name == "value1" else f.dataType) for f in df.schema]
    )


@query("q_d_types")
def _(table, p):
    data = table(VALUE_TABLE)
    return quality.check_types(data, VALUE_TABLE, _declared(data))


@query("q_e_outliers")
def _(table, p):
    return quality.check_outliers(table("dwh.billable_efforts_approveds"), "dwh.billable_efforts_approveds")


def _suite(table) -> DataFrame:
    data = table(VALUE_TABLE)
    return quality.validate(data, VALUE_TABLE, _declared(data))


@query("q_f_suite")
def _(table, p):
    return _suite(table)


@query("q_f_summary", digits={"success_percent": 4})
def _(table, p):
    return quality.suite_summary(_suite(table))


@query("q_g_report")
def _(table, p):
    data = table(VALUE_TABLE)
    older = data.where(F.col("month_at") < "1998-01")
    runs = runlog.row_count(older, VALUE_TABLE, dt.datetime(1998, 1, 1)).unionByName(
        runlog.row_count(data, VALUE_TABLE, LOAD_TS)
    )
    latest = runlog.row_count_deltas(runs).where(F.col("run_ts") == F.lit(LOAD_TS).cast("timestamp_ntz"))
    return quality.report(_suite(table), latest.select("table_name", "total_rows", "new_rows"))


# Analyses ------------------------------------------------------------------------------------------

for _by in ("group", "total", "sequence"):
    query("x1_headcount_change" if _by == "group" else f"x1_headcount_{_by}", digits=CHANGE_DIGITS)(
        lambda table, p, by=_by: analyses.headcount_change(table("dwh.time_series"), table("dwh.users"), p, by)
    )


def _headcount_facts(table, p) -> DataFrame:
    return analyses.headcount_facts(table("dwh.time_series"), table("dwh.users"), p)


query("x2_projects_with_value", digits=PROJECT_DIGITS)(
    lambda table, p: analyses.projects_having_value(table("jira.dim_projects"))
)
query("x3_strict_project_value", digits=PROJECT_DIGITS)(
    lambda table, p: analyses.strict_project_value(table("dwh.projects"), table(VALUE_TABLE))
)
query("x4_yearly_headcount")(lambda table, p: analyses.yearly_headcount(_headcount_facts(table, p)))
query("x4_total_headcount")(lambda table, p: analyses.total_headcount(_headcount_facts(table, p)))
query("x5_ever_joined")(
    lambda table, p: analyses.ever_joined(table("dwh.time_series"), table("dwh.users"), p)
)
query("x6_row_count")(lambda table, p: analyses.row_count(table("dwh.users")))
for _table, _column in (
    ("dwh.users", "user_level"),
    ("hr.fct_hrm_employees", "emp_status"),
    ("dwh.jira_issues", "issue_priority"),
    ("jira.dim_jira_issues", "resolution"),
    ("jira.dim_jira_issues", "status"),
    ("jira.dim_members", "department_name"),
):
    query(f"x6_distinct_{_column}")(
        lambda table, p, t=_table, c=_column: analyses.distinct_values(table(t), c)
    )
query("x7_absence_by_month", digits={"absent_days": 4})(
    lambda table, p: analyses.absence_by_month(table("dwh.staff_attendances"))
)
query("x8_absence_by_year", digits={"absent_days": 4})(
    lambda table, p: analyses.absence_by_year(table("dwh.staff_attendances"))
)
query("x9_users_with_attendance")(
    lambda table, p: analyses.users_with_attendance(
        table("src_create.stg_users"), table("src_create.stg_staff_attendances")
    )
)
query("x10_facts_with_absence", digits=EMPLOYEE_DIGITS)(
    lambda table, p: analyses.facts_with_absence(table("hr.fct_hrm_employees"))
)
query("x10_users_without_start")(lambda table, p: analyses.users_without_start(table("dwh.users")))
query("x11_active_without_start")(
    lambda table, p: analyses.active_without_start(table("dwh.users"), "fixed")
)
query("x11_active_without_start_reference")(
    lambda table, p: analyses.active_without_start(table("dwh.users"), "reference")
)
query("x12_pay_range")(lambda table, p: analyses.pay_range(table("hr.fct_hrm_employees")))
for _mode in ("fixed", "reference"):
    query(
        "x13_resolution_hours" + ("_reference" if _mode == "reference" else ""),
        DELIVERY,
        {"avg_hour_resolution": 6},
    )(
        lambda table, p, mode=_mode: analyses.resolution_hours_by_week(
            table("dwh.jira_issues"), table("jira.dim_time_series"), mode
        )
    )
query("x14_bugs")(lambda table, p: analyses.issues_of_type(table("jira.dim_jira_issues")))


query("x15_project_sla", digits={"sla_compliance_percent": 6})(
    lambda table, p: analyses.project_sla(
        table("jira.dim_projects"), table("jira.fct_project_members"), table("dwh.jira_issues")
    )
)
query("x16_worked_time", digits={"time_worked": 2})(
    lambda table, p: analyses.worked_time(table("jira.fct_worklog"), table("jira.dim_members"))
)
query("x17_contributions", digits={"total_hours_worked": 2})(
    lambda table, p: analyses.contributions(
        table("jira.dim_projects"),
        table("jira.fct_project_members"),
        table("jira.dim_members"),
        table("jira.fct_worklog"),
        analyses.issues_with_status(table("dwh.jira_issues"), table("dwh.jira_issue_status")),
    )
)
query("x18_members_of_pods")(
    lambda table, p: analyses.members_of_pods(
        table("src_create.stg_project_members"), table("src_create.stg_pods")
    )
)
query("x19_future_projects", digits=PROJECT_DIGITS)(
    lambda table, p: analyses.future_projects(table("dwh.projects"), FUTURE_FROM)
)
scan_query("x20_log_of_target")(
    lambda spark, read: analyses.log_of_target(job_log(read("events")), "stg_click")
)
scan_query("x20_log_successes")(lambda spark, read: analyses.log_with_status(job_log(read("events"))))
query("x21_member")(lambda table, p: analyses.member(table("jira.dim_members"), SOME_MEMBER))
