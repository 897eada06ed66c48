"""Staging loads: every source table whole, cleaned, stamped and swapped in."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from millrace.sources import cleaning
from millrace.sources.readers import Split, extract_sql_data, extract_sql_split
from millrace.sources.tables import TableStore


@dataclass(frozen=True)
class Source:
    """One operational system and how its cells are cleaned."""

    schema: str
    tables: tuple[str, ...]
    documents: bool = False
    strips_nul: bool = True
    splits: Mapping[str, Split] = field(default_factory=dict)

    def extract(self, spark: SparkSession, table: str, url: str | None = None, properties: Mapping[str, str] | None = None) -> DataFrame:
        """A relational table of this source, dealt out as ``splits`` says; without a split it arrives in one task."""
        query = f"SELECT * FROM {table}"
        if table in self.splits:
            return extract_sql_split(spark, query, self.splits[table], url, properties)
        return extract_sql_data(spark, query, None if url is None else {"url": url, "query": query, **(properties or {})})


# The staged systems and their tables.
SOURCES = {
    "portal": Source(
        schema="src_create",
        tables=(
            "projects",
            "project_categories",
            "pods",
            "project_members",
            "user_skills",
            "billable_efforts_approveds",
            "users",
            "branches",
            "user_positions",
            "company_departments",
            "user_infos",
            "profit_loss_expenses",
            "profit_loss_project_expenses",
            "staff_attendances",
            "staff_attendance_types",
            "salaries",
            "project_bill_costs",
        ),
        documents=True,
    ),
    "tracker": Source(
        schema="src_jira",
        tables=("jiraissue", "issuestatus", "project", "resolution", "worklog", "issuetype", "priority"),
    ),
    "facts": Source(schema="src_jisseki", tables=("projects", "project_customer"), strips_nul=False),
}


def staged_name(table: str) -> str:
    return f"stg_{table}"


def clean(df: DataFrame, source: Source, load_ts: dt.datetime) -> DataFrame:
    if source.documents:
        df = cleaning.serialize_complex_types(cleaning.convert_object_ids(df))
    if source.strips_nul:
        df = cleaning.strip_nul(df)
    return cleaning.stamp(df, load_ts)


def load_table(
    store: TableStore, source: Source, table: str, extract: Callable[[str], DataFrame], load_ts: dt.datetime
) -> DataFrame:
    """Loads one table; the columns of its first load stay fixed."""
    cleaned = clean(extract(table), source, load_ts)
    return store.overwrite(source.schema, staged_name(table), cleaned, frozen=True)


def load_all(
    store: TableStore,
    extract: Callable[[str, str], DataFrame],
    load_ts: dt.datetime,
    parallel: int = 4,
) -> dict[tuple[str, str], DataFrame | Exception]:
    """Loads every table of every source; a failed table does not stop the others.

    The threads only submit Spark jobs, so small tables share the cluster instead of queueing.
    """

    def one(job: tuple[str, str]) -> DataFrame | Exception:
        name, table = job
        try:
            return load_table(store, SOURCES[name], table, lambda t: extract(name, t), load_ts)
        except Exception as error:  # noqa: BLE001 - reported per table
            return error

    jobs = [(name, table) for name, source in SOURCES.items() for table in source.tables]
    with ThreadPoolExecutor(parallel) as pool:
        return dict(zip(jobs, pool.map(one, jobs)))
