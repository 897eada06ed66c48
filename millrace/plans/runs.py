"""Whole runs over stored tables: load or build, then log, count, check and report.

The run writes its own record as tables of the ``monitoring`` schema. Checks advise, they stop nothing; a
failed table is logged and everything that reads it is skipped.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable, Iterable
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, functions as F

from millrace.operators import calendar, quality, runlog, snapshots
from millrace.params import Params
from millrace.plans.registry import MODELS, run_order
from millrace.sources import staging
from millrace.sources.tables import TableStore

MONITORING = "monitoring"
LOGS, COUNTS, CHECKS = "etl_job_logs", "row_counts", "quality_results"

CALENDAR = ("dwh", "time_series")
PARALLEL_CHECKS = 8
PARALLEL_MODELS = 4
CHECKS_RAN = "checks_ran"

# The database names a run log entry carries.
STAGING_DB, WAREHOUSE_DB, MART_DB = "staging", "dwh", "dtm"


@dataclass(frozen=True)
class Outcome:
    """One table of a run: where it came from and the stored rows, or why there are none."""

    job: str
    source_db: str
    target_db: str
    sources: tuple[str, ...]
    name: str
    logged_as: str
    result: DataFrame | Exception

    @property
    def status(self) -> str:
        return runlog.FAILURE if isinstance(self.result, Exception) else runlog.SUCCESS


def _union(parts: Iterable[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, parts)


def _log_entries(store: TableStore, outcomes: list[Outcome], p: Params) -> DataFrame:
    rows = [
        (
            o.job,
            o.source_db,
            o.target_db,
            list(o.sources),
            o.logged_as,
            o.job,
            f"{o.status.lower()}_{o.logged_as}",
            p.load_ts,
            o.status,
            p.load_ts,
        )
        for o in outcomes
    ]
    schema = runlog.LOG_SCHEMA.replace("source_table string", "source_table array<string>")
    entries = store.spark.createDataFrame(rows, schema)
    return entries.withColumn("source_table", runlog.json_list(F.col("source_table")))


def _checked(outcome: Outcome) -> DataFrame:
    """The check results of a table; checks that cannot be set up are one failed result that names the error."""
    try:
        return quality.validate(outcome.result, outcome.name)
    except Exception as error:
        row = (outcome.name, None, f"{CHECKS_RAN}: {type(error).__name__}", 0, 0, False)
        return outcome.result.sparkSession.createDataFrame([row], quality.RESULT_SCHEMA)


def record(store: TableStore, outcomes: list[Outcome], p: Params) -> None:
    """Appends the log, the row counts and the check results of a run, one write each.

    A batch is a set of tables at a load time, so a repeated run replaces its own record.
    """
    tables = hashlib.md5("\n".join(sorted(o.name for o in outcomes)).encode()).hexdigest()
    batch = f"{p.load_ts.isoformat()} {tables}"
    store.append(MONITORING, LOGS, _log_entries(store, outcomes, p), batch)
    loaded = [o for o in outcomes if isinstance(o.result, DataFrame)]
    if not loaded:
        return
    store.append(MONITORING, COUNTS, _union(runlog.row_count(o.result, o.name, p.load_ts) for o in loaded), batch)
    run_ts = F.lit(p.load_ts.isoformat(" ")).cast("timestamp_ntz").alias("run_ts")
    # A check runs a few small jobs in a row; threads let those of several tables share the cluster.
    with ThreadPoolExecutor(PARALLEL_CHECKS) as pool:
        checks = _union(pool.map(_checked, loaded))
    store.append(MONITORING, CHECKS, checks.select(run_ts, "*"), batch)


def load_staging(store: TableStore, extract: Callable[[str, str], DataFrame], p: Params) -> list[Outcome]:
    """Loads every source table; ``extract`` gets the source and the table name."""
    outcomes = []
    for (name, table), result in staging.load_all(store, extract, p.load_ts).items():
        target = f"{staging.SOURCES[name].schema}.{staging.staged_name(table)}"
        outcomes.append(
            Outcome(f"{name}_to_staging", name, STAGING_DB, (table,), target, target.split(".")[1], result)
        )
    record(store, outcomes, p)
    return outcomes


def _store_model(store: TableStore, name: str, p: Params) -> DataFrame:
    entry = MODELS[name]
    built = entry.build({i: store.read(*i.split(".")) for i in entry.inputs}, p)
    schema, table = name.split(".")
    if entry.unique_key:
        snapshots.refresh(store, schema, table, built, entry.unique_key)
        return store.read(schema, table)
    return store.overwrite(schema, table, built)


def _outcome(name: str, result: DataFrame | Exception) -> Outcome:
    schema, table = name.split(".")
    in_warehouse = schema == WAREHOUSE_DB
    return Outcome(
        job="staging_to_warehouse" if in_warehouse else "warehouse_to_mart",
        source_db=STAGING_DB if in_warehouse else WAREHOUSE_DB,
        target_db=WAREHOUSE_DB if in_warehouse else MART_DB,
        sources=MODELS[name].inputs,
        name=name,
        logged_as=table if in_warehouse else runlog.mart_target(schema, table),
        result=result,
    )


def build_models(store: TableStore, targets: Iterable[str], p: Params, parallel: int = PARALLEL_MODELS) -> list[Outcome]:
    """Builds ``targets`` and the models they need from stored tables, inputs first.

    A model starts as soon as the ones it reads are stored, up to ``parallel`` at a time, each in a scheduler pool of
    its own, so that with fair scheduling a small one need not wait for a large one's tasks. A failed model blocks
    what reads it and nothing else.
    """
    if not store.exists(*CALENDAR):
        store.overwrite(*CALENDAR, calendar.time_series(store.spark))
    order = run_order(targets)
    results: dict[str, DataFrame | Exception] = {}

    def build(name: str) -> DataFrame | Exception:
        store.spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        try:
            return _store_model(store, name, p)
        except Exception as error:  # noqa: BLE001 - reported per table
            return error

    with ThreadPoolExecutor(parallel) as pool:
        waiting, running = list(order), {}
        while waiting or running:
            for name in [n for n in waiting if all(i in results for i in MODELS[n].inputs if i in order)]:
                waiting.remove(name)
                failed = [i for i in MODELS[name].inputs if isinstance(results.get(i), Exception)]
                if failed:
                    results[name] = RuntimeError(f"not built: {', '.join(sorted(failed))}")
                else:
                    running[pool.submit(inheritable_thread_target(store.spark)(build), name)] = name
            # A blocked model may have made others ready to be blocked.
            if running and not any(all(i in results for i in MODELS[n].inputs if i in order) for n in waiting):
                for future in wait(running, return_when=FIRST_COMPLETED).done:
                    results[running.pop(future)] = future.result()
    outcomes = [_outcome(name, results[name]) for name in order]
    record(store, outcomes, p)
    return outcomes


def reports(store: TableStore, p: Params) -> DataFrame:
    """One readable text per table checked in the run of ``p.load_ts``."""
    now = F.col("run_ts") == F.lit(p.load_ts.isoformat(" ")).cast("timestamp_ntz")
    counts = runlog.row_count_deltas(store.read(MONITORING, COUNTS)).where(now)
    checks = store.read(MONITORING, CHECKS).where(now).drop("run_ts")
    return quality.report(checks, counts.select("table_name", "total_rows", "new_rows"))
