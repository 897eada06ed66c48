"""Run log, row-count deltas, samples, retention and load checks."""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import BooleanType, DateType, FractionalType, IntegralType, StringType, TimestampNTZType, TimestampType

SUCCESS, FAILURE = "SUCCESS", "FAILURE"

LOG_SCHEMA = (
    "job_name string, source_db string, target_db string, source_table string, target_table string, "
    "dag_id string, task_id string, execution_time timestamp_ntz, status string, created_time timestamp_ntz"
)


def json_list(names: Column | Sequence[str]) -> Column:
    """Table names as a JSON array text."""
    return F.to_json(names if isinstance(names, Column) else F.array(*[F.lit(n) for n in names]))


def log_row(spark: SparkSession, created_time: dt.datetime, **entry: object) -> DataFrame:
    """One log entry. A list of source tables is stored as JSON text, a single name as it is."""
    sources = entry.get("source_table")
    several = isinstance(sources, (list, tuple))
    values = {**entry, "source_table": None if several else sources, "created_time": created_time}
    names = [part.split()[0] for part in LOG_SCHEMA.split(", ")]
    row = spark.createDataFrame([tuple(values.get(n) for n in names)], LOG_SCHEMA)
    return row.withColumn("source_table", json_list(sources)) if several else row


def mart_target(mart: str, table: str) -> str:
    """Name under which a mart table is logged."""
    return f"{mart}_dtm-{table}"


def row_count(df: DataFrame, table: str, run_ts: dt.datetime) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_rows")).select(
        F.lit(table).alias("table_name"),
        F.lit(run_ts.isoformat(" ")).cast("timestamp_ntz").alias("run_ts"),
        "total_rows",
    )


def row_count_deltas(row_counts: DataFrame) -> DataFrame:
    """Adds ``previous_rows`` (0 before the first run) and ``new_rows``, which may be negative.

    A table contributes one row per run, so a window partition holds its run history and no data rows.
    """
    runs = Window.partitionBy("table_name").orderBy("run_ts")
    return row_counts.withColumn(
        "previous_rows", F.coalesce(F.lag("total_rows").over(runs), F.lit(0))
    ).withColumn("new_rows", F.col("total_rows") - F.col("previous_rows"))


def repeatable_sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """``rows`` rows in the order of a digest of their key: the same ones on every run.

    Spark keeps the best ``rows`` of each task and merges those, so nothing is sorted as a whole.
    """
    digest = F.md5(F.col(key).cast("string"))
    return df.orderBy(digest, key).limit(rows)


def expired_objects(objects: DataFrame, as_of: dt.date, keep_days: int = 1) -> DataFrame:
    """Objects whose first 8-digit date lies before the kept days; undated and misdated ones are kept."""
    digits = F.regexp_extract("object_name", r"(\d{8})", 1)
    # No match extracts as '', and there is no year 0.
    day = F.concat_ws(
        "-", F.substring(digits, 1, 4), F.substring(digits, 5, 2), F.substring(digits, 7, 2)
    ).try_cast("date")
    dated = objects.withColumn("object_date", F.when(~digits.startswith("0000"), day))
    return dated.where(F.col("object_date") < F.date_sub(F.lit(as_of), keep_days))


def total_rows(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table: table_name, row_count. Only counts leave the tasks."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return functools.reduce(DataFrame.unionByName, counts)


# Below this every half is a double of its own, so that rounding by comparison is exact.
EXACT_HALVES = float(2**52)
# A row's 60-bit digest is summed in three parts of 20 bits: longs hold the sums of 2**43 rows.
PART_BITS = 20


def _millionths(cell: Column) -> Column:
    """The rounded millionths of a fraction as text, halves away from zero; only huge ones need decimals, which cost far more."""
    value = cell.cast("double") * 1_000_000
    size = F.abs(value)
    whole = F.floor(size)
    rounded = whole + F.when(size - whole >= 0.5, 1).otherwise(0)
    signed = F.when(value < 0, -rounded).otherwise(rounded).cast("string")
    return F.when(size < EXACT_HALVES, signed).otherwise(F.round(value).cast("decimal(38,0)").cast("string"))


def _cell_text(df: DataFrame, name: str) -> Column:
    """A cell as a text that any engine can form: fractions as millionths, times as ISO text, a missing cell unlike any other."""
    kind, cell = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, FractionalType):
        text = _millionths(cell)
    elif isinstance(kind, (TimestampType, TimestampNTZType)):
        text = F.date_format(cell, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    elif isinstance(kind, (IntegralType, BooleanType, DateType, StringType)):
        text = cell.cast("string")
    else:
        text = F.to_json(cell)
    return F.coalesce(F.concat(F.lit("="), text), F.lit("-"))


def content_digest(df: DataFrame, table: str) -> DataFrame:
    """table_name, row_count and content_digest: the sum of a 60-bit digest per row, whatever the order of rows and columns.

    One aggregate over the table; tables of the same rows, repeated ones included, have the same digest.
    """
    row = F.md5(F.concat_ws("\x1f", *[_cell_text(df, c) for c in sorted(df.columns)]))
    number = F.conv(F.substring(row, 1, 15), 16, 10).cast("bigint")
    parts = [F.shiftright(number, i * PART_BITS).bitwiseAND(F.lit((1 << PART_BITS) - 1)) for i in range(3)]
    sums = df.agg(F.count(F.lit(1)).alias("row_count"), *[F.coalesce(F.sum(n), F.lit(0)).cast("decimal(20,0)").alias(f"part_{i}") for i, n in enumerate(parts)])
    digest = functools.reduce(Column.__add__, [F.col(f"part_{i}") * F.lit(1 << i * PART_BITS).cast("decimal(13,0)") for i in range(3)])
    return sums.select(F.lit(table).alias("table_name"), "row_count", digest.cast("decimal(38,0)").cast("string").alias("content_digest"))


def load_check(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The sum over all tables and whether it is present and above zero."""
    return (
        total_rows(tables)
        .agg(F.sum("row_count").alias("total_rows"))
        .withColumn("loaded", F.coalesce(F.col("total_rows") > 0, F.lit(False)))
    )


def new_tables(remote: DataFrame, local: DataFrame, remote_schema: str | None = None) -> DataFrame:
    """Base tables listed remotely whose name is not present locally; present ones are not compared.

    Further columns of the listing are carried along.
    """
    listed = remote.where(F.col("table_type") == "BASE TABLE").drop("table_type")
    if remote_schema is not None:
        listed = listed.where(F.col("table_schema") == remote_schema)
    return listed.join(local.select("table_name").distinct(), "table_name", "left_anti")
