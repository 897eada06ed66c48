"""Column-profile expectations as one long result table.

A suite reads the data for one profile aggregate, a few narrow passes for the exact percentiles, one
aggregate that counts all violations, and one shuffle that checks all id columns for duplicates.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import NumericType, StructType

from millrace.operators.quantiles import ColumnRange, exact_quantiles, sketch, usable

# The expectation names, the percentiles, the outlier limit and the tolerated shares.
NOT_NULL = "expect_column_values_to_not_be_null"
UNIQUE = "expect_column_values_to_be_unique"
BETWEEN = "expect_column_values_to_be_between"
OF_TYPE = "expect_column_values_to_be_of_type"
NOT_IN_SET = "expect_column_values_to_not_be_in_set"
ID_MARK = "id"


@dataclass(frozen=True)
class Limits:
    low_share: float = 0.05
    high_share: float = 0.95
    between_mostly: float = 0.95
    outlier_score: float = 3.0
    outlier_mostly: float = 0.99


RESULT_SCHEMA = (
    "table_name string, column_name string, expectation string, "
    "evaluated bigint, unexpected bigint, success boolean"
)


def id_columns(df: DataFrame) -> list[str]:
    """Columns with "id" anywhere in the name, foreign keys and ``is_hidden`` included."""
    return [c for c in df.columns if ID_MARK in c.lower()]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, NumericType)]


@dataclass(frozen=True)
class Profile:
    """Per-column counts and moments, read back as a single row."""

    rows: int
    filled: Mapping[str, int]
    ranges: Mapping[str, ColumnRange]
    mean: Mapping[str, float | None]
    deviation: Mapping[str, float | None]


def profile(df: DataFrame) -> Profile:
    numeric = numeric_columns(df)
    aggregates = [F.count(F.lit(1)).alias("rows")]
    aggregates += [F.count(f"`{c}`").alias(f"f{i}") for i, c in enumerate(df.columns)]
    for i, c in enumerate(numeric):
        value = usable(c)
        aggregates += [
            F.count(value).alias(f"n{i}"),
            F.min(value).alias(f"lo{i}"),
            F.max(value).alias(f"hi{i}"),
            sketch(c).alias(f"k{i}"),
            F.mean(value).alias(f"m{i}"),
            F.stddev_samp(value).alias(f"s{i}"),
        ]
    row = df.agg(*aggregates).first()
    return Profile(
        rows=row["rows"],
        filled={c: row[f"f{i}"] for i, c in enumerate(df.columns)},
        ranges={
            c: ColumnRange(row[f"n{i}"], row[f"lo{i}"], row[f"hi{i}"], row[f"k{i}"]) for i, c in enumerate(numeric)
        },
        mean={c: row[f"m{i}"] for i, c in enumerate(numeric)},
        deviation={c: row[f"s{i}"] for i, c in enumerate(numeric)},
    )


def _result(table: str, column: str, expectation: str, evaluated: Column, unexpected: Column, mostly: float):
    kept = (evaluated - unexpected) / evaluated
    return F.struct(
        F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"),
        F.lit(expectation).alias("expectation"),
        evaluated.cast("bigint").alias("evaluated"),
        unexpected.cast("bigint").alias("unexpected"),
        F.when(evaluated == 0, F.lit(True)).otherwise(kept >= mostly).alias("success"),
    )


def _count_results(df: DataFrame, results: list[Column]) -> DataFrame:
    """Results built from aggregates, computed in one pass and laid out as rows."""
    if not results:
        return df.sparkSession.createDataFrame([], RESULT_SCHEMA)
    return df.agg(F.array(*results).alias("results")).select(F.inline("results"))


def not_null_results(df: DataFrame, table: str) -> list[Column]:
    """Every column filled in every row."""
    rows = F.count(F.lit(1))
    return [_result(table, c, NOT_NULL, rows, rows - F.count(f"`{c}`"), 1.0) for c in df.columns]


def check_not_null(df: DataFrame, table: str) -> DataFrame:
    return _count_results(df, not_null_results(df, table))


def check_unique(df: DataFrame, table: str) -> DataFrame:
    """No value of an id column occurs twice; every row of a duplicate group counts.

    All id columns share one shuffle of (column, value) counts, combined before it moves, so a hot value
    arrives as one small row per task.
    """
    ids = id_columns(df)
    if not ids:
        return df.sparkSession.createDataFrame([], RESULT_SCHEMA)
    cells = F.array(
        *[F.struct(F.lit(i).alias("position"), F.col(f"`{c}`").cast("string").alias("value")) for i, c in enumerate(ids)]
    )
    counts = (
        df.select(F.explode(cells).alias("cell"))
        .where(F.col("cell.value").isNotNull())
        .groupBy(F.col("cell.position").alias("position"), F.col("cell.value").alias("value"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )

    def sums(i: int) -> tuple[Column, Column]:
        mine = F.when(F.col("position") == i, F.col("rows"))
        zero = F.lit(0)
        return F.coalesce(F.sum(mine), zero), F.coalesce(F.sum(F.when(F.col("rows") > 1, mine)), zero)

    return _count_results(
        counts, [_result(table, c, UNIQUE, *sums(i), 1.0) for i, c in enumerate(ids)]
    )


def between_results(df: DataFrame, table: str, found: Profile, limits: Limits = Limits()) -> list[Column]:
    """Values within the table's own percentiles; exact, from :func:`exact_quantiles`."""
    numeric = numeric_columns(df)
    bounds = exact_quantiles(df, numeric, [limits.low_share, limits.high_share], found.ranges)
    results = []
    for c in numeric:
        low, high = bounds[c]
        outside = (
            F.lit(0) if low is None else F.count_if((usable(c) < low) | (usable(c) > high))
        )
        results.append(_result(table, c, BETWEEN, F.count(usable(c)), outside, limits.between_mostly))
    return results


def check_between(df: DataFrame, table: str, limits: Limits = Limits()) -> DataFrame:
    return _count_results(df, between_results(df, table, profile(df), limits))


def check_types(df: DataFrame, table: str, declared: StructType) -> DataFrame:
    """Observed against declared column types; a column of another type fails with all its values."""
    expected = {f.name: f.dataType for f in declared}
    return _count_results(df, type_results(df, table, expected))


def type_results(df: DataFrame, table: str, expected: Mapping[str, object]) -> list[Column]:
    results = []
    for f in df.schema:
        filled = F.count(f"`{f.name}`")
        fits = expected.get(f.name, f.dataType) == f.dataType
        results.append(_result(table, f.name, OF_TYPE, filled, F.lit(0) if fits else filled, 1.0))
    return results


def outlier_results(df: DataFrame, table: str, found: Profile, limits: Limits = Limits()) -> list[Column]:
    """Values further from the mean than ``outlier_score`` sample deviations.

    None if the deviation is 0, or if infinite values leave no finite mean and deviation.
    """
    results = []
    for c in numeric_columns(df):
        mean, deviation = found.mean[c], found.deviation[c]
        far = (
            F.count_if(F.abs(usable(c) - mean) / deviation > limits.outlier_score)
            if deviation and math.isfinite(deviation) and math.isfinite(mean)
            else F.lit(0)
        )
        results.append(_result(table, c, NOT_IN_SET, F.count(usable(c)), far, limits.outlier_mostly))
    return results


def check_outliers(df: DataFrame, table: str, limits: Limits = Limits()) -> DataFrame:
    return _count_results(df, outlier_results(df, table, profile(df), limits))


def validate(
    df: DataFrame, table: str, declared: StructType | None = None, limits: Limits = Limits()
) -> DataFrame:
    """All expectations of a table: table_name, column_name, expectation, evaluated, unexpected, success."""
    found = profile(df)
    expected = {f.name: f.dataType for f in (declared or df.schema)}
    counted = _count_results(
        df,
        [
            *not_null_results(df, table),
            *between_results(df, table, found, limits),
            *type_results(df, table, expected),
            *outlier_results(df, table, found, limits),
        ],
    )
    return counted.unionByName(check_unique(df, table))


def suite_summary(results: DataFrame) -> DataFrame:
    """Per table: overall success, evaluated and successful expectations, success percent."""
    return (
        results.groupBy("table_name")
        .agg(
            F.bool_and("success").alias("success"),
            F.count(F.lit(1)).alias("evaluated_expectations"),
            F.count_if("success").alias("successful_expectations"),
        )
        .withColumn(
            "success_percent",
            F.col("successful_expectations") / F.col("evaluated_expectations") * 100,
        )
    )


def report(results: DataFrame, row_counts: DataFrame) -> DataFrame:
    """One readable text per table. ``row_counts`` has table_name, total_rows and new_rows.

    A table contributes one line per failed expectation, so a text is bounded by its number of columns.
    """
    failed = F.when(
        ~F.col("success"),
        F.format_string("- %s (Column: %s, Unexpected: %d)", "expectation", "column_name", "unexpected"),
    )
    lines = results.groupBy("table_name").agg(F.sort_array(F.collect_list(failed)).alias("failed"))
    body = F.when(F.size("failed") == 0, "All expectations passed!").otherwise(
        F.concat(F.lit("Failed Expectations:\n"), F.array_join("failed", "\n"))
    )
    joined = suite_summary(results).join(lines, "table_name").join(row_counts, "table_name", "left")
    text = F.concat_ws(
        "\n",
        F.concat(F.lit("Table: "), "table_name"),
        F.concat(F.lit("Total Rows: "), F.col("total_rows").cast("string")),
        F.concat(F.lit("New Rows Inserted: "), F.col("new_rows").cast("string")),
        F.concat(F.lit("Status: "), F.when(F.col("success"), "Passed").otherwise("Failed")),
        F.concat(F.lit("Total Expectations: "), F.col("evaluated_expectations").cast("string")),
        F.concat(F.lit("Successful: "), F.col("successful_expectations").cast("string")),
        F.concat(F.lit("Success Rate: "), F.format_string("%.2f", "success_percent"), F.lit("%")),
        body,
    )
    return joined.select("table_name", text.alias("report"))


