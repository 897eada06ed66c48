"""A row-frame window over one global order, without moving all rows to one task.

Spark runs a window that has no PARTITION BY in a single task. Here every row gets its position in the
global order from per-bucket counts, positions are cut into blocks of equal size, and each block also
receives the few rows just before it, which is all a frame of n PRECEDING rows can reach. Buckets must be
small and follow the order; a digest prefix of the tie-break key splits a bucket that one hot value (say,
one month) would otherwise make huge.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

BLOCK_ROWS = 100_000
DIGEST_PREFIX = 2

_INTERNAL = ("_digest", "_slice", "_rank", "_before", "_index", "_block")


def with_tie_digest(df: DataFrame, tie_keys: Sequence[str], prefix: int = DIGEST_PREFIX) -> DataFrame:
    """Adds ``_digest`` (order among equal leading values) and ``_slice``, its first hex digits."""
    key = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in tie_keys])
    return df.withColumn("_digest", F.md5(key)).withColumn(
        "_slice", F.substring("_digest", 1, prefix)
    )


def with_global_index(df: DataFrame, leading: Sequence[str], tie_keys: Sequence[str]) -> DataFrame:
    """Adds ``_index``, the 0-based position in the order (leading, digest of ties, ties).

    The running total runs over one row per (leading, slice). ``leading`` therefore has to be a calendar
    column: its distinct values grow with time passed, not with the data.
    """
    # One text per leading column that is never null, so that the window below and the join with the offsets
    # hash the same plain keys and share one shuffle.
    keys = [f"_key{i}" for i in range(len(leading))]
    known = [
        F.when(F.col(c).isNull(), "").otherwise(F.concat(F.lit("="), F.col(c).cast("string"))).alias(k)
        for c, k in zip(leading, keys)
    ]
    sliced = with_tie_digest(df, tie_keys)
    counts = sliced.groupBy(*leading, "_slice").agg(F.count(F.lit(1)).alias("_rows"))
    # Missing leading values come last, as the source queries order them.
    in_order = [F.col(c).asc_nulls_last() for c in leading]
    running = Window.orderBy(*in_order, "_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*known, "_slice", F.coalesce(F.sum("_rows").over(running), F.lit(0)).alias("_before"))
    in_bucket = Window.partitionBy(*keys, "_slice").orderBy("_digest", *tie_keys)
    ranked = sliced.select("*", *known).withColumn("_rank", F.row_number().over(in_bucket))
    return (
        ranked.join(offsets, [*keys, "_slice"], "inner")
        .withColumn("_index", F.col("_before") + F.col("_rank") - 1)
        .drop(*keys)
    )


def sequential_window(
    df: DataFrame,
    leading: Sequence[str],
    tie_keys: Sequence[str],
    preceding: int,
    columns: Callable[[WindowSpec], dict[str, Column]],
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Adds ``columns(window)`` where window is ORDER BY (leading, ties) ROWS preceding..CURRENT.

    ``columns`` receives the ordered window without a frame for functions such as ``lag`` that reach no
    further back than ``preceding`` rows; the frame is applied with ``rowsBetween`` by the caller.
    (leading, tie_keys) must identify a row.
    """
    if block_rows <= preceding:
        raise ValueError("a block must hold more rows than the frame reaches back")
    indexed = with_global_index(df, leading, tie_keys)
    home = F.expr(f"_index div {block_rows}")
    last_rows = F.pmod(F.col("_index"), F.lit(block_rows)) >= block_rows - preceding
    blocks = indexed.withColumn(
        "_block", F.explode(F.when(last_rows, F.array(home, home + 1)).otherwise(F.array(home)))
    )
    window = Window.partitionBy("_block").orderBy("_index")
    result = blocks.select("*", *[c.alias(n) for n, c in columns(window).items()])
    return result.where(F.col("_block") == home).drop(*_INTERNAL)


def carry_forward(
    value: Column | str, partition: Sequence[str], order: Sequence[Column | str]
) -> Column:
    """The last known value at or before each row, for a partition whose order has no ties."""
    frame = (
        Window.partitionBy(*partition)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return F.last(value, ignorenulls=True).over(frame)


def carry_forward_by_island(
    df: DataFrame, value: str, partition: Sequence[str], order: str, name: str
) -> DataFrame:
    """As :func:`carry_forward`, but rows that tie on ``order`` share their island, in two windows.

    The island id is a running count over a RANGE frame, so peers see each other's values; inside an
    island the first row by ``order`` wins, among peers the smallest known value.
    """
    running = Window.partitionBy(*partition).orderBy(F.col(order).asc_nulls_last())
    islands = df.withColumn("_island", F.sum(F.when(F.col(value).isNotNull(), 1)).over(running))
    inside = Window.partitionBy("_island", *partition).orderBy(
        F.col(order).asc_nulls_last(), F.col(value).asc_nulls_last()
    )
    return islands.withColumn(
        name, F.first(value).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    ).drop("_island")
