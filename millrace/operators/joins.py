"""Joins that stay balanced when one key owns a large share of the rows.

Small lookups need nothing from here: Spark broadcasts a side whose measured size is under
``spark.sql.autoBroadcastJoinThreshold`` and shuffles it beyond that. When both sides of a join arrive by a
shuffle made for that join, Spark splits a hot partition at run time: either side of an inner join, the
preserved side of an outer one, and by the tasks that wrote it, so that even identical rows part. It cannot
do so when one side is still partitioned by the key from a step before (a sum per key, an earlier join), since
nothing is shuffled there. The functions below close that gap.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

SPLITTABLE_JOINS = ("inner", "left", "left_semi", "left_anti")


def _own_shuffle(on: Sequence[str]) -> Column:
    """Always 0, in a form the optimizer cannot see through."""
    return F.pmod(F.hash(*on), F.lit(1))


def splittable_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Equi-join on equally named columns where a key may own much of ``left``.

    One more key column, the same on both sides, makes Spark shuffle both for this join alone, which is what
    lets it split hot partitions. The price is a second shuffle of a ``right`` that was summed up by the key,
    usually far smaller than ``left``.
    """
    if how not in SPLITTABLE_JOINS:
        raise ValueError(f"hot rows of a {how} join cannot be split")
    on = list(on)
    return (
        left.withColumn("_own", _own_shuffle(on))
        .join(right.withColumn("_own", _own_shuffle(on)), [*on, "_own"], how)
        .drop("_own")
    )


# A key is heavy with this share of the rows, and this many of them; its rows are dealt into so many parts.
HEAVY_SHARE = 0.01
HEAVY_ROWS = 10_000
SALTS = 32


def _key_text(on: Sequence[str]) -> Column:
    """The key as one text, which tells all keys apart."""
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in on]))


def heavy_keys(df: DataFrame, on: Sequence[str], share: float = HEAVY_SHARE, rows: int = HEAVY_ROWS) -> list[str]:
    """The texts of the keys that own at least ``share`` of the rows and ``rows`` of them, by a frequent-items sketch.

    One scan of the key columns; at most 1 / share keys come back. A key with a missing part joins nothing and is never heavy.
    """
    known = functools.reduce(Column.__and__, [F.col(f"`{c}`").isNotNull() for c in on])
    found = df.where(known).select(_key_text(on).alias("key")).agg(
        F.call_function("approx_top_k", F.col("key"), F.lit(math.ceil(1 / share))).alias("top"), F.count(F.lit(1)).alias("rows")
    ).first()
    return sorted(t["item"] for t in found["top"] or [] if t["count"] >= max(rows, share * found["rows"]))


def left_join_hot_right(
    left: DataFrame, right: DataFrame, on: Sequence[str], salts: int = SALTS, share: float = HEAVY_SHARE, rows: int = HEAVY_ROWS
) -> DataFrame:
    """Left join on equally named columns where single keys may own much of ``right``.

    Rows of ``right`` with a heavy key are dealt into ``salts`` parts, and ``left`` rows with such a key are copied to each. As the
    key is there, a copy that meets nothing is no unmatched row and goes. All other rows join as ever. Each side is read once.
    """
    on = list(on)
    heavy = heavy_keys(right, on, share, rows)
    if not heavy:
        return splittable_join(left, right, on, "left")
    is_heavy = F.coalesce(_key_text(on).isin(heavy), F.lit(False))
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    # Equal rows of several tasks part as well.
    part = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in right.columns]) + F.spark_partition_id(), F.lit(salts)).cast("int")
    copies = left.withColumn("_heavy", is_heavy).withColumn("_part", F.explode(F.when(F.col("_heavy"), every).otherwise(F.array(F.lit(0)))))
    dealt = right.withColumns({"_part": F.when(is_heavy, part).otherwise(F.lit(0)), "_met": F.lit(True)})
    return copies.join(dealt, [*on, "_part"], "left").where(~F.col("_heavy") | F.col("_met")).drop("_heavy", "_part", "_met")


def equi_left_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Left join that drops the right key, for lookups keyed by a differently named column."""
    return left.join(right, left[left_key] == right[right_key], "left").drop(right[right_key])
