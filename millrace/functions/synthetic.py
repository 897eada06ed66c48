"""Repeatable pseudo-random draws: a pure function of row key, column and seed.

An unseeded generator would give other values on every run and on every retry of a lost task. A digest of
the row's own key gives the same value on any partitioning and in any engine.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

HEX_DIGITS = 8


def fraction(row_key: Column, column_name: str, seed: str) -> Column:
    """A value in [0, 1) for this row, column and seed."""
    digest = F.md5(F.concat(row_key, F.lit(f"|{column_name}|{seed}")))
    return F.conv(F.substring(digest, 1, HEX_DIGITS), 16, 10).cast("bigint") / F.lit(
        float(16**HEX_DIGITS)
    )


def whole_number(row_key: Column, column_name: str, seed: str, low: int, high: int) -> Column:
    """A whole number between ``low`` and ``high``, both included."""
    span = high - low + 1
    return F.floor(F.lit(low) + fraction(row_key, column_name, seed) * span).cast("int")
