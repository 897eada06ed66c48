"""Exact order statistics of several columns from three scans.

``percentile`` keeps every distinct value of a column in one task's map. Here the first scan makes a mergeable quantile sketch of
every column (KLL, some kilobytes each), which brackets each wanted rank within a small share of the values. The second
counts exactly what lies below and within each bracket, in one aggregate. The third counts the different values
within the brackets; that table, about a hundredth of the values, is checkpointed, and repeated histograms over it find the value of
each rank: a round cuts a bracket into cells and keeps the one cell a rank falls into. A sketch that has missed a rank, which the exact counts show, has its
bracket widened to the column's end.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.session import cut_lineage

# The sketch's size; the rank error at 99 % confidence falls with it, and twice that error is allowed on both sides.
SKETCH = 2048
MARGIN = 2 * 2.296 / SKETCH**0.9021
CELLS = 16_384
CROWDED = 16
# Smallest exponent of a double, so that magnitudes start above zero.
LOWEST_EXPONENT = 1075.0


@dataclass(frozen=True)
class ColumnRange:
    """Count, minimum and maximum of the usable values of a column, and their sketch."""

    rows: int
    low: float | None
    high: float | None
    sketch: bytes | None = None


def usable(name: str) -> Column:
    """The value as a double, with NaN taken as missing."""
    value = F.col(f"`{name}`").cast("double")
    return F.when(~F.isnan(value), value)


def sketch(name: str) -> Column:
    """An aggregate: the quantile sketch of a column's usable values."""
    return F.call_function("kll_sketch_agg_double", usable(name), F.lit(SKETCH))


@dataclass(frozen=True)
class _Range:
    """A value range of a column that still holds wanted ranks, and how many values lie below it."""

    column: str
    rows: int
    below: int
    low: float
    high: float
    ranks: tuple[int, ...]
    source: int = 0
    by_magnitude: bool = False


def _magnitude(v: float) -> float:
    return math.copysign(math.log2(abs(v)) + LOWEST_EXPONENT, v) if v else 0.0


def _cell(value: Column, r: _Range) -> Column:
    """Cell number in 0..CELLS-1. The ends of the range always fall into different cells.

    Cells are equally wide, or equally wide in signed magnitude, which separates values that differ by
    orders of magnitude.
    """
    low, high = _magnitude(r.low), _magnitude(r.high)
    if r.by_magnitude and low < high:
        size = F.log2(F.abs(value)) + LOWEST_EXPONENT
        place = F.when(value > 0, size).when(value < 0, -size).otherwise(F.lit(0.0))
    else:
        # Halving keeps the width finite when the range spans most of the doubles.
        scale = 0.5 if math.isinf(r.high - r.low) else 1.0
        low, high, place = r.low * scale, r.high * scale, value * scale
    share = (place - low) / (high - low)
    return F.greatest(F.lit(0), F.least(F.floor(share * CELLS), F.lit(CELLS - 1)))


def _narrow(values: DataFrame, ranges: Sequence[_Range]) -> list[_Range]:
    """One round over the counted values (source, value, rows): for each range, the cells that hold its wanted ranks."""
    number, cell = F.lit(None).cast("int"), F.lit(None).cast("long")
    for i, r in enumerate(ranges):
        inside = (F.col("source") == r.source) & F.col("value").between(r.low, r.high)
        number = F.when(inside, F.lit(i)).otherwise(number)
        cell = F.when(inside, _cell(F.col("value"), r)).otherwise(cell)
    cells = (
        values.select(number.alias("range"), cell.alias("cell"), "value", "rows")
        .where(F.col("range").isNotNull())
        .groupBy("range", "cell")
        .agg(F.sum("rows").alias("rows"), F.min("value").alias("low"), F.max("value").alias("high"))
    )
    # At most CELLS rows per range reach this window.
    upto = Window.partitionBy("range").orderBy("cell")
    wanted = F.element_at(
        F.array(*[F.array(*[F.lit(k - r.below) for k in r.ranks]) for r in ranges]), F.col("range") + 1
    )
    hits = (
        cells.withColumn("upto", F.sum("rows").over(upto))
        .where(F.exists(wanted, lambda k: (F.col("upto") > k) & (F.col("upto") - F.col("rows") <= k)))
        .collect()  # at most one row per wanted rank
    )
    narrowed = []
    for hit in hits:
        parent = ranges[hit["range"]]
        first = parent.below + hit["upto"] - hit["rows"]
        ranks = tuple(k for k in parent.ranks if first <= k < first + hit["rows"])
        # A cell that still holds much of its range means that the other kind of cell separates better.
        crowded = hit["rows"] * CROWDED > parent.rows
        by_magnitude = parent.by_magnitude != crowded
        narrowed.append(replace(parent, rows=hit["rows"], below=first, low=hit["low"], high=hit["high"], ranks=ranks, by_magnitude=by_magnitude))
    return narrowed


def column_ranges(df: DataFrame, columns: Sequence[str]) -> dict[str, ColumnRange]:
    if not columns:
        return {}
    aggregates = []
    for i, name in enumerate(columns):
        aggregates += [
            F.count(usable(name)).alias(f"n{i}"),
            F.min(usable(name)).alias(f"lo{i}"),
            F.max(usable(name)).alias(f"hi{i}"),
            sketch(name).alias(f"k{i}"),
        ]
    row = df.agg(*aggregates).first()
    return {c: ColumnRange(row[f"n{i}"], row[f"lo{i}"], row[f"hi{i}"], row[f"k{i}"]) for i, c in enumerate(columns)}


def _brackets(df: DataFrame, ranges: Mapping[str, ColumnRange], columns: Sequence[str], shares: Sequence[float]) -> list[_Range]:
    """A bracket for every wanted rank of every column, from the sketches alone."""
    if not columns or not shares:
        return []
    ends = [min(1.0, max(0.0, share + step)) for share in shares for step in (-MARGIN, MARGIN)]
    sketches = df.sparkSession.createDataFrame([(c, bytearray(ranges[c].sketch)) for c in columns], "name string, sketch binary")
    quantiles = F.call_function("kll_sketch_get_quantile_double", "sketch", F.array(*[F.lit(e) for e in ends]))
    found = {r["name"]: r["ends"] for r in sketches.select("name", quantiles.alias("ends")).collect()}
    out = []
    for c in columns:
        for i, share in enumerate(shares):
            low, high = found[c][2 * i : 2 * i + 2]
            low = ranges[c].low if share <= MARGIN else low
            high = ranges[c].high if share >= 1 - MARGIN else high
            out.append(_Range(c, 0, 0, low, high, tuple(sorted(set(_neighbours(ranges[c].rows, share)[:2])))))
    return out


def _counted(df: DataFrame, brackets: Sequence[_Range]) -> list[_Range]:
    """The brackets with the numbers of values below and within them, in one aggregate."""
    counts = []
    for i, b in enumerate(brackets):
        counts += [F.count_if(usable(b.column) < b.low).alias(f"below{i}"), F.count_if(usable(b.column).between(b.low, b.high)).alias(f"rows{i}")]
    row = df.agg(*counts).first()
    return [replace(b, below=row[f"below{i}"], rows=row[f"rows{i}"], source=i) for i, b in enumerate(brackets)]


def _values_within(df: DataFrame, brackets: Sequence[_Range]) -> DataFrame:
    """source, value and rows: the different values within the brackets. Only they leave the scan."""
    inside = [
        F.when(usable(b.column).between(b.low, b.high), F.struct(F.lit(b.source).alias("source"), usable(b.column).alias("value")))
        for b in brackets
    ]
    return (
        df.select(F.explode(F.array_compact(F.array(*inside))).alias("found"))
        .groupBy(F.col("found.source").alias("source"), F.col("found.value").alias("value"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    shares: Sequence[float],
    ranges: Mapping[str, ColumnRange] | None = None,
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles per column; None for a column without values."""
    if ranges is None:
        ranges = column_ranges(df, columns)
    filled = [c for c in columns if ranges[c].rows]
    done: dict[tuple[str, int], float] = {}
    constant = {c for c in filled if ranges[c].low == ranges[c].high}
    for c in constant:
        done.update({(c, k): ranges[c].low for share in shares for k in _neighbours(ranges[c].rows, share)[:2]})
    brackets = _brackets(df, ranges, [c for c in filled if c not in constant], shares)
    while brackets:
        brackets = _counted(df, brackets)
        missed = [b for b in brackets if not b.below <= b.ranks[0] <= b.ranks[-1] < b.below + b.rows]
        held = [b for b in brackets if b not in missed]
        done.update({(b.column, k): b.low for b in held if b.low == b.high for k in b.ranks})
        pending = [replace(b, low=_bounded(b.low), high=_bounded(b.high)) for b in held if b.low != b.high]
        infinite = [b for b in held if b.low != b.high and (math.isinf(b.low) or math.isinf(b.high))]
        done.update(_at_infinity(df, infinite))
        pending = [p for p in (replace(b, ranks=tuple(k for k in b.ranks if (b.column, k) not in done)) for b in pending) if p.ranks]
        if infinite:
            # What lies at -infinity is below the finite part of its bracket.
            pending = [replace(p, below=b.below, rows=b.rows) for p, b in zip(pending, _counted_again(df, pending), strict=True)]
        values = cut_lineage(_values_within(df, pending)) if pending else None
        while pending:
            pending = _narrow(values, pending)
            done.update({(r.column, k): r.low for r in pending if r.low == r.high for k in r.ranks})
            pending = [r for r in pending if r.low != r.high]
        # Brackets that missed their ranks are widened to the ends of the column.
        brackets = [
            replace(b, low=ranges[b.column].low if b.ranks[0] < b.below else b.low, high=ranges[b.column].high if b.ranks[-1] >= b.below + b.rows else b.high)
            for b in missed
        ]

    def interpolate(column: str, share: float) -> float:
        low_rank, high_rank, part = _neighbours(ranges[column].rows, share)
        low, high = done[column, low_rank], done[column, high_rank]
        return low + (high - low) * part if part and low != high else low

    return {
        c: [interpolate(c, share) if c in filled else None for share in shares] for c in columns
    }


def _bounded(x: float) -> float:
    return max(min(x, 1.7976931348623157e308), -1.7976931348623157e308)


def _at_infinity(df: DataFrame, brackets: Sequence[_Range]) -> dict[tuple[str, int], float]:
    """The ranks of the brackets that fall on infinite values."""
    if not brackets:
        return {}
    names = sorted({b.column for b in brackets})
    counts = [F.count_if(usable(c) == sign * math.inf).alias(f"{side}{i}") for i, c in enumerate(names) for side, sign in (("low", -1), ("high", 1))]
    row = df.agg(*counts, *[F.count(usable(c)).alias(f"n{i}") for i, c in enumerate(names)]).first()
    out = {}
    for b in brackets:
        i = names.index(b.column)
        for k in b.ranks:
            if k < row[f"low{i}"]:
                out[b.column, k] = -math.inf
            elif k >= row[f"n{i}"] - row[f"high{i}"]:
                out[b.column, k] = math.inf
    return out


def _counted_again(df: DataFrame, brackets: Sequence[_Range]) -> list[_Range]:
    return [replace(b, source=old.source) for b, old in zip(_counted(df, brackets), brackets, strict=True)] if brackets else []


def _neighbours(rows: int, share: float) -> tuple[int, int, float]:
    """The ranks around a quantile and how far it lies between them."""
    position = share * (rows - 1)
    low = math.floor(position)
    return low, min(low + 1, rows - 1) if position > low else low, position - low
