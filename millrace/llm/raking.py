"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into the cells of a table whose margins are classes of source, language and topic. The tokens of the
cells are counted in one distributed aggregation; then the wanted tokens of the cells are raked: scaled to each
margin's targets in turn, never above what a cell has, for a fixed number of rounds. Each document is drawn with its
cell's wanted share of tokens as probability, decided by a digest of its id and text, so a repeated run draws the same.

The cells are the product of the classes that the caller names and one rest class per margin, so the collected table is
bounded by the caller's targets, not by the data.

Edge cases: null or unnamed values belong to the rest class. Without a target for it, the rest class is wanted with its own
share of the tokens, and the named classes share what is left of the budget. A class without tokens gives its weight to the others of
its margin, in proportion. A document without tokens weighs nothing and is drawn with the share asked for overall. Targets that the
tokens cannot meet are met as far as they go. The draw depends on id and text, so different texts with one id, or with
none, are decided apart; only rows that repeat both are decided alike within a cell. An empty table gives an empty
result. The columns of the table pass through; a table that has columns of the names to be added is refused by
:func:`mix`, and :func:`drawn` then takes other names.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from millrace.llm.scratch import Scratch, bounded_batches

ROUNDS = 40
MAX_CELLS = 100_000
WORD = r"[^\x20\x09-\x0D]+"
REST = None


@dataclass(frozen=True)
class Margin:
    """A column, and the share of tokens wanted for its values; the key REST stands for all others, which keep their own share if it is absent."""

    name: str
    value: Column
    targets: Mapping[object, float]

    def classes(self) -> list[object]:
        return [v for v in self.targets if v is not REST]

    def index(self) -> Column:
        named = self.classes()
        out = F.lit(len(named))
        for i, v in enumerate(named):
            out = F.when(self.value == v, F.lit(i)).otherwise(out)
        return out

    def shares(self) -> np.ndarray:
        return np.array([self.targets[v] for v in self.classes()] + [self.targets.get(REST, np.nan)], dtype=float)


def words(text: Column) -> Column:
    """Number of words, the token weight of a document."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def initials(text: Column, ranges: Sequence[str]) -> Column:
    """A struct: n, the number of words, and n0, n1, ... of those whose first letter is in each range, as in a-d; null has none."""
    tables = []
    for first, last in ((r[0], r[-1]) for r in ranges):
        table = np.zeros(256, bool)
        for letter in (first, first.upper()):
            table[ord(letter) : ord(letter) + ord(last) - ord(first) + 1] = True
        tables.append(table)
    space = np.zeros(256, bool)
    space[[0x20, *range(0x09, 0x0E)]] = True

    @F.pandas_udf("struct<n: long, " + ", ".join(f"n{i}: long" for i in range(len(ranges))) + ">")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for t in texts:
                body = np.frombuffer(b" " if t is None else b" " + t.encode(), np.uint8)
                gap = space[body]
                first = body[1:][gap[:-1] & ~gap[1:]]
                rows.append([len(first), *(int(table[first].sum()) for table in tables)])
            yield pd.DataFrame(rows, columns=["n", *(f"n{i}" for i in range(len(ranges)))])

    return count(text)


def rake(tokens: np.ndarray, shares: Sequence[np.ndarray], budget_share: float, rounds: int = ROUNDS) -> np.ndarray:
    """Wanted tokens of every cell; axis m of ``tokens`` holds the classes of margin m. A class whose share is NaN keeps its own."""
    budget = budget_share * tokens.sum()
    wanted = tokens * budget_share
    for _ in range(rounds):
        for axis, share in enumerate(shares):
            others = tuple(a for a in range(tokens.ndim) if a != axis)
            held = tokens.sum(axis=others)
            own = np.where(np.isnan(share), budget_share * held, 0.0)
            goal = np.where((held > 0) & ~np.isnan(share), share, 0.0)
            goal = (budget - own.sum()) * goal / goal.sum() if goal.sum() > 0 else goal
            goal = goal + own
            now = wanted.sum(axis=others)
            factor = np.divide(goal, now, out=np.zeros_like(goal), where=now > 0)
            shape = [1] * tokens.ndim
            shape[axis] = -1
            wanted = np.minimum(tokens, wanted * factor.reshape(shape))
    return wanted


def draw(identity: Column, text: Column, seed: int) -> Column:
    """A number from 0 up to 1 that depends on the id, the text and the seed alone."""
    parts = F.lit(f"{seed}:"), F.coalesce(identity.cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(text, F.lit("")))
    digits = F.substring(F.md5(F.concat(*parts)), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 52))


def added_columns(margins: Sequence[Margin], prefix: str) -> list[str]:
    """All names that :func:`mix` gives to columns, on its way too."""
    return [f"{prefix}{x}" for x in ("tokens", "draw", "probability", "drawn", *(m.name for m in margins), *(f"key_{m.name}" for m in margins))]


def mix(
    docs: DataFrame,
    margins: Sequence[Margin],
    budget_share: float,
    tokens: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = 11,
    rounds: int = ROUNDS,
    prefix: str = "mix_",
    drop: Sequence[str] = (),
) -> DataFrame:
    """``docs`` with the columns tokens, probability and drawn, and the class index of every margin, under ``prefix``.

    Columns in ``drop`` are used for margins and tokens and then left out.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    sizes = [len(m.classes()) + 1 for m in margins]
    if np.prod(sizes) > MAX_CELLS:
        raise ValueError(f"the targets make more than {MAX_CELLS} cells")
    names = [f"{prefix}{m.name}" for m in margins]
    added = added_columns(margins, prefix)
    if set(added) & set(docs.columns):
        raise ValueError(f"the table already has columns named {sorted(set(added) & set(docs.columns))}")
    # Written, so that classes and counts are worked out once.
    classed = Scratch(spark, "raking").keep(
        docs.withColumns(
            {
                f"{prefix}tokens": words(F.col(text_col)) if tokens is None else tokens,
                f"{prefix}draw": draw(F.col(id_col), F.col(text_col), seed),
            }
            | {n: m.index() for n, m in zip(names, margins, strict=True)}
        ).drop(*drop),
        "classed",
    )
    table = np.zeros(sizes)
    for r in classed.groupBy(*names).agg(F.sum(f"{prefix}tokens").alias("tokens")).collect():
        table[tuple(r[n] for n in names)] = r["tokens"] or 0
    wanted = rake(table, [m.shares() for m in margins], budget_share, rounds)
    probability = np.divide(wanted, table, out=np.full_like(table, budget_share), where=table > 0)
    keys = [f"{prefix}key_{m.name}" for m in margins]
    schema = StructType([StructField(k, IntegerType()) for k in keys] + [StructField(f"{prefix}probability", DoubleType())])
    cells = spark.createDataFrame([(*map(int, at), float(x)) for at, x in np.ndenumerate(probability)], schema)
    on = [F.col(n) == F.col(k) for n, k in zip(names, keys, strict=True)]
    chance = F.when(F.col(f"{prefix}tokens") > 0, F.col(f"{prefix}probability")).otherwise(budget_share)
    return (
        classed.join(F.broadcast(cells), on)
        .drop(*keys)
        .withColumn(f"{prefix}probability", chance)
        .withColumn(f"{prefix}drawn", F.col(f"{prefix}draw") < F.col(f"{prefix}probability"))
        .drop(f"{prefix}draw")
    )


def drawn(docs: DataFrame, margins: Sequence[Margin], *args, **options) -> DataFrame:
    """The rows of ``docs`` that :func:`mix` draws, with their columns."""
    prefix = "mix_"
    while set(added_columns(margins, prefix)) & set(docs.columns):
        prefix = f"_{prefix}"
    return mix(docs, margins, *args, prefix=prefix, **options).where(f"{prefix}drawn").select(*docs.columns)
