"""Divergence of sources: how far each (lang, source) group's use of words is from the other sources and from its language.

Terms are runs of letters (ASCII letters and all characters beyond ASCII), with A-Z lower-cased. A language keeps the terms of at least
MIN_DOCS of its documents. A group gives a kept term, of which it has ``count`` occurrences, the price
1 + floor(SCALE * (count + 5) / (N + 5 * V)) with its N occurrences of the V kept terms; so does the language as a whole.

The distance of two groups is the sum over all kept terms of the differences of their prices. A price depends on the
group and the count only, so it is enough to know, for every pair of groups, how many terms have count i in the one and j
in the other: the joint table of the pair. All tables come from one product: the terms are rows, the columns are indicators of (group, count level),
and the matrix times its transpose holds every joint table as a block. The matrix is never built whole. Terms are dealt into blocks of about
BLOCK_TERMS, ordered by their occurrences, and groups into blocks of COLUMNS; each task takes one block of
terms and one pair of group blocks and multiplies SLICE terms at a time, so that a slice has few levels. A product
counts at most SLICE terms per cell, which is exact in single precision; prices and sums are whole numbers.

Null text, lang and source count as empty. Texts without terms still make their group, with N = 0. Repeated rows
count as often as they are there, also for MIN_DOCS. A null id needs nothing, as ids are not read. Other columns are ignored,
whatever their names. Ties rank by the UTF-8 order of the item. A language without kept terms has pairs of value 0 and no
term rows; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.llm.scratch import Scratch, bounded_batches, skew_aware

MIN_DOCS = 30
SCALE = 1_000_000_000
PRIOR = 5
TOP_TERMS = 50
BLOCK_TERMS = 512
SLICE = 32
COLUMNS = 32
# Counts held by a task before it hands them on, and the parts a group's row is copied to, for joins with hot groups.
HELD = 1 << 18
SALTS = 16

# Lower-cases A-Z and makes every other ASCII character but a letter a space.
TERM_BYTES = bytes(
    b | 0x20 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """lang, source, term, docs (that hold it) and n (occurrences), summed over all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs_of: dict[tuple, Counter] = defaultdict(Counter)
        occurrences: dict[tuple, Counter] = defaultdict(Counter)
        held = 0
        for batch in batches:
            for lang, source, body in zip(*(batch.column(c) for c in range(3)), strict=True):
                own = Counter(body.as_py().translate(TERM_BYTES).split())
                key = lang.as_py(), source.as_py()
                held -= len(occurrences[key])
                occurrences[key].update(own)
                docs_of[key].update(own.keys())
                held += len(occurrences[key])
                if held >= HELD:
                    yield from _batches(occurrences, docs_of)
                    occurrences.clear()
                    docs_of.clear()
                    held = 0
        yield from _batches(occurrences, docs_of)

    rows = docs.select(
        F.coalesce(F.col(lang_col), F.lit("")).alias("lang"),
        F.coalesce(F.col(source_col), F.lit("")).alias("source"),
        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("body"),
    )
    return (
        rows.mapInArrow(count, "lang string, source string, term binary, docs long, n long")
        .groupBy("lang", "source", F.col("term").cast("string").alias("term"))
        .agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"))
    )


def _batches(occurrences: dict[tuple, Counter], docs_of: dict[tuple, Counter]) -> Iterator[pa.RecordBatch]:
    for (lang, source), found in occurrences.items():
        if found:
            n = len(found)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * n, pa.string()),
                    pa.array([source] * n, pa.string()),
                    pa.array(list(found), pa.binary()),
                    pa.array([docs_of[lang, source][t] for t in found], pa.int64()),
                    pa.array(list(found.values()), pa.int64()),
                ],
                names=["lang", "source", "term", "docs", "n"],
            )


def price(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + PRIOR) / (total + PRIOR * terms)), without rounding on the way."""
    above = (count + PRIOR).cast("decimal(19,0)") * F.lit(SCALE).cast("decimal(10,0)")
    below = (total + F.lit(PRIOR) * terms).cast("decimal(19,0)")
    return F.call_function("div", above, below) + 1


class Audit:
    """The counted tables of one run, from which the parts are derived.

    groups: lang, source, place (0 to size - 1 within the lang), size, n, terms, lang_n. cells: lang, source, place, block, row (the term's
    place within its block), term, n, price, lang_price, for every kept term of a group. blocks: lang, block, block_terms.
    """

    def __init__(self, docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_docs: int = MIN_DOCS, block_terms: int = BLOCK_TERMS):
        spark = docs.sparkSession
        skew_aware(spark)
        bounded_batches(spark)
        scratch = Scratch(spark, "level-products")
        counted = scratch.keep(term_counts(docs, text_col, lang_col, source_col), "counted")
        common = counted.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n")).where(F.col("docs") >= min_docs).drop("docs")
        common = scratch.keep(common, "common")
        langs = common.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("lang_n").alias("lang_total"))
        blocked = common.join(langs.select("lang", F.ceil(F.col("terms") / block_terms).alias("n_blocks")), "lang").withColumn(
            "block", F.pmod(F.xxhash64("term"), "n_blocks")
        )
        by_use = Window.partitionBy("lang", "block").orderBy(F.desc("lang_n"), "term")
        kept = scratch.keep(blocked.select("lang", "term", "lang_n", "block", (F.row_number().over(by_use) - 1).alias("row")), "kept")
        found = scratch.keep(counted.select("lang", "source", "term", "n").join(kept, ["lang", "term"]), "found")

        every = docs.select(F.coalesce(F.col(lang_col), F.lit("")).alias("lang"), F.coalesce(F.col(source_col), F.lit("")).alias("source")).distinct()
        totals = found.groupBy("lang", "source").agg(F.sum("n").alias("n"))
        zero = F.lit(0).cast("long")
        within = Window.partitionBy("lang")
        self.groups = scratch.keep(
            every.join(totals, ["lang", "source"], "left")
            .join(langs, "lang", "left")
            .select(
                "lang",
                "source",
                (F.row_number().over(within.orderBy("source")) - 1).alias("place"),
                F.count(F.lit(1)).over(within).alias("size"),
                F.coalesce("n", zero).alias("total"),
                F.coalesce("terms", zero).alias("terms"),
                F.coalesce("lang_total", zero).alias("lang_total"),
            ),
            "groups",
        )
        self.blocks = scratch.keep(kept.groupBy("lang", "block").agg(F.count(F.lit(1)).alias("block_terms")), "blocks")
        # A group may hold a third of all cells: its row goes to several parts, among which its cells are dealt.
        part = F.pmod(F.xxhash64("term"), F.lit(SALTS))
        copies = self.groups.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
        self.cells = scratch.keep(
            found.withColumn("part", part)
            .join(copies, ["lang", "source", "part"])
            .select(
                "lang",
                "source",
                "place",
                "size",
                "block",
                "row",
                "term",
                "n",
                price(F.col("n"), F.col("total"), F.col("terms")).alias("price"),
                price(F.col("lang_n"), F.col("lang_total"), F.col("terms")).alias("lang_price"),
            ),
            "cells",
        )

    def _dealt(self, columns: int) -> DataFrame:
        """The cells and, with row null, each group's price of a term that it lacks, for every block of terms and pair of group blocks."""
        missing = (
            self.groups.join(self.blocks, "lang")
            .select("lang", "place", "size", "block", F.lit(None).cast("int").alias("row"), F.lit(0).cast("long").alias("n"), price(F.lit(0).cast("long"), F.col("total"), F.col("terms")).alias("price"), "block_terms")
        )
        cells = self.cells.select("lang", "place", "size", "block", "row", "n", "price", F.lit(None).cast("long").alias("block_terms"))
        own = F.floor(F.col("place") / columns)
        last = F.floor((F.col("size") - 1) / columns)
        return cells.unionByName(missing).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), last))).select(
            "lang", "block", F.least(own, "other").alias("left"), F.greatest(own, "other").alias("right"), "place", "row", "n", "price", "block_terms"
        )

    def pair_values(self, columns: int = COLUMNS) -> DataFrame:
        """lang, a, b (places of groups, a < b) and value, the distance of their prices over all kept terms."""

        def price_block(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            found = Counter()
            for left, right, joint in _products(rows, key[2], key[3], columns):
                worth = np.abs(left.price[:, None] - right.price[None, :]) * joint
                worth = np.add.reduceat(np.add.reduceat(worth, left.starts, axis=0), right.starts, axis=1)
                for i, j in zip(*np.nonzero(worth), strict=True):
                    if left.groups[i] < right.groups[j]:
                        found[int(left.groups[i]), int(right.groups[j])] += int(worth[i, j])
            return pd.DataFrame([(key[0], a, b, v) for (a, b), v in found.items()], columns=["lang", "a", "b", "value"])

        blocks = self._dealt(columns).groupBy("lang", "block", "left", "right")
        return blocks.applyInPandas(price_block, "lang string, a long, b long, value long").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))

    def joint_tables(self, columns: int = COLUMNS) -> DataFrame:
        """lang, a, level_a, b, level_b, terms: how many kept terms have these counts in groups a <= b."""

        def list_block(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            found = Counter()
            for left, right, joint in _products(rows, key[2], key[3], columns):
                for i, j in zip(*np.nonzero(joint), strict=True):
                    a, b = left.owner[i], right.owner[j]
                    if a <= b:
                        found[int(a), int(left.level[i]), int(b), int(right.level[j])] += int(joint[i, j])
            return pd.DataFrame([(key[0], *k, v) for k, v in found.items()], columns=["lang", "a", "level_a", "b", "level_b", "terms"])

        blocks = self._dealt(columns).groupBy("lang", "block", "left", "right")
        listed = blocks.applyInPandas(list_block, "lang string, a long, level_a long, b long, level_b long, terms long")
        return listed.groupBy("lang", "a", "level_a", "b", "level_b").agg(F.sum("terms").alias("terms"))

    def pairs(self) -> DataFrame:
        """Each group's other sources of its language by their distance: lang, source, part, item, value, rank."""
        names = self.groups.select("lang", "place", "source")
        a, b = names.select("lang", F.col("place").alias("a"), "source"), names.select("lang", F.col("place").alias("b"), F.col("source").alias("item"))
        values = self.pair_values()
        both = values.unionByName(values.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
        # The contract wants a row for every pair of a language's sources.
        wanted = a.join(b, "lang").where("a <> b").join(both, ["lang", "a", "b"], "left")
        ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
        return wanted.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0).cast("long")).alias("value")).withColumn(
            "rank", F.row_number().over(ranked)
        )

    def terms(self, top: int = TOP_TERMS) -> DataFrame:
        """Each group's terms with the most above the price of its language: lang, source, part, item, value, rank."""
        above = self.cells.where("price > lang_price").select(
            "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("price") - F.col("lang_price")).alias("value")
        )
        ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
        return above.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top)


class _Side:
    """The indicator columns of a slice for some groups: owner and level of each, its price, and the matrix of zeros and ones."""

    def __init__(self, groups: np.ndarray, zero_price: np.ndarray, terms: int, place: np.ndarray, row: np.ndarray, n: np.ndarray, value: np.ndarray):
        self.groups = groups
        index = np.searchsorted(groups, place)
        level = np.zeros((terms, len(groups)), np.int64)
        level[row, index] = n
        worth = np.broadcast_to(zero_price, level.shape).copy()
        worth[row, index] = value
        order = np.argsort(level, axis=0, kind="stable")
        ranked = np.take_along_axis(level, order, axis=0)
        new = np.ones(ranked.shape, bool)
        new[1:] = ranked[1:] != ranked[:-1]
        per_group = new.sum(axis=0)
        self.starts = np.concatenate([[0], per_group.cumsum()[:-1]])
        column = np.empty_like(level)
        np.put_along_axis(column, order, new.cumsum(axis=0) - 1 + self.starts, axis=0)
        self.matrix = np.zeros((terms, int(per_group.sum())), np.float32)
        self.matrix[np.arange(terms)[:, None], column] = 1
        self.owner = np.repeat(groups, per_group)
        self.level = np.empty(len(self.owner), np.int64)
        self.level[column] = level
        self.price = np.empty(len(self.owner), np.int64)
        self.price[column] = worth


def _products(rows: pd.DataFrame, left: int, right: int, columns: int) -> Iterator[tuple[_Side, _Side, np.ndarray]]:
    """The two sides and their joint tables, slice by slice, of one block of terms and one pair of group blocks."""
    absent = rows["row"].isna().to_numpy()
    zeros = rows[absent].sort_values("place")
    terms = int(zeros["block_terms"].iloc[0])
    cells = rows[~absent].sort_values("row")
    place, row, n, value = (cells[c].to_numpy().astype(np.int64) for c in ("place", "row", "n", "price"))
    groups, zero_price = zeros["place"].to_numpy().astype(np.int64), zeros["price"].to_numpy().astype(np.int64)
    cuts = np.searchsorted(row, np.arange(0, terms + SLICE, SLICE))
    for k, first in enumerate(range(0, terms, SLICE)):
        part = slice(cuts[k], cuts[k + 1])
        sides = []
        for block in {left: 0, right: 0}:
            mine, own = groups // columns == block, place[part] // columns == block
            sides.append(_Side(groups[mine], zero_price[mine], min(SLICE, terms - first), place[part][own], row[part][own] - first, n[part][own], value[part][own]))
        a, b = sides[0], sides[-1]
        yield a, b, (a.matrix.T @ b.matrix).astype(np.int64)


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """Both parts for every (lang, source) group of ``docs``."""
    found = Audit(docs, text_col, lang_col, source_col, min_docs)
    return found.pairs().unionByName(found.terms(top))
