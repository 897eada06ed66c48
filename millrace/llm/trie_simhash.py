"""SimHash near-duplicates: fingerprints of three-word shingles, joined with themselves in binary tries.

Two fingerprints are linked if they differ in at most ERRORS bits. The join walks two nodes of a trie at a time, from
(root, root) down: a pair of nodes carries the bits in which its two prefixes differ, and is dropped once these exceed
the budget. Of ERRORS + 1 equal parts of two linked fingerprints one is the same in both, so there is one trie per part, that
begins with this part and allows no error in it: its nodes at that depth are independent, and Spark deals them out. A
node pair with more than ``limit`` fingerprints is walked on in Spark, STEP levels at a time; smaller ones are finished in
numpy, a frontier of bounded size at a time. A task returns at most one link per fingerprint it holds, as pairs of nodes
whose leaves are known to be connected are not walked again.

Words are runs of characters other than space and tab to carriage return, with A-Z lower-cased. Null and empty texts
and texts of white space have the fingerprint zero, which is linked like any other; a text with fewer than three words
is one shingle. Repeated rows and rows with a null id get a fingerprint and a component of their own row; a null id is
never a component's name, so it is null where no row of the component has an id. Ties (a bit set in exactly half of the
shingles) are zero. Other columns are ignored, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.components import components
from millrace.llm.scratch import Scratch, bounded_batches, skew_aware

SHINGLE = 3
SEED = 42
BITS = 64
ERRORS = 3
PART = BITS // (ERRORS + 1)
STEP = 8
# Fingerprints of a node pair that one task walks by itself (8 MB).
LIMIT = 1 << 20
# Node pairs held at once in a task; nodes so small that all their leaves are compared.
FRONTIER = 1 << 18
LEAVES = 64
SHINGLES_AT_ONCE = 1 << 16
CHUNK = 1 << 19

U = np.uint64


def fingerprint(body: bytes) -> int:
    """The majority of the shingles' hashes, bit by bit."""
    words = body.lower().split()  # ASCII only, for bytes
    if not words:
        return 0
    if len(words) < SHINGLE:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    text = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[: -SHINGLE] + 1]).tolist()
    ends = ends[SHINGLE - 1 :].tolist()
    votes = np.zeros(BITS, np.int64)
    for k in range(0, len(starts), SHINGLES_AT_ONCE):
        upto = slice(k, k + SHINGLES_AT_ONCE)
        found = [xxhash.xxh64_intdigest(text[s:e], SEED) for s, e in zip(starts[upto], ends[upto], strict=True)]
        bits = np.unpackbits(np.array(found, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and print (the fingerprint as a signed long) for every row of ``docs``."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(x.as_py()) for x in batch.column(1)], U).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], names=["id", "print"])

    body = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    return docs.select(F.col(id_col).cast("long").alias("id"), body.alias("body")).mapInArrow(read, "id long, print long")


def _masks(width: int, most: int) -> np.ndarray:
    """Numbers of ``width`` bits with at most ``most`` ones."""
    every = np.arange(1 << width)
    return every[np.bitwise_count(every.astype(U)) <= most]


def _turned(part: Column) -> Column:
    """The fingerprint turned so that it begins with the given part."""
    shift = (part * PART).cast("int")
    return F.when(shift == 0, F.col("print")).otherwise(
        F.call_function("shiftleft", F.col("print"), shift).bitwiseOR(F.call_function("shiftrightunsigned", F.col("print"), F.lit(BITS) - shift))
    )


NODES = ("part", "depth", "a", "b")


def node_pairs(prints: DataFrame, scratch: Scratch, limit: int = LIMIT) -> DataFrame:
    """part, depth, a, b, turned: the turned fingerprints of every pair (a, b) of nodes that a task has to walk.

    Starts with the nodes (a, a) at depth PART; a pair with more than ``limit`` fingerprints is replaced by the pairs STEP
    levels below whose prefixes are within the budget, where both nodes have leaves.
    """
    parts = prints.select("print", F.explode(F.array(*[F.lit(i) for i in range(BITS // PART)])).alias("part"))
    rows = parts.select("part", F.lit(PART).alias("depth"), _turned(F.col("part")).alias("turned"))
    prefix = F.call_function("shiftrightunsigned", F.col("turned"), F.lit(BITS - PART))
    open_rows = rows.select("part", "depth", prefix.alias("a"), prefix.alias("b"), "turned")
    done, depth = [], PART
    while depth + STEP < BITS:
        large = scratch.keep(open_rows.groupBy(*NODES).count().where(F.col("count") > limit).select(*NODES), f"large{depth}")
        if large.isEmpty():
            break
        done.append(open_rows.join(large, list(NODES), "left_anti"))
        open_rows = _walked(open_rows.join(large, list(NODES)), scratch, f"nodes{depth + STEP}")
        depth += STEP
    for part in done:
        open_rows = open_rows.unionByName(part)
    return open_rows


def _walked(rows: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """The node pairs STEP levels below those of ``rows``."""
    shift = F.lit(BITS) - F.col("depth") - STEP
    own = F.call_function("shiftrightunsigned", F.col("turned"), shift.cast("int"))
    below = own.bitwiseAND(F.lit((1 << STEP) - 1))
    left = F.call_function("shiftrightunsigned", own, F.lit(STEP)) == F.col("a")
    spent = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    masks = F.array(*[F.lit(int(m)).cast("long") for m in _masks(STEP, ERRORS)])
    fits = F.filter(masks, lambda m: F.bit_count(m) + spent <= ERRORS)
    step = rows.withColumn("mask", F.explode(fits)).withColumns({"own": own, "left": left})
    other = F.call_function("shiftleft", F.when(F.col("left"), F.col("b")).otherwise(F.col("a")), F.lit(STEP)).bitwiseOR(below.bitwiseXOR(F.col("mask")))
    # Of a node with itself, a pair of different children is met from both sides under one name.
    twin = F.col("a") == F.col("b")
    first = F.when(twin, F.least("own", "other")).when(F.col("left"), F.col("own")).otherwise(F.col("other"))
    second = F.when(twin, F.greatest("own", "other")).when(F.col("left"), F.col("other")).otherwise(F.col("own"))
    below_rows = scratch.keep(
        step.withColumn("other", other).select("part", (F.col("depth") + STEP).alias("depth"), first.alias("a"), second.alias("b"), "turned", (F.col("own") == first).alias("is_a")),
        f"{name}-all",
    )
    both = below_rows.groupBy(*NODES).agg((F.bool_or("is_a") & F.bool_or((F.col("a") == F.col("b")) | ~F.col("is_a"))).alias("met"))
    return scratch.keep(below_rows.join(both.where("met"), list(NODES)).select(*NODES, "turned"), name)


def _merge(label: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Joins the labels of x and y in place; a label is the least place of its component."""
    while True:
        least = np.minimum(label[x], label[y])
        if (label[x] == least).all() and (label[y] == least).all():
            return
        for side in (x, y):
            np.minimum.at(label, label[side], least)
            np.minimum.at(label, side, least)
        while (label[label] != label).any():
            label[:] = label[label]


def walk(prints: np.ndarray, roots: np.ndarray, errors: int = ERRORS, frontier: int = FRONTIER) -> np.ndarray:
    """The least connected place of every fingerprint.

    ``roots`` has the node pairs to start with as columns a_from, a_to, b_from, b_to, depth: ranges of ``prints``, each sorted. The budget
    grows from one error to ``errors``, so that dense groups are connected by few links and not walked for the rest.
    """
    label = np.arange(len(prints))
    prints = prints.astype(U)
    spent = np.bitwise_count((prints[roots[0]] ^ prints[roots[2]]) & _high(roots[4]))
    start = np.vstack([roots, spent.astype(np.int64)])
    for budget in range(1, errors + 1):
        stack = [start[:, start[5] <= budget]]
        until = _same_until(label)
        while stack:
            nodes = stack.pop()
            if nodes.shape[1] > frontier:
                stack += [nodes[:, frontier:], nodes[:, :frontier]]
                continue
            a_from, a_to, b_from, b_to = nodes[:4]
            known = (until[a_from] >= a_to) & (until[b_from] >= b_to) & (label[a_from] == label[b_from])
            nodes = nodes[:, ~known]
            few = (nodes[1] - nodes[0]) * (nodes[3] - nodes[2]) <= LEAVES
            small = nodes[:, few]
            if small.shape[1]:
                x, y = _leaves(small)
                near = np.bitwise_count(prints[x] ^ prints[y]) <= budget
                near &= label[x] != label[y]
                if near.any():
                    _merge(label, x[near], y[near])
                    until = _same_until(label)
            nodes = nodes[:, ~few]
            if nodes.shape[1]:
                stack.append(_children(prints, nodes, budget))
    return label


def _high(depth: np.ndarray) -> np.ndarray:
    """The first ``depth`` bits; depth is from 1 to BITS."""
    return ~U(0) << (U(BITS) - depth.astype(U))


def _same_until(label: np.ndarray) -> np.ndarray:
    """The first place after each at which the label is another."""
    ends = np.concatenate([np.flatnonzero(label[1:] != label[:-1]) + 1, [len(label)]])
    return np.repeat(ends, np.diff(ends, prepend=0))


def _leaves(nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of leaves of the node pairs."""
    a_from, a_to, b_from, b_to = nodes[:4]
    wide = b_to - b_from
    count = (a_to - a_from) * wide
    owner = np.repeat(np.arange(len(count)), count)
    place = np.arange(len(owner)) - np.repeat(count.cumsum() - count, count)
    return a_from[owner] + place // wide[owner], b_from[owner] + place % wide[owner]


def _children(prints: np.ndarray, nodes: np.ndarray, budget: int) -> np.ndarray:
    """The pairs of children within the budget; a node with itself gives three, two nodes give four."""
    a_from, a_to, b_from, b_to, depth, spent = nodes
    a_mid, b_mid = _middle(prints, a_from, depth), _middle(prints, b_from, depth)
    a_mid, b_mid = np.clip(a_mid, a_from, a_to), np.clip(b_mid, b_from, b_to)
    same = a_from == b_from
    found = [
        np.vstack([a_from, a_mid, b_from, b_mid, depth + 1, spent]),
        np.vstack([a_mid, a_to, b_mid, b_to, depth + 1, spent]),
        np.vstack([a_from, a_mid, b_mid, b_to, depth + 1, spent + 1]),
        np.vstack([a_mid, a_to, b_from, b_mid, depth + 1, spent + 1])[:, ~same],
    ]
    out = np.concatenate(found, axis=1)
    return out[:, (out[0] < out[1]) & (out[2] < out[3]) & (out[5] <= budget)]


def _middle(prints: np.ndarray, first: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """Where the ones begin among the fingerprints with the node's prefix, in the whole sorted run of its group."""
    one = U(1) << (U(BITS - 1) - depth.astype(U))
    return np.searchsorted(prints, (prints[first] & _high(depth)) | one)


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) of the node pairs in sorted rows of NODES and turned; whole node pairs, about CHUNK rows at a time."""
    held: list[np.ndarray] = []
    size = 0
    for batch in batches:
        rows = np.vstack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in range(5)])
        if not rows.shape[1]:
            continue
        held.append(rows)
        size += rows.shape[1]
        if size >= CHUNK:
            rows = np.concatenate(held, axis=1)
            edge = np.flatnonzero((rows[:4, 1:] != rows[:4, :-1]).any(axis=0))
            if len(edge):
                cut = int(edge[-1]) + 1
                yield _links_of(rows[:, :cut])
                rows = rows[:, cut:]
            held, size = [rows], rows.shape[1]
    if size:
        yield _links_of(np.concatenate(held, axis=1))


def _links_of(rows: np.ndarray) -> pa.RecordBatch:
    part, depth, a, b, turned = rows
    edge = np.flatnonzero((rows[:4, 1:] != rows[:4, :-1]).any(axis=0)) + 1
    start = np.concatenate([[0], edge])
    stop = np.concatenate([edge, [rows.shape[1]]])
    prints = turned.view(U)
    out_a, out_b = [], []
    # The search for a node's middle needs one sorted run, so groups of one part and depth go together where they ascend.
    for x, y in _runs(rows, start, stop):
        groups = slice(*np.searchsorted(start, [x, y]))
        s, e = start[groups] - x, stop[groups] - x
        own = prints[x:y]
        twin = a[x:y][s] == b[x:y][s]
        prefix = own >> (U(BITS) - depth[x:y].astype(U))
        is_a = prefix == a[x:y].view(U)
        lower = np.add.reduceat(is_a.astype(np.int64), s)
        middle = np.where(twin, s, s + lower)
        roots = np.vstack([s, np.where(twin, e, middle), middle, e, depth[x:y][s]])
        label = walk(own, roots)
        linked = np.flatnonzero(label != np.arange(len(label)))
        back = _unturned(own, part[x:y])
        out_a.append(back[linked])
        out_b.append(back[label[linked]])
    columns = [np.concatenate(c).view(np.int64) for c in (out_a, out_b)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["a", "b"])


def _runs(rows: np.ndarray, start: np.ndarray, stop: np.ndarray) -> list[tuple[int, int]]:
    """Stretches of whole groups in which the fingerprints ascend."""
    prints = rows[4].view(U)
    falls = prints[start[1:]] <= prints[stop[:-1] - 1]
    cuts = np.concatenate([[0], start[1:][falls], [rows.shape[1]]])
    return list(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))


def _unturned(prints: np.ndarray, part: np.ndarray) -> np.ndarray:
    shift = (part * PART).astype(U)
    return np.where(shift == 0, prints, (prints >> shift) | (prints << ((U(BITS) - shift) % U(BITS))))


def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """One row per row of ``docs``: id, fingerprint (16 hexadecimal digits) and component_id, the least id that can be reached."""
    spark = docs.sparkSession
    skew_aware(spark)
    bounded_batches(spark)
    scratch = Scratch(spark, "trie-simhash")
    prints = scratch.keep(fingerprints(docs, id_col, text_col), "prints")
    least = scratch.keep(prints.groupBy("print").agg(F.min("id").alias("least")), "least")
    walked = node_pairs(least.select("print"), scratch, limit)
    order = [*NODES, "turned"]
    links = walked.select(*order).repartition(*NODES).sortWithinPartitions(*order).mapInArrow(_linked, "a long, b long")
    labels = components(scratch.keep(links, "links"), scratch, "components")
    joined = least.join(labels.withColumnRenamed("node", "print"), "print", "left").select("print", "least", F.coalesce("label", "print").alias("label"))
    names = joined.groupBy("label").agg(F.min("least").alias("component_id"))
    named = scratch.keep(joined.join(names, "label").select("print", "component_id"), "named")
    return prints.join(named, "print").select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id"
    )
