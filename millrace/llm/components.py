"""Connected components by hooking to the least neighbour and jumping pointers, as joins of written tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.scratch import Scratch

# So many contracted links (16 MB) or fewer are finished by one task.
FINISH = 1 << 20


def components(links: DataFrame, scratch: Scratch, name: str, finish: int = FINISH) -> DataFrame:
    """node and label (the least node of its component) for every node in ``links`` (a, b); both are longs.

    Each step contracts the links by joins, until at most ``finish`` are left.
    """
    edges = scratch.keep(links.select("a", "b").where("a <> b"), f"{name}-edges0")
    labels, step = None, 0
    while edges.count() > finish:
        step += 1
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = scratch.keep(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("p")), f"{name}-parents{step}")
        up = parents.select(F.col("a").alias("p"), F.col("p").alias("q"))
        higher = up.select(F.col("p").alias("q"), F.col("q").alias("r"))
        roots = scratch.keep(
            parents.join(up, "p").join(higher, "q").select(F.col("a").alias("node"), F.col("r").alias("label")), f"{name}-roots{step}"
        )
        labels = _relabelled(labels, roots, scratch, f"{name}-labels{step}")
        a = roots.select(F.col("node").alias("a"), F.col("label").alias("new_a"))
        b = roots.select(F.col("node").alias("b"), F.col("label").alias("new_b"))
        edges = scratch.keep(
            edges.join(a, "a").join(b, "b").select(F.col("new_a").alias("a"), F.col("new_b").alias("b")).where("a <> b").distinct(),
            f"{name}-edges{step}",
        )
    roots = scratch.keep(edges.coalesce(1).mapInArrow(_least_nodes, "node long, label long"), f"{name}-roots")
    return _relabelled(labels, roots, scratch, f"{name}-labels")


def _relabelled(labels: DataFrame | None, roots: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """The labels, each replaced by the label that ``roots`` gives to it."""
    if labels is None:
        return roots
    found = roots.select(F.col("node").alias("label"), F.col("label").alias("root"))
    return scratch.keep(labels.join(found, "label", "left").select("node", F.coalesce("root", "label").alias("label")), name)


def _least_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for batch in batches:
        a.append(batch.column(0).to_numpy())
        b.append(batch.column(1).to_numpy())
    x, y = np.concatenate(a), np.concatenate(b)
    nodes, places = np.unique(np.concatenate([x, y]), return_inverse=True)
    x, y = places[: len(x)], places[len(x) :]
    label, before = np.arange(len(nodes)), None
    while before is None or (label != before).any():
        before = label.copy()
        least = np.minimum(before[x], before[y])
        np.minimum.at(label, before[x], least)
        np.minimum.at(label, before[y], least)
        while (label[label] != label).any():
            label = label[label]
    yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[label])], names=["node", "label"])
