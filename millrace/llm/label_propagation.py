"""Sharding by balanced label propagation.

Linked documents start on shards drawn by digest. In each round every group counts its members per shard, and members
elsewhere ask to move to the shard that holds most. A shard accepts as many as its quota has room for, small groups first,
counting those that leave it; a group too large for the room is let in in part. Documents without links cut no edge
wherever they are, so they fill what the linked ones leave, and the counts of the shards differ by one at most.

Groups meet in joins and sums; what reaches the driver is a sum per pair of shards and order of magnitude of the group.
Places within a shard are counted per slice of the digest, so no task orders more than a slice.

Edge cases: a null text takes one byte and is equal to the empty text only if ``group`` says so, as by default. Rows with equal or null ids
are documents of their own; rows equal in everything may take each other's places. With fewer rows than shards the
last shards stay empty; an empty table gives an empty result. Only id, text and what ``group`` reads are used.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.llm.scratch import Scratch, skew_aware, unit

ROUNDS = 6
SLICE_ROWS = 4096
LAW = "rows"


def _chosen(values: list, index: Column) -> Column:
    """The literal at ``index``."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _accept(flows: dict[tuple[int, int, int], int], load: list[int], quota: list[int]) -> list[tuple[int, float]]:
    """Per shard the order of magnitude up to which groups may move there, and the share of the next.

    ``flows`` counts the wishes by (from, to, magnitude). A shard takes in what its quota has left plus what leaves it.
    """
    n = len(quota)
    wish = [sum(c for (_, t, _), c in flows.items() if t == s) for s in range(n)]
    share = [1.0] * n
    for _ in range(64):
        leaving = [sum(c * share[t] for (f, t, _), c in flows.items() if f == s) for s in range(n)]
        share = [min(1.0, max(0.0, quota[s] - load[s] + leaving[s]) / wish[s]) if wish[s] else 1.0 for s in range(n)]
    out = []
    for s in range(n):
        room = share[s] * wish[s]
        by_size: dict[int, int] = {}
        for (_, t, m), c in flows.items():
            if t == s:
                by_size[m] = by_size.get(m, 0) + c
        edge = (64, 0.0)
        for m in sorted(by_size):
            if by_size[m] > room:
                edge = (m, room / by_size[m])
                break
            room -= by_size[m]
        out.append(edge)
    return out


def _propagate(state: DataFrame, scratch: Scratch, quota: list[int], rounds: int) -> DataFrame:
    """``state`` holds row, g, draw, label of the linked documents; the labels change."""
    shards = range(len(quota))
    for r in range(rounds):
        held = [F.col(f"c{s}") for s in shards]
        rank = F.array_max(F.array(*[F.struct((held[s] * len(quota) + F.pmod(F.xxhash64("g") + s, F.lit(len(quota)))).alias("v"), F.lit(s).alias("s")) for s in shards]))
        groups = scratch.keep(
            state.groupBy("g")
            .agg(*[F.sum((F.col("label") == s).cast("long")).alias(f"c{s}") for s in shards])
            .select("*", rank["s"].alias("target"), F.floor(F.log2(sum(held[1:], held[0]))).cast("int").alias("magnitude")),
            f"groups{r}",
        )
        sums = groups.groupBy("target", "magnitude").agg(*[F.sum(f"c{s}").alias(f"c{s}") for s in shards]).collect()
        load = [sum(x[f"c{s}"] for x in sums) for s in shards]
        flows = {(s, x["target"], x["magnitude"]): x[f"c{s}"] for x in sums for s in shards if s != x["target"] and x[f"c{s}"]}
        edges = _accept(flows, load, quota)
        # Where only part of a group may still come, further rounds only shuffle the rest about.
        if not any(m < edges[t][0] for _, t, m in flows) and (r or not any(f for _, f in edges)):
            break
        last = _chosen([m for m, _ in edges], F.col("target"))
        part = _chosen([f for _, f in edges], F.col("target"))
        moves = (F.col("magnitude") < last) | ((F.col("magnitude") == last) & (unit(F.col("draw"), F.lit(r)) < part))
        state = scratch.keep(
            state.join(groups.select("g", "target", "magnitude"), "g").select(
                "row", "g", "draw", F.when(moves, F.col("target")).otherwise(F.col("label")).alias("label")
            ),
            f"state{r}",
        )
    return state


def balanced_shards(
    docs: DataFrame,
    n_shards: int = 8,
    id_col: str = "doc_id",
    text_col: str = "text",
    group: Column | None = None,
    rounds: int = ROUNDS,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """One row per row of ``docs``: id, size, text_crc32, shard, slot, links (other members of its group).

    ``group`` is the key that linked documents share (null: none); by default the digest of the text.
    """
    spark = docs.sparkSession
    skew_aware(spark)
    scratch = Scratch(spark, "label-propagation")
    body = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    key = F.unhex(F.sha2(body, 256)) if group is None else group
    rows = scratch.keep(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_col).alias("id"),
            (F.octet_length(body) + 1).cast("long").alias("size"),
            F.crc32(body).alias("crc"),
            key.alias("g"),
        ).withColumn("draw", unit(F.col("row"), F.col("id"), F.col("crc"), F.lit(1))),
        "rows",
    )
    hubs = scratch.keep(rows.where("g IS NOT NULL").groupBy("g").agg(F.count(F.lit(1)).alias("members")).where("members > 1"), "hubs")
    total = rows.count()
    quota = [total // n_shards + (s < total % n_shards) for s in range(n_shards)]
    linked = scratch.keep(
        rows.select("row", "g", "draw")
        .join(hubs, "g")
        .select("row", "g", "draw", F.floor(unit(F.col("draw"), F.lit(2)) * n_shards).cast("int").alias("label")),
        "linked",
    )
    labels = _propagate(linked, scratch, quota, rounds).select("row", "label")

    slices = max(1, math.ceil(total / slice_rows))
    labelled = scratch.keep(
        rows.drop("g")
        .join(labels, "row", "left")
        .withColumns({"label": F.coalesce("label", F.lit(n_shards)), "slice": F.floor(F.col("draw") * slices).cast("long")}),
        "labelled",
    )
    counts = labelled.groupBy("label", "slice").agg(F.count(F.lit(1)).alias("count"))
    before = Window.partitionBy("label").orderBy("slice")
    offsets = scratch.keep(counts.withColumn("before", F.sum("count").over(before) - F.col("count")), "offsets")
    found = {r["label"]: r["n"] for r in offsets.groupBy("label").agg(F.sum("count").alias("n")).collect()}
    load = [found.get(s, 0) for s in range(n_shards)]
    placed = [min(a, q) for a, q in zip(load, quota, strict=True)]
    surplus = [a - p for a, p in zip(load, placed, strict=True)]
    pool_start = [sum(surplus[:s]) for s in range(n_shards + 1)]  # the last for documents without links
    free = [q - p for q, p in zip(quota, placed, strict=True)]
    free_start = [sum(free[:s]) for s in range(n_shards + 1)]

    ranked = labelled.join(offsets.select("label", "slice", "before"), ["label", "slice"]).withColumn(
        "rank", F.col("before") + F.row_number().over(Window.partitionBy("label", "slice").orderBy("draw", "row")) - 1
    )
    stays = F.col("rank") < _chosen([*placed, 0], F.col("label"))
    pool = _chosen(pool_start, F.col("label")) + F.col("rank") - _chosen([*placed, 0], F.col("label"))
    target = F.lit(n_shards - 1)
    for s in reversed(range(n_shards - 1)):
        target = F.when(F.col("pool") < free_start[s + 1], F.lit(s)).otherwise(target)
    sized = rows.select("row", "g").join(hubs, "g").select("row", "members")
    return (
        ranked.withColumn("pool", F.when(~stays, pool))
        .withColumn("shard", F.when(stays, F.col("label")).otherwise(target))
        .withColumn(
            "slot",
            F.when(stays, F.col("rank")).otherwise(F.col("pool") - _chosen(free_start[:-1], F.col("shard")) + _chosen(placed, F.col("shard"))),
        )
        .join(sized, "row", "left")
        .select(
            F.col("id").alias(id_col),
            "size",
            F.col("crc").alias("text_crc32"),
            F.col("shard").cast("int").alias("shard"),
            F.col("slot").cast("long").alias("slot"),
            (F.coalesce("members", F.lit(1)) - 1).alias("links"),
        )
    )
