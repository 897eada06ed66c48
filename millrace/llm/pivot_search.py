"""Exact top-k search by inner product with pivot-table elimination.

Every vector's distances to a few pivots are computed once and stored with it. For a query and a candidate the largest
difference of their pivot distances is a lower bound of their distance, and with both norms an upper bound of their inner product.
Within a block the candidates are evaluated in the order of this bound, until it falls below the query's k-th best exact score.

Queries against all rows run in blocks: candidates are packed into blocks, blocks of queries are copied to each group of
candidate blocks, and each pair of blocks gives at most k rows per query, of which the best k remain.

The pivots are the vectors farthest apart among ``SAMPLE`` vectors with the smallest digests; they decide the speed, not
the result.

Edge cases: a null vector, one that holds a null or non-finite component and one without an id take no part. Only vectors of
the query's length are its candidates. Rows with the query's own id are not candidates; any other repeated row is
a candidate of its own. Repeated query rows answer once. Scores beyond 64 bits are ranked exactly and returned as the
nearest long. Fewer candidates than k give fewer rows; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.llm.scratch import Scratch

SAMPLE = 256
PIVOTS = 16
BLOCK = 4096
QUERY_BLOCK = 1024
GROUP_ROWS = 65_536
FIRST_EVALUATED = 64
LONG = (-(1 << 63), (1 << 63) - 1)
# Digits for scores beyond a long, of doubles of any size; as text of one width they sort as numbers.
WIDTH = 700
WIDEST = 10 ** (WIDTH - 1)
BLOCK_SCHEMA = "block long, dim int, ids binary, body binary, distances binary"


def _scaled(batch: pa.RecordBatch, scale: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and floor(scale * x) of the valid vectors of a batch (id, vector), for each length."""
    lists = batch.column(1)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = lengths.cumsum()
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    valid = lists.is_valid().to_numpy(zero_copy_only=False) & (bad[ends] == bad[ends - lengths])
    ids = batch.column(0).to_numpy(zero_copy_only=False)
    for dim in np.unique(lengths[valid]):
        rows = np.flatnonzero(valid & (lengths == dim))
        values = flat[(ends[rows] - dim)[:, None] + np.arange(dim)]
        with np.errstate(over="ignore"):
            yield ids[rows].astype(np.int64), np.floor(values * scale)


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers as 32-bit integers where they fit, else as doubles; the first byte tells which."""
    if not values.size or np.abs(values).max() < 1 << 31:
        return b"i" + values.astype("<i4").tobytes()
    return b"d" + values.astype("<f8").tobytes()


def _unpacked(body: bytes, dim: int) -> np.ndarray:
    kind = "<i4" if body[:1] == b"i" else "<f8"
    flat = np.frombuffer(body, kind, offset=1).astype(np.float64)
    return flat.reshape(-1, dim) if dim else np.zeros((0, 0))


def pack_blocks(vectors: DataFrame, pivots: dict[int, np.ndarray], scale: float, block: int) -> DataFrame:
    """Blocks of at most ``block`` vectors (columns id, vector) of one length, with their distances to the pivots."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def flush(dim: int) -> Iterator[pa.RecordBatch]:
            ids = np.concatenate([i for i, _ in held[dim]])
            values = np.concatenate([v for _, v in held[dim]])
            held[dim] = []
            for a in range(0, len(ids), block):
                i, v = ids[a : a + block], values[a : a + block]
                d = _distances(v, pivots.get(dim, np.zeros((0, dim))))
                body = i.astype("<i8").tobytes()
                yield pa.RecordBatch.from_pydict(
                    {"block": pa.array([zlib.crc32(body)], pa.int64()), "dim": pa.array([dim], pa.int32()), "ids": [body], "body": [_packed(v)], "distances": [d.tobytes()]}
                )

        for batch in batches:
            for ids, values in _scaled(batch, scale):
                dim = values.shape[1]
                held.setdefault(dim, []).append((ids, values))
                if sum(len(i) for i, _ in held[dim]) >= block:
                    yield from flush(dim)
        for dim in held:
            if held[dim]:
                yield from flush(dim)

    return vectors.mapInArrow(pack, BLOCK_SCHEMA)


def _distances(values: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    out = np.empty((len(values), len(pivots)))
    with np.errstate(over="ignore", invalid="ignore"):
        for k, p in enumerate(pivots):
            out[:, k] = np.sqrt(((values - p) ** 2).sum(axis=1))
    return out


def choose_pivots(vectors: DataFrame, scale: float, sample: int = SAMPLE, count: int = PIVOTS) -> dict[int, np.ndarray]:
    """Per vector length, the sampled vectors that lie farthest apart."""
    rows = vectors.orderBy(F.xxhash64("id"), "id").limit(sample).collect()
    by_dim: dict[int, list[np.ndarray]] = {}
    for r in rows:
        v = r["vector"]
        if v is not None and v and all(x is not None and math.isfinite(x) for x in v):
            by_dim.setdefault(len(v), []).append(np.floor(np.array(v, float) * scale))
    out = {}
    for dim, found in by_dim.items():
        v = np.array(found)
        chosen = [0]
        nearest = _distances(v, v[:1])[:, 0]
        while len(chosen) < min(count, len(v)):
            chosen.append(int(nearest.argmax()))
            nearest = np.minimum(nearest, _distances(v, v[chosen[-1:]])[:, 0])
        out[dim] = v[chosen]
    return out


def _best_of_block(q: np.ndarray, q_ids, q_dist, x: np.ndarray, x_ids, x_dist, k: int) -> list[tuple[int, int, int, int]]:
    """(query's place, query id, candidate id, score) of the k best candidates of every query."""
    out = []
    reach = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, q.shape[1])
    exact = reach < 1 << 53  # doubles then hold every partial sum
    whole = None if exact else np.array([[int(a) for a in row] for row in x], dtype=object)
    q_norm, x_norm = (q * q).sum(axis=1), (x * x).sum(axis=1)
    slack = 1.0 + 1e-9 * float(q_norm.max(initial=0) + x_norm.max(initial=0))
    for i in range(len(q)):
        bound = np.sqrt(q_norm[i] * x_norm)
        if x_dist.shape[1]:
            gap = np.zeros(len(x))
            for p in range(x_dist.shape[1]):
                np.maximum(gap, np.abs(x_dist[:, p] - q_dist[i, p]), out=gap)
            bound = np.minimum(bound, (q_norm[i] + x_norm - gap * gap) / 2)
        bound = np.where(np.isfinite(bound), bound + slack, np.inf)
        order = np.argsort(-bound, kind="stable")
        order = order[x_ids[order] != q_ids[i]]
        best: list[tuple[int, int]] = []
        at, step = 0, FIRST_EVALUATED
        while at < len(order) and not (len(best) == k and bound[order[at]] < best[-1][0] * -1):
            rows = order[at : at + step]
            if exact:
                scores = x[rows] @ q[i]
                if len(scores) > k:  # only scores that can still be among the best, ties kept
                    top = np.partition(scores, -k)[-k]
                    rows, scores = rows[scores >= top], scores[scores >= top]
                scores = scores.astype(np.int64).tolist()
            else:
                scores = (whole[rows] @ np.array([int(a) for a in q[i]], dtype=object)).tolist()
            best = sorted(best + list(zip([-s for s in scores], x_ids[rows].tolist(), strict=True)))[:k]
            at, step = at + step, step * 2
        out += [(i, int(q_ids[i]), v, -s) for s, v in best]
    return out


def top_k(
    vectors: DataFrame,
    is_query: Callable[[Column], Column],
    k: int = 5,
    scale: float = 256.0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """query_id, rank from 1, vec_id, score: the k best of all other rows for every row whose id ``is_query``."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "pivot-search")
    source = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector")).where("id IS NOT NULL")
    pivots = choose_pivots(source, scale)
    total = source.count()
    wanted = source.where(is_query(F.col("id"))).dropDuplicates(["id", "vector"])
    query_blocks = max(1, math.ceil(wanted.count() / QUERY_BLOCK))
    groups = max(math.ceil(total / GROUP_ROWS), min(math.ceil(total / BLOCK), 2 * spark.sparkContext.defaultParallelism), 1)
    size = max(1, min(BLOCK, math.ceil(total / groups)))
    table = scratch.keep(pack_blocks(source, pivots, scale, size), "table")
    queries = scratch.keep(pack_blocks(wanted.repartition(query_blocks, "id"), pivots, scale, QUERY_BLOCK), "queries")

    left = table.withColumn("part", F.pmod(F.xxhash64("block", "dim"), F.lit(groups)))
    right = queries.select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("part"),
        "dim",
        *[F.col(c).alias(f"q_{c}") for c in ("ids", "body", "distances")],
    )
    pairs = left.join(right, ["part", "dim"]).select("dim", "ids", "body", "distances", "q_ids", "q_body", "q_distances")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                dim, *bodies = (c[n].as_py() for c in batch.columns)
                sides = []
                for ids, body, dist in (bodies[:3], bodies[3:]):
                    i = np.frombuffer(ids, "<i8")
                    sides.append((i, _unpacked(body, dim), np.frombuffer(dist).reshape(len(i), -1)))
                (x_ids, x, x_dist), (q_ids, q, q_dist) = sides
                if not dim:  # vectors without components score 0 with each other
                    x, q = np.zeros((len(x_ids), 0)), np.zeros((len(q_ids), 0))
                found = _best_of_block(q, q_ids, q_dist, x, x_ids, x_dist, k)
                if found:
                    digest = [zlib.crc32(q[i].tobytes()) for i, *_ in found]
                    score = [min(max(f[3], LONG[0]), LONG[1]) for f in found]
                    columns = [[f[1] for f in found], digest, [f[2] for f in found], score]
                    beyond = ["" if LONG[0] < s < LONG[1] else str(WIDEST + f[3]).zfill(WIDTH) for s, f in zip(score, found, strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [*(pa.array(c, pa.int64()) for c in columns), pa.array(beyond, pa.string())],
                        names=["query_id", "vector", "vec_id", "score", "beyond"],
                    )

    found = pairs.mapInArrow(search, "query_id long, vector long, vec_id long, score long, beyond string")
    order = Window.partitionBy("query_id", "vector").orderBy(F.desc("score"), F.desc("beyond"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
