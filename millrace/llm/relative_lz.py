"""Substring duplicates by relative Lempel-Ziv parsing.

Every document is factored against blocks of all documents with smaller ids. A factor goes on, word by word, as long as
its last ``window`` words stand in an indexed block; so each factor is at least ``window`` words long, shorter ones being of no use
here, and a window across the boundary of two factors is looked up like any other. The factors' words are the duplicate spans.

Blocks are content-defined: of the ``gram``-word runs in a window the one with the least digest is the window's anchor,
so equal windows have equal anchors wherever they stand. Consecutive windows with one anchor make up a block, indexed by
the anchor's digest and, within it, by the digest of the whole block. Anchors that only one document has are done with. Where
all blocks of an anchor are the same, the least id decides for all their windows. Else one copy of each distinct block is
cut into its windows, and the least id of every window decides. So the index has a row for about every sixteenth word,
nothing grows with the number of pairs of copies, and a hot passage is merged before it is shuffled.

Windows are told apart by two independent 64-bit digests (anchor and window).

Edge cases: a null text has no words; texts shorter than a window lose nothing. A row without an id is kept whole and is nobody's
source. Rows with equal ids are not each other's sources, and repeated rows lose the same words. An
empty table gives an empty result. Only id and text are read. Ids must be whole numbers.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.scratch import Scratch, skew_aware
from millrace.llm.word_hashes import BASES, by_size, mix, range_digests, word_digests

WINDOW = 50
GRAM = 20
SPAN_LIMIT = 62  # windows of a block, as bits of a long


def block_index(first: np.ndarray, words: list[np.ndarray], window: int, gram: int) -> dict[str, np.ndarray]:
    """All blocks of a batch of texts: text, first window (as a word number of its text), windows, anchor, digest.

    ``first`` says where each text's words begin, ``words`` are the words' digests of both families.
    """
    n = np.diff(first)
    count = np.maximum(n - window + 1, 0)
    if not count.sum():
        return {k: np.zeros(0, np.int64) for k in ("text", "start", "windows", "anchor", "digest")}
    total = len(words[0])
    grams = range_digests(words[0], at := np.arange(total - gram + 1), at + gram, BASES[0])
    width = window - gram + 1
    # The place of the least gram in every run of ``width`` grams, the leftmost of equals.
    least, size = np.arange(len(grams)), 1
    while size * 2 <= width:
        a, b = least[: len(least) - size], least[size:]
        least = np.where(grams[a] <= grams[b], a, b)
        size *= 2
    if size < width:
        a, b = least[: len(least) - (width - size)], least[width - size :]
        least = np.where(grams[a] <= grams[b], a, b)
    text = np.repeat(np.arange(len(n)), count)
    place = np.repeat(first[:-1] - count.cumsum() + count, count) + np.arange(len(text))
    anchor = least[place]
    begins = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])]))
    windows = np.diff(np.concatenate([begins, [len(text)]]))
    start, at = place[begins], anchor[begins]
    digest = range_digests(words[1], start, start + windows + window - 1, BASES[1])
    return {
        "text": text[begins],
        "start": start - first[text[begins]],
        "windows": windows,
        "anchor": grams[at].view(np.int64),
        "digest": mix(digest + (at - start).astype(np.uint64)).view(np.int64),
    }


def factors(starts: np.ndarray, window: int) -> list[tuple[int, int]]:
    """First word and length of the greedy factors, given the sorted starts of all windows found in the index."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > 1)
    begin = starts[np.concatenate([[0], cut + 1])]
    end = starts[np.concatenate([cut, [len(starts) - 1]])] + window
    return list(zip(begin.tolist(), (end - begin).tolist(), strict=True))


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), place)


def _squeezed(docs: DataFrame) -> DataFrame:
    """id, th and the compressed text; what a join by document has to move."""

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([zlib.compress(x.as_py(), 1) for x in b.column(2)], pa.binary())], names=["id", "th", "z"]
            )

    return docs.select("id", "th", "body").mapInArrow(squeeze, "id long, th long, z binary")


def duplicate_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_removed, factors (start, length in words), kept (text of the kept words)."""
    if not 1 <= gram <= window or window - gram + 1 > SPAN_LIMIT:
        raise ValueError(f"gram must be from window - {SPAN_LIMIT - 1} to window")
    spark = docs.sparkSession
    skew_aware(spark)
    scratch = Scratch(spark, "relative-lz")
    body = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(body).alias("th"), body.alias("body"))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
            for rows, bodies in by_size(range(batch.num_rows), (x.as_py() for x in batch.column(2))):
                found = block_index(*word_digests(bodies), window, gram)
                if len(found["text"]):
                    at = np.array(rows)[found["text"]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(i[at], pa.int64()) for i in ids]
                        + [pa.array(found["start"], pa.int32()), pa.array(found["windows"], pa.int32())]
                        + [pa.array(found[c], pa.int64()) for c in ("anchor", "digest")],
                        names=["id", "th", "start", "windows", "anchor", "digest"],
                    )

    blocks = scratch.keep(
        source.where("id IS NOT NULL").mapInArrow(index, "id long, th long, start int, windows int, anchor long, digest long"), "blocks"
    )
    anchors = scratch.keep(
        blocks.groupBy("anchor")
        .agg(F.min("id").alias("least"), F.max("id").alias("most"), (F.min("digest") != F.max("digest")).alias("differ"))
        .where("least < most")
        .select("anchor", "least", "differ"),
        "anchors",
    )
    shared = scratch.keep(blocks.join(anchors, "anchor"), "shared")
    scratch.drop("blocks")
    every = _bit(F.col("windows")) - 1
    whole = shared.where("NOT differ AND least < id").select("id", "th", "start", every.alias("found"))

    # Blocks of an anchor that differ: the least holder of each distinct block stands for it.
    differing = shared.where("differ")
    holders = scratch.keep(
        differing.groupBy("anchor", "digest").agg(F.min(F.struct("id", "th", "start", "windows")).alias("of")).select("anchor", "digest", "of.*"),
        "holders",
    )
    wanted = holders.groupBy("id", "th").agg(F.collect_list(F.struct("anchor", "digest", "start", "windows")).alias("blocks"))

    def windows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, bodies in by_size(range(batch.num_rows), (zlib.decompress(x.as_py()) for x in batch.column(1))):
                first, words = word_digests(bodies)
                lists = batch.column(2).take(pa.array(rows))
                per_text = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
                flat = lists.flatten()
                anchor, digest, start, count = (flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in range(4))
                text = np.repeat(np.arange(len(rows)), per_text)
                at = np.repeat(np.arange(len(text)), count)
                offset = np.arange(len(at)) - np.repeat(count.cumsum() - count, count)
                begin = first[text[at]] + start[at] + offset
                found = range_digests(words[1], begin, begin + window, BASES[1]).view(np.int64)
                ids = batch.column(0).to_numpy(zero_copy_only=False)[np.array(rows)][text[at]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, pa.int64()) for x in (anchor[at], digest[at])]
                    + [pa.array(offset, pa.int8()), pa.array(found, pa.int64()), pa.array(ids, pa.int64())],
                    names=["anchor", "digest", "offset", "window", "id"],
                )

    squeezed = _squeezed(source)
    cut = scratch.keep(
        squeezed.join(wanted, ["id", "th"])
        .select("id", "z", "blocks")
        .mapInArrow(windows_of, "anchor long, digest long, offset byte, window long, id long"),
        "windows",
    )
    least = scratch.keep(
        cut.groupBy("anchor", "window").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most").drop("most"), "least"
    )
    holding = scratch.keep(
        cut.select("anchor", "window", "digest", "offset")
        .distinct()
        .join(least, ["anchor", "window"])
        .groupBy("anchor", "digest")
        .agg(F.collect_list(F.struct("offset", "least")).alias("held")),
        "holding",
    )
    bits = F.aggregate(
        F.col("held"),
        F.lit(0).cast("long"),
        lambda found, w: found + F.when(w["least"] < F.col("id"), _bit(w["offset"].cast("int"))).otherwise(0),
    )
    # A block whose windows are shared by nobody else may still have copies of itself.
    own = F.when(F.col("first_id") < F.col("id"), every).otherwise(F.lit(0).cast("long"))
    parts = differing.join(holders.select("anchor", "digest", F.col("id").alias("first_id")), ["anchor", "digest"]).join(
        holding, ["anchor", "digest"], "left"
    ).select("id", "th", "start", F.coalesce(bits, F.lit(0).cast("long")).bitwiseOR(own).alias("found")).where("found <> 0")
    lists = scratch.keep(
        whole.unionByName(parts).groupBy("id", "th").agg(F.collect_list(F.struct("start", "found")).alias("hits")), "lists"
    )

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, size = [], 0
            for identity, z, hits in zip(*(batch.column(c) for c in range(3)), strict=True):
                words = zlib.decompress(z.as_py()).split()  # at the same characters, for bytes
                spans: list[tuple[int, int]] = []
                if hits.is_valid:
                    starts, found = (hits.values.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in range(2))
                    bit = np.flatnonzero((found[:, None] >> np.arange(SPAN_LIMIT)) & 1)
                    spans = factors(np.unique(starts[bit // SPAN_LIMIT] + bit % SPAN_LIMIT), window)
                kept = words
                if spans:
                    stays = np.ones(len(words), bool)
                    for s, length in spans:
                        stays[s : s + length] = False
                    kept = list(compress(words, stays.tolist()))
                text = b" ".join(kept)
                rows.append((identity.as_py(), len(words), len(words) - len(kept), [{"start": s, "length": n} for s, n in spans], text))
                size += len(text)
                if size >= 1 << 23:
                    yield _parsed(rows)
                    rows, size = [], 0
            if rows:
                yield _parsed(rows)

    on = squeezed["id"].eqNullSafe(lists["id"]) & (squeezed["th"] == lists["th"])
    return (
        squeezed.join(lists, on, "left")
        .select(squeezed["id"], "z", "hits")
        .mapInArrow(parse, "id long, n_words long, n_removed long, factors array<struct<start:long,length:long>>, kept binary")
        .select(F.col("id").alias(id_col), "n_words", "n_removed", "factors", F.col("kept").cast("string").alias("kept"))
    )


def _parsed(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    span = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
    kinds = [pa.int64(), pa.int64(), pa.int64(), span, pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["id", "n_words", "n_removed", "factors", "kept"]
    )
